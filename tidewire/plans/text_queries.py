"""Row-wise text, URL and hash queries, exact dedup and wire copies."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire.functions import text as T
from tidewire.functions import url as U
from tidewire.plans.registry import query
from tidewire.sources.tables import articles, table

_COLLAPSED = r"trim(regexp_replace(lower(body), '[\s\p{Z}]+', ' ', 'g'))"
#: Words, distinct shingles of five and their number, in SQL.
SHINGLES = r"""w AS (SELECT id, list_filter(regexp_split_to_array(lower(body), '[\s\p{Z}]+'), lambda x: x <> '') AS ws FROM a),
    sh AS (SELECT id, list_distinct(list_transform(range(1, greatest(len(ws) - 3, 2)), lambda i: array_to_string(ws[i : i + 4], ' '))) AS s FROM w)"""


@query("SELECT id, domain, lang, title, fetched, tier, owner, length(body) AS n_chars FROM a", articles=True)
def articles_projection(spark, sf):
    return articles(spark, sf).select("id", "domain", "lang", "title", F.col("fetched").cast("double").alias("fetched"), "tier", "owner", F.length("body").cast("long").alias("n_chars"))


@query("SELECT owner, tier, count(*) AS n, count(DISTINCT domain) AS domains FROM a GROUP BY owner, tier", articles=True)
def owner_tier_projection(spark, sf):
    return articles(spark, sf).groupBy("owner", "tier").agg(F.count("*").alias("n"), F.countDistinct("domain").alias("domains"))


@query(f"SELECT id, sha256({_COLLAPSED}) AS content_hash FROM a", articles=True)
def content_hash(spark, sf):
    return articles(spark, sf).select("id", T.content_hash(F.col("body")).alias("content_hash"))


@query(f"WITH {SHINGLES} SELECT id, len(s) AS n_shingles, sha256(array_to_string(list_sort(s), '|')) AS shingle_hash FROM sh", articles=True)
def shingle_counts(spark, sf):
    s = T.with_shingles(articles(spark, sf).select("id", "body"), "body", "s")
    return s.select("id", F.size("s").cast("long").alias("n_shingles"), F.sha2(F.array_join(F.array_sort("s"), "|").cast("binary"), 256).alias("shingle_hash"))


@query(r"SELECT id, trim(regexp_replace(regexp_replace(lower(title), '[^\p{L}\p{N}_\s]', '', 'g'), '\s+', ' ', 'g')) AS headline FROM a", articles=True)
def headline_normalise(spark, sf):
    return articles(spark, sf).select("id", T.headline_key(F.col("title")).alias("headline"))


@query(r"""WITH p AS (SELECT id, list_filter(list_transform(CASE WHEN len(regexp_split_to_array(body, '\n\s*\n')) > 1 THEN regexp_split_to_array(body, '\n\s*\n') ELSE string_split(body, chr(10)) END,
    lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> '') AS ps FROM a) SELECT id, len(ps) AS n_paragraphs, sha256(array_to_string(ps, chr(10))) AS joined FROM p""", articles=True)
def paragraph_split(spark, sf):
    p = articles(spark, sf).select("id", T.paragraphs(F.col("body")).alias("p"))
    return p.select("id", F.size("p").cast("long").alias("n_paragraphs"), F.sha2(F.array_join("p", "\n").cast("binary"), 256).alias("joined"))


@query("""SELECT band, count(*) AS n, round(avg(value), 6) AS mean FROM (SELECT value, CASE WHEN value >= 70 THEN 'major' WHEN value >= 60 THEN 'strong' WHEN value >= 50 THEN 'moderate' WHEN value >= 40 THEN 'light' WHEN value >= 30 THEN 'minor' ELSE 'micro' END AS band FROM events) GROUP BY band""")
def magnitude_bands(spark, sf):
    e = table(spark, sf, "events").select("value", T.magnitude_band(F.col("value") / 10).alias("band"))
    return e.groupBy("band").agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean"))


@query(r"""SELECT page_id, trim(regexp_extract(html, '<title[^>]*>([^<]*)</title>', 1)) AS title, sha256(trim(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->', ' ', 'g'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))) AS text_hash FROM pages""")
def html_title_strip(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.trim(F.regexp_extract("html", "<title[^>]*>([^<]*)</title>", 1)).alias("title"), F.sha2(T.visible_text(F.col("html")).cast("binary"), 256).alias("text_hash"))


@query(r"""SELECT page_id, len(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)) AS links, len(regexp_extract_all(html, '<(?:iframe|video|img|audio)\b')) AS media, len(regexp_extract_all(html, '<p\b')) AS blocks FROM pages""")
def html_media_links(spark, sf):
    n = lambda p, g=0: F.size(F.regexp_extract_all("html", F.lit(p), F.lit(g))).cast("long")
    return table(spark, sf, "pages").select("page_id", n('<a [^>]*href="([^"]*)"', 1).alias("links"), n(r"<(?:iframe|video|img|audio)\b").alias("media"), n(r"<p\b").alias("blocks"))


@query(r"""SELECT id, array_to_string(list_filter(regexp_extract_all(body, '"([^"]{20,300})"', 1), lambda q: contains(q, ' '))[1:10], '|') AS quotes FROM a""", articles=True)
def quotes_extract(spark, sf):
    q = F.filter(F.regexp_extract_all("body", F.lit('"([^"]{20,300})"'), F.lit(1)), lambda x: F.contains(x, F.lit(" ")))
    return articles(spark, sf).select("id", F.array_join(F.slice(q, 1, 10), "|").alias("quotes"))


@query(r"""SELECT id, array_to_string(regexp_extract_all(body, '\d+(?:[.,]\d+)*%?'), '|') AS numbers, len(regexp_extract_all(body, '\d+(?:[.,]\d+)*%?')) AS n FROM a""", articles=True)
def statistics_extract(spark, sf):
    n = F.regexp_extract_all("body", F.lit(r"\d+(?:[.,]\d+)*%?"), F.lit(0))
    return articles(spark, sf).select("id", F.array_join(n, "|").alias("numbers"), F.size(n).cast("long").alias("n"))


@query("SELECT id, unnest(range(0, CAST(ceil(length(body) / 480.0) AS BIGINT))) AS chunk, substring(body, CAST(480 * unnest(range(0, CAST(ceil(length(body) / 480.0) AS BIGINT))) + 1 AS BIGINT), 480) AS part FROM a WHERE body <> ''", articles=True)
def text_chunks(spark, sf):
    return articles(spark, sf).select("id", F.posexplode(T.chunks(F.col("body"))).alias("chunk", "part")).withColumn("chunk", F.col("chunk").cast("long"))


@query(r"""SELECT id, coalesce(nullif(substring(regexp_replace(regexp_replace(lower(trim(title)), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 32), ''), 'neutral') AS label FROM a""", articles=True)
def viewpoint_label(spark, sf):
    return articles(spark, sf).select("id", T.label_key(F.col("title")).alias("label"))


_NAMES = ", ".join(f"'{x}'" for x in U.TRACKING)
_PREFIXES = "|".join(U.TRACKING_PREFIXES)
_SUFFIXES = ", ".join(f"'{x}'" for x in U.PUBLIC_SUFFIXES)
#: The rules for absolute URLs, labels off one at a time; the pages' queries hold nothing that is encoded.
_CANONICAL = rf"""u AS (SELECT page_id, trim(url) AS url FROM pages),
    h0 AS (SELECT page_id, url, lower(regexp_extract(url, '^https?://([^/?#:]*)', 1)) AS host, 0 AS n FROM u),
    h1 AS (SELECT * FROM h0 UNION ALL SELECT page_id, url, array_to_string(string_split(host, '.')[2:], '.'), n + 1 FROM h1
        WHERE string_split(host, '.')[1] IN ('www', 'm', 'mobile', 'amp') AND len(string_split(host, '.')) >= 3 AND array_to_string(string_split(host, '.')[2:], '.') NOT IN ({_SUFFIXES})),
    h AS (SELECT page_id, any_value(url) AS url, arg_max(host, n) AS host FROM h1 GROUP BY page_id),
    x AS (SELECT page_id, url, host,
        regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '/+$', ''), '^/(?i:amp)/', '/'), '/(?i:amp)$', ''), '/+$', '') AS path,
        list_sort(list_filter(list_transform(list_filter(string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'), lambda p: p <> ''), lambda p: lower(string_split(p, '=')[1]) || '=' || array_to_string(string_split(p, '=')[2:], '=')),
            lambda p: NOT list_contains([{_NAMES}], string_split(p, '=')[1]) AND NOT regexp_matches(p, '^({_PREFIXES})') AND NOT regexp_matches(p, '^(amp|ampmode|amp_js_v|output)=(|1|(?i:amp|true))$'))) AS q FROM h),
    c AS (SELECT page_id, url, 'https://' || host || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS canonical, host FROM x)"""


@query(f"WITH RECURSIVE {_CANONICAL} SELECT page_id, canonical, sha256(lower(canonical)) AS url_hash FROM c")
def url_canonical(spark, sf):
    return table(spark, sf, "pages").select("page_id", U.canonical(F.col("url")).alias("canonical"), U.url_hash(F.col("url")).alias("url_hash"))


@query(f"WITH RECURSIVE {_CANONICAL} SELECT canonical, min(page_id) AS first_page, count(*) AS copies FROM c GROUP BY canonical")
def url_hash_dedup(spark, sf):
    return table(spark, sf, "pages").select("page_id", U.canonical(F.col("url")).alias("canonical")).groupBy("canonical").agg(F.min("page_id").alias("first_page"), F.count("*").alias("copies"))


@query(f"WITH RECURSIVE {_CANONICAL} SELECT host, count(*) AS n FROM c GROUP BY host ORDER BY n DESC, host LIMIT 60")
def url_domain_top(spark, sf):
    return table(spark, sf, "pages").select(U.host(F.trim("url")).alias("host")).groupBy("host").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "host").limit(60)


@query(f"WITH RECURSIVE {_CANONICAL} SELECT page_id, canonical AS from_search, canonical AS from_cache, canonical AS from_feed FROM c")
def url_unwrap(spark, sf):
    """The pages' URLs as three redirectors would carry them, one inside the other too."""
    u = F.trim("url")
    wrap = lambda lead, x: F.concat(F.lit(lead), F.url_encode(x))
    search = wrap("https://www.google.com/url?sa=t&utm_source=x&url=", u)
    feed = wrap("http://feeds.feedburner.com/~r/x?u=", wrap("https://www.google.com/url?q=", u))
    # A cache carries the path alone, so the query goes behind it through a search redirector.
    cache = wrap("https://news.google.com/url?dest=", u)
    return table(spark, sf, "pages").select("page_id", U.canonical(search).alias("from_search"), U.canonical(cache).alias("from_cache"), U.canonical(feed).alias("from_feed"))


@query(f"WITH RECURSIVE {_CANONICAL} SELECT page_id, canonical, canonical AS again FROM c")
def url_variants(spark, sf):
    """Each URL in another dress (user, port, case, labels, dots, escapes, tracking, fragment), which all fold to the same form."""
    u = F.trim("url")
    rest = F.regexp_extract(u, "^https?://[^/?#]*([^?#]*)", 1)
    q = F.regexp_extract(u, r"^[^?#]*(\?[^#]*)", 1)
    dressed = F.concat(F.lit("HTTP://me:pw@AMP."), F.upper(F.regexp_extract(u, "^https?://([^/?#]*)", 1)), F.lit(".:443/./x/.."), F.replace(rest, F.lit("a"), F.lit("%61")), F.lit("/AMP/"), F.when(q == "", "?").otherwise(F.concat(q, F.lit("&"))), F.lit("UTM_x=1&GCLID=2&amp=TRUE#top"))
    return table(spark, sf, "pages").select("page_id", U.canonical(dressed).alias("canonical"), U.canonical(U.canonical(u)).alias("again"))


@query(f"""WITH h AS (SELECT id, domain, title, sha256({_COLLAPSED}) AS content_hash FROM a),
    k AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY id) AS by_key FROM h),
    f AS (SELECT *, CASE WHEN by_key = 1 THEN row_number() OVER (PARTITION BY by_key = 1, content_hash, domain ORDER BY id) END AS by_content FROM k)
    SELECT id, by_key > 1 AS url_duplicate, coalesce(by_content > 1, false) AS content_duplicate, by_key = 1 AND by_content = 1 AS kept FROM f""", articles=True)
def exact_dedup_two_key(spark, sf):
    """The first of each key stays; only rows that pass the first key claim the second one."""
    a = articles(spark, sf).select("id", "domain", "title", T.content_hash(F.col("body")).alias("content_hash"))
    first = a.groupBy("title").agg(F.min("id").alias("first_id"))
    passed = a.join(first, "title").select("*", (F.col("id") == F.col("first_id")).alias("new"))
    claims = passed.where("new").groupBy("content_hash", "domain").agg(F.min("id").alias("claimed_by"))
    out = passed.join(claims, ["content_hash", "domain"], "left")
    return out.select("id", (~F.col("new")).alias("url_duplicate"), (F.col("new") & (F.col("id") != F.col("claimed_by"))).alias("content_duplicate"), (F.col("new") & (F.col("id") == F.col("claimed_by"))).alias("kept"))


@query(f"""WITH h AS (SELECT id, domain, owner, tier, sha256({_COLLAPSED}) AS content_hash FROM a),
    o AS (SELECT content_hash, min(domain) AS wire FROM h WHERE tier = 1 GROUP BY content_hash)
    SELECT id, wire AS wire_origin, coalesce(wire <> domain, false) AS is_wire_copy FROM h LEFT JOIN o USING (content_hash)""", articles=True)
def wire_origin(spark, sf):
    a = articles(spark, sf).select("id", "domain", "tier", T.content_hash(F.col("body")).alias("content_hash"))
    wires = a.where("tier = 1").groupBy("content_hash").agg(F.min("domain").alias("wire_origin"))
    return a.join(wires, "content_hash", "left").select("id", "wire_origin", F.coalesce(F.col("wire_origin") != F.col("domain"), F.lit(False)).alias("is_wire_copy"))


@query(f"""WITH h AS (SELECT id, domain, owner, tier, sha256({_COLLAPSED}) AS content_hash FROM a),
    o AS (SELECT content_hash, min(domain) AS wire FROM h WHERE tier = 1 GROUP BY content_hash)
    SELECT content_hash, count(*) AS articles, count(DISTINCT owner) AS raw_owners, count(DISTINCT CASE WHEN wire IS NULL THEN owner ELSE wire END) AS effective_owners, count(*) FILTER (WHERE wire <> domain) AS collapsed FROM h LEFT JOIN o USING (content_hash) GROUP BY content_hash""", articles=True)
def wire_collapse_note(spark, sf):
    a = articles(spark, sf).select("domain", "owner", "tier", T.content_hash(F.col("body")).alias("content_hash"))
    wires = a.where("tier = 1").groupBy("content_hash").agg(F.min("domain").alias("wire"))
    j = a.join(wires, "content_hash", "left")
    return j.groupBy("content_hash").agg(F.count("*").alias("articles"), F.countDistinct("owner").alias("raw_owners"), F.countDistinct(F.coalesce("wire", "owner")).alias("effective_owners"), F.count_if(F.col("wire") != F.col("domain")).alias("collapsed"))


@query("SELECT domain, string_agg(owner || ':' || n, ',' ORDER BY owner) AS owners FROM (SELECT domain, owner, count(*) AS n FROM a GROUP BY domain, owner) GROUP BY domain", articles=True)
def owner_histogram(spark, sf):
    n = articles(spark, sf).groupBy("domain", "owner").agg(F.count("*").alias("n"))
    return n.groupBy("domain").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("owner", "n"))), lambda x: F.concat(x["owner"], F.lit(":"), x["n"].cast("string"))), ",").alias("owners"))


_TOPICS = {"Economy": ["the", "than"], "Health": ["heit", "ung"], "Technology": ["ción", "que"], "Geopolitics": ["eau", "ment"]}


@query("WITH t AS (" + " UNION ALL ".join("SELECT id, '{}' AS topic, {} AS hits FROM a".format(t, " + ".join(f"CAST(contains(lower(title), '{k}') AS INT)" for k in ks)) for t, ks in _TOPICS.items()) + """),
    m AS (SELECT id, topic, CAST(least(100, 10 + 15 * hits) AS INT) AS confidence FROM t WHERE hits > 0)
    SELECT * FROM m UNION ALL SELECT id, 'Geopolitics', 10 FROM a WHERE id NOT IN (SELECT id FROM m)""", articles=True)
def topic_assignment(spark, sf):
    """Keyword hits per topic in one pass over the row; without any, the fallback topic."""
    title = F.lower("title")
    scored = [F.struct(F.lit(t).alias("topic"), F.least(F.lit(100), 10 + 15 * sum((F.contains(title, F.lit(k)).cast("int") for k in ks), F.lit(0))).cast("int").alias("confidence")) for t, ks in _TOPICS.items()]
    hits = F.filter(F.array(*scored), lambda x: x["confidence"] > 10)
    none = F.array(F.struct(F.lit("Geopolitics").alias("topic"), F.lit(10).alias("confidence")))
    return articles(spark, sf).select("id", F.explode(F.when(F.size(hits) > 0, hits).otherwise(none)).alias("t")).select("id", "t.topic", "t.confidence")
