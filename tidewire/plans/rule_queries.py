"""Entities, extraction from texts and pages, revisions, families, geometry, search and evaluation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewire.functions import alignment as AL
from tidewire.functions import extract as X
from tidewire.functions import text as T
from tidewire.operators import assign as A
from tidewire.operators import entities as N
from tidewire.operators import geometry as G
from tidewire.plans.registry import query
from tidewire.sources.tables import articles, map_events, revisions, table

_HONORIFICS = "|".join(sorted(N.HONORIFICS, key=lambda x: -len(x)))
#: Mentions: the title's capitalised words in pairs, in several dresses.
_MENTIONS = r"""mw AS (SELECT id, unnest(list_distinct(regexp_extract_all(title, '[\p{L}]{4,}'))) AS w FROM a), mn AS (SELECT DISTINCT w, CASE length(w) % 3 WHEN 0 THEN 'PERSON' WHEN 1 THEN 'GPE' ELSE 'ORG' END AS kind FROM mw),
    ms AS (SELECT w, kind, CASE length(w) % 4 WHEN 0 THEN 'Mr. President ' || w WHEN 1 THEN 'The ' || w || '''s' WHEN 2 THEN w || ', ' || w ELSE ' ' || w || '  ' END AS surface FROM mn)"""


def mentions(spark, sf):
    w = articles(spark, sf).select(F.explode(F.array_distinct(F.regexp_extract_all("title", F.lit(r"\p{L}{4,}"), F.lit(0)))).alias("w")).distinct()
    n = F.length("w")
    dress = F.when(n % 4 == 0, F.concat(F.lit("Mr. President "), "w")).when(n % 4 == 1, F.concat(F.lit("The "), "w", F.lit("'s"))).when(n % 4 == 2, F.concat("w", F.lit(", "), "w")).otherwise(F.concat(F.lit(" "), "w", F.lit("  ")))
    return w.select("w", F.when(n % 3 == 0, "PERSON").when(n % 3 == 1, "GPE").otherwise("ORG").alias("kind"), dress.alias("surface"))


_NORMAL = rf"""nm AS (SELECT surface, kind, regexp_replace(regexp_replace(strip_accents(lower(trim(surface))), '^(?:(?:{_HONORIFICS})\.?\s+)+', ''), '[''’]s$', '') AS s FROM ms),
    nk AS (SELECT surface, kind, kind || ':' || trim(regexp_replace(regexp_replace(CASE WHEN kind IN ('GPE', 'ORG') THEN regexp_replace(s, '^the\s+', '') ELSE s END, '[^\p{{L}}\p{{N}}_\s-]', '', 'g'), '\s+', ' ', 'g')) AS key FROM nm)"""


@query(f"WITH {_MENTIONS}, {_NORMAL} SELECT surface, kind, key, sha256(key) AS entity_id FROM nk", articles=True)
def entity_keys(spark, sf):
    """The normal form of mentions, by which they are matched, and the id it mints."""
    return mentions(spark, sf).select("surface", "kind", N.normal(F.col("surface"), F.col("kind")).alias("key")).withColumn("entity_id", N.mint(F.col("key")))


@query("""WITH n AS (SELECT c_custkey AS k FROM customer), s AS (SELECT k, CASE k % 6 WHEN 0 THEN 'the US' WHEN 1 THEN 'Mr. Trump''s' WHEN 2 THEN 'London, London, City Of, United Kingdom' WHEN 3 THEN 'NATO' WHEN 4 THEN 'Dr.  Jane   Doe' ELSE 'Britain, Europe' END AS surface, CASE k % 6 WHEN 1 THEN 'PERSON' WHEN 3 THEN 'ORG' WHEN 4 THEN 'PERSON' ELSE 'GPE' END AS kind FROM n)
    SELECT k, surface, CASE k % 6 WHEN 0 THEN 'United States' WHEN 1 THEN 'Donald Trump' WHEN 2 THEN 'London' WHEN 3 THEN 'North Atlantic Treaty Organization' WHEN 4 THEN 'Jane Doe' ELSE 'United Kingdom' END AS display FROM s""")
def display_surfaces(spark, sf):
    """Names as they are shown: known spellings, places without what follows the comma, no titles or possessives."""
    k = F.col("c_custkey")
    s = table(spark, sf, "customer").select(
        k.alias("k"), F.when(k % 6 == 0, "the US").when(k % 6 == 1, "Mr. Trump's").when(k % 6 == 2, "London, London, City Of, United Kingdom").when(k % 6 == 3, "NATO").when(k % 6 == 4, "Dr.  Jane   Doe").otherwise("Britain, Europe").alias("surface"),
        F.when((k % 6).isin(1, 4), "PERSON").when(k % 6 == 3, "ORG").otherwise("GPE").alias("kind"))
    return N.display_surfaces(s).select("k", "surface", "display")


@query(f"WITH {_MENTIONS}, {_NORMAL}, u AS (SELECT split_part(key, ':', 2) AS name, kind, key FROM nk), f AS (SELECT CASE WHEN length(name) % 2 = 0 THEN 'anna ' || name ELSE 'bo ' || substring(name, 1, 4) END AS full_name, key FROM u WHERE kind = 'PERSON'), l AS (SELECT string_split(full_name, ' ')[-1] AS surname, count(DISTINCT key) AS n, min(key) AS key FROM f GROUP BY 1) SELECT surname, key FROM l WHERE n = 1", articles=True)
def surname_claims(spark, sf):
    """Surnames that one person alone has."""
    k = mentions(spark, sf).where("kind = 'PERSON'").select(N.normal(F.col("surface"), F.col("kind")).alias("entity_id")).distinct()
    name = F.split_part("entity_id", F.lit(":"), F.lit(2))
    full = k.select("entity_id", F.lit("PERSON").alias("kind"), F.when(F.length(name) % 2 == 0, F.concat(F.lit("anna "), name)).otherwise(F.concat(F.lit("bo "), F.substring(name, 1, 4))).alias("name"))
    return N.surname_index(full).select("surname", F.col("entity_id").alias("key"))


@query(r"""WITH t AS (SELECT id, body || ' "' || substring(body, 1, 60) || '" ''Jane Doe''' AS x FROM a), q AS (SELECT id, list_concat(list_concat(regexp_extract_all(x, '"([^"]{20,300})"', 1), regexp_extract_all(x, '''([^'']{20,300})''', 1)), regexp_extract_all(x, '[“”]([^“”]{20,300})[“”]', 1)) AS q FROM t),
    f AS (SELECT id, list_filter(list_transform(q, lambda s: trim(s)), lambda s: length(s) BETWEEN 20 AND 300 AND NOT regexp_full_match(s, '[A-Z][a-z]+ [A-Z][a-z]+')) AS q FROM q), e AS (SELECT id, unnest(q) AS s, unnest(range(len(q))) AS k FROM f), d AS (SELECT id, s, min(k) AS k FROM e GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY k) AS nth FROM d)
    SELECT id, string_agg(s, '|' ORDER BY k) AS quotes FROM r WHERE nth <= 5 GROUP BY id""", articles=True)
def key_quotes(spark, sf):
    """Quoted passages in the order of their first place, five at most; a bare name is none."""
    x = F.concat("body", F.lit(' "'), F.substring("body", 1, 60), F.lit("\" 'Jane Doe'"))
    return articles(spark, sf).select("id", x.alias("x")).select("id", X.quotes(F.col("x")).alias("q")).where("size(q) > 0").select("id", F.array_join("q", "|").alias("quotes"))


_STAT = "l_quantity::INTEGER || ' percent of sales fell by ' || l_linenumber || '.5% and more than ' || l_suppkey || ' million people, about ' || l_linenumber || ' thousand. Officials confirmed that the part ' || l_partkey || ' will be made in the same place again next year.'"


@query(f"""WITH t AS (SELECT l_orderkey AS story, l_linenumber AS line, l_partkey AS part, l_quantity::INTEGER AS q, l_suppkey AS s, {_STAT} AS x FROM lineitem)
    SELECT DISTINCT story, line, part, q || ' percent|fell by ' || line || '.5%|more than ' || s || ' million|about ' || line || ' thousand|' || q || ' percent of' AS stats, 'the part ' || part || ' will be made in the same place again next year|be made in the same place again next year' AS claims FROM t""")
def statistics_and_claims(spark, sf):
    """Figures as they are claimed, and what is said to be so."""
    s = lambda c: F.col(c).cast("string")
    x = F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(" percent of sales fell by "), s("l_linenumber"), F.lit(".5% and more than "), s("l_suppkey"), F.lit(" million people, about "), s("l_linenumber"), F.lit(" thousand. Officials confirmed that the part "), s("l_partkey"), F.lit(" will be made in the same place again next year."))
    t = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("story"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"), x.alias("x"))
    return t.select("story", "line", "part", F.array_join(X.figures(F.col("x")), "|").alias("stats"), F.array_join(X.claims(F.col("x")), "|").alias("claims")).distinct()


_ADDRESSES = [
    "https://www.youtube.com/watch?v=abc{p}", "https://youtu.be/xyz{p}", "https://vimeo.com/{n}", "https://x.com/someone/status/{n}", "https://bsky.app/profile/a.b/post/p{n}", "https://open.spotify.com/{n}", "https://example.com/{n}", "https://www.instagram.com/reel/{n}",
    "https://www.youtube.com/shorts/sho{p}", "https://www.tiktok.com/@some.one/video/{n}", "https://www.dailymotion.com/video/d{n}", "https://www.twitch.tv/videos/{n}", "https://www.facebook.com/someone/posts/{n}", "https://notes.example.org/watch?v={n}",
]
_URLS = f"u AS (SELECT event_id AS id, replace(replace(({_ADDRESSES!r})[event_id % {len(_ADDRESSES)} + 1], '{{n}}', CAST(event_id AS VARCHAR)), '{{p}}', lpad(CAST(event_id AS VARCHAR), 8, '0')) AS url FROM events)"


@query(rf"""WITH {_URLS}, h AS (SELECT id, url, regexp_extract(url, '^https://([^/]+)', 1) AS host FROM u)
    SELECT id, CASE WHEN contains(host, 'youtu') THEN 'youtube' WHEN contains(host, 'vimeo') THEN 'vimeo' WHEN host = 'x.com' THEN 'twitter' WHEN contains(host, 'instagram') THEN 'instagram' WHEN contains(host, 'tiktok') THEN 'tiktok' WHEN contains(host, 'bsky') THEN 'bluesky'
        WHEN contains(host, 'facebook') THEN 'facebook' WHEN contains(host, 'dailymotion') THEN 'dailymotion' WHEN contains(host, 'twitch') THEN 'twitch' WHEN contains(host, 'spotify') THEN 'spotify' ELSE 'embed' END AS platform,
    CASE WHEN contains(host, 'youtu') THEN 'https://www.youtube.com/embed/' || regexp_extract(url, '(?:v=|youtu\.be/|shorts/)([\w-]{{11}})', 1) WHEN host = 'vimeo.com' THEN 'https://player.vimeo.com/video/' || regexp_extract(url, '/(\d+)$', 1)
        WHEN host = 'x.com' THEN 'https://publish.twitter.com/oembed?url=https://twitter.com/user/status/' || regexp_extract(url, 'status/(\d+)', 1) WHEN host = 'bsky.app' THEN 'https://bsky.app/profile/user/post/' || regexp_extract(url, 'post/(\w+)', 1)
        WHEN host = 'www.instagram.com' THEN 'https://www.instagram.com/p/' || regexp_extract(url, 'reel/(.+)$', 1) || '/embed/' WHEN host = 'www.tiktok.com' AND regexp_matches(url, '@\w+/video') THEN 'https://www.tiktok.com/embed/' || regexp_extract(url, 'video/(\d+)', 1)
        WHEN host = 'www.dailymotion.com' THEN 'https://www.dailymotion.com/embed/video/' || regexp_extract(url, 'video/(\w+)', 1) WHEN host = 'www.twitch.tv' THEN 'https://clips.twitch.tv/embed?clip=' || regexp_extract(url, 'videos/(\d+)', 1)
        WHEN host = 'www.facebook.com' THEN 'https://www.facebook.com/plugins/post.php?href=https://www.facebook.com/user/posts/' || regexp_extract(url, 'posts/(\d+)', 1) END AS embed_url FROM h""")
def embeds(spark, sf):
    """Platforms of addresses, ids of videos and posts, and the addresses that embed them."""
    n = F.col("event_id")
    form = F.element_at(F.array(*[F.lit(a) for a in _ADDRESSES]), (n % len(_ADDRESSES) + 1).cast("int"))
    url = F.replace(F.replace(form, F.lit("{n}"), n.cast("string")), F.lit("{p}"), F.lpad(n.cast("string"), 8, "0"))
    u = table(spark, sf, "events").select(n.alias("id"), url.alias("url"))
    return u.select("id", X.platform(F.col("url")).alias("platform"), F.get(X.embeds(F.col("url")), F.lit(0))["url"].alias("embed_url"))


@query(r"""WITH m AS (SELECT page_id, unnest(regexp_extract_all(html, '<(?:img|iframe|video|audio|source|a)\b[^>]*?(?:src|href)="([^"]*)"', 1)) AS url FROM pages) SELECT page_id, count(*) AS named, count(DISTINCT url) AS distinct_urls, count(DISTINCT url) FILTER (WHERE regexp_matches(url, '(?i)\.(?:jpe?g|png|gif|webp)$')) AS images FROM m WHERE url <> '' GROUP BY page_id""")
def page_media(spark, sf):
    """Addresses that a page's tags name, each once."""
    m = table(spark, sf, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit(r'<(?:img|iframe|video|audio|source|a)\b[^>]*?(?:src|href)="([^"]*)"'), F.lit(1))).alias("url")).where("url <> ''")
    u = m.groupBy("page_id", "url").agg(F.count("*").alias("n"))
    return u.groupBy("page_id").agg(F.sum("n").alias("named"), F.count("*").alias("distinct_urls"), F.count_if(F.col("url").rlike(r"(?i)\.(?:jpe?g|png|gif|webp)$")).alias("images"))


def _noticed(spark, sf):
    """Turns with notices of several kinds around them."""
    k = (F.col("conv_id") + F.col("turn")) % 6
    lead = F.when(k == 0, "Correction: a name was wrong.\n\n").when(k == 1, "Updated: 2026-09-30T14:03:00Z\n\n").when(k == 2, "Last updated September 30, 2026 at 2:03 p.m.\n\n").otherwise("")
    tail = F.when(k == 3, "\n\none\n\ntwo\n\nthree\n\nEditor's note\n\nThe story has been updated since.").when(k == 4, "\n\none\n\ntwo\n\nthree\n\nIt was amended later.").otherwise("")
    return table(spark, sf, "conversations").select("conv_id", "turn", k.alias("k"), F.concat(lead, F.regexp_replace(F.coalesce("text", F.lit("x")), r"\s+", " "), tail).alias("content"))


@query("""WITH k AS (SELECT conv_id, turn, (conv_id + turn) % 6 AS k, trim(regexp_replace(coalesce(text, 'x'), '\\s+', ' ', 'g')) <> '' AS said FROM conversations), c AS (SELECT conv_id, turn, CASE k WHEN 0 THEN [{'l': 'correction', 'w': 'top'}] WHEN 1 THEN [{'l': 'updated', 'w': 'top'}] WHEN 2 THEN [{'l': 'updated', 'w': 'top'}]
        WHEN 3 THEN [{'l': 'story-updated', 'w': 'body'}] WHEN 4 THEN [{'l': 'amended', 'w': 'body'}] ELSE [] END AS s FROM k) SELECT conv_id, turn, unnest(s).l AS label, unnest(s).w AS location FROM c""".replace("\\\\s", "\\s"))
def correction_notices(spark, sf):
    """Notices of corrections: strong words anywhere, weak ones in the first paragraphs or in a block that announces them."""
    p = _noticed(spark, sf).withColumn("p", T.paragraphs(F.col("content")))
    return p.select("conv_id", "turn", F.explode(X.corrections(F.col("p"))).alias("s")).select("conv_id", "turn", "s.label", "s.location")


@query("SELECT conv_id, turn, CASE (conv_id + turn) % 6 WHEN 1 THEN epoch(TIMESTAMP '2026-09-30 14:03:00') WHEN 2 THEN epoch(TIMESTAMP '2026-09-30 14:03:00') END::BIGINT AS shown FROM conversations")
def displayed_timestamps(spark, sf):
    """When a text says that it was updated."""
    p = _noticed(spark, sf).withColumn("p", T.paragraphs(F.col("content")))
    return p.select("conv_id", "turn", F.unix_timestamp(X.displayed_timestamp(F.col("p"))).alias("shown"))


@query()
def paragraph_diff(spark, sf):
    """Each turn against the one before: paragraphs changed, added and removed, and an excerpt of the difference."""
    w = Window.partitionBy("article_id").orderBy("revision")
    r = revisions(spark, sf).withColumn("before", F.coalesce(F.lag("content").over(w), F.lit("")))
    return r.select("article_id", "revision", AL.paragraph_diff(T.paragraphs(F.col("before")), T.paragraphs(F.col("content"))).alias("d")).select("article_id", "revision", "d.*")


@query(r"""WITH t AS (SELECT event_id AS id, 'Rates stand at ' || (event_id % 50) || ' percent and ' || (event_id % 9) || '% here' AS a FROM events),
    x AS (SELECT id, a, CASE id % 6 WHEN 1 THEN 'Rates stand at ' || (id % 50 * 2) || ' percent and ' || (id % 9) || '% here' WHEN 2 THEN replace(a, '% here', ' here  ') WHEN 3 THEN 'Nothing of what was said about ' || (id % 50) || ' holds, nor about ' || (id % 9) || '% there' WHEN 4 THEN a || '.' WHEN 5 THEN 'No figure is known' ELSE a END AS b FROM t),
    f AS (SELECT id, a, b, regexp_extract_all(a, '\b\d+(?:\.\d+)?%?\b') AS p, regexp_extract_all(b, '\b\d+(?:\.\d+)?%?\b') AS q FROM x),
    z AS (SELECT id, a, b, len(p) = len(q) AND len(p) > 0 AND len(list_filter(list_zip(p, q), lambda v: suffix(v[1], '%') <> suffix(v[2], '%') OR CASE WHEN CAST(replace(v[1], '%', '') AS DOUBLE) = 0 THEN CAST(replace(v[2], '%', '') AS DOUBLE) <> 0 ELSE abs(CAST(replace(v[2], '%', '') AS DOUBLE) / CAST(replace(v[1], '%', '') AS DOUBLE) - 1) > 0.05 END)) > 0 AS numbers FROM f)
    SELECT id, numbers, CASE WHEN a = b THEN false WHEN numbers THEN true WHEN abs(length(a) - length(b)) < 0.05 * greatest(length(a), length(b)) THEN false ELSE levenshtein(a, b) > 0.1 * greatest(length(a), length(b)) END AS significant FROM z""")
def change_significance(spark, sf):
    """Whether a revision says something else: figures that moved by more than a twentieth, or other words."""
    n = F.col("event_id")
    s = lambda c: c.cast("string")
    line = lambda v: F.concat(F.lit("Rates stand at "), s(v), F.lit(" percent and "), s(n % 9), F.lit("% here"))
    a = line(n % 50)
    other = F.concat(F.lit("Nothing of what was said about "), s(n % 50), F.lit(" holds, nor about "), s(n % 9), F.lit("% there"))
    b = F.when(n % 6 == 1, line(n % 50 * 2)).when(n % 6 == 2, F.replace(a, F.lit("% here"), F.lit(" here  "))).when(n % 6 == 3, other).when(n % 6 == 4, F.concat(a, F.lit("."))).when(n % 6 == 5, "No figure is known").otherwise(a)
    t = table(spark, sf, "events").select(n.alias("id"), a.alias("a"), b.alias("b"))
    return t.select("id", X.numbers_changed(F.col("a"), F.col("b")).alias("numbers"), X.differs(F.col("a"), F.col("b")).alias("significant"))


_PHRASES = ["Police probe the case", "A summit on trade", "Quake, M 4.2 near the coast", "nothing at all", "Humanitarian groups", "The festival opens", "Warship seen", "He said so"]
_FAMILY_SQL = "CASE " + " ".join(f"WHEN contains(t, '{k}') THEN '{f}'" for f, keys in X.FAMILIES for k in keys) + f" WHEN regexp_matches(t, '{X.MAGNITUDE}') THEN 'ENVIRONMENT' ELSE 'UNMATCHED' END"
_KEYWORD_SQL = "CASE " + " ".join(f"WHEN contains(t, '{k}') THEN '{k}'" for _, keys in X.FAMILIES for k in keys) + f" WHEN regexp_matches(t, '{X.MAGNITUDE}') THEN 'magnitude_pattern' ELSE '' END"


@query(f"""WITH p AS (SELECT event_id AS id, ' ' || lower([{", ".join(f"'{x}'" for x in _PHRASES)}][event_id % {len(_PHRASES)} + 1] || ' ' || event_type) || ' ' AS t, CASE WHEN event_id % 11 = 0 THEN 'gdacs.org' ELSE 'example.com' END AS d FROM events)
    SELECT id, CASE WHEN d = 'gdacs.org' THEN 'ENVIRONMENT' ELSE {_FAMILY_SQL} END AS family, CASE WHEN d = 'gdacs.org' THEN 'sensor_domain' ELSE {_KEYWORD_SQL} END AS keyword FROM p""")
def family_classify(spark, sf):
    """The family of an event by its text: the first keyword of the most specific family."""
    n = F.col("event_id")
    phrase = F.element_at(F.array(*[F.lit(x) for x in _PHRASES]), (n % len(_PHRASES) + 1).cast("int"))
    p = table(spark, sf, "events").select(n.alias("id"), F.concat(phrase, F.lit(" "), "event_type").alias("t"), F.when(n % 11 == 0, "gdacs.org").otherwise("example.com").alias("d"))
    return p.select("id", X.family(F.col("t"), F.col("d")).alias("f")).select("id", "f.family", "f.keyword")


@query("""WITH names AS (SELECT n_nationkey AS code, lower(n_name) AS name FROM nation UNION ALL SELECT n_nationkey, 'republic of ' || lower(n_name) FROM nation), g AS (SELECT event_id AS id, CASE WHEN event_id % 5 = 0 THEN 'NATION_' || (user_id % 25) END AS geo, [' Nation_' || (event_id % 7) || '''s', 'the nowhere', 'NATION_' || (event_id % 25), 'Republic of Nation_' || (event_id % 7)] AS gpes FROM events),
    c AS (SELECT id, code, count(*) AS n, min(k) AS k FROM (SELECT id, unnest(gpes) AS x, unnest(range(len(gpes))) AS k FROM g) JOIN names ON name = regexp_replace(lower(trim(x)), '[''’]s$', '') GROUP BY ALL), m AS (SELECT id, arg_min(code, (-n, k)) AS code FROM c GROUP BY id)
    SELECT g.id, coalesce(x.code, m.code) AS country, CASE WHEN x.code IS NOT NULL THEN 'geo_name' WHEN m.code IS NOT NULL THEN 'gpe' ELSE 'none' END AS method FROM g LEFT JOIN names x ON x.name = lower(geo) LEFT JOIN m ON m.id = g.id""")
def country_attribute(spark, sf):
    """The country of an article: its place if it has one, else the country that most of its names mean, the first named of equals."""
    nation = table(spark, sf, "nation")
    names = nation.select(F.col("n_nationkey").alias("code"), F.explode(F.array(F.lower("n_name"), F.concat(F.lit("republic of "), F.lower("n_name")))).alias("name"))
    s = lambda c: c.cast("string")
    n = F.col("event_id")
    gpes = F.array(F.concat(F.lit(" Nation_"), s(n % 7), F.lit("'s")), F.lit("the nowhere"), F.concat(F.lit("NATION_"), s(n % 25)), F.concat(F.lit("Republic of Nation_"), s(n % 7)))
    g = table(spark, sf, "events").select(n.alias("id"), F.when(n % 5 == 0, F.concat(F.lit("nation_"), s(F.col("user_id") % 25))).alias("name"), gpes.alias("gpes"))
    each = g.select("id", F.posexplode("gpes").alias("k", "x")).select("id", "k", F.regexp_replace(F.lower(F.trim("x")), "['’]s$", "").alias("name")).join(names, "name")
    m = each.groupBy("id", "code").agg(F.count("*").alias("n"), F.min("k").alias("k")).groupBy("id").agg(F.min_by("code", F.struct(-F.col("n"), "k")).alias("by_name"))
    j = g.join(names.withColumnRenamed("code", "by_geo"), "name", "left").join(m, "id", "left")
    return j.select("id", F.coalesce("by_geo", "by_name").alias("country"), F.when(F.col("by_geo").isNotNull(), "geo_name").when(F.col("by_name").isNotNull(), "gpe").otherwise("none").alias("method"))


# Roots of event codes and their families.
ROOTS = {
    "01": "VERBAL", "02": "VERBAL", "03": "COOPERATION", "04": "COOPERATION", "05": "COOPERATION", "06": "COOPERATION", "07": "AID", "08": "COOPERATION", "09": "INVESTIGATE", "10": "DISAPPROVE", "11": "DISAPPROVE",
    "12": "DISAPPROVE", "13": "THREAT", "14": "PROTEST", "15": "COERCION", "16": "COERCION", "17": "COERCION", "18": "VIOLENCE", "19": "ARMED_CONFLICT", "20": "MASS_VIOLENCE",
}


@query("WITH c AS (SELECT lpad(CAST(event_id % 22 AS VARCHAR), 2, '0') || '1' AS code, value FROM events) SELECT coalesce(family, 'UNKNOWN') AS family, count(*) AS n, round(sum(value), 4) AS attention FROM c LEFT JOIN (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in ROOTS.items()) + ") r(root, family) ON root = substring(code, 1, 2) GROUP BY 1")
def code_families(spark, sf):
    """Families of event codes by their first two digits."""
    root = F.lpad((F.col("event_id") % 22).cast("string"), 2, "0")
    names = F.create_map(*[F.lit(x) for kv in ROOTS.items() for x in kv])
    return table(spark, sf, "events").groupBy(F.coalesce(F.try_element_at(names, root), F.lit("UNKNOWN")).alias("family")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("attention"))


@query("""WITH e AS (SELECT event_id AS id, CAST(user_id % 100 AS DOUBLE) AS x, CAST(event_id % 80 AS DOUBLE) AS y FROM events)
    SELECT id, CASE id % 5 WHEN 0 THEN y WHEN 1 THEN y + 1 WHEN 2 THEN round((y + y + y + 3 + y) / 4, 6) WHEN 3 THEN y ELSE NULL END AS lat, CASE id % 5 WHEN 0 THEN x WHEN 1 THEN x + 1 WHEN 2 THEN round((x + x + 3 + x + x) / 4, 6) WHEN 3 THEN x ELSE NULL END AS lon FROM e""")
def geometry_points(spark, sf):
    """A point for each geometry: its own, a line's middle, the mean of an outer ring with its closing vertex, the first of several."""
    n, x, y = F.col("event_id"), (F.col("user_id") % 100).cast("int"), (F.col("event_id") % 80).cast("int")
    at = lambda a, b: F.concat(F.lit("["), a.cast("string"), F.lit(","), b.cast("string"), F.lit("]"))
    shape = lambda kind, c: F.concat(F.lit(f'{{"type":"{kind}","coordinates":'), c, F.lit("}"))
    line = F.concat(F.lit("["), at(x, y), F.lit(","), at(x + 1, y + 1), F.lit(","), at(x + 2, y + 5), F.lit("]"))
    ring = F.concat(F.lit("[["), at(x, y), F.lit(","), at(x + 3, y), F.lit(","), at(x, y + 3), F.lit(","), at(x, y), F.lit("]]"))
    several = F.concat(F.lit("["), at(x, y), F.lit(","), at(x + 9, y + 9), F.lit("]"))
    g = F.when(n % 5 == 0, shape("Point", at(x, y))).when(n % 5 == 1, shape("LineString", line)).when(n % 5 == 2, shape("Polygon", ring)).when(n % 5 == 3, shape("MultiPoint", several)).otherwise(shape("Point", at(x + 500, y)))
    p = table(spark, sf, "events").select(n.alias("id"), G.representative_point(g).alias("p"))
    return p.select("id", F.round("p.lat", 6).alias("lat"), F.round("p.lon", 6).alias("lon"))


@query("""WITH v AS (SELECT event_id AS id, greatest(-180.0, least(180.0, (user_id * 53) % 400 - 200.0)) AS w, greatest(-180.0, least(180.0, (event_id * 17) % 400 - 200.0)) AS e FROM events)
    SELECT id, 1 AS part, w AS west, CASE WHEN e < w THEN 180.0 ELSE e END AS east FROM v UNION ALL SELECT id, 2, -180.0, e FROM v WHERE e < w""")
def viewport_boxes(spark, sf):
    """A viewport as one box, or as two where it lies over the antimeridian."""
    v = table(spark, sf, "events").select(F.col("event_id").alias("id"), ((F.col("user_id") * 53) % 400 - 200).cast("double").alias("w"), ((F.col("event_id") * 17) % 400 - 200).cast("double").alias("e"))
    return v.select("id", F.posexplode(G.boxes(F.col("w"), F.col("e"))).alias("k", "b")).select("id", (F.col("k") + 1).alias("part"), "b.west", "b.east")


_MARKERS = """m AS (SELECT event_id AS id, epoch_us(ts) AS t, event_type, (user_id * 37) % 180 - 90 + value / 1000 AS lat, CAST((user_id * 53) % 360 - 180 AS DOUBLE) AS lon, least(1.0, value / 100) AS confidence FROM events),
    d AS (SELECT *, row_number() OVER (PARTITION BY floor(lat * 1000 + 0.5), floor(lon * 1000 + 0.5), event_type ORDER BY id) AS nth FROM m)"""


@query(f"WITH {_MARKERS} SELECT id, t, event_type, row_number() OVER (PARTITION BY event_type ORDER BY t, id) AS of_type FROM d WHERE nth = 1")
def timeline(spark, sf):
    """Markers in order of time: the first of each place and type, and its number within its type."""
    e = map_events(spark, sf)
    first = Window.partitionBy(F.floor(F.col("lat") * 1000 + 0.5), F.floor(F.col("lon") * 1000 + 0.5), "event_type").orderBy("id")
    d = e.select("id", F.col("start").alias("t"), "event_type", F.row_number().over(first).alias("nth")).where("nth = 1")
    return d.select("id", "t", "event_type", F.row_number().over(Window.partitionBy("event_type").orderBy("t", "id")).alias("of_type"))


@query("WITH c AS (SELECT o_orderkey AS q, epoch(TIMESTAMP '2024-01-01') + o_orderkey % 2600000 AS t FROM orders) SELECT q, (SELECT count(*) FROM events WHERE epoch(ts) <= t) AS shown FROM c")
def as_of_counts(spark, sf):
    """How many events there are up to each cursor: counts of an hour, added up, and the cursor's own hour compared."""
    e = table(spark, sf, "events").select(F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    c = table(spark, sf, "orders").select(F.col("o_orderkey").alias("q"), ((F.lit(1_704_067_200) + F.col("o_orderkey") % 2600000) * 1_000_000).alias("at"))
    return G.as_of_counts(e, "t", c, "q", "at", 3_600_000_000)


@query(f"""WITH {_MARKERS}, s AS (SELECT id, event_type, confidence, (SELECT max(t) FROM m) - t AS age FROM m), f AS (SELECT *, age <= 43200000000 AS fresh, age <= 259200000000 AS recent FROM s), p AS (SELECT *, row_number() OVER (PARTITION BY fresh AND confidence >= 0.6 ORDER BY id) <= 48 AND fresh AND confidence >= 0.6 AS pulse FROM f)
    SELECT id, CAST(4 + floor(confidence * 4 + 0.5) AS INTEGER) AS radius, fresh, recent, pulse FROM p""")
def marker_styles(spark, sf):
    """Size by confidence, freshness by age, and a pulse for the first of the fresh and sure ones."""
    e = map_events(spark, sf).select("id", F.least(F.lit(1.0), F.col("value") / 100).alias("confidence"), F.col("start").alias("t"))
    newest = e.agg(F.max("t").alias("newest"))
    f = e.crossJoin(F.broadcast(newest)).withColumn("age", F.col("newest") - F.col("t"))  # one row
    f = f.select("id", "confidence", (F.col("age") <= 43_200_000_000).alias("fresh"), (F.col("age") <= 259_200_000_000).alias("recent"))
    pulse = f.where("fresh AND confidence >= 0.6").orderBy("id").limit(48).select("id", F.lit(True).alias("pulse"))
    return f.join(F.broadcast(pulse), "id", "left").select("id", (4 + F.floor(F.col("confidence") * 4 + 0.5)).cast("int").alias("radius"), "fresh", "recent", F.coalesce("pulse", F.lit(False)).alias("pulse"))


@query("""SELECT event_id AS id, '{"type":"Feature","id":"' || event_id || '","geometry":{"type":"Point","coordinates":[' || CAST((user_id * 53) % 360 - 180 AS BIGINT) || ',' || CAST((user_id * 37) % 180 - 90 AS BIGINT) || ']},"properties":{"event_type":"' || event_type || '","radius_km":' || CASE WHEN event_id % 3 = 0 THEN '25' ELSE 'null' END || ',"story_id":"' || user_id || '"}}' AS feature FROM events""")
def geojson_features(spark, sf):
    """Events as features: a point, and their properties with those of the geometry over them."""
    u = F.col("user_id")
    properties = F.struct("event_type", F.when(F.col("event_id") % 3 == 0, 25).alias("radius_km"), u.cast("string").alias("story_id"))
    geometry = F.struct(F.lit("Point").alias("type"), F.array((u * 53) % 360 - 180, (u * 37) % 180 - 90).alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), F.col("event_id").cast("string").alias("id"), geometry.alias("geometry"), properties.alias("properties"))
    return table(spark, sf, "events").select(F.col("event_id").alias("id"), F.to_json(feature, {"ignoreNullFields": "false"}).alias("feature"))


@query()
def story_search_trigram(spark, sf):
    """Stories by how near a query comes to some run of their headline's words: most shared trigrams of any extent; or that hold it."""
    return A.word_similarity(articles(spark, sf).select("id", F.concat_ws("-", "lang", "domain").alias("story"), "title"), "heit und", 50)


@query("WITH n AS (SELECT id, len(list_filter(regexp_split_to_array(lower(body), '[^\\p{L}\\p{N}_]+'), lambda t: length(t) > 1)) AS words FROM a) SELECT id, words > 0 AS has_words FROM n".replace("\\\\", "\\"), articles=True)
def scored_words(spark, sf):
    """Whether anything is left of a text in the form in which answers are scored (stop words are passed over)."""
    t = articles(spark, sf).select("id", X.scored_form(F.col("body")).alias("s"))
    return t.select("id", (F.size(F.filter(F.regexp_extract_all("s", F.lit(r"(?U)\w+"), F.lit(0)), lambda w: F.length(w) > 1)) > 0).alias("has_words"))


@query("SELECT id, 1.0::DOUBLE AS same, CASE WHEN regexp_matches(title, '[\\p{L}]') THEN 0.0 ELSE 1.0 END::DOUBLE AS other FROM a".replace("\\\\", "\\"), articles=True)
def script_overlaps(spark, sf):
    """The share of a title's letters whose script its body has, and a Cyrillic answer."""
    return articles(spark, sf).select("id", F.when(F.length("body") > 0, X.script_overlap(F.col("title"), F.col("body"))).otherwise(1.0).alias("same"), X.script_overlap(F.col("title"), F.lit("ответ")).alias("other"))


@query()
def snippet_matches(spark, sf):
    """A turn's sentences matched one to one with an answer that has them in reverse and without their first word."""
    gold = F.split("content", r"(?<=[.!?])\s+")
    pred = F.reverse(F.transform(gold, lambda x: F.regexp_replace(x, r"^\S+\s+", "")))
    return A.match_snippets(revisions(spark, sf).select(F.concat_ws("-", "article_id", "revision").alias("article"), gold.alias("gold"), pred.alias("pred")))


@query()
def snippet_dedup(spark, sf):
    """Sentences of an article that share five words in a row with none kept before, in order of confidence."""
    s = articles(spark, sf).select("id", F.posexplode(F.split("body", r"(?<=[.!?])\s+")).alias("k", "snippet")).where("length(snippet) >= 20")
    return A.distinct_snippets(s.withColumn("confidence", F.length("snippet") % 101))


@query("WITH r AS (SELECT l_orderkey AS story, l_linenumber AS line, l_suppkey AS source, l_partkey AS part, CAST(l_quantity AS INTEGER) AS confidence FROM lineitem), n AS (SELECT *, row_number() OVER (PARTITION BY story ORDER BY confidence DESC, line, part, source) AS nth, 1 + source % 4 AS tier FROM r) SELECT story, string_agg(tier || ':' || source || ':' || part, ',' ORDER BY tier, source, part) AS evidence, count(*) AS shown FROM n WHERE nth <= 3 GROUP BY story")
def story_evidence(spark, sf):
    """The three surest pieces of evidence of each story, ordered by tier, source and part."""
    n = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("story"), F.col("l_linenumber").alias("line"), F.col("l_suppkey").alias("source"), F.col("l_partkey").alias("part"), F.col("l_quantity").cast("int").alias("confidence"))
    top = n.withColumn("nth", F.row_number().over(Window.partitionBy("story").orderBy(F.desc("confidence"), "line", "part", "source"))).where("nth <= 3")
    e = F.array_sort(F.collect_list(F.struct((1 + F.col("source") % 4).alias("tier"), "source", "part")))
    return top.groupBy("story").agg(F.array_join(F.transform(e, lambda x: F.concat_ws(":", x["tier"].cast("string"), x["source"].cast("string"), x["part"].cast("string"))), ",").alias("evidence"), F.count("*").alias("shown"))
