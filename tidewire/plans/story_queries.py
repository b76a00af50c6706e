"""What reads show of a story: badges, sentences, headlines, captions; and the filters that choose stories."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewire.functions import phrases as P
from tidewire.plans.registry import query
from tidewire.sources.tables import EPOCH, articles, map_events, table

#: Stories of the projection: articles of one id mod 97; every third article is not tallied yet.
_ST = """st AS (SELECT id % 97 AS story, count(*) AS n, count(*) FILTER (WHERE tier = 1 AND id % 3 <> 0) AS t1, count(*) FILTER (WHERE tier = 2 AND id % 3 <> 0) AS t2, count(*) FILTER (WHERE tier = 3 AND id % 3 <> 0) AS t3,
        count(*) FILTER (WHERE tier = 4 AND id % 3 <> 0) AS t4, count(DISTINCT owner) FILTER (WHERE tier = 1 AND id % 3 <> 0) AS owners, max(fetched) AS latest FROM a GROUP BY 1)"""
_TIERS = ["t1", "t2", "t3", "t4"]


def stories(spark, sf):
    told = F.col("id") % 3 != 0
    return articles(spark, sf).groupBy((F.col("id") % 97).alias("story")).agg(
        F.count("*").alias("n"), *[F.count_if((F.col("tier") == k + 1) & told).alias(t) for k, t in enumerate(_TIERS)],
        F.countDistinct(F.when((F.col("tier") == 1) & told, F.col("owner"))).alias("owners"), F.max("fetched").alias("latest"))


def _tiers():
    return [F.col(t) for t in _TIERS]


@query(f"""WITH {_ST} SELECT story, owners AS outlets, CASE WHEN t1 > 0 THEN 1 WHEN t2 > 0 THEN 2 WHEN t3 > 0 THEN 3 WHEN t4 > 0 THEN 4 END AS best_tier, t1 >= 2 AND owners >= 2 AS corroborated,
    CASE WHEN t1 >= 2 AND owners >= 2 THEN 'Corroborated · ' || owners || ' outlets' WHEN owners >= 2 THEN owners || ' outlets · needs tier-1 confirmation' WHEN owners = 1 THEN 'Single outlet · unconfirmed' ELSE 'No outlets yet' END AS label FROM st""", articles=True)
def verification_badge(spark, sf):
    t1, owners = F.col("t1"), F.col("owners")
    return stories(spark, sf).select("story", owners.alias("outlets"), P.best_tier(_tiers()).alias("best_tier"), P.corroborated(t1, owners).alias("corroborated"), P.badge_label(t1, owners).alias("label"))


@query(f"""WITH {_ST}, c AS (SELECT story, unnest([1, 2, 3, 4]) AS tier, unnest([t1, t2, t3, t4]) AS count FROM st) SELECT story, tier, count, CASE WHEN count = 1 THEN 'outlet' ELSE 'outlets' END AS noun FROM c WHERE count > 0""", articles=True)
def tier_chips(spark, sf):
    chips = F.array(*[F.struct(F.lit(k + 1).alias("tier"), F.col(t).alias("count")) for k, t in enumerate(_TIERS)])
    return stories(spark, sf).select("story", F.inline(F.filter(chips, lambda c: c["count"] > 0))).select("story", "tier", "count", F.when(F.col("count") == 1, "outlet").otherwise("outlets").alias("noun"))


@query(f"WITH {_ST} SELECT story, n > 0 AND owners = 0 AND t1 + t2 + t3 + t4 = 0 AS pending FROM st", articles=True)
def counts_pending(spark, sf):
    return stories(spark, sf).select("story", P.counts_pending(_tiers(), F.col("owners"), F.col("n")).alias("pending"))


def _part(k: int) -> str:
    return f"CASE WHEN t{k} > 0 THEN t{k} || ' tier-{k} ' || CASE WHEN t{k} = 1 THEN 'outlet' ELSE 'outlets' END || ' ({P.TIER_MEANING[k]})' END"


@query(f"""WITH {_ST}, p AS (SELECT story, n, list_filter([{", ".join(_part(k) for k in (1, 2, 3, 4))}], lambda x: x IS NOT NULL) AS ps FROM st)
    SELECT story, CASE WHEN len(ps) = 0 AND n = 1 THEN 'The pipeline has not tallied this story''s tiers yet, so the source listed below carries its own tier.'
        WHEN len(ps) = 0 THEN 'The pipeline has not tallied this story''s tiers yet, so each of the ' || n || ' sources listed below carries its own tier.' WHEN len(ps) = 1 THEN ps[1] || '.' ELSE array_to_string(ps[:-2], ', ') || ' and ' || ps[-1] || '.' END AS sentence FROM p""", articles=True)
def tier_sentence(spark, sf):
    return stories(spark, sf).select("story", P.tier_sentence(_tiers(), F.col("n")).alias("sentence"))


@query(f"""WITH {_ST} SELECT story, CASE WHEN t1 >= 2 AND owners >= 2 THEN 'Corroborated by ' || owners || ' outlets, ' || t1 || ' of them tier-1.'
    WHEN owners = 0 THEN 'Not tallied yet: ' || CASE WHEN n = 1 THEN '1 source' ELSE n || ' sources' END || ' listed, and the pipeline has not counted this story''s outlets, so there is no corroboration verdict to give yet.'
    WHEN owners = 1 THEN 'Not corroborated: a single outlet carried this story, with no independent confirmation.'
    ELSE 'Not corroborated: ' || owners || ' outlets carried this story but not two or more tier-1 outlets, so it still needs tier-1 confirmation.' END AS sentence FROM st""", articles=True)
def corroboration_sentence(spark, sf):
    return stories(spark, sf).select("story", P.corroboration_sentence(F.col("t1"), F.col("owners"), F.col("n")).alias("sentence"))


#: Articles with a publication time that every fifth lacks, a translated title of every fourth, blank titles of every seventh.
_RA = r"""ra AS (SELECT id % 97 AS story, id, domain, tier, body, CASE WHEN id % 5 = 0 THEN NULL ELSE fetched END AS published, CASE WHEN id % 7 = 0 THEN ' ' ELSE title END AS title, CASE WHEN id % 4 = 0 THEN 'en: ' || domain END AS title_en FROM a)"""


def representatives(spark, sf):
    n = F.col("id")
    return articles(spark, sf).select((n % 97).alias("story"), "id", "domain", "tier", "body", F.when(n % 5 != 0, F.col("fetched")).alias("published"), F.when(n % 7 == 0, " ").otherwise(F.col("title")).alias("title"), F.when(n % 4 == 0, F.concat(F.lit("en: "), "domain")).alias("title_en"))


@query(f"WITH {_RA} SELECT story, id, row_number() OVER (PARTITION BY story ORDER BY published NULLS LAST, id) AS place, tier AS tier_num, domain FROM ra", articles=True)
def representative_articles(spark, sf):
    """Sources of a story, oldest first, undated ones last."""
    w = Window.partitionBy("story").orderBy(F.col("published").asc_nulls_last(), "id")
    return representatives(spark, sf).select("story", "id", F.row_number().over(w).alias("place"), F.col("tier").alias("tier_num"), "domain")


@query(rf"""WITH {_RA}, t AS (SELECT *, trim(regexp_replace(title, '[\s\p{{Z}}]+', ' ', 'g')) AS o, coalesce(title_en, '') AS e FROM ra), k AS (SELECT *, CASE WHEN e <> '' THEN e ELSE o END AS h FROM t),
    b AS (SELECT story, arg_min(h, (published IS NULL, published, id)) FILTER (WHERE h <> '') AS headline, arg_min(domain, (published IS NULL, published, id)) FILTER (WHERE h <> '') AS source_domain, bool_or(false) AS x,
        arg_min(e <> '' AND e <> o, (published IS NULL, published, id)) FILTER (WHERE h <> '') AS translated FROM k GROUP BY story)
    SELECT story, coalesce(headline, 'No headline captured') AS headline, source_domain, coalesce(translated, false) AS translated FROM b""", articles=True)
def story_headline(spark, sf):
    """The first source with a title, translated if it is, oldest first: one minimum for each story."""
    o, e = F.trim(F.regexp_replace("title", r"[\s\p{Z}]+", " ")), F.coalesce("title_en", F.lit(""))
    k = representatives(spark, sf).withColumns({"o": o, "e": e}).withColumn("h", F.when(F.col("e") != "", F.col("e")).otherwise(F.col("o")))
    first = F.min(F.when(F.col("h") != "", F.struct(F.col("published").isNull().alias("undated"), "published", "id", "h", "domain", ((F.col("e") != "") & (F.col("e") != F.col("o"))).alias("translated"))))
    return k.groupBy("story").agg(first.alias("x")).select("story", F.coalesce("x.h", F.lit(P.NO_HEADLINE)).alias("headline"), F.col("x.domain").alias("source_domain"), F.coalesce("x.translated", F.lit(False)).alias("translated"))


@query(rf"""WITH {_RA}, t AS (SELECT *, trim(regexp_replace(body, '[\s\p{{Z}}]+', ' ', 'g')) AS c FROM ra), b AS (SELECT story, arg_min(c, (published IS NULL, published, id)) AS c, arg_min(domain, (published IS NULL, published, id)) AS domain FROM t WHERE c <> '' GROUP BY story)
    SELECT story, sha256(substring(c, 1, 600)) AS summary_hash, length(c) > 600 AS truncated, domain FROM b""", articles=True)
def story_summary(spark, sf):
    """The opening of the first source that says anything: the source is chosen before its text is joined."""
    c = F.trim(F.regexp_replace("body", r"[\s\p{Z}]+", " "))
    t = representatives(spark, sf).select("story", "published", "id", "domain", c.alias("c")).where("c <> ''")
    first = t.groupBy("story").agg(F.min(F.struct(F.col("published").isNull().alias("undated"), "published", "id", "domain", F.substring("c", 1, P.SUMMARY_CHARS + 1).alias("c"))).alias("x"))
    return first.select("story", F.sha2(F.substring("x.c", 1, P.SUMMARY_CHARS).cast("binary"), 256).alias("summary_hash"), (F.length("x.c") > P.SUMMARY_CHARS).alias("truncated"), "x.domain")


@query(f"""WITH {_ST}, e AS (SELECT user_id % 97 AS story, count(*) AS event_count, max(epoch_us(ts)) AS latest_event FROM events GROUP BY 1)
    SELECT story, owners AS outlets, t1 AS tier1, coalesce(event_count, 0) AS event_count, latest_event FROM st LEFT JOIN e USING (story)""", articles=True)
def public_story_summary(spark, sf):
    """A story's counters beside its events: both sides are aggregated before they are joined."""
    e = map_events(spark, sf).groupBy((F.col("story_id") % 97).alias("story")).agg(F.count("*").alias("event_count"), F.max("start").alias("latest_event"))
    return stories(spark, sf).join(e, "story", "left").select("story", F.col("owners").alias("outlets"), F.col("t1").alias("tier1"), F.coalesce("event_count", F.lit(0)).alias("event_count"), "latest_event")


_AGES = "g AS (SELECT event_id AS id, CASE WHEN event_id % 50 = 0 THEN NULL ELSE (event_id % 40) * (event_id % 40) * (event_id % 40) * 97 - 30 END AS s FROM events)"


def _ages(spark, sf):
    k = F.col("event_id") % 40
    return table(spark, sf, "events").select(F.col("event_id").alias("id"), F.when(F.col("event_id") % 50 != 0, k * k * k * 97 - 30).alias("s"))


@query(f"""WITH {_AGES}, m AS (SELECT id, s, CAST(floor(greatest(s, 0) / 60.0) AS BIGINT) AS m FROM g), d AS (SELECT id, s, m, m // 60 AS h, m // 1440 AS d FROM m)
    SELECT id, CASE WHEN s IS NULL THEN '' WHEN m < 2 THEN 'just now' WHEN m < 60 THEN m || ' min ago' WHEN h < 24 THEN h || CASE WHEN h = 1 THEN ' hour ago' ELSE ' hours ago' END ELSE d || CASE WHEN d = 1 THEN ' day ago' ELSE ' days ago' END END AS age,
        CASE WHEN s IS NULL THEN 'timestamp not recorded' WHEN s < 90 THEN 'just now' WHEN s < 3600 THEN greatest(s // 60, 1) || CASE WHEN greatest(s // 60, 1) = 1 THEN ' minute ago' ELSE ' minutes ago' END
            WHEN s < 86400 THEN (s // 3600) || CASE WHEN s // 3600 = 1 THEN ' hour ago' ELSE ' hours ago' END WHEN s < 604800 THEN (s // 86400) || CASE WHEN s // 86400 = 1 THEN ' day ago' ELSE ' days ago' END
            WHEN s < 3024000 THEN (s // 604800) || CASE WHEN s // 604800 = 1 THEN ' week ago' ELSE ' weeks ago' END ELSE (s // 2592000) || ' months ago' END AS freshness FROM d""")
def relative_ages(spark, sf):
    return _ages(spark, sf).select("id", P.ago(F.col("s")).alias("age"), P.freshness(F.col("s")).alias("freshness"))


@query(f"""WITH {_AGES}, v AS (SELECT id, s, id % 3 AS outlets, id % 4 AS ev FROM g WHERE s IS NULL OR s < 120)
    SELECT id, CASE WHEN s IS NULL THEN 'No events recorded yet' WHEN ev > 0 OR outlets = 0 THEN 'Updated just now, ' || outlets || CASE WHEN outlets = 1 THEN ' outlet, ' ELSE ' outlets, ' END || ev || CASE WHEN ev = 1 THEN ' corroborated event (24h)' ELSE ' corroborated events (24h)' END
        ELSE 'No corroborated events (24h), ' || outlets || CASE WHEN outlets = 1 THEN ' outlet, last event just now' ELSE ' outlets, last event just now' END END AS stamp FROM v""")
def freshness_line(spark, sf):
    return _ages(spark, sf).where("s IS NULL OR s < 120").select("id", P.freshness_stamp(F.col("s"), F.col("id") % 3, F.col("id") % 4).alias("stamp"))


@query("""WITH p AS (SELECT event_id AS id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 20000 - 100 END AS hours, CASE WHEN event_id % 3 = 0 THEN epoch(ts) END AS lo, CASE WHEN event_id % 6 = 0 THEN epoch(ts) + value * 3600 END AS hi, event_id % 5 - 2 AS least FROM events)
    SELECT id, CASE WHEN lo IS NOT NULL OR hi IS NOT NULL THEN CASE WHEN lo IS NULL OR hi IS NULL THEN NULL ELSE CAST(floor(greatest(0.0, hi - lo) / 3600) AS BIGINT) END WHEN hours IS NULL OR hours <= 0 THEN NULL ELSE least(hours, 8760) END AS window_hours,
        CASE WHEN hours IS NULL OR hours <= 0 THEN NULL ELSE least(hours, 8760) * 3600 END AS back_seconds, CASE WHEN id % 7 = 0 THEN 2 ELSE greatest(0, least) END AS min_tier1 FROM p""")
def request_windows(spark, sf):
    """The window and threshold that a request means: an explicit pair wins, nothing or less than nothing is unbounded, and a year is the most."""
    n = F.col("event_id")
    ts = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    p = table(spark, sf, "events").select(n.alias("id"), F.when(n % 11 != 0, n % 20000 - 100).alias("hours"), F.when(n % 3 == 0, ts).alias("lo"), F.when(n % 6 == 0, ts + F.col("value") * 3600).alias("hi"), (n % 5 - 2).alias("least"))
    resolved = F.when(F.col("hours") > 0, F.least("hours", F.lit(8760)))
    pair = F.floor(F.greatest(F.lit(0.0), F.col("hi") - F.col("lo")) / 3600)
    return p.select("id", F.when(F.col("lo").isNotNull() | F.col("hi").isNotNull(), F.when(F.col("lo").isNotNull() & F.col("hi").isNotNull(), pair)).otherwise(resolved).alias("window_hours"), (resolved * 3600).alias("back_seconds"), F.when(F.col("id") % 7 == 0, 2).otherwise(F.greatest(F.lit(0), F.col("least"))).alias("min_tier1"))


@query(f"""WITH {_ST}, w AS (SELECT story, t1, t2, t3, t4, CASE story % 4 WHEN 0 THEN '1,2' WHEN 1 THEN ' 3 , 9' WHEN 2 THEN '' ELSE '1,2,3,4' END AS tiers FROM st)
    SELECT story, tiers FROM w WHERE story % 4 IN (2, 3) OR (story % 4 = 0 AND (t1 > 0 OR t2 > 0)) OR (story % 4 = 1 AND t3 > 0)""", articles=True)
def tier_inclusion(spark, sf):
    """Stories with a source in one of the tiers that a request lists; nothing listed, or all, is no filter."""
    n = F.col("story") % 4
    w = stories(spark, sf).withColumn("tiers", F.when(n == 0, "1,2").when(n == 1, " 3 , 9").when(n == 2, "").otherwise("1,2,3,4"))
    wanted = F.array_distinct(F.filter(F.transform(F.split("tiers", ","), lambda x: F.trim(x).try_cast("int")), lambda x: x.between(1, 4)))
    held = F.array(*[F.when(F.col(t) > 0, k + 1) for k, t in enumerate(_TIERS)])
    return w.where((F.size(wanted) == 0) | (F.size(wanted) == 4) | F.arrays_overlap(wanted, F.array_compact(held))).select("story", "tiers")


_EV = "ev AS (SELECT event_id AS id, user_id % 97 AS story, event_type FROM events)"


@query(f"WITH {_ST}, {_EV} SELECT ev.id, ev.story FROM ev JOIN st USING (story) WHERE t1 > 0 OR t2 > 0", articles=True)
def events_of_tiers(spark, sf):
    """Events whose story has a source of tier 1 or 2."""
    e = table(spark, sf, "events").select(F.col("event_id").alias("id"), (F.col("user_id") % 97).alias("story"))
    return e.join(stories(spark, sf).where("t1 > 0 OR t2 > 0").select("story"), "story").select("id", "story")


@query("SELECT event_id AS id FROM events WHERE user_id IN (SELECT o_custkey FROM orders WHERE o_orderstatus IN ('F', 'P')) AND event_type = 'click'")
def public_events(spark, sf):
    """Events of stories whose status is public, as a semi-join."""
    public = table(spark, sf, "orders").where("o_orderstatus IN ('F', 'P')").select(F.col("o_custkey").alias("user_id"))
    return table(spark, sf, "events").where("event_type = 'click'").join(public, "user_id", "left_semi").select(F.col("event_id").alias("id"))


@query("""WITH k AS (SELECT l_orderkey AS o, count(DISTINCT l_suppkey) FILTER (WHERE l_quantity > 10) AS units FROM lineitem GROUP BY 1)
    SELECT o_orderkey AS story, coalesce(units, 0) AS units FROM orders LEFT JOIN k ON o = o_orderkey WHERE o_orderstatus IN ('O', 'P') AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderkey % 10 <> 1 AND coalesce(units, 0) >= 2 ORDER BY o_orderdate DESC, o_orderkey LIMIT 100""")
def phase2_selection(spark, sf):
    """Stories to analyse, newest first: of a status and window, no viewpoint child, with enough units that bear text."""
    units = table(spark, sf, "lineitem").where("l_quantity > 10").groupBy(F.col("l_orderkey").alias("story")).agg(F.countDistinct("l_suppkey").alias("units")).where("units >= 2")
    o = table(spark, sf, "orders").where("o_orderstatus IN ('O', 'P') AND o_orderkey % 10 <> 1").where(F.col("o_orderdate").cast("timestamp") >= F.lit("1996-01-01 00:00:00").cast("timestamp"))
    return o.select(F.col("o_orderkey").alias("story"), "o_orderdate").join(units, "story").orderBy(F.desc("o_orderdate"), "story").limit(100).select("story", "units")


_ORDERS = {"top": "owners DESC, t1 DESC, latest DESC, story", "newest": "latest DESC, story", "oldest": "latest, story"}


@query(f"""WITH {_ST}, q AS (SELECT *, story % 5 = 0 AS child, CASE WHEN story % 3 = 0 THEN 'blocked' ELSE 'pending' END AS status FROM st),
    k AS (SELECT story, owners, t1, latest FROM q WHERE status = 'pending' AND (NOT child OR (t1 >= 2 AND owners >= 2)) AND t1 + t2 > 0 AND latest >= epoch(TIMESTAMP '2024-01-01') + 43200)
    """ + " UNION ALL ".join(f"SELECT * FROM (SELECT '{name}' AS sort, row_number() OVER (ORDER BY {keys}) AS place, story FROM k) WHERE place <= 50" for name, keys in _ORDERS.items()), articles=True)
def curation_orders(spark, sf):
    """The queue in its three orders, fifty of each: pending, no unconfirmed child, in the tiers and the window; ranks are given within fifty rows."""
    q = stories(spark, sf).where((F.col("story") % 3 != 0) & ((F.col("story") % 5 != 0) | P.corroborated(F.col("t1"), F.col("owners"))) & (F.col("t1") + F.col("t2") > 0) & (F.col("latest") >= EPOCH + 43200))
    out = None
    for name, keys in _ORDERS.items():
        order = [F.expr(k.replace(" DESC", "")).desc() if k.endswith("DESC") else F.expr(k) for k in keys.split(", ")]
        best = q.orderBy(*order).limit(50).select(F.lit(name).alias("sort"), F.row_number().over(Window.orderBy(*order)).alias("place"), "story")
        out = best if out is None else out.unionByName(best)
    return out


@query(r"""SELECT page_id, regexp_matches(trim(url), '^(?i:https?):') AS safe, trim(url) = url AS clean FROM pages UNION ALL SELECT -page_id, false, true FROM pages""")
def safe_urls(spark, sf):
    """Absolute http(s) addresses are safe to link, any other scheme and relative ones are not."""
    u = table(spark, sf, "pages").select("page_id", "url").unionByName(table(spark, sf, "pages").select((-F.col("page_id")).alias("page_id"), F.concat(F.lit("javascript:"), "url").alias("url")))
    cleaned = F.regexp_replace(F.regexp_replace("url", r"[\t\n\r]", ""), r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    return u.select("page_id", cleaned.rlike("^(?i:https?):").alias("safe"), (cleaned == F.col("url")).alias("clean"))


@query("""WITH b AS (SELECT id, CASE id % 4 WHEN 0 THEN ' Please LIMIT requests to one every 5 seconds' WHEN 1 THEN '{"articles": "too many requests"}' WHEN 2 THEN repeat(' ', 600) || 'too many requests' ELSE body END AS t FROM a)
    SELECT id, (ltrim(substring(t, 1, 512)) <> '' AND NOT starts_with(ltrim(substring(t, 1, 512)), '{') AND regexp_matches(lower(substring(t, 1, 512)), 'please limit requests|please do not hammer|too many requests')) AS throttled FROM b""", articles=True)
def throttle_bodies(spark, sf):
    n = F.col("id") % 4
    t = F.when(n == 0, " Please LIMIT requests to one every 5 seconds").when(n == 1, '{"articles": "too many requests"}').when(n == 2, F.concat(F.repeat(F.lit(" "), F.lit(600)), F.lit("too many requests"))).otherwise(F.col("body"))
    head = F.trim(F.substring(t, 1, 512))
    return articles(spark, sf).select("id", ((head != "") & ~F.startswith(head, F.lit("{")) & F.lower(head).rlike("please limit requests|please do not hammer|too many requests")).alias("throttled"))


@query(r"""WITH f AS (SELECT id, trim(regexp_replace(title, '[\s\p{Z}]+', ' ', 'g')) AS t, CASE WHEN id % 3 = 0 THEN '' WHEN id % 3 = 1 THEN 'https://example.com/' || id ELSE 'https://example.com/' || repeat('x', 300) END AS u, trim(regexp_replace(substring(body, 1, 400), '[\s\p{Z}]+', ' ', 'g')) AS b FROM a),
    g AS (SELECT id, u, CASE WHEN id % 2 = 0 AND b <> '' THEN b WHEN t <> '' THEN t ELSE 'News Update' END AS base FROM f)
    SELECT id, CASE WHEN u = '' THEN trim(substring(base, 1, 280)) WHEN 279 - length(u) <= 0 THEN substring(u, 1, 280) ELSE rtrim(substring(base, 1, 279 - length(u))) || ' ' || u END AS caption FROM g""", articles=True)
def captions(spark, sf):
    n = F.col("id")
    url = F.when(n % 3 == 0, "").when(n % 3 == 1, F.concat(F.lit("https://example.com/"), n.cast("string"))).otherwise(F.concat(F.lit("https://example.com/"), F.repeat(F.lit("x"), F.lit(300))))
    facts = F.when(n % 2 == 0, F.array(F.lit("  "), F.substring("body", 1, 400)))
    return articles(spark, sf).select("id", P.caption(F.col("title"), facts, F.array(url)).alias("caption"))


@query(r"""WITH w AS (SELECT id, list_filter(regexp_split_to_array(lower(body), '[\s\p{Z}]+'), lambda x: x <> '') AS ws, list_filter(regexp_split_to_array(lower(title), '[\s\p{Z}]+'), lambda x: x <> '') AS ts, title FROM a),
    c AS (SELECT id, trim(title) <> '' AS said, CASE WHEN id % 2 = 0 THEN list_reverse(ts) ELSE ts END AS ts, ws FROM w),
    g AS (SELECT id, said, list_distinct(list_transform(range(1, len(ts) - 4), lambda i: array_to_string(ts[i : i + 5], ' '))) AS x, list_distinct(list_transform(range(1, len(ws) - 4), lambda i: array_to_string(ws[i : i + 5], ' '))) AS y FROM c)
    SELECT id, said AND NOT list_has_any(x, y) AS adopted FROM g""", articles=True)
def caption_adoption(spark, sf):
    """A caption is adopted if it says something and shares no six words in a row with its source; every other one is reversed here."""
    words = F.filter(F.split("title", r"[\s\p{Z}]+"), lambda x: x != "")
    cap = F.when(F.col("id") % 2 == 0, F.array_join(F.reverse(words), " ")).otherwise(F.col("title"))
    a = articles(spark, sf).select("id", cap.alias("caption"), "title", "body")
    return a.select("id", ((F.trim("title") != "") & ~F.arrays_overlap(P.ngrams(F.col("caption"), 6), P.ngrams(F.col("body"), 6))).alias("adopted"))


@query("""WITH r AS (SELECT event_id AS id, CASE event_id % 6 WHEN 0 THEN 'high' WHEN 1 THEN NULL WHEN 2 THEN '88.4' WHEN 3 THEN '-5' WHEN 4 THEN '250' ELSE CAST(event_id % 101 AS VARCHAR) END AS c, CASE event_id % 4 WHEN 0 THEN 'x' WHEN 1 THEN '0.25' ELSE CAST((event_id % 8) / 8.0 AS VARCHAR) END AS p FROM events),
    v AS (SELECT id, coalesce(least(100, greatest(0, CAST(trunc(TRY_CAST(c AS DOUBLE)) AS INTEGER))), 80) AS confidence, coalesce(CAST(trunc(TRY_CAST(p AS DOUBLE) * 1000000) AS INTEGER), 500000) AS position FROM r)
    SELECT id, confidence, position, CASE WHEN confidence <= 24 THEN 0 WHEN confidence <= 49 THEN 1 WHEN confidence <= 74 THEN 2 ELSE 3 END AS band, CAST(greatest(0, least(4, trunc(position / 1000000.0 * 5))) AS INTEGER) AS bucket FROM v""")
def model_answers(spark, sf):
    """A model's free answers coerced: confidence, position, and the bands in which they are scored."""
    n = F.col("event_id")
    c = F.when(n % 6 == 0, "high").when(n % 6 == 1, None).when(n % 6 == 2, "88.4").when(n % 6 == 3, "-5").when(n % 6 == 4, "250").otherwise((n % 101).cast("string"))
    p = F.when(n % 4 == 0, "x").when(n % 4 == 1, "0.25").otherwise(((n % 8) / 8.0).cast("string"))
    v = table(spark, sf, "events").select(n.alias("id"), P.confidence(c).alias("confidence"), P.position(p).alias("position"))
    return v.select("*", P.confidence_band(F.col("confidence")).alias("band"), P.position_bucket(F.col("position") / 1000000.0).alias("bucket"))


@query("""SELECT event_id AS id, CASE event_id % 5 WHEN 0 THEN 0 WHEN 1 THEN (event_id % 60) * 3600 WHEN 2 THEN (event_id % 60) * 60 + 5 WHEN 3 THEN (event_id % 9) * 3600 + (event_id % 60) * 60 + event_id % 60 ELSE 0 END AS seconds,
    event_id % 7 + event_id % 5 + CASE WHEN event_id % 3 = 0 THEN 0 ELSE event_id % 11 END AS engagement FROM events""")
def durations_and_engagement(spark, sf):
    """Seconds of ISO durations; likes, replies and shares added up, absent ones as none."""
    n = F.col("event_id")
    s = lambda c: c.cast("string")
    text = F.when(n % 5 == 0, "P1D").when(n % 5 == 1, F.concat(F.lit("PT"), s(n % 60), F.lit("H"))).when(n % 5 == 2, F.concat(F.lit("PT"), s(n % 60), F.lit("M5S"))).when(n % 5 == 3, F.concat(F.lit("PT"), s(n % 9), F.lit("H"), s(n % 60), F.lit("M"), s(n % 60), F.lit("S"))).otherwise("")
    total = sum((F.coalesce(x, F.lit(0)) for x in (n % 5, F.when(n % 3 != 0, n % 11))), n % 7)
    return table(spark, sf, "events").select(n.alias("id"), P.iso_duration(text).alias("seconds"), total.alias("engagement"))


@query("SELECT id, length(body) // 2 + 1 AS tokens FROM a", articles=True)
def prompt_tokens(spark, sf):
    return articles(spark, sf).select("id", (F.floor(F.length("body") / 2) + 1).alias("tokens"))
