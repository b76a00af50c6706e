"""Filters and reads over events, topics of stories, ranks, revisions, selections and cleanup."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewire.operators import topics as P
from tidewire.plans.graph_queries import _LK, links
from tidewire.plans.registry import query
from tidewire.sources.tables import articles, map_events, table

_TOPICS = {"Economy": ["economy", "standard"], "Economy > Metals": ["ring", "valve", "bolt"], "Promotion": ["promo"], "Size": ["small", "large", "medium"]}
_SCORES = " UNION ALL ".join(f"SELECT story, '{t}' AS topic, " + " + ".join(f"CAST(contains(names, '{k}') AS INTEGER)" for k in ks) + " AS hits FROM n" for t, ks in _TOPICS.items())


@query(f"""WITH n AS (SELECT l_orderkey AS story, lower(string_agg(DISTINCT p_name || ' ' || p_type, ' ' ORDER BY p_name || ' ' || p_type)) AS names FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_linenumber > 2 GROUP BY l_orderkey), s AS ({_SCORES}), m AS (SELECT story, topic, least(100, 10 + 15 * hits) AS confidence FROM s WHERE hits > 0),
    a AS (SELECT o_orderkey AS story FROM orders) SELECT story, topic, confidence FROM m UNION ALL SELECT story, 'Geopolitics', 10 FROM a WHERE story NOT IN (SELECT story FROM m)""")
def topic_groups(spark, sf):
    """Topic groups of stories by keywords in their entities' names, with the fallback for those that none names."""
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.concat_ws(" ", "p_name", "p_type").alias("name"))
    named = table(spark, sf, "lineitem").where("l_linenumber > 2").join(part, "l_partkey").groupBy(F.col("l_orderkey").alias("story")).agg(F.sort_array(F.collect_set("name")).alias("entities"))
    stories = table(spark, sf, "orders").select(F.col("o_orderkey").alias("story")).join(named, "story", "left")
    return P.match(stories, "entities", _TOPICS, "Geopolitics")


_EV = """ev AS (SELECT event_id AS id, user_id AS story, event_type, epoch_us(ts) AS t, (user_id * 37) % 180 - 90 + value / 1000 AS lat, CAST((user_id * 53) % 360 - 180 AS DOUBLE) AS lon, value / 100 AS confidence, coalesce(CAST(json_extract_string(props, '$.k') AS INTEGER), 0) % 3 AS tier1 FROM events)"""


@query(f"""WITH {_EV}, c AS (SELECT *, sum(tier1) OVER (PARTITION BY story, event_type) AS cluster_tier1, min(id) OVER (PARTITION BY story, event_type, t // 3600000000) AS canonical FROM ev) SELECT id, t FROM c WHERE id = canonical AND story IN (SELECT o_custkey FROM orders WHERE o_orderstatus IN ('F', 'P')) AND event_type <> 'error' AND confidence >= 0.3 AND cluster_tier1 >= 2 AND lon BETWEEN -100 AND 120 AND lat BETWEEN -60 AND 60 AND t BETWEEN epoch_us(TIMESTAMP '2024-01-03') AND epoch_us(TIMESTAMP '2024-01-20')""")
def event_conditions(spark, sf):
    """All conditions of an event read: canonical, public, type, confidence, the cluster's tier-1 sources, box and time, bounds included."""
    e = map_events(spark, sf).select("id", F.col("story_id").alias("story"), "event_type", F.col("start").alias("t"), "lat", "lon", (F.col("value") / 100).alias("confidence"), F.col("tier1_source_count").alias("tier1"))
    cluster = e.groupBy("story", "event_type").agg(F.sum("tier1").alias("cluster_tier1")).where("cluster_tier1 >= 2")
    first = e.groupBy("story", "event_type", F.floor(F.col("t") / 3_600_000_000).alias("h")).agg(F.min("id").alias("id")).select("id")
    public = table(spark, sf, "orders").where("o_orderstatus IN ('F', 'P')").select(F.col("o_custkey").alias("story"))
    box = "event_type <> 'error' AND confidence >= 0.3 AND lon BETWEEN -100 AND 120 AND lat BETWEEN -60 AND 60"
    seen = e.where(box).where(F.col("t").between(1_704_240_000_000_000, 1_705_708_800_000_000))
    return seen.join(first, "id", "left_semi").join(public, "story", "left_semi").join(cluster, ["story", "event_type"], "left_semi").select("id", "t")


@query("WITH e AS (SELECT l_orderkey AS s, l_returnflag AS p, l_suppkey AS o, min(l_linenumber) AS kept, count(*) AS n FROM lineitem GROUP BY ALL) SELECT s, p, o, kept, n - 1 AS dropped FROM e")
def edge_dedup(spark, sf):
    """One edge for each subject, predicate and object: the first; how many more there were."""
    e = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("s"), F.col("l_returnflag").alias("p"), F.col("l_suppkey").alias("o")).agg(F.min("l_linenumber").alias("kept"), (F.count("*") - 1).alias("dropped"))
    return e.select("s", "p", "o", "kept", "dropped")


@query("SELECT conv_id AS article, max(turn) AS revision, sha256(coalesce(arg_max(coalesce(text, ''), turn), '')) AS content_hash FROM conversations GROUP BY conv_id")
def latest_revisions(spark, sf):
    r = table(spark, sf, "conversations").select("conv_id", "turn", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("h"))
    return r.groupBy(F.col("conv_id").alias("article")).agg(F.max("turn").alias("revision"), F.max_by("h", "turn").alias("content_hash"))


@query("SELECT o_orderkey, rank() OVER w AS r, dense_rank() OVER w AS d, ntile(4) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS quarter, round(percent_rank() OVER w, 6) AS pr, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS after FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderstatus)")
def rank_functions(spark, sf):
    w, o = Window.partitionBy("o_custkey").orderBy("o_orderstatus"), Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return table(spark, sf, "orders").select("o_orderkey", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("d"), F.ntile(4).over(o).alias("quarter"), F.round(F.percent_rank().over(w), 6).alias("pr"), F.lead("o_orderkey").over(o).alias("after"))


@query(f"WITH {_LK}, e AS (SELECT story, list_sort(list_distinct(list_concat(list(brand), list('unit' || lpad(CAST(unit AS VARCHAR), 6, '0'))))) AS e FROM lk GROUP BY story) SELECT story, array_to_string(e[1:10], ',') AS entities, len(e) AS n FROM e")
def story_entities(spark, sf):
    """A story's entities as they are stored: those of its units together, the first ten in order."""
    unit = F.concat(F.lit("unit"), F.lpad(F.col("unit").cast("string"), 6, "0"))
    e = links(spark, sf).groupBy("story").agg(F.array_sort(F.array_union(F.collect_set("brand"), F.collect_set(unit))).alias("e"))
    return e.select("story", F.array_join(F.slice("e", 1, 10), ",").alias("entities"), F.size("e").cast("long").alias("n"))


@query("""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, source, lang FROM documents), e AS (SELECT doc_id, lang, source, list_distinct(regexp_extract_all(text, '[A-Z][a-z]{3,}')) AS person, [source] AS org FROM d)
    SELECT doc_id, len(list_distinct(list_concat(person, org))) AS primary_size, CASE WHEN len(person) > 0 THEN list_sort(person)[1] ELSE lang END AS event_key FROM e""")
def entity_sets(spark, sf):
    """Entities of persons, bodies and places as one set; an event's keys are its story's, or else its place."""
    person = F.array_distinct(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[A-Z][a-z]{3,}"), F.lit(0)))
    e = table(spark, sf, "documents").select("doc_id", "lang", F.create_map(F.lit("PERSON"), person, F.lit("ORG"), F.array("source"), F.lit("DATE"), F.array(F.lit("today"))).alias("m"))
    primary = F.array_distinct(F.flatten(F.map_values(F.map_filter("m", lambda k, v: k.isin("PERSON", "ORG", "GPE")))))
    keys = F.coalesce(F.nullif(F.col("m")["PERSON"], F.array().cast("array<string>")), F.array("lang"))
    return e.select("doc_id", F.size(primary).cast("long").alias("primary_size"), F.array_min(keys).alias("event_key"))


@query("WITH s AS (SELECT DISTINCT source AS name, 1 + CAST(substring(source, 4) AS INTEGER) % 4 AS tier FROM documents), n AS (SELECT unnest(['src1', 'src2', 'src5', 'nowhere']) AS name) SELECT coalesce(s.name, n.name) AS name, CASE WHEN s.name IS NULL THEN 'unknown' WHEN n.name IS NOT NULL AND tier IN (1, 2, 3) THEN 'selected' ELSE 'left out' END AS state FROM s FULL JOIN n ON s.name = n.name")
def source_selection(spark, sf):
    """Sources that a run takes: of the tiers asked for and among the names asked for; names that nothing has are told."""
    s = table(spark, sf, "documents").select(F.col("source").alias("name")).distinct().withColumn("tier", 1 + F.substring("name", 4, 9).cast("int") % 4)
    n = spark.createDataFrame([(x,) for x in ("src1", "src2", "src5", "nowhere")], "name string").withColumn("asked", F.lit(True))
    return s.join(n, "name", "full").select("name", F.when(F.col("tier").isNull(), "unknown").when(F.col("asked") & F.col("tier").isin(1, 2, 3), "selected").otherwise("left out").alias("state"))


@query("""SELECT 'expired' AS step, count(*) AS n FROM orders WHERE (o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '1996-01-01' - INTERVAL 120 HOUR) OR (o_orderstatus = 'O' AND o_orderdate < TIMESTAMP '1996-01-01' - INTERVAL 168 HOUR) UNION ALL SELECT 'orphan units', count(*) FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)
    UNION ALL SELECT 'stale links', count(*) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def cleanup_run(spark, sf):
    """What one cleanup does, step by step."""
    o, line = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    before = lambda h: F.col("o_orderdate").cast("timestamp") < F.expr(f"TIMESTAMP '1996-01-01 00:00:00' - INTERVAL {h} HOURS")
    count = lambda step, df: df.agg(F.count("*").alias("n")).select(F.lit(step).alias("step"), "n")
    expired = o.where(((F.col("o_orderstatus") == "P") & before(120)) | ((F.col("o_orderstatus") == "O") & before(168)))
    orphans = table(spark, sf, "part").join(line.where("l_quantity > 45"), F.col("p_partkey") == F.col("l_partkey"), "left_anti")
    stale = line.join(o.where("o_orderstatus = 'F'"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    return count("expired", expired).unionByName(count("orphan units", orphans)).unionByName(count("stale links", stale))


@query("SELECT id, lang AS detected_language, CASE WHEN lang = 'en' THEN title WHEN id % 3 = 0 THEN 'en: ' || domain ELSE title END AS shown_title, lang <> 'en' AND id % 3 = 0 AS translated FROM a", articles=True)
def translated_views(spark, sf):
    """Titles as they are shown: the translation where there is one."""
    given = (F.col("lang") != "en") & (F.col("id") % 3 == 0)
    return articles(spark, sf).select("id", F.col("lang").alias("detected_language"), F.when(given, F.concat(F.lit("en: "), "domain")).otherwise(F.col("title")).alias("shown_title"), given.alias("translated"))


@query(f"WITH {_LK}, e AS (SELECT user_id AS c, event_type, count(*) AS n FROM events GROUP BY ALL), g AS (SELECT c, count(*) AS event_count FROM e GROUP BY c) SELECT o_orderkey AS story, o_orderstatus AS status, event_count, (SELECT count(DISTINCT unit) FROM lk WHERE lk.story = o_orderkey) AS units FROM orders JOIN g ON c = o_custkey WHERE o_orderstatus IN ('F', 'P') ORDER BY event_count DESC, story LIMIT 50")
def top_public_stories(spark, sf):
    """Public stories by the kinds of events that they have, each side aggregated before the join."""
    g = table(spark, sf, "events").groupBy(F.col("user_id").alias("o_custkey")).agg(F.countDistinct("event_type").alias("event_count"))
    top = table(spark, sf, "orders").where("o_orderstatus IN ('F', 'P')").join(g, "o_custkey").select(F.col("o_orderkey").alias("story"), F.col("o_orderstatus").alias("status"), "event_count").orderBy(F.desc("event_count"), "story").limit(50)
    u = links(spark, sf).join(F.broadcast(top.select("story")), "story", "left_semi").groupBy("story").agg(F.countDistinct("unit").alias("units"))  # fifty rows
    return top.join(u, "story", "left").select("story", "status", "event_count", F.coalesce("units", F.lit(0)).alias("units"))
