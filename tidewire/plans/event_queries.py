"""Map events, reads, audits and analysis."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewire.operators import events as E
from tidewire.plans.registry import query
from tidewire.sources.tables import articles, map_events, table

_EVENTS = """ev AS (SELECT event_id AS id, user_id AS story_id, event_type, epoch_us(ts) AS start, (user_id * 37) % 180 - 90 + value / 1000 AS lat, CAST((user_id * 53) % 360 - 180 AS DOUBLE) AS lon,
        coalesce(CAST(json_extract_string(props, '$.k') AS INTEGER), 0) AS source_count, coalesce(CAST(json_extract_string(props, '$.k') AS INTEGER), 0) % 3 AS tier1_source_count, value FROM events)"""
_PAIRS = f"""{_EVENTS}, pr AS (SELECT l.id AS a, r.id AS b FROM ev l JOIN ev r ON l.event_type = r.event_type AND l.story_id = r.story_id AND l.id < r.id WHERE abs(l.start - r.start) < 86400000000
        AND 2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(r.lat - l.lat) / 2), 2) + cos(radians(l.lat)) * cos(radians(r.lat)) * pow(sin(radians(r.lon - l.lon) / 2), 2)))) <= 50)"""
_CLUSTERS = f"""{_PAIRS}, eg AS (SELECT a AS x, b AS y FROM pr UNION ALL SELECT b, a FROM pr), rc AS (SELECT id AS node, id AS root FROM ev UNION SELECT eg.y, rc.root FROM rc JOIN eg ON eg.x = rc.node AND rc.root < eg.y),
    cl AS (SELECT node AS id, min(root) AS cluster FROM rc GROUP BY node)"""


@query(f"WITH {_PAIRS} SELECT a, b FROM pr")
def event_same_pairs(spark, sf):
    return E.same_event_pairs(map_events(spark, sf))


@query(f"WITH RECURSIVE {_CLUSTERS} SELECT id, cluster FROM cl")
def event_clusters(spark, sf):
    return E.event_clusters(map_events(spark, sf))


@query(f"WITH RECURSIVE {_CLUSTERS} SELECT cluster, count(*) AS members, sum(source_count)::BIGINT AS sources, sum(tier1_source_count)::BIGINT AS tier1_sources, arg_min(id, (-tier1_source_count, -source_count, start, id)) AS canonical_id FROM cl JOIN ev USING (id) GROUP BY cluster")
def cluster_corroboration(spark, sf):
    return E.canonical_events(map_events(spark, sf))


@query(f"WITH {_EVENTS} SELECT story_id, arg_min(id, (CASE event_type WHEN 'purchase' THEN 0 WHEN 'click' THEN 1 ELSE 2 END, -value, id)) AS place, count(*) AS n FROM ev GROUP BY story_id")
def place_pick(spark, sf):
    rank = F.when(F.col("event_type") == "purchase", 0).when(F.col("event_type") == "click", 1).otherwise(2)
    return map_events(spark, sf).groupBy("story_id").agg(F.min_by("id", F.struct(rank, -F.col("value"), "id")).alias("place"), F.count("*").alias("n"))


@query(f"WITH {_EVENTS} SELECT id, event_type, start FROM ev WHERE lat BETWEEN -45 AND 45 AND (lon >= 120 OR lon <= -60) AND source_count >= 20 ORDER BY source_count DESC, start DESC, id LIMIT 500")
def map_events_bbox(spark, sf):
    """A viewport over the antimeridian is two boxes; inclusive bounds."""
    m = map_events(spark, sf).where("lat BETWEEN -45 AND 45 AND (lon >= 120 OR lon <= -60) AND source_count >= 20")
    return m.orderBy(F.desc("source_count"), F.desc("start"), "id").limit(500).select("id", "event_type", "start")


@query(f"WITH {_EVENTS} SELECT id, event_type, start, count(*) OVER () > 200 AS truncated FROM (SELECT * FROM ev WHERE start >= epoch_us(TIMESTAMP '2024-01-02') AND start <= epoch_us(TIMESTAMP '2024-01-09') ORDER BY start, id LIMIT 201) ORDER BY start, id LIMIT 200")
def replay_window(spark, sf):
    """The first 200 in order of time, and whether there are more: one row more than shown is taken."""
    lo, hi = 1_704_153_600_000_000, 1_704_758_400_000_000
    got = map_events(spark, sf).where(F.col("start").between(lo, hi)).orderBy("start", "id").limit(201)
    more = got.agg((F.count("*") > 200).alias("truncated"))
    return got.orderBy("start", "id").limit(200).crossJoin(F.broadcast(more)).select("id", "event_type", "start", "truncated")


@query("WITH b AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events), h AS (SELECT least(59, CAST(floor((epoch_us(ts) - lo) / CAST(hi - lo AS DOUBLE) * 60) AS INTEGER)) AS bucket, count(*) AS n FROM events, b GROUP BY ALL), g AS (SELECT CAST(unnest(range(60)) AS INTEGER) AS bucket) SELECT g.bucket, coalesce(n, 0) AS n FROM g LEFT JOIN h USING (bucket)")
def timeline_histogram(spark, sf):
    e = table(spark, sf, "events").select(F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    span = e.agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    h = e.crossJoin(F.broadcast(span)).groupBy(F.least(F.lit(59), F.floor((F.col("t") - F.col("lo")) / (F.col("hi") - F.col("lo")) * 60).cast("int")).alias("bucket")).agg(F.count("*").alias("n"))
    return spark.range(60).select(F.col("id").cast("int").alias("bucket")).join(h, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


@query(f"WITH {_EVENTS} SELECT event_type, count(*) AS markers, sum(c)::BIGINT AS events FROM (SELECT event_type, floor(lat * 1000 + 0.5) AS a, floor(lon * 1000 + 0.5) AS o, count(*) AS c FROM ev GROUP BY ALL) GROUP BY event_type")
def marker_dedup(spark, sf):
    m = map_events(spark, sf).groupBy("event_type", F.floor(F.col("lat") * 1000 + 0.5).alias("a"), F.floor(F.col("lon") * 1000 + 0.5).alias("o")).agg(F.count("*").alias("c"))
    return m.groupBy("event_type").agg(F.count("*").alias("markers"), F.sum("c").alias("events"))


@query("SELECT day, event_type, sum(n) OVER (PARTITION BY event_type ORDER BY day)::BIGINT AS total FROM (SELECT CAST(floor(epoch(ts) / 86400) AS BIGINT) AS day, event_type, count(*) AS n FROM events GROUP BY ALL)")
def cumulative_type_counts(spark, sf):
    """Counts per day first, so that the window runs over days, not events."""
    d = table(spark, sf, "events").groupBy(F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 86400).alias("day"), "event_type").agg(F.count("*").alias("n"))
    return d.select("day", "event_type", F.sum("n").over(Window.partitionBy("event_type").orderBy("day")).alias("total"))


_TOP = """s AS (SELECT lang || '-' || domain AS story, count(DISTINCT owner) AS owners, count(*) FILTER (WHERE tier = 1) AS tier1, max(fetched) AS latest, arg_min(title, (fetched, id)) AS headline FROM a GROUP BY ALL)"""


def _stories(spark, sf):
    a = articles(spark, sf)
    return a.groupBy(F.concat_ws("-", "lang", "domain").alias("story")).agg(F.countDistinct("owner").alias("owners"), F.count_if(F.col("tier") == 1).alias("tier1"), F.max("fetched").cast("double").alias("latest"), F.min_by("title", F.struct("fetched", "id")).alias("headline"))


@query(f"WITH {_TOP} SELECT story, owners, tier1, latest FROM s ORDER BY owners DESC, tier1 DESC, latest DESC, story LIMIT 50", articles=True)
def top_stories(spark, sf):
    return _stories(spark, sf).orderBy(F.desc("owners"), F.desc("tier1"), F.desc("latest"), "story").limit(50).select("story", "owners", "tier1", "latest")


@query(f"WITH {_TOP}, r AS (SELECT *, row_number() OVER (PARTITION BY headline ORDER BY tier1 DESC, story) AS nth FROM s) SELECT story, headline FROM r WHERE nth = 1", articles=True)
def headline_dedup(spark, sf):
    w = Window.partitionBy("headline").orderBy(F.desc("tier1"), "story")
    return _stories(spark, sf).withColumn("nth", F.row_number().over(w)).where("nth = 1").select("story", "headline")


@query("SELECT id, domain FROM a WHERE body ILIKE '%the and%' OR title ILIKE '%heit%'", articles=True)
def story_search_ilike(spark, sf):
    return articles(spark, sf).where(F.col("body").ilike("%the and%") | F.col("title").ilike("%heit%")).select("id", "domain")


@query("SELECT max(fetched) AS newest, count(*) FILTER (WHERE fetched >= m - 86400) AS in_window, count(DISTINCT domain) FILTER (WHERE fetched >= m - 86400) AS outlets FROM a, (SELECT max(fetched) AS m FROM a)", articles=True)
def freshness_stamp(spark, sf):
    a = articles(spark, sf).select("fetched", "domain")
    newest = a.agg(F.max("fetched").alias("m"))
    recent = F.col("fetched") >= F.col("m") - 86400
    return a.crossJoin(F.broadcast(newest)).agg(F.max("fetched").cast("double").alias("newest"), F.count_if(recent).alias("in_window"), F.countDistinct(F.when(recent, F.col("domain"))).alias("outlets"))


@query("WITH r AS (SELECT lang, domain, id, tier, row_number() OVER (PARTITION BY lang, tier ORDER BY fetched DESC, id) AS nth FROM a) SELECT lang, tier, id, domain FROM r WHERE nth <= 6", articles=True)
def curation_queue(spark, sf):
    w = Window.partitionBy("lang", "tier").orderBy(F.desc("fetched"), "id")
    return articles(spark, sf).select("lang", "domain", "id", "tier", F.row_number().over(w).alias("nth")).where("nth <= 6").select("lang", "tier", "id", "domain")


@query("SELECT lang AS story, 'tier' || tier AS key, count(*) AS n FROM a GROUP BY ALL UNION ALL SELECT lang, owner, count(*) FROM a GROUP BY ALL", articles=True)
def story_sources(spark, sf):
    keys = F.explode(F.array(F.concat(F.lit("tier"), F.col("tier").cast("string")), F.col("owner")))
    return articles(spark, sf).select(F.col("lang").alias("story"), keys.alias("key")).groupBy("story", "key").agg(F.count("*").alias("n"))


@query("SELECT 'labels without document' AS kind, count(*) AS n FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents) UNION ALL SELECT 'documents without label', count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT 'customers without order', count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def orphans(spark, sf):
    t = lambda n: table(spark, sf, n)
    count = lambda kind, df: df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
    return count("labels without document", t("labels").join(t("documents"), "doc_id", "left_anti")).unionByName(count("documents without label", t("documents").join(t("labels"), "doc_id", "left_anti"))).unionByName(
        count("customers without order", t("customer").join(t("orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti")))


@query("SELECT CAST(floor(fetched / 86400) AS BIGINT) AS day, lang, count(*) AS n FROM a GROUP BY ALL", articles=True)
def stories_per_day(spark, sf):
    return articles(spark, sf).groupBy(F.floor(F.col("fetched") / 86400).alias("day"), "lang").agg(F.count("*").alias("n"))


@query("SELECT owner, count(*) FILTER (WHERE lang = 'en') AS en, count(*) FILTER (WHERE lang = 'fr') AS fr, count(*) FILTER (WHERE lang = 'de') AS de, count(*) FILTER (WHERE lang = 'es') AS es FROM a GROUP BY owner", articles=True)
def crosstab(spark, sf):
    return articles(spark, sf).groupBy("owner").pivot("lang", ["en", "fr", "de", "es"]).agg(F.count(F.lit(1))).na.fill(0)


@query("SELECT domain, title, count(*) AS n, min(fetched) AS first, max(fetched) AS last FROM a GROUP BY domain, title HAVING count(*) > 1", articles=True)
def duplicate_titles(spark, sf):
    return articles(spark, sf).groupBy("domain", "title").agg(F.count("*").alias("n"), F.min("fetched").cast("double").alias("first"), F.max("fetched").cast("double").alias("last")).where("n > 1")


@query(r"WITH e AS (SELECT id, lang, len(list_distinct(regexp_extract_all(title, '[A-Z][a-z]+'))) AS n FROM a) SELECT lang, min(n) AS low, max(n) AS high, list_sort(list(n))[len(list(n)) // 2 + 1] AS median, count(*) FILTER (WHERE n = 0) AS empty FROM e GROUP BY lang", articles=True)
def entity_set_sizes(spark, sf):
    """The median is the upper middle one, taken by rank within the counts of each size."""
    e = articles(spark, sf).select("lang", F.size(F.array_distinct(F.regexp_extract_all("title", F.lit("[A-Z][a-z]+"), F.lit(0)))).cast("long").alias("n"))
    sizes = e.groupBy("lang", "n").agg(F.count("*").alias("c"))
    w = Window.partitionBy("lang")
    ranked = sizes.select("*", F.sum("c").over(w.orderBy("n")).alias("upto"), F.sum("c").over(w).alias("total"))
    return ranked.groupBy("lang").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.min(F.when(F.col("upto") >= F.floor(F.col("total") / 2) + 1, F.col("n"))).alias("median"), F.sum(F.when(F.col("n") == 0, F.col("c")).otherwise(0)).alias("empty"))


@query("SELECT o_orderkey, o.n AS stored, l.n AS counted FROM (SELECT o_orderkey, 1 + o_orderkey % 7 AS n FROM orders) o LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) l ON o_orderkey = l_orderkey WHERE o.n <> coalesce(l.n, 0)")
def counter_mismatch(spark, sf):
    counted = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("counted"))
    stored = table(spark, sf, "orders").select("o_orderkey", (1 + F.col("o_orderkey") % 7).alias("stored"))
    j = stored.join(counted, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return j.where(F.col("stored") != F.coalesce("counted", F.lit(0))).select("o_orderkey", "stored", "counted")


@query("SELECT domain, count(*) AS n, max(fetched) AS newest FROM a WHERE tier = 1 GROUP BY domain ORDER BY n DESC, domain", articles=True)
def tier1_freshness(spark, sf):
    return articles(spark, sf).where("tier = 1").groupBy("domain").agg(F.count("*").alias("n"), F.max("fetched").cast("double").alias("newest"))


@query("SELECT c_nationkey AS country, o_orderpriority AS family, count(*) AS events, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS share FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL")
def family_coverage(spark, sf):
    j = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    g = j.groupBy(F.col("c_nationkey").alias("country"), F.col("o_orderpriority").alias("family")).agg(F.count("*").alias("events"))
    total = g.agg(F.sum("events").alias("t"))
    return g.crossJoin(F.broadcast(total)).select("country", "family", "events", F.round(F.col("events") * 100.0 / F.col("t"), 6).alias("share"))


@query("WITH e AS (SELECT c_nationkey AS country, count(*) AS events FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY ALL), p AS (SELECT s_nationkey AS country, count(*) AS articles FROM supplier WHERE s_acctbal > 8000 GROUP BY ALL) SELECT coalesce(e.country, p.country) AS country, coalesce(events, 0) AS events, coalesce(articles, 0) AS articles, CASE WHEN coalesce(articles, 0) = 0 THEN 0.0 ELSE round(articles / CAST(events AS DOUBLE), 6) END AS ratio FROM e FULL JOIN p ON e.country = p.country")
def country_coverage(spark, sf):
    e = table(spark, sf, "customer").join(table(spark, sf, "orders"), F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").alias("country")).agg(F.count("*").alias("events"))
    p = table(spark, sf, "supplier").where("s_acctbal > 8000").groupBy(F.col("s_nationkey").alias("country")).agg(F.count("*").alias("articles"))
    j = e.join(p, "country", "full_outer").na.fill(0, ["events", "articles"])
    return j.select("country", "events", "articles", F.when(F.col("articles") == 0, 0.0).otherwise(F.round(F.col("articles") / F.col("events"), 6)).alias("ratio"))


@query("SELECT n_nationkey AS country, o_orderpriority AS family FROM nation, (SELECT DISTINCT o_orderpriority FROM orders) EXCEPT SELECT s_nationkey, o_orderpriority FROM supplier JOIN orders ON s_suppkey = o_custkey WHERE s_acctbal > 5000")
def zero_cells(spark, sf):
    """Country x family cells without coverage: the grid of two small dimensions less the cells that occur."""
    families = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("family")).distinct()
    grid = table(spark, sf, "nation").select(F.col("n_nationkey").alias("country")).crossJoin(F.broadcast(families))
    held = table(spark, sf, "supplier").where("s_acctbal > 5000").join(table(spark, sf, "orders"), F.col("s_suppkey") == F.col("o_custkey")).select(F.col("s_nationkey").alias("country"), F.col("o_orderpriority").alias("family"))
    return grid.join(held, ["country", "family"], "left_anti").distinct()


@query("SELECT user_id, arg_max(event_id, (ts, value, event_id)) AS event_id, count(*) AS versions FROM events GROUP BY user_id")
def event_census_dedup(spark, sf):
    """The latest version of each, then the one of the greater value."""
    return table(spark, sf, "events").groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", "value", "event_id")).alias("event_id"), F.count("*").alias("versions"))


@query("SELECT source, lang, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY ROLLUP (source, lang)")
def rollup_by_source_lang(spark, sf):
    return table(spark, sf, "documents").rollup("source", "lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("SELECT tier, lang, count(*) AS n FROM a GROUP BY CUBE (tier, lang)", articles=True)
def cube_tiers(spark, sf):
    return articles(spark, sf).cube("tier", "lang").agg(F.count("*").alias("n"))


@query("WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w >= INTERVAL 30 MINUTE OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM g) SELECT user_id, count(DISTINCT session) AS sessions, count(*) AS n FROM s GROUP BY user_id")
def session_windows(spark, sf):
    s = table(spark, sf, "events").groupBy("user_id", F.session_window(F.col("ts").cast("timestamp"), "30 minutes")).agg(F.count("*").alias("c"))
    return s.groupBy("user_id").agg(F.count("*").alias("sessions"), F.sum("c").alias("n"))


@query("(SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O') EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal < 0")
def intersect_except(spark, sf):
    o = table(spark, sf, "orders")
    both = o.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k")).intersect(o.where("o_orderstatus = 'O'").select("o_custkey"))
    return both.exceptAll(table(spark, sf, "customer").where("c_acctbal < 0").select("c_custkey"))
