"""Revisions, the Merkle log, vectors, maintenance, evaluation and streams."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewire.functions import text as T
from tidewire.operators import merkle as M
from tidewire.operators import vectors as V
from tidewire.plans.registry import query
from tidewire.sources.tables import revisions, table
from tidewire.streaming import streams


@query("WITH h AS (SELECT conv_id AS article_id, turn, sha256(coalesce(text, '')) AS h FROM conversations), c AS (SELECT *, lag(h) OVER (PARTITION BY article_id ORDER BY turn) AS prev FROM h), k AS (SELECT * FROM c WHERE prev IS NULL OR prev <> h) SELECT article_id, turn, h AS content_hash, prev AS previous_hash, row_number() OVER (PARTITION BY article_id ORDER BY turn) AS revision_number FROM k")
def revision_numbering(spark, sf):
    w = Window.partitionBy("article_id").orderBy("revision")
    r = revisions(spark, sf).select("article_id", "revision", F.sha2(F.col("content").cast("binary"), 256).alias("content_hash"))
    changed = r.withColumn("previous_hash", F.lag("content_hash").over(w)).where("previous_hash IS NULL OR previous_hash <> content_hash")
    return changed.select("article_id", F.col("revision").alias("turn"), "content_hash", "previous_hash", F.row_number().over(w).alias("revision_number"))


@query("WITH c AS (SELECT role, coalesce(text, '') ILIKE '%correct%' OR coalesce(text, '') ILIKE '%update%' AS open FROM conversations) SELECT role, count(*) AS revisions, count(*) FILTER (WHERE NOT open) AS stealth, round(avg(CASE WHEN open THEN 0.0 ELSE 1.0 END), 6) AS rate FROM c GROUP BY role")
def stealth_rate(spark, sf):
    t = F.coalesce("text", F.lit(""))
    c = table(spark, sf, "conversations").select("role", (t.ilike("%correct%") | t.ilike("%update%")).alias("open"))
    return c.groupBy("role").agg(F.count("*").alias("revisions"), F.count_if(~F.col("open")).alias("stealth"), F.round(F.avg((~F.col("open")).cast("double")), 6).alias("rate"))


@query(r"SELECT conv_id, turn, len(list_filter(string_split(coalesce(text, ''), chr(10)), lambda p: regexp_matches(p, '(?i)\b(correction|editor|updated|clarification)\b'))) AS notices FROM conversations")
def correction_notices(spark, sf):
    found = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda p: p.rlike(r"(?i)\b(correction|editor|updated|clarification)\b"))
    return table(spark, sf, "conversations").select("conv_id", "turn", F.size(found).cast("long").alias("notices"))


def _leaves(spark, sf):
    return table(spark, sf, "documents").select(F.col("doc_id").alias("i"), M.leaf_hash(F.coalesce("text", F.lit(""))).alias("h"))


@query("SELECT doc_id AS i, sha256(unhex('00') || encode(coalesce(text, ''))) AS h FROM documents")
def leaf_hashes(spark, sf):
    return _leaves(spark, sf)


@query("""WITH RECURSIVE t AS (SELECT 0 AS lvl, list(sha256(unhex('00') || encode(coalesce(text, ''))) ORDER BY doc_id) AS h FROM documents UNION ALL
    SELECT lvl + 1, list_transform(range(1, len(h) + 1, 2), lambda k: CASE WHEN k = len(h) THEN h[k] ELSE sha256(unhex('01') || unhex(h[k]) || unhex(h[k + 1])) END) FROM t WHERE len(h) > 1)
    SELECT h[1] AS root FROM t WHERE len(h) = 1""")
def merkle_root(spark, sf):
    return M.root(_leaves(spark, sf))


@query("WITH e AS (SELECT label, unnest(embedding) AS x, unnest(range(1, len(embedding) + 1)) AS k FROM embeddings), m AS (SELECT label, k, avg(CAST(x AS DOUBLE)) AS x FROM e GROUP BY ALL) SELECT label, count(*) AS dimensions, round(sqrt(sum(x * x)), 5) AS norm FROM m GROUP BY label")
def embedding_centroids(spark, sf):
    c = V.centroids(table(spark, sf, "embeddings"), "label", "embedding")
    return c.select("label", F.size("centroid").cast("long").alias("dimensions"), F.round(V.norm("centroid"), 5).alias("norm"))


@query("""WITH q AS (SELECT vec_id AS q, embedding AS a FROM embeddings WHERE vec_id % 50 = 0), s AS (SELECT q, vec_id, round(list_cosine_similarity(CAST(a AS DOUBLE[]), CAST(embedding AS DOUBLE[])), 6) AS cosine FROM q, embeddings WHERE vec_id <> q),
    r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY cosine DESC, vec_id) AS nth FROM s) SELECT q, vec_id, cosine FROM r WHERE nth <= 10""")
def cosine_topk(spark, sf):
    """The ten nearest of every fiftieth vector, exactly, against all vectors in blocks."""
    e = table(spark, sf, "embeddings")
    return V.top_k(e.where("vec_id % 50 = 0"), e, "vec_id", "embedding", 10)


@query("SELECT l_suppkey AS name, count(*) AS n, count(*) FILTER (WHERE spent <= 1000) AS admitted FROM (SELECT l_suppkey, sum(l_quantity) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey ROWS UNBOUNDED PRECEDING) AS spent FROM lineitem) GROUP BY l_suppkey")
def budget_running_spend(spark, sf):
    w = Window.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber", "l_partkey").rowsBetween(Window.unboundedPreceding, 0)
    s = table(spark, sf, "lineitem").select("l_suppkey", F.sum("l_quantity").over(w).alias("spent"))
    return s.groupBy(F.col("l_suppkey").alias("name")).agg(F.count("*").alias("n"), F.count_if(F.col("spent") <= 1000).alias("admitted"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '1996-01-01' - INTERVAL 120 HOUR THEN 'expired' WHEN o_orderstatus = 'O' AND o_orderdate < TIMESTAMP '1996-01-01' - INTERVAL 168 HOUR THEN 'expired' ELSE o_orderstatus END AS status FROM orders")
def expire_stale(spark, sf):
    before = lambda h: F.col("o_orderdate").cast("timestamp") < F.expr(f"TIMESTAMP '1996-01-01 00:00:00' - INTERVAL {h} HOURS")
    status = F.when((F.col("o_orderstatus") == "P") & before(120), "expired").when((F.col("o_orderstatus") == "O") & before(168), "expired").otherwise(F.col("o_orderstatus"))
    return table(spark, sf, "orders").select("o_orderkey", status.alias("status"))


@query("SELECT source, count(*) AS n, count(*) FILTER (WHERE doc_id % 72 < 24) AS expired, coalesce(sum(length(text)) FILTER (WHERE doc_id % 72 < 24), 0)::BIGINT AS reclaimed FROM documents GROUP BY source")
def retention_preview(spark, sf):
    old = F.col("doc_id") % 72 < 24
    return table(spark, sf, "documents").groupBy("source").agg(F.count("*").alias("n"), F.count_if(old).alias("expired"), F.coalesce(F.sum(F.when(old, F.length("text"))), F.lit(0)).cast("long").alias("reclaimed"))


_RUNS = "WITH e AS (SELECT user_id, ts, event_id, event_type = 'error' AS empty FROM events), g AS (SELECT *, sum(CASE WHEN empty THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM e), r AS (SELECT user_id, island, count(*) FILTER (WHERE empty) AS run FROM g GROUP BY ALL)"


@query(f"{_RUNS} SELECT user_id, max(run) AS longest_run, max(run) >= 3 AS dead FROM r GROUP BY user_id")
def feed_health_runs(spark, sf):
    """Longest run of empty polls, as gaps and islands; three make a feed dead."""
    e = table(spark, sf, "events").select("user_id", "ts", "event_id", (F.col("event_type") == "error").alias("empty"))
    g = e.withColumn("island", F.sum(F.when(F.col("empty"), 0).otherwise(1)).over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    r = g.groupBy("user_id", "island").agg(F.count_if("empty").alias("run"))
    return r.groupBy("user_id").agg(F.max("run").alias("longest_run"), (F.max("run") >= 3).alias("dead"))


@query("WITH e AS (SELECT user_id, ts, event_id, CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS ok FROM events), r AS (SELECT user_id, count(*) OVER w AS tries, sum(ok) OVER w AS good FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) SELECT user_id, bool_or(tries >= 8 AND good < 0.6 * tries) AS opened FROM r GROUP BY user_id")
def circuit_breaker(spark, sf):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    e = table(spark, sf, "events").select("user_id", "ts", "event_id", F.when(F.col("event_type") == "error", 0).otherwise(1).alias("ok"))
    r = e.select("user_id", F.count("*").over(w).alias("tries"), F.coalesce(F.sum("ok").over(w), F.lit(0)).alias("good"))
    return r.groupBy("user_id").agg(F.bool_or((F.col("tries") >= 8) & (F.col("good") < 0.6 * F.col("tries"))).alias("opened"))


@query("WITH s AS (SELECT doc_id, lang, n_chars, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS nth FROM documents) SELECT doc_id, lang FROM s WHERE nth <= 20")
def stratified_sample(spark, sf):
    w = Window.partitionBy("lang").orderBy(F.desc("n_chars"), "doc_id")
    return table(spark, sf, "documents").select("doc_id", "lang", F.row_number().over(w).alias("nth")).where("nth <= 20").select("doc_id", "lang")


@query(r"""WITH t AS (SELECT conv_id, turn, lower(coalesce(text, '')) AS a, lower(coalesce(lag(text) OVER (PARTITION BY conv_id ORDER BY turn), '')) AS b FROM conversations),
    w AS (SELECT conv_id, turn, list_filter(regexp_split_to_array(a, '[\s\p{Z}]+'), lambda x: x <> '') AS a, list_filter(regexp_split_to_array(b, '[\s\p{Z}]+'), lambda x: x <> '') AS b FROM t),
    x AS (SELECT conv_id, turn, u AS word, count(*) AS n FROM (SELECT conv_id, turn, unnest(a) AS u FROM w) GROUP BY ALL), y AS (SELECT conv_id, turn, u AS word, count(*) AS n FROM (SELECT conv_id, turn, unnest(b) AS u FROM w) GROUP BY ALL),
    o AS (SELECT conv_id, turn, sum(least(x.n, y.n)) AS met FROM x JOIN y USING (conv_id, turn, word) GROUP BY ALL)
    SELECT w.conv_id, w.turn, CASE WHEN len(a) + len(b) = 0 THEN 0.0 ELSE round(2.0 * coalesce(met, 0) / (len(a) + len(b)), 6) END AS f1 FROM w LEFT JOIN o USING (conv_id, turn)""")
def token_f1(spark, sf):
    """Multiset overlap of each turn's words with those of the turn before."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    t = table(spark, sf, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("a"), F.coalesce(F.lag("text").over(w), F.lit("")).alias("b"))
    t = t.select("conv_id", "turn", T.words(F.col("a")).alias("a"), T.words(F.col("b")).alias("b"))
    count = lambda side: t.select("conv_id", "turn", F.explode(side).alias("word")).groupBy("conv_id", "turn", "word").agg(F.count("*").alias(side))
    both = count("a").join(count("b"), ["conv_id", "turn", "word"]).groupBy("conv_id", "turn").agg(F.sum(F.least("a", "b")).alias("both"))
    size = F.size("a") + F.size("b")
    return t.join(both, ["conv_id", "turn"], "left").select("conv_id", "turn", F.when(size == 0, 0.0).otherwise(F.round(F.try_divide(2.0 * F.coalesce("both", F.lit(0)), size), 6)).alias("f1"))


@query("SELECT CAST(floor(epoch(ts) / 86400) AS BIGINT) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def stream_day_counts(spark, sf):
    return streams.day_counts(spark, sf)


@query("SELECT CAST(floor(epoch(ts) / 900) * 900 AS BIGINT) AS start, count(*) AS n, max(value) AS most FROM events GROUP BY 1")
def stream_quarter_hours(spark, sf):
    return streams.quarter_hours(spark, sf)


@query("SELECT c.event_id AS click, p.event_id AS purchase FROM events c JOIN events p ON c.user_id = p.user_id AND p.ts > c.ts AND p.ts <= c.ts + INTERVAL 1 HOUR WHERE c.event_type = 'click' AND p.event_type = 'purchase'")
def stream_interval_join(spark, sf):
    return streams.cross_owner_matches(spark, sf)


@query("WITH e AS (SELECT user_id, ts, event_id, CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS ok FROM events), r AS (SELECT user_id, count(*) OVER w AS tries, sum(ok) OVER w AS good FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) SELECT user_id, count(*) AS tries, bool_or(tries >= 8 AND good < 0.6 * tries) AS opened FROM r GROUP BY user_id")
def stream_breakers(spark, sf):
    return streams.breaker_states(spark, sf)


@query("SELECT user_id, event_type, count(*) AS n FROM (SELECT DISTINCT user_id, event_type, date_trunc('hour', ts) FROM events) GROUP BY ALL")
def stream_dedup(spark, sf):
    return streams.hourly_distinct(spark, sf)


@query()
def minhash_estimate(spark, sf):
    """Signatures of 128 permutations over word shingles, and their estimate against the exact Jaccard of neighbouring turns."""
    return V.minhash_neighbours(revisions(spark, sf))


@query()
def leader_clusters(spark, sf):
    """Greedy leader clusters of the vectors of each label, in the order of their ids."""
    return V.leader_clusters(table(spark, sf, "embeddings"), "label", "vec_id", "embedding", 0.7)
