"""Claims, reliability, topics and verdicts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewire.plans.registry import query
from tidewire.sources.tables import evidence, table

_EVIDENCE = """v AS (SELECT l_orderkey AS claim_id, l_suppkey AS domain, p_brand AS topic, CASE l_returnflag WHEN 'A' THEN 'disputes' WHEN 'R' THEN 'supports' ELSE 'neutral' END AS stance, CAST(l_quantity AS INTEGER) AS confidence
    FROM lineitem JOIN part ON l_partkey = p_partkey)"""


@query(f"""WITH {_EVIDENCE}, m AS (SELECT *, sum(CASE stance WHEN 'supports' THEN confidence ELSE 0 END) OVER (PARTITION BY claim_id) AS pro, sum(CASE stance WHEN 'disputes' THEN confidence ELSE 0 END) OVER (PARTITION BY claim_id) AS con,
        count(*) FILTER (WHERE stance <> 'neutral') OVER (PARTITION BY claim_id) AS voices FROM v),
    k AS (SELECT domain, topic, (stance = 'supports') = (pro >= con) AS agrees FROM m WHERE voices >= 2 AND stance <> 'neutral')
    SELECT domain, topic, CAST(round_even(100.0 * count(*) FILTER (WHERE agrees) / count(*), 0) AS INTEGER) AS score, count(*) AS sample_size FROM k GROUP BY domain, topic HAVING count(*) >= 3""")
def claim_majority_reliability(spark, sf):
    """Agreement with the confidence-weighted majority of each claim; ties support; at least two voices and three samples."""
    claim = Window.partitionBy("claim_id")
    side = lambda s: F.sum(F.when(F.col("stance") == s, F.col("confidence")).otherwise(0)).over(claim)
    m = evidence(spark, sf).select("*", side("supports").alias("pro"), side("disputes").alias("con"), F.count_if(F.col("stance") != "neutral").over(claim).alias("voices"))
    k = m.where("voices >= 2 AND stance <> 'neutral'").withColumn("agrees", (F.col("stance") == "supports") == (F.col("pro") >= F.col("con")))
    out = k.groupBy("domain", "topic").agg(F.count_if("agrees").alias("agree"), F.count("*").alias("sample_size")).where("sample_size >= 3")
    return out.select("domain", "topic", F.bround(100.0 * F.col("agree") / F.col("sample_size"), 0).cast("int").alias("score"), "sample_size")


_FACTS = """f AS (SELECT source AS domain, CASE WHEN quality = 1 AND toxic = 0 THEN 'true' WHEN quality = 0 AND toxic = 1 THEN 'false' ELSE 'mixed' END AS verdict, quality, toxic, doc_id FROM labels JOIN documents USING (doc_id))"""


def _facts(spark, sf):
    verdict = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "true").when((F.col("quality") == 0) & (F.col("toxic") == 1), "false").otherwise("mixed")
    return table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", F.col("source").alias("domain")), "doc_id").select("domain", verdict.alias("verdict"), "quality", "toxic", "doc_id")


@query(f"""WITH {_FACTS} SELECT domain, count(*) FILTER (WHERE verdict = 'true') AS n_true, count(*) FILTER (WHERE verdict = 'false') AS n_false, count(*) FILTER (WHERE verdict = 'mixed') AS n_mixed, CAST(trunc(100.0 * count(*) FILTER (WHERE verdict = 'true') / count(*)) AS INTEGER) AS accuracy FROM f GROUP BY domain""")
def fact_check_accuracy(spark, sf):
    g = _facts(spark, sf).groupBy("domain").agg(*[F.count_if(F.col("verdict") == v).alias(f"n_{v}") for v in ("true", "false", "mixed")], F.count("*").alias("n"))
    return g.select("domain", "n_true", "n_false", "n_mixed", F.coalesce(F.try_divide(100.0 * F.col("n_true"), F.col("n")), F.lit(50.0)).cast("int").alias("accuracy"))


@query(f"""WITH {_FACTS}, c AS (SELECT domain, count(*) FILTER (WHERE toxic = 1) AS corrections FROM f GROUP BY domain), n AS (SELECT source AS domain, count(*) AS articles FROM documents GROUP BY source)
    SELECT domain, coalesce(corrections, 0) AS corrections, articles, CAST(trunc(100.0 * coalesce(corrections, 0) / articles) AS INTEGER) AS rate FROM n LEFT JOIN c USING (domain)""")
def correction_rate(spark, sf):
    c = _facts(spark, sf).groupBy("domain").agg(F.count_if(F.col("toxic") == 1).alias("corrections"))
    n = table(spark, sf, "documents").groupBy(F.col("source").alias("domain")).agg(F.count("*").alias("articles"))
    j = n.join(c, "domain", "left").withColumn("corrections", F.coalesce("corrections", F.lit(0)))
    return j.select("domain", "corrections", "articles", F.coalesce(F.try_divide(100.0 * F.col("corrections"), F.col("articles")), F.lit(0.0)).cast("int").alias("rate"))


@query(f"""WITH {_FACTS}, g AS (SELECT domain, CAST(trunc(100.0 * count(*) FILTER (WHERE verdict = 'true') / count(*)) AS INTEGER) AS fact, CAST(trunc(100.0 * count(*) FILTER (WHERE toxic = 1) / count(*)) AS INTEGER) AS correction, CAST(trunc(100 * avg(quality)) AS INTEGER) AS consensus FROM f GROUP BY domain)
    SELECT *, CAST(trunc(0.4 * fact + 0.2 * (100 - correction) + 0.3 * consensus + 0.1 * 50) AS INTEGER) AS composite FROM g""")
def reliability_snapshot(spark, sf):
    g = _facts(spark, sf).groupBy("domain").agg(
        (100.0 * F.count_if(F.col("verdict") == "true") / F.count("*")).cast("int").alias("fact"), (100.0 * F.count_if(F.col("toxic") == 1) / F.count("*")).cast("int").alias("correction"), (100 * F.avg("quality")).cast("int").alias("consensus"))
    d = lambda x: F.lit(x).cast("decimal(3,1)")
    return g.withColumn("composite", (d(0.4) * F.col("fact") + d(0.2) * (100 - F.col("correction")) + d(0.3) * F.col("consensus") + 5).cast("int"))


@query("""WITH r AS (SELECT source AS domain, CASE WHEN quality = 1 AND toxic = 0 THEN 1.0 WHEN quality = 1 THEN 0.75 WHEN toxic = 0 THEN 0.25 ELSE 0.0 END AS s, CASE doc_id % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 0.8 ELSE 0.7 END AS w, (50 + doc_id % 50) / 100.0 AS c FROM labels JOIN documents USING (doc_id)),
    t AS (SELECT domain, round(CAST(sum(CAST(s * w * c AS DOUBLE)) / sum(CAST(w * c AS DOUBLE)) AS DOUBLE), 6) AS score, count(*) AS checks FROM r GROUP BY domain)
    SELECT domain, score, checks, CASE WHEN score >= 0.875 THEN 'true' WHEN score >= 0.625 THEN 'mostly_true' WHEN score >= 0.375 THEN 'mixed' WHEN score >= 0.125 THEN 'mostly_false' ELSE 'false' END AS verdict FROM t""")
def verdict_aggregation(spark, sf):
    f = _facts(spark, sf)
    s = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), 1.0).when(F.col("quality") == 1, 0.75).when(F.col("toxic") == 0, 0.25).otherwise(0.0)
    w = F.element_at(F.array(F.lit(1.0), F.lit(0.8), F.lit(0.7)), (F.col("doc_id") % 3 + 1).cast("int"))
    c = (50 + F.col("doc_id") % 50) / 100
    t = f.groupBy("domain").agg(F.round(F.sum(s * w * c) / F.sum(w * c), 6).alias("score"), F.count("*").alias("checks"))
    band = F.when(F.col("score") >= 0.875, "true").when(F.col("score") >= 0.625, "mostly_true").when(F.col("score") >= 0.375, "mixed").when(F.col("score") >= 0.125, "mostly_false").otherwise("false")
    return t.select("domain", "score", "checks", band.alias("verdict"))


@query("""WITH s AS (SELECT l_suppkey AS domain, date_trunc('month', l_shipdate) AS month, CAST(trunc(avg(l_quantity) * 2) AS INTEGER) AS score, count(*) AS n FROM lineitem GROUP BY ALL)
    SELECT domain, arg_max(score, month) AS score, CAST(epoch(max(month)) AS BIGINT) AS snapshot, count(*) AS snapshots FROM s GROUP BY domain""")
def latest_reliability(spark, sf):
    """The newest of each source's monthly snapshots: aggregated, then one maximum for each source."""
    month = F.date_trunc("month", F.col("l_shipdate").cast("timestamp"))
    s = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("domain"), month.alias("month")).agg((F.avg("l_quantity") * 2).cast("int").alias("score"))
    return s.groupBy("domain").agg(F.max_by("score", "month").alias("score"), F.unix_timestamp(F.max("month")).alias("snapshot"), F.count("*").alias("snapshots"))


@query("""WITH RECURSIVE t AS (SELECT r_regionkey AS key, r_name AS path, 0 AS depth FROM region UNION ALL SELECT n_nationkey + 100, t.path || ' > ' || n_name, 1 FROM nation JOIN t ON t.depth = 0 AND n_regionkey = t.key) SELECT key, path, depth FROM t""")
def topic_tree_paths(spark, sf):
    """The tree's depth is fixed, so a level is one join."""
    top = table(spark, sf, "region").select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("path"), F.lit(0).alias("depth"))
    below = table(spark, sf, "nation").join(top, F.col("n_regionkey") == F.col("key")).select((F.col("n_nationkey") + 100).alias("key"), F.concat_ws(" > ", "path", "n_name").alias("path"), F.lit(1).alias("depth"))
    return top.unionByName(below)
