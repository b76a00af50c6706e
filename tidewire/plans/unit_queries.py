"""Reporting units, corroboration and the gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire.operators import units as U
from tidewire.plans.registry import query
from tidewire.plans.text_queries import SHINGLES
from tidewire.sources.tables import articles, table

#: Articles in day buckets: the fetch time of the projection spans three days.
_UNITS = f"""{SHINGLES},
    d AS (SELECT id, CAST(floor(fetched / 86400) AS BIGINT) AS day, owner, tier, domain, body FROM a),
    e AS (SELECT id, day, unnest(s) AS x, len(s) AS n FROM sh JOIN d USING (id)),
    i AS (SELECT l.id AS a, r.id AS b, count(*) AS inter, least(any_value(l.n), any_value(r.n)) AS lo, greatest(any_value(l.n), any_value(r.n)) AS hi
          FROM e l JOIN e r ON l.day = r.day AND l.x = r.x AND l.id < r.id GROUP BY l.id, r.id),
    p AS (SELECT a, b, inter FROM i WHERE inter >= 0.9 * lo - 1e-9 AND inter >= 0.5 * hi - 1e-9 AND inter >= least(5, lo)),
    g AS (SELECT a AS x, b AS y FROM p UNION ALL SELECT b, a FROM p),
    reach AS (SELECT id AS node, id AS root FROM d UNION SELECT g.y, reach.root FROM reach JOIN g ON g.x = reach.node AND reach.root < g.y),
    u AS (SELECT node AS id, min(root) AS unit_id FROM reach GROUP BY node),
    j AS (SELECT u.unit_id, d.* FROM u JOIN d USING (id))"""


def days(spark, sf):
    return articles(spark, sf).withColumn("day", F.floor(F.col("fetched") / 86400))


@query(f"WITH {_UNITS} SELECT id, day, unit_id FROM j", articles=True)
def reporting_units(spark, sf):
    return U.reporting_units(days(spark, sf))


@query(f"""WITH {_UNITS} SELECT unit_id, count(*) AS article_count, count(DISTINCT owner) AS distinct_owners, count(DISTINCT tier) AS tiers, count(*) FILTER (WHERE tier = 1) AS tier1_articles,
    count(DISTINCT owner) FILTER (WHERE tier = 1) AS tier1_owners, arg_min(id, (-length(body), id)) AS representative_id FROM j GROUP BY unit_id""", articles=True)
def unit_rollup(spark, sf):
    a = days(spark, sf)
    return U.unit_rollup(a, U.reporting_units(a))


@query(f"""WITH {_UNITS} SELECT domain, count(DISTINCT unit_id) AS units, count(DISTINCT owner) AS owners, count(DISTINCT unit_id) >= 2 AND count(DISTINCT owner) >= 2 AS passed,
    CASE WHEN count(DISTINCT unit_id) < 2 THEN 'units ' || count(DISTINCT unit_id) || ' < 2' WHEN count(DISTINCT owner) < 2 THEN 'owners ' || count(DISTINCT owner) || ' < 2' ELSE 'passed' END AS reason
    FROM (SELECT lang AS domain, unit_id, j.owner FROM j JOIN a USING (id) WHERE j.tier = 1) GROUP BY domain""", articles=True)
def tier1_gate(spark, sf):
    """The boolean gate over tier-1 units, with a language as the story."""
    a = days(spark, sf)
    tier1 = a.where("tier = 1").select("id", F.col("lang").alias("domain"), "owner").join(U.reporting_units(a).select("id", "unit_id"), "id")
    return U.tier1_gate(tier1, "domain")


#: Orders stand for stories, their parts for units (a part's size is its article count), a supplier for a source with its tier and
#: owner; a returned line is an allegation, every third customer a person.
_SCORE = """k AS (SELECT l_orderkey AS story, l_partkey AS unit, 1 + l_suppkey % 4 AS tier, l_suppkey % 7 AS owner, p_size AS size, l_returnflag AS flag FROM lineitem JOIN part ON p_partkey = l_partkey),
    s AS (SELECT story, count(DISTINCT owner) FILTER (WHERE tier = 1) AS owners, count(DISTINCT unit) FILTER (WHERE tier = 1) AS units, coalesce(max(size) FILTER (WHERE tier >= 3), 0) AS virality, bool_or(flag = 'R') AND any_value(o_custkey) % 3 = 0 AS harm FROM k JOIN orders ON o_orderkey = story GROUP BY story),
    t AS (SELECT *, owners >= 2 AND units >= 2 AS ok FROM s),
    v AS (SELECT story, owners, units, ok AS gate_passed, CAST(greatest(0, least(100, CASE WHEN ok THEN 40 + least(owners * 10, 30) + least(owners * 5, 20) ELSE 0 END + least(virality * 2, 10) - CASE WHEN harm THEN 20 ELSE 0 END)) AS BIGINT) AS score, CASE WHEN harm THEN 70 ELSE 50 END AS threshold FROM t)"""


def _scored(spark, sf):
    """Admission scores: independence, owners, virality of tier 3 and 4 units, less harm, which also raises the bar."""
    size = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").alias("size"))
    person = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % 3 == 0).alias("person"))
    n = F.col("l_suppkey")
    k = table(spark, sf, "lineitem").join(size, "l_partkey").select(F.col("l_orderkey"), "l_partkey", (1 + n % 4).alias("tier"), (n % 7).alias("owner"), "size", F.col("l_returnflag").alias("flag"))
    first = F.col("tier") == 1
    s = k.groupBy("l_orderkey").agg(
        F.countDistinct(F.when(first, F.col("owner"))).alias("owners"), F.countDistinct(F.when(first, F.col("l_partkey"))).alias("units"),
        F.coalesce(F.max(F.when(F.col("tier") >= 3, F.col("size"))), F.lit(0)).alias("virality"), F.bool_or(F.col("flag") == "R").alias("alleged"),
    ).join(person, "l_orderkey").select(F.col("l_orderkey").alias("story"), "owners", "units", "virality", (F.col("alleged") & F.col("person")).alias("harm"))
    ok = (F.col("owners") >= 2) & (F.col("units") >= 2)
    base = F.when(ok, 40 + F.least(F.col("owners") * 10, F.lit(30)) + F.least(F.col("owners") * 5, F.lit(20))).otherwise(0) + F.least(F.col("virality") * 2, F.lit(10))
    score = F.greatest(F.lit(0), F.least(F.lit(100), base - F.when(F.col("harm"), 20).otherwise(0))).cast("long")
    return s.select("story", "owners", "units", ok.alias("gate_passed"), score.alias("score"), F.when(F.col("harm"), 70).otherwise(50).alias("threshold"))


@query(f"WITH {_SCORE} SELECT *, score >= threshold AS admitted FROM v")
def admission_score(spark, sf):
    return _scored(spark, sf).withColumn("admitted", F.col("score") >= F.col("threshold"))


@query(f"WITH {_SCORE} SELECT count(*) AS stories, count(*) FILTER (WHERE gate_passed <> (score >= threshold)) AS disagree, round(avg(CASE WHEN gate_passed <> (score >= threshold) THEN 1.0 ELSE 0.0 END), 6) AS rate FROM v")
def gate_disagreement(spark, sf):
    off = F.col("gate_passed") != (F.col("score") >= F.col("threshold"))
    return _scored(spark, sf).agg(F.count("*").alias("stories"), F.count_if(off).alias("disagree"), F.round(F.avg(off.cast("double")), 6).alias("rate"))


@query(f"WITH {_SCORE} SELECT story, 'tier1' AS gate_name, gate_passed AS passed, sha256(concat_ws('|', story, owners, units, score)) AS input_hash FROM v UNION ALL SELECT story, 'dynamic', score >= threshold, sha256(concat_ws('|', story, owners, units, score)) FROM v")
def gate_decision_ledger(spark, sf):
    s = _scored(spark, sf).withColumn("input_hash", F.sha2(F.concat_ws("|", "story", F.col("owners").cast("string"), F.col("units").cast("string"), F.col("score").cast("string")).cast("binary"), 256))
    gates = F.array(F.struct(F.lit("tier1").alias("gate_name"), F.col("gate_passed").alias("passed")), F.struct(F.lit("dynamic").alias("gate_name"), (F.col("score") >= F.col("threshold")).alias("passed")))
    return s.select("story", F.explode(gates).alias("g"), "input_hash").select("story", "g.gate_name", "g.passed", "input_hash")


@query("""SELECT lang AS story, count(*) FILTER (WHERE tier = 1) AS tier1, count(*) FILTER (WHERE tier = 2) AS tier2, count(*) FILTER (WHERE tier = 3) AS tier3, count(*) FILTER (WHERE tier = 4) AS tier4, count(DISTINCT owner) AS distinct_owners FROM a GROUP BY lang""", articles=True)
def story_counters(spark, sf):
    a = articles(spark, sf)
    return a.groupBy(F.col("lang").alias("story")).agg(*[F.count_if(F.col("tier") == t).alias(f"tier{t}") for t in (1, 2, 3, 4)], F.countDistinct("owner").alias("distinct_owners"))


@query("""SELECT doc_id, string_agg(item_id, ',' ORDER BY item_id) AS items, count(*) AS n FROM (SELECT doc_id, item_id FROM documents JOIN benchmark ON contains(documents.text, benchmark.text)) GROUP BY doc_id""")
def benchmark_containment(spark, sf):
    """Documents that hold a whole benchmark passage: joined on the hash of its second to eighth words, then compared.

    Its first and last words may be parts of a document's words, those between are whole; shorter passages are compared directly.
    """
    docs = table(spark, sf, "documents").select("doc_id", "text", F.split("text", r"[ \n]").alias("w"))
    keys = F.array_distinct(F.transform(F.sequence(F.lit(1), F.size("w")), lambda i: F.xxhash64(F.array_join(F.slice("w", i, 7), " "))))
    spread = docs.select("doc_id", F.explode(keys).alias("k"))
    items = table(spark, sf, "benchmark").select("item_id", F.col("text").alias("passage"), F.split("text", r"[ \n]").alias("pw"))
    long = items.where("size(pw) >= 9").select("item_id", F.xxhash64(F.array_join(F.slice("pw", 2, 7), " ")).alias("k"))
    short = docs.join(items.where("size(pw) < 9"), F.contains("text", F.col("passage"))).select("doc_id", "item_id")
    near = spread.join(long, "k").select("doc_id", "item_id").unionByName(short).distinct()
    met = near.join(table(spark, sf, "documents").select("doc_id", "text"), "doc_id").join(items.select("item_id", "passage"), "item_id").where(F.contains("text", F.col("passage")))
    return met.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_list("item_id")), ",").alias("items"), F.count("*").alias("n"))
