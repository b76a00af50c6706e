"""Signatures: the same hashes as Spark's own, without one expression for each shingle and seed."""

from pyspark.sql import functions as F

from tidewire.operators import vectors as V


def test_signatures_are_least_hashes(spark):
    rows = [(0, [""]), (1, ["a b c", "é ü", "x" * 100]), (2, [f"w{k}" for k in range(5000)]), (3, None), (4, [])]
    df = spark.createDataFrame(rows, "i int, s array<string>")
    got = V.minhash(df, "s", "sig", 70)
    want = F.transform(F.sequence(F.lit(1), F.lit(70)), lambda k: F.array_min(F.transform("s", lambda x: F.xxhash64(x, k))))
    assert got.where(F.col("sig").eqNullSafe(want)).count() == len(rows)
    # A shingle is hashed once: the seeds are not in the plan.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64") == 1 and "sequence(1, 70" not in plan and "array_min" not in plan
