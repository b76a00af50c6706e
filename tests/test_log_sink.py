"""The log that is appended to in batches, and the table that is committed to, under repeats and faults."""

import hashlib
import random

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidewire.functions.hashes import GENESIS
from tidewire.operators import log as L
from tidewire.sources import committed as C

h = lambda b: hashlib.sha256(b).digest()


def plain_root(payloads):
    level = [h(b"\0" + h(p.encode())) for p in payloads]
    while len(level) > 1:
        level = [h(b"\1" + level[k] + level[k + 1]) if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)]
    return level[0].hex() if level else None


def plain_chain(payloads):
    c = bytes.fromhex(GENESIS)
    for p in payloads:
        c = h(c + h(p.encode()))
    return c.hex()


@pytest.mark.parametrize("seed", range(8))
def test_merging_any_parts_gives_the_root(seed):
    rng = random.Random(seed)
    payloads = [f"p{k}" for k in range(rng.randrange(1, 300))]
    frontier, at = [], 0
    while at < len(payloads):
        n = rng.randrange(1, 60)
        frontier = L.merged([*frontier, *L.merged([(0, at + k, h(b"\0" + h(p.encode())).hex()) for k, p in enumerate(payloads[at : at + n])])])
        at += n
    assert L.root_of(frontier) == plain_root(payloads) and len(frontier) == bin(len(payloads)).count("1")


def test_batches_append_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(L, "WIDTH", 3)
    payloads, at, heads = [f"entry {k} é" for k in range(150)], 0, []
    for b, n in enumerate((37, 1, 0, 64, 48)):
        rows = spark.createDataFrame([(k, payloads[k]) for k in range(at, at + n)], "k long, payload string").repartition(3)
        at += n
        head = L.append(rows, f"{tmp_path}/log", f"b{b}", ["k"])
        assert (head["size"], head["root"], head["chain"]) == (at, plain_root(payloads[:at]), plain_chain(payloads[:at]))
        again = L.append(rows, f"{tmp_path}/log", f"b{b}", ["k"])
        assert (again["size"], again["root"]) == (head["size"], head["root"])
        heads.append(head)
    got = L.entries(spark, f"{tmp_path}/log")
    assert [tuple(r) for r in got.orderBy("idx").select("idx", "payload").collect()] == list(enumerate(payloads))
    assert L.broken_links(got).count() == 0


def test_a_batch_that_failed_is_written_anew(spark, tmp_path):
    rows = spark.createDataFrame([(k, f"x{k}") for k in range(20)], "k long, payload string")
    L.append(rows, f"{tmp_path}/log", "one", ["k"])
    # Entries of a batch whose head was never written are no part of the log.
    rows.selectExpr("k AS idx", "payload", "payload AS leaf", "payload AS chain").write.parquet(f"{tmp_path}/log/entries/batch=two")
    assert L.entries(spark, f"{tmp_path}/log").count() == 20
    head = L.append(rows.limit(7), f"{tmp_path}/log", "two", ["k"])
    assert head["size"] == 27 and L.entries(spark, f"{tmp_path}/log").count() == 27


def test_changed_entries_break_links(spark, tmp_path):
    rows = spark.createDataFrame([(k, f"x{k}") for k in range(12)], "k long, payload string")
    L.append(rows, f"{tmp_path}/log", "one", ["k"])
    log = L.entries(spark, f"{tmp_path}/log")
    other = log.withColumn("payload", F.when(F.col("idx") == 4, "other").otherwise(F.col("payload")))
    assert [tuple(r) for r in L.broken_links(other).collect()] == [(4, "payload")]
    forged = other.withColumn("leaf", F.sha2(F.col("payload").cast("binary"), 256))
    assert [tuple(r) for r in L.broken_links(forged).collect()] == [(4, "chain")]
    assert [tuple(r) for r in L.broken_links(log.where("idx <> 7")).collect()] == [(8, "gap")]


# The committed table


def test_repeated_batches_count_once(spark, tmp_path):
    rows = spark.range(100).selectExpr("CAST(id % 7 AS STRING) AS key", "id AS n").repartition(4)
    for _ in range(3):
        C.put(rows, f"{tmp_path}/t", "b1")
    # Two writers that did not know of each other: the manifest that is there first stays.
    spark.dataSource.register(C.Committed)
    rows.write.format("committed").mode("append").option("path", f"{tmp_path}/t").option("batch", "b1").save()
    C.put(rows.limit(10), f"{tmp_path}/t", "b2")
    got = C.read(spark, f"{tmp_path}/t", "key string, n long")
    assert got.groupBy("batch").count().orderBy("batch").collect() == [("b1", 100), ("b2", 10)]
    want = rows.unionByName(rows.limit(10)).groupBy("key").agg(F.sum("n").alias("n"))
    assert sorted(C.counters(spark, f"{tmp_path}/t", "key string", "n").collect()) == sorted(want.collect())
    import os

    assert len(os.listdir(f"{tmp_path}/t/files")) == sum(len(m["files"]) for m in C.manifests(f"{tmp_path}/t"))


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    rows = spark.range(50).selectExpr("CAST(id AS STRING) AS key", "id AS n").repartition(3)
    C.put(rows, f"{tmp_path}/t", "b1")
    with pytest.raises(Exception, match="half way"):
        C.put(rows, f"{tmp_path}/t", "b2", fails="fault")
    assert C.read(spark, f"{tmp_path}/t", "key string, n long").count() == 50
    C.put(rows, f"{tmp_path}/t", "b2", fails="fault")  # the fault has passed
    assert C.read(spark, f"{tmp_path}/t", "key string, n long").count() == 100
    assert C.read(spark, f"{tmp_path}/none", "key string").count() == 0


def test_faults_that_pass_are_retried():
    tries = []

    def action():
        tries.append(1)
        if len(tries) < 3:
            raise OSError("busy")
        return "done"

    assert C.with_retry(action, wait=0.001) == "done" and len(tries) == 3
    with pytest.raises(OSError):
        C.with_retry(lambda: (_ for _ in ()).throw(OSError("gone")), tries=2, wait=0.001)


def test_session_is_shared(spark):
    assert SparkSession.getActiveSession() is spark
