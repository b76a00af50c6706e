"""Streams over several late, unordered files against the batch; state that goes; windows with broken archives and a restart."""

import random
import zipfile

from pyspark.sql import functions as F

from tidewire.sources import windows as W
from tidewire.streaming import stateful as S

SF = "/root/testdata/sf0.001"


def unordered_files(spark, path, parts, shift):
    """The events in files by time, rows near a border exchanged with the next file (late, within an hour or so)."""
    rows = spark.read.parquet(f"{SF}/events.parquet").orderBy("ts").collect()
    rng, n = random.Random(3), len(rows)
    order = sorted(range(n), key=lambda k: k + rng.uniform(0, shift))
    for p in range(parts):
        part = [rows[k] for k in order[p * n // parts : (p + 1) * n // parts]]
        rng.shuffle(part)
        spark.createDataFrame(part, spark.read.parquet(f"{SF}/events.parquet").schema).coalesce(1).write.mode("append").parquet(path)


def test_late_files_give_the_batch_sessions(spark, tmp_path):
    unordered_files(spark, f"{tmp_path}/events", 5, 3)
    got = S.closed_stream(spark, f"{tmp_path}/events", lambda rows: S.sessions(rows, "user_id", "ts", "30 minutes", "12 hours"), files=1)
    got = got.where(F.col("begins") < F.lit(S.END).cast("timestamp"))
    e = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    want = e.groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count("*").alias("n")).select("user_id", "w.start", "w.end", "n")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def plain_runs(events, gap):
    out, run = [], {}
    for source, at, ok in events:
        if source in run and at - run[source][1] >= gap:
            out.append((source, run[source][0], *run[source][2:]))
            del run[source]
        begins, _, tries, good, opened = run.get(source, (at, at, 0, 0, False))
        run[source] = (begins, at, tries + 1, good + ok, opened or (tries >= 8 and good < 0.6 * tries))
    return sorted([*out, *((s, r[0], *r[2:]) for s, r in run.items())])


def test_breakers_forget_idle_sources(spark, tmp_path):
    """Many batches, each of new sources: results as in one pass, and the state never holds more than the sources of a few batches."""
    rows, at = [], 1_700_000_000
    rng = random.Random(1)
    for batch in range(8):
        part = []
        for k in range(60):
            at += 120
            part.append((len(rows) + k, at, f"s{batch}-{k % 5}", rng.random() < 0.5))
        rows += part
        df = spark.createDataFrame(part, "event_id long, at long, source string, ok boolean").select("event_id", F.timestamp_seconds("at").alias("ts"), "source", "ok")
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/polls")
    sizes = []

    class Listener(__import__("pyspark").sql.streaming.StreamingQueryListener):
        def onQueryStarted(self, event):
            pass

        def onQueryProgress(self, event):
            sizes.extend(o.numRowsTotal for o in event.progress.stateOperators)

        def onQueryTerminated(self, event):
            pass

    listener = Listener()
    spark.streams.addListener(listener)
    got = S.closed_stream(spark, f"{tmp_path}/polls", lambda r: S.breaker_runs(r, "10 minutes", hours=1), files=1)
    got = sorted(map(tuple, got.collect()))
    spark.streams.removeListener(listener)
    want = plain_runs([(s, t * 1000, ok) for _, t, s, ok in rows], 3_600_000)
    assert got == want
    assert not sizes or max(sizes) <= 3 * 5 * 2


def archive(path, lines, cut=0):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("member.csv", "".join(f"{x}\n" for x in lines))
    if cut:
        raw = open(path, "rb").read()
        open(path, "wb").write(raw[:-cut])


def test_windows_skip_what_is_broken_and_go_on_after_a_restart(spark, tmp_path):
    folder = f"{tmp_path}/in"
    __import__("os").makedirs(folder)
    stamps = [f"2024010100{m:02d}00" for m in (0, 15, 30, 45)]
    for k, s in enumerate(stamps):
        archive(f"{folder}/{s}.export.zip", [f"{k}{j}\thttps://n.example/{j}\tx" for j in range(4)] + [f"{k}9\thttps://n.example/1\tx", "short"], cut=25 if k == 1 else 0)
        if k != 2:
            archive(f"{folder}/{s}.gkg.zip", [f"g{k}{j}\thttps://n.example/{j}\ty" for j in (1, 7)] + ["g\t\ty"])
    spark.dataSource.register(W.Windows)

    def put(batch, epoch):
        batch.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{tmp_path}/out/batch={epoch}")

    for upto in (0, 2, 2, 4):
        with open(f"{folder}/manifest.txt", "w") as f:
            f.writelines(f"12 abc http://x/{s}.export.CSV.zip\nnoise\n" for s in stamps[:upto])
        spark.readStream.format("windows").option("path", folder).load().writeStream.option("checkpointLocation", f"{tmp_path}/log").foreachBatch(put).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.schema(W.SCHEMA).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/out")
    faults = {(r.stamp, r.kind): r.fault for r in got.where("fault IS NOT NULL").collect()}
    assert faults.keys() == {(stamps[1], "export"), (stamps[2], "gkg")} and faults[stamps[2], "gkg"] == "missing"
    j = sorted((r.stamp, r.url[-1], r.event[0] if r.event else None) for r in W.joined(got, 3, 1, 1).collect())
    assert j == [(stamps[0], "1", "09"), (stamps[0], "7", None), (stamps[1], "1", None), (stamps[1], "7", None), (stamps[3], "1", "39"), (stamps[3], "7", None)]
