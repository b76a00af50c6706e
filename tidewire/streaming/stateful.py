"""Streams whose state goes when its time is over: merging session windows, and breakers that forget idle sources.

State is kept by Spark (session windows) or by a stateful processor with event-time timers; both are bounded by the keys that were
active within the gap before the watermark. What is still open when a stream ends is closed by a marker row far in the future,
sent in a second run from the same checkpoint: it moves the watermark on and is itself
no result: its session begins at END, and a breaker has no source of its name. No filter on the key may stand in the stream, as Spark
would push it below the watermark and the marker would not move that.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidewire.operators.graph import shared_dir

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: A gap without polls after which a source's breaker begins anew.
IDLE_HOURS = 6
#: When the marker is: later than any row.
END = "2200-01-01 00:00:00"


def closed_stream(spark: SparkSession, path: str, build: Callable[[DataFrame], DataFrame], time: str = "ts", files: int | None = None) -> DataFrame:
    """All rows of an appending stream over the Parquet files at path, those included that only the end of the stream closes.

    The first run takes what is there, a batch for each so many files; the second one resumes from the checkpoint and adds the
    marker. A batch's rows go to a folder of its own, written anew if the batch is repeated.
    """
    at = f"{shared_dir(spark)}/tidewire/{uuid.uuid4().hex}"
    schema = spark.read.parquet(path).schema
    marks = spark.createDataFrame([], schema)
    marks.write.parquet(f"{at}/marks")
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files or 1000).parquet(f"{path}*")
    ends = spark.readStream.schema(schema).parquet(f"{at}/marks")
    both = rows.unionByName(ends).withColumn(time, F.col(time).cast("timestamp"))
    stream = build(both)
    out = stream.schema

    def put(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{at}/out/batch={epoch}")

    def run() -> None:
        query = stream.writeStream.outputMode("append").option("checkpointLocation", f"{at}/log").trigger(availableNow=True).foreachBatch(put).start()
        query.awaitTermination()

    run()
    end = spark.range(1).select(*[(F.lit(END).cast("timestamp").cast(f.dataType) if f.name == time else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])
    end.write.mode("append").parquet(f"{at}/marks")
    run()
    return spark.read.schema(out).option("recursiveFileLookup", "true").parquet(f"{at}/out")


def sessions(rows: DataFrame, key: str, time: str, gap: str, late: str) -> DataFrame:
    """Session windows of a stream: (key, begins, ends, n), each once, when the watermark has passed its end.

    A row that comes late, between two open sessions, merges them; one later than the watermark is passed over.
    """
    w = rows.withWatermark(time, late).groupBy(key, F.session_window(time, gap).alias("w")).agg(F.count("*").alias("n"))
    return w.select(key, F.col("w.start").alias("begins"), F.col("w.end").alias("ends"), "n")


class Breaker(StatefulProcessor):
    """Polls of one source: tries and good ones since it was last idle, and the latch that opens below a share of good ones.

    An event-time timer stands at the last poll and the gap; when the watermark passes it, the run is given out and the state goes.
    Rows of a batch are taken in their order; a poll after the gap closes the run before it at once.
    """

    def __init__(self, gap_ms: int, least: int, share: float):
        self.gap, self.least, self.share = gap_ms, least, share

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "begins long, last long, tries long, good long, opened boolean")

    def handleInputRows(self, key, rows, timerValues):
        if key[0] is None or pd.isna(key[0]):  # no source: the marker that closes a stream, or a broken row
            yield self._rows(key, [])
            return
        polls = pd.concat(list(rows)).sort_values(["at", "event_id"])
        run, out = (tuple(self.run.get()) if self.run.exists() else None), []
        before = run[1] if run else None
        for at, ok in zip(polls["at"].tolist(), polls["ok"].tolist(), strict=True):
            if run and at - run[1] >= self.gap:
                out.append(run)
                run = None
            begins, last, tries, good, opened = run or (at, at, 0, 0, False)
            opened = bool(opened or (tries >= self.least and good < self.share * tries))
            run = (min(begins, at), max(last, at), tries + 1, good + int(ok), opened)
        if before is not None and before != run[1]:
            self.handle.deleteTimer(before + self.gap)
        self.handle.registerTimer(run[1] + self.gap)
        self.run.update(run)
        yield self._rows(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        run = tuple(self.run.get()) if self.run.exists() else None
        if run and run[1] + self.gap <= expiredTimerInfo.getExpiryTimeInMs():
            self.run.clear()
            yield self._rows(key, [run])

    def close(self) -> None:
        pass

    @staticmethod
    def _rows(key, runs) -> pd.DataFrame:
        return pd.DataFrame([(key[0], r[0], r[2], r[3], r[4]) for r in runs], columns=["source", "begins", "tries", "good", "opened"]).astype({"tries": "int64", "good": "int64", "begins": "int64", "opened": "bool"})


def breaker_runs(polls: DataFrame, late: str, hours: float = IDLE_HOURS, least: int = 8, share: float = 0.6) -> DataFrame:
    """(source, begins in milliseconds, tries, good, opened) for each run of polls (source, ts, event_id, ok) without an idle gap."""
    spark = polls.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKS:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    rows = polls.withWatermark("ts", late).withColumn("at", F.unix_millis("ts"))
    return rows.groupBy("source").transformWithStateInPandas(Breaker(int(hours * 3_600_000), least, share), f"source {polls.schema['source'].dataType.simpleString()}, begins long, tries long, good long, opened boolean", "append", "eventTime")
