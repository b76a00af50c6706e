"""Exact dedup by a heavy-hitter split.

Misra-Gries summaries of the digests, one per partition, are merged in a tree; the at most ``counters`` candidates are
counted exactly, and the winners of those that are truly frequent are broadcast, so that their rows never meet in one
task. All other digests go through one ordinary shuffle, where no group can hold more than rows / (counters + 1).
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.common import SPACES, n_parts, staged, text_of

#: Counters of a summary: the bound on what is broadcast, in rows of about 120 bytes.
COUNTERS = 1024
#: Summaries that one task merges.
FAN_IN = 32


def shrink(counts: dict[bytes, int], counters: int) -> dict[bytes, int]:
    """The Misra-Gries step for many keys at once: subtract the (counters + 1)-th largest count from all."""
    if len(counts) <= counters:
        return counts
    off = sorted(counts.values(), reverse=True)[counters]
    return {k: v - off for k, v in counts.items() if v > off}


def summaries(df: DataFrame, counters: int) -> DataFrame:
    """One summary (digest, n) for each partition of rows (digest, n)."""

    def run(batches):
        counts: dict[bytes, int] = {}
        for batch in batches:
            got = pa.table(batch.columns, names=["digest", "n"]).group_by("digest").aggregate([("n", "sum")])
            for k, v in zip(got["digest"].to_pylist(), got["n_sum"].to_pylist(), strict=True):
                counts[k] = counts.get(k, 0) + v
            counts = shrink(counts, counters)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["digest", "n"])

    return df.mapInArrow(run, "digest binary, n long")


def frequent(df: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` values of column digest; every one held by more than rows / (counters + 1) rows is among them."""
    parts, df = n_parts(df), summaries(df.select("digest", F.lit(1).cast("long").alias("n")), counters)
    while parts > 1:
        parts = -(-parts // FAN_IN)
        df = summaries(df.repartition(parts), counters)
    return df.select("digest")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """A verdict for every row of docs: doc_id, keep_id, group_size, kept, digest (SHA-256), n_chars.

    Texts are equal when identical without white space. The row with the most code points stays, then the smallest id.
    A null text is an empty one; empty and blank texts are one group. A null id ranks last and stays null. Rows that
    repeat both id and length of a group count each towards group_size and exactly one of them is kept. An empty table
    gives no rows. Other columns, whatever their names, are not read.
    """
    text = text_of(text_col)
    slim = staged(docs.select(
        F.col(id_col).cast("long").alias("id"), F.length(text).cast("long").alias("n_chars"),
        F.unhex(F.sha2(F.translate(text, SPACES, "").cast("binary"), 256)).alias("digest"), F.monotonically_increasing_id().alias("row"),
    ))
    rank = F.struct((-F.col("n_chars")).alias("most"), F.col("id").isNull().alias("without"), "id", "row")
    rows = slim.count()  # from the staged files' footers
    winners = staged(
        slim.join(F.broadcast(frequent(slim, counters)), "digest").groupBy("digest").agg(F.min(rank).alias("best"), F.count("*").alias("group_size"))
        .where(F.col("group_size") > rows / (counters + 1))
    )
    heavy = slim.join(F.broadcast(winners), "digest")
    group = Window.partitionBy("digest")
    light = slim.join(F.broadcast(winners.select("digest")), "digest", "left_anti").select("*", F.min(rank).over(group).alias("best"), F.count("*").over(group).alias("group_size"))
    return heavy.unionByName(light).select(
        F.col("id").alias("doc_id"), F.col("best.id").alias("keep_id"), "group_size",
        (F.col("best.row") == F.col("row")).alias("kept"), "digest", "n_chars",
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The rows of docs that stay, with all their columns; of rows that repeat id and text one stays."""
    key = lambda i, d, n: F.struct(i.isNull().alias("without"), F.coalesce(i, F.lit(0)).alias("id"), d.alias("digest"), n.alias("n"))
    kept = exact_duplicates(docs, id_col, text_col, counters).where("kept").select(key(F.col("doc_id"), F.col("digest"), F.col("n_chars")).alias("key"))
    text = text_of(f"`{text_col}`")
    own = key(F.col(f"`{id_col}`").cast("long"), F.unhex(F.sha2(F.translate(text, SPACES, "").cast("binary"), 256)), F.length(text).cast("long"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), own.alias("key")).join(kept, "key", "left_semi").dropDuplicates(["key"])
    return rows.select([F.col(f"row.`{c}`").alias(c) for c in docs.columns])
