"""Reporting units: near-duplicate articles of a day under a containment rule, and their rollup."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.functions.text import words
from tidewire.operators.graph import connected_components, cut_lineage

CONTAINMENT, REVERSE, OVERLAP = 0.9, 0.5, 5
#: Words hashed at once, about; bits of a shingle's hash that name its bucket.
BLOCK, BUCKET_BITS = 1 << 20, 11
NAMES = ["id", "day", "set", "n", "bucket", "sets", "sizes", "hashes"]


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers, each bit of which hangs on all bits of x."""
    x = (x ^ x >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


def shingle_rows(articles: DataFrame, k: int = 5) -> DataFrame:
    """Rows of two kinds: (id, day, set, n) for each article, and (bucket, sets, sizes, hashes) for the shingles of a block of them.

    A shingle is a 64-bit hash of its day and its words' hashes, a set that of its distinct n shingles: equal sets of a day have
    the same, and are given out once for a block. A shorter text is one shingle, an empty one the empty shingle. A block's
    shingles are dealt to buckets by their hashes; a row holds those of one bucket, packed, set by set.
    """
    kinds = {c: articles.schema[c].dataType.simpleString() for c in ("id", "day")}
    factors = _mixed(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)

    def packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
        at = (np.append(0, ends) * values.itemsize).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(values))])

    def run(batches):
        for batch in batches:
            at, sizes = 0, np.diff(batch.column(3).offsets.to_numpy()).astype(np.int64)
            while at < batch.num_rows:
                stop = max(at + 1, int(np.searchsorted(np.cumsum(sizes[at:]), BLOCK, side="right")) + at)
                part, size = batch.slice(at, stop - at), sizes[at:stop]
                w = np.concatenate([part.column(3).flatten().to_numpy().view(np.uint64), np.zeros(k, np.uint64)])
                many, begins = np.maximum(size - k + 1, 1), np.cumsum(size) - size
                own = np.repeat(np.arange(len(size)), many)
                place = np.arange(len(own)) - np.repeat(np.cumsum(many) - many, many) + begins[own]
                h, short = np.zeros(len(w) - k, np.uint64), np.flatnonzero(size < k)
                for j in range(k):
                    h += w[j : j + len(h)] * factors[j]
                h = h[np.minimum(place, len(h) - 1)] if len(h) else np.zeros(len(own), np.uint64)
                few = begins[short][:, None] + np.arange(k)  # a shorter text has its own words only
                h[(np.cumsum(many) - many)[short]] = (np.where(np.arange(k) < size[short][:, None], w[few], np.uint64(0)) * factors).sum(axis=1, dtype=np.uint64)
                h = _mixed(h + part.column(2).to_numpy().view(np.uint64)[own])
                for a, b in zip((np.cumsum(many) - many).tolist(), np.cumsum(many).tolist(), strict=True):
                    h[a:b].sort()
                first = np.append(True, (h[1:] != h[:-1]) | (own[1:] != own[:-1]))
                h, own = h[first], own[first]
                n = np.bincount(own, minlength=len(size))
                name = _mixed(np.add.reduceat(_mixed(h), np.cumsum(n) - n) + n.astype(np.uint64)).view(np.int64)
                nulls = [pa.nulls(len(size), t) for t in (pa.int32(), pa.binary(), pa.binary(), pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(name), pa.array(n.astype(np.int32)), *nulls], names=NAMES)
                once = np.zeros(len(size), bool)
                once[np.unique(name, return_index=True)[1]] = True
                h, own = h[once[own]], own[once[own]]
                bucket = (h >> np.uint64(64 - BUCKET_BITS)).astype(np.uint16)
                order = np.argsort(bucket, kind="stable")
                h, own, bucket = h[order], own[order], bucket[order]
                turn = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (own[1:] != own[:-1])))  # where a set begins in a bucket
                row = np.flatnonzero(np.append(True, bucket[turn][1:] != bucket[turn][:-1]))  # and where a bucket does, among these
                ends = np.append(row[1:], len(turn))
                nulls = [pa.nulls(len(row), t) for t in (part.column(0).type, part.column(1).type, pa.int64(), pa.int32())]
                sets, many = packed(name[own[turn]], ends), packed(np.diff(np.append(turn, len(h))).astype(np.int32), ends)
                yield pa.RecordBatch.from_arrays([*nulls, pa.array(bucket[turn][row].astype(np.int32)), sets, many, packed(h, np.append(turn, len(h))[ends])], names=NAMES)
                at = stop

    hashed = F.transform(F.coalesce(words(F.col("body")), F.array().cast("array<string>")), lambda w: F.xxhash64(w))
    return articles.select("id", "day", F.xxhash64("day").alias("seed"), hashed.alias("w")).mapInArrow(run, f"id {kinds['id']}, day {kinds['day']}, set long, n int, bucket int, sets binary, sizes binary, hashes binary")


def shared_shingles(rows: DataFrame) -> DataFrame:
    """Rows (id, day, set, n) of articles as they are, and (set, h, df) of the shingles that df > 1 sets hold, for each set that does."""

    def told(parts: list[pa.RecordBatch]) -> list[pa.Array]:
        sets, sizes, h = (np.frombuffer(b"".join(x for p in parts for x in p.column(c).to_pylist()), t) for c, t in ((5, np.int64), (6, np.int32), (7, np.int64)))
        name = np.repeat(sets, sizes)
        order = np.lexsort((name, h))
        h, name = h[order], name[order]
        once = np.append(True, (h[1:] != h[:-1]) | (name[1:] != name[:-1]))
        h, name = h[once], name[once]
        begins = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        df = np.diff(np.append(begins, len(h)))
        df = np.repeat(df, df)
        return [pa.array(x[df > 1]) for x in (name, h, df)]

    def run(batches):
        held, of = [], None
        for batch in batches:
            own = pc.is_null(batch.column(4))
            lone, batch = batch.filter(own), batch.filter(pc.invert(own))
            null = lambda n, *at: [pa.nulls(n, batch.column(c).type) for c in at]  # noqa: B023, E731
            shingles = lambda name, h, df: pa.RecordBatch.from_arrays([*null(len(h), 0, 1), name, *null(len(h), 3), h, df], names=["id", "day", "set", "n", "h", "df"])  # noqa: B023, E731
            if lone.num_rows:
                yield pa.RecordBatch.from_arrays([*lone.columns[:4], *(pa.nulls(lone.num_rows, pa.int64()) for _ in range(2))], names=["id", "day", "set", "n", "h", "df"])
            bucket = batch.column(4).to_numpy()
            at = 0
            while at < len(bucket):  # rows of one bucket lie together, and may go on in the next batch
                stop = int(np.searchsorted(bucket, bucket[at], side="right"))
                if held and of != bucket[at]:
                    yield shingles(*told(held))
                    held = []
                held, of, at = [*held, batch.slice(at, stop - at)], bucket[at], stop
        if held:
            yield shingles(*told(held))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:4])
    return rows.repartition(F.coalesce("bucket", F.pmod(F.xxhash64("id"), F.lit(1 << BUCKET_BITS)).cast("int"))).sortWithinPartitions("bucket").mapInArrow(run, f"{kinds}, h long, df long")


def containment_pairs(articles: DataFrame, containment: float = CONTAINMENT, reverse: float = REVERSE, overlap: int = OVERLAP) -> tuple[DataFrame, DataFrame]:
    """(rows, pairs): each article with the representative of its shingle set, and the linked pairs (a, b, inter) of representatives.

    Equal sets are one before the join. A linked pair shares at least ``reverse`` of the larger set and ``containment`` of the
    smaller, so with shingles in one order, rarest first, it shares one among the first (1 - reverse) of the larger and the first
    (1 - containment) of the smaller: only these are joined, and frequent shingles hardly occur among them.
    """
    # Shingles are shuffled once, by themselves; those of one set are in no pair and go no further, so sets are never written whole.
    rows = cut_lineage(shared_shingles(shingle_rows(articles)))
    reps = rows.where("h IS NULL").groupBy("set").agg(F.min("id").alias("rep"), F.max("n").alias("n"))
    named = rows.where("h IS NULL").join(reps.select("set", "rep"), "set").select("id", "day", "rep")
    # Places count from the front, the lone ones first, and only the others are kept.
    common = rows.where("h IS NOT NULL").groupBy("set").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("s"))
    held = cut_lineage(common.join(reps, "set").select("rep", "n", F.transform("s", lambda x: x["h"]).alias("s")))
    length = lambda share: F.greatest(F.lit(0), F.size("s") - F.ceil(F.col("n") * share - 1e-9).cast("int") + 1)
    prefix = held.select("rep", "n", length(containment).alias("few"), F.posexplode(F.slice("s", 1, length(reverse))).alias("place", "h")).select("rep", "n", "h", (F.col("place") < F.col("few")).alias("small"))
    small, large = prefix.where("small").select("h", F.col("rep").alias("a"), F.col("n").alias("na")), prefix.select("h", F.col("rep").alias("b"), F.col("n").alias("nb"))
    near = small.join(large, "h").where("a != b AND na <= nb AND na >= " + repr(reverse) + " * nb").select("a", "b").distinct()
    checked = near.join(held.withColumnsRenamed({"rep": "a", "s": "sa", "n": "na"}), "a").join(held.withColumnsRenamed({"rep": "b", "s": "sb", "n": "nb"}), "b")
    inter = F.size(F.array_intersect("sa", "sb"))
    ok = (F.col("inter") >= containment * F.col("na") - 1e-9) & (F.col("inter") >= reverse * F.col("nb") - 1e-9) & (F.col("inter") >= F.least(F.lit(overlap), F.col("na")))
    pairs = checked.withColumn("inter", inter).where(ok).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "inter").distinct()
    return named, pairs


def reporting_units(articles: DataFrame) -> DataFrame:
    """id, day and unit_id (the smallest article of the closure) for every article; articles needs id, day, body."""
    named, pairs = containment_pairs(articles)
    roots = connected_components(pairs.select(F.col("a").alias("src"), F.col("b").alias("dst"))).withColumnsRenamed({"node": "rep", "component": "root"})
    return named.join(roots, "rep", "left").select("id", "day", F.coalesce("root", "rep").alias("unit_id"))


def unit_rollup(articles: DataFrame, units: DataFrame) -> DataFrame:
    """Per unit: article_count, owners, tiers present, tier-1 articles and owners, and the longest body (then smallest id)."""
    j = articles.select("id", "owner", "tier", F.length("body").alias("length")).join(units.select("id", "unit_id"), "id")  # texts stay where they are
    return j.groupBy("unit_id").agg(
        F.count("*").alias("article_count"), F.countDistinct("owner").alias("distinct_owners"), F.countDistinct("tier").alias("tiers"), F.count_if(F.col("tier") == 1).alias("tier1_articles"),
        F.countDistinct(F.when(F.col("tier") == 1, F.col("owner"))).alias("tier1_owners"), F.min_by("id", F.struct(-F.col("length"), "id")).alias("representative_id"),
    )


def tier1_gate(pairs: DataFrame, group: str) -> DataFrame:
    """(group, unit, owner) pairs of tier-1 units: passes with two distinct units of two distinct owners; the reason as text."""
    got = pairs.groupBy(group).agg(F.countDistinct("unit_id").alias("units"), F.countDistinct("owner").alias("owners"))
    reason = F.when(F.col("units") < 2, F.concat(F.lit("units "), F.col("units").cast("string"), F.lit(" < 2"))).when(F.col("owners") < 2, F.concat(F.lit("owners "), F.col("owners").cast("string"), F.lit(" < 2"))).otherwise("passed")
    return got.select(group, "units", "owners", ((F.col("units") >= 2) & (F.col("owners") >= 2)).alias("passed"), reason.alias("reason"))
