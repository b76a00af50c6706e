"""Vector code compression: product codebooks trained in integers, entries sought by annular norm pruning.

Vectors become integers floor(1024 x), cut into equal parts; each part position has a codebook of at most ENTRIES entries, which
start as the parts of the smallest ids and move to floor(sum / count) of what is nearest to them, for ROUNDS rounds. All sums are
exact integers, so the result does not hang on how the table is dealt.

The nearest entry of a part: entries lie sorted by norm. An entry whose norm differs from the part's by more than the best
distance so far cannot be nearer (triangle inequality), so the annulus of norms that is left is found by binary search, both
ends inclusive, and evaluated exactly from the middle outwards, while the best distance narrows it.

At scale: a round is one scan of the vectors; a task sends one row of sums for each entry that it used. Only codebooks, ENTRIES
times the length of a vector, pass through the driver.

Rows whose vector is null or holds a null or non-finite component are not kept. Vectors shorter than the longest, or of a length
that does not divide by the parts, count as filled with zeros. Components saturate at +-2^27 (131072 before scaling), so that
errors fit into a long. A null id ranks after all others, ties by the vector itself; repeated rows are coded each. A sum of
errors beyond a long is null. No kept rows: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import id_back, id_of, spread_join, staged

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
MOST = 1 << 27
#: Entries of an annulus evaluated in a step on each side of the middle, parts of like norm taken together, and parts read at once.
STEP, GROUP, ROWS = 32, 256, 1 << 16


class Codebook:
    """Entries (n, width) sorted by norm; among equal distances the one of the lower index is the nearest."""

    def __init__(self, entries: np.ndarray):
        norms = np.sqrt((entries.astype(np.float64) ** 2).sum(1))
        self.order = np.argsort(norms, kind="stable")
        self.entries, self.norms = entries[self.order], norms[self.order]
        self.largest = int(np.abs(entries).max(initial=0))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of each row's nearest entry.

        Rows are taken in groups of like norm, so that their annuli overlap and one product evaluates them together.
        """
        norm = np.sqrt((x.astype(np.float64) ** 2).sum(1))
        at, best = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
        by = np.argsort(norm, kind="stable")
        for k in range(0, len(by), GROUP):
            rows = by[k : k + GROUP]
            at[rows], best[rows] = self._group(x[rows], norm[rows])
        return at, best

    def _group(self, x: np.ndarray, norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        best, at = np.full(len(x), np.iinfo(np.int64).max), np.full(len(x), len(self.norms), np.int64)
        lo, hi = 0, len(self.norms)
        left = right = int(np.searchsorted(self.norms, norm[len(norm) // 2]))
        while left > lo or right < hi:
            a, b = max(left - STEP, lo), min(right + STEP, hi)
            for start, end in ((a, left), (right, b)):
                if start < end:
                    far = self._distances(x, start, end)
                    least = far.min(1)
                    index = np.where(far == least[:, None], self.order[start:end], len(self.norms)).min(1)
                    nearer = (least < best) | ((least == best) & (index < at))
                    best[nearer], at[nearer] = least[nearer], index[nearer]
            left, right = min(a, left), max(b, right)
            # The annulus that the best distances allow; rounding of the roots is given room, so that its ends are inclusive.
            reach = np.sqrt(best.astype(np.float64)) * (1 + 1e-12) + norm * 1e-12 + 1e-6
            lo = int(np.searchsorted(self.norms, (norm - reach).min(), "left"))
            hi = int(np.searchsorted(self.norms, (norm + reach).max(), "right"))
        return at, best

    def _distances(self, x: np.ndarray, start: int, end: int) -> np.ndarray:
        """Exact squared distances; as a product of doubles where all sums are whole numbers below 2^53."""
        e = self.entries[start:end]
        largest = max(self.largest, int(np.abs(x).max(initial=0)))
        if 4 * x.shape[1] * largest**2 < 1 << 53:
            a, b = x.astype(np.float64), e.astype(np.float64)
            return ((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)).astype(np.int64)
        gap = x[:, None] - e[None]
        return np.einsum("ijk,ijk->ij", gap, gap)


def finite(vec: Column) -> Column:
    """True where the vector and all its components are there and finite."""
    bad = F.exists(vec, lambda v: F.coalesce(F.isnan(v) | (F.abs(v) == float("inf")), F.lit(True)))
    return vec.isNotNull() & ~F.coalesce(bad, F.lit(True))


def integers(vectors: pa.Array, width: int) -> np.ndarray:
    """(n, width) integers floor(1024 x) of a list array, filled up with zeros."""
    flat = np.asarray(vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False))
    size = np.diff(vectors.offsets.to_numpy())
    whole = np.clip(np.floor(flat * SCALE), -MOST, MOST).astype(np.int64)
    if len(size) and (size == width).all():
        return whole.reshape(-1, width)
    out = np.zeros((len(size), width), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(whole)) - np.repeat(np.cumsum(size) - size, size)] = whole
    return out


def parts_of(vectors: pa.Array, width: int, parts: int) -> Iterator[list[np.ndarray]]:
    """The parts of so many vectors at a time that the pairs of a step are bounded."""
    step = max(1, ROWS * 16 // max(1, width))
    for k in range(0, len(vectors), step):
        yield np.split(integers(vectors.slice(k, step), width), parts, axis=1)


def trained(vectors: DataFrame, width: int, first: list[list[float]], parts: int, rounds: int) -> list[np.ndarray]:
    """The codebooks after all rounds: one (entries, width / parts) array for each part position."""
    books = np.split(integers(pa.array(first, pa.list_(pa.float64())), width), parts, axis=1)
    own = width // parts
    schema = "part int, entry int, n long, total array<long>"
    for _ in range(rounds):
        sent = books

        def run(batches, sent=sent):
            at = [Codebook(b) for b in sent]
            counts, sums = [np.zeros(len(b), np.int64) for b in sent], [np.zeros(b.shape, np.int64) for b in sent]
            for batch in batches:
                for xs in parts_of(batch.column(0), width, parts):
                    for p, x in enumerate(xs):
                        near, _ = at[p].nearest(x)
                        counts[p] += np.bincount(near, minlength=len(counts[p]))
                        by = np.argsort(near, kind="stable")
                        starts = np.flatnonzero(np.diff(near[by], prepend=-1))
                        sums[p][near[by][starts]] += np.add.reduceat(x[by], starts, axis=0)
            used = [(p, int(e), int(counts[p][e]), sums[p][e].tolist()) for p in range(parts) for e in np.flatnonzero(counts[p])]
            cols = list(zip(*used, strict=True)) if used else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())), strict=True)], names=["part", "entry", "n", "total"])

        # Exact at any size: sums are decimals, and only the floor of the mean comes back.
        sums = [F.sum(F.get("total", F.lit(i)).cast("decimal(20,0)")).alias(f"s{i}") for i in range(own)]
        total = vectors.mapInArrow(run, schema).groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums)
        books = [b.copy() for b in books]
        for row in total.collect():  # at most parts * entries rows
            books[row["part"]][row["entry"]] = [int(row[f"s{i}"]) // row["n"] for i in range(own)]
    return books


def compress(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(id, label, code, error, label_error, codebooks_sha256) for every kept row: its entries in hex, the squared distance to them,
    that summed over its label (nulls together), and the digest of the codebooks."""
    spark = table.sparkSession
    kept = table.select(F.col(f"`{vec_col}`").alias("vec"), id_of(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("string").alias("label")).where(finite(F.col("vec")))
    kept = kept.withColumn("vec", F.col("vec").cast("array<double>"))
    longest = kept.agg(F.max(F.size("vec"))).first()[0]
    schema = "id long, label string, code string, error long"
    if longest is None:
        return spark.createDataFrame([], schema + ", label_error long, codebooks_sha256 string").withColumn("id", id_back("id"))
    width = max(parts, -(-longest // parts) * parts)
    first = [r["vec"] for r in kept.orderBy("id", "vec").limit(entries).select("vec").collect()]  # at most entries rows
    books = trained(kept.select("vec"), width, first, parts, rounds)
    digest = hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()
    digits = max(2, len(f"{len(first) - 1:x}"))

    def run(batches):
        at = [Codebook(b) for b in books]
        for batch in batches:
            codes, errors = [], []
            for xs in parts_of(batch.column(0), width, parts):
                found = [book.nearest(x) for book, x in zip(at, xs, strict=True)]
                codes += ["".join(f"{k:0{digits}x}" for k in row) for row in np.stack([f[0] for f in found], 1).tolist()]
                errors.append(sum(f[1] for f in found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(codes, pa.string()), pa.array(np.concatenate(errors) if errors else [], pa.int64())], names=["id", "label", "code", "error"]
            )

    coded = staged(kept.mapInArrow(run, schema).withColumn("key", F.coalesce(F.concat(F.lit("="), "label"), F.lit("-"))))
    total = coded.groupBy("key").agg(F.expr("try_cast(sum(CAST(error AS DECIMAL(20, 0))) AS LONG)").alias("label_error"))
    out = spread_join(coded, total, "key", "id")
    return out.select(id_back("id").alias("id"), "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
