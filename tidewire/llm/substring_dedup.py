"""Substring dedup of word windows behind a count-min prefilter.

First pass: each block of documents sketches its windows. A sketch has DEPTH rows, each as wide as CELLS cells for every window of the
corpus, so its width grows with the input; it is cut into shards by cell, and sent as sorted, difference-coded lists. A shard
merges the sketches of all blocks: the count of a cell is never below that of a window in it. What comes back to a
block is one bit per cell asked for: does the merged count reach two?

Second pass: a block sends on only windows whose cells all say two or more, as 128-bit hashes, and those are grouped exactly.
No window that repeats is lost, as its cells count it at least twice. The occurrences that are not the first come back to
their block, which removes the words they cover.

Documents are dealt to blocks once; the three uses of a block read the same exchange.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import id_of, text_of

WINDOW = 20
DEPTH, CELLS = 2, 4
#: Bytes of text in a block and windows in a shard, about.
BLOCK_BYTES = 12 << 20
SHARD_WINDOWS = 1 << 21
_B1, _B2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.array([*map(xxhash.xxh3_64_intdigest, words)], np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ h >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ h >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ h >> np.uint64(33)


def window_hashes(words: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each window: polynomials in odd bases over the words' hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    own = word_hashes(words)
    other = mixed(own)
    a, b = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            a = a * _B1 + own[k : k + n]
            b = b * _B2 + other[k : k + n]
    return mixed(a), mixed(b)


def pack_sorted(x: np.ndarray) -> bytes:
    """Sorted unsigned numbers as differences, byte planes apart, compressed."""
    gaps = np.diff(x, prepend=np.uint64(0)).astype("<u8")
    width = max(1, -(-int(gaps.max()).bit_length() // 8)) if len(gaps) else 1
    planes = np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + zstandard.compress(planes.tobytes(), 1)


def unpack_sorted(raw: bytes) -> np.ndarray:
    width = raw[0]
    planes = np.frombuffer(zstandard.decompress(raw[1:]), np.uint8).reshape(width, -1)
    gaps = np.zeros((planes.shape[1], 8), np.uint8)
    gaps[:, :width] = planes.T
    return np.cumsum(gaps.view("<u8").ravel(), dtype=np.uint64)


class Block:
    """The windows of a block's documents, in the order of id and text."""

    def __init__(self, docs: pa.Table, size: int):
        rows = sorted({(i, t) for i, t in zip(docs["id"].to_pylist(), docs["text"].cast(pa.binary()).to_pylist(), strict=True)})
        self.rows = rows
        counts, firsts, seconds = [], [], []
        for _, text in rows:
            a, b = window_hashes(text.split(), size)
            counts.append(len(a))
            firsts.append(a)
            seconds.append(b)
        self.first = np.concatenate(firsts) if firsts else np.zeros(0, np.uint64)
        self.second = np.concatenate(seconds) if seconds else np.zeros(0, np.uint64)
        self.counts = np.array(counts, np.int64)

    def cells(self, width: int):
        """For each row of the sketch, the cell of each window."""
        return [(h % np.uint64(width)) for h in (self.first, self.second)[:DEPTH]]


def sketches(block: int, docs: pa.Table, size: int, width: int, shards: int) -> pa.Table:
    """One row (row, shard, block, once, more) for each row of the sketch and shard: sorted cells counted once, and more often."""
    out = []
    per = -(-width // shards)
    for row, cells in enumerate(Block(docs, size).cells(width)):
        cells, n = np.unique(cells, return_counts=True)
        cut = np.searchsorted(cells, np.arange(shards + 1, dtype=np.uint64) * np.uint64(per))
        for s in np.flatnonzero(np.diff(cut)):
            own, many = cells[cut[s] : cut[s + 1]] - np.uint64(s * per), n[cut[s] : cut[s + 1]] > 1
            out.append((row, int(s), block, pack_sorted(own), zstandard.compress(np.packbits(many).tobytes(), 1)))
    cols = list(zip(*out, strict=True)) if out else [()] * 5
    return pa.table([pa.array(c, t) for c, (_, t) in zip(cols, _SKETCH, strict=True)], pa.schema(_SKETCH))


_SKETCH = [("row", pa.int32()), ("shard", pa.int32()), ("block", pa.int64()), ("cells", pa.binary()), ("many", pa.binary())]
_REPLY = [("row", pa.int32()), ("shard", pa.int32()), ("block", pa.int64()), ("bits", pa.binary())]
_WINDOW = [("shard", pa.int32()), ("block", pa.int64()), ("windows", pa.binary())]
_STARTS = [("block", pa.int64()), ("starts", pa.binary())]


def merged(sketches: pa.Table, width: int, shards: int) -> pa.Table:
    """Add up a shard's sketches, saturating at two, and answer each block's cells with a bit."""
    counts = np.zeros(-(-width // shards), np.uint8)
    asked = []
    for cells, many in zip(sketches["cells"].to_pylist(), sketches["many"].to_pylist(), strict=True):
        at = unpack_sorted(cells).astype(np.int64)
        counts[at] = np.minimum(2, counts[at] + 1 + np.unpackbits(np.frombuffer(zstandard.decompress(many), np.uint8), count=len(at)))
        asked.append(cells)
    bits = [zstandard.compress(np.packbits(counts[unpack_sorted(c).astype(np.int64)] > 1).tobytes(), 1) for c in asked]
    return pa.table([sketches["row"], sketches["shard"], sketches["block"], pa.array(bits, pa.binary())], schema=pa.schema(_REPLY))


def pack(x: np.ndarray) -> bytes:
    """Unsigned numbers in any order, byte planes apart, compressed."""
    width = max(1, -(-int(x.max()).bit_length() // 8)) if len(x) else 1
    planes = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + zstandard.compress(planes.tobytes(), 1)


def unpack(raw: bytes) -> np.ndarray:
    width = raw[0]
    planes = np.frombuffer(zstandard.decompress(raw[1:]), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def framed(*parts: bytes) -> bytes:
    return b"".join(len(x).to_bytes(8, "little") + x for x in parts)


def unframed(raw: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(raw):
        n = int.from_bytes(raw[at : at + 8], "little")
        out.append(raw[at + 8 : at + 8 + n])
        at += 8 + n
    return out


def candidates(docs: pa.Table, replies: pa.Table, size: int, width: int, shards: int) -> pa.Table:
    """The windows of a block all of whose cells count two or more, dealt to shards by their first hash.

    Each distinct window is sent once: its two hashes, the id of the document it starts in first and its places in the block, so
    that a window that every document holds is one entry for each block.
    """
    empty = pa.schema(_WINDOW).empty_table()
    if not docs.num_rows or not replies.num_rows:
        return empty
    block, per, ok = Block(docs, size), -(-width // shards), None
    got = {(r, s): b for r, s, b in zip(replies["row"].to_pylist(), replies["shard"].to_pylist(), replies["bits"].to_pylist(), strict=True)}
    for row, cells in enumerate(block.cells(width)):
        distinct, back = np.unique(cells, return_inverse=True)
        cut = np.searchsorted(distinct, np.arange(shards + 1, dtype=np.uint64) * np.uint64(per))
        bits = np.concatenate([np.unpackbits(np.frombuffer(zstandard.decompress(got[row, int(s)]), np.uint8), count=int(cut[s + 1] - cut[s])) for s in np.flatnonzero(np.diff(cut))] or [np.zeros(0, np.uint8)])
        ok = bits[back] if ok is None else ok & bits[back]
    at = np.flatnonzero(ok)
    if not len(at):
        return empty
    begins = np.concatenate([[0], np.cumsum(block.counts)])
    ids = np.array([i for i, _ in block.rows], np.int64)
    order = np.lexsort((at, block.second[at], block.first[at]))
    at = at[order]
    h1, h2 = block.first[at], block.second[at]
    new = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
    heads = np.flatnonzero(new)
    times = np.diff(np.append(heads, len(at)))
    h1, h2 = h1[heads], h2[heads]
    first_ids = ids[np.searchsorted(begins, at[heads], side="right") - 1]
    step = (1 << 64) // shards + 1
    cut = np.searchsorted(h1, np.array([min(i * step, (1 << 64) - 1) for i in range(shards)], np.uint64)).tolist() + [len(h1)]
    ends = np.append(heads, len(at))
    out = []
    for s in range(shards):
        a, b = cut[s], cut[s + 1]
        if a < b:
            own = at[ends[a] : ends[b]]
            out.append((s, docs["block"][0].as_py(), framed(pack_sorted(h1[a:b]), pack(h2[a:b]), pack(first_ids[a:b].view(np.uint64)), pack(times[a:b].astype(np.uint64)), pack(own.astype(np.uint64)))))
    cols = list(zip(*out, strict=True))
    return pa.table([pa.array(c, t) for c, (_, t) in zip(cols, _WINDOW, strict=True)], schema=pa.schema(_WINDOW))


def later(windows: pa.Table) -> pa.Table:
    """Group a shard's windows exactly; for each block, the places of those that are not the first of their kind."""
    parts = [[f(x) for f, x in zip((unpack_sorted, unpack, unpack, unpack, unpack), unframed(w), strict=True)] for w in windows["windows"].to_pylist()]
    h1, h2 = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    ids = np.concatenate([p[2] for p in parts]).view(np.int64)
    # Within a block a window has one entry: the smallest id has the first occurrence, and of one id with several texts the first block.
    blocks = np.repeat(windows["block"].to_numpy(), [len(p[0]) for p in parts])
    order = np.lexsort((blocks, ids, h2, h1))
    a, b = h1[order], h2[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    first = np.zeros(len(order), bool)
    first[order[new]] = True
    out, at = [], 0
    for block, (own, _, _, times, places) in zip(windows["block"].to_pylist(), parts, strict=True):
        keep = first[at : at + len(own)]
        at += len(own)
        times = times.astype(np.int64)
        stays = np.zeros(len(places), bool)
        stays[(np.cumsum(times) - times)[keep]] = True
        if not stays.all():
            out.append((block, pack_sorted(np.sort(places[~stays]))))
    cols = list(zip(*out, strict=True)) if out else [()] * 2
    return pa.table([pa.array(c, t) for c, (_, t) in zip(cols, _STARTS, strict=True)], schema=pa.schema(_STARTS))


def covered(n: int, starts: np.ndarray, size: int) -> np.ndarray:
    """Which of n items lie in one of the windows."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + size, -1)
    return np.cumsum(step[:-1]) > 0


def deduplicate_windows(docs: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and text (the words kept, joined by one space) for every row of docs.

    Words are parted by ASCII white space. A word goes if a window of ``size`` words over it also starts earlier: in a document of
    smaller id, or before in the same one. Null, empty and short texts lose nothing (null: no words). A null id ranks last,
    with the largest one, and stays null. Rows that repeat an id and a text are one document and come back alike, as often as they
    came; rows with one id and different texts are taken in a fixed order of their hashes. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(id_of(id_col).alias("id"), text_of(text_col).alias("text"), F.col(id_col).isNull().alias("none"))
    total = rows.agg(F.sum(F.octet_length("text")).alias("bytes"), F.sum(F.length("text") - F.length(F.translate("text", "\x20\x09\x0a\x0b\x0c\x0d", "")) + 1).alias("words")).first()
    n_bytes, n_words = total["bytes"] or 0, total["words"] or 0
    blocks = max(1, -(-n_bytes // BLOCK_BYTES))
    width = max(1024, CELLS * n_words)
    shards = max(1, -(-n_words // SHARD_WINDOWS))
    # Shuffled by block: once for all three uses, which share the exchange.
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).cast("long"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(blocks, 100_000))
    dealt = dealt.repartition(parts, "block")

    def first_pass(docs: pa.Table) -> pa.Table:
        return sketches(docs["block"][0].as_py(), docs, size, width, shards)

    def merge(rows: pa.Table) -> pa.Table:
        return merged(rows, width, shards)

    def second_pass(docs: pa.Table, replies: pa.Table) -> pa.Table:
        return candidates(docs, replies, size, width, shards)

    sketched = dealt.groupBy("block").applyInArrow(first_pass, "row int, shard int, block long, cells binary, many binary")
    replies = sketched.groupBy("row", "shard").applyInArrow(merge, "row int, shard int, block long, bits binary")
    asked = dealt.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(second_pass, "shard int, block long, windows binary")
    starts = asked.groupBy("shard").applyInArrow(later, "block long, starts binary")

    def remove(docs: pa.Table, starts: pa.Table) -> pa.Table:
        schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.binary()), ("none", pa.bool_())])
        places = np.sort(np.concatenate([unpack_sorted(x) for x in starts["starts"].to_pylist()] or [np.zeros(0, np.uint64)])).astype(np.int64)
        pairs = [*zip(docs["id"].to_pylist(), docs["text"].cast(pa.binary()).to_pylist(), strict=True)]
        out, done, begin = [], {}, 0
        for pair in sorted(set(pairs)):  # the order of the block's windows
            words = kept = pair[1].split()
            end = begin + max(0, len(words) - size + 1)
            own = places[np.searchsorted(places, begin) : np.searchsorted(places, end)] - begin
            begin = end
            if len(own):
                kept = [w for w, x in zip(words, covered(len(words), own, size).tolist(), strict=True) if not x]
            done[pair] = (pair[0], len(words), len(words) - len(kept), b" ".join(kept))
        out = [done[x] for x in pairs]
        cols = list(zip(*out, strict=True)) if out else [()] * 4
        return pa.table([*(pa.array(c, f.type) for c, f in zip(cols, schema, strict=False)), docs["none"]], schema=schema)

    done = dealt.groupBy("block").cogroup(starts.groupBy("block")).applyInArrow(remove, "id long, n_words long, n_removed long, text binary, none boolean")
    return done.select(F.when(~F.col("none"), F.col("id")).alias("doc_id"), "n_words", "n_removed", F.col("text").cast("string").alias("text"))
