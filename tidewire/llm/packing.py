"""Packing of tokenised documents by minimum bin slack.

Every full window of a document is a sequence of its own; what is left of each document (under ``capacity`` ids) is packed by its
length alone. The lengths' histogram has at most capacity - 1 entries however many documents there are, so the plan is made on
the driver: for each window the longest length left is taken, and a bitset subset-sum over the others finds the multiset that
fills the window closest; it is backtracked to counts and repeated as often as the histogram allows. The plan then says where
the r-th piece of a length goes, and pieces are ranked in shares, never in one task.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewire.llm.common import slices, staged, text_of

CAPACITY = 4096
END_ID = 2
#: Words whose ids a process keeps; it starts afresh beyond.
WORDS = 400_000


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    """One per process; the file lies at the same path on every machine."""
    return Tokenizer.from_file(path)


def _category(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(0x250) if unicodedata.category(chr(c))[0] == kind)


#: Characters that normalisation leaves alone but for case, and that the tokenizer's classes and Python's hold alike.
_PLAIN = re.compile("[\t\n\x0b\x0c\r\x20-\x7e\xa1-\u012f\u0131-\u024f]*")
#: The tokenizer's own splitting of lower-cased text, over those characters.
_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_category('L')}]+|[{_category('N')}]|[^\\s{_category('L')}{_category('N')}]+")
#: Bytes as the characters that a byte-level vocabulary writes them in: printable ones as they are, others from 256 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SHOW = {b: chr(b) for b in _SHOWN} | {b: chr(256 + k) for k, b in enumerate(x for x in range(256) if x not in _SHOWN)}


class WordCache:
    """Ids of texts by way of their words.

    Texts of plain characters are lower-cased and split into words as the tokenizer does, and its model gives each new word's ids
    once. In other texts the parts between spaces and newlines are taken, as no match goes across white space; those of other
    characters go through the whole tokenizer. Texts that hold a special token's string are encoded whole.
    """

    def __init__(self, path: str):
        self.encoder = tokenizer(path)
        self.model = self.encoder.model
        self.special = [t.content for t in self.encoder.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.odd: dict[str, bytes] = {}

    def _words(self, words: list[str]) -> bytes:
        known = self.known
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            if len(known) > WORDS:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = np.array([t.id for t in self.model.tokenize(w.encode().decode("latin-1").translate(_SHOW))], "<u4").tobytes()
            return b"".join([known[w] for w in words])

    def _whole(self, text: str) -> bytes:
        return np.array(self.encoder.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _part(self, part: str) -> bytes:
        if _PLAIN.fullmatch(part):
            return self._words(_WORD.findall(part.lower()))
        if (got := self.odd.get(part)) is None:
            if len(self.odd) > WORDS:
                self.odd.clear()
            got = self.odd[part] = self._whole(part)
        return got

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out = []
        for text in texts:
            if "<|" in text and any(s in text for s in self.special):
                out.append(self._whole(text))
            elif _PLAIN.fullmatch(text):
                out.append(self._words(_WORD.findall(text.lower())))
            else:
                out.append(b"".join([self._part(x) for x in text.replace("\n", " ").split(" ")]))
        return out


@lru_cache(maxsize=2)
def word_cache(path: str) -> WordCache:
    return WordCache(path)


def pieces(docs: DataFrame, path: str, capacity: int, end_id: int, id_col: str, text_col: str, with_ids: bool) -> DataFrame:
    """Rows (id, start, length, ids_crc32, doc_tokens[, ids]): the full windows and the rest of every document."""
    names = ["id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        cache = word_cache(path)
        for batch in slices(batches):
            rows = []
            for i, ids in zip(batch.column(0).to_pylist(), cache.encode(batch.column(1).to_pylist()), strict=True):
                ids += end
                n = len(ids) // 4
                for at in range(0, n, capacity):
                    own = ids[4 * at : 4 * (at + capacity)]
                    rows.append((i, at, len(own) // 4, zlib.crc32(own), n, own))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 6
            arrays = [pa.array(c, pa.int64()) for c in cols[:5]] + [pa.array(cols[5], pa.binary())] * with_ids
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    return docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text")).mapInArrow(run, schema)


def padding(fill: int, capacity: int) -> int:
    """Sequences are padded to the capacity, but for those of a power of two."""
    return 0 if fill & (fill - 1) == 0 else capacity - fill


def fill_window(first: int, counts: dict[int, int], order: list[int], capacity: int) -> dict[int, int]:
    """The multiset of lengths, first among them, that leaves the least padding; counts excludes that first one.

    Bit s of a bitset says that lengths seen so far add up to s. One bitset per length and copy is kept for the way back,
    and the search ends at the first exact fill.
    """
    room = capacity - first
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in order:
        if length > room:
            continue
        left, take = min(counts[length], room // length), 1
        while left > 0:
            take = min(take, left)  # copies in powers of two
            new = reach | (reach << (length * take)) & mask
            if new != reach:
                steps.append((reach, length, take))
                reach = new
            left -= take
            take *= 2
            if reach >> room & 1:
                break
        if reach >> room & 1:
            break
    sums = [room] if reach >> room & 1 else [s for s in range(room + 1) if reach >> s & 1]
    at = min(sums, key=lambda s: (padding(first + s, capacity), -s))
    out = {first: 1}
    for before, length, take in reversed(steps):
        if not before >> at & 1:
            out[length] = out.get(length, 0) + take
            at -= length * take
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Rows (length, first rank, first sequence, copies in a sequence, offset) and the number of sequences."""
    counts = {k: v for k, v in histogram.items() if v > 0}
    order = sorted(counts, reverse=True)
    used = dict.fromkeys(counts, 0)
    out, sequence, top = [], 0, 0
    while top < len(order):
        first = order[top]
        if not counts[first]:
            top += 1
            continue
        counts[first] -= 1
        order = [x for x in order[top:] if counts[x] or x == first]
        top = 0
        own = fill_window(first, counts, [x for x in order if counts[x]], capacity)
        counts[first] += 1
        times, offset = min(counts[k] // m for k, m in own.items()), 0
        for k in sorted(own, reverse=True):
            out.append((k, used[k], sequence, own[k], offset))
            offset += k * own[k]
            used[k] += own[k] * times
            counts[k] -= own[k] * times
        sequence += times
    return out, sequence


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids].

    A document is its ids and end_id, so a null or empty text is one piece of one id. Null ids stay null. Repeated rows are
    packed as often as they come. An empty table gives no pieces. Other columns are not read.
    """
    path = path or public_tokenizers.path("word_bpe_49k.json")
    spark = docs.sparkSession
    rows = pieces(docs, path, capacity, end_id, id_col, text_col, with_ids)
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()))
    # A share is what one task of that scan made, so that shares are as many as the input asks for.
    rows = rows.withColumn("share", F.shiftright("row", 33).cast("int"))
    sizes = rows.groupBy("length", "share").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    sizes = staged(sizes.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long"))).select("length", "share", "base", "n"))
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    full = histogram.pop(capacity, 0)
    places, _ = plan(histogram, capacity)
    # The full windows come first, one sequence each.
    places = sorted([(capacity, 0, 0, 1, 0)] * (full > 0) + [(k, r, s + full, m, o) for k, r, s, m, o in places])
    table = np.array(places, np.int64).reshape(-1, 5)
    shared = spark.sparkContext.broadcast(table)
    ranked = rows.withColumn("own", F.row_number().over(Window.partitionBy("length", "share").orderBy("row")) - 1)
    ranked = ranked.join(sizes.drop("n"), ["length", "share"]).withColumn("rank", F.col("base") + F.col("own"))
    cols = ["id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids

    def place(batches):
        t = shared.value
        keys = t[:, 0] << 44 | t[:, 1]
        for batch in batches:
            length, rank = batch.column(2).to_numpy(), batch.column(batch.num_columns - 1).to_numpy()
            own = t[np.searchsorted(keys, length << 44 | rank, side="right") - 1]
            r = rank - own[:, 1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(own[:, 2] + r // own[:, 3]), pa.array(own[:, 4] + r % own[:, 3] * length)], names=[*cols, "sequence_id", "offset"])

    schema = "id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids + ", sequence_id long, offset long"
    out = ranked.select(*cols, "rank").mapInArrow(place, schema)
    return out.withColumnRenamed("id", "doc_id").select("doc_id", *cols[1:5], "sequence_id", "offset", *cols[5:])
