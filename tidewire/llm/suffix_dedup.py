"""Suffix-array dedup of byte strings.

Only suffixes that start at anchors are sorted. An anchor of a string of ``size`` bytes is the place of its ``LEAD``-byte piece with
the least hash, so equal strings have equal anchors, and one suffix in about a dozen is one. A suffix record carries the bytes
that the strings of its anchor cover. Records are range-partitioned by their leading tokens (the ``LEAD`` bytes at the anchor)
at sampled splitters; a bucket sorts its strings by a multikey quicksort, eight bytes a step, that goes deeper only into ties, and
compares neighbours. A leading token that one splitter has goes to one side of it. One that several splitters have is hot: its
strings are dealt one by one, by the token, where it lies in them and their other bytes, so that it spreads over all the ranges
that its share of the sample asks for. A string that several splitters equal is dealt over the ranges between them by its block;
its buckets tell the smallest id that each has seen, and these are compared across the boundaries.

Before that, leading tokens that no two documents can share are found as in the count-min prefilter (an overestimate, so none
is lost), and records that a block holds more than once are sent once, with their places.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.common import id_of, text_of
from tidewire.llm.substring_dedup import _SKETCH, framed, merged, mixed, pack, pack_sorted, unframed, unpack, unpack_sorted

SIZE, LEAD = 50, 24
#: Cells of the sketch for each anchor; anchors of a shard and bytes of a block and of one pass over it, about.
CELLS, SHARD_CELLS, BLOCK_BYTES, PASS_BYTES = 16, 1 << 25, 12 << 20, 1 << 20
#: Suffix records of a bucket, about; suffixes sampled for a splitter; strings sorted at once.
BUCKET_RECORDS, SAMPLED, STRINGS = 1 << 17, 32, 1 << 18
#: Ranges at most, the bound on what the driver samples; a range is dealt to as many buckets as it needs by the leading tokens' hash.
RANGES = 1 << 16
#: Ranges of a hot token for each that its share of the sample asks for, as its strings are dealt one by one.
FINER = 8
#: Rows of a range that is sorted outright.
SMALL = 1024


def anchors(text: np.ndarray, size: int = SIZE, lead: int = LEAD) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor places, the first and last string start of each, and 64-bit hashes of the leading tokens."""
    n = len(text) - size + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    word = np.ndarray((len(text),), "<u8", padded, 0, (1,))  # the eight bytes from each place on
    m = len(text) - lead + 1
    with np.errstate(over="ignore"):
        h = word[:m] * np.uint64(0x9E3779B97F4A7C15)
        for k in range(8, lead, 8):
            h ^= h >> np.uint64(32)
            h += word[k : k + m]
            h *= np.uint64(0xC2B2AE3D27D4EB4F)
    h = mixed(h)
    low = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(m, dtype=np.uint64)
    span, done = size - lead + 1, 1  # pieces of a string
    while 2 * done <= span:
        low = np.minimum(low[:-done], low[done:])
        done *= 2
    if done < span:
        low = np.minimum(low[: len(low) - (span - done)], low[span - done :])
    at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    begins = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    lasts = np.append(begins[1:], n) - 1
    return at[begins], begins, lasts, h[at[begins]]


class Block:
    """The distinct (id, text) of a block in order, as one array of bytes."""

    def __init__(self, docs: pa.Table):
        self.rows = sorted(set(zip(docs["id"].to_pylist(), docs["text"].cast(pa.binary()).to_pylist(), strict=True)))
        self.bytes = np.frombuffer(b"".join([t for _, t in self.rows]), np.uint8)
        self.begins = np.concatenate([[0], np.cumsum([len(t) for _, t in self.rows])]).astype(np.int64)
        self.ids = np.array([i for i, _ in self.rows], np.int64)

    def anchors(self, size: int, lead: int):
        """Anchor, first and last string start (places in the block), hash of the leading tokens, document number."""
        out, a = [], 0
        while a < len(self.rows):
            b = a + 1
            while b < len(self.rows) and self.begins[b + 1] - self.begins[a] <= PASS_BYTES:
                b += 1
            base = self.begins[a]
            at, first, last, h = anchors(self.bytes[base : self.begins[b]], size, lead)
            # Strings that reach over a document's end are none: an anchor's starts are cut to its first string's document, and
            # anchors that straddle two documents give one record for each.
            own = self.begins[a : b + 1] - base
            doc = np.searchsorted(own, first, side="right") - 1
            until = np.searchsorted(own, last, side="right") - 1
            extra = np.flatnonzero(until > doc)
            if len(extra):
                more = [(e, d) for e in extra.tolist() for d in range(int(doc[e]) + 1, int(until[e]) + 1)]
                e, d = np.array([x for x, _ in more]), np.array([x for _, x in more])
                at, h = np.append(at, at[e]), np.append(h, h[e])
                first, last = np.append(first, np.maximum(first[e], own[d])), np.append(last, last[e])
                doc = np.append(doc, d)
            last = np.minimum(last, own[doc + 1] - size)
            ok = first <= last
            out.append((at[ok] + base, first[ok] + base, last[ok] + base, h[ok], doc[ok] + a))
            a = b
        if not out:
            z = np.zeros(0, np.int64)
            return z, z, z, np.zeros(0, np.uint64), z
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def prefilter(block: int, docs: pa.Table, size: int, lead: int, width: int, shards: int) -> pa.Table:
    """The block's sketch: cells of leading tokens, each document counted once."""
    _, _, _, h, doc = (own := Block(docs)).anchors(size, lead)
    n = np.uint64(max(1, len(own.rows)))
    both = np.unique((h % np.uint64(width)) * n + doc.astype(np.uint64)) // n
    cells, count = np.unique(both, return_counts=True)
    per = -(-width // shards)
    cut = np.searchsorted(cells, np.arange(shards + 1, dtype=np.uint64) * np.uint64(per))
    out = [(0, int(s), block, pack_sorted(cells[cut[s] : cut[s + 1]] - np.uint64(s * per)), zstandard.compress(np.packbits(count[cut[s] : cut[s + 1]] > 1).tobytes(), 1)) for s in np.flatnonzero(np.diff(cut))]
    cols = list(zip(*out, strict=True)) if out else [()] * 5
    return pa.table([pa.array(c, t) for c, (_, t) in zip(cols, _SKETCH, strict=True)], pa.schema(_SKETCH))


def shared_anchors(own: Block, replies: pa.Table, size: int, lead: int, width: int, shards: int):
    """The anchors whose leading tokens two documents may hold."""
    got = own.anchors(size, lead)
    if not replies.num_rows or not len(got[0]):
        return tuple(x[:0] for x in got)
    bits = {s: b for s, b in zip(replies["shard"].to_pylist(), replies["bits"].to_pylist(), strict=True)}
    cells, back = np.unique(got[3] % np.uint64(width), return_inverse=True)
    per = -(-width // shards)
    cut = np.searchsorted(cells, np.arange(shards + 1, dtype=np.uint64) * np.uint64(per))
    ok = np.concatenate([np.unpackbits(np.frombuffer(zstandard.decompress(bits[int(s)]), np.uint8), count=int(cut[s + 1] - cut[s])) for s in np.flatnonzero(np.diff(cut))])
    keep = ok[back] > 0
    return tuple(x[keep] for x in got)


def leading(text: np.ndarray, at: np.ndarray, lead: int) -> np.ndarray:
    return np.ascontiguousarray(text[at[:, None] + np.arange(lead)]).view(f"S{lead}").ravel()


def turned(text: np.ndarray, start: np.ndarray, at: np.ndarray, size: int, lead: int) -> np.ndarray:
    """Each string as its leading token, the place of that in it, and its bytes from the token's end on, round to the token again."""
    k = at - start
    rest = start[:, None] + (k[:, None] + np.arange(lead, size)) % size
    place = k[:, None] >> np.array([8, 0]) & 255
    return np.ascontiguousarray(np.concatenate([text[at[:, None] + np.arange(lead)], place.astype(np.uint8), text[rest]], axis=1)).view(f"S{size + 2}").ravel()


class Splitters:
    """Sampled strings, turned, in order: what they tell of leading tokens, hot ones, and strings that several of them equal."""

    def __init__(self, picks: list[bytes], size: int, lead: int):
        self.strings = np.array(picks, f"S{size + 2}")
        self.tokens = np.array([p[:lead] for p in picks], f"S{lead}")
        self.hot = np.unique(self.tokens[1:][self.tokens[1:] == self.tokens[:-1]])
        self.shared = np.unique(self.strings[1:][self.strings[1:] == self.strings[:-1]])

    def deal(self, own: Block, block: int, got: tuple, size: int, lead: int, parts: int) -> tuple[np.ndarray, ...]:
        """Bucket, anchor, first and last string start, document number of every record; those of hot tokens are cut where the bucket changes."""
        at, first, last, h, doc = got
        tokens = leading(own.bytes, at, lead)
        bucket = np.searchsorted(self.tokens, tokens, side="right") * parts + (h >> np.uint64(7)).astype(np.int64) % parts
        hot = np.isin(tokens, self.hot)
        out, rest = [(bucket[~hot], at[~hot], first[~hot], last[~hot], doc[~hot])], np.flatnonzero(hot)
        ends = np.cumsum(last[rest] - first[rest] + 1)
        for rec in np.split(rest, np.unique(np.searchsorted(ends, np.arange(STRINGS, ends[-1], STRINGS)))) if len(rest) else ():
            if not len(rec):
                continue
            n = last[rec] - first[rec] + 1
            which = np.repeat(rec, n)
            start = first[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            keys = turned(own.bytes, start, at[which], size, lead)
            left, right = np.searchsorted(self.strings, keys, side="left"), np.searchsorted(self.strings, keys, side="right")
            over = (right - left) * parts
            words = np.zeros((len(keys), -(-(size + 2) // 8) * 8), np.uint8)
            words[:, : size + 2] = keys.view(np.uint8).reshape(len(keys), size + 2)
            mix = np.zeros(len(keys), np.uint64)
            for w in words.view("<u8").T:
                mix = mixed(mix ^ w)
            to = np.where(right - left > 1, (left + 1) * parts + block % np.maximum(over, 1), right * parts + (mix >> np.uint64(7)).astype(np.int64) % parts)
            a = np.flatnonzero(np.concatenate([[True], (which[1:] != which[:-1]) | (to[1:] != to[:-1])]))
            z = np.append(a[1:], len(to)) - 1
            out.append((to[a], at[which[a]], start[a], start[z], doc[which[a]]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


_SUFFIX = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("records", pa.binary())])
_RUNS = pa.schema([("block", pa.int64()), ("starts", pa.binary()), ("shared", pa.int64()), ("least", pa.int64())])


def records(docs: pa.Table, replies: pa.Table, splitters: Splitters, size: int, lead: int, width: int, shards: int, parts: int = 1) -> pa.Table:
    """A block's suffix records, dealt to buckets; equal ones are one record with several places."""
    if not docs.num_rows:
        return _SUFFIX.empty_table()
    own = Block(docs)
    got = shared_anchors(own, replies, size, lead, width, shards)
    if not len(got[0]):
        return _SUFFIX.empty_table()
    raw, block, out = own.bytes.tobytes(), docs["block"][0].as_py(), []
    bucket, at, first, last, doc = splitters.deal(own, block, got, size, lead, parts)
    order = np.argsort(bucket, kind="stable")
    names, cut = np.unique(bucket[order], return_index=True)
    for b, mine in zip(names.tolist(), np.split(order, cut[1:]), strict=True):
        same: dict[tuple[bytes, int], list[tuple[int, int]]] = {}
        for a, f, z, d in zip(at[mine].tolist(), first[mine].tolist(), last[mine].tolist(), doc[mine].tolist(), strict=True):
            same.setdefault((raw[f : z + size], a - f), []).append((d, f))
        keys = sorted(same, key=lambda k: k[0][k[1] :])  # near suffixes share bytes, which compresses
        places = [sorted(same[k]) for k in keys]
        flat = [p for own_places in places for p in own_places]
        out.append((int(b), block, framed(
            zstandard.compress(b"".join([k[0] for k in keys]), 3), pack(np.array([len(k[0]) for k in keys], np.uint64)), pack(np.array([k[1] for k in keys], np.uint64)),
            pack(np.array([len(p) for p in places], np.uint64)), pack(own.ids[[d for d, _ in flat]].view(np.uint64)), pack(np.array([f for _, f in flat], np.uint64)),
        )))
    cols = list(zip(*out, strict=True))
    return pa.table([pa.array(c, t) for c, t in zip(cols, _SUFFIX.types, strict=True)], schema=_SUFFIX)


def multikey_sort(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of n rows of big-endian 8-byte words, and for each in that order whether it differs from the one before.

    A multikey quicksort: a range of rows is parted at a pivot into those whose word is less, the same and more; only the same go
    on to the next word. Ranges of up to SMALL rows are sorted outright on the words that are left.
    """
    n, words = strings.shape
    order, ranges = np.arange(n), [(0, n, 0)]
    while ranges:
        lo, hi, w = ranges.pop()
        if hi - lo < 2 or w == words:
            continue
        rows = order[lo:hi]
        if hi - lo <= SMALL:
            order[lo:hi] = rows[np.lexsort(strings[rows, w:].T[::-1])]
            continue
        key = strings[rows, w]
        pivot = np.sort(key[:: len(key) // 9][:9])[4]
        less, more = key < pivot, key > pivot
        order[lo:hi] = np.concatenate([rows[less], rows[~(less | more)], rows[more]])
        a, b = lo + int(less.sum()), hi - int(more.sum())
        ranges += [(lo, a, w), (a, b, w + 1), (b, hi, w)]
    new = np.ones(n, bool)
    new[1:] = (strings[order[1:]] != strings[order[:-1]]).any(axis=1)
    return order, new


def compare(suffixes: pa.Table, splitters: Splitters, size: int, lead: int) -> pa.Table:
    """Sort a bucket's strings and give, for each block, the starts of those that a document of smaller id holds too.

    Of a string that several splitters equal, the starts that no document seen here takes are given with its number and the
    smallest id seen here, to be compared with what its other buckets have seen.
    """
    texts, lens, anchors_, counts, ids, places, blocks = [], [], [], [], [], [], []
    for block, raw in zip(suffixes["block"].to_pylist(), suffixes["records"].to_pylist(), strict=True):
        text, *rest = unframed(raw)
        ln, an, co, i, p = (unpack(x) for x in rest)
        texts.append(np.frombuffer(zstandard.decompress(text), np.uint8))
        lens.append(ln.astype(np.int64))
        anchors_.append(an.astype(np.int64))
        counts.append(co.astype(np.int64))
        ids.append(i.view(np.int64))
        places.append(p.astype(np.int64))
        blocks.append(np.full(len(co), block, np.int64))
    text, lens, anchor, counts, ids, places, blocks = (np.concatenate(x) for x in (texts, lens, anchors_, counts, ids, places, blocks))
    begin, head = np.cumsum(lens) - lens, np.cumsum(counts) - counts
    # Records of several blocks that are alike throughout are one from here on, with the smallest id of them all.
    raw, known = text.tobytes(), {}
    same = np.array([known.setdefault((raw[f : f + n], a), len(known)) for f, n, a in zip(begin.tolist(), lens.tolist(), anchor.tolist(), strict=True)], np.int64)
    least = np.full(len(known), (1 << 63) - 1, np.int64)
    np.minimum.at(least, same, ids[head])
    pick = np.zeros(len(known), np.int64)
    pick[same] = np.arange(len(same))
    del known
    begin, anchor, strings = begin[pick], anchor[pick], lens[pick] - size + 1
    # Only records whose leading tokens another record holds, here or in another bucket.
    tokens = leading(text, begin + anchor, lead)
    order = np.argsort(tokens, kind="stable")
    run = np.cumsum(np.concatenate([[True], tokens[order[1:]] != tokens[order[:-1]]])) - 1
    alone = (np.bincount(run)[run] == 1) & ~np.isin(tokens[order], splitters.hot)
    a = 0
    order, run = order[~alone], run[~alone]
    ends = np.flatnonzero(np.append(run[1:] != run[:-1], True)) + 1 if len(run) else []
    until, total = 0, np.cumsum(strings[order]) if len(order) else np.zeros(0, np.int64)
    best = np.repeat(least, strings)  # of each string of each record
    row0 = np.cumsum(strings) - strings
    number_of = np.full(len(best) if len(splitters.shared) else 0, -1, np.int64)
    while a < len(order):
        limit = (total[a - 1] if a else 0) + STRINGS
        until = np.searchsorted(total, limit, side="right")
        k = max(np.searchsorted(ends, until, side="right") - 1, np.searchsorted(ends, a, side="right"))
        b = int(ends[min(k, len(ends) - 1)])
        rec = order[a:b]
        if total[b - 1] - (total[a - 1] if a else 0) <= STRINGS:
            which = np.repeat(rec, strings[rec])
            sorts = [(which, np.arange(len(which)) - np.repeat(np.cumsum(strings[rec]) - strings[rec], strings[rec]))]
        else:  # strings that differ in the place of the token are not alike
            sorts = ((rec[ok], anchor[rec[ok]] - k) for k in range(size - lead + 1) if (ok := (anchor[rec] >= k) & (anchor[rec] - k < strings[rec])).any())
        for which, number in sorts:
            cols = np.zeros((len(which), -(-size // 8) * 8), np.uint8)
            cols[:, :size] = text[(begin[which] + number)[:, None] + np.arange(size)]
            sort, new = multikey_sort(cols.view(">u8").astype(np.uint64))
            group, heads = np.cumsum(new) - 1, np.flatnonzero(new)
            smallest = np.minimum.reduceat(least[which[sort]], heads)
            best[row0[which[sort]] + number[sort]] = smallest[group]
            if len(number_of):
                one = sort[heads]
                keys = turned(text, begin[which[one]] + number[one], (begin + anchor)[which[one]], size, lead)
                at = np.searchsorted(splitters.shared, keys)
                at = np.where(splitters.shared[np.minimum(at, len(splitters.shared) - 1)] == keys, at, -1)
                number_of[row0[which[sort]] + number[sort]] = at[group]
        a = b
    # A place loses a string if its document's id is above the string's smallest.
    owner = np.repeat(np.arange(len(counts)), counts)
    rec, held = same[owner], np.repeat(np.arange(len(places)), strings[same[owner]])
    number = np.arange(len(held)) - np.repeat(np.cumsum(strings[rec]) - strings[rec], strings[rec])
    string = row0[rec[held]] + number
    lost = ids[held] > best[string]
    out = []

    def tell(chosen: np.ndarray, shared: int | None, smallest: int | None) -> None:
        start, block = (places[held] + number)[chosen], blocks[owner[held]][chosen]
        by = np.argsort(block, kind="stable")
        names, firsts = np.unique(block[by], return_index=True)
        for x, s in zip(names.tolist(), np.split(start[by], firsts[1:]) if len(names) else (), strict=True):
            out.append((x, pack_sorted(np.sort(s).astype(np.uint64)), shared, smallest))

    tell(lost, None, None)
    if len(number_of):
        open_ = np.flatnonzero(~lost & (number_of[string] >= 0))
        by = open_[np.argsort(number_of[string[open_]], kind="stable")]
        names, firsts = np.unique(number_of[string[by]], return_index=True)
        for x, chosen in zip(names.tolist(), np.split(by, firsts[1:]) if len(names) else (), strict=True):
            tell(chosen, x, int(best[string[chosen[0]]]))
    cols = list(zip(*out, strict=True)) if out else [()] * 4
    return pa.table([pa.array(c, t) for c, t in zip(cols, _RUNS.types, strict=True)], schema=_RUNS)


def remove(docs: pa.Table, starts: pa.Table, size: int) -> pa.Table:
    schema = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("content", pa.binary()), ("none", pa.bool_())])
    own = Block(docs) if docs.num_rows else None
    if own is None:
        return schema.empty_table()
    step = np.zeros(len(own.bytes) + 1, np.int32)
    for raw in starts["starts"].to_pylist():
        at = unpack_sorted(raw).astype(np.int64)
        np.add.at(step, at, 1)
        np.add.at(step, at + size, -1)
    gone = np.cumsum(step[:-1]) > 0
    done = {}
    for pair, a, b in zip(own.rows, own.begins[:-1].tolist(), own.begins[1:].tolist(), strict=True):
        g = gone[a:b]
        spans = int((g & ~np.concatenate([[False], g[:-1]])).sum()) if b > a else 0
        done[pair] = (pair[0], b - a, int(g.sum()), spans, own.bytes[a:b][~g].tobytes() if spans else pair[1])
    out = [done[x] for x in zip(docs["id"].to_pylist(), docs["text"].cast(pa.binary()).to_pylist(), strict=True)]
    cols = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=False)]
    return pa.table([*cols, docs["none"]], schema=schema)


def deduplicate_bytes(docs: DataFrame, size: int = SIZE, lead: int = LEAD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and content (the bytes left) for every row of docs.

    Texts are UTF-8 bytes. A byte goes if a string of ``size`` bytes over it also starts in a document of smaller id; what is
    left may be cut within a character. Null, empty and shorter texts lose nothing (null: no bytes). A null id ranks last, with
    the largest one, and stays null. Rows of one id never cost each other anything, whatever their texts, and come back as often as they came.
    Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(id_of(id_col).alias("id"), text_of(text_col).alias("text"), F.col(id_col).isNull().alias("none"))
    n_bytes = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-n_bytes // BLOCK_BYTES))
    n_anchors = max(1, 2 * n_bytes // (size - lead + 2))
    width = max(1024, CELLS * n_anchors)
    shards = max(1, -(-width // SHARD_CELLS))
    buckets = max(1, -(-n_anchors // BUCKET_RECORDS))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(blocks, 100_000))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)).cast("long")).repartition(parts, "block")
    ranges = min(buckets, RANGES)
    splitters, per_range = sampled_splitters(rows, n_bytes, ranges, size, lead), -(-buckets // ranges)

    def first_pass(docs: pa.Table) -> pa.Table:
        return prefilter(docs["block"][0].as_py(), docs, size, lead, width, shards)

    def merge(rows: pa.Table) -> pa.Table:
        return merged(rows, width, shards)

    def second_pass(docs: pa.Table, replies: pa.Table) -> pa.Table:
        return records(docs, replies, splitters, size, lead, width, shards, per_range)

    def sort(rows: pa.Table) -> pa.Table:
        return compare(rows, splitters, size, lead)

    def last_pass(docs: pa.Table, starts: pa.Table) -> pa.Table:
        return remove(docs, starts, size)

    sketched = dealt.groupBy("block").applyInArrow(first_pass, "row int, shard int, block long, cells binary, many binary")
    replies = sketched.groupBy("shard").applyInArrow(merge, "row int, shard int, block long, bits binary")
    suffixes = dealt.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(second_pass, "bucket long, block long, records binary")
    starts = suffixes.groupBy("bucket").applyInArrow(sort, "block long, starts binary, shared long, least long")
    if len(splitters.shared):  # a row for each bucket of such a string and block of its smallest id there
        seen = Window.partitionBy("shared", F.when(F.col("shared").isNull(), F.col("block")))
        starts = starts.withColumn("smallest", F.min("least").over(seen)).where("shared IS NULL OR least > smallest")
    done = dealt.groupBy("block").cogroup(starts.groupBy("block")).applyInArrow(last_pass, "id long, n_bytes long, n_removed long, n_spans long, content binary, none boolean")
    return done.select(F.when(~F.col("none"), F.col("id")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "content")


def sampled_splitters(rows: DataFrame, n_bytes: int, ranges: int, size: int, lead: int) -> Splitters:
    """Strings, turned, that cut all suffixes into ``ranges`` about even ranges, from one of each of SAMPLED anchors for a range."""
    if ranges < 2:
        return Splitters([], size, lead)
    share = SAMPLED * ranges * (size - lead + 2) / 2 / n_bytes

    def run(batches):
        for batch in batches:
            out = []
            for i, x in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                text = np.frombuffer(x, np.uint8)
                at, first, last, h = anchors(text, size, lead)
                # Document and place take part, so that the places of one token are sampled one by one.
                draw = mixed(h ^ mixed(np.uint64(i * 0x9E3779B97F4A7C15 % (1 << 64)) ^ at.astype(np.uint64)))
                some = np.flatnonzero(draw >> np.uint64(1) < np.uint64(int(share * (1 << 63))))
                start = first[some] + (mixed(draw[some]) % (last - first + 1)[some].astype(np.uint64)).astype(np.int64)
                out += [k.ljust(size + 2, b"\0") for k in turned(text, start, at[some], size, lead).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["lead"])

    # Documents are thinned before they are cut up; the sample serves the balance alone, never the result.
    some = rows.where(F.pmod(F.xxhash64("text", "id"), F.lit(8)) == 0).select("id", "text")
    share = min(1.0, 8 * share)
    got = sorted(r["lead"] for r in some.mapInArrow(run, "lead binary").collect())
    picks = [got[i * len(got) // ranges] for i in range(1, ranges)] if got else []
    hot = {a[:lead] for a, b in zip(picks, picks[1:], strict=False) if a[:lead] == b[:lead]}
    step = max(1, SAMPLED // FINER)
    fine = [k for _, keys in groupby((k for k in got if k[:lead] in hot), key=lambda k: k[:lead]) for k in list(keys)[::step]]
    return Splitters(sorted([p for p in {p[:lead]: p for p in picks}.values() if p[:lead] not in hot] + fine), size, lead)
