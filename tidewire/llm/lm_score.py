"""Language-model scores: a weighted backoff automaton over all n-grams of the training documents.

Tokens are words with A-Z lower-cased, then one end. The model smooths an n-gram by what lies below it,

    p(w | context) = (c(context w) + MU p(w | shorter context)) / (c(context) + MU),    p(w) = (c(w) + 1) / (N + V + 1),

which sums to one and needs counts alone. As an automaton: each n-gram shorter than ORDER is a state, the empty one the root. A
state has an arc for each word seen after it, of weight log10 p, to the longest state that ends in that word; and one failure
arc to the state without its first word, of weight log10(MU / (c + MU)). The root has an arc for every word, unknown ones too.
A text is read once from left to right: the automaton stands in one state, takes failure arcs until there is an arc for the
next token, takes that, and adds up the weights; a document starts in the state of the document's start.

The automaton of a corpus has about as many arcs as the corpus has tokens, and never lies in one place. A block of documents
asks for the counts of its own distinct n-grams, and adds those of its training documents. Shards of the space of n-gram hashes
add up counts over all blocks and answer; a block builds the part of the automaton that its texts can reach from the answers,
with every weight as in the whole, and walks it. Nothing is pruned or capped. N-grams are equal if their 64-bit hashes are.

Sizes of blocks and shards grow with the square root of the corpus once it is large, so that a message from a block to a shard
holds at least MESSAGE n-grams and their number grows as the corpus does, not faster. Blocks are runs of rows where they lie in
the table: docs is a table of files (or a staged result) that reads the same twice; a block checks that answers fit its n-grams.

Null texts are empty (one end token); a row without an id is held out. Rows that repeat count and
are scored as often as they occur. A text longer than a block is a block of its own. No rows: no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import shuffle_parts, staged, text_of
from tidewire.llm.substring_dedup import mixed, pack_sorted, unpack_sorted, word_hashes

ORDER, MU = 3, 100.0
#: Bytes of text in a block and tokens' n-grams in a shard, at least; and n-grams in a message, on average at least.
BLOCK_BYTES, SHARD_TOKENS, MESSAGE = 5 << 20, 1 << 20, 64
TOKEN_BYTES = 6
#: Shards or blocks that one task takes one after the other, about.
GROUPS = 4
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: No word has a space in it, so these are no words.
START, END = b" s", b" e"
_EDGE = {x: np.uint64(xxhash.xxh3_64_intdigest(x)) for x in (START, END)}
_BASE = np.uint64(0x9E3779B97F4A7C15)
_COUNTS = [("order", pa.int32()), ("shard", pa.int32()), ("block", pa.int64()), ("grams", pa.binary()), ("counts", pa.binary())]
_REPLY = [("order", pa.int32()), ("shard", pa.int32()), ("block", pa.int64()), ("counts", pa.binary()), ("total", pa.int64()), ("distinct", pa.int64())]


def is_held_out(id_col: str = "doc_id") -> Column:
    """True for the documents that the model does not learn from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(7)) == 2, F.lit(True))


def pack(n: np.ndarray) -> bytes:
    """Counts, byte planes apart, compressed."""
    width = max(1, -(-int(n.max()).bit_length() // 8)) if len(n) else 1
    return bytes([width]) + zstandard.compress(np.ascontiguousarray(n.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes(), 1)


def unpack(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw[1:]), np.uint8).reshape(raw[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : raw[0]] = planes.T
    return out.view("<u8").ravel().astype(np.int64)


class Tokens:
    """The tokens of some texts end to end, each text behind its start, and the hash of the n-gram that ends at each."""

    def __init__(self, texts: list[bytes], order: int):
        words = [t.translate(_LOWER).split() for t in texts]
        size = np.array([len(w) + 2 for w in words], np.int64)
        self.first = np.cumsum(size) - size
        self.size = size
        own = np.empty(int(size.sum()), np.uint64)
        for at, w in zip(self.first.tolist(), words, strict=True):
            own[at], own[at + 1 : at + 1 + len(w)], own[at + 1 + len(w)] = _EDGE[START], word_hashes(w), _EDGE[END]
        #: Place of each token in its text, the start being 0.
        self.place = np.arange(len(own)) - np.repeat(self.first, size)
        self.grams, run = [mixed(own)], own
        with np.errstate(over="ignore"):
            for _ in range(1, order):
                run = np.concatenate([run[:1], run[:-1] * _BASE + own[1:]]) if len(own) else run
                self.grams.append(mixed(run))

    def whole(self, k: int) -> np.ndarray:
        """Where an n-gram of k tokens ends that lies in one text and does not consist of its start."""
        return self.place >= max(1, k - 1)


def blocks(batches, size: int):
    """Consecutive rows (row, held_out, text, ...) up to about size bytes of text: (number of the first row, rows, texts as bytes)."""
    rows, texts, held = [], [], 0
    for batch in batches:
        raw = batch.column(batch.schema.get_field_index("text")).cast(pa.binary())
        for k, x in enumerate(raw):
            text = x.as_buffer().to_pybytes()
            if rows and held + len(text) > size:
                yield rows[0]["row"], rows, texts
                rows, texts, held = [], [], 0
            rows.append({c: batch.column(i)[k].as_py() for i, c in enumerate(batch.schema.names) if c != "text"})
            texts.append(text)
            held += len(text)
    if rows:
        yield rows[0]["row"], rows, texts


def shard_cuts(grams: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's range of hashes begins in the sorted hashes, and their end."""
    per = -(-(1 << 64) // shards)
    return np.concatenate([np.searchsorted(grams, np.array([s * per for s in range(shards)], np.uint64)), [len(grams)]])


def asked(block: int, texts: list[bytes], learns: np.ndarray, order: int, shards: int) -> pa.RecordBatch:
    """One row for each order and shard: the block's distinct n-grams and their counts in its training documents."""
    tokens, out = Tokens(texts, order), []
    learnt = np.repeat(learns, tokens.size)
    for k in range(1, order + 1):
        whole = tokens.whole(k)
        known, n = np.unique(tokens.grams[k - 1][whole & learnt], return_counts=True)
        grams = np.union1d(known, tokens.grams[k - 1][whole & ~learnt])
        counts = np.zeros(len(grams), np.int64)
        counts[np.searchsorted(grams, known)] = n
        cuts = shard_cuts(grams, shards)
        out += [(k, int(s), block, pack_sorted(grams[cuts[s] : cuts[s + 1]]), pack(counts[cuts[s] : cuts[s + 1]])) for s in np.flatnonzero(np.diff(cuts))]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out, strict=True), _COUNTS, strict=True)], schema=pa.schema(_COUNTS))


def answered(asks: pa.Table) -> pa.Table:
    """Add up a shard's counts over all blocks, and answer each block's n-grams in their order; one row carries the shard's sums."""
    grams = [unpack_sorted(x) for x in asks["grams"].to_pylist()]
    counts = [unpack(x) for x in asks["counts"].to_pylist()]
    size = np.array([len(g) for g in grams])
    distinct, which = np.unique(np.concatenate(grams), return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, which, np.concatenate(counts))
    ends = np.cumsum(size)
    first = [1] + [0] * (len(size) - 1)
    return pa.table(
        [asks["order"], asks["shard"], asks["block"], pa.array([pack(total[which[e - n : e]]) for e, n in zip(ends.tolist(), size.tolist(), strict=True)], pa.binary()),
         pa.array([int(total.sum()) * f for f in first], pa.int64()), pa.array([int((total > 0).sum()) * f for f in first], pa.int64())], schema=pa.schema(_REPLY))


class Automaton:
    """The part of the automaton that some texts reach.

    For each order: the count of each distinct n-gram (an arc where it is not 0), the arc's weight, the failure weight of the
    state that the n-gram is, and the n-gram that ends at each token.
    """

    def __init__(self, tokens: Tokens, counts: list[np.ndarray], n: int, v: int, mu: float):
        self.tokens, self.counts, self.weight, self.fail, self.gram = tokens, counts, [], [], []
        documents, chance = 0, []
        for k, count in enumerate(counts, 1):
            whole = np.flatnonzero(tokens.whole(k))
            grams, at, which = np.unique(tokens.grams[k - 1][whole], return_index=True, return_inverse=True)
            if len(grams) != len(count):
                raise RuntimeError(f"{len(count)} answers to {len(grams)} n-grams: the table did not read the same twice")
            gram = np.zeros(len(tokens.place), np.int64)
            gram[whole] = which
            if k == 1:
                documents = int(count[which[np.searchsorted(whole, tokens.first[0] + tokens.size[0] - 1)]])
                p = (count + 1) / (n + v + 1)
            else:
                # An n-gram is known by where it first ends: one token to the left ends its context, and there ends its suffix too.
                end = whole[at]
                before = self.counts_at(k - 1, end - 1, documents)
                p = np.where(before > 0, (count + mu * chance[-1][self.gram[-1][end]]) / (before + mu), chance[-1][self.gram[-1][end]])
            chance.append(p)
            self.gram.append(gram)
            self.weight.append(np.log10(p))
            self.fail.append(np.log10(mu / (count + mu)))
        self.start = (documents, np.log10(mu / (documents + mu)))

    def counts_at(self, k: int, at: np.ndarray, documents: int | None = None) -> np.ndarray:
        """Count of the n-gram of k tokens that ends at each place; that of a start is the number of training documents."""
        count = self.counts[k - 1][self.gram[k - 1][at]]
        at_start = self.tokens.place[at] == 0
        return np.where(at_start, (documents if documents is not None else self.start[0]) if k == 1 else 0, np.where(self.tokens.place[at] >= k - 1, count, 0))

    def walk(self) -> np.ndarray:
        """log10 probability of each text.

        All tokens' steps are taken side by side, as the state before a token is the longest n-gram of the model that ends at the
        token before it, whatever path led there: with an n-gram the model has all that end it.
        """
        t = self.tokens
        here = np.flatnonzero(t.place >= 1)
        state = np.zeros(len(here), np.int64)
        for k in range(1, len(self.counts)):
            state[self.counts_at(k, here - 1) > 0] = k
        score, done = np.zeros(len(here)), np.zeros(len(here), bool)
        for k in range(len(self.counts) - 1, 0, -1):
            stands = (state == k) & ~done
            arc = stands & (self.counts_at(k + 1, here) > 0)
            score[arc] += self.weight[k][self.gram[k][here[arc]]]
            done |= arc
            fails = stands & ~arc
            at = here[fails] - 1
            score[fails] += np.where(t.place[at] == 0, self.start[1], self.fail[k - 1][self.gram[k - 1][at]]) if k == 1 else self.fail[k - 1][self.gram[k - 1][at]]
            state[fails] = k - 1
        score[~done] += self.weight[0][self.gram[0][here[~done]]]
        return np.add.reduceat(score, t.first - np.arange(len(t.first)))


def score_documents(docs: DataFrame, order: int = ORDER, mu: float = MU, block_bytes: int = BLOCK_BYTES, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every document."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), is_held_out().alias("held_out"), text_of("text").alias("text"))
    size = docs.agg(F.sum(F.length(text_of("text").cast("binary")).cast("long") + TOKEN_BYTES)).first()[0]
    out = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    if size is None:
        return docs.sparkSession.createDataFrame([], out)
    root = int((MESSAGE * size / TOKEN_BYTES) ** 0.5)
    block_bytes, shard_tokens = max(block_bytes, root * TOKEN_BYTES), max(shard_tokens, root)
    shards = max(1, -(-size // (TOKEN_BYTES * shard_tokens)))

    def ask(batches):
        for block, own, texts in blocks(batches, block_bytes):
            yield asked(block, texts, ~np.array([r["held_out"] for r in own]), order, shards)

    def dealt(batches):
        for block, own, texts in blocks(batches, block_bytes):
            cols = [[r[c] for r in own] for c in ("row", "doc_id", "held_out")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * len(own), pa.int64()), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.bool_()), pa.array(texts, pa.binary())],
                names=["block", "row", "doc_id", "held_out", "text"],
            )

    def spread(df: DataFrame, groups: int, *keys: str) -> DataFrame:
        """By the keys of the grouping that follows, into more partitions than the session's if there are far more groups."""
        parts = groups // GROUPS
        return df.repartition(parts, *keys) if parts > shuffle_parts(df.sparkSession) else df

    asks = spread(rows.mapInArrow(ask, "order int, shard int, block long, grams binary, counts binary"), order * shards, "order", "shard")
    replies = staged(asks.groupBy("order", "shard").applyInArrow(answered, "order int, shard int, block long, counts binary, total long, distinct long"))
    n, v = replies.where("order = 1").agg(F.sum("total"), F.sum("distinct")).first()

    def score(own: pa.Table, got: pa.Table) -> pa.Table:
        own = own.sort_by("row")
        got = got.sort_by([("order", "ascending"), ("shard", "ascending")])
        counts, level, raw = [[] for _ in range(order)], got["order"].to_pylist(), got["counts"].to_pylist()
        for k, x in zip(level, raw, strict=True):
            counts[k - 1].append(unpack(x))
        tokens = Tokens([x.as_buffer().to_pybytes() for x in own["text"]], order)
        model = Automaton(tokens, [np.concatenate(c) if c else np.zeros(0, np.int64) for c in counts], n, v, mu)
        here = tokens.place >= 1
        known = np.add.reduceat(here & (model.counts_at(1, np.arange(len(here))) > 0), tokens.first, dtype=np.int64)
        base = np.add.reduceat(np.where(here, model.weight[0][model.gram[0]], 0.0), tokens.first)
        return pa.table(
            [own["doc_id"], own["held_out"], pa.array(tokens.size - 1, pa.int64()), pa.array(known, pa.int64()), pa.array([n] * len(own), pa.int64()), pa.array(base, pa.float64()), pa.array(model.walk(), pa.float64())],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    runs = size // block_bytes
    texts = spread(rows.mapInArrow(dealt, "block long, row long, doc_id long, held_out boolean, text binary"), runs, "block")
    told = spread(replies.select("block", "order", "shard", "counts"), runs, "block")
    return texts.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(score, out)
