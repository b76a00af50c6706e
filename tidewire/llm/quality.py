"""Quality classifier: nearest-neighbour voting among labelled latent-semantic vectors.

Terms are trigrams of byte classes and bands of word statistics. A bounded sample of labelled documents gives weights for the
terms and, by a singular value decomposition, a latent space; the sample's vectors in it and their labels are broadcast. Every
document of the corpus is projected into the space, and its cosines with all labelled vectors are computed exactly, in blocks. Its
score is the vote of its nearest neighbours, each label weighted by its similarity.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidewire.llm.common import by_text, slices, text_of

#: The bound on labelled rows that are fitted, for each label, taken in the order of a hash of the id.
PER_LABEL = 1536
TERMS, BANDS, DIMENSIONS = 1024, 64, 64
NEIGHBOURS = 41
THRESHOLD = 0.7
#: Documents scored in one matrix product.
BLOCK = 512


def byte_classes() -> np.ndarray:
    """32 classes: vowels, other lower case in four groups, upper case in two, digits, white space, signs, high bytes."""
    out = np.zeros(256, np.int64)
    for i, chars in enumerate(("aeiou", "bcdfg", "hjklm", "npqrs", "tvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ", "0123456789", " ", "\n", "\t\r\x0b\x0c", ".", ",", "!", "?", "'\"", "-_", ":;", "()[]{}", "<>", "/\\|", "#", "%", "&", "*", "$", "@", "+=~^`")):
        out[list(chars.encode())] = i + 1
    out[128:192], out[192:] = 29, 30
    return out


_CLASS = byte_classes()
#: The term of each class trigram, by a multiplicative hash.
_TERM = (np.arange(1 << 15, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(54)).astype(np.int16)


def term_counts(text: bytes) -> np.ndarray:
    """TERMS + BANDS weights: square roots of trigram shares, and one-hot bands of word statistics."""
    out = np.zeros(TERMS + BANDS, np.float32)
    c = _CLASS[np.frombuffer(text, np.uint8)]
    if len(c) > 2:
        got = np.bincount(_TERM[c[:-2] << 10 | c[1:-1] << 5 | c[2:]], minlength=TERMS)
        out[:TERMS] = np.sqrt(got / (len(c) - 2))
    words = text.split()
    n = max(1, len(words))
    stats = (
        len(set(words)) / n ** 0.9,  # repeated words; the power allows for long texts
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        len(text) / n / 16,
        np.log2(len(text) + 1) / 24,
    )
    for i, x in enumerate(stats):
        out[TERMS + 16 * i + min(15, int(x * 16))] = 0.35
    return out


def features(texts: list[bytes]) -> np.ndarray:
    return np.stack([term_counts(x) for x in texts]) if texts else np.zeros((0, TERMS + BANDS), np.float32)


class Model:
    """weights of the terms, the basis of the latent space, the labelled unit vectors and their labels."""

    def __init__(self, x: np.ndarray, y: np.ndarray, dimensions: int = DIMENSIONS, neighbours: int = NEIGHBOURS):
        self.prior = float(y.mean()) if len(y) else 1.0
        self.y, self.neighbours = y.astype(np.float32), neighbours
        if not len(y):
            return
        self.weights = np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))).astype(np.float32) + 1
        x = x * self.weights
        self.mean = x.mean(axis=0)
        _, _, v = np.linalg.svd(x - self.mean, full_matrices=False)
        self.basis = np.ascontiguousarray(v[:dimensions].T, np.float32)
        self.vectors = self.project(x, weighted=True)

    def project(self, x: np.ndarray, weighted: bool = False) -> np.ndarray:
        z = ((x if weighted else x * self.weights) - self.mean) @ self.basis
        return (z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)).astype(np.float32)

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not len(self.y):
            return np.full(len(texts), self.prior)
        out = np.zeros(len(texts))
        k = min(self.neighbours, len(self.y))
        for at in range(0, len(texts), BLOCK):
            cos = self.project(features(texts[at : at + BLOCK])) @ self.vectors.T
            near = np.argpartition(cos, -k, axis=1)[:, -k:]
            # Cosines below zero weigh next to nothing; the floor keeps the vote defined.
            s = np.maximum(np.take_along_axis(cos, near, axis=1), 1e-3).astype(np.float64) ** 4
            out[at : at + BLOCK] = (s * self.y[near]).sum(axis=1) / s.sum(axis=1)
        return np.clip(out, 0, 1)


def held_out(id_col: str):
    """crc32 of the id as text, mod 4, is 2. Rows without an id are held out: they are never learnt from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", per_label: int = PER_LABEL) -> Model:
    """Learn from at most per_label rows of each label that are not held out. Labels other than 0 and 1 (null too) are passed over."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col)).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
    known = known.groupBy("id").agg(F.min("y").alias("y"))  # one label for an id that has several: the lower
    picked = [known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(per_label) for y in (0, 1)]
    picked = picked[0].unionByName(picked[1])
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text")).join(F.broadcast(picked), "id")

    def run(batches):
        for batch in slices(batches):
            x = features([t.as_buffer().to_pybytes() for t in batch.column(1).cast(pa.binary())])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([r.astype("<f4").tobytes() for r in x], pa.binary())], names=["id", "y", "x"])

    vectors = rows.select("id", "text", "y").mapInArrow(run, "id long, y int, x binary").groupBy("id").agg(F.min("y").alias("y"), F.min("x").alias("x"))  # of several texts of one id the least vector
    got = sorted((r["id"], r["y"], r["x"]) for r in vectors.collect())  # at most 2 x per_label vectors
    if not got:
        return Model(np.zeros((0, TERMS + BANDS), np.float32), np.zeros(0))
    return Model(np.stack([np.frombuffer(x, "<f4") for _, _, x in got]), np.array([y for _, y, _ in got]))


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", per_label: int = PER_LABEL, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from the threshold on) for every row of docs.

    The text alone decides the score; a null text is an empty one, and both are scored like any other. Without labels every
    score is 1. Ids (null too) and repeated rows pass as they are. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col, per_label))

    def each(_, texts):
        return {"score": pa.array(shared.value.score(texts), pa.float64())}

    got = by_text(docs, each, "score double", id_col, text_col)
    return got.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", per_label: int = PER_LABEL, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that score at least the threshold, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col, per_label))

    def run(batches):
        for batch in slices(batches, "__text"):
            texts = [x.as_buffer().to_pybytes() for x in batch.column(0).cast(pa.binary())]
            keep = pa.array(model.value.score(texts) >= threshold)
            yield pa.RecordBatch.from_arrays([batch.column(1)], names=["row"]).filter(keep)

    rows = docs.select(text_of(text_col).alias("__text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    out = rows.mapInArrow(run, StructType([StructField("row", rows.schema["row"].dataType)]))
    return out.select([F.col(f"row.`{c}`").alias(c) for c in docs.columns])
