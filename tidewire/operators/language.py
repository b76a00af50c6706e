"""Language of texts by character n-grams: naive Bayes over hashed n-grams of one to three characters.

Profiles are fitted on at most PER_LANGUAGE texts of each language (the smallest hashes of their ids, so the choice is the same
at every run) and at most LANGUAGES languages, those of most texts; n-grams are hashed to CELLS cells. So a model is at
most LANGUAGES x CELLS numbers whatever the corpus, and is sent to every task. Every text is scored whole, where it lies: no shuffle.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PER_LANGUAGE, LANGUAGES, CELLS, SIZES, LEAST = 400, 64, 1 << 15, (1, 2, 3), 12
_OTHER = re.compile(r"[\W\d_]+")


def grams(text: str) -> np.ndarray:
    """Cells of the n-grams of a text in lower case, its words parted by one space."""
    c = np.frombuffer((" " + _OTHER.sub(" ", text.lower()).strip() + " ").encode("utf-32-le"), np.uint32).astype(np.uint64)
    out, h = [], np.zeros(len(c), np.uint64)
    with np.errstate(over="ignore"):
        for n in range(1, max(SIZES) + 1):
            h = h[: len(c) - n + 1] * np.uint64(0x100000001B3) + c[n - 1 :]
            if n in SIZES and len(h):
                x = (h + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
                out.append(x >> np.uint64(64 - CELLS.bit_length() + 1))
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)


def sampled(docs: DataFrame, id_col: str, lang_col: str, per_language: int = PER_LANGUAGE) -> DataFrame:
    """The texts that profiles are fitted on: rows (id, lang, text columns as they are) of the smallest hashes of a language.

    Hashes above what a language of its size needs, by a wide margin, go before rows are ranked, so that no task ranks a language.
    """
    sizes = docs.where(F.col(lang_col).isNotNull()).groupBy(lang_col).count().orderBy(F.desc("count"), lang_col).limit(LANGUAGES).collect()
    if not sizes:
        return docs.limit(0)
    share = F.create_map(*[x for r in sizes for x in (F.lit(r[0]), F.lit(min(1.0, (2.0 * per_language + 64) / r[1])))])
    hashed = F.xxhash64(F.col(id_col).cast("string"))
    near = docs.withColumn("__hash", hashed).where((F.pmod("__hash", F.lit(1 << 20)) / (1 << 20)) < F.try_element_at(share, F.col(lang_col)))
    nth = F.row_number().over(_by(lang_col).orderBy(F.pmod("__hash", F.lit(1 << 20)), "__hash", id_col))
    return near.withColumn("__nth", nth).where(F.col("__nth") <= per_language).drop("__nth", "__hash")


def _by(col: str):
    from pyspark.sql import Window

    return Window.partitionBy(col)


def fitted(sample: DataFrame, lang_col: str, text_col: str) -> tuple[list[str], np.ndarray]:
    """Languages in order and the log probabilities of cells in each, add-one smoothed."""

    def count(batches):
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                cell, n = np.unique(grams(text or ""), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(cell), pa.string()), pa.array(cell, pa.int64()), pa.array(n, pa.int64())], names=["lang", "cell", "n"])

    rows = sample.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).mapInArrow(count, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(rows["lang"].unique())
    table = np.ones((len(langs), CELLS))
    table[rows["lang"].map({x: k for k, x in enumerate(langs)}).to_numpy(int), rows["cell"].to_numpy(int)] += rows["n"].to_numpy()
    return langs, np.log(table / table.sum(1, keepdims=True)).astype(np.float32)


def detected(text: Column, langs: list[str], table: np.ndarray) -> Column:
    """The likeliest language, the first by name among equals; null for texts that are null, of fewer than 12 characters once
    trimmed, or without a letter."""

    def detect(texts: pd.Series) -> pd.Series:
        return pd.Series([_likeliest(t, langs, table) for t in texts], dtype=object)

    return F.pandas_udf(detect, "string")(text)


def _likeliest(text: str | None, langs: list[str], table: np.ndarray) -> str | None:
    if not langs or text is None or len(text.strip()) < LEAST or not _OTHER.sub("", text):
        return None
    n = np.bincount(grams(text), minlength=CELLS)
    used = np.flatnonzero(n)
    return langs[int((table[:, used].astype(np.float64) * n[used]).sum(1).argmax())]
