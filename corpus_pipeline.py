"""The corpus pipeline: quality, lines, near copies, secrets, packing.

``STAGES`` are applied in order to ``documents``; each stage's result is written as Parquet to the shared folder and read again as
the next one's input. All but the last return the columns of ``documents``; ``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewire.llm import line_dedup, packing, quality, secret_scan, simhash
from tidewire.llm.common import slices, staged, text_of

#: Near copies: shingles of five words, linked from a Jaccard similarity of their sets on.
SHINGLE_WORDS, SIMILARITY = 5, 0.8


def _with_text(docs: DataFrame, text, columns: list[str]) -> DataFrame:
    changed = docs.withColumn("text", text)
    if "n_chars" in columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select([F.col(f"`{c}`") for c in columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores under its threshold go; labels are those of the table ``labels``."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; documents stay, if with less text."""
    return _with_text(line_dedup.deduplicate_lines(docs), F.col("text"), docs.columns)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id stays of each group of near copies.

    Documents without any words left are linked with one another, as equal texts are, and one of them stays.
    """
    return simhash.one_of_each(docs, SHINGLE_WORDS, SIMILARITY)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets, also those in encoded layers, are replaced by a mark; documents stay."""

    def run(batches):
        for batch in slices(batches):
            texts = [secret_scan.masked(x)[0] for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column(1)], names=["text", "row"])

    rows = docs.select(text_of("text").alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    out = rows.mapInArrow(run, StructType([StructField("text", StringType()), StructField("row", rows.schema["row"].dataType)]))
    return _with_text(out.select("text", *[F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != "text"]), F.col("text"), docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left and their places in sequences of at most 4096 tokens."""
    return packing.pack(docs)


STAGES = [("quality", quality_stage), ("lines", lines_stage), ("near copies", near_copies_stage), ("secrets", secrets_stage), ("packing", packing_stage)]

#: The classifier, the fingerprints and the tokenizer are beyond SQL; tests/llm hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs)
    return docs
