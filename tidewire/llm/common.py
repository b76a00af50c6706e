"""Shared plumbing of the corpus operators: staging, ids, text columns and Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of all word and line contracts: space, tab, \n, \v, \f, \r.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
#: Stands for a null id inside an operator: such a row ranks after all others.
NO_ID = (1 << 63) - 1
#: Arrow batches are worked on in slices of about this many bytes of text.
SLICE_BYTES = 4 << 20
#: Rows of one key in one task of a join, about.
SPREAD = 1024


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where the session names none (tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: driver and executors need a folder that they share")
        at = tempfile.mkdtemp(prefix="tidewire-")
        spark.sparkContext.setCheckpointDir(at)
        at = spark.sparkContext.getCheckpointDir()
    return at


def staged(df: DataFrame) -> DataFrame:
    """Write to the shared folder as Parquet and read it back: lineage ends there, and a lost executor costs no rerun."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidewire/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def text_of(col: str) -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def id_of(col: str) -> Column:
    """The id as a long without nulls: NO_ID for null, so that null ranks last."""
    return F.coalesce(F.col(col).cast("long"), F.lit(NO_ID))


def id_back(col: str) -> Column:
    return F.when(F.col(col) != NO_ID, F.col(col))


def n_parts(df: DataFrame) -> int:
    """Partitions of a scan or staged table, known without running it."""
    return df.rdd.getNumPartitions()


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread_join(left: DataFrame, right: DataFrame, key: str, by: str, per: int = SPREAD) -> DataFrame:
    """left joined to right, which has one row for each key; a key of more than per rows of left goes to several tasks,
    by a hash of column by. Such keys are at most one in per rows of left; each has its row of right once for every part.
    """
    hot = left.groupBy(key).agg(F.count("*").alias("__n")).where(F.col("__n") > per).select(key, F.ceil(F.col("__n") / per).cast("int").alias("__parts"))
    parts = F.coalesce(F.col("__parts"), F.lit(1))
    a = left.join(hot, key, "left").withColumn("__part", F.when(F.col("__parts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(by), F.col("__parts")).cast("int"))).drop("__parts")
    b = right.join(hot, key, "left").withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__parts")
    return a.join(b, [key, "__part"]).drop("__part")


def slices(batches: Iterator[pa.RecordBatch], col: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that none holds much more than SLICE_BYTES of text; a longer single text is a slice of its own."""
    for batch in batches:
        i = batch.schema.get_field_index(col)
        n, size = batch.num_rows, batch.column(i).nbytes
        step = max(1, min(n, n * SLICE_BYTES // max(size, 1)))
        for at in range(0, n, step):
            yield batch.slice(at, step)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def by_text(docs: DataFrame, each: Callable[[list, list], dict], schema: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Map every whole text to one row. each gets the ids and the texts as UTF-8 bytes and returns the other columns.

    The ids pass unchanged (null stays null); repeated rows give repeated rows.
    """

    def run(batches):
        for batch in slices(batches):
            ids = batch.column(0)
            texts = [x.as_buffer().to_pybytes() for x in batch.column(1).cast(pa.binary())] if batch.num_rows else []
            out = each(ids.to_pylist(), texts)
            yield pa.RecordBatch.from_arrays([ids, *out.values()], names=["doc_id", *out])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(run, f"doc_id long, {schema}")
