"""Connected components and hierarchies over edge tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shared_dir(spark) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only where none is set."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: driver and executors need a folder that they share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidewire-"))
        at = spark.sparkContext.getCheckpointDir()
    return at


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidewire/{uuid.uuid4().hex}"
    df.write.parquet(path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Rows (node, component): component is the smallest node reachable. Nodes without an edge do not appear.

    Alternates large-star and small-star steps, which finish in a number of rounds logarithmic in the longest chain. A round
    never makes more links than it was given, and hubs are pre-aggregated by the partial minimum.
    """
    e = edges.select(F.least(src, dst).alias("a"), F.greatest(src, dst).alias("b")).where("a < b").distinct()
    e = cut_lineage(e)
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Large star: the larger neighbours of a node link to its smallest neighbour.
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        # Small star: a node and its smaller neighbours link to the smallest of them.
        small_least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(small_least, "b").select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y")).where("x < y")
        new = cut_lineage(small.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        # It has ended when the links are stars: each node has one smaller neighbour, which has none itself.
        bad = new.groupBy("b").agg(F.count("*").alias("n")).where("n > 1").select("b").unionByName(new.join(new.select(F.col("b").alias("a")).distinct(), "a", "left_semi").select("b"))
        e = new
        if bad.isEmpty():
            return e.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(e.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
