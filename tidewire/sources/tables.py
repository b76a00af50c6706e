"""The tables of the data model as projections of the driver's Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: 2024-01-01 00:00:00 UTC, the reference time of the projected articles.
EPOCH = 1_704_067_200
#: Rows of a partition, about, where tasks would else grow with the table.
PART = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """df by its keys, in as many partitions as so many rows ask for: the more rows, the more tasks, none of them larger."""
    return df.repartition(max(1, -(-rows // PART)), *keys)


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, body, domain, lang, title, fetched (epoch seconds), tier, owner; columns that are not used are pruned from the scan."""
    n = F.substring("source", 4, 9).cast("int")
    text = F.coalesce("text", F.lit(""))
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), text.alias("body"), F.col("source").alias("domain"), "lang", F.substring(text, 1, 80).alias("title"),
        (F.lit(EPOCH) + F.pmod("doc_id", F.lit(72)) * 3600).cast("long").alias("fetched"), (1 + F.pmod(n, F.lit(4))).cast("int").alias("tier"),
        F.concat(F.lit("owner"), F.pmod(n, F.lit(7)).cast("string")).alias("owner"),
    )


def map_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map events: id, story_id, event_type, start (epoch microseconds), lat, lon, source_count, tier1_source_count."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("user_id").alias("story_id"), "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("start"),
        (F.pmod(F.col("user_id") * 37, F.lit(180)) - 90 + F.col("value") / 1000).alias("lat"), (F.pmod(F.col("user_id") * 53, F.lit(360)) - 180).cast("double").alias("lon"),
        F.coalesce(k, F.lit(0)).alias("source_count"), F.pmod(F.coalesce(k, F.lit(0)), F.lit(3)).alias("tier1_source_count"), "value",
    )


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claim evidence: claim_id, domain, topic, stance, confidence."""
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    stance = F.when(F.col("l_returnflag") == "A", "disputes").when(F.col("l_returnflag") == "R", "supports").otherwise("neutral")
    return line.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("claim_id"), F.col("l_suppkey").alias("domain"), F.col("p_brand").alias("topic"), stance.alias("stance"), F.col("l_quantity").cast("int").alias("confidence"))


def revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article revisions: article_id, revision, content."""
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("article_id"), F.col("turn").alias("revision"), F.coalesce("text", F.lit("")).alias("content"))
