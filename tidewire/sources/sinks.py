"""Sinks: appended tables, rejects beside them, capped spending and stage ledgers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    df.write.mode("append").partitionBy(*(partition_by or [])).parquet(path)


def split_rejects(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that hold to every rule, and the others with the name of the first rule they break (null breaks a rule)."""
    reason = F.coalesce(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()])
    marked = df.withColumn("reason", reason)
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")


def upsert_sum(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Counters added up by key: the state after the new rows."""
    return old.select(*keys, value).unionByName(new.select(*keys, value)).groupBy(*keys).agg(F.sum(value).alias(value))


def capped_spend(requests: DataFrame, caps: DataFrame, key: str, order: list[str], amount: str, cap: str) -> DataFrame:
    """Each request with ``admitted``: it fits what is left of its key's cap, those before it that did not fit aside.

    Whether a request fits hangs on all before it, so a key's requests (of one day, by contract) are folded in order in one task.
    """
    rows = requests.join(caps.select(key, F.col(cap).alias("_cap")), key).select(key, *order, amount, "_cap")

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, used, ok = pdf.sort_values(order), 0.0, []
        for x, top in zip(pdf[amount], pdf["_cap"], strict=True):
            ok.append(used + x <= top)
            used += x if ok[-1] else 0.0
        return pdf.drop(columns="_cap").assign(admitted=ok)

    schema = StructType([*[f for f in rows.schema.fields if f.name != "_cap"], StructField("admitted", BooleanType())])
    return rows.groupBy(key).applyInPandas(fold, schema)


def save_state(df: DataFrame, path: str) -> None:
    """A small table as a new version beside the old ones; readers see a version once it is whole."""
    spark = df.sparkSession
    df.withColumn("saved", F.lit(_versions(spark, path) + 1)).write.mode("append").partitionBy("saved").parquet(path)


def load_state(spark: SparkSession, path: str) -> DataFrame:
    """The newest version."""
    return spark.read.parquet(path).where(F.col("saved") == _versions(spark, path)).drop("saved")


def _versions(spark: SparkSession, path: str) -> int:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return 0
    names = [x.getPath().getName() for x in fs.listStatus(at)]
    return max((int(n.split("=")[1]) for n in names if n.startswith("saved=")), default=0)


def report_lines(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows as lines of a Markdown table, its head first: (place, line)."""
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), F.lit(" |"))
    head = df.sparkSession.createDataFrame([(-2, "| " + " | ".join(columns) + " |"), (-1, "|" + "-|" * len(columns))], "place long, line string")
    return head.unionByName(df.select(F.monotonically_increasing_id().alias("place"), line.alias("line")))


def stage_ledger(stages: DataFrame, stage: str, reason: str, n: str) -> DataFrame:
    """Per stage: the items of each drop reason as one map."""
    per = stages.groupBy(stage, reason).agg(F.sum(n).alias(n))
    return per.groupBy(stage).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(reason, n)))).alias("dropped"), F.sum(n).alias("total"))


def lead_media(media: DataFrame, story: str, kind: str, when: str, most: int = 6) -> DataFrame:
    """The latest of each kind, at most ``most`` of a story."""
    latest = media.withColumn("nth", F.row_number().over(Window.partitionBy(story, kind).orderBy(F.desc(when)))).where("nth = 1")
    return latest.withColumn("nth", F.row_number().over(Window.partitionBy(story).orderBy(F.desc(when), kind))).where(F.col("nth") <= most).drop("nth")
