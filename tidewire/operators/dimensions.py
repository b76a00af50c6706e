"""Dimension lookups by domain, and name variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def suffixes(domain: Column) -> Column:
    """A domain and what is left of it label by label, itself first."""
    parts = F.split(F.lower(F.trim(domain)), r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def owner_groups(rows: DataFrame, domain: str, owners: DataFrame, default: str = "Independent") -> DataFrame:
    """rows with owner: that of the domain itself, else of the first known domain that it is below, else the default.

    owners holds (known, owner, ordinal). Distinct domains are looked up, each by its few suffixes, in one equi-join.
    """
    own = rows.select(F.col(domain).alias("d")).distinct().select("d", F.posexplode(suffixes(F.col("d"))).alias("below", "known"))
    best = own.join(owners, "known").groupBy("d").agg(F.min_by("owner", F.struct((F.col("below") > 0).alias("suffix"), "ordinal")).alias("owner"))
    return rows.join(best.withColumnRenamed("d", domain), domain, "left").withColumn("owner", F.coalesce("owner", F.lit(default)))


def tiers(rows: DataFrame, domain: str, known: DataFrame, default: int) -> DataFrame:
    """rows with tier: of several tiers that list a domain the first, else the default; (known, tier)."""
    best = known.groupBy(F.col("known").alias(domain)).agg(F.min("tier").alias("tier"))
    return rows.join(best, domain, "left").withColumn("tier", F.coalesce("tier", F.lit(default)))


def name_variants(name: Column) -> Column:
    """Spellings under which a place's name is found: as it is, parts around a comma swapped, without brackets, without an article."""
    low = F.lower(name)
    swapped = F.when(F.contains(name, F.lit(",")), F.concat(F.trim(F.split_part(low, F.lit(","), F.lit(2))), F.lit(" "), F.trim(F.split_part(low, F.lit(","), F.lit(1)))))
    return F.array_distinct(F.filter(F.array(low, swapped, F.trim(F.regexp_replace(low, r"\s*\(.*?\)", "")), F.trim(F.regexp_replace(low, r"^the\s+", ""))), lambda v: v.isNotNull() & (v != "")))
