"""Entities: normal forms, display surfaces, surname index, resolution by alias and surname, and deterministic minting."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Titles before a name; types whose names drop a leading article.
HONORIFICS = ["mr", "mrs", "ms", "dr", "prof", "president", "prime minister", "pm", "secretary", "minister", "potus", "justice", "prince", "princess", "mahatma"]
ARTICLE_TYPES = ["GPE", "ORG"]
# Spellings of one entity, as (type, alias, display name).
ALIASES = [
    ("GPE", "US", "United States"), ("GPE", "U.S.", "United States"), ("GPE", "USA", "United States"), ("GPE", "America", "United States"), ("GPE", "the US", "United States"), ("GPE", "UK", "United Kingdom"),
    ("GPE", "Britain", "United Kingdom"), ("GPE", "Great Britain", "United Kingdom"), ("GPE", "the UK", "United Kingdom"), ("GPE", "UAE", "United Arab Emirates"), ("GPE", "Holland", "Netherlands"),
    ("ORG", "EU", "European Union"), ("ORG", "the EU", "European Union"), ("ORG", "UN", "United Nations"), ("ORG", "the UN", "United Nations"), ("ORG", "FBI", "Federal Bureau of Investigation"), ("ORG", "CIA", "Central Intelligence Agency"),
    ("ORG", "DoD", "Department of Defense"), ("ORG", "Pentagon", "Department of Defense"), ("ORG", "SCOTUS", "Supreme Court of the United States"), ("ORG", "WHO", "World Health Organization"),
    ("ORG", "NATO", "North Atlantic Treaty Organization"), ("ORG", "EC", "European Commission"), ("ORG", "IMF", "International Monetary Fund"),
    ("PERSON", "Trump", "Donald Trump"), ("PERSON", "Biden", "Joe Biden"), ("PERSON", "Pence", "Mike Pence"), ("PERSON", "Obama", "Barack Obama"), ("PERSON", "Musk", "Elon Musk"), ("PERSON", "Netanyahu", "Benjamin Netanyahu"),
    ("PERSON", "Putin", "Vladimir Putin"), ("PERSON", "Zelensky", "Volodymyr Zelensky"), ("PERSON", "Volodymyr Zelenskyy", "Volodymyr Zelensky"), ("PERSON", "Khamenei", "Ali Khamenei"), ("PERSON", "Macron", "Emmanuel Macron"),
    ("PERSON", "Merkel", "Angela Merkel"), ("PERSON", "Modi", "Narendra Modi"), ("PERSON", "Harris", "Kamala Harris"),
]
_TITLE = "(?i)^(?:(?:" + "|".join(sorted(HONORIFICS, key=lambda x: -len(x))) + r")\.?\s+)+"


def _folded(texts: pd.Series) -> pd.Series:
    """Compatibility decomposition without combining marks."""
    return texts.map(lambda t: None if t is None else "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)))


def folded(text: Column) -> Column:
    """Accents folded; text that is ASCII stays in the JVM's hands."""
    return F.when(text.rlike(r"^\p{ASCII}*$"), text).otherwise(F.pandas_udf(_folded, "string")(text))


def without_titles(text: Column) -> Column:
    return F.regexp_replace(text, _TITLE, "")


def _key(folded_text: Column, kind: Column) -> Column:
    """``TYPE:name`` of a name in lower case without accents: titles, a possessive, an article, punctuation off."""
    s = F.regexp_replace(without_titles(folded_text), "['’]s$", "")
    s = F.when(kind.isin(ARTICLE_TYPES), F.regexp_replace(s, r"^the\s+", "")).otherwise(s)
    s = F.trim(F.regexp_replace(F.regexp_replace(s, r"[^\p{L}\p{N}_\s-]", ""), r"\s+", " "))
    return F.concat(kind, F.lit(":"), s)


def normal(surface: Column, kind: Column) -> Column:
    return _key(folded(F.lower(F.trim(surface))), kind)


def alias_index(spark) -> DataFrame:
    """(key, display) of the known spellings: a fixed table of some forty rows."""
    rows = spark.createDataFrame(ALIASES, "kind string, alias string, display string")
    return rows.select(normal(F.col("alias"), F.col("kind")).alias("key"), "display").groupBy("key").agg(F.max("display").alias("display"))


def display_surfaces(mentions: DataFrame, places: tuple[str, ...] = ("GPE", "LOC")) -> DataFrame:
    """mentions (surface, kind, ...) with display: the known name of a spelling, else the name without title, possessive and, of a place, what follows a comma."""
    bare = F.trim(F.regexp_replace(without_titles(F.trim(F.regexp_replace("surface", r"[\s\p{Z}]+", " "))), "['’]s$", ""))
    head = F.trim(F.split_part("bare", F.lit(","), F.lit(1)))
    m = mentions.withColumn("bare", bare).withColumn("head", F.when(F.col("kind").isin(*places) & F.contains("bare", F.lit(",")) & (head != ""), head))
    m = m.withColumns({"k1": normal(F.col("bare"), F.col("kind")), "k2": normal(F.coalesce("head", F.lit("")), F.col("kind"))})
    known = alias_index(mentions.sparkSession)
    j = m.join(F.broadcast(known.toDF("k1", "d1")), "k1", "left").join(F.broadcast(known.toDF("k2", "d2")), "k2", "left")
    return j.select(*mentions.columns, F.coalesce("d1", F.when(F.col("head").isNotNull(), F.coalesce("d2", "head")), "bare").alias("display"))


def mint(key: Column) -> Column:
    """The same id for the same normal form, run after run."""
    return F.sha2(key.cast("binary"), 256)


def surname_index(entities: DataFrame) -> DataFrame:
    """(surname, entity_id) of persons' last words that only one entity has; entities: entity_id, kind, name."""
    last = entities.where("kind = 'PERSON'").select("entity_id", F.lower(F.element_at(F.split(F.trim("name"), r"\s+"), -1)).alias("surname"), F.size(F.split(F.trim("name"), r"\s+")).alias("words")).where("words > 1")
    return last.groupBy("surname").agg(F.countDistinct("entity_id").alias("n"), F.min("entity_id").alias("entity_id")).where("n = 1").select("surname", "entity_id")


def resolve(mentions: DataFrame, aliases: DataFrame, surnames: DataFrame) -> DataFrame:
    """mentions (surface, kind, ...) with entity_id and confidence: by alias (1.0), by a lone surname (0.8), else minted (1.0)."""
    m = mentions.withColumn("key", normal(F.col("surface"), F.col("kind")))
    a = aliases.select(F.col("alias").alias("key"), F.col("entity_id").alias("by_alias"))
    s = surnames.select(F.concat(F.lit("PERSON:"), "surname").alias("key"), F.col("entity_id").alias("by_surname"))
    j = m.join(a, "key", "left").join(s, "key", "left")
    return j.select(*mentions.columns, F.coalesce("by_alias", "by_surname", mint(F.col("key"))).alias("entity_id"), F.when(F.col("by_alias").isNull() & F.col("by_surname").isNotNull(), 0.8).otherwise(1.0).alias("confidence"))
