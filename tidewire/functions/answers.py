"""Answers of models as VARIANT: lists of snippets, bare or wrapped, in whatever shape they come, and their place in the text.

Everything is done by JSON and VARIANT expressions inside the JVM; an answer that cannot be read costs no other one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds of snippets and the one for others; keys under which a list is looked for, in order; lengths of a text.
KINDS, OTHER_KIND = ["quote", "stat", "fact", "summary", "claim"], "fact"
WRAPPERS = ["snippets", "results", "items", "data"]
SHORTEST, LONGEST, MOST = 20, 300, 5


def parsed(raw: Column) -> Column:
    """The answer as VARIANT: as it stands, or without a fence of back-ticks, or from its first bracket to the last; null if none is JSON.

    What follows a whole value is passed over."""
    fenced = F.regexp_extract(raw, r"(?s)```(?:json)?\s*(.*?)```", 1)
    inner = F.regexp_extract(raw, r"(?s)([\[{].*[\]}])", 1)
    return F.coalesce(*[F.try_parse_json(F.nullif(x, F.lit(""))) for x in (raw, fenced, inner)])


def listed(answer: Column) -> Column:
    """The list in an answer as an array of VARIANT: itself, or under the first of the wrapping keys that holds one; else null."""
    as_list = lambda path: F.try_variant_get(answer, path, "array<variant>")
    return F.coalesce(*[as_list(p) for p in ("$", *[f"$.{k}" for k in WRAPPERS])])


def outcome(raw: Column) -> Column:
    """What became of an answer: empty, unreadable, not a list, or read."""
    answer = parsed(raw)
    return F.when(F.coalesce(F.trim(raw), F.lit("")) == "", "empty").when(answer.isNull(), "unreadable").when(listed(answer).isNull(), "not a list").otherwise("read")


def _field(item: Column, name: str, kind: str) -> Column:
    return F.try_variant_get(item, f"$.{name}", kind)


def _is_text(item: Column, name: str) -> Column:
    return F.schema_of_variant(_field(item, name, "variant")) == "STRING"


def snippets(answers: DataFrame, raw: str, text: str) -> DataFrame:
    """A row for each valid snippet among an answer's first five entries: the other columns, with place, kind, snippet, confidence,
    and begins, the code point of text where the snippet stands (null where it stands nowhere, or was cut).

    Entries that are no objects, or whose text is no string of 20 characters, are passed over; a longer text than 300 is cut and
    marked. A confidence that is no number is 80, others are held to 0 to 100; an unknown kind is a fact.
    """
    keep = [c for c in answers.columns if c not in (raw, text)]
    rows = answers.select(*[F.col(f"`{c}`") for c in keep], F.col(text).alias("__text"), F.posexplode(F.slice(listed(parsed(F.col(raw))), 1, MOST)).alias("place", "item"))
    item = F.col("item")
    said = F.when(_is_text(item, "text"), F.regexp_replace(_field(item, "text", "string"), r"(?U)^\s+|\s+$", ""))
    rows = rows.withColumn("__said", said).where(F.length("__said") >= SHORTEST)
    number = _field(item, "confidence", "double")
    cut = F.length("__said") > LONGEST
    kind = F.when(_is_text(item, "type") & _field(item, "type", "string").isin(KINDS), _field(item, "type", "string")).otherwise(OTHER_KIND)
    at = F.expr("position(__said, __text)")
    return rows.select(
        *[F.col(f"`{c}`") for c in keep], "place", kind.alias("kind"), F.when(cut, F.concat(F.substring("__said", 1, LONGEST - 3), F.lit("..."))).otherwise(F.col("__said")).alias("snippet"),
        F.coalesce(F.when(number.isNotNull() & ~F.isnan(number), F.greatest(F.lit(0.0), F.least(F.lit(100.0), number)).cast("int")), F.lit(80)).alias("confidence"), F.when(at > 0, at - 1).cast("long").alias("begins"),
    )
