"""A sample frozen by strata, checked against the digests that were recorded, and the labels that go with it."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewire.functions.answers import KINDS, SHORTEST

#: Version that a file of labels must have.
GOLD_VERSION = "gold/v1"


def stratified(rows: DataFrame, strata: list[tuple[str, Column, int]], size: Column, id_col: str) -> DataFrame:
    """(id, stratum) of a sample: each stratum in turn takes its so many largest rows that none before it took, ties by id.

    A stratum's rows are among its largest as many as all strata up to it take, since no more can have gone before. So one pass
    keeps that many of each, and the turns are taken over what is left: a few times the sample, whatever the table.
    """
    reach, total = [], 0
    for name, condition, most in strata:
        total += most
        reach.append((name, condition, total))
    each = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(k).alias("k"), F.lit(t).alias("reach"))) for k, (_, c, t) in enumerate(reach)]))
    met = rows.select(F.col(id_col).alias("id"), size.alias("size"), F.explode(each).alias("s")).select("id", "size", "s.k", "s.reach")
    nth = F.row_number().over(Window.partitionBy("k").orderBy(F.desc("size"), "id"))
    near = met.withColumn("nth", nth).where(F.col("nth") <= total).where(F.col("nth") <= F.col("reach"))

    order = [(name, most) for name, _, most in strata]

    def turns(pdf: pd.DataFrame) -> pd.DataFrame:
        taken: dict = {}
        for k, (name, most) in enumerate(order):
            own = pdf[(pdf["k"] == k) & ~pdf["id"].isin(taken)].sort_values("nth")["id"].head(most)
            taken |= dict.fromkeys(own, name)
        return pd.DataFrame({"id": list(taken), "stratum": list(taken.values())})

    kind = rows.schema[id_col].dataType.simpleString()
    return near.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(turns, f"id {kind}, stratum string")  # at most strata * total rows, both parameters


def frozen(sample: DataFrame, articles: DataFrame) -> DataFrame:
    """(id, stratum, fault) of a frozen sample (id, stratum, body_sha256) against articles (id, body): missing, changed, or null."""
    now = articles.select("id", F.sha2(F.coalesce("body", F.lit("")).cast("binary"), 256).alias("now"))
    j = sample.join(now, "id", "left")
    return j.select("id", "stratum", F.when(F.col("now").isNull(), "missing").when(F.col("now") != F.col("body_sha256"), "changed").alias("fault"))


def gold_labels(spark: SparkSession, path: str, version: str = GOLD_VERSION) -> DataFrame:
    """(article, place, text, type, entities, confidence, position, fault) of a file of labels; another version is an error.

    fault names the first rule that a label breaks: its text has fewer than 20 characters, its type is none, its confidence is not
    within 0 to 100 (80 if it has none) or its position not within 0 to 1 (a half).
    """
    label = "struct<text:string,type:string,entities:array<string>,confidence:double,position:double,note:string>"
    data = spark.read.schema(f"gold_version string, items map<string,struct<snippets:array<{label}>>>").option("multiLine", True).json(path)
    found = [r[0] for r in data.select("gold_version").collect()]  # a file, a row
    if any(v != version for v in found):
        raise ValueError(f"labels of version {found} where {version!r} is wanted")
    s = data.select(F.explode("items").alias("article", "item")).select("article", F.posexplode("item.snippets").alias("place", "s")).select("article", "place", "s.*")
    s = s.withColumns({"text": F.trim("text"), "type": F.lower(F.trim("type")), "confidence": F.coalesce("confidence", F.lit(80.0)), "position": F.coalesce("position", F.lit(0.5))})
    within = lambda c, hi: F.coalesce(F.col(c).between(0, hi), F.lit(False))
    fault = F.when(F.length(F.coalesce("text", F.lit(""))) < SHORTEST, "text").when(~F.coalesce(F.col("type").isin(KINDS), F.lit(False)), "type").when(~within("confidence", 100), "confidence").when(~within("position", 1), "position")
    return s.select("article", "place", "text", "type", F.coalesce("entities", F.array().cast("array<string>")).alias("entities"), "confidence", "position", fault.alias("fault"))


#: Ways to spoil a list of snippets on purpose, to see whether a score notices; the last one must change none.
PERTURBATIONS = ["drop_confidence", "collapse_type", "cycle_type", "truncate_text", "first_only", "shout_entities"]
#: Length to which texts are cut: one less than the shortest that is kept.
CUT = SHORTEST - 1


def perturbed(answers: DataFrame, snippets: str) -> DataFrame:
    """A row for each answer and perturbation: the other columns, perturbation, the spoilt list, and whether anything changed.

    snippets is an array of (text, type, confidence, entities).
    """
    s = F.col(snippets)
    kinds = F.array(*[F.lit(k) for k in KINDS])
    each = lambda **new: F.transform(s, lambda x: F.struct(*[new.get(f, lambda y, f=f: y[f])(x).alias(f) for f in ("text", "type", "confidence", "entities")]))
    turned = lambda x: F.when(F.array_contains(kinds, x["type"]), F.element_at(kinds, (F.array_position(kinds, x["type"]) % len(KINDS) + 1).cast("int"))).otherwise(x["type"])
    ways = {
        "drop_confidence": each(confidence=lambda x: F.lit(None).cast("int")), "collapse_type": each(type=lambda x: F.lit("summary")), "cycle_type": each(type=turned),
        "truncate_text": each(text=lambda x: F.substring(x["text"], 1, CUT)), "first_only": F.slice(s, 1, 1), "shout_entities": each(entities=lambda x: F.transform(x["entities"], F.upper)),
    }
    kind = "array<struct<text:string,type:string,confidence:int,entities:array<string>>>"
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("perturbation"), w.cast(kind).alias("spoilt")) for n, w in ways.items()]))
    keep = [c for c in answers.columns if c != snippets]
    return answers.withColumn("__was", s.cast(kind)).select(*keep, "__was", rows.alias("x")).select(*keep, "x.*", (~F.col("x.spoilt").eqNullSafe(F.col("__was"))).alias("changed"))
