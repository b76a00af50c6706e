"""Topic groups of stories by keywords, which are a parameter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def match(stories: DataFrame, entities: str, topics: dict[str, list[str]], fallback: str) -> DataFrame:
    """(story, topic, confidence) of stories (story, entities): 10 and 15 for each keyword that the names hold, 100 at most.

    A story that no keyword names has the fallback at 10. All topics are tested in one pass over a story's names.
    """
    text = F.lower(F.array_join(F.coalesce(F.col(entities), F.array().cast("array<string>")), " "))
    of = lambda t, keys: F.struct(F.lit(t).alias("topic"), F.least(F.lit(100), 10 + 15 * sum((F.contains("text", F.lit(k.lower())).cast("int") for k in keys), F.lit(0))).alias("confidence"))
    scored = F.filter(F.array(*[of(t, keys) for t, keys in topics.items()]), lambda x: x["confidence"] > 10)
    none = F.array(F.struct(F.lit(fallback).alias("topic"), F.lit(10).alias("confidence")))
    return stories.select("story", text.alias("text")).select("story", F.inline(F.when(F.size(scored) > 0, scored).otherwise(none)))
