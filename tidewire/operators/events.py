"""Map events: same-event links, clusters and representatives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.operators.graph import connected_components

DAY_US = 86_400_000_000
RADIUS_KM = 25.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * 6371.0088 * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def same_event_pairs(events: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of one type and story whose 24-hour windows overlap and that lie within both radii.

    An equi-join on type, story and day; each event is in its own day's block and, as the right side, in the next's too.
    """
    day = F.floor(F.col("start") / DAY_US)
    cols = ["event_type", "story_id", "day"]
    left = events.select("event_type", "story_id", day.alias("day"), F.col("id").alias("l"), F.col("start").alias("ls"), F.col("lat").alias("l_lat"), F.col("lon").alias("l_lon"))
    right = events.select("event_type", "story_id", F.explode(F.array(day, day - 1)).alias("day"), F.col("id").alias("r"), F.col("start").alias("rs"), F.col("lat").alias("r_lat"), F.col("lon").alias("r_lon"))
    # Of two events the earlier one, then the smaller id, is on the left, so that each pair is met once.
    pairs = left.join(right, cols).where("(ls < rs OR (ls = rs AND l < r)) AND rs - ls < " + str(DAY_US))
    near = pairs.where(haversine_km(F.col("l_lat"), F.col("l_lon"), F.col("r_lat"), F.col("r_lon")) <= 2 * RADIUS_KM)
    return near.select(F.least("l", "r").alias("a"), F.greatest("l", "r").alias("b"))


def event_clusters(events: DataFrame) -> DataFrame:
    """id and cluster (the smallest id of the closure) of every event."""
    pairs = same_event_pairs(events)
    linked = connected_components(pairs, "a", "b").withColumnsRenamed({"node": "id", "component": "root"})
    return events.join(linked, "id", "left").select("id", F.coalesce("root", "id").alias("cluster"))


def canonical_events(events: DataFrame) -> DataFrame:
    """Per cluster: members, summed source counts and the representative (most tier-1, most sources, earliest, smallest id)."""
    j = events.join(event_clusters(events), "id")
    best = F.struct(-F.col("tier1_source_count"), -F.col("source_count"), "start", "id")
    return j.groupBy("cluster").agg(F.count("*").alias("members"), F.sum("source_count").alias("sources"), F.sum("tier1_source_count").alias("tier1_sources"), F.min_by("id", best).alias("canonical_id"))
