"""Stories: units grouped by the entities they share, one after the other, and viewpoints within a story."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from itertools import chain, combinations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.operators.graph import connected_components, cut_lineage

JACCARD = 0.4
STORED = 10
#: Rows, on average, whose components are folded in one go.
GROUPED = 8192
#: Entities up to which a story is found by the parts it shares; each story is listed under 2^SMALL of them at most.
SMALL = 6
#: Hours for which a story that is pending or blocked takes further units.
RECENT_HOURS = 48


def attach(units: list[tuple[int, int, frozenset]], threshold: float = JACCARD, stored: int = STORED, stories: list[tuple[int, frozenset]] = ()) -> list[int]:
    """For units in order, the story that each joins: one of those given, in their order, or one that an earlier unit founded.

    A unit joins the story of the greatest Jaccard similarity from the threshold on, the oldest of equals, and adds its entities; a
    unit without entities, or without a story near enough, founds one of its first ``stored`` entities in order. Only stories
    that share an entity with a unit are looked at.
    """
    names, sets = [s for s, _ in stories], [set(e) for _, e in stories]
    # Stories by their size and entity, and small ones by their size and each part of theirs that a unit as near can share.
    sized: dict[int, dict] = {}
    parts: dict[int, dict[tuple, list[int]]] = {}
    ranks: dict[int, list] = {}

    def of(k: int) -> Iterator[tuple]:
        own = sorted(sets[k])
        return chain.from_iterable(combinations(own, c) for c in range(max(1, math.ceil(threshold * len(own) - 1e-9)), len(own) + 1))

    def enter(k: int) -> None:
        m = len(sets[k])
        held = sized.setdefault(m, {})
        for e in sets[k]:
            held.setdefault(e, set()).add(k)
        if m <= SMALL:
            held = parts.setdefault(m, {})
            for part in of(k):
                heapq.heappush(held.setdefault(part, []), k)

    def leave(k: int) -> None:
        held = sized[len(sets[k])]
        for e in sets[k]:
            held[e].discard(k)

    for k in range(len(sets)):
        enter(k)
    out = []
    for _, unit, entities in units:
        own, best, most = frozenset(entities), None, 0.0
        if len(own) <= SMALL:
            best, most = _nearest_small(own, sets, parts, threshold, ranks)
        best = _nearest(own, sets, sized, threshold, best, most)
        if best is None:
            best = len(sets)
            names.append(unit)
            sets.append(set(sorted(entities)[:stored]))
            enter(best)
        elif not sets[best].issuperset(entities):
            leave(best)
            sets[best].update(entities)
            enter(best)
        out.append(names[best])
    return out


def _nearest_small(own: frozenset, sets: list[set], parts: dict[int, dict[tuple, list[int]]], threshold: float, ranks: dict[int, list]) -> tuple[int | None, float]:
    """The nearest of the stories of at most SMALL entities, the first of equals, and its similarity, for a unit of no more.

    Similarities are tried from the greatest on. One is had where a story of m entities shares c with own, so the stories of that size
    that hold some c of own's are looked up; none of them shares more, as it would have been found before. So a unit costs as many
    looks as it has parts, however many stories there are. A story that has grown stays in the lists of its old size until it comes up there.
    """
    n, ordered = len(own), sorted(own)
    if n not in ranks:
        tried: dict[float, list[tuple[int, int]]] = {}
        for m in range(1, SMALL + 1):
            for c in range(1, min(n, m) + 1):
                if (j := c / (n + m - c)) >= threshold:
                    tried.setdefault(j, []).append((m, c))
        ranks[n] = sorted(tried.items(), reverse=True)
    for j, tried in ranks[n]:
        best = None
        for m, c in tried:
            held = parts.get(m)
            for part in combinations(ordered, c) if held else ():
                first = held.get(part)
                while first and len(sets[first[0]]) != m:
                    heapq.heappop(first)
                if first and (best is None or first[0] < best):
                    best = first[0]
        if best is not None:
            return best, j
    return None, 0.0


def _nearest(own: frozenset, sets: list[set], sized: dict[int, dict], threshold: float, best: int | None = None, most: float = 0.0) -> int | None:
    """The place of the set of the greatest Jaccard similarity with own, from the threshold on and above zero, the first of equals.

    With own of SMALL elements at most, the nearest of the sets that are no larger is known (best, most), and only larger ones are
    looked at. Sizes are tried from the likest on, until none can be as near as the best found. A set of m elements that is as near
    as that shares at least ``least`` with own, so it holds one of all but least - 1 of own's elements: those that fewest sets of that
    size hold.
    """
    n = len(own)
    if not n:
        return None
    for m in sorted((m for m in sized if m > (SMALL if n <= SMALL else 0)), key=lambda m: -min(n, m) / max(n, m)):
        near = max(threshold, most)
        if min(n, m) / max(n, m) < near - 1e-9:
            break
        least = max(1, math.ceil(near * (n + m) / (1 + near) - 1e-9))
        held = sorted(filter(None, (sized[m].get(e) for e in own)), key=len)
        if len(held) < least:
            continue
        met = set().union(*held[: len(held) - least + 1])
        for k in met:
            shared = len(own & sets[k])
            if shared >= least:
                j = shared / (n + m - shared)
                if j >= threshold and (j > most or j == most and k < best):
                    best, most = k, j
    return best


def build_stories(units: DataFrame, threshold: float = JACCARD, recent: DataFrame | None = None) -> DataFrame:
    """unit_id and story_id (a recent story, or the first unit of a new one) for units of (unit_id, day, entities array<string>), in the order of day and unit.

    recent holds (story_id, entities) of the stories that still take units. A story only grows by units that share an entity
    with it, so units that no chain of shared entities links never meet: each component of that graph is folded by itself. Units
    link to the first unit or story of each of their entities, never all with all. Units that share nothing found stories of their own
    without being folded, and some GROUPED rows' components are folded in one go, as they never meet in it.
    """
    rows = units.select(F.lit(1).alias("kind"), F.col("unit_id").alias("node"), F.col("day").cast("long").alias("day"), "entities")
    if recent is not None:
        rows = rows.unionByName(recent.select(F.lit(0).alias("kind"), F.col("story_id").alias("node"), F.lit(None).cast("long").alias("day"), "entities"))
    # Stories and units may have the same number: a node's name is twice it, and one more for a unit.
    rows = rows.withColumn("key", F.col("node") * 2 + F.col("kind"))
    each = rows.select("key", F.explode(F.array_distinct("entities")).alias("e"))
    hub = each.groupBy("e").agg(F.min("key").alias("src"))
    edges = each.join(hub, "e").select("src", F.col("key").alias("dst")).where("src != dst")
    parts = connected_components(edges).withColumnsRenamed({"node": "key", "component": "part"})
    lone = rows.where("kind = 1").join(parts, "key", "left_anti").select(F.col("node").alias("unit_id"), F.col("node").alias("story_id"))
    groups = max(1, -(-parts.count() // GROUPED))
    keyed = rows.join(parts, "key").select("kind", "node", "day", "entities", F.pmod(F.xxhash64("part"), F.lit(groups)).alias("group"))

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        sets = [frozenset(e if e is not None else ()) for e in pdf["entities"]]
        pdf = pdf.assign(own=sets).sort_values(["kind", "day", "node"])
        old, new = pdf[pdf["kind"] == 0], pdf[pdf["kind"] == 1]
        stories = attach([*zip(new["day"], new["node"], new["own"], strict=True)], threshold, stories=[*zip(old["node"], old["own"], strict=True)])
        return pd.DataFrame({"unit_id": new["node"], "story_id": stories})

    return keyed.groupBy("group").applyInPandas(fold, "unit_id long, story_id long").unionByName(lone)


def grown(units: DataFrame, assigned: DataFrame, recent: DataFrame | None = None) -> DataFrame:
    """(story_id, entities, updated) of the stories that units joined: the first STORED entities in order, and their latest unit's day."""
    each = assigned.join(units, "unit_id").select("story_id", "day", "entities")
    if recent is not None:
        each = each.unionByName(recent.join(assigned.select("story_id").distinct(), "story_id", "left_semi").select("story_id", F.lit(None).cast("long").alias("day"), "entities"))
    sets = each.groupBy("story_id").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("entities")))), 1, STORED).alias("entities"), F.max("day").alias("updated"))
    return sets.select("story_id", "entities", "updated")


def stories_by_run(units: DataFrame, threshold: float = JACCARD, hours: int = RECENT_HOURS) -> DataFrame:
    """unit_id and story_id for units of (unit_id, at: epoch seconds, entities), run by run: a run takes the units of one day.

    A run's units see the stories that a unit joined in the hours before the run's first unit, so a story that was left alone for
    longer takes no more, and a run reads those few stories and its own day, not the past. Within a run the units are folded as
    in build_stories, by components of that run alone.
    """
    rows = cut_lineage(units.select("unit_id", F.col("at").cast("long").alias("at"), F.floor(F.col("at") / 86400).alias("day"), "entities"))
    days = [r[0] for r in rows.select("day").distinct().orderBy("day").collect()]
    out, stories = None, None
    for day in days:
        run = rows.where(F.col("day") == day)
        begins = run.agg(F.min("at")).first()[0]
        recent = None if stories is None else cut_lineage(stories.where(F.col("updated") >= begins - hours * 3600))
        seen = None if recent is None else recent.select("story_id", "entities")
        assigned = cut_lineage(build_stories(run.select("unit_id", "day", "entities"), threshold, seen))
        now = grown(run.select("unit_id", F.col("at").alias("day"), "entities"), assigned, seen)
        if recent is not None:
            now = now.unionByName(recent.join(now, "story_id", "left_anti"))
        stories = cut_lineage(now)
        out = assigned if out is None else out.unionByName(assigned)
    return out if out is not None else rows.select("unit_id", F.col("unit_id").alias("story_id"))


def viewpoints(members: DataFrame, least: int = 3) -> DataFrame:
    """(story_id, label, units) of stories with at least ``least`` units and two labels, of rows (story_id, unit_id, label)."""
    per = members.groupBy("story_id", "label").agg(F.countDistinct("unit_id").alias("units"))
    whole = per.groupBy("story_id").agg(F.sum("units").alias("n"), F.count("*").alias("labels")).where((F.col("n") >= least) & (F.col("labels") >= 2))
    return per.join(whole.select("story_id"), "story_id", "left_semi")
