"""Sentences, labels and bands that reads show: column builders over counters and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What each tier means; least tier-1 outlets and owners of a corroborated story.
TIER_MEANING = {1: "verified editorial standards", 2: "national or regional outlet", 3: "social, forums, unverified", 4: "niche, hyperlocal, experimental"}
LEAST_TIER1, LEAST_OWNERS = 2, 2
# Characters of a platform's post.
PLATFORM_LIMITS = {"twitter": 280, "x": 280, "bluesky": 300, "threads": 500, "instagram": 2200, "linkedin": 3000, "facebook": 63206}
NO_HEADLINE, SUMMARY_CHARS = "No headline captured", 600


def counted(n: Column, noun: str) -> Column:
    """1 outlet, 2 outlets."""
    return F.concat(n.cast("string"), F.lit(f" {noun}"), F.when(n == 1, "").otherwise("s"))


def corroborated(t1: Column, owners: Column) -> Column:
    return (t1 >= LEAST_TIER1) & (owners >= LEAST_OWNERS)


def best_tier(tiers: list[Column]) -> Column:
    return F.coalesce(*[F.when(t > 0, k + 1) for k, t in enumerate(tiers)])


def badge_label(t1: Column, owners: Column) -> Column:
    """The badge's verdict in words."""
    return (
        F.when(corroborated(t1, owners), F.concat(F.lit("Corroborated · "), counted(owners, "outlet"))).when(owners >= 2, F.concat(owners.cast("string"), F.lit(" outlets · needs tier-1 confirmation")))
        .when(owners == 1, "Single outlet · unconfirmed").otherwise("No outlets yet")
    )


def counts_pending(tiers: list[Column], owners: Column, sources: Column) -> Column:
    """Sources are listed, and none is tallied yet."""
    return (sources > 0) & (owners <= 0) & (sum(tiers[1:], tiers[0]) <= 0)


def tier_sentence(tiers: list[Column], sources: Column) -> Column:
    """One sentence that names each tier present and what it means."""
    parts = F.filter(F.array(*[F.when(t > 0, F.concat(t.cast("string"), F.lit(f" tier-{k + 1} "), F.when(t == 1, "outlet").otherwise("outlets"), F.lit(f" ({TIER_MEANING[k + 1]})"))) for k, t in enumerate(tiers)]), lambda x: x.isNotNull())
    n = F.size(parts)
    several = F.concat(F.array_join(F.slice(parts, 1, F.greatest(n - 1, F.lit(1))), ", "), F.lit(" and "), F.element_at(parts, -1), F.lit("."))
    none = F.when(sources == 1, "The pipeline has not tallied this story's tiers yet, so the source listed below carries its own tier.").when(
        sources > 1, F.concat(F.lit("The pipeline has not tallied this story's tiers yet, so each of the "), sources.cast("string"), F.lit(" sources listed below carries its own tier."))
    ).otherwise("No sources have been attributed to this story yet.")
    return F.when(n == 0, none).when(n == 1, F.concat(F.get(parts, F.lit(0)), F.lit("."))).otherwise(several)


def corroboration_sentence(t1: Column, owners: Column, sources: Column) -> Column:
    return (
        F.when(corroborated(t1, owners), F.concat(F.lit("Corroborated by "), counted(owners, "outlet"), F.lit(", "), t1.cast("string"), F.lit(" of them tier-1.")))
        .when((owners == 0) & (sources > 0), F.concat(F.lit("Not tallied yet: "), counted(sources, "source"), F.lit(" listed, and the pipeline has not counted this story's outlets, so there is no corroboration verdict to give yet.")))
        .when(owners == 0, "Not corroborated: no outlet has been attributed to this story yet.")
        .when(owners == 1, "Not corroborated: a single outlet carried this story, with no independent confirmation.")
        .otherwise(F.concat(F.lit("Not corroborated: "), counted(owners, "outlet"), F.lit(" carried this story but not two or more tier-1 outlets, so it still needs tier-1 confirmation.")))
    )


def ago(seconds: Column) -> Column:
    """How long ago, coarsely: minutes, hours or days."""
    minutes = F.floor(F.greatest(seconds, F.lit(0)) / 60)
    hours, days = F.floor(minutes / 60), F.floor(minutes / 1440)
    return F.when(seconds.isNull(), "").when(minutes < 2, "just now").when(minutes < 60, F.concat(minutes.cast("string"), F.lit(" min ago"))).when(hours < 24, F.concat(counted(hours, "hour"), F.lit(" ago"))).otherwise(F.concat(counted(days, "day"), F.lit(" ago")))


def freshness(seconds: Column) -> Column:
    """How long ago, in the queue's words: up to weeks, then months."""
    out = F.when(seconds.isNull(), "timestamp not recorded").when(seconds < 90, "just now")
    for size, noun, limit in ((60, "minute", 60), (3600, "hour", 24), (86400, "day", 7), (604800, "week", 5)):
        out = out.when(seconds < size * limit, F.concat(counted(F.greatest(F.floor(seconds / size), F.lit(1)), noun), F.lit(" ago")))
    return out.otherwise(F.concat(F.floor(seconds / 2592000).cast("string"), F.lit(" months ago")))


def freshness_stamp(seconds: Column, outlets: Column, events: Column, window_hours: int = 24) -> Column:
    """The map's line of how fresh it is."""
    outlets, events, window = F.greatest(outlets, F.lit(0)), F.greatest(events, F.lit(0)), f"({window_hours}h)"
    return (
        F.when(seconds.isNull(), "No events recorded yet")
        .when((events > 0) | (outlets == 0), F.concat(F.lit("Updated "), ago(seconds), F.lit(", "), counted(outlets, "outlet"), F.lit(", "), counted(events, "corroborated event"), F.lit(f" {window}")))
        .otherwise(F.concat(F.lit(f"No corroborated events {window}, "), counted(outlets, "outlet"), F.lit(", last event "), ago(seconds)))
    )


def caption(title: Column, facts: Column, urls: Column, platform: str = "twitter") -> Column:
    """The first fact that says something, else the title, clipped so that the link fits the platform."""
    first = lambda a: F.coalesce(F.get(F.filter(F.transform(F.coalesce(a, F.array().cast("array<string>")), lambda x: F.trim(F.coalesce(x, F.lit("")))), lambda x: x != ""), F.lit(0)), F.lit(""))
    base = F.coalesce(F.nullif(first(facts), F.lit("")), F.nullif(F.trim(F.coalesce(title, F.lit(""))), F.lit("")), F.lit("News Update"))
    base, url, limit = F.trim(F.regexp_replace(base, r"[\s\p{Z}]+", " ")), first(urls), PLATFORM_LIMITS.get(platform, 280)
    room = F.lit(limit - 1) - F.length(url)
    return F.when(url == "", F.trim(F.substring(base, 1, limit))).when(room <= 0, F.substring(url, 1, limit)).otherwise(F.concat(F.rtrim(base.substr(F.lit(1), room)), F.lit(" "), url))


def ngrams(text: Column, n: int) -> Column:
    """Distinct n-grams of words; none of a shorter text."""
    words = F.filter(F.split(F.lower(text), r"[\s\p{Z}]+"), lambda x: x != "")
    return F.element_at(F.transform(F.array(words), lambda w: _grams(w, n)), 1)  # the words are made once


def _grams(w: Column, n: int) -> Column:
    return F.when(F.size(w) < n, F.array().cast("array<string>")).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(w, i, n), " "))))


def iso_duration(text: Column) -> Column:
    """Seconds of PTxHxMxS; zero where it is none."""
    part = lambda unit: F.coalesce(F.regexp_extract(text, rf"(\d+){unit}", 1).try_cast("long"), F.lit(0))
    return F.when(text.rlike(r"^PT(?:\d+H)?(?:\d+M)?(?:\d+S)?$"), part("H") * 3600 + part("M") * 60 + part("S")).otherwise(0)


def confidence(value: Column) -> Column:
    """A model's answer as 0 to 100; 80 where it is no number."""
    return F.coalesce(F.least(F.lit(100), F.greatest(F.lit(0), value.try_cast("double").try_cast("int"))), F.lit(80))


def position(value: Column) -> Column:
    """A model's answer from 0 to 1 in millionths; the middle where it is no number."""
    return F.coalesce((value.try_cast("double") * 1000000).try_cast("int"), F.lit(500000))


def confidence_band(value: Column) -> Column:
    return F.when(value.between(0, 24), 0).when(value.between(25, 49), 1).when(value.between(50, 74), 2).otherwise(3)


def position_bucket(value: Column, buckets: int = 5) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(buckets - 1), (value * buckets).cast("int")))
