"""Canonical payloads, chains, digests of inputs, and the arithmetic of MinHash estimates: column builders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions import text as T

# Fixed value: the digest from which every chain starts.
GENESIS = "a72e8b07e5acde74bfd7570504562fb846cb173423b82403ebdca8a22ba671ff"
#: Shingle sets up to this size are compared exactly; permutations of a signature.
EXACT, PERMUTATIONS = 64, 128


def canonical_json(fields: dict[str, Column]) -> Column:
    """An object as compact JSON, keys in order; strings are escaped as JSON has it, numbers and booleans are bare."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def chain(leaves: Column) -> Column:
    """The chain hashes of leaves (hexadecimal) in order: each is that of the raw one before it and the raw leaf."""
    step = lambda acc, leaf: F.concat(acc, F.array(F.sha2(F.concat(F.unhex(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(GENESIS))), F.unhex(leaf)), 256)))
    return F.aggregate(leaves, F.array().cast("array<string>"), step)


def rendered(part: Column) -> Column:
    """One part as text; a null is a token of its own."""
    return F.coalesce(part.cast("string"), F.lit("\0none"))


def rendered_set(members: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(members)), "\x1e")


def framed(parts: list[Column]) -> Column:
    """Bytes of the parts, each behind its length as eight bytes."""
    return F.concat(*[x for p in parts for x in (F.unhex(F.lpad(F.hex(F.octet_length(p).cast("long")), 16, "0")), p.cast("binary"))])


def input_hash(version: str, *parts: Column) -> Column:
    return F.sha2(framed([F.lit(f"analyzer_version={version}"), *parts]), 256)


def intersection(jaccard: Column, a: Column, b: Column) -> Column:
    """The size of what two sets of these sizes share, if their Jaccard similarity is that."""
    return jaccard * (a + b) / (1 + jaccard)


def jaccard_sigma(jaccard: Column, permutations: int) -> Column:
    return F.sqrt(F.greatest(jaccard, F.lit(0.0)) * F.greatest(1 - jaccard, F.lit(0.0)) / permutations)


def containment(jaccard: Column, a: Column, b: Column, permutations: int = PERMUTATIONS) -> Column:
    """The share of the smaller set that the other holds; nothing where the estimate says more than its error can explain."""
    small, met = F.least(a, b), intersection(jaccard, a, b)
    error = jaccard_sigma(jaccard, permutations) * (a + b) / F.pow(1 + jaccard, F.lit(2))
    return (
        F.when((a <= 0) | (b <= 0) | (jaccard <= 0), 0.0).when(jaccard >= 1, 1.0).when((met > small) & (met - small > 3 * error), 0.0)
        .otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.try_divide(met, small))))
    )


def signature(shingles: Column, permutations: int = PERMUTATIONS) -> Column:
    """MinHash slots: for each seed the least hash of the shingles."""
    return F.transform(F.sequence(F.lit(1), F.lit(permutations)), lambda s: F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, s))))


def neighbour_containment(revisions: DataFrame) -> DataFrame:
    """(article_id, revision, exact, containment) of each revision's shingles with those of the revision before."""
    w = Window.partitionBy("article_id").orderBy("revision")
    t = revisions.withColumn("before", F.coalesce(F.lag("content").over(w), F.lit("")))
    t = T.with_shingles(T.with_shingles(t, "content", "x"), "before", "y")
    small = F.greatest(F.size("x"), F.size("y")) <= EXACT
    same = F.size(F.filter(F.zip_with(signature(F.col("x")), signature(F.col("y")), lambda p, q: p == q), lambda e: e))
    exact = F.try_divide(F.size(F.array_intersect("x", "y")), F.least(F.size("x"), F.size("y")))
    about = containment(same / PERMUTATIONS, F.size("x").cast("double"), F.size("y").cast("double"))
    return t.select("article_id", "revision", small.alias("exact"), F.when(small, exact).otherwise(about).alias("containment"))
