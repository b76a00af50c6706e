"""Tamper-evident logs: leaf hashes, the chain, RFC 6962 trees and proofs.

Levels of a tree are DataFrames: each halves the one below, so a tree of n leaves takes log2 n shuffles of shrinking size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.operators.graph import cut_lineage


def leaf_hash(payload: Column) -> Column:
    return F.sha2(F.concat(F.unhex(F.lit("00")), payload.cast("binary")), 256)


def node_hash(left: Column, right: Column) -> Column:
    return F.sha2(F.concat(F.unhex(F.lit("01")), F.unhex(left), F.unhex(right)), 256)


def levels(leaves: DataFrame, repeat: bool = False) -> list[DataFrame]:
    """(i, h) per level, leaves first; an odd last node is promoted, or paired with itself in the older scheme. leaves has gapless i from 0."""
    out, n = [leaves.select("i", "h")], leaves.count()
    while n > 1:
        below = out[-1]
        pair = below.groupBy(F.floor(F.col("i") / 2).alias("i")).agg(F.max(F.when(F.col("i") % 2 == 0, F.col("h"))).alias("l"), F.max(F.when(F.col("i") % 2 == 1, F.col("h"))).alias("r"))
        right = F.coalesce("r", "l") if repeat else F.col("r")
        up = pair.select("i", F.when(right.isNull(), F.col("l")).otherwise(node_hash(F.col("l"), right)).alias("h"))
        out.append(cut_lineage(up) if len(out) % 8 == 0 else up)
        n = (n + 1) // 2
    return out


def root(leaves: DataFrame) -> DataFrame:
    return levels(leaves)[-1].select(F.col("h").alias("root"))


def inclusion_proofs(leaves: DataFrame) -> DataFrame:
    """(i, level, sibling, is_left) for every leaf: the audit path, without the levels where a node is promoted."""
    tree = levels(leaves)
    out = None
    for k, level in enumerate(tree[:-1]):
        at = leaves.select("i", F.shiftright("i", k).alias("node"))
        sibling = at.withColumn("s", F.when(F.col("node") % 2 == 0, F.col("node") + 1).otherwise(F.col("node") - 1))
        step = sibling.join(level.select(F.col("i").alias("s"), F.col("h").alias("sibling")), "s").select("i", F.lit(k).alias("level"), "sibling", (F.col("node") % 2 == 1).alias("is_left"))
        out = step if out is None else out.unionByName(step)
    return out


def verify(leaves: DataFrame, proofs: DataFrame, root: DataFrame) -> DataFrame:
    """(i, valid): each leaf folded with its path gives the root."""
    path = proofs.groupBy("i").agg(F.array_sort(F.collect_list(F.struct("level", "sibling", "is_left"))).alias("path"))
    fold = lambda acc, s: F.when(s["is_left"], node_hash(s["sibling"], acc)).otherwise(node_hash(acc, s["sibling"]))
    folded = leaves.join(path, "i", "left").select("i", F.coalesce(F.aggregate("path", F.col("h"), fold), F.col("h")).alias("got"))
    return folded.crossJoin(F.broadcast(root)).select("i", (F.col("got") == F.col("root")).alias("valid"))


def proof_paths(leaves: DataFrame, repeat: bool = False) -> DataFrame:
    """(i, path, valid) for every leaf: its audit path (sibling, is_left), and whether that folds to the root.

    With repeat, of the older scheme: an odd level's last node is its own sibling.

    Paths are made from the root down: a node hands its own path, behind its sibling, to its children. Each level is one join of
    that level's nodes, so n leaves cost about two n rows, and not n for each level.
    """
    tree = [cut_lineage(x) for x in levels(leaves, repeat)]
    path = "array<struct<sibling:string,is_left:boolean>>"
    at = tree[-1].select("i", F.array().cast(path).alias("path"))
    for level in reversed(tree[:-1]):
        pair = level.groupBy(F.floor(F.col("i") / 2).alias("up")).agg(F.max(F.when(F.col("i") % 2 == 0, F.col("h"))).alias("l"), F.max(F.when(F.col("i") % 2 == 1, F.col("h"))).alias("r"))
        both = pair.join(at.withColumnRenamed("i", "up"), "up").withColumn("own", F.col("r").isNotNull())
        if repeat:
            both = both.withColumn("r", F.coalesce("r", "l"))
        step = lambda sibling, left: F.when(F.col("r").isNull(), F.col("path")).otherwise(F.concat(F.array(F.struct(sibling.alias("sibling"), F.lit(left).alias("is_left"))), "path"))
        children = F.array(F.struct((F.col("up") * 2).alias("i"), step(F.col("r"), False).alias("path")), F.when(F.col("own"), F.struct((F.col("up") * 2 + 1).alias("i"), step(F.col("l"), True).alias("path"))))
        at = cut_lineage(both.select(F.inline(F.array_compact(children))))
    fold = lambda acc, s: F.when(s["is_left"], node_hash(s["sibling"], acc)).otherwise(node_hash(acc, s["sibling"]))
    folded = tree[0].join(at, "i").select("i", "path", F.aggregate("path", F.col("h"), fold).alias("got"))
    return folded.crossJoin(F.broadcast(tree[-1].select(F.col("h").alias("root")))).select("i", "path", (F.col("got") == F.col("root")).alias("valid"))  # one row


#: Schemes of trees: RFC 6962 (leaves with a prefix, odd nodes promoted) and the older one (bare leaves, odd nodes repeated).
RFC, OLD = "rfc6962", "ct/v1"


def _shifted(c: Column, k: Column) -> Column:
    return F.call_function("shiftright", c, k)


def fold_steps(payload: Column, i: Column, size: Column, siblings: Column, scheme: Column) -> Column:
    """The nodes from the leaf to the root that a proof leads through; null where it cannot be one.

    It cannot if scheme, size or index are none, or if it has another number of siblings than a leaf at that place.
    """
    leaf = F.when(scheme == RFC, leaf_hash(payload)).otherwise(F.sha2(payload.cast("binary"), 256))
    at = F.transform(F.sequence(F.lit(0), F.lit(62)), lambda k: F.struct(k.alias("k"), _shifted(i, k).alias("node"), _shifted(size - 1, k).alias("last")))
    at = F.filter(at, lambda x: (x["last"] > 0) & ((scheme == OLD) | (x["node"] != x["last"]) | (x["last"] % 2 == 1)))
    steps = F.zip_with(at, siblings, lambda x, s: F.struct((x["node"] % 2 == 1).alias("left"), s.alias("sibling")))
    up = lambda acc, s: F.concat(acc, F.array(F.when(s["left"], node_hash(s["sibling"], F.element_at(acc, -1))).otherwise(node_hash(F.element_at(acc, -1), s["sibling"]))))
    able = scheme.isin(RFC, OLD) & (size > 0) & (i >= 0) & (i < size) & (F.size(at) == F.size(siblings))
    return F.when(able, F.aggregate(steps, F.array(leaf), up))


def included(payload: Column, i: Column, size: Column, siblings: Column, scheme: Column, root: Column) -> Column:
    """Whether a proof shows that the payload is leaf i of the tree of that size and root; false for one that cannot be a proof."""
    return F.coalesce(F.element_at(fold_steps(payload, i, size, siblings, scheme), -1) == root, F.lit(False))
