"""Vectors: centroids, exact top-k cosine, leader clusters, MinHash signatures."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions.text import with_shingles
from tidewire.operators.graph import cut_lineage

#: Queries of one block of a search; cosines that a task holds at a time.
BLOCK, CELLS = 4096, 1 << 20


def norm(v: str) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def centroids(df: DataFrame, group: str, vector: str) -> DataFrame:
    """(group, centroid): the mean by position."""
    mean = df.select(group, F.posexplode(vector).alias("k", "x")).groupBy(group, "k").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return mean.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "x"))), lambda s: s["x"]).alias("centroid"))


def top_k(queries: DataFrame, vectors: DataFrame, id_col: str, vector: str, k: int) -> DataFrame:
    """(q, id, cosine): the k nearest of each query among all vectors but itself.

    Queries are taken in blocks of about BLOCK, the bound on what is broadcast; each block is one pass over the vectors where
    they lie. A partition answers with matrix products and keeps its own k best for each query, and these alone are merged.
    """
    spark = queries.sparkSession
    q = queries.select(F.col(id_col).alias("q"), F.col(vector).alias("v"))
    blocks = max(1, -(-q.count() // BLOCK))
    out = None
    for b in range(blocks):
        rows = q.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == b).toPandas()  # about BLOCK rows
        if not len(rows):
            continue
        shared = spark.sparkContext.broadcast((rows["q"].to_numpy(), _unit(np.stack(rows["v"].to_numpy()).astype(np.float64))))
        best = vectors.select(F.col(id_col).alias("id"), F.col(vector).alias("v")).mapInPandas(_nearest(shared, k), "q long, id long, cosine double")
        out = best if out is None else out.unionByName(best)
    if out is None:
        return spark.createDataFrame([], f"q long, {id_col} long, cosine double")
    w = Window.partitionBy("q").orderBy(F.desc("cosine"), "id")
    return out.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= k).select("q", F.col("id").alias(id_col), "cosine")


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)


def _nearest(shared, k: int):
    def run(batches):
        qs, a = shared.value
        held = None
        rows = max(1, CELLS // len(qs))
        for pdf in batches:
            for at in range(0, len(pdf), rows):
                part = pdf.iloc[at : at + rows]
                ids, cos = part["id"].to_numpy(), np.round(a @ _unit(np.stack(part["v"].to_numpy()).astype(np.float64)).T, 6)
                # Of a slice, only what is not worse than a query's k-th best can be among its k.
                place = max(0, len(ids) - k - 1)
                i, j = np.nonzero(cos >= np.partition(cos, place, axis=1)[:, place, None])
                own = pd.DataFrame({"q": qs[i], "id": ids[j], "cosine": cos[i, j]})
                own = own[own["q"] != own["id"]]
                held = own if held is None else pd.concat([held, own])
                held = held.sort_values(["q", "cosine", "id"], ascending=[True, False, True]).groupby("q").head(k)
        if held is not None:
            yield held

    return run


#: Vectors of a group that are decided in one task in a round, and vectors of a task that are held against the round's leaders.
BLOCK, CHUNK = 512, 8192


def leader_clusters(df: DataFrame, group: str, id_col: str, vector: str, threshold: float) -> DataFrame:
    """(group, id, leader): in the order of ids a vector joins the first leader at least threshold near, or becomes one.

    Rounds: of each group the first BLOCK open vectors are folded in order. No leader found before is near them, or they would not be
    open, so the fold is exact. The leaders it makes go to all open vectors of the group, dealt in chunks; those that are near one
    join the first such and are open no more. So no task sees a group, whatever its size; a round takes BLOCK vectors of each
    group at least, and all that are near their leaders. Cosines are held against the threshold to nine decimals.
    """
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    own = df.select(F.col(group).alias("g"), F.col(id_col).alias("id"), F.col(vector).alias("v"))
    open_, done = own, None
    kind = f"g {fields[group]}, id {fields[id_col]}"
    while True:
        first = open_.withColumn("nth", F.row_number().over(Window.partitionBy("g").orderBy("id"))).where(F.col("nth") <= BLOCK).drop("nth")
        leaders = cut_lineage(first.groupBy("g").applyInPandas(_leaders(threshold), f"{kind}, v {fields[vector]}"))
        if leaders.isEmpty():
            break
        # A group's vectors are dealt to as many parts as its chunks; each part meets all of the round's leaders of the group.
        parts = open_.groupBy(F.col("g").alias("pg")).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("parts"))
        same = F.col("g").eqNullSafe(F.col("pg"))
        dealt = open_.join(parts, same).select("g", "id", "v", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"))
        sent = leaders.join(parts, same).select("g", "id", "v", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        met = cut_lineage(dealt.groupBy("g", "part").cogroup(sent.groupBy("g", "part")).applyInPandas(_joined(threshold), f"{kind}, v {fields[vector]}, leader {fields[id_col]}"))
        told = met.where("leader IS NOT NULL").select("g", "id", "leader")
        done = told if done is None else done.unionByName(told)
        open_ = met.where("leader IS NULL").drop("leader")
    out = done if done is not None else own.select("g", "id", F.col("id").alias("leader"))
    return out.select(F.col("g").alias(group), F.col("id").alias(id_col), "leader")


def _leaders(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        v = _unit(np.stack(pdf["v"].to_numpy()).astype(np.float64))
        near, leaders = np.round(v @ v.T, 9) >= threshold, []
        for i in range(len(v)):
            if not near[i, leaders].any():
                leaders.append(i)
        return pdf.iloc[leaders][["g", "id", "v"]]

    return run


def _joined(threshold: float):
    def run(own: pd.DataFrame, leaders: pd.DataFrame) -> pd.DataFrame:
        leaders = leaders.sort_values("id")
        ids = leaders["id"].to_numpy()
        near = np.round(_unit(np.stack(own["v"].to_numpy()).astype(np.float64)) @ _unit(np.stack(leaders["v"].to_numpy()).astype(np.float64)).T, 9) >= threshold
        near |= own["id"].to_numpy()[:, None] == ids[None]  # a leader is its own, a zero vector too
        return own[["g", "id", "v"]].assign(leader=pd.Series(ids[near.argmax(1)], index=own.index, dtype=object).where(near.any(1), None))

    return run


def minhash(df: DataFrame, shingles: str, out: str, permutations: int = 128) -> DataFrame:
    """df with a signature: for each seed the least xxhash64(shingle, seed).

    Such a hash goes on from the shingle's own one, which is made once; the seeds are folded in by blocks of hashes.
    """

    def least(hashes: pd.Series) -> pd.Series:
        return pd.Series([[None] * permutations if h is None or not len(h) else _least_hashes(np.asarray(h, dtype=np.int64), permutations) for h in hashes])

    return df.withColumn(out, F.pandas_udf(least, "array<bigint>")(F.transform(shingles, lambda x: F.xxhash64(x))))


def _least_hashes(h: np.ndarray, permutations: int) -> np.ndarray:
    """For each of the seeds from one on, the least of XXH64(seed as four bytes) that begin with the hashes h."""
    p1, p2, p3, p5 = (np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))
    seeds = (np.arange(1, permutations + 1, dtype=np.uint64) * p1)[:, None]
    found = None
    for k in range(0, len(h), 2048):
        x = (h[k : k + 2048].view(np.uint64) + (p5 + np.uint64(4)))[None, :] ^ seeds
        x = (x << np.uint64(23) | x >> np.uint64(41)) * p2 + p3
        x = (x ^ x >> np.uint64(33)) * p2
        x = (x ^ x >> np.uint64(29)) * p3
        block = (x ^ x >> np.uint64(32)).view(np.int64).min(axis=1)
        found = block if found is None else np.minimum(found, block)
    return found


def minhash_neighbours(revisions: DataFrame) -> DataFrame:
    """(article_id, revision, exact, estimate): Jaccard of each revision's shingles with those of the one before."""
    w = Window.partitionBy("article_id").orderBy("revision")
    s = minhash(with_shingles(revisions, "content", "s"), "s", "sig").select("article_id", "revision", "s", "sig")
    pair = s.withColumns({"ps": F.lag("s").over(w), "psig": F.lag("sig").over(w)}).where("ps IS NOT NULL")
    same = F.aggregate(F.zip_with("sig", "psig", lambda a, b: (a == b).cast("int")), F.lit(0), lambda acc, x: acc + x)
    return pair.select("article_id", "revision", F.round(F.size(F.array_intersect("s", "ps")) / F.size(F.array_union("s", "ps")), 6).alias("exact"), F.round(same / F.size("sig"), 6).alias("estimate"))
