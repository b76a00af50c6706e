"""An append-only log in a folder: entries with leaf and chain hashes, and the frontier of its RFC 6962 tree.

The frontier (a compact range) holds the roots of the largest complete subtrees of what is there, at most one a level. A batch of m
entries adds to a log of n with O(m + log n) hashes: its leaves are merged within aligned blocks, blocks within larger ones, and
what is left, some tens of nodes, with the frontier. Old entries are never read.

A batch has an id. Its entries go to a folder of that id, its head (size, frontier, root, last chain hash) to another, and the head
is what makes the entries part of the log: a batch that failed before that is written anew, one that is repeated after it changes
nothing. One writer at a time, as an order of entries has one author.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewire.functions.hashes import GENESIS
from tidewire.operators.graph import cut_lineage

#: Binary logarithm of the children of a block that are merged in one group.
WIDTH = 12
HEAD = "batch string, first long, size long, frontier array<struct<level:int,at:long,hash:string>>, root string, chain string"
ENTRY = "idx long, payload string, leaf string, chain string"
Node = tuple[int, int, str]


def node_hash(left: str, right: str) -> str:
    return hashlib.sha256(b"\1" + bytes.fromhex(left) + bytes.fromhex(right)).hexdigest()


def merged(nodes: list[Node]) -> list[Node]:
    """The largest complete subtrees over neighbouring nodes (level, index at the level, hash), given from left to right."""
    out: list[Node] = []
    for node in nodes:
        out.append(node)
        while len(out) > 1 and out[-1][0] == out[-2][0] and out[-2][1] % 2 == 0 and out[-1][1] == out[-2][1] + 1:
            (level, at, left), (_, _, right) = out[-2:]
            out[-2:] = [(level + 1, at // 2, node_hash(left, right))]
    return out


def root_of(frontier: list[Node]) -> str | None:
    """The tree's root: the smallest subtrees are joined first, from the right. None for an empty log."""
    root = None
    for _, _, h in reversed(frontier):
        root = h if root is None else node_hash(h, root)
    return root


def subtrees(leaves: DataFrame, first: int, size: int) -> list[Node]:
    """The largest complete subtrees over leaves (idx, node: hexadecimal) from first to size, merged in groups of 2^WIDTH."""

    def step(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["level"].to_pylist(), table["at"].to_pylist(), table["hash"].to_pylist(), strict=True), key=lambda x: x[1] << x[0])
        got = merged(rows)
        return pa.table([pa.array([g[k] for g in got], t) for k, t in enumerate((pa.int32(), pa.int64(), pa.string()))], names=["level", "at", "hash"])

    nodes, bits = leaves.select(F.lit(0).alias("level"), F.col("idx").alias("at"), F.col("node").alias("hash")), WIDTH
    while True:
        nodes = nodes.groupBy(F.expr(f"shiftright(shiftleft(at, level), {bits})").alias("block")).applyInArrow(step, "level int, at long, hash string")
        if (size - 1) >> bits == first >> bits or ((size - first) >> bits) < 1 << WIDTH:
            break
        bits += WIDTH
    return merged(sorted(((r["level"], r["at"], r["hash"]) for r in nodes.collect()), key=lambda x: x[1] << x[0]))  # at most 2^WIDTH blocks' few nodes


def chained(leaves: DataFrame, before: str) -> DataFrame:
    """(idx, chain): sha256(chain before || leaf), in order.

    Each hash needs the one before it, so a batch's leaf hashes, 32 bytes each, pass through one task as a stream; nothing is held.
    """

    def run(batches):
        chain = bytes.fromhex(before)
        for batch in batches:
            out = []
            for leaf in batch.column(1).to_pylist():
                chain = hashlib.sha256(chain + bytes.fromhex(leaf)).digest()
                out.append(chain.hex())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["idx", "chain"])

    return leaves.select("idx", "leaf").repartition(1).sortWithinPartitions("idx").mapInArrow(run, "idx long, chain string")


def numbered(rows: DataFrame, order: list[str], first: int) -> DataFrame:
    """rows with idx from first on, gapless, in the order of columns order: sorted by range, counted by partition."""
    part = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"__part": F.spark_partition_id(), "__nth": F.monotonically_increasing_id()})
    part = cut_lineage(part.withColumn("__nth", F.col("__nth").bitwiseAND(F.lit((1 << 33) - 1))))
    before = part.groupBy("__part").agg(F.count("*").alias("n")).withColumn("before", F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)))  # a row a partition
    return part.join(F.broadcast(before.select("__part", F.coalesce("before", F.lit(0)).alias("before"))), "__part").withColumn("idx", F.col("before") + F.col("__nth") + first).drop("__part", "__nth", "before")


def heads(spark: SparkSession, folder: str) -> DataFrame:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/heads")
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], HEAD)
    return spark.read.schema(HEAD).option("recursiveFileLookup", "true").parquet(f"{folder}/heads")


def append(rows: DataFrame, folder: str, batch: str, order: list[str]) -> dict:
    """Append rows (payload: canonical text; order: columns that order them) as one batch; the log's head after it.

    A batch id that the log has already is passed over and its own head returned. An empty batch leaves the log as it is.
    """
    spark = rows.sparkSession
    known = {r["batch"]: r.asDict() for r in heads(spark, folder).collect()}  # a row for each batch
    if batch in known:
        return known[batch]
    last = max(known.values(), key=lambda r: r["size"], default={"size": 0, "frontier": [], "chain": GENESIS})
    entries = numbered(rows.select(*dict.fromkeys([*order, "payload"])), order, last["size"]).select("idx", "payload", F.sha2(F.col("payload").cast("binary"), 256).alias("leaf"))
    entries = entries.join(chained(entries, last["chain"]), "idx")
    path = f"{folder}/entries/batch={batch}"
    entries.write.mode("overwrite").parquet(path)
    entries = spark.read.schema(ENTRY).parquet(path)
    size, chain = entries.agg(F.count("*"), F.max_by("chain", "idx")).first()
    frontier = [tuple(x) for x in last["frontier"]]
    if size:
        tree = entries.select("idx", F.sha2(F.concat(F.unhex(F.lit("00")), F.unhex("leaf")), 256).alias("node"))
        frontier = merged([*frontier, *subtrees(tree, last["size"], last["size"] + size)])
    head = {"batch": batch, "first": last["size"], "size": last["size"] + size, "frontier": frontier, "root": root_of(frontier), "chain": chain or last["chain"]}
    spark.createDataFrame([tuple(head[f.strip().split(" ")[0]] for f in ("batch", "first", "size", "frontier", "root", "chain"))], HEAD).coalesce(1).write.mode("overwrite").parquet(f"{folder}/heads/batch={batch}")
    return head


def entries(spark: SparkSession, folder: str) -> DataFrame:
    """The entries of all batches that have a head."""
    names = [r["batch"] for r in heads(spark, folder).select("batch").collect()]
    if not names:
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).parquet(*[f"{folder}/entries/batch={n}" for n in names])


def broken_links(log: DataFrame) -> DataFrame:
    """Entries whose leaf is not their payload's, whose chain does not follow from the entry before, or whose index leaves a gap.

    Only neighbours are compared: each entry meets the one of the next lower index in an equi-join, no log is one group.
    """
    before = log.select((F.col("idx") + 1).alias("idx"), F.col("chain").alias("before"))
    j = log.join(before, "idx", "left")
    link = F.sha2(F.concat(F.unhex(F.coalesce("before", F.lit(GENESIS))), F.unhex("leaf")), 256)
    reason = (
        F.when(F.col("before").isNull() & (F.col("idx") != 0), "gap").when(F.sha2(F.col("payload").cast("binary"), 256) != F.col("leaf"), "payload").when(link != F.col("chain"), "chain")
    )
    return j.select("idx", reason.alias("reason")).where("reason IS NOT NULL")
