"""SimHash near-dedup with a segment-popcount embedding.

A fingerprint of 64 bits is 16 segments of 4 bits; its point is the vector of the segments' bit counts. The Manhattan distance of
two points is a lower bound of the Hamming distance of the fingerprints, so fingerprints at most 2 bits apart have points at
most 2 apart, and then both points lie within 1 of a common grid cell. Each distinct fingerprint is dealt to the at most 33
cells within 1 of its point; cells with one fingerprint are left. In the others an exact check follows: two fingerprints
are at most 2 bits apart if and only if some 64-bit value is within 1 bit of both, and that value's own point is the shared
cell. No value is within 1 bit of more than 65 fingerprints, so no group is large, and a star of links in each stands for all its pairs.

Two texts of shingle similarity 0.8 differ in about 10 of 64 bits, and no grid of segments bears that radius. ``near_groups``, which
asks for a similarity and not for bits, therefore seeks partners by min-hash bands of the same shingle hashes too, and holds every
pair, of the grid and of the bands, against the exact similarity of the two texts' shingle sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.common import slices, spread_join, staged, text_of
from tidewire.operators.graph import connected_components

SEED = 42
SEGMENTS, WIDTH, BITS = 16, 4, 2
#: Shingles hashed at once.
CHUNK = 1 << 16
#: Min-hash bands and the hashes in each: two texts of similarity 0.8 share one with a probability of 0.991, of 0.9 of all but 1e-4.
BANDS, ROWS = 12, 5
SIMILARITY = 0.8
#: Texts of one band in a block, about.
BLOCK = 256
_ODD = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) << np.uint64(1) | np.uint64(1)


def words_of(text: bytes) -> list[bytes]:
    """Words parted by ASCII white space, A-Z lower-cased."""
    return text.lower().split()


def shingle_hashes(w: list[bytes], size: int):
    """XXH64 of the shingles in chunks, repeats included, as big-endian bytes; fewer words than size are one shingle."""
    h, join = xxhash.xxh64_digest, b" ".join
    if w and len(w) < size:
        yield h(join(w), SEED)
    for at in range(0, len(w) - size + 1, CHUNK):
        own = w[at : at + CHUNK + size - 1]
        yield b"".join([h(join(s), SEED) for s in zip(*(own[k:] for k in range(size)), strict=False)])


def print_and_bands(w: list[bytes], size: int, bands: bool) -> tuple[int, list[int]]:
    """The fingerprint as a signed long and, if asked for, the keys of the min-hash bands."""
    ones, n = np.zeros(64, np.int64), 0
    least = np.full(BANDS * ROWS, (1 << 64) - 1, np.uint64)
    for packed in shingle_hashes(w, size):
        bits = np.frombuffer(packed, np.uint8).reshape(-1, 8)
        n += len(bits)
        ones += np.unpackbits(bits, axis=1).sum(axis=0, dtype=np.int32)
        if bands:
            own = np.frombuffer(packed, ">u8").astype(np.uint64)
            with np.errstate(over="ignore"):
                for at in range(0, len(own), 4096):
                    least = np.minimum(least, (own[at : at + 4096] * _ODD[:, None]).min(axis=1))
    if not n:
        return 0, []
    fp = int(np.packbits(2 * ones > n).view(">i8")[0])
    return fp, [xxhash.xxh64_intdigest(x.tobytes(), k) - (1 << 63) for k, x in enumerate(least.reshape(BANDS, ROWS))] if bands else []


def fingerprint(text: bytes, size: int = 3) -> int:
    """The fingerprint as a signed long; a text without words has zero."""
    return print_and_bands(words_of(text), size, False)[0]


def fingerprints(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, fp): one for each row of docs."""

    def run(batches):
        for batch in slices(batches):
            seen: dict[bytes, int] = {}
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for x in texts:
                if x not in seen:
                    seen[x] = fingerprint(x, size)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([seen[x] for x in texts], pa.int64())], names=["id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text")).mapInArrow(run, "id long, fp long")


def _nibble(col: Column, i: int) -> Column:
    return F.shiftrightunsigned(col, WIDTH * i).bitwiseAND(F.lit((1 << WIDTH) - 1).cast("long"))


def point(fp: Column) -> Column:
    """Three bits for the bit count of each segment."""
    return sum((F.shiftleft(F.bit_count(_nibble(fp, i)).cast("long"), 3 * i) for i in range(1, SEGMENTS)), F.bit_count(_nibble(fp, 0)).cast("long"))


def links(prints: DataFrame) -> DataFrame:
    """Links (src, dst) between distinct fp at most 2 bits apart: stars whose closure is that of all the pairs."""
    fp = prints.select("fp", point(F.col("fp")).alias("p"))
    near = [F.struct(F.col("p").alias("cell"), F.lit(-1).alias("segment"), F.lit(0).alias("step"))]
    for i in range(SEGMENTS):
        count = F.shiftrightunsigned("p", 3 * i).bitwiseAND(F.lit(7).cast("long"))
        one = F.lit(1 << (3 * i)).cast("long")
        near += [F.when(count < WIDTH, F.struct((F.col("p") + one).alias("cell"), F.lit(i).alias("segment"), F.lit(1).alias("step")))]
        near += [F.when(count > 0, F.struct((F.col("p") - one).alias("cell"), F.lit(i).alias("segment"), F.lit(-1).alias("step")))]
    dealt = fp.select("fp", F.explode(F.filter(F.array(*near), lambda x: x.isNotNull())).alias("x")).select("fp", "x.cell", "x.segment", "x.step")
    full = dealt.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1").select("cell")
    met = dealt.join(full, "cell", "left_semi")
    # The values within 1 bit of a fingerprint whose point is the cell: the fingerprint itself, or a bit of one segment set or cleared.
    flips = []
    for b in range(WIDTH):
        bit = F.expr(f"shiftleft(1L, segment * {WIDTH} + {b})")
        is_set = F.col("fp").bitwiseAND(bit) != 0
        flips.append(F.when((F.col("segment") >= 0) & (is_set == (F.col("step") < 0)), F.col("fp").bitwiseXOR(bit)))
    middle = F.when(F.col("segment") < 0, F.array(F.col("fp"))).otherwise(F.filter(F.array(*flips), lambda x: x.isNotNull()))
    groups = met.select("fp", F.explode(middle).alias("middle")).groupBy("middle").agg(F.collect_set("fp").alias("near")).where(F.size("near") > 1)
    star = groups.select(F.array_min("near").alias("src"), F.explode("near").alias("dst"))
    return star.where((F.col("src") != F.col("dst")) & (F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= BITS)).distinct()


def simhash_groups(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp and component_id (the smallest id reachable by links of at most 2 bits) for every row of docs.

    Null, empty and blank texts have fingerprint zero and link like any other. Equal fingerprints are one group before any
    link is sought. A null id stays null and ranks last: component_id is null only where no row of the group has an id. Rows that
    repeat an id and a text come back as often; rows of one id and different texts are linked by their texts alone. Other
    columns are not read.
    """
    rows = staged(fingerprints(docs, size, id_col, text_col))
    nodes = staged(rows.groupBy("fp").agg(F.min("id").alias("least")))
    linked = connected_components(links(nodes)).withColumnsRenamed({"node": "fp", "component": "root"})
    rooted = nodes.join(linked, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return spread_join(rows, named, "fp", "id").select(F.col("id").alias("doc_id"), "fp", "component_id")


def sketched(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """Rows (id, digest, words, fp, bands): the text's digest, that of its lower-cased words, its fingerprint and band keys."""

    def run(batches):
        for batch in slices(batches):
            seen: dict[bytes, tuple] = {}
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for x in texts:
                if x not in seen:
                    w = words_of(x)
                    seen[x] = (xxhash.xxh3_128_digest(b" ".join(w)), *print_and_bands(w, size, True))
            got = [seen[x] for x in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([g[0] for g in got], pa.binary()), pa.array([g[1] for g in got], pa.int64()), pa.array([g[2] for g in got], pa.list_(pa.int64()))], names=["id", "digest", "words", "fp", "bands"])

    return docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"), text_digest(text_col).alias("digest")).mapInArrow(run, "id long, digest binary, words binary, fp long, bands array<long>")


def text_digest(text_col: str) -> Column:
    return F.unhex(F.md5(text_of(text_col)))


def shingle_sets(docs: DataFrame, named: DataFrame, size: int, text_col: str) -> DataFrame:
    """(node, shingles) of the texts whose digests are named (digest, node): distinct shingle hashes in order, packed."""

    def run(batches):
        for batch in slices(batches):
            sets = [np.unique(np.frombuffer(b"".join(shingle_hashes(words_of(x), size)), ">u8")).astype("<u8").tobytes() for x in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["node", "shingles"])

    texts = docs.select(text_digest(text_col).alias("digest"), text_of(text_col).alias("text")).join(named, "digest").groupBy("node").agg(F.any_value("text").alias("text"))
    return texts.mapInArrow(run, "node long, shingles binary")


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two sets of shingle hashes (sorted, distinct) are as similar as that, by Jaccard's index."""
    if min(len(a), len(b)) < similarity * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (len(a) + len(b) - both)


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of the pairs (src, dst) whose texts' sets of shingles are similar enough."""

    def run(batches):
        for batch in batches:
            keep = [similar(np.frombuffer(batch.column(2)[k].as_buffer(), "<u8"), np.frombuffer(batch.column(3)[k].as_buffer(), "<u8"), similarity) for k in range(batch.num_rows)]
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["src", "dst"])

    a, b = (sets.select(F.col("node").alias(x), F.col("shingles").alias(f"{x}_set")) for x in ("src", "dst"))
    both = spread_join(spread_join(pairs, b, "dst", "src"), a, "src", "dst")
    return both.select("src", "dst", "src_set", "dst_set").mapInArrow(run, "src long, dst long")


def links_between(held: DataFrame, sets: DataFrame, similarity: float, per: int = BLOCK) -> DataFrame:
    """Links (src, dst) that join the groups within each band, of rows (key, node, item: the node's group).

    A band's nodes are cut into blocks of about ``per``: a group that large has blocks of its own, smaller ones share blocks. Each
    pair of blocks, but those of one large group, is compared in one task, which links what is not yet linked and so tests
    few pairs of a group that hangs together. Links come out, never pairs: at most one less than the nodes of a task.
    """
    sizes = held.groupBy("key", "item").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("large", F.when(F.col("n") >= per, F.col("item")))
    bands = sizes.groupBy("key").agg(F.count("*").alias("groups"), F.ceil(F.sum(F.when(F.col("large").isNull(), F.col("n")).otherwise(0)) / per).cast("int").alias("shared")).where("groups > 1").select("key", "shared")
    own = held.join(sizes.select("key", "item", "n", "large"), ["key", "item"]).join(bands, "key")
    block = F.when(F.col("large").isNull(), F.pmod(F.xxhash64("item"), F.greatest("shared", F.lit(1)))).otherwise(F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / per)))
    own = staged(own.select("key", "node", "item", F.struct(F.coalesce("large", F.lit(-1)).alias("large"), block.cast("long").alias("part")).alias("block")))
    blocks = own.select("key", "block").distinct()
    pairs = blocks.select("key", F.col("block").alias("i")).join(blocks.select("key", F.col("block").alias("j")), "key").where("i <= j AND NOT (i.large = j.large AND i.large >= 0)")
    dealt = own.join(pairs.select("key", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"), "i", "j"), ["key", "block"]).select("node", "item", "key", "i", "j")
    rows = spread_join(dealt, sets, "node", "key")

    def link(table: pa.Table) -> pa.Table:
        nodes = table["node"].to_numpy()
        own_sets = [np.frombuffer(x.as_buffer(), "<u8") for x in table["shingles"]]
        root = np.unique(table["item"].to_numpy(), return_inverse=True)[1]
        order = np.argsort([len(x) for x in own_sets], kind="stable")
        src, dst = [], []
        for n, k in enumerate(order.tolist()):
            for m in order[:n][::-1].tolist():
                if len(own_sets[m]) < similarity * len(own_sets[k]):
                    break  # smaller ones are too small as well
                if root[m] != root[k] and similar(own_sets[m], own_sets[k], similarity):
                    src.append(min(nodes[m], nodes[k]))
                    dst.append(max(nodes[m], nodes[k]))
                    root[root == root[m]] = root[k]
        return pa.table([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], names=["src", "dst"])

    return rows.groupBy("key", "i", "j").applyInArrow(link, "src long, dst long").distinct()


def near_groups(docs: DataFrame, size: int = 5, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (words, root, first): each distinct word sequence, its group, and the first of its rows as (without, id, digest).

    First each text is held against the one partner that the grid or most of its bands name: that makes groups of most
    copies, however many. Then bands that hold several groups are compared in blocks, so that no link between texts that
    meet in a band is lost and no group is ever spread into its pairs.
    """
    rows = sketched(docs, size, id_col, text_col)
    first = F.min(F.struct(F.col("id").isNull().alias("without"), "id", "digest")).alias("first")
    nodes = rows.groupBy("words").agg(first, F.any_value("fp").alias("fp"), F.any_value("bands").alias("bands"))
    nodes = staged(nodes.withColumn("node", F.monotonically_increasing_id()))
    banded = nodes.select("node", F.explode("bands").alias("key"))
    met = banded.groupBy("key").agg(F.min("node").alias("src"), F.max("node").alias("last")).where("src != last").select("key", "src")
    banded = staged(banded.join(met, "key"))  # bands that two texts share
    best = banded.where("src != node").groupBy("node", "src").agg(F.count("*").alias("n")).groupBy("node").agg(F.max_by("src", F.struct("n", -F.col("src"))).alias("src"))
    prints = staged(nodes.groupBy("fp").agg(F.min("node").alias("src")))
    a, b = prints.toDF("src_fp", "x"), prints.toDF("dst_fp", "y")
    grid = links(prints.select("fp")).toDF("src_fp", "dst_fp").join(a, "src_fp").join(b, "dst_fp").select(F.least("x", "y").alias("src"), F.greatest("x", "y").alias("dst"))
    grid = grid.unionByName(nodes.select("node", "fp").join(prints, "fp").where("src != node").select("src", F.col("node").alias("dst")))
    pairs = staged(best.select("src", F.col("node").alias("dst")).unionByName(grid).distinct())
    asked = pairs.select(F.col("src").alias("node")).unionByName(pairs.select(F.col("dst").alias("node"))).unionByName(banded.select("node")).distinct()
    sets = staged(shingle_sets(docs, nodes.join(asked, "node", "left_semi").select(F.col("first.digest").alias("digest"), "node"), size, text_col))
    near = staged(verified(pairs, sets, similarity))
    groups = connected_components(near)
    held = staged(banded.join(groups, "node", "left").select("key", "node", F.coalesce("component", "node").alias("item")))
    linked = connected_components(near.unionByName(links_between(held, sets, similarity)))
    return nodes.select("node", "words", "first").join(linked, "node", "left").select("words", F.coalesce("component", "node").alias("root"), "first")


def one_of_each(docs: DataFrame, size: int = 5, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs for each group of near copies, with all its columns: that of the smallest id, then of the smallest text digest.

    Texts link from a Jaccard similarity of their sets of shingles on; texts of the same lower-cased words are alike, and
    so are all without words. A group whose rows all lack an id keeps one of them, and rows of one id and different texts are
    held apart. Of rows that repeat an id and a text, that of the smallest hash of all its columns stays.
    """
    least = near_groups(docs, size, similarity, id_col, text_col).groupBy("root").agg(F.min("first").alias("x"))
    stays = least.select(F.struct("x.without", F.coalesce("x.id", F.lit(0)).alias("id"), "x.digest").alias("key"))
    given = F.col(f"`{id_col}`").cast("long")
    key = F.struct(given.isNull().alias("without"), F.coalesce(given, F.lit(0)).alias("id"), text_digest(f"`{text_col}`").alias("digest"))
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key")).join(stays, "key", "left_semi")
    first = own.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64(F.to_json("row"))))).where("n = 1")
    return first.select([F.col(f"row.`{c}`").alias(c) for c in docs.columns])
