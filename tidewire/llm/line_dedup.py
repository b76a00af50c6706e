"""Line dedup: documents probe sharded minimal perfect hashes of the distinct line hashes.

Each shard of the hash space has one perfect hash over its distinct lines and three flat arrays in its order:
fingerprints, counts (1, or 2 for "two or more documents") and the smallest document. Documents send the hashes of their lines
to the shards in packed form. An index holds no keys: about four bits of levels, a fingerprint, a count and an id for each line; all
lines that probe it were put into it, so none can be taken for another. A shard that a third of all lines fall on is probed in several salted parts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidewire.llm.common import id_of, slices, staged, text_of
from tidewire.llm.perfect_hash import PerfectHash, words

MIN_CHARS = 10
#: Distinct lines of a shard, about; 40 bytes each while it is built.
SHARD_LINES = 1 << 18
#: Probes of one part of a shard, about.
PROBES = 1 << 20
_SPACES = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    """Stripped, with A-Z lower-cased (bytes.lower changes ASCII letters alone)."""
    return line.strip(_SPACES).lower()


def key_hash(key: bytes, min_chars: int) -> bytes | None:
    """The 128-bit hash of a key of at least min_chars code points."""
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode()) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def line_hashes(docs: DataFrame, min_chars: int, id_col: str, text_col: str) -> DataFrame:
    """Rows (key, id, doc): the distinct hashes of each row's long enough lines; doc is the digest of its id and text."""

    def run(batches):
        for batch in slices(batches):
            keys, ids, docs = [], [], []
            for i, text, doc in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), strict=True):
                own = {key_hash(line_key(x), min_chars) for x in text.split(b"\n")} - {None}
                keys += own
                ids += [i] * len(own)
                docs += [doc] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.int64()), pa.array(docs, pa.binary())], names=["key", "id", "doc"])

    return docs.select(id_of(id_col).alias("id"), text_of(text_col).alias("text"), doc_key(id_col, text_col).alias("doc")).mapInArrow(run, "key binary, id long, doc binary")


def doc_key(id_col: str, text_col: str):
    """A digest of id and text, so that rows without an id, or with one that many share, are no single key."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit("none")), F.lit(" "), text_of(text_col))))


def build_shard(shard: int, keys: list[bytes], first: np.ndarray, last: np.ndarray) -> dict:
    own = words(b"".join(keys))
    index = PerfectHash(own)
    at = index(own)
    prints, counts, firsts = np.zeros(len(own), "<u4"), np.zeros(len(own), "u1"), np.zeros(len(own), "<i8")
    prints[at], counts[at], firsts[at] = own[:, 1] & np.uint64(0xFFFFFFFF), 1 + (first != last), first
    return {"shard": shard, "levels": index.packed(), "prints": prints.tobytes(), "counts": counts.tobytes(), "firsts": firsts.tobytes()}


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc, keys): the hashes of the lines that a row loses, as one array; doc is the digest of its id and text."""
    spark = docs.sparkSession
    lines = staged(line_hashes(docs, min_chars, id_col, text_col))
    shards = max(1, -(-lines.count() // SHARD_LINES))
    shard = F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int")
    distinct = lines.groupBy(shard.alias("shard"), "key").agg(F.min("id").alias("first"), F.max("id").alias("last"))

    def build(table: pa.Table) -> pa.Table:
        made = build_shard(table["shard"][0].as_py(), table["key"].to_pylist(), table["first"].to_numpy(), table["last"].to_numpy())
        return pa.table({k: [v] for k, v in made.items()}, pa.schema([("shard", pa.int32()), ("levels", pa.binary()), ("prints", pa.binary()), ("counts", pa.binary()), ("firsts", pa.binary())]))

    index = staged(distinct.groupBy("shard").applyInArrow(build, "shard int, levels binary, prints binary, counts binary, firsts binary"))
    probes = lines.withColumn("shard", shard)
    parts = probes.groupBy("shard").agg(F.ceil(F.count("*") / PROBES).cast("int").alias("parts"))  # a row for each shard
    parts = staged(parts)
    probes = probes.join(F.broadcast(parts) if shards <= 1 << 16 else parts, "shard").select("shard", F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int").alias("part"), "key", "id", "doc")
    index = index.join(parts, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "levels", "prints", "counts", "firsts")

    def probe(index: pa.Table, asked: pa.Table) -> pa.Table:
        schema = pa.schema([("key", pa.binary()), ("doc", pa.binary())])
        if not index.num_rows or not asked.num_rows:
            return schema.empty_table()
        one = {k: index[k][0].as_py() for k in ("levels", "prints", "counts", "firsts")}
        key = words(b"".join(asked["key"].to_pylist()))
        at = PerfectHash.unpacked(one["levels"])(key)
        prints, counts, firsts = np.frombuffer(one["prints"], "<u4"), np.frombuffer(one["counts"], "u1"), np.frombuffer(one["firsts"], "<i8")
        hit = (at >= 0) & (prints[at] == (key[:, 1] & np.uint64(0xFFFFFFFF))) & (counts[at] > 1) & (firsts[at] != asked["id"].to_numpy())
        return asked.select(["key", "doc"]).filter(pa.array(hit)).cast(schema)

    lost = index.groupBy("shard", "part").cogroup(probes.groupBy("shard", "part")).applyInArrow(probe, "key binary, doc binary")
    return lost.distinct().groupBy("doc").agg(F.collect_list("key").alias("keys"))


def drop_lines(text: bytes, lost: set[bytes], min_chars: int = MIN_CHARS) -> tuple[bytes, int, int]:
    """The text left, its lines before, the lines dropped."""
    lines = text.split(b"\n")
    kept = [x for x in lines if key_hash(line_key(x), min_chars) not in lost] if lost else lines
    return b"\n".join(kept), len(lines), len(lines) - len(kept)


def deduplicate_lines(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with text_col rewritten and two more columns, lines_before and lines_dropped.

    A line's key is the line stripped of white space with A-Z lower-cased. Keys of at least min_chars code points that two
    documents hold lose all their lines except in the document of the smallest id. A null or empty text is one empty line
    and comes back as an empty text. A null id ranks last, with the largest one, and stays null; rows with one id count as one document. All other
    columns pass, whatever their names. Columns of docs named lines_before or lines_dropped are replaced.
    """
    lost = repeated_lines(docs, min_chars, f"`{id_col}`", f"`{text_col}`")
    own = docs.select(doc_key(f"`{id_col}`", f"`{text_col}`").alias("doc"), text_of(f"`{text_col}`").alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("rest"))
    rest = own.join(lost, "doc", "left").select("text", "keys", "rest")

    def run(batches):
        for batch in slices(batches):
            made = [drop_lines(t, set(k or ()), min_chars) for t, k in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in made], pa.binary()).cast(pa.string()), pa.array([x[1] for x in made], pa.int64()), pa.array([x[2] for x in made], pa.int64()), batch.column(2)], names=["text", "before", "dropped", "rest"])

    out = rest.mapInArrow(run, StructType([StructField("text", StringType()), StructField("before", LongType()), StructField("dropped", LongType()), StructField("rest", rest.schema["rest"].dataType)]))
    cols = [F.col("text").alias(text_col) if c == text_col else F.col(f"rest.`{c}`").alias(c) for c in docs.columns if c not in ("lines_before", "lines_dropped")]
    return out.select(*cols, F.col("before").alias("lines_before"), F.col("dropped").alias("lines_dropped"))
