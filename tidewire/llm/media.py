"""Media columns: images as bytes, and copies among them, cropped or edited, by local descriptors.

An image is a PNG (8-bit grey, RGB or either with alpha, not interlaced) or a binary PGM or PPM. Corners are found at several
scales; the patch around each is turned by its intensity centroid's angle and compared at fixed pairs of places, which gives 64
bits. Distinct descriptors go to Hamming tables, so that two that differ in at most two bits meet in one; images that hold
near descriptors are compared feature by feature, save where too few of the features of one could match. The matched features
of two images vote for one change of scale, angle and place; enough agreeing votes make them copies.
"""

from __future__ import annotations

import math
import re
import struct
import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.common import spread_join, staged
from tidewire.operators.graph import connected_components

#: Shrinking factors of the scales; radius of a patch; least corner response; bits of two descriptors that may differ.
SCALES, RADIUS, RESPONSE, BITS = (1.0, 0.5), 7, 8e-3, 2
#: Features dealt, and pairs of features compared, at once, about.
BLOCK = 1 << 18
#: A corner is the greatest within so many pixels.
APART = 2
#: Votes for one placement that make a copy; cells of a vote in pixels and in angle steps.
VOTES, CELL, ANGLES = 6, 8, 32
#: Features, the most widely held of an image, by which it does not seek.
LEFT = 2
_SEED = 20


def png(grey: np.ndarray) -> bytes:
    """An 8-bit grey PNG."""
    h, w = grey.shape
    raw = np.concatenate([np.zeros((h, 1), np.uint8), grey.astype(np.uint8)], axis=1).tobytes()
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw, 1)) + chunk(b"IEND", b"")


def _unfiltered(raw: np.ndarray, w: int, h: int, n: int) -> np.ndarray:
    """Undo a PNG's line filters."""
    lines = raw[: h * (w * n + 1)].reshape(h, w * n + 1)
    out = np.zeros((h + 1, (w + 1) * n), np.uint8)
    for y in range(h):
        kind, line = lines[y, 0], lines[y, 1:]
        up, own = out[y], out[y + 1]
        if kind == 0:
            own[n:] = line
        elif kind == 1:
            own[n:] = np.cumsum(line.reshape(w, n), axis=0, dtype=np.uint8).ravel()
        elif kind == 2:
            own[n:] = line + up[n:]
        else:
            for x in range(n, (w + 1) * n):
                a, b, c = int(own[x - n]), int(up[x]), int(up[x - n])
                if kind == 3:
                    guess = (a + b) // 2
                else:
                    pa_, pb, pc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
                    guess = a if pa_ <= pb and pa_ <= pc else b if pb <= pc else c
                own[x] = (int(line[x - n]) + guess) & 255
    return out[1:, n:].reshape(h, w, n)


def decode(data: bytes | None) -> np.ndarray | None:
    """Grey levels from 0 to 1, or none for null, empty or unreadable bytes."""
    if not data:
        return None
    try:
        if data[:8] == b"\x89PNG\r\n\x1a\n":
            at, body, head = 8, [], None
            while at + 8 <= len(data):
                n, kind = struct.unpack(">I4s", data[at : at + 8])
                if kind == b"IHDR":
                    head = struct.unpack(">IIBBBBB", data[at + 8 : at + 8 + n])
                elif kind == b"IDAT":
                    body.append(data[at + 8 : at + 8 + n])
                at += 12 + n
            w, h, depth, colour, _, _, interlaced = head
            n = {0: 1, 2: 3, 4: 2, 6: 4}[colour]
            if depth != 8 or interlaced:
                return None
            px = _unfiltered(np.frombuffer(zlib.decompress(b"".join(body)), np.uint8), w, h, n).astype(np.float32) / 255
            px = px[..., :3] if n >= 3 else px[..., :1]
        elif data[:2] in (b"P5", b"P6"):
            kind, w, h, top = data.split(None, 4)[:4]
            n, start = (1, 3)[kind == b"P6"], len(data) - int(w) * int(h) * (1, 3)[kind == b"P6"]
            px = np.frombuffer(data, np.uint8, offset=start).reshape(int(h), int(w), n).astype(np.float32) / int(top)
        else:
            return None
    except (KeyError, ValueError, TypeError, zlib.error, struct.error):
        return None
    return px @ np.array([0.299, 0.587, 0.114], np.float32) if px.shape[2] == 3 else px[..., 0]


def resized(img: np.ndarray, factor: float) -> np.ndarray:
    """Shrunk by area averages: of squares of four pixels, or else by the summed image."""
    if factor == 0.5 and not img.shape[0] % 2 and not img.shape[1] % 2:
        return (img[::2, ::2] + img[1::2, ::2] + img[::2, 1::2] + img[1::2, 1::2]) / np.float32(4)
    h, w = max(1, int(img.shape[0] * factor)), max(1, int(img.shape[1] * factor))
    total = np.zeros((img.shape[0] + 1, img.shape[1] + 1))
    total[1:, 1:] = img.cumsum(0).cumsum(1)
    y, x = np.linspace(0, img.shape[0], h + 1).round().astype(int), np.linspace(0, img.shape[1], w + 1).round().astype(int)
    t = total[np.ix_(y, x)]
    return ((t[1:, 1:] - t[1:, :-1] - t[:-1, 1:] + t[:-1, :-1]) / np.outer(np.diff(y), np.diff(x))).astype(np.float32)


def _box(img: np.ndarray, r: int) -> np.ndarray:
    """Means over squares of side 2 r + 1, edges repeated."""
    p, (h, w) = np.pad(img, r, mode="edge"), img.shape
    rows = p[:h].copy()
    for k in range(1, 2 * r + 1):
        rows += p[k : k + h]
    out = rows[:, :w].copy()
    for k in range(1, 2 * r + 1):
        out += rows[:, k : k + w]
    return out / np.float32((2 * r + 1) ** 2)


def corners(img: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (y, x) whose least eigenvalue of the gradients' second moments is a local maximum, away from the border."""
    if min(img.shape) <= 2 * RADIUS + 2:
        return (np.zeros(0, np.int64),) * 2
    dy, dx = np.zeros_like(img), np.zeros_like(img)
    dy[1:-1], dx[:, 1:-1] = (img[2:] - img[:-2]) / 2, (img[:, 2:] - img[:, :-2]) / 2
    a, b, c = _box(dx * dx, 2), _box(dx * dy, 2), _box(dy * dy, 2)
    least = (a + c) / 2 - np.sqrt(((a - c) / 2) ** 2 + b * b)
    inner = least[RADIUS:-RADIUS, RADIUS:-RADIUS]
    top = inner > RESPONSE
    best, (h, w) = least, inner.shape
    for axis in (0, 1):  # the maximum over squares of side 2 APART + 1, in doubling steps
        p, done, side = np.pad(best, [(APART, APART) if k == axis else (0, 0) for k in (0, 1)]), 1, 2 * APART + 1
        while done < side:
            step = min(done, side - done)
            p = np.maximum(p[:-step], p[step:]) if axis == 0 else np.maximum(p[:, :-step], p[:, step:])
            done += step
        best = p
    top &= inner == best[RADIUS : RADIUS + h, RADIUS : RADIUS + w]
    y, x = np.nonzero(top)
    return y + RADIUS, x + RADIUS


def _pattern() -> np.ndarray:
    """For each angle step, 64 pairs of offsets (dy, dx) within the patch, drawn once from a fixed seed."""
    rng = np.random.default_rng(_SEED)
    pairs = np.clip(rng.normal(0, RADIUS / 2.2, (64, 2, 2)), -RADIUS + 2, RADIUS - 2)
    turns = np.arange(ANGLES) * 2 * np.pi / ANGLES
    rot = np.stack([np.stack([np.cos(turns), np.sin(turns)], -1), np.stack([-np.sin(turns), np.cos(turns)], -1)], -2)
    return np.clip(np.rint(np.einsum("aij,ptj->apti", rot, pairs)), -RADIUS, RADIUS).astype(np.int64)


_PAIRS = _pattern()
_GRID = np.arange(-RADIUS, RADIUS + 1)
_DISC = (_GRID[:, None] ** 2 + _GRID[None] ** 2 <= RADIUS**2).astype(np.float32)


def describe(img: np.ndarray):
    """Features of all scales: descriptor, x and y in the image's own pixels, scale number, angle step."""
    out = []
    for s, factor in enumerate(SCALES):
        small = resized(img, factor) if factor < 1 else img
        y, x = corners(small)
        if not len(y):
            continue
        patches = np.lib.stride_tricks.sliding_window_view(small, (2 * RADIUS + 1,) * 2)[y - RADIUS, x - RADIUS] * _DISC
        angle = np.arctan2((patches * _GRID[:, None]).sum((1, 2)), (patches * _GRID).sum((1, 2)))
        step = np.rint(angle / (2 * np.pi) * ANGLES).astype(np.int64) % ANGLES
        smooth = _box(small, 1)
        at = _PAIRS[step]
        v = smooth[y[:, None, None] + at[..., 0], x[:, None, None] + at[..., 1]]
        bits = np.packbits(v[..., 0] < v[..., 1], axis=1).view(">u8").ravel().astype(np.uint64)
        out.append((bits, np.rint(x / factor).astype(np.int64), np.rint(y / factor).astype(np.int64), np.full(len(y), s), step))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 4)


def features(images: DataFrame, id_col: str, image_col: str) -> DataFrame:
    """Rows (id, digest, n_features, bits, place): the features of an image as packed arrays; digest is that of its grey levels."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, rows = batch.slice(at, 256), []
                for raw in part.column(1).to_pylist():
                    img = decode(raw)
                    if img is None:
                        rows.append((None, 0, [], []))
                        continue
                    bits, x, y, s, a = describe(img)
                    rows.append((xxhash.xxh3_128_digest(np.rint(img * 255).astype(np.uint8).tobytes() + struct.pack("<II", *img.shape)), len(bits), bits.view(np.int64), x << 40 | y << 16 | s << 8 | a))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.list_(pa.int64())), pa.array([r[3] for r in rows], pa.list_(pa.int64()))], names=["id", "digest", "n_features", "bits", "place"])

    return images.select(F.col(id_col).cast("long").alias("id"), F.col(image_col).cast("binary").alias("image")).mapInArrow(run, "id long, digest binary, n_features long, bits array<long>, place array<long>")


def tables(features: int) -> list[int]:
    """The masks of the Hamming tables: 64 bits in k blocks, and in each table all but BITS of them.

    Two descriptors within BITS bits agree in all bits of one table, whatever k. More descriptors take more blocks, so that
    entries of a table, which have 21 bits at k = 3, 32 at 4 and 38 at 5, hold a few descriptors at any size.
    """
    k = BITS + 1
    while k < 8 and 64 * (k - BITS) // k < math.log2(max(features, 1)) - 3:
        k += 1
    cuts = [64 * i // k for i in range(k + 1)]
    blocks = [(1 << cuts[i + 1]) - (1 << cuts[i]) for i in range(k)]
    return [sum(blocks[i] for i in kept) for kept in combinations(range(k), k - BITS)]


def descriptors(first: DataFrame) -> DataFrame:
    """Rows (bits, node, m): each distinct descriptor of an image and the number of its features that have it."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                bits, sizes = part.column(1).flatten().to_numpy(), np.diff(part.column(1).offsets.to_numpy())
                both, m = np.unique(np.stack([np.repeat(np.arange(part.num_rows), sizes), bits]), axis=1, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(both[1]), pa.array(part.column(0).to_numpy()[both[0]]), pa.array(m.astype(np.int32))], names=["bits", "node", "m"])

    return first.select("node", "bits").mapInArrow(run, "bits long, node long, m int")


def _met(tag: np.ndarray, bits: np.ndarray, many: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (x, y), x <= y, of descriptors in one entry within BITS bits; x = y, in the first table, where two images hold it."""
    entry = bits & masks[tag]
    xs, ys = [bits[many & (tag == 0)]], [bits[many & (tag == 0)]]
    left = np.arange(len(bits))
    for d in range(1, len(bits)):  # each row with the d-th after it, as long as one entry has so many
        left = left[left + d < len(bits)]
        left = left[(entry[left] == entry[left + d]) & (tag[left] == tag[left + d])]
        if not len(left):
            break
        a, b = bits[left], bits[left + d]
        near = (np.bitwise_count((a ^ b).view(np.uint64)) <= BITS) & ((a != b) | (tag[left] == 0))
        xs.append(np.minimum(a[near], b[near]))
        ys.append(np.maximum(a[near], b[near]))
    both = np.unique(np.stack([np.concatenate(xs), np.concatenate(ys)]), axis=1)
    return both[0], both[1]


def near_bits(first: DataFrame, masks: list[int]) -> DataFrame:
    """Pairs (x, y), x <= y, of descriptors that differ in at most BITS bits and that two images hold: the Hamming-table join.

    A descriptor goes to each table once for a block of images, so that one that a third of them hold is a few rows. Rows of
    one entry lie together in one sorted partition and are compared there.
    """
    own = np.array(masks, np.uint64).view(np.int64)

    def deal(batches):
        for batch in batches:
            at, sizes = 0, np.diff(batch.column(1).offsets.to_numpy())
            while at < batch.num_rows:
                stop = max(at + 1, int(np.searchsorted(np.cumsum(sizes[at:]), BLOCK, side="right")) + at)
                bits = batch.column(1).slice(at, stop - at).flatten().to_numpy()
                node = np.repeat(np.arange(stop - at), sizes[at:stop])
                bits, images = np.unique(np.unique(np.stack([bits, node]), axis=1)[0], return_counts=True)
                for t in range(len(masks)):
                    yield pa.RecordBatch.from_arrays([pa.array((np.full(len(bits), t) << 1 | (images > 1)).astype(np.int16)), pa.array(bits)], names=["tag", "bits"])
                at = stop

    def compare(batches):
        held = None
        for batch in batches:
            now = np.stack([batch.column(0).to_numpy().astype(np.int64), batch.column(1).to_numpy()])
            now = now if held is None else np.concatenate([held, now], axis=1)
            entry = now[1] & own[now[0] >> 1]
            last = np.flatnonzero((entry != entry[-1]) | (now[0] >> 1 != now[0, -1] >> 1)) if now.shape[1] else np.zeros(0, np.int64)
            cut = int(last[-1]) + 1 if len(last) else 0  # the last entry may go on in the next batch
            held = now[:, cut:]
            x, y = _met(now[0, :cut] >> 1, now[1, :cut], (now[0, :cut] & 1) > 0, own)
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["x", "y"])
        if held is not None and held.shape[1]:
            x, y = _met(held[0] >> 1, held[1], (held[0] & 1) > 0, own)
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["x", "y"])

    table = F.shiftright("tag", 1)
    entry = F.col("bits").bitwiseAND(F.element_at(F.array(*[F.lit(int(m)) for m in own]), (table + 1).cast("int")))
    dealt = first.select("node", "bits").mapInArrow(deal, "tag short, bits long")
    parts = max(1, int(first.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return dealt.repartition(parts, table, entry).sortWithinPartitions(table, entry).mapInArrow(compare, "x long, y long").distinct()


def shared_descriptors(first: DataFrame, masks: list[int] | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows (bits, node, w) of the descriptors that another image holds, or one within BITS bits; and pairs (x, y) of these, x = y too.

    A link takes VOTES features of its first image, so VOTES - LEFT at least are not among any LEFT of them: an image seeks by
    its features but the LEFT that most images hold, w of one descriptor, and not at all if it has less than VOTES that others
    hold. That choice moves the cost and never the links found.
    """
    near = staged(near_bits(first, masks or tables(first.agg(F.sum(F.size("bits"))).first()[0] or 0)))
    both = near.unionByName(near.where("x != y").select(F.col("y").alias("x"), F.col("x").alias("y")))
    held = descriptors(first).join(both.select(F.col("x").alias("bits")).distinct(), "bits", "left_semi")
    named = held.join(held.groupBy("bits").agg(F.count("*").alias("n")), "bits")
    rank, whole = Window.partitionBy("node").orderBy(F.col("n").desc(), "bits"), Window.partitionBy("node")
    w = F.least("m", F.greatest(F.lit(0), F.sum("m").over(rank) - LEFT))
    return staged(named.select("bits", "node", F.when(F.sum("m").over(whole) >= VOTES, w).otherwise(0).cast("int").alias("w"))), both


def leaders(rows: DataFrame) -> DataFrame:
    """Pairs (src, dst): to each image, of the smallest images that hold one of its descriptors, the one with which it shares most."""
    least = rows.groupBy("bits").agg(F.min("node").alias("src"), F.max("node").alias("last")).where("src != last").select("bits", "src")
    shared = rows.join(least, "bits").where("src != node AND w > 0").groupBy("node", "src").agg(F.count("*").alias("n"))
    return shared.groupBy("node").agg(F.max_by("src", F.struct("n", -F.col("src"))).alias("src")).select("src", F.col("node").alias("dst"))


def candidates(rows: DataFrame, near: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Pairs (src, dst), src < dst, that share a descriptor within BITS bits, but those within one of the groups (node, component).

    Among them are all pairs of VOTES matches or more between groups. Descriptors that a whole group holds are one row for
    the group, so that a group of many copies costs no more than its distinct descriptors; images are named again only for
    the descriptors that two groups share.
    """
    named = rows.withColumn("component", F.col("node")) if groups is None else rows.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = staged(named)
    held = named.groupBy("bits", "component").agg(F.max("w").alias("w"))
    a = held.where("w > 0").select(F.col("bits").alias("x"), F.col("component").alias("a"))
    b = held.select(F.col("bits").alias("y"), F.col("component").alias("b"))
    met = near.join(a, "x").join(b, "y").where("a != b")
    src = named.where("w > 0").select(F.col("component").alias("a"), F.col("bits").alias("x"), F.col("node").alias("p"), "w")
    dst = named.select(F.col("component").alias("b"), F.col("bits").alias("y"), F.col("node").alias("q"))
    found = met.join(src, ["a", "x"]).join(dst, ["b", "y"]).where("p < q").groupBy(F.col("p").alias("src"), F.col("q").alias("dst")).agg(F.sum("w").alias("n"))
    return found.where(F.col("n") >= VOTES - LEFT).select("src", "dst")


def _votes(a: np.ndarray, b: np.ndarray, i: np.ndarray) -> np.ndarray:
    """Distinct (vote, feature) of matches between places a and b; i numbers the first image's features."""
    (xa, ya), (xb, yb) = ((p >> 40 & (1 << 24) - 1, p >> 16 & (1 << 24) - 1) for p in (a, b))
    scale, turn = (b >> 8 & 255) - (a >> 8 & 255), ((b & 255) - (a & 255)) % ANGLES
    still = (scale == 0) & ((turn <= 1) | (turn >= ANGLES - 1))
    votes = [np.stack([scale, turn * 0 - 1, (xb - xa) // CELL, (yb - ya) // CELL, i])[:, still]]
    grow = np.array([SCALES[0] / SCALES[1]]) ** scale
    for near in (-1, 0, 1):
        t = (turn + near) % ANGLES
        cos, sin = np.cos(t * 2 * np.pi / ANGLES), np.sin(t * 2 * np.pi / ANGLES)
        dx, dy = (np.floor((to - grow * at) / CELL).astype(np.int64) for to, at in ((xb, cos * xa - sin * ya), (yb, sin * xa + cos * ya)))
        votes.append(np.stack([scale, t, dx, dy, i])[:, ~still])
    scale, turn, dx, dy, i = np.concatenate(votes, axis=1)
    return np.unique(np.stack([(scale + len(SCALES)) * (ANGLES + 1) + turn + 1 << 48 | dx + (1 << 23) << 24 | dy + (1 << 23), i]), axis=1)[0]


def agrees(bits_a: np.ndarray, place_a: np.ndarray, bits_b: np.ndarray, place_b: np.ndarray) -> bool:
    """Whether VOTES features of the first image match ones of the second under one change of scale, angle and place.

    A match that changes neither scale nor angle votes for a shift; any other one for the place that its scale and each of
    the three nearest angle steps give. Features of the first image are taken in blocks and the votes added up, so that two
    images of many like features need no more room than others.
    """
    total: dict[int, int] = {}
    rows = max(1, min(64, BLOCK // max(1, len(bits_b))))
    for at in range(0, len(bits_a), rows):
        i, j = np.nonzero(np.bitwise_count((bits_a[at : at + rows, None] ^ bits_b).view(np.uint64)) <= BITS)
        if len(i):
            vote, n = np.unique(_votes(place_a[at : at + rows][i], place_b[j], i), return_counts=True)
            for v, k in zip(vote.tolist(), n.tolist(), strict=True):
                k += total.get(v, 0)
                if k >= VOTES:
                    return True
                total[v] = k
    return False


def copies(pairs: DataFrame, first: DataFrame) -> DataFrame:
    """Those of the pairs (src, dst) whose images agree."""

    def run(batches):
        for batch in batches:
            keep = []
            for k in range(batch.num_rows):
                keep.append(agrees(*(batch.column(c)[k].values.to_numpy() for c in range(2, 6))))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["src", "dst"])

    a, b = (first.toDF(x, f"bits_{x}", f"place_{x}") for x in ("src", "dst"))
    return spread_join(spread_join(pairs, b, "dst", "src"), a, "src", "dst").select("src", "dst", "bits_src", "place_src", "bits_dst", "place_dst").mapInArrow(run, "src long, dst long")


def image_copies(images: DataFrame, id_col: str = "id", image_col: str = "image") -> DataFrame:
    """id, n_features and component_id (the smallest id among the copies that are linked) for every row of images.

    Images of equal pixels are one before anything is matched; their name is a number of its own, never an id. Then each image is
    held against the smallest one with which it shares most, which makes groups of most copies, and last all pairs between
    groups that could agree are compared. Null, empty and unreadable images have no features and are copies of none. A null id
    stays null and ranks last: a group's component_id is null only if all its ids are. Repeated rows come back as often as
    they came. Other columns are not read.
    """
    rows = staged(features(images, id_col, image_col).withColumn("row", F.monotonically_increasing_id()))
    slim = rows.where("digest IS NOT NULL").select("digest", "id", "row")
    own = staged(slim.groupBy("digest").agg(F.min("id").alias("least"), F.min("row").alias("node")))
    first = rows.where(F.size("bits") >= VOTES).join(own.select(F.col("node").alias("row")), "row", "left_semi").select(F.col("row").alias("node"), "bits", "place")
    shared, near = shared_descriptors(first)
    agreed = staged(copies(leaders(shared), first))
    groups = connected_components(agreed)
    linked = connected_components(agreed.unionByName(copies(candidates(shared, near, groups), first)))
    rooted = own.join(linked, "node", "left").withColumn("root", F.coalesce("component", "node"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("digest", "component_id")
    known = spread_join(rows.where("digest IS NOT NULL").select("digest", "id", "row", "n_features"), named, "digest", "row").select("id", "n_features", "component_id")
    return known.unionByName(rows.where("digest IS NULL").select("id", "n_features", F.col("id").alias("component_id")))


#: Pixels of a row, rows of a line, bytes of a pixel.
PAGE_WIDTH, LINE, PIXEL_BYTES = 64, 3, 4
_TAGS = re.compile(r"<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>", re.S)


def render(html: str | None) -> bytes | None:
    """A page's picture, as no table holds images: its whole text as rows of bars, one for each word, of a grey that its bytes give."""
    if html is None:
        return None
    words = _TAGS.sub(" ", html).encode().split()
    if not words:
        return None
    lens = np.array([-(-len(w) // PIXEL_BYTES) for w in words])
    grey = np.array([xxhash.xxh32_intdigest(w) % 200 for w in words], np.uint8)
    ends = np.cumsum(lens + 1)
    line = np.full(-(-int(ends[-1]) // PAGE_WIDTH) * PAGE_WIDTH, 255, np.uint8)
    line[: ends[-1]] = np.repeat(grey, lens + 1)
    line[ends - 1] = 255
    rows = line.reshape(-1, PAGE_WIDTH)
    out = np.full((len(rows), LINE, PAGE_WIDTH), 255, np.uint8)
    out[:, : LINE - 1] = rows[:, None]
    return png(out.reshape(-1, PAGE_WIDTH))


def page_images(pages: DataFrame) -> DataFrame:
    """id and image of every page."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([render(x) for x in part.column(1).to_pylist()], pa.binary())], names=["id", "image"])

    return pages.select(F.col("page_id").cast("long").alias("id"), F.col("html").cast("string")).mapInArrow(run, "id long, image binary")
