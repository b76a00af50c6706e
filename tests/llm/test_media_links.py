"""Links of image copies against all pairs of images, feature by feature."""

from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from tidewire.llm import media


def mosaics(n=48, groups=16, tiles=24, kept=0.45, seed=7):
    """Images of tiles from a small pool, so that table entries are crowded; those of one group share some of their tiles' places."""
    rng = np.random.default_rng(seed)
    pool = [np.kron(rng.integers(0, 256, (9, 9)), np.ones((3, 3))).astype(np.uint8) for _ in range(tiles)]
    plans = rng.integers(0, tiles, (groups, 3, 3))
    out = []
    for k in range(n):
        plan = np.where(rng.random((3, 3)) < kept, plans[k % groups], rng.integers(0, tiles, (3, 3)))
        out.append((k + 1, np.vstack([np.hstack([pool[t] for t in row]) for row in plan])))
    return out


def plain_link(a, b):
    """Whether VOTES features of a match ones of b under one change."""
    votes = {}
    for p, xa, ya, sa, ta in zip(*a, strict=True):
        for q, xb, yb, sb, tb in zip(*b, strict=True):
            if (int(p) ^ int(q)).bit_count() <= media.BITS:
                turn = int(tb - ta) % media.ANGLES
                still = sa == sb and turn in (0, 1, media.ANGLES - 1)
                keys = [(0, -1, int(xb - xa) // media.CELL, int(yb - ya) // media.CELL)] if still else []
                for t in () if still else (turn - 1, turn, turn + 1):
                    t, grow = t % media.ANGLES, 2.0 ** int(sb - sa)
                    cos, sin = np.cos(t * 2 * np.pi / media.ANGLES), np.sin(t * 2 * np.pi / media.ANGLES)
                    keys.append((int(sb - sa), t, np.floor((xb - grow * (cos * xa - sin * ya)) / media.CELL), np.floor((yb - grow * (sin * xa + cos * ya)) / media.CELL)))
                for key in keys:
                    votes.setdefault(key, set()).add((xa, ya, sa, ta))
    return any(len(v) >= media.VOTES for v in votes.values())


@pytest.fixture(scope="module")
def crowded():
    rows = mosaics()
    marks = {i: media.describe(media.decode(media.png(x))) for i, x in rows}
    return rows, marks, {(a, b) for a, b in combinations(marks, 2) if plain_link(marks[a], marks[b])}


def test_entries_are_crowded(crowded):
    _, marks, links = crowded
    held = Counter(int(x) for m in marks.values() for x in m[0])
    assert max(held.values()) >= 20 and 20 <= len(links) < len(marks) * (len(marks) - 1) // 2


def test_links_are_those_of_all_pairs(spark, crowded):
    rows, _, links = crowded
    got = media.image_copies(spark.createDataFrame([(i, media.png(x)) for i, x in rows], "id long, image binary")).collect()
    root = {i: i for i, _ in rows}
    for _ in rows:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert {r.id: r.component_id for r in got} == root


def test_each_link_is_found(spark, crowded):
    _, marks, links = crowded
    packed = [(i, m[0].view(np.int64).tolist(), (m[1] << 40 | m[2] << 16 | m[3] << 8 | m[4]).tolist()) for i, m in marks.items()]
    first = spark.createDataFrame(packed, "node long, bits array<long>, place array<long>")
    for features in (1, 1 << 27, 1 << 38):
        shared, near = media.shared_descriptors(first, media.tables(features))
        assert {(r.src, r.dst) for r in media.copies(media.candidates(shared, near), first).collect()} == links


def test_tables_hold_all_near_descriptors():
    rng = np.random.default_rng(3)
    for features, n in ((1, 3), (1 << 27, 6), (1 << 38, 10)):
        masks = media.tables(features)
        assert len(masks) == n
        for _ in range(500):
            x = int(rng.integers(1 << 63))
            y = x ^ 1 << int(rng.integers(64)) ^ 1 << int(rng.integers(64))
            assert any(x & m == y & m for m in masks)


def test_small_copies_link(spark):
    """Seven corners a few pixels apart agree; of those five pixels apart only one would be left."""
    small = np.kron(np.random.default_rng(4).integers(0, 256, (8, 8)), np.ones((4, 4))).astype(np.uint8)
    edited = small.copy()
    edited[:, :3] = 255
    rows = [(1, media.png(small)), (2, media.png(edited))]
    assert {r.component_id for r in media.image_copies(spark.createDataFrame(rows, "id long, image binary")).collect()} == {1}


def test_pictures_without_an_id_stay_apart(spark):
    """Two pictures of null ids and one of the largest id are three; a copy of one of them takes its own id."""
    big = (1 << 63) - 1
    a, b = (np.kron(np.random.default_rng(k).integers(0, 256, (9, 9)), np.ones((4, 4))).astype(np.uint8) for k in (11, 12))
    edited = b.copy()
    edited[:, :3] = 255
    got = [(r.id, r.component_id) for r in media.image_copies(spark.createDataFrame([(None, media.png(a)), (None, media.png(b)), (big, media.png(edited))], "id long, image binary")).collect()]
    assert sorted(got, key=str) == sorted([(None, None), (None, big), (big, big)], key=str)


def test_many_like_features_take_bounded_room():
    """Pictures of one tile repeated agree, and shifted noise does not, however many of their descriptors are equal."""
    n = 20000
    bits, place = np.zeros(n, np.int64), (np.arange(n, dtype=np.int64) * 10 << 40) | (5 << 16)
    assert media.agrees(bits, place, bits, place)
    far = (np.arange(n, dtype=np.int64) ** 2 % 16000000 << 40) | ((np.arange(n, dtype=np.int64) * 37 % 60000) << 16)
    assert not media.agrees(bits[:5], place[:5], bits, far)
