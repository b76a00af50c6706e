"""Units held against those of their slot: the nearest one before, in blocks, whatever words their elements fall into."""

import random
from datetime import datetime, timezone

import pytest

from tidewire.operators import meeting as M
from tidewire.plans import catalog
from tidewire.streaming import streams

SPAN = 100


def made(universe, seed, n=120):
    rng = random.Random(seed)
    return {k * 3 - 40: (rng.randrange(3), rng.randrange(-150, 400) // 7 * 7, set(rng.sample(universe, rng.randrange(0, 6)))) for k in range(n)}


def frames(spark, units):
    items = [(k, e) for k, (_, _, es) in units.items() for e in sorted(es)]
    times = [(k, o, t) for k, (o, t, _) in units.items()] + [(9000, None, 0), (9001, 1, None)]
    return spark.createDataFrame(items + items[:5] + [(9000, 1), (9001, 1), (5, None)], "id long, e long"), spark.createDataFrame(times, "id long, owner long, t long")


def plain(units, threshold):
    out = {}
    for a, (o, t, s) in units.items():
        near = [(-len(s & z) / len(s | z), b) for b, (p, u, z) in units.items() if p != o and (u < t or u == t and b < a) and t - u <= SPAN and s & z]
        if near and -min(near)[0] >= threshold:
            out[a] = (min(near)[1], -min(near)[0])
    return out


@pytest.mark.parametrize("universe", [range(12), [*range(-70, -60), 3, 64, 65, 2**40], range(50, 75)])
@pytest.mark.parametrize("held", [7, 1 << 16])
@pytest.mark.parametrize("threshold", [0.0, 0.4])
def test_nearest_is_the_plain_one(spark, monkeypatch, universe, held, threshold):
    monkeypatch.setattr(M, "HELD", held)
    monkeypatch.setattr(M, "BESIDE", 2 * held)
    monkeypatch.setattr(M, "FEW", 64 if held == 7 else 1 << 16)
    units = made([*universe], held)
    got = M.nearest_before(*frames(spark, units), threshold, SPAN).collect()
    assert len(got) == len({r.unit for r in got})
    assert {r.unit: (r.story, r.jaccard) for r in got} == plain(units, threshold)


def test_no_pair_is_a_row(spark):
    """attach_best compares units within blocks of a slot: its rows meet in no join but that of a unit's time and set."""
    plan = catalog.QUERIES["attach_best"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroupsInArrow" in plan and "Join Inner" not in plan


@pytest.mark.parametrize("held", [5, 1 << 16])
def test_matches_of_parts(spark, tmp_path, monkeypatch, held):
    """A unit that comes in two batches and several packs is one; the stream writes a slot's units, not their pairs."""
    for name, value in (("HELD", held), ("BESIDE", held), ("PACKED", 16 * held), ("HANDED", held), ("FEW", 8 * held)):
        monkeypatch.setattr(M, name, value)
    rng, written = random.Random(held), []
    units = {k: (k % 3, rng.randrange(3600), set(rng.sample([*range(-5, 30), 64, 130, 2**50], 4))) for k in range(60)}
    for half in (0, 2):
        rows = [(k, o, e, datetime.fromtimestamp(1_704_067_200 + t, timezone.utc)) for k, (o, t, es) in units.items() for e in sorted(es)[half : half + 2]]
        spark.createDataFrame(rows, "id long, owner long, e long, t timestamp").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    run = streams.finished
    monkeypatch.setattr(streams, "finished", lambda s: written.append(run(s)) or written[-1])
    items = spark.readStream.schema("id long, owner long, e long, t timestamp").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    got = streams.owner_matches(items).collect()
    assert {(r.a, r.b): r.met for r in got} == {(a, b): n for a in units for b in units if a < b and units[a][0] != units[b][0] and (n := len(units[a][2] & units[b][2]))}
    assert len(got) == len({(r.a, r.b) for r in got})
    assert held == 5 or written[0].count() < len(got) / 10
