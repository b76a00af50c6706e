"""Stories: components are folded many at a time, lone units not at all, and the search for the nearest story finds the plain one."""

import random
import time

import pytest

from tidewire.operators import stories as S


def plain(units, threshold):
    out, sets = {}, {}
    for _, unit, own in sorted(units, key=lambda u: u[:2]):
        near = [(len(own & e) / len(own | e), -k) for k, e in sets.items() if own & e]
        j, k = max((x for x in near if x[0] >= threshold), default=(0, None))
        out[unit] = unit if k is None else -k
        sets[out[unit]] = set(sorted(own)[:10]) if k is None else sets[-k] | own
    return out


@pytest.mark.parametrize("threshold", [0.2, 0.4, 1.0])
def test_nearest_is_the_plain_one(threshold):
    rng = random.Random(4)
    for _ in range(60):
        words = rng.randrange(4, 30)
        units = [(0, k, frozenset(rng.sample(range(words), rng.randrange(0, min(words, 14))))) for k in range(80)]
        assert dict(zip(range(80), S.attach(units, threshold), strict=True)) == plain(units, threshold)


def test_components_are_folded_together(spark, monkeypatch):
    monkeypatch.setattr(S, "GROUPED", 20)
    rng = random.Random(5)
    units = [(0, k, frozenset(rng.sample([f"{k % 25}-{i}" for i in range(4)], 2))) for k in range(100)] + [(0, 100 + k, frozenset([f"lone{k}"])) for k in range(20)] + [(0, 200, frozenset())]
    df = S.build_stories(spark.createDataFrame([(u, d, sorted(e)) for d, u, e in units], "unit_id long, day long, entities array<string>"))
    assert {r.unit_id: r.story_id for r in df.collect()} == plain(units, 0.4)
    fold = df._jdf.queryExecution().optimizedPlan().toString().split("FlatMapGroupsInPandas", 1)
    assert "Union" in fold[0] and fold[1].startswith(" [group")


def test_a_unit_looks_at_no_story_in_turn():
    """Twenty thousand units of one entity among as many stories that hold it: each finds the first by the part they share."""
    n = 20_000
    units = [(0, k, frozenset(["hub", f"e{k}"])) for k in range(n)] + [(1, n + k, frozenset(["hub"])) for k in range(n)] + [(2, 2 * n, frozenset(["hub", "e7", "x"])), (2, 2 * n + 1, frozenset(["e7", "x"]))]
    start = time.process_time()
    assert S.attach(units) == [*range(n), *[0] * n, 7, 7]
    assert time.process_time() - start < 4


@pytest.mark.parametrize("small", [0, 2, 20])
def test_small_stories_and_large_ones(monkeypatch, small):
    """Whatever counts as small, stories given and founded, that grow beyond it too, are found as by the plain fold."""
    monkeypatch.setattr(S, "SMALL", small)
    rng = random.Random(small)
    for threshold in (0.0, 0.3, 0.4):
        units = [(0, k, frozenset(rng.sample(range(14), rng.randrange(0, 8)))) for k in range(150)]
        given = [(k, e) for _, k, e in units[:20]]
        first = plain([(0, k, e) for k, e in given], 2.0)
        assert set(first.values()) == set(range(20))
        want, sets = {}, {k: set(e) for k, e in given}
        for _, k, own in units[20:]:
            near = [(len(own & e) / len(own | e), -s) for s, e in sets.items() if own & e]
            j, s = max((x for x in near if x[0] >= threshold), default=(0, None))
            want[k] = k if s is None else -s
            sets[want[k]] = set(sorted(own)[:10]) if s is None else sets[-s] | own
        assert S.attach(units[20:], threshold, stories=given) == [*want.values()]
