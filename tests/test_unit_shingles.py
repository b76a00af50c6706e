"""Reporting units: shingles are shuffled once, packed, and only those that several sets hold are written."""

import random

import pytest

from tidewire.operators import units as U

random.seed(4)
_WORDS = [f"w{k}" for k in range(40)]
_LONG = [random.choices(_WORDS, k=80) for _ in range(6)]
BODIES = ["", None, " ", "one", "one two", "two one", "a b c d e", "a b c d e f", "a b c d e f", "e d c b a", *(" ".join(x) for x in _LONG), *(" ".join(x[:72]) for x in _LONG), *(" ".join(x[3:]) + " end" for x in _LONG), *(" ".join(x) for x in _LONG)]


def plain(rows):
    sets = {i: (day, {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}) for i, day, body in rows for w in [(body or "").lower().split()]}
    root = {i: i for i in sets}

    def top(i):
        return i if root[i] == i else top(root[i])

    for a, (da, sa) in sets.items():
        for b, (db, sb) in sets.items():
            low, high, both = min(len(sa), len(sb)), max(len(sa), len(sb)), len(sa & sb)
            if a < b and da == db and both >= 0.9 * low and both >= 0.5 * high and both >= min(5, low):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: top(i) for i in sets}


@pytest.mark.parametrize("block", [7, 1 << 20])
def test_units_of_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(U, "BLOCK", block)
    rows = [(i, i % 2 if i < 60 else 1, body) for i, body in enumerate(BODIES * 2)]
    got = {r.id: r.unit_id for r in U.reporting_units(spark.createDataFrame(rows, "id long, day long, body string").repartition(3)).collect()}
    assert got == plain(rows)


def test_only_shared_shingles_are_kept(spark):
    rows = spark.createDataFrame([(1, 0, "a b c d e f"), (2, 0, "a b c d e g"), (3, 0, "A  b c d e g"), (4, 1, "a b c d e f")], "id long, day long, body string")
    got = U.shared_shingles(U.shingle_rows(rows)).cache()
    assert got.where("h IS NULL").select("id", "n").orderBy("id").collect() == [(1, 2), (2, 2), (3, 2), (4, 2)]
    sets = {r.id: r.set for r in got.where("h IS NULL").collect()}
    assert sets[2] == sets[3] and len(set(sets.values())) == 3
    assert sorted((r.set, r.df) for r in got.where("h IS NOT NULL").collect()) == sorted((sets[k], 2) for k in (1, 2))


def test_rollup_moves_no_texts(spark):
    a = spark.createDataFrame([(1, "x", 1, "long text"), (2, "y", 1, "text")], "id long, owner string, tier int, body string")
    df = U.unit_rollup(a, spark.createDataFrame([(1, 1), (2, 1)], "id long, unit_id long"))
    assert df.select("article_count", "tier1_owners", "representative_id").collect() == [(2, 2, 1)]
    join = df._jdf.queryExecution().optimizedPlan().toString().split("Join", 1)[1]
    assert "length(body" in join
