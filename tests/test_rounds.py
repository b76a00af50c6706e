"""Leaders, stories and searches by rounds and indexes against the plain folds."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewire.operators import assign as A
from tidewire.operators import stories as S
from tidewire.operators import vectors as V


def plain_leaders(rows, threshold):
    out, leaders = {}, {}
    for g, i, v in sorted(rows, key=lambda r: r[1]):
        v = np.array(v) / max(np.linalg.norm(v), 1e-300)
        near = [j for j, w in leaders.setdefault(g, []) if round(float(v @ w), 9) >= threshold]
        if not near:
            leaders[g].append((i, v))
        out[g, i] = near[0] if near else i
    return out


@pytest.mark.parametrize("block", [3, 40])
def test_leaders_of_one_giant_group(spark, monkeypatch, block):
    monkeypatch.setattr(V, "BLOCK", block)
    monkeypatch.setattr(V, "CHUNK", 50)
    rng = np.random.default_rng(block)
    centres = rng.normal(size=(12, 6))
    rows = [(k % 9 // 8, int(k * 7 % 311), (centres[rng.integers(12)] + rng.normal(size=6) * 0.3).tolist()) for k in range(220)]
    rows += [(0, 900, [0.0] * 6), (0, 901, [0.0] * 6), (None, 902, [1.0] * 6), (None, 903, [1.0] * 6)]
    df = spark.createDataFrame(rows, "label int, vec_id long, embedding array<double>").repartition(3)
    got = {(r.label, r.vec_id): r.leader for r in V.leader_clusters(df, "label", "vec_id", "embedding", 0.9).collect()}
    assert got == plain_leaders(rows, 0.9) and len(set(got.values())) > 2 * block / 3
    assert V.leader_clusters(df.limit(0), "label", "vec_id", "embedding", 0.9).count() == 0


def test_stories_by_run_forget_old_ones(spark):
    """One chain of shared entities over all days; each run sees 48 hours."""
    rng = random.Random(7)
    names = [f"e{k:02d}" for k in range(9)]
    units = [(100 * d + k, d * 86400 + 3600 * k, rng.sample(names, rng.randrange(0, 4))) for d in (0, 1, 2, 5, 6, 9) for k in range(14)]
    got = {r.unit_id: r.story_id for r in S.stories_by_run(spark.createDataFrame(units, "unit_id long, at long, entities array<string>").repartition(3)).collect()}
    want, stories = {}, {}
    for day in sorted({at // 86400 for _, at, _ in units}):
        run = sorted((at // 86400, u, frozenset(e)) for u, at, e in units if at // 86400 == day)
        begins = min(at for _, at, _ in units if at // 86400 == day)
        recent = sorted((s, e) for s, (e, t) in stories.items() if t >= begins - 48 * 3600)
        for (_, u, e), s in zip(run, S.attach(run, stories=[(s, frozenset(e)) for s, e in recent]), strict=True):
            want[u] = s
        for s in set(want[u] for _, u, _ in run):
            mine = [(e, at) for u, at, e in units if at // 86400 == day and want[u] == s]
            old = set(dict(recent).get(s, ()))
            stories[s] = (set(sorted(old.union(*[e for e, _ in mine]))[:10]), max(at for _, at in mine))
    assert got == want and len({s // 100 for s in want.values()}) > 2
    assert S.stories_by_run(spark.createDataFrame([], "unit_id long, at long, entities array<string>")).count() == 0


def test_search_equals_every_run(spark):
    rng = random.Random(5)
    words = ["Ukraine", "talks", "Geneva", "resume", "Genève", "in", "a", "of", "Mont-Blanc", "talk", "ukrainian", "x9", "and", "the"]
    titles = [(k, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 8)))) for k in range(120)] + [(500, None), (501, ""), (502, "Ukraine talks"), (502, "Ukraine talks")]
    queries = [(1, "ukrain"), (2, "talks in"), (3, "geneva resume"), (4, "a"), (5, "zzz"), (6, ""), (7, None), (8, "kraine tal"), (9, "in a"), (10, "blanc the"), (11, "nian")]
    t = spark.createDataFrame(titles[:-1], "id long, title string").repartition(3)
    got = {}
    for r in A.search(t, spark.createDataFrame(queries, "q long, query string"), 1000).collect():
        got[r.q, r.id] = r.score
    want = {}
    for q, text in queries:
        for i, title in titles[:-1]:
            score = A.plain_similarity(text or "", title or "")
            if score >= 0.6 or (text or "").lower() in (title or "").lower():
                want[q, i] = pytest.approx(score, abs=1e-6)
    assert got == want
    top = A.search(t, spark.createDataFrame(queries, "q long, query string"), 3).groupBy("q").count().where("count > 3")
    assert top.count() == 0 and A.search(t.limit(0), spark.createDataFrame(queries, "q long, query string"), 3).where(F.col("score") > 0).count() == 0
