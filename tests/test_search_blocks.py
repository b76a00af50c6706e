"""The search by blocks: exact scores of every run, titles long and repetitive, and queries that are held as they stand."""

import random

import pytest
from tidewire.operators import assign as A
from tidewire.operators import runs as R


@pytest.mark.parametrize("wide", [4, 128])
@pytest.mark.parametrize("titles", [7, 1 << 13])
def test_best_are_the_plain_ones(spark, monkeypatch, wide, titles):
    for at, name, value in ((A, "TITLES", titles), (A, "ASKED", titles), (R, "WIDE", wide), (R, "LONG", 3 * wide)):
        monkeypatch.setattr(at, name, value)
    rng = random.Random(wide + titles)
    words = ["the", "tha", "on", "no", "river", "rive", "stone", "stones", "a", "ö"]
    named = [(k, " ".join(rng.choices(words, k=rng.choice((1, 2, 4, 9, 40))))) for k in range(90)] + [(100, None), (101, ""), (102, "!!"), (103, "RIVER stone")]
    asked = [(1, "the riv"), (2, "on"), (3, ""), (4, "stone the"), (5, "river"), (6, "River"), (7, "tones"), (8, None), (9, "zzz"), (10, "a the on no river"), (11, "ver sto")]
    got = A.search(spark.createDataFrame(named, "id long, title string"), spark.createDataFrame(asked, "q long, query string"), 12).collect()
    want = set()
    for q, query in asked:
        query = query or ""
        scores = [(-A.plain_similarity(query, t or ""), k) for k, t in named if query.lower() in (t or "").lower() or A.plain_similarity(query, t or "") >= 0.6]
        want |= {(q, k, round(-s, 6)) for s, k in sorted(scores)[:12]}
    assert {(r.q, r.id, r.score) for r in got} == want and len(got) == len(want)


def test_no_candidate_is_a_row(spark):
    """Many titles share every trigram with a query, but far apart: none of them leaves its block."""
    rows = [(k, f"river {' '.join(f'x{k}y{j}' for j in range(12))} stone") for k in range(400)]
    written, cut = [], A.cut_lineage
    try:
        A.cut_lineage = lambda df: written.append(cut(df)) or written[-1]
        got = A.search(spark.createDataFrame(rows, "id long, title string"), spark.createDataFrame([(1, "river stone")], "q long, query string"), 50)
    finally:
        A.cut_lineage = cut
    assert got.count() == 0
    assert [df.count() for df in written if "score" in df.columns] == [0]
