"""Snippets of an article: picked as a row among others, not as a frame of its own."""

from tidewire.operators import assign as A


def test_distinct_snippets_by_rows(spark):
    words = "a b c d e f g h i j k l".split()
    texts = {i: [" ".join(words[(i * k) % 7 :][: 3 + k % 5]) for k in range(12)] for i in range(40)} | {-1: ["a b c d e f"] * 3000}
    rows = [(i, k, x, None if (i + k) % 9 == 0 else (k * 37) % 5) for i, xs in texts.items() for k, x in enumerate(xs)]
    df = A.distinct_snippets(spark.createDataFrame(rows, "id long, k int, snippet string, confidence int"))
    want = {}
    for i in texts:
        seen = set()
        for _, k, x, c in sorted((r for r in rows if r[0] == i), key=lambda r: (r[3] is None, -(r[3] or 0), r[1])):
            w = x.split()
            own = {" ".join(w[m : m + 5]) for m in range(max(1, len(w) - 4))}
            want[i, k] = not own & seen
            seen |= own if want[i, k] else set()
    assert {(r.id, r.k): r.kept for r in df.collect()} == want
    assert "FlatMapGroupsInPandas" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_matches_by_rows(spark):
    texts = ["river stone light", "stone light cloud", "river stone", "cloud", "", "green paper horse", "horse"]
    rows = [(f"a{k}", [texts[(k + j) % 7] for j in range(5)], [texts[(k * j + 2) % 7] for j in range(4)]) for k in range(30)]
    df = A.match_snippets(spark.createDataFrame(rows, "article string, gold array<string>, pred array<string>"))
    got = sorted((r.article, r.gold_index, r.pred_index) for r in df.collect())
    f1 = lambda a, b: A.token_f1(a.split(), b.split()) if a or b else 1.0
    assert got == sorted((a, i, j) for a, g, p in rows for i, j in A.plain_matches(g, p, f1))
    assert "FlatMapGroupsInPandas" not in df._jdf.queryExecution().optimizedPlan().toString()
