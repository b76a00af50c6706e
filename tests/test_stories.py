"""Stories in batch and as a stream against a plain fold; answers matched; runs of words; tables of rows without SQL."""

import random

import pytest
from pyspark.sql import functions as F

from tidewire.operators import assign as A
from tidewire.operators import stories as S
from tidewire.plans import catalog
from tidewire.streaming import streams

SF = "/root/testdata/sf0.001"
HOUR = 3600


def plain(units, stories):
    """stories: {id: (entities, updated)}; the run's own stories are uncut while it runs."""
    out, cache = {}, {s: set(e) for s, (e, _) in sorted(stories.items())}
    for day, unit, own in sorted(units):
        best, most = None, 0.0
        for s, e in cache.items():
            j = len(own & e) / len(own | e) if own and e else 0.0
            if j > most and j >= 0.4:
                best, most = s, j
        if best is None:
            best, cache[unit] = unit, set(sorted(own)[:10])
        else:
            cache[best] |= own
        out[unit] = best
    return out


def made(n, seed):
    rng = random.Random(seed)
    return [(k, 100 + k, frozenset(rng.sample([f"e{i}" for i in range(40)], rng.randrange(0, 6)))) for k in range(n)]


def frame(spark, units):
    return spark.createDataFrame([(u, d, sorted(e)) for d, u, e in units], "unit_id long, day long, entities array<string>")


@pytest.mark.parametrize("seed", [1, 2])
def test_batch_is_the_fold(spark, seed):
    units, recent = made(80, seed), {5: ({"e1", "e2", "e3"}, 0), 9: ({"e1", "e2"}, 0), 101: ({"e30", "e31"}, 0)}
    units = [u for u in units if u[1] != 101]
    old = spark.createDataFrame([(s, sorted(e)) for s, (e, _) in recent.items()], "story_id long, entities array<string>")
    got = {r.unit_id: r.story_id for r in S.build_stories(frame(spark, units), recent=old).collect()}
    assert got == plain(units, recent)


def test_stream_is_the_fold_of_its_runs(spark, tmp_path):
    runs = [[(at * HOUR, 1000 * r + k, e) for k, (_, _, e) in enumerate(made(25, 10 + r))] for r, at in enumerate((0, 20, 40, 120))]
    for r, units in enumerate(runs):
        rows = [(u, at // 86400, at, sorted(e)) for at, u, e in units]
        spark.createDataFrame(rows, "unit_id long, day long, at long, entities array<string>").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    # Each file is a run of its own, oldest first.
    stream = spark.readStream.schema("unit_id long, day long, at long, entities array<string>").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = {r.unit_id: r.story_id for r in streams.story_stream(stream, str(tmp_path / "out")).collect()}
    want, stories = {}, {}
    for units in runs:
        now = units[0][0]
        recent = {s: (e, t) for s, (e, t) in stories.items() if t >= now - 48 * HOUR}
        mine = plain([(at // 86400, u, e) for at, u, e in units], recent)
        want |= mine
        for at, u, e in units:
            s = mine[u]
            stories[s] = (set(sorted((stories[s][0] if s in stories else set()) | e)[:10]), at)
    assert got == want and any(v < 1000 for k, v in want.items() if k >= 1000) and not any(v < 3000 for k, v in want.items() if k >= 3000)


def test_matches_are_the_plain_ones(spark):
    rng = random.Random(3)
    words = ["river", "stone", "light", "cloud", "green", "paper", "horse", "metal"]
    rows = [(f"a{k}", [" ".join(rng.sample(words, 4)) for _ in range(5)], [" ".join(rng.sample(words, 4)) for _ in range(4)] + [""]) for k in range(12)]
    df = spark.createDataFrame(rows, "article string, gold array<string>, pred array<string>")
    got = sorted((r.article, r.gold_index, r.pred_index) for r in A.match_snippets(df).collect())
    score = lambda a, b: A.token_f1(a.split(), b.split())
    assert got == sorted((a, i, j) for a, g, p in rows for i, j in A.plain_matches(g, p, score))


def test_word_similarity_is_the_best_run(spark):
    titles = ["Ukraine talks resume in Geneva", "the ukrain", "nothing here", "", "Genève talks", "a b c d e f g", "talks"]
    df = spark.createDataFrame([(k, str(k), t) for k, t in enumerate(titles)], "id long, story string, title string")
    for q in ("ukrain", "talks in", "geneva"):
        got = {int(r.story): r.score for r in A.word_similarity(df, q, 50, least=0.0).collect()}
        assert all(got[k] == pytest.approx(A.plain_similarity(q, t), abs=1e-6) for k, t in enumerate(titles))
        best = {int(r.story) for r in A.word_similarity(df, q, 50).collect()}
        assert best == {k for k, t in enumerate(titles) if A.plain_similarity(q, t) >= 0.6 or q in t.lower()}


def test_paragraph_diffs(spark):
    rows = catalog.QUERIES["paragraph_diff"](spark, SF).collect()
    assert all(r.changed >= max(r.added, r.removed) and len(r.excerpt) <= 1200 and r.truncated == ("[truncated at" in r.excerpt) for r in rows)


def test_alignment_is_a_longest_one():
    import random

    from tidewire.functions import alignment as AL

    def longest(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        return best[-1][-1]

    rng = random.Random(2)
    for _ in range(400):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(0, 12))] for _ in range(2))
        pairs = AL.matches(a, b)
        assert len(pairs) == longest(a, b) and all(a[i] == b[j] for i, j in pairs) and all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
        changed, added, removed, excerpt, cut = AL._row(a, b)
        assert (added, removed) == (len(b) - len(pairs), len(a) - len(pairs)) and max(added, removed) <= changed <= added + removed and not cut
        assert (excerpt == "") == (a == b)
    assert AL._row(["x" * 3000], [])[3:] == ("- " + "x" * (1200 - len("[truncated at 1200 characters]") - 3) + "\n[truncated at 1200 characters]", True)


def test_snippets_kept_share_nothing(spark):
    kept = catalog.QUERIES["snippet_dedup"](spark, SF)
    text = spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id").alias("id"), F.posexplode(F.split("text", r"(?<=[.!?])\\s+")).alias("k", "snippet"))
    seen = {}
    for r in kept.where("kept").join(text, ["id", "k"]).collect():
        own = A._grams(r.snippet)
        assert not own & seen.setdefault(r.id, set())
        seen[r.id] |= own


def test_search_of_copies(spark):
    """Equal titles and queries are sought once; each copy of a query is answered, and no title is scored twice in the plan."""
    titles = [(k, "The long way round") for k in range(100, 130)] + [(k, "A long waiting line") for k in range(30)] + [(500, None), (501, "")]
    asked = [(1, "long way"), (2, "long way"), (3, "long wai")]
    df = A.search(spark.createDataFrame(titles, "id long, title string"), spark.createDataFrame(asked, "q long, query string"), 12)
    got = {(r.q, r.id): r.score for r in df.collect()}
    near = lambda query, title: round(A.plain_similarity(query, title), 6)
    want = {(q, k): near("long way", "The long way round") for q in (1, 2) for k in range(100, 112)} | {(3, k): near("long wai", "A long waiting line") for k in range(12)}
    assert got == want
    assert "aggregate(flatten(transform" not in df._jdf.queryExecution().optimizedPlan().toString()
