"""The pipeline, stage by stage, against plain versions of each."""

import re
import sys
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parents[2]))
import edge
from test_operators import check_packing, plain_lines, plain_print

import corpus_pipeline
from tidewire.llm import quality, secret_scan, simhash


def plain_score(model, text):
    """The vote of the nearest labelled vectors, one cosine at a time."""
    x = (quality.term_counts(text) * model.weights - model.mean) @ model.basis
    x = x / max(np.linalg.norm(x), 1e-9)
    cos = sorted(((float(np.dot(x, v)), float(y)) for v, y in zip(model.vectors, model.y, strict=True)), reverse=True)[: model.neighbours]
    weights = [max(c, 1e-3) ** 4 for c, _ in cos]
    return sum(w * y for w, (_, y) in zip(weights, cos, strict=True)) / sum(weights)


def shingle_set(text, size=5):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), text).translate({ord(c): " " for c in "\t\n\x0b\x0c\r"}).split(" ")
    w = [x for x in w if x]
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def near_groups(rows):
    """The ids that stay, by all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if jaccard(sets[a], sets[b]) >= corpus_pipeline.SIMILARITY:
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(i, least.get(find(k), i))
    return {i for k, (i, _) in enumerate(rows) if least[find(k)] == i}


def test_fingerprint_is_the_plain_one(rows):
    for t in list(rows.values())[:40]:
        assert simhash.fingerprint(t.encode(), 5) % (1 << 64) == plain_print(t, 5)


def edited(text, similarity, rng):
    """A copy with words replaced until the shingle similarity is about that asked for, never below it."""
    words, base = text.split(), shingle_set(text)
    best = text
    for k in range(len(words)):
        words[int(rng.integers(len(words)))] = f"edit{k}"
        got = " ".join(words)
        if jaccard(base, shingle_set(got)) < similarity:
            return best
        best = got
    return best


@pytest.mark.parametrize("similarity", [0.8, 0.85, 0.9, 0.95])
def test_recall_of_planted_copies(spark, similarity):
    """Copies of texts of 150 words and more, edited down to a similarity, are dropped: 0.95 of them at least."""
    docs = pq.read_table("/root/testdata/sf0.01/documents.parquet")
    texts, rng = [t for t in docs["text"].to_pylist() if 150 <= len(t.split()) <= 3000], np.random.default_rng(5)
    seen, base = set(), []
    for t in texts:  # texts that have no near copy among themselves, by their rarest shingles
        own = shingle_set(t)
        if not own & seen:
            base.append(t)
            seen |= own
    base = base[:120]
    rows = [(k, t) for k, t in enumerate(base)] + [(1000 + k, edited(t, similarity, rng)) for k, t in enumerate(base)]
    stay = {r.doc_id for r in simhash.one_of_each(edge.frame(spark, rows)).collect()}
    assert stay >= set(range(len(base)))
    assert len(stay) - len(base) <= 0.05 * len(base), (similarity, len(base))


def test_blocks_lose_no_link(spark):
    """Groups that several blocks hold are joined wherever two of their texts are alike."""
    rng = np.random.default_rng(2)
    base = [rng.integers(0, 1 << 60, 100, dtype=np.uint64) for _ in range(3)]
    sets = []
    for k in range(60):
        own = base[k % 3].copy()
        own[rng.integers(0, 100, 7)] = rng.integers(0, 1 << 60, 7, dtype=np.uint64)
        sets.append(np.unique(own))
    held = spark.createDataFrame([(key, k, 0 if k % 6 == 0 else k) for key in (1, 2) for k in range(60)], "key long, node long, item long")
    packed = spark.createDataFrame([(k, bytearray(x.astype("<u8").tobytes())) for k, x in enumerate(sets)], "node long, shingles binary")

    def groups(links):
        root = {k: 0 if k % 6 == 0 else k for k in range(60)}
        for a, b in links:
            x, y = root[a], root[b]
            root = {k: min(x, y) if v in (x, y) else v for k, v in root.items()}
        return root

    want = groups([(a, b) for a in range(60) for b in range(a) if simhash.similar(sets[a], sets[b], 0.8)])
    assert len(set(want.values())) < 40
    for per in (4, 8, 256):
        assert groups([tuple(r) for r in simhash.links_between(held, packed, 0.8, per).collect()]) == want


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        out.append((name, corpus_pipeline.staged(stage(spark, out[-1][1], sf))))
    return out


def texts(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_names_and_columns(stages):
    assert [n for n, _ in stages] == ["documents", "quality", "lines", "near copies", "secrets", "packing"]
    assert all(df.columns == stages[0][1].columns for _, df in stages[:-1])
    assert all(r.n_chars == len(r.text) for r in stages[4][1].collect())


def test_quality_stage(spark, sf, stages):
    model = quality.fit(stages[0][1], spark.read.parquet(f"{sf}/labels.parquet"))
    want = [(i, t) for i, t in texts(stages[0][1]) if plain_score(model, t.encode()) >= quality.THRESHOLD]
    assert texts(stages[1][1]) == want


def test_lines_stage(stages):
    assert texts(stages[2][1]) == sorted((i, t) for i, _, _, t in plain_lines(texts(stages[1][1])))


def test_near_copies_stage(stages):
    before = texts(stages[2][1])
    kept = near_groups(before)
    assert texts(stages[3][1]) == [(i, t) for i, t in before if i in kept]


def test_secrets_stage(stages):
    after = texts(stages[4][1])
    assert after == [(i, secret_scan.masked(t)[0]) for i, t in texts(stages[3][1])]
    assert not any(secret_scan.scan(t)[1] for _, t in after)


def test_packing_stage(stages):
    check_packing(stages[5][1].collect(), texts(stages[4][1]))


def test_awkward_rows(spark, sf):
    for docs in (edge.frame(spark), edge.empty(spark)):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = corpus_pipeline.staged(stage(spark, docs, sf))
            assert k == 4 or docs.columns == edge.frame(spark).columns


def test_run(spark, sf, stages):
    assert corpus_pipeline.run(spark, sf).count() == stages[-1][1].count()
