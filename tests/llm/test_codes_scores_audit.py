"""Vector codes, language-model scores and the filter audit beside plain versions, also on awkward and empty tables."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import edge
import numpy as np
import pytest

from tidewire.llm import filter_audit, lm_score, oracles, vector_codes

# Vector codes


def plain_codes(rows, parts=4, entries=256, rounds=4):
    """rows: (id, vector, label), complete, in the order of id and vector."""
    width = max(parts, -(-max((len(v) for _, v, _ in rows), default=0) // parts) * parts)
    own = width // parts
    x = [[math.floor(1024 * c) for c in v] + [0] * (width - len(v)) for _, v, _ in rows]
    cut = [[v[p * own : (p + 1) * own] for p in range(parts)] for v in x]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    near = lambda v, book: min((sum((a - b) ** 2 for a, b in zip(v, e, strict=True)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        new = []
        for p in range(parts):
            got = {}
            for c in cut:
                got.setdefault(near(c[p], books[p])[1], []).append(c[p])
            new.append([[sum(col) // len(got[k]) for col in zip(*got[k], strict=True)] if k in got else e for k, e in enumerate(books[p])])
        books = new
    found = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    total = Counter()
    for (_, _, label), f in zip(rows, found, strict=True):
        total[label] += sum(d for d, _ in f)
    return sorted(((i, "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), total[label], digest) for (i, _, label), f in zip(rows, found, strict=True)), key=repr)


def coded(spark, rows, **more):
    df = spark.createDataFrame([(i, v, y, 1, "x") for i, v, y in rows], "vec_id long, embedding array<float>, label int, id long, vec string").repartition(3)
    return sorted((tuple(r) for r in vector_codes.compress(df, **more).select("id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)


def test_codes_equal_plain_version(spark):
    rng = random.Random(4)
    rows = [(k, [rng.choice((-1, 0.5, 0.25, 1)) * rng.random() for _ in range(8)], k % 3 or None) for k in range(90)]
    rows += [(200 + k, rows[k % 4][1], 1) for k in range(40)]
    rows = [(i, np.float32(v).tolist(), y) for i, v, y in rows]
    assert coded(spark, rows, entries=16) == plain_codes(rows, entries=16)


def test_codes_of_awkward_rows(spark):
    bad = [(1, None, 1), (2, [1.0, None, 2.0, 3.0], 1), (3, [math.nan, 0.0, 0.0, 0.0], 1), (4, [math.inf, 0.0, 0.0, 0.0], 1)]
    good = [(5, [1.0, 2.0, 3.0, 4.0, 5.0], None), (6, [], None), (7, [-1.0, -0.0001, 0.5, 2.0], 2), (7, [-1.0, -0.0001, 0.5, 2.0], 2), (8, [0.25], 2)]
    good = [(i, np.float32(v).tolist(), y) for i, v, y in good]
    assert coded(spark, bad + good, entries=3) == plain_codes(good, entries=3)
    far = coded(spark, [(1, [3e38, -3e38, 0.0, 1.0], 1), (None, [0.0, 0.0, 0.0, 0.0], 1)], entries=1)
    assert [r[0] for r in far] == [1, None]
    assert coded(spark, bad) == []
    assert vector_codes.compress(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_annulus_finds_the_nearest_entry(seed):
    rng = np.random.default_rng(seed)
    span = (3, 50, 4000, 1 << 20)[seed % 4]
    entries, x = rng.integers(-span, span, (rng.integers(1, 300), 6)), rng.integers(-span, span, (500, 6))
    entries[rng.integers(0, len(entries), 20)] = entries[0]
    far = ((x[:, None, :] - entries[None]) ** 2).sum(2)
    at, best = vector_codes.Codebook(entries).nearest(x)
    assert (at == far.argmin(1)).all() and (best == far.min(1)).all()


# Language-model scores


def plain_scores(rows, order, mu):
    """The whole automaton as dictionaries, walked token by token."""
    low = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
    docs = [(i, i is None or zlib.crc32(str(i).encode()) % 7 == 2, ["s"] + (t or "").encode().translate(low).split() + ["e"]) for i, t in rows]
    c = Counter()
    for _, held, w in docs:
        if not held:
            c.update(tuple(w[t - k + 1 : t + 1]) for k in range(1, order + 1) for t in range(max(1, k - 1), len(w)))
            c[("s",)] += 1
    words = {g: n for g, n in c.items() if len(g) == 1 and g != ("s",)}
    n, v = sum(words.values()), len(words)
    p = lambda ctx, w: (c[ctx + (w,)] + mu * p(ctx[1:], w)) / (c[ctx] + mu) if ctx else (words.get((w,), 0) + 1) / (n + v + 1)
    out = []
    for i, held, w in docs:
        state, score = ("s",)[: order - 1], 0.0
        while state and not c[state]:
            state = state[1:]
        for x in w[1:]:
            while state and not c[state + (x,)]:
                score, state = score + math.log10(mu / (c[state] + mu)), state[1:]
            score += math.log10(p(state, x))
            state = (state + (x,))[-(order - 1) :] if order > 1 else ()
            while state and not c[state]:
                state = state[1:]
        out.append((i, held, len(w) - 1, sum((x,) in words for x in w[1:]), n, sum(math.log10(p((), x)) for x in w[1:]), score))
    return out


def assert_scores(got, want):
    key = lambda r: repr(r[:5]) + f"{r[6]:.6f}"
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert tuple(a[:5]) == b[:5] and a[5] == pytest.approx(b[5], abs=1e-6) and a[6] == pytest.approx(b[6], abs=1e-6)


@pytest.mark.parametrize(("order", "mu", "block", "shard"), [(3, 2.0, 12 << 20, 1 << 21), (3, 100.0, 1 << 12, 1 << 10), (2, 5.0, 1 << 14, 1 << 12), (1, 1.0, 1 << 16, 1 << 16)])
def test_scores_equal_the_whole_automaton(spark, sf, rows, order, mu, block, shard):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert_scores(lm_score.score_documents(docs, order, mu, block, shard).collect(), plain_scores(list(rows.items()), order, mu))


def test_scores_of_awkward_rows(spark, tmp_path):
    edge.frame(spark).write.parquet(f"{tmp_path}/docs")
    assert_scores(lm_score.score_documents(spark.read.parquet(f"{tmp_path}/docs"), block_bytes=64, shard_tokens=50).collect(), plain_scores(edge.ROWS, lm_score.ORDER, lm_score.MU))
    assert lm_score.score_documents(edge.empty(spark)).count() == 0


def test_probabilities_sum_to_one(spark):
    """Over all known words, the end and one unknown word, in a context that was seen."""
    docs = [(k, "a b a c a b d") for k in range(6)]
    ends = [(100 + k, f"a b{x}") for k, x in enumerate(["", " a", " b", " c", " d", " zz"])]
    learnt = [r for r in docs if zlib.crc32(str(r[0]).encode()) % 7 != 2]
    tests = [(next(k for k in range(1000 * i, 1000 * i + 1000) if zlib.crc32(str(k).encode()) % 7 == 2), t) for i, t in ends]
    got = {r.doc_id: r.score for r in lm_score.score_documents(spark.createDataFrame(learnt + tests, "doc_id long, text string"), mu=3.0).collect()}
    want = {r[0]: r[6] for r in plain_scores(learnt + tests, 3, 3.0)}
    assert all(math.isclose(got[i], want[i], abs_tol=1e-9) for i in got)


def test_context_helps_on_held_out_texts(spark):
    got = lm_score.score_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").selectExpr("sum(score) AS s", "sum(base_score) AS b").first()
    assert got.s > got.b


# Filter audit


def plain_audit(docs, labels):
    first, rows = {}, []
    rank = lambda i: math.inf if i is None else i
    for i, t, _ in docs:
        first[t or ""] = min(first.get(t or "", math.inf), rank(i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    for i, t, part in docs:
        t = t or ""
        words = re.findall("[^\x20\x09-\x0d]+", t)
        fails = [len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), bool(re.search(r"[#$%&*|]", t)), first[t] < rank(i)]
        rows.append((part or "", {f for f, x in zip("ABCDE", fails, strict=True) if x}, i in good, i in toxic))
    out, share = {}, Counter()
    for part in {r[0] for r in rows}:
        own = [r[1:] for r in rows if r[0] == part]
        for order in itertools.permutations("ABCDE"):
            for k, f in enumerate(order):
                left = [r for r in own if not r[0] & set(order[:k])]
                lost = [r for r in left if f in r[0]]
                out[part, "".join(order), k + 1] = (len(left) - len(lost), len(lost), sum(f in r[0] for r in own) - len(lost), sum(r[0] == {f} for r in own), sum(r[1] for r in lost), sum(r[2] for r in lost), f)
                share[part, f] += len(lost)
    return sorted((*key, *v[:6], share[key[0], v[6]]) for key, v in out.items())


def audited(spark, docs, labels):
    d = spark.createDataFrame([(i, t, part, None, 1) for i, t, part in docs], "doc_id long, text string, lang string, part string, n long").repartition(3)
    return sorted(tuple(r) for r in filter_audit.audit(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect())


def test_audit_equals_plain_version(spark):
    rng = random.Random(2)
    many = " ".join(f"w{k}" for k in range(120))
    texts = [None, "", "short", "SHOUT A", many, many + " %", many.upper(), " ".join(["x"] * 300), many + " é ö", "a\x0bb " * 90, "word " * 40000]
    docs = [(rng.choice([None, *range(30)]), rng.choice(texts), rng.choice([None, "", "en", "de"])) for _ in range(200)]
    labels = [(k % 25 if k % 9 else None, rng.choice([0, 1, None]), rng.choice([0, 1])) for k in range(50)]
    got = audited(spark, docs, labels)
    assert got == plain_audit(docs, labels) and len(got) == 3 * 600
    assert audited(spark, [], labels) == []
    assert audited(spark, docs[:5], []) == plain_audit(docs[:5], [])


@pytest.mark.parametrize(("name", "tables"), [("op11_vector_codes", ["embeddings"]), ("op13_filter_audit", ["documents", "labels"])])
def test_queries_equal_sql(spark, sf, name, tables):
    from tidewire.llm import queries

    con = duckdb.connect()
    for t in tables:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.sql(oracles.ORACLES[name])
    got = queries.QUERIES[name](spark, sf)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(tuple(r) for r in got.select(*want.columns).collect()) == sorted(want.fetchall())
