"""Matching and searching by words: greedy one-to-one pairs, greedy dedup, and the nearest run of words."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.functions import extract as X
from tidewire.operators import runs as R
from tidewire.operators.graph import cut_lineage

MATCH, LEAST_SIMILARITY = 0.5, 0.6
#: Titles of a block, and queries that are asked of it in one place.
TITLES, ASKED = 1 << 13, 1 << 12


def match_snippets(rows: DataFrame, threshold: float = MATCH) -> DataFrame:
    """(article, gold_index, pred_index, f1) of rows (article, gold, pred: arrays of texts): pairs of token F1 from the threshold on, best first, each text once.

    Pairs are made and scored as rows; only the greedy pick of an article's own few pairs is a fold.
    """
    side = lambda c, k, t: rows.select("article", F.posexplode(c).alias(k, t)).select("article", k, X.scored_form(F.col(t)).alias(t))
    g = side("gold", "gold_index", "g").withColumn("gt", X.tokens(F.col("g")))
    p = side("pred", "pred_index", "p").withColumn("pt", X.tokens(F.col("p")))
    counts = lambda df, k, t: df.select("article", k, F.size(t).alias(f"n_{k}"), F.explode(t).alias("word")).groupBy("article", k, f"n_{k}", "word").agg(F.count("*").alias(f"c_{k}"))
    met = counts(g, "gold_index", "gt").join(counts(p, "pred_index", "pt"), ["article", "word"]).groupBy("article", "gold_index", "pred_index", "n_gold_index", "n_pred_index").agg(F.sum(F.least("c_gold_index", "c_pred_index")).alias("both"))
    f1 = (2 * F.col("both") / (F.col("n_gold_index") + F.col("n_pred_index"))).alias("f1")
    scored = met.select("article", "gold_index", "pred_index", f1)
    bare = g.where("size(gt) = 0").join(p.where("size(pt) = 0"), (g.article == p.article) & (F.col("g") == F.col("p"))).select(g.article, "gold_index", "pred_index", F.lit(1.0).alias("f1"))

    def pick(gold: pd.Series, pred: pd.Series) -> pd.Series:
        return pd.Series([_each_once(a, b) for a, b in zip(gold, pred, strict=True)])

    ranked = F.array_sort(F.collect_list(F.struct((-F.col("f1")).alias("less"), "gold_index", "pred_index", "f1")))
    rows = scored.unionByName(bare).where(F.col("f1") >= threshold).groupBy("article").agg(ranked.alias("s"))
    picked = rows.select("article", "s", F.pandas_udf(pick, "array<boolean>")(F.transform("s", lambda x: x["gold_index"]), F.transform("s", lambda x: x["pred_index"])).alias("kept"))
    out = picked.select("article", F.explode(F.arrays_zip("s", "kept")).alias("x")).where("x.kept")
    return out.select(F.col("article").cast("string").alias("article"), "x.s.gold_index", "x.s.pred_index", "x.s.f1")


def _each_once(gold: list[int], pred: list[int]) -> list[bool]:
    used: tuple[set, set] = (set(), set())
    keep = []
    for a, b in zip(gold, pred, strict=True):
        keep.append(a not in used[0] and b not in used[1])
        if keep[-1]:
            used[0].add(a)
            used[1].add(b)
    return keep


def plain_matches(gold: list[str], pred: list[str], f1, threshold: float = MATCH) -> list[tuple[int, int]]:
    """The same of one article, for tests."""
    pairs = sorted((-f1(a, b), i, j) for i, a in enumerate(gold) for j, b in enumerate(pred) if f1(a, b) >= threshold)
    used: tuple[set, set] = (set(), set())
    out = []
    for _, i, j in pairs:
        if i not in used[0] and j not in used[1]:
            used[0].add(i)
            used[1].add(j)
            out.append((i, j))
    return out


def _grams(text: str, n: int = 5) -> set[str]:
    w = text.lower().split()
    return {" ".join(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {" ".join(w)}


def distinct_snippets(snippets: DataFrame, n: int = 5) -> DataFrame:
    """(id, k, kept) of snippets (id, k, snippet, confidence): one stays if it shares no n words in a row with one that stays before it.

    The order is by confidence, then place. An article's snippets are one row, as large as one text, and many such rows go to Python
    at a time.
    """

    def pick(articles: pd.Series) -> pd.Series:
        return articles.map(lambda texts: _first_of_grams(texts, n))

    own = F.struct(F.col("confidence").isNull().alias("none"), (-F.col("confidence")).alias("less"), "k", "snippet")
    rows = snippets.groupBy("id").agg(F.array_sort(F.collect_list(own)).alias("s"))
    picked = rows.select("id", F.transform("s", lambda x: x["k"]).alias("k"), F.pandas_udf(pick, "array<boolean>")(F.transform("s", lambda x: x["snippet"])).alias("kept"))
    return picked.select("id", F.explode(F.arrays_zip("k", "kept")).alias("x")).select("id", "x.k", "x.kept")


def _first_of_grams(texts: list[str], n: int) -> list[bool]:
    seen: set[str] = set()
    kept = []
    for text in texts:
        own = _grams(text, n)
        kept.append(seen.isdisjoint(own))
        if kept[-1]:
            seen |= own
    return kept


def trigrams(text: Column) -> Column:
    """Trigrams of a text's words, each with two spaces before and one behind, in order."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    of = lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.concat(F.lit("  "), w, F.lit(" ")).substr(i, F.lit(3)))
    return F.flatten(F.transform(words, of))


def word_similarity(rows: DataFrame, query: str, limit: int, least: float = LEAST_SIMILARITY) -> DataFrame:
    """(story, score) of rows (id, story, title): the best share of the query's trigrams in any run of the title's, best first.

    A run's score is the trigrams it shares with the query over those of both. A title that holds the query is in, whatever its score.
    """
    words = [w for w in "".join(c if c.isalnum() else " " for c in query.lower()).split()]
    wanted = sorted({f"  {w} "[i : i + 3] for w in words for i in range(len(w) + 1)})
    s = rows.select("story", "title", best_run(trigrams(F.col("title")), F.array(*[F.lit(t) for t in wanted])).alias("score")).where((F.col("score") >= least) | F.contains(F.lower("title"), F.lit(query.lower())))
    return s.groupBy("story").agg(F.round(F.max("score"), 6).alias("score")).orderBy(F.desc("score"), "story").limit(limit)


def best_run(t: Column, asked: Column) -> Column:
    """The best share of asked (distinct trigrams) in any run of trigrams t; a run's score is what it shares over all of both.

    Only runs that begin and end at a shared trigram are tried: any other scores less than the one within it.
    """
    at = F.filter(F.transform(t, lambda x, i: F.when(F.array_contains(asked, x), i)), lambda i: i.isNotNull())

    def score(a: Column, b: Column) -> Column:
        run = F.array_distinct(F.slice(t, a + 1, b - a + 1))
        both = F.size(F.array_intersect(run, asked))
        return both / (F.size(run) + F.size(asked) - both)

    return F.aggregate(F.flatten(F.transform(at, lambda a: F.transform(F.filter(at, lambda b: b >= a), lambda b: score(a, b)))), F.lit(0.0), lambda m, s: F.greatest(m, s))


def search(titles: DataFrame, queries: DataFrame, limit: int, least: float = LEAST_SIMILARITY) -> DataFrame:
    """(q, id, score) for the best titles (id, title) of each query (q, query), by the share of its trigrams in some run; ties by id.

    Titles that hold the query itself are in whatever their score. Titles are dealt to blocks, and so are queries; a block of titles has
    an index of where each trigram stands, and each query of a block is asked of it. A title of score s shares s of a query's n
    trigrams at least, in a run of n / s different ones at most, so only such runs are tried. A block answers with no more
    than limit titles a query, so no pair that is merely a candidate is a row.

    Equal titles are sought once, and so are equal queries; of a title's copies a query can want no more than limit, the first by id.
    """
    named = cut_lineage(titles.select("id", F.coalesce("title", F.lit("")).alias("title")))
    copies = named.withColumn("nth", F.row_number().over(Window.partitionBy("title").orderBy("id"))).where(F.col("nth") <= limit)
    copies = cut_lineage(copies.select("id", "title", "nth", F.min("id").over(Window.partitionBy("title")).alias("first")))
    wanted = cut_lineage(queries.select("q", F.coalesce("query", F.lit("")).alias("query")))
    asked = wanted.groupBy("query").agg(F.min("q").alias("q"))
    same = wanted.join(asked.withColumnRenamed("q", "first_q"), "query").select("q", "first_q")
    text = cut_lineage(copies.where("nth = 1").select("id", F.lower("title").alias("text"), trigrams(F.col("title")).alias("t")))
    asked = cut_lineage(asked.select(F.col("q").alias("id"), F.lower("query").alias("text"), F.array_distinct(trigrams(F.col("query"))).alias("t")))
    p, r = (max(1, -(-df.count() // most)) for df, most in ((text, TITLES), (asked, ASKED)))
    one = lambda n: F.array(F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))
    every = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    dealt = lambda df, x, y, mine: df.withColumn("x", F.explode(x)).withColumn("y", F.explode(y)).withColumn("query", F.lit(mine))
    rows = dealt(text, one(p), every(r), False).unionByName(dealt(asked, every(p), one(r), True)).repartition(min(1024, 2 * p * r), "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        own = rows.filter(pc.invert(rows.column("query"))).combine_chunks()
        if not own.num_rows:
            return
        block = R.Titles(own.column("id").to_numpy(), *(own.column(c).combine_chunks() for c in ("text", "t")))
        for q in rows.filter(rows.column("query")).select(["id", "text", "t"]).to_batches(max_chunksize=1024):
            out = [(k, *block.best(text, t, least, limit)) for k, text, t in zip(*(c.to_pylist() for c in q.columns), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat([k for k, _, _ in out], [len(i) for _, i, _ in out])), *(pa.array(np.concatenate([x[c] for x in out])) for c in (1, 2))], names=["q", "first", "score"])

    # Written, so that titles are asked once.
    found = cut_lineage(rows.groupBy("x", "y").applyInArrow(run, "q long, first long, score double"))
    best = lambda df, k: df.withColumn("best", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), k))).where(F.col("best") <= limit).drop("best")
    each = best(best(found, "first").join(copies, "first").select("q", "id", "score"), "id").withColumnRenamed("q", "first_q")
    return each.join(same, "first_q").select("q", "id", F.round("score", 6).alias("score"))


def plain_similarity(query: str, title: str) -> float:
    """The same of one title, for tests: every run of its trigrams."""
    split = lambda s: ["  " + w + " " for w in "".join(c if c.isalnum() else " " for c in s.lower()).split()]
    of = lambda s: [w[i : i + 3] for w in split(s) for i in range(len(w) - 2)]
    q, t = set(of(query)), of(title)
    runs = (set(t[a:b]) for a in range(len(t)) for b in range(a + 1, len(t) + 1))
    return max((len(r & q) / len(r | q) for r in runs), default=0.0)


def token_f1(a: list[str], b: list[str]) -> float:
    both = sum((Counter(a) & Counter(b)).values())
    return 2 * both / (len(a) + len(b)) if both else 0.0
