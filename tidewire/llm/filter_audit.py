"""Filter interaction audit: what each filter removes at each step of every order, over the lattice of filter subsets.

With n filters the lattice has n * 2^(n-1) edges (S, f): the filters of S have been applied, f comes next. What f removes there
depends on S alone and not on the order within S, so documents are counted once per edge (80 for five filters), and the
n * n! steps of all orders (600) are looked up as edges along lattice paths. Documents are first counted by part, set of failed
filters and labels, which is what their contributions to all edges hang on; an edge never sees a single document.

Nulls: a null text is empty, a null part is the empty string, a null doc_id ranks after all others (of equal texts without an id
none comes before another). Rows that repeat id and text are documents each, none before the other. A document is good or toxic
if any of its rows in ``labels`` says so; labels without an id belong to none. Very long texts are read whole, one at a time.
An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.common import NO_ID, id_of, text_of

SPACE, WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]+"
#: Fewest words, least share of distinct words and largest share of capitals, as percentages, and characters not allowed.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SIGNS = 100, 80, 10, r"[#$%&*|]"
#: Rows without an id match no label; they are dealt over so many keys of the join.
SALTS = 4096


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions that a text alone decides, by filter letter."""
    words = F.array_remove(F.split(text, SPACE), "")
    return {
        "A": F.size("__words") < LEAST_WORDS, "B": F.size(F.array_distinct("__words")) * 100 < F.size("__words") * LEAST_DISTINCT,
        "C": F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long") * 100 > F.length(text).cast("long") * MOST_CAPITALS, "D": text.rlike(SIGNS), "__words": words,
    }


def failures(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """(part, fails, good, toxic, n): documents by the set of filters they fail, bit k for the k-th letter of ABCDE.

    Equal texts fail A to D alike, so a text is known by its digest from here on. E fails all rows of a text but those of its
    smallest id: rows are counted by (digest, part, labels) before a digest's groups meet, however many copies it has.
    """
    own = text_filters(F.col("__text"))
    words = own.pop("__words")
    read = docs.select(id_of("doc_id").alias("__doc"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), text_of("text").alias("__text"))
    bits = reduce(lambda a, b: a + b, [F.when(c, 1 << k).otherwise(0) for k, c in enumerate(own.values())])
    rows = read.withColumn("__words", words).select("__doc", "part", bits.alias("fails"), F.unhex(F.sha2(F.col("__text").cast("binary"), 256)).alias("digest"))
    rows = rows.groupBy("__doc", "digest", "part", "fails").agg(F.count("*").alias("n"))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("__doc")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    salt = F.when(F.col("__doc") == NO_ID, 1 + F.pmod(F.xxhash64("digest"), F.lit(SALTS))).otherwise(F.lit(0).cast("long"))
    rows = rows.withColumn("__salt", salt).join(marks.withColumn("__salt", F.lit(0).cast("long")), ["__doc", "__salt"], "left")
    rows = rows.withColumns({"good": F.coalesce("good", F.lit(0)), "toxic": F.coalesce("toxic", F.lit(0))})
    # Of a group, the rows of its smallest id: ids are unique in it by now.
    group = rows.groupBy("digest", "part", "fails", "good", "toxic").agg(F.sum("n").alias("n"), F.min(F.struct("__doc", "n")).alias("first"))
    # A text has at most four groups in a part, so the window is as small as the parts are few.
    group = group.withColumn("least", F.min("first.__doc").over(Window.partitionBy("digest")))
    stays = F.when(F.col("first.__doc") == F.col("least"), F.col("first.n")).otherwise(F.lit(0))
    both = F.explode(F.array(F.struct(F.col("fails"), stays.alias("n")), F.struct((F.col("fails") + 16).alias("fails"), (F.col("n") - stays).alias("n"))))
    return group.select("part", "good", "toxic", both.alias("x")).where("x.n > 0").groupBy("part", F.col("x.fails").alias("fails"), "good", "toxic").agg(F.sum("x.n").alias("n"))


def edges(patterns: DataFrame, letters: str) -> DataFrame:
    """(part, applied, letter, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for every lattice edge.

    applied is the bit set S, and a pattern of failures contributes to all edges at once. shapley weighs what f removes at (S, f)
    by the |S|! (n - 1 - |S|)! orders that pass there.
    """
    n = len(letters)
    fact = [1]
    for k in range(1, n + 1):
        fact.append(fact[-1] * k)
    lattice = [(s, k, fact[s.bit_count()] * fact[n - 1 - s.bit_count()]) for s in range(1 << n) for k in range(n) if not s >> k & 1]
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("applied"), F.lit(1 << k).alias("bit"), F.lit(letters[k]).alias("letter"), F.lit(w).cast("long").alias("paths")) for s, k, w in lattice]))
    x = patterns.select("*", each.alias("e")).select("part", "fails", "good", "toxic", "n", "e.*")
    before, now = F.col("fails").bitwiseAND(F.col("applied")) != 0, F.col("fails").bitwiseAND(F.col("bit")) != 0
    total = lambda c: F.sum(F.when(c, F.col("n")).otherwise(F.lit(0)))
    got = x.groupBy("part", "applied", "letter", "paths").agg(
        total(~before & ~now).alias("kept"), total(~before & now).alias("removed"), total(before & now).alias("redundant"), total(F.col("fails") == F.col("bit")).alias("unique_fails"),
        total(~before & now & (F.col("good") == 1)).alias("good_lost"), total(~before & now & (F.col("toxic") == 1)).alias("toxic_lost"))
    return got.withColumn("shapley", F.sum(F.col("removed") * F.col("paths")).over(Window.partitionBy("part", "letter"))).drop("paths")


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley): every step of every order.

    The steps are a fixed table of n * n! rows, broadcast; each is one edge of its order's path through the lattice.
    """
    letters = "ABCDE"
    at = {c: 1 << k for k, c in enumerate(letters)}
    steps = [("".join(p), k + 1, sum(at[c] for c in p[:k]), p[k]) for p in permutations(letters) for k in range(len(letters))]
    path = docs.sparkSession.createDataFrame(steps, "filter_order string, step int, applied int, letter string")
    got = edges(failures(docs, labels, part), letters).join(F.broadcast(path), ["applied", "letter"])
    return got.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
