"""Articles in pages and the language of texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire.functions import html as P
from tidewire.operators import assign as S
from tidewire.operators import language as L
from tidewire.plans.registry import query
from tidewire.sources.tables import table


@query()
def page_articles(spark, sf):
    """Of every whole page, the article's body and title by their digests, its blocks and characters; null where a page holds none."""
    p = table(spark, sf, "pages").select("page_id", P.article(F.col("html")).alias("a")).select("page_id", "a.*")
    return p.select("page_id", F.sha2(F.col("body").cast("binary"), 256).alias("body_sha256"), F.sha2(F.col("title").cast("binary"), 256).alias("title_sha256"), F.coalesce(F.size(F.split("body", "\n")), F.lit(0)).alias("blocks"), F.coalesce(F.length("body"), F.lit(0)).alias("chars"))


@query()
def detected_languages(spark, sf):
    """The language of every whole text, by profiles of a bounded sample; ``fitted`` says whether the text is one of the sample."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    sample = L.sampled(docs, "doc_id", "lang")
    langs, profiles = L.fitted(sample, "lang", "text")
    used = sample.select(F.col("doc_id").alias("used"))
    return docs.join(F.broadcast(used), F.col("doc_id") == F.col("used"), "left").select("doc_id", "lang", L.detected(F.col("text"), langs, profiles).alias("detected"), F.col("used").isNotNull().alias("fitted"))


@query("""WITH d AS (SELECT lang, count(*) AS texts, count(*) FILTER (WHERE length(trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(13))) < 12 OR NOT regexp_matches(coalesce(text, ''), '\\pL')) AS unknown FROM documents WHERE lang IS NOT NULL GROUP BY lang) SELECT lang, texts, unknown FROM d""".replace("\\\\", "\\"))
def language_gaps(spark, sf):
    """By declared language: texts, and those too short or without letters, of which no language is told."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    langs, profiles = L.fitted(L.sampled(docs, "doc_id", "lang"), "lang", "text")
    told = docs.where("lang IS NOT NULL").select("lang", L.detected(F.col("text"), langs, profiles).alias("told"))
    return told.groupBy("lang").agg(F.count("*").alias("texts"), F.count_if(F.col("told").isNull()).alias("unknown"))


@query()
def page_search(spark, sf):
    """Search by trigrams: each fiftieth page's title, its first two words cut short, asked of the titles of all pages; fifty best each."""
    titles = table(spark, sf, "pages").select(F.col("page_id").alias("id"), P.article(F.col("html"))["title"].alias("title"))
    words = F.slice(F.filter(F.split("title", r"[^\p{L}\p{N}]+"), lambda w: w != ""), 1, 2)
    asked = titles.where("id % 50 = 0").select(F.col("id").alias("q"), F.array_join(words, " ").alias("query"))
    asked = asked.select("q", F.when(F.length("query") > 5, F.expr("substring(query, 1, length(query) - 1)")).otherwise(F.col("query")).alias("query"))
    return S.search(titles, asked, 50)
