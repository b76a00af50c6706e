"""Column builders over text: all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space as the word splitter sees it, Unicode separators included.
SPACE = r"[\s\p{Z}]+"


def collapsed(text: Column) -> Column:
    """Lower case, runs of white space as one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), SPACE, " "))


def content_hash(text: Column) -> Column:
    return F.sha2(collapsed(text).cast("binary"), 256)


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), SPACE), lambda w: w != "")


def with_shingles(df: DataFrame, text: str, out: str, k: int = 5) -> DataFrame:
    """df with the distinct k-word shingles of a column; a shorter text is one shingle, an empty one the empty shingle.

    The words are a projection of their own: inside the lambda they would be split anew for each shingle.
    """
    with_words = df.withColumn("__w", words(F.col(text)))
    n = F.size("__w")
    many = F.transform(F.sequence(F.lit(1), F.greatest(n - k + 1, F.lit(1))), lambda i: F.array_join(F.slice("__w", i, k), " "))
    return with_words.withColumn(out, F.array_distinct(many)).drop("__w")


def headline_key(title: Column) -> Column:
    """Letters, digits and single spaces in lower case."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(title), r"[^\p{L}\p{N}_\s]", ""), r"\s+", " "))


def paragraphs(text: Column) -> Column:
    """Blank-line blocks, or lines where there is no blank line, collapsed, without empty ones."""
    blocks = F.when(F.size(F.split(text, r"\n\s*\n")) > 1, F.split(text, r"\n\s*\n")).otherwise(F.split(text, r"\n"))
    return F.filter(F.transform(blocks, lambda p: F.trim(F.regexp_replace(p, r"\s+", " "))), lambda p: p != "")


def magnitude_band(m: Column) -> Column:
    return F.when(m >= 7, "major").when(m >= 6, "strong").when(m >= 5, "moderate").when(m >= 4, "light").when(m >= 3, "minor").otherwise("micro")


def label_key(raw: Column) -> Column:
    """snake_case of at most 32 characters, ``neutral`` when nothing is left."""
    s = F.regexp_replace(F.regexp_replace(F.lower(F.trim(raw)), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")
    return F.coalesce(F.nullif(F.substring(s, 1, 32), F.lit("")), F.lit("neutral"))


def chunks(text: Column, size: int = 480) -> Column:
    """Pieces of a fixed number of characters; none of an empty text."""
    return F.filter(F.transform(F.sequence(F.lit(0), F.floor((F.greatest(F.length(text), F.lit(1)) - 1) / size).cast("int")), lambda i: text.substr(i * size + 1, F.lit(size))), lambda c: c != "")


def visible_text(html: Column) -> Column:
    """Tags, scripts, styles and comments out, entities kept, white space collapsed."""
    bare = F.regexp_replace(html, r"(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"<[^>]+>", " "), r"\s+", " "))
