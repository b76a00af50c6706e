"""Registration of queries beside their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Articles, as the documents table gives them; every SQL text that names ``a`` starts with this.
ARTICLES = """a AS (
    SELECT doc_id AS id, coalesce(text, '') AS body, source AS domain, lang, substring(coalesce(text, ''), 1, 80) AS title,
           epoch(TIMESTAMP '2024-01-01 00:00:00') + (doc_id % 72) * 3600 AS fetched,
           CAST(1 + CAST(substring(source, 4) AS INTEGER) % 4 AS INTEGER) AS tier, 'owner' || CAST(CAST(substring(source, 4) AS INTEGER) % 7 AS VARCHAR) AS owner
    FROM documents)"""


def query(sql: str | None = None, articles: bool = False):
    """Register a function of (spark, sf_dir); with articles its SQL starts from the CTE ``a``."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            text = sql.strip()
            if articles:
                text = f"WITH RECURSIVE {ARTICLES}, {text[5:]}" if text.upper().startswith("WITH ") else f"WITH {ARTICLES} {text}"
            ORACLES[f.__name__] = text
        return f

    return add
