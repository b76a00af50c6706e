"""Table functions that SQL can call: ``SELECT ... FROM docs, LATERAL paragraphs(text)``.

Rows go to Python by hundreds, not in Arrow batches, which hold up to ten thousand texts and all that they become.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

_BLANK, _SPACE = re.compile(r"\n\s*\n"), re.compile(r"\s+")


@udtf(returnType="place int, paragraph string", useArrow=False)
class Paragraphs:
    """Blank-line blocks of a text, or its lines where no line is blank, collapsed, without empty ones; none for null."""

    def eval(self, text: str):
        parts = _BLANK.split(text or "")
        place = 0
        for part in parts if len(parts) > 1 else (text or "").split("\n"):
            part = _SPACE.sub(" ", part).strip()
            if part:
                yield place, part
                place += 1


@udtf(returnType="place int, shingle string", useArrow=False)
class Shingles:
    """Runs of size words of a text in lower case, a row each, in order; a shorter text is one run; none for null or blank."""

    def eval(self, text: str, size: int):
        words = (text or "").lower().split()
        for k in range(max(1, len(words) - size + 1) if words else 0):
            yield k, " ".join(words[k : k + size])


def register(spark: SparkSession) -> None:
    spark.udtf.register("paragraphs", Paragraphs)
    spark.udtf.register("shingles", Shingles)
