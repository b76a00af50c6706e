"""Table functions: a few rows at a time in Python, whatever the length of a batch."""

import pytest
from pyspark.util import PythonEvalType

from tidewire.functions import tables as TF


@pytest.mark.parametrize("kind", [TF.Paragraphs, TF.Shingles])
def test_no_batches_of_texts(kind):
    assert kind.evalType == PythonEvalType.SQL_TABLE_UDF


def test_paragraphs_and_shingles(spark):
    TF.register(spark)
    rows = spark.createDataFrame([(1, "a  b\n\n c\n\n\n"), (2, "x\ny"), (3, ""), (4, None), (5, " \n ")], "id long, body string")
    got = spark.sql("SELECT id, p.place, p.paragraph FROM {r}, LATERAL paragraphs(body) AS p ORDER BY id, place", r=rows).collect()
    assert got == [(1, 0, "a b"), (1, 1, "c"), (2, 0, "x"), (2, 1, "y")]
    got = spark.sql("SELECT id, p.place, p.shingle FROM {r}, LATERAL shingles(body, 2) AS p ORDER BY id, place", r=rows).collect()
    assert got == [(1, 0, "a b"), (1, 1, "b c"), (2, 0, "x y")]
