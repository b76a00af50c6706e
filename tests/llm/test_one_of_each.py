"""One row stays for each group of near copies, also of rows without an id or with a repeated one."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
import edge

from tidewire.llm import simhash


def test_rows_without_an_id_stay(spark):
    a, b, c = ("one text about ships and the sea at night", "another text on bread, flour and salt in towns", "third words of hills and rain over fields")
    rows = [(None, a), (None, b), (None, b), (5, c), (5, a + " again and again with more"), (6, c)]
    got = [(r.doc_id, r.text) for r in simhash.one_of_each(edge.frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([(None, a), (None, b), (5, c), (5, rows[4][1])], key=str)
