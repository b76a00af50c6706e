"""Links of stories: tasks stay as large as they are when tables grow, and the results are those of plain sets."""

import pytest

from tidewire.plans import catalog
from tidewire.sources import tables

LINES = [(s, u, ((s or 0) * 5 + u * 3) % 11) for s in [*range(-7, 24), None] for u in [*((s or 2) * j % 5 for j in range(4)), 9]] + [(5, None, 2), (8, None, 4), (9, 1, None), (9, 1, None)]


@pytest.fixture
def folder(spark, tmp_path):
    spark.createDataFrame(LINES, "l_orderkey long, l_partkey long, l_suppkey long").selectExpr("*", "CAST('' AS STRING) AS l_returnflag", "1.0D AS l_quantity").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(u, 1, "b") for u in range(10)], "p_partkey long, p_size int, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    return str(tmp_path)


def deals(df):
    return df._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM")


def test_viewpoint_own_units(spark, folder, monkeypatch):
    monkeypatch.setattr(tables, "PART", 16)
    df = catalog.QUERIES["viewpoint_own_units"](spark, folder)
    pairs = {(s, u) for s, u, _ in LINES}
    parent = lambda s: int(s / 4) * 4
    want = {}
    for s, u in pairs:
        if s is None or u is None or parent(s) == s or (parent(s), u) not in pairs:
            want[s] = want.get(s, 0) + 1
    assert {r.story: r.own_units for r in df.collect()} == want
    assert deals(df)


def test_tier1_beside_source(spark, folder, monkeypatch):
    monkeypatch.setattr(tables, "PART", 16)
    df = catalog.QUERIES["tier1_beside_source"](spark, folder)
    lines = [(s, u, x) for s, u, x in LINES if u is not None]
    units, stories = {}, {}
    for s, _, x in lines:
        for s1, u1, x1 in lines:
            if s is not None and s == s1 and x1 is not None and x1 % 4 == 0:
                units.setdefault(x, set()).add(u1)
                stories.setdefault(x, set()).add(s)
    assert {r.source: (r.tier1_units, r.stories) for r in df.collect()} == {x: (len(units[x]), len(stories[x])) for x in units}
    assert deals(df)
