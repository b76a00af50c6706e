"""Distinct counts and quantiles beyond the sizes at which sketches are exact, against the SQL."""

import duckdb
import pytest

from tidewire.plans import catalog


@pytest.mark.parametrize("name", ["approx_distinct", "sketch_windows"])
def test_counts_of_many(spark, tmp_path, name):
    con = duckdb.connect()
    events = f"{tmp_path}/events.parquet"
    con.sql(f"""COPY (SELECT k AS event_id, TIMESTAMP '2024-01-01' + INTERVAL 1 MINUTE * (k % 17280) AS ts, CASE WHEN k % 11 <> 0 THEN (k * 7919) % 30011 END AS user_id,
        CASE WHEN k % 7 <> 0 THEN 'click' END AS event_type, CASE WHEN k % 13 = 0 THEN NULL WHEN k % 3 = 0 THEN 5.0 ELSE (k * 31) % 99991 / 7.0 END AS value, '' AS props FROM range(150000) t(k)
        UNION ALL SELECT 150000, TIMESTAMP '2024-03-01', NULL, 'bare', NULL, '') TO '{events}'""")
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{events}'")
    df = catalog.QUERIES[name](spark, str(tmp_path))
    rel = con.sql(f"SELECT {', '.join(df.columns)} FROM ({catalog.ORACLES[name]})")
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(rel.fetchall(), key=repr)
