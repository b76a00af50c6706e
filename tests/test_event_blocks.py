"""Same-event pairs: blocks are squares of the globe, not whole bands of latitude, and lose no pair over their edges."""

import duckdb

from tidewire.plans import catalog


def test_blocks_of_place(spark, tmp_path):
    con = duckdb.connect()
    con.sql(f"""COPY (SELECT CAST(i AS BIGINT) AS event_id, TIMESTAMP '2024-01-01' + INTERVAL (i * 7919 % 100) HOUR AS ts, CAST(i * 31 % 90 AS BIGINT) AS user_id, ['a', 'b'][i % 2 + 1] AS event_type,
        CAST(i * 613 % 1000 AS DOUBLE) AS value, '{{"k": ' || (i % 40) || '}}' AS props FROM range(3000) t(i)) TO '{tmp_path}/events.parquet' (FORMAT parquet)""")
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    df = catalog.QUERIES["same_event_blocked"](spark, str(tmp_path))
    want = con.sql(catalog.ORACLES["same_event_blocked"]).fetchall()
    assert len(want) > 500 and sorted((r.a, r.b) for r in df.collect()) == sorted(want)
    on = next(x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in x)
    assert "(u#" in on and "(v#" in on
