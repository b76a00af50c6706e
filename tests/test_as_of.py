"""Counts up to a time: cursors are never joined with the events of their bucket, and what has no time counts nowhere."""

from tidewire.operators import geometry as G


def test_counts_up_to_cursors(spark):
    times = [None, None, 0, 5, 5, 9, 10, 19, 47, 47]
    at = {1: None, 2: -3, 3: 0, 4: 5, 5: 9, 6: 12, 7: 35, 8: 47, 9: 46, 10: 900, 11: -1}
    events = spark.createDataFrame([(t,) for t in times], "t long")
    df = G.as_of_counts(events, "t", spark.createDataFrame(list(at.items()), "q long, at long"), "q", "at", 10)
    want = {q: sum(t is not None and c is not None and t <= c for t in times) for q, c in at.items()}
    assert {r.q: r.shown for r in df.collect()} == want
    # One join only, with a row for each bucket: none of cursors with events.
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
