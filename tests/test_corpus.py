"""Frozen samples, labels and spoilt answers; answers of any shape beside a plain reader."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidewire.functions import answers as A
from tidewire.operators import corpus as C
from tidewire.plans import catalog


def test_strata_take_turns(spark):
    rng = random.Random(1)
    rows = [(k, rng.randrange(40), rng.choice("abc")) for k in range(400)]
    strata = [("a", "kind = 'a'", 5), ("even", "id % 2 = 0", 30), ("none", "false", 4), ("small", "size < 10", 7), ("all", "true", 20)]
    tests = {"a": lambda r: r[2] == "a", "even": lambda r: r[0] % 2 == 0, "none": lambda r: False, "small": lambda r: r[1] < 10, "all": lambda r: True}
    want: dict = {}
    for name, _, most in strata:
        own = sorted((r for r in rows if tests[name](r) and r[0] not in want), key=lambda r: (-r[1], r[0]))[:most]
        want |= {r[0]: name for r in own}
    df = spark.createDataFrame(rows, "id long, size int, kind string").repartition(3)
    got = {r.id: r.stratum for r in C.stratified(df, [(n, F.expr(c), m) for n, c, m in strata], F.col("size"), "id").collect()}
    assert got == want
    assert C.stratified(df.limit(0), [("a", F.lit(True), 3)], F.col("size"), "id").count() == 0


def test_gold_labels(spark, tmp_path):
    label = lambda **x: {"text": "a text that is long enough", "type": " Quote", **x}
    good = {"gold_version": C.GOLD_VERSION, "items": {"a1": {"snippets": [label(), label(text="short"), label(type="guess"), label(confidence=101)]}, "a2": {"snippets": [label(position=1.5, entities=["X"])]}, "a3": {"snippets": []}}}
    (tmp_path / "gold.json").write_text(json.dumps(good, indent=1))
    got = sorted((r.article, r.place, r.fault, r.confidence) for r in C.gold_labels(spark, str(tmp_path / "gold.json")).collect())
    assert [g[:3] for g in got] == [("a1", 0, None), ("a1", 1, "text"), ("a1", 2, "type"), ("a1", 3, "confidence"), ("a2", 0, "position")] and got[0][3] == 80
    (tmp_path / "old.json").write_text(json.dumps(good | {"gold_version": "gold/v0"}))
    with pytest.raises(ValueError, match="gold/v0"):
        C.gold_labels(spark, str(tmp_path / "old.json"))


def test_signatures_are_read_as_they_were_stored(spark):
    rows = catalog.QUERIES["stored_signatures"](spark, "/root/testdata/sf0.001").collect()
    assert rows and all(r.slots == 128 and r.same for r in rows)


def plain_snippets(raw, text):
    """One answer, by the json module."""
    import re

    data = None
    for part in (raw, *re.findall(r"(?s)```(?:json)?\s*(.*?)```", raw or "")[:1], *re.findall(r"(?s)([\[{].*[\]}])", raw or "")[:1]):
        try:
            data = json.loads(part)
            break
        except (TypeError, ValueError):
            continue
    if isinstance(data, dict):
        data = next((data[k] for k in A.WRAPPERS if isinstance(data.get(k), list)), None)
    out = []
    for place, s in enumerate((data if isinstance(data, list) else [])[: A.MOST]):
        if not isinstance(s, dict) or not isinstance(s.get("text"), str) or len(s["text"].strip()) < 20:
            continue
        said = s["text"].strip()
        kind = s.get("type") if isinstance(s.get("type"), str) and s["type"] in A.KINDS else A.OTHER_KIND
        sure = s.get("confidence", 80)
        try:
            sure = min(100, max(0, int(float(sure)))) if not isinstance(sure, (list, dict, type(None))) else 80
        except ValueError:
            sure = 80
        at = text.find(said)
        out.append((place, kind, said if len(said) <= 300 else said[:297] + "...", sure, at if at >= 0 else None))
    return out


def test_answers_of_any_shape(spark):
    rng, rows = random.Random(9), []
    text = "The river rose by two metres overnight, officials said. " * 9
    values = lambda: rng.choice([{"text": text[3:40], "type": "quote", "confidence": rng.choice([7, "91.5", "high", None, -3, 1e12, [1], 55.9])}, {"text": " " + text[10:400] + "\n", "type": rng.choice(["stat", "guess", 3, None])}, {"text": "short"}, {"text": 5}, {"other": 1}, "x", None, 4, [], {"text": "nowhere to be found in it at all", "confidence": {}}])
    for k in range(120):
        items = [values() for _ in range(rng.randrange(0, 8))]
        body = json.dumps(rng.choice([items, {"results": items}, {"data": 3, "items": items}, {"note": items}, 7, "text", None, {"snippets": {"a": 1}, "results": items}]))
        rows.append((k, rng.choice([body, f"Sure!\n```json\n{body}\n```\nbye", f"```{body}```", f"I say {body} so", body[:-2], ""]), text))
    rows.append((999, None, text))
    df = spark.createDataFrame(rows, "id long, raw string, body string").repartition(3)
    got: dict = {}
    for r in A.snippets(df, "raw", "body").orderBy("id", "place").collect():
        got.setdefault(r.id, []).append((r.place, r.kind, r.snippet, r.confidence, r.begins))
    want = {k: s for k, raw, t in rows if (s := plain_snippets(raw, t))}
    assert got == want
