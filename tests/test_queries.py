"""Every query beside its DuckDB SQL on the smallest tables, and the operators' edges."""

import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from tidewire.functions import text as T
from tidewire.functions import url as U
from tidewire.operators import merkle
from tidewire.operators.graph import connected_components
from tidewire.operators.units import reporting_units
from tidewire.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    got = sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)
    if name in catalog.ORACLES:
        rel = duck.sql(catalog.ORACLES[name])
        assert sorted(rel.columns) == sorted(df.columns)
        order = [rel.columns.index(c) for c in sorted(rel.columns)]
        assert got == sorted((tuple(r[i] for i in order) for r in rel.fetchall()), key=repr)


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("http://www.Example.com:80/a/./b/../c/?utm_source=x&B=2&a=1#f", "https://example.com/a/c?a=1&b=2"), ("//m.example.org", "https://example.org/"), ("https://amp.co.uk/x", "https://amp.co.uk/x"),
        ("https://example.com/story/amp/", "https://example.com/story"), ("https://example.com/?amp=1&id=3", "https://example.com/?id=3"), ("mailto:a@b", "mailto:a@b"), (" https://u:p@example.com:8080/x ", "https://example.com:8080/x"),
        ("https://www.m.example", "https://m.example/"), ("https://www.amp.co.uk", "https://amp.co.uk/"), ("https://m.in.gr/x", "https://in.gr/x"), ("https://example.amp.com/a", "https://example.com/a"), ("https://example.com./a", "https://example.com/a"),
        ("https://[2001:DB8::1]:8443/a", "https://[2001:db8::1]:8443/a"), ("https://bücher.example/x", "https://xn--bcher-kva.example/x"), ("https://example.com:99999/a", "https://example.com:99999/a"), ("http:///a", "http:///a"),
        ("https://example.com/%7euser/%2fa%c3%a9", "https://example.com/~user/%2Fa%C3%A9"), ("https://example.com/a//../b", "https://example.com/a/b"), ("https://example.com/amp/news/s", "https://example.com/news/s"), ("https://example.com/a/amp/b", "https://example.com/a/amp/b"),
        ("https://example.com/a?b=x+y&c=%7E*&empty", "https://example.com/a?b=x+y&c=~%2A&empty="), ("https://example.com/?fb_ref=1&trk=2&_hsci=3&ito=4", "https://example.com/?ito=4"), ("https://example.com/?output=html", "https://example.com/?output=html"),
        ("https://www.google.com/url?q=https%3A%2F%2Fwww.example.com%2Fa%3Futm_x%3D1", "https://example.com/a"), ("https://www-example-com.cdn.ampproject.org/c/s/www.example.com/a/amp", "https://example.com/a"), ("https://google.com/search?q=https://example.com", "https://google.com/search?q=https%3A%2F%2Fexample.com"),
        ("https://feedproxy.google.com/~r/x?url=http://example.com/1", "https://feedproxy.google.com/~r/x?url=http%3A%2F%2Fexample.com%2F1"), ("http://feeds.feedburner.com/x?target=http://m.example.com/1", "https://example.com/1"), ("javascript:alert(1)", "javascript:alert(1)"), ("", ""),
        ("https://example.com/a?x=%zz", "https://example.com/a?x=%25zz"), ("https://example.com/" + "a/" * 20000, "https://example.com/" + ("a/" * 20000)[:-1]),
    ],
)
def test_url(spark, url, want):
    assert spark.createDataFrame([(url,)], "u string").select(U.canonical(F.col("u"))).first()[0] == want


def test_shingles(spark):
    rows = [(0, ""), (1, "one two"), (2, "A b c d e f"), (3, "a a a a a a a")]
    got = {r.i: r.s for r in T.with_shingles(spark.createDataFrame(rows, "i int, t string"), "t", "s").collect()}
    assert got == {0: [""], 1: ["one two"], 2: ["a b c d e", "b c d e f"], 3: ["a a a a a"]}


def test_units_join_copies_of_a_day(spark):
    body = " ".join(f"w{k}" for k in range(60))
    rows = [(1, 0, body), (2, 0, body + " x"), (3, 1, body), (4, 0, "other words are here now"), (5, 0, ""), (6, 0, "")]
    got = {r.id: r.unit_id for r in reporting_units(spark.createDataFrame(rows, "id long, day long, body string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 5}


def test_components(spark):
    chain = [(k, k + 1) for k in range(60)] + [(100, 101), (103, 102), (102, 101), (7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(chain, "src long, dst long")).collect()}
    assert got == {k: 0 for k in range(61)} | {k: 100 for k in range(100, 104)}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8])
def test_merkle(spark, n):
    import hashlib

    h = [hashlib.sha256(b"\0" + str(k).encode()).hexdigest() for k in range(n)]
    leaves = spark.createDataFrame(list(enumerate(h)), "i long, h string")
    level = h
    while len(level) > 1:
        level = [hashlib.sha256(b"\1" + bytes.fromhex(level[k]) + bytes.fromhex(level[k + 1])).hexdigest() if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)]
    assert merkle.root(leaves).first().root == level[0]
    if n > 1:
        assert all(r.valid for r in merkle.verify(leaves, merkle.inclusion_proofs(leaves), merkle.root(leaves)).collect())


def test_minhash_is_near(spark):
    rows = catalog.QUERIES["minhash_estimate"](spark, SF).collect()
    assert all(math.fabs(r.exact - r.estimate) < 0.25 for r in rows)
