"""Zipped tables, wiki tables, feeds of several kinds, saved state and reports on small made inputs."""

import json
import zipfile

from pyspark.sql import functions as F

from tidewire.sources import sinks, static


def zipped(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)


def test_zipped_tables(spark, tmp_path):
    zipped(tmp_path / "a.zip", {"b.csv": "no\tnot\tthis", "a.csv": "1\tx\t\"q\n2\ty\nshort\n3\té\tz\r\n".encode("utf-8") + b"4\t\xff\tw\n"})
    (tmp_path / "bad.zip").write_bytes(b"nothing")
    got = static.zipped_table(spark, str(tmp_path / "*.zip"), {"id": 0, "name": 1}, 3).orderBy("id").collect()
    assert [(r.id, r.name) for r in got] == [("1", "x"), ("3", "é"), ("4", "\ufffd")]
    spark.dataSource.register(static.ZippedLines)
    lines = spark.read.format("zipped_lines").option("paths", str(tmp_path / "a.zip")).load()
    assert lines.count() == 5 and lines.where("at = 1").first().value == "2\ty"


def test_wiki_codes(spark):
    text = ["| {{mono|US}}", "| {{flag|United States}}", "|-", "| {{mono|UK}}", "| {{flagicon|X}} ''[[United Kingdom|UK]]''<ref>a</ref>", "| {{mono|ZZ}}", "no name"]
    lines = spark.createDataFrame([("f", k, v) for k, v in enumerate(text)], "file_path string, at long, value string")
    assert {r.code: r.name for r in static.wiki_codes(lines).collect()} == {"US": "United States", "UK": "United Kingdom"}


def test_entries_of_three_kinds(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<rss><channel><item><title>A</title><link>http://a/1</link><pubDate>p</pubDate></item></channel></rss>')
    (tmp_path / "b.xml").write_text('<RDF><channel><title>c</title></channel><item><title>B</title><link>http://b/1</link><date>d</date></item></RDF>')
    (tmp_path / "c.xml").write_text('<feed><entry><title>C</title><link href="http://c/1"/><updated>u</updated></entry><entry><title>D</title></entry></feed>')
    got = sorted((r.title, r.url, r.published) for r in static.evidence_entries(spark, str(tmp_path / "*.xml")).collect())
    assert got == [("A", "http://a/1", "p"), ("B", "http://b/1", "d"), ("C", "http://c/1", "u")]


def test_json_lines_and_features(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 1, "t": "x"}\nnot json\n{"id": 2}\n')
    good, bad = static.json_lines(spark, str(tmp_path / "a.jsonl"), "id long, t string")
    assert [r.id for r in good.collect()] == [1, 2] and [r._corrupt for r in bad.collect()] == ["not json"]
    f = lambda url, xy: {"properties": {"html": f'<a href="{url}">x</a>', "url": None, "name": "n"}, "geometry": {"coordinates": xy}}
    (tmp_path / "g.json").write_text(json.dumps({"features": [f("http://www.a.com/1", [2.0, 1.0]), f("http://a.com/1/", [2.0, 1.0]), f("http://b.com/1", [500.0, 1.0])]}))
    schema = "features array<struct<properties:struct<html:string,url:string,name:string>,geometry:struct<coordinates:array<double>>>>"
    rows = static.place_features(spark.read.schema(schema).option("multiLine", True).json(str(tmp_path / "g.json")).select(F.explode("features").alias("f"))).collect()
    assert [(r.canonical_url, r.lat, r.lon) for r in rows] == [("https://a.com/1", 1.0, 2.0)]


def test_composed_body(spark):
    row = spark.createDataFrame([("T", ["a", "b"], [], ["o"], [("P", "FR", 1.0, 2.0)], "src", "010", 3)], "title string, themes array<string>, persons array<string>, organizations array<string>, places array<struct<name:string,country:string,lat:double,lon:double>>, source string, code string, n int")
    fields = {c: F.col(c) for c in ("title", "themes", "persons", "organizations", "places", "source")}
    assert row.select(static.composed_body(fields, F.col("code"), F.col("n"))).first()[0] == "T Event 010 3 articles Themes: a, b Organizations: o Location: P (FR) 1.0,2.0 Source: src"


def test_state_and_reports(spark, tmp_path):
    path = str(tmp_path / "state")
    for n in (1, 2):
        sinks.save_state(spark.createDataFrame([("f", n)], "feed string, empties int"), path)
    assert [(r.feed, r.empties) for r in sinks.load_state(spark, path).collect()] == [("f", 2)]
    lines = [r.line for r in sinks.report_lines(spark.createDataFrame([("a", 1), (None, 2)], "k string, n int"), ["k", "n"]).orderBy("place").collect()]
    assert lines == ["| k | n |", "|-|-|", "| a | 1 |", "|  | 2 |"]
    leaf = static.stamped(spark.createDataFrame([(1, "A  b")], "id long, t string"), "id", "t").first()
    assert leaf.payload.startswith('{"content_hash":"') and len(leaf.leaf) == 64
