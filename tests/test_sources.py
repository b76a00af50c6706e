"""Feeds, sinks, entities and stories on small made inputs."""

import json

import pytest
from pyspark.sql import functions as F

from tidewire.operators import entities, stories
from tidewire.sources import feeds, sinks


def event_row(**cells):
    row = [""] * feeds.EVENT_COLUMNS
    for k, v in cells.items():
        row[feeds.EVENT[k]] = v
    return "\t".join(row)


def graph_row(**cells):
    row = [""] * feeds.GRAPH_COLUMNS
    for k, v in cells.items():
        row[feeds.GRAPH[k]] = v
    return "\t".join(row)


def test_event_and_graph_tables(spark, tmp_path):
    (tmp_path / "e.tsv").write_text("\n".join([
        event_row(source_url="http://a.com/1", action_geo_name="Paris", action_geo_lat="48.8", action_geo_long="2.3", event_root_code="01"),
        event_row(source_url="http://a.com/1", action_geo_name="Nowhere", action_geo_lat="99", action_geo_long="2", actor1_geo_name="Lyon", actor1_geo_lat="45.7", actor1_geo_long="4.8", event_root_code="02"),
        "too\tshort",
    ]))
    (tmp_path / "g.tsv").write_text("\n".join([
        graph_row(url="http://a.com/1", title="<PAGE_TITLE>A  title</PAGE_TITLE>", persons="x;y;;z", tone="1.5,2"), graph_row(url="http://www.a.com/1/", title="copy"),
        graph_row(url="http://b.com/2", locations="1#Rome#IT##41.9#12.5#x;1#Bad#IT##x#y#z"), graph_row(url="http://c.com/3"),
    ]))
    index = feeds.event_index(feeds.tab_table(spark, str(tmp_path / "e.tsv"), feeds.EVENT, feeds.EVENT_COLUMNS))
    assert [(r.geo.name, r.event_root_code) for r in index.collect()] == [("Lyon", "02")]
    graph = feeds.tab_table(spark, str(tmp_path / "g.tsv"), feeds.GRAPH, feeds.GRAPH_COLUMNS)
    got = {r.url: r for r in feeds.graph_articles(graph, index).collect()}
    assert set(got) == {"http://a.com/1", "http://b.com/2"}
    assert got["http://a.com/1"].geo.name == "Lyon" and got["http://a.com/1"].persons == ["x", "y", "z"] and got["http://a.com/1"].title == "A title"
    assert got["http://b.com/2"].geo.name == "Rome"
    known = feeds.graph_articles(graph, index).where("domain = 'b.com'")
    assert feeds.graph_articles(graph, index, known).count() == 1


def test_quakes_and_alerts(spark, tmp_path):
    quake = lambda url, xy, mag: {"type": "Feature", "properties": {"url": url, "mag": mag, "place": "p", "time": 1_700_000_000_000}, "geometry": {"type": "Point", "coordinates": xy}}
    (tmp_path / "q.json").write_text(json.dumps({"features": [quake("http://q/1", [10.0, 20.0, 5.0], 6.1), quake("http://q/1/", [10.0, 20.0, 5.0], 6.1), quake("http://q/2", [500.0, 2.0, 1.0], 4.0), quake("", [1.0, 2.0, 1.0], 4.0)]}))
    rows = feeds.quakes(spark.read.option("multiLine", True).json(str(tmp_path / "q.json")).select(F.explode("features").alias("f"))).collect()
    assert [(r.lat, r.lon, r.band) for r in rows] == [(20.0, 10.0, "strong")]
    items = spark.createDataFrame([("t", "http://g/1", "Thu, 01 Jan 2026 00:00:00 GMT", "fl", "Red", "X", "1.5 2.5"), ("t", "http://g/2", None, "zz", None, None, "bad")], "title string, link string, pubDate string, eventtype string, alertlevel string, country string, point string")
    got = feeds.alerts(items).collect()
    assert [(r.kind, r.level, r.lat, r.lon) for r in got] == [("Flood", "Red", 1.5, 2.5)] and got[0].published.year == 2026
    (tmp_path / "alerts.xml").write_text(
        "<rss><channel><item><title></title><guid>TC7</guid><link>http://g/3</link><eventtype>tc</eventtype><Point><lat> 4.5</lat><long>-7</long></Point><point>1 2</point></item>"
        "<item><title>named</title><link>http://g/4</link><eventtype>QQ</eventtype><point>10 20</point></item><item><title>far</title><link>http://g/5</link><point>100 20</point></item><item><title>none</title><point>1 2</point></item></channel></rss>"
    )
    schema = "title string, guid string, link string, eventtype string, Point struct<lat:string,long:string>, point string"
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        got = feeds.alerts(spark.read.schema(schema).option("rowTag", "item").xml(str(tmp_path / "alerts.xml"))).collect()
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")
    assert sorted((r.title, r.kind, r.lat, r.lon) for r in got) == [("Tropical Cyclone TC7", "Tropical Cyclone", 4.5, -7.0), ("named", "QQ", 10.0, 20.0)]


def test_feed(spark, tmp_path):
    body = "word " * 60
    (tmp_path / "f.xml").write_text(f"<rss><channel><item><title>A</title><link>http://x.com/a?utm_source=1</link><description>&lt;p&gt;{body}&lt;/p&gt;</description><pubDate>Thu, 01 Jan 2026 00:00:00 GMT</pubDate></item><item><title>B</title><link>http://www.x.com/a</link><description>{body}</description></item><item><title>C</title><link>http://x.com/c</link><description>short</description></item></channel></rss>")
    got = feeds.feed_articles(feeds.feed_items(spark, str(tmp_path / "f.xml")).withColumn("feed", F.lit("f")), "feed").collect()
    assert [r.canonical_url for r in got] == ["https://x.com/a"]


def test_manifest(spark):
    lines = spark.createDataFrame([("1 a http://h/20260101000000.export.zip",), ("2 b http://h/20260102000000.gkg.zip",)], "value string")
    assert [r.stamp for r in feeds.manifest_stamps(lines).collect()] == ["20260102000000", "20260101000000"]


def test_sinks(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "i int, s string")
    good, bad = sinks.split_rejects(df, {"no id": F.col("i").isNotNull(), "no text": F.col("s").isNotNull()})
    assert good.count() == 1 and {r.reason for r in bad.collect()} == {"no id", "no text"}
    asked = spark.createDataFrame([("k", 1, 6.0), ("k", 2, 6.0), ("k", 3, 4.0), ("k", 4, 1.0)], "key string, at int, amount double")
    caps = spark.createDataFrame([("k", 10.0)], "key string, cap double")
    assert [r.admitted for r in sinks.capped_spend(asked, caps, "key", ["at"], "amount", "cap").orderBy("at").collect()] == [True, False, True, False]
    assert sinks.upsert_sum(caps, caps, ["key"], "cap").first().cap == 20.0


@pytest.mark.parametrize(("surface", "kind", "want"), [("Dr. Mr José  Álvarez's", "PERSON", "PERSON:jose alvarez"), ("The United Nations", "ORG", "ORG:united nations"), ("the Hague", "GPE", "GPE:hague")])
def test_entity_normal_form(spark, surface, kind, want):
    assert spark.createDataFrame([(surface, kind)], "s string, k string").select(entities.normal(F.col("s"), F.col("k"))).first()[0] == want


def test_resolution(spark):
    known = spark.createDataFrame([("e1", "PERSON", "Ann Lee"), ("e2", "PERSON", "Bob Ray"), ("e3", "PERSON", "Tim Ray")], "entity_id string, kind string, name string")
    aliases = spark.createDataFrame([("PERSON:ann lee", "e1")], "alias string, entity_id string")
    mentions = spark.createDataFrame([("Ann Lee", "PERSON"), ("Lee", "PERSON"), ("Ray", "PERSON")], "surface string, kind string")
    got = {r.surface: (r.entity_id, r.confidence) for r in entities.resolve(mentions, aliases, entities.surname_index(known)).collect()}
    assert got["Ann Lee"] == ("e1", 1.0) and got["Lee"] == ("e1", 0.8) and got["Ray"][0] not in ("e2", "e3")


def test_stories_match_the_plain_fold(spark):
    import random

    rng = random.Random(1)
    units = [(k, rng.randrange(3), [f"e{rng.randrange(40)}" for _ in range(rng.randrange(5))]) for k in range(120)]
    got = {r.unit_id: r.story_id for r in stories.build_stories(spark.createDataFrame(units, "unit_id long, day long, entities array<string>")).collect()}
    order = sorted((d, u, frozenset(e)) for u, d, e in units)
    assert got == dict(zip([u for _, u, _ in order], stories.attach(order), strict=True))


def test_viewpoints(spark):
    rows = [(1, 1, "a"), (1, 2, "a"), (1, 3, "b"), (2, 4, "a"), (2, 5, "b"), (3, 6, "a"), (3, 7, "a"), (3, 8, "a")]
    got = stories.viewpoints(spark.createDataFrame(rows, "story_id int, unit_id int, label string")).collect()
    assert {(r.story_id, r.label, r.units) for r in got} == {(1, "a", 2), (1, "b", 1)}
