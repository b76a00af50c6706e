"""Joins, audits and scores over stories, units and evidence.

The driver's tables stand for the data model: an order is a story (created at its date, of a status), a line links it to a unit
(its part), a part's size is its article count, a supplier is a source with its tier and owner, a return flag is a stance.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewire.operators import similarity as S
from tidewire.operators.events import haversine_km
from tidewire.plans.registry import query
from tidewire.sources.tables import articles, map_events, spread, table

_LK = """lk AS (SELECT l_orderkey AS story, l_partkey AS unit, l_suppkey AS source, 1 + l_suppkey % 4 AS tier, 'owner' || (l_suppkey % 7) AS owner, l_returnflag AS flag, CAST(l_quantity AS INTEGER) AS quantity, p_size AS articles, p_brand AS brand
    FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def links(spark, sf):
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_size").alias("articles"), F.col("p_brand").alias("brand"))
    n = F.col("l_suppkey")
    return table(spark, sf, "lineitem").join(part, "l_partkey").select(
        F.col("l_orderkey").alias("story"), F.col("l_partkey").alias("unit"), n.alias("source"), (1 + n % 4).alias("tier"), F.concat(F.lit("owner"), (n % 7).cast("string")).alias("owner"),
        F.col("l_returnflag").alias("flag"), F.col("l_quantity").cast("int").alias("quantity"), "articles", "brand")


@query(f"WITH {_LK}, k AS (SELECT story, tier, sum(articles) AS n FROM lk GROUP BY ALL) SELECT story, coalesce(sum(n) FILTER (WHERE tier = 1), 0)::BIGINT AS tier1, coalesce(sum(n) FILTER (WHERE tier = 2), 0)::BIGINT AS tier2, coalesce(sum(n) FILTER (WHERE tier = 3), 0)::BIGINT AS tier3, coalesce(sum(n) FILTER (WHERE tier = 4), 0)::BIGINT AS tier4 FROM k GROUP BY story")
def tier_histograms(spark, sf):
    """Stored tier maps of the units, exploded and added up for each story: article counts, whatever their name says."""
    unit = links(spark, sf).select("story", F.create_map(F.concat(F.lit("tier"), F.col("tier").cast("string")), F.col("articles")).alias("source_tiers"))
    n = unit.select("story", F.explode("source_tiers")).groupBy("story").pivot("key", ["tier1", "tier2", "tier3", "tier4"]).agg(F.sum("value"))
    return n.na.fill(0)


@query(f"""WITH {_LK}, u AS (SELECT story, unit, list_distinct(list(owner) FILTER (WHERE tier = 1)) AS seen, 'owner' || (unit % 5) AS stored FROM lk GROUP BY story, unit), o AS (SELECT story, unnest(CASE WHEN seen IS NOT NULL AND len(seen) > 0 THEN seen ELSE [stored] END) AS owner FROM u)
    SELECT story, count(DISTINCT owner) AS owners, count(*) AS attributions FROM o GROUP BY story""")
def tier1_owners_with_fallback(spark, sf):
    """A unit's tier-1 owners; one that resolves to none counts by the owner stored for it."""
    u = links(spark, sf).groupBy("story", "unit").agg(F.collect_set(F.when(F.col("tier") == 1, F.col("owner"))).alias("seen"))
    stored = F.array(F.concat(F.lit("owner"), (F.col("unit") % 5).cast("string")))
    o = u.select("story", F.explode(F.when(F.size("seen") > 0, F.col("seen")).otherwise(stored)).alias("owner"))
    return o.groupBy("story").agg(F.countDistinct("owner").alias("owners"), F.count("*").alias("attributions"))


@query(f"""WITH {_LK}, w AS (SELECT story, 'wire' || (source % 3) AS wire, count(*) AS n FROM lk WHERE source % 3 < 2 AND tier > 1 GROUP BY ALL)
    SELECT story, string_agg(n || ' wire ' || CASE WHEN n = 1 THEN 'copy' ELSE 'copies' END || ' collapsed to ' || wire, '; ' ORDER BY n DESC, wire) AS note FROM w GROUP BY story""")
def collapse_notes(spark, sf):
    """Wire copies for each story and service, most first, as one sentence."""
    w = links(spark, sf).where("source % 3 < 2 AND tier > 1").groupBy("story", F.concat(F.lit("wire"), (F.col("source") % 3).cast("string")).alias("wire")).agg(F.count("*").alias("n"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "wire", "n"))), lambda x: F.concat(x["n"].cast("string"), F.when(x["n"] == 1, " wire copy collapsed to ").otherwise(" wire copies collapsed to "), x["wire"]))
    return w.groupBy("story").agg(F.array_join(parts, "; ").alias("note"))


@query("""WITH l AS (SELECT l_orderkey AS story, l_partkey AS unit, l_linenumber AS line FROM lineitem), live AS (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F'), kept AS (SELECT p_partkey FROM part WHERE p_size > 2)
    SELECT 'units without link' AS bucket, count(*) AS n FROM part WHERE p_partkey NOT IN (SELECT unit FROM l) UNION ALL SELECT 'stories without link', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT story FROM l)
    UNION ALL SELECT 'links without story', count(*) FROM l WHERE story NOT IN (SELECT * FROM live) UNION ALL SELECT 'links without unit', count(*) FROM l WHERE unit NOT IN (SELECT * FROM kept)
    UNION ALL SELECT 'sources without evidence', count(*) FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_quantity > 49) """)
def orphan_buckets(spark, sf):
    t = lambda n: table(spark, sf, n)
    line = t("lineitem")
    live, kept = t("orders").where("o_orderstatus <> 'F'"), t("part").where("p_size > 2")
    buckets = {
        "units without link": t("part").join(line, F.col("p_partkey") == F.col("l_partkey"), "left_anti"), "stories without link": t("orders").join(line, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti"),
        "links without story": line.join(live, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti"), "links without unit": line.join(kept, F.col("p_partkey") == F.col("l_partkey"), "left_anti"),
        "sources without evidence": t("supplier").join(line.where("l_quantity > 49"), F.col("s_suppkey") == F.col("l_suppkey"), "left_anti"),
    }
    out = None
    for name, rows in buckets.items():
        n = rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("bucket"), "n")
        out = n if out is None else out.unionByName(n)
    return out


@query("SELECT DISTINCT l_orderkey AS story, l_partkey AS unit FROM lineitem LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F') ON o_orderkey = l_orderkey LEFT JOIN (SELECT p_partkey FROM part WHERE p_size > 2) ON p_partkey = l_partkey WHERE o_orderkey IS NULL OR p_partkey IS NULL")
def stale_links(spark, sf):
    """Links whose story or unit is gone: two outer joins, one pass over the links."""
    live, kept = table(spark, sf, "orders").where("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("story")), table(spark, sf, "part").where("p_size > 2").select(F.col("p_partkey").alias("unit"))
    line = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("story"), F.col("l_partkey").alias("unit"))
    return line.join(live.withColumn("s", F.lit(1)), "story", "left").join(kept.withColumn("u", F.lit(1)), "unit", "left").where("s IS NULL OR u IS NULL").select("story", "unit").distinct()


@query("SELECT p_partkey AS unit FROM part WHERE p_size >= 25 AND p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def old_orphan_units(spark, sf):
    """Units of a day and more ago (here by size) that no story holds."""
    return table(spark, sf, "part").where("p_size >= 25").join(table(spark, sf, "lineitem").where("l_quantity > 45"), F.col("p_partkey") == F.col("l_partkey"), "left_anti").select(F.col("p_partkey").alias("unit"))


@query("""SELECT r_name AS topic, s_suppkey AS source, count(*) AS evidence, count(DISTINCT o_orderkey) AS claims, count(*) FILTER (WHERE l_returnflag = 'A') AS disputes FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    JOIN region ON r_regionkey = n_regionkey JOIN supplier ON s_suppkey = l_suppkey WHERE o_orderdate >= TIMESTAMP '1995-01-01' GROUP BY ALL""")
def evidence_star(spark, sf):
    """Evidence to claim, story, topic and source: small dimensions are left to Spark's size check."""
    t = lambda n: table(spark, sf, n)
    o = t("orders").where(F.col("o_orderdate").cast("timestamp") >= F.lit("1995-01-01 00:00:00").cast("timestamp")).select("o_orderkey", "o_custkey")
    topic = t("customer").join(t("nation"), F.col("n_nationkey") == F.col("c_nationkey")).join(t("region"), F.col("r_regionkey") == F.col("n_regionkey")).select(F.col("c_custkey").alias("o_custkey"), F.col("r_name").alias("topic"))
    j = t("lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(topic, "o_custkey").join(t("supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
    return j.groupBy("topic", F.col("s_suppkey").alias("source")).agg(F.count("*").alias("evidence"), F.countDistinct("o_orderkey").alias("claims"), F.count_if(F.col("l_returnflag") == "A").alias("disputes"))


@query(f"WITH {_LK}, m AS (SELECT DISTINCT story, source FROM lk), t AS (SELECT DISTINCT story, unit FROM lk WHERE tier = 1) SELECT m.source, count(DISTINCT t.unit) AS tier1_units, count(DISTINCT m.story) AS stories FROM m JOIN t USING (story) GROUP BY m.source")
def tier1_beside_source(spark, sf):
    """For each source, the tier-1 units of the stories that it covers."""
    lk, rows = links(spark, sf), table(spark, sf, "lineitem").count()
    m = spread(lk.select("story", "source"), rows, "story").distinct()
    t = spread(lk.where("tier = 1").select("story", "unit"), rows, "story").distinct()
    # A story counts by the first of its units, so that one table of sources and units tells both numbers.
    t = t.withColumn("first", F.col("unit").eqNullSafe(F.min("unit").over(Window.partitionBy("story"))))
    met = spread(m.join(t, "story").select("source", "unit", "first"), rows, "source", "unit").groupBy("source", "unit").agg(F.count_if("first").alias("stories"))
    return met.groupBy("source").agg(F.count("unit").alias("tier1_units"), F.sum("stories").alias("stories"))


@query("SELECT DISTINCT l_partkey AS unit, l_suppkey AS article FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size = 1) OR l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 9000)")
def unit_or_representative(spark, sf):
    """Articles of a set of units, or representatives: two semi-joins and a distinct, as OR in a join would be a nested loop."""
    line = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("unit"), F.col("l_suppkey").alias("article"))
    a = line.join(table(spark, sf, "part").where("p_size = 1").select(F.col("p_partkey").alias("unit")), "unit", "left_semi")
    b = line.join(table(spark, sf, "supplier").where("s_acctbal > 9000").select(F.col("s_suppkey").alias("article")), "article", "left_semi")
    return a.unionByName(b).distinct()


@query(f"WITH {_LK}, e AS (SELECT story, list_distinct(list(brand)) AS entities FROM lk GROUP BY story), w AS (SELECT * FROM e WHERE story NOT IN (SELECT story FROM lk WHERE flag = 'R')) SELECT p_brand AS entity, count(*) AS stories FROM (SELECT DISTINCT p_brand FROM part) JOIN w ON list_contains(w.entities, p_brand) GROUP BY p_brand")
def stories_without_event(spark, sf):
    """Stories that no event names, by the entities in their lists: the containment test is an equi-join on the exploded list."""
    lk = links(spark, sf)
    e = lk.groupBy("story").agg(F.collect_set("brand").alias("entities")).join(lk.where("flag = 'R'").select("story"), "story", "left_anti")
    entity = table(spark, sf, "part").select(F.col("p_brand").alias("entity")).distinct()
    return e.select("story", F.explode("entities").alias("entity")).join(entity, "entity").groupBy("entity").agg(F.count("*").alias("stories"))


#: Edge of a block of events.
CELL_KM = 200
_GEO = """g AS (SELECT event_id AS id, event_type, epoch_us(ts) AS t, (user_id * 37) % 180 - 90 + value / 1000 AS lat, CAST((user_id * 53) % 360 - 180 AS DOUBLE) AS lon, coalesce(CAST(json_extract_string(props, '$.k') AS INTEGER), 0) AS k, user_id % 6 AS e1, user_id % 10 + 6 AS e2 FROM events),
    r AS (SELECT *, CASE WHEN k > 0 AND k <= 25 THEN k ELSE 25 END AS radius FROM g)"""


def _located(spark, sf):
    e = map_events(spark, sf)
    k = F.col("source_count")
    return e.select("id", "event_type", F.col("start").alias("t"), "lat", "lon", F.when((k > 0) & (k <= 25), k).otherwise(25).alias("radius"), F.array(F.col("story_id") % 6, F.col("story_id") % 10 + 6).alias("keys"))


@query(f"""WITH {_GEO} SELECT a.id AS a, b.id AS b FROM r a JOIN r b ON a.event_type = b.event_type AND a.id < b.id AND abs(a.t - b.t) < 86400000000 AND abs(floor(a.lat) - floor(b.lat)) <= 1 AND (a.e1 = b.e1 OR a.e2 = b.e2)
    WHERE 2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)))) <= a.radius + b.radius""")
def same_event_blocked(spark, sf):
    """Same-event pairs: one type, windows that overlap, distance within both radii, a shared key; blocks of type, day and place.

    A place is a square of CELL_KM of two coordinates of the point on the globe, which differ by no more than the distance does: there is
    no seam at a meridian or pole. An event is sought in its own block by all whose reach (25 km, the largest radius, beyond
    their own) touches it, on its day and the one before.
    """
    axis = lambda x: x * 6371.0088
    z, x = axis(F.sin(F.radians("lat"))), axis(F.cos(F.radians("lat")) * F.cos(F.radians("lon")))
    e = _located(spark, sf).withColumns({"day": F.floor(F.col("t") / 86_400_000_000), "z": z, "x": x})
    cell = lambda v: F.floor(v / CELL_KM)
    left = e.select("event_type", "day", cell(F.col("z")).alias("u"), cell(F.col("x")).alias("v"), *[F.col(c).alias(f"l_{c}") for c in ("id", "t", "lat", "lon", "radius", "keys")])
    reach = F.col("radius") + 25.1
    each = lambda v: F.explode(F.sequence(cell(F.col(v) - reach), cell(F.col(v) + reach)))
    right = e.withColumn("u", each("z")).withColumn("v", each("x")).withColumn("own", F.explode(F.array(F.lit(True), F.lit(False))))
    right = right.select("event_type", F.when(F.col("own"), F.col("day")).otherwise(F.col("day") - 1).alias("day"), "u", "v", "own", *[F.col(c).alias(f"r_{c}") for c in ("id", "t", "lat", "lon", "radius", "keys")])
    pairs = left.join(right, ["event_type", "day", "u", "v"]).where("(NOT own OR l_id < r_id) AND abs(l_t - r_t) < 86400000000 AND abs(floor(l_lat) - floor(r_lat)) <= 1").where(F.arrays_overlap("l_keys", "r_keys"))
    met = pairs.where(haversine_km(F.col("l_lat"), F.col("l_lon"), F.col("r_lat"), F.col("r_lon")) <= F.col("l_radius") + F.col("r_radius"))
    return met.select(F.least("l_id", "r_id").alias("a"), F.greatest("l_id", "r_id").alias("b"))


@query(f"WITH {_GEO} SELECT event_type, CAST(floor(t / 86400000000) AS BIGINT) + d AS day, CAST(floor(lat) AS BIGINT) + b AS band, count(*) AS n FROM r, (SELECT unnest([-1, 0, 1]) AS d), (SELECT unnest([-1, 0, 1]) AS b) GROUP BY ALL")
def neighbour_blocks(spark, sf):
    """The nine blocks of type, day and degree of latitude around each event, counted."""
    e = _located(spark, sf).select("event_type", F.floor(F.col("t") / 86_400_000_000).alias("day"), F.floor("lat").cast("long").alias("band")).groupBy("event_type", "day", "band").agg(F.count("*").alias("n"))
    around = e.select("event_type", F.explode(F.sequence(F.col("day") - 1, F.col("day") + 1)).alias("day"), "band", "n")
    return around.select("event_type", "day", F.explode(F.sequence(F.col("band") - 1, F.col("band") + 1)).alias("band"), "n").groupBy("event_type", "day", "band").agg(F.sum("n").alias("n"))


_SETS = """it AS (SELECT DISTINCT l_orderkey AS id, l_partkey AS e FROM lineitem), sz AS (SELECT id, count(*) AS n FROM it GROUP BY id), tm AS (SELECT o_orderkey AS id, epoch(o_orderdate) AS t, o_custkey % 5 AS owner, o_orderstatus AS status FROM orders)"""


def _sets(spark, sf):
    """Stories as (id, t, owner) and their entities as (id, e)."""
    items = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("e")).distinct()
    when = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("t"), (F.col("o_custkey") % 5).alias("owner"), F.col("o_orderstatus").alias("status"))
    return items, when


@query(f"""WITH {_SETS}, pr AS (SELECT a.id AS a, b.id AS b, count(*) AS met FROM it a JOIN it b ON a.e = b.e AND a.id <> b.id GROUP BY ALL),
    j AS (SELECT a, b, met / CAST(x.n + y.n - met AS DOUBLE) AS j FROM pr JOIN sz x ON x.id = a JOIN sz y ON y.id = b JOIN tm p ON p.id = a JOIN tm q ON q.id = b WHERE abs(p.t - q.t) <= 90 * 86400)
    SELECT a AS subject, b AS object, CASE WHEN j >= 0.5 THEN 'same_event_as' ELSE 'part_of_narrative' END AS predicate, CAST(trunc(j * 100 + 1e-9) AS INTEGER) AS confidence FROM j WHERE j >= 0.2""")
def narrative_edges(spark, sf):
    """Edges from each story to every other of 90 days whose entities are alike: Jaccard from 0.5 on the same event, from 0.2 on one narrative."""
    items, when = _sets(spark, sf)
    near = S.jaccard_pairs(items, 0.2, when, 90 * 86400)
    both = near.select("a", "b", "jaccard").unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"), "jaccard"))
    return both.select(F.col("a").alias("subject"), F.col("b").alias("object"), F.when(F.col("jaccard") >= 0.5, "same_event_as").otherwise("part_of_narrative").alias("predicate"), (F.col("jaccard") * 100 + 1e-9).cast("int").alias("confidence"))


@query(f"""WITH {_SETS}, pr AS (SELECT a.id AS a, b.id AS b, count(*) AS met FROM it a JOIN it b ON a.e = b.e AND a.id < b.id GROUP BY ALL) SELECT a, b, round(met / CAST(x.n + y.n - met AS DOUBLE), 6) AS jaccard FROM pr JOIN sz x ON x.id = a JOIN sz y ON y.id = b WHERE met / CAST(x.n + y.n - met AS DOUBLE) >= 0.4""")
def entity_jaccard_pairs(spark, sf):
    """Pairs of entity sets of Jaccard 0.4 and more, by prefixes of the rarest entities."""
    return S.jaccard_pairs(_sets(spark, sf)[0], 0.4).select("a", "b", F.round("jaccard", 6).alias("jaccard"))


_BEST = f"""{_SETS}, c AS (SELECT p.id AS a, q.id AS b FROM tm p JOIN tm q ON p.id <> q.id AND p.owner <> q.owner AND abs(p.t - q.t) <= 172800 WHERE p.id IN (SELECT id FROM sz) AND q.id IN (SELECT id FROM sz)),
    m AS (SELECT x.id AS a, y.id AS b, count(*) AS met FROM it x JOIN it y ON x.e = y.e AND x.id <> y.id GROUP BY ALL),
    j AS (SELECT c.a, c.b, coalesce(met, 0) / CAST(x.n + y.n - coalesce(met, 0) AS DOUBLE) AS j FROM c LEFT JOIN m USING (a, b) JOIN sz x ON x.id = c.a JOIN sz y ON y.id = c.b),
    u AS (SELECT a, max(j) AS best, arg_min(b, (-j, b)) AS with_unit FROM j GROUP BY a)"""


def _best_matches(spark, sf):
    """Each unit's best Jaccard with a unit of another owner within 48 hours; units with none of these (no candidate) at zero."""
    items, when = _sets(spark, sf)
    own = when.join(items.select("id").distinct(), "id", "left_semi")
    pairs = S.jaccard_pairs(items, 0.0, own, 172_800).join(own.select(F.col("id").alias("a"), F.col("owner").alias("oa")), "a").join(own.select(F.col("id").alias("b"), F.col("owner").alias("ob")), "b")
    pairs = pairs.where("oa != ob").select("a", "b", "jaccard")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "jaccard"))
    best = both.groupBy("a").agg(F.max("jaccard").alias("best"), F.min_by("b", F.struct(-F.col("jaccard"), "b")).alias("with_unit"))
    # A unit has a candidate if days near it hold another owner's unit: counts for each day and owner, no pairs.
    day = (F.col("t") / 86400).cast("long")
    per = own.groupBy(day.alias("day"), "owner").agg(F.count("*").alias("n"))
    reach = per.select(F.explode(F.sequence(F.col("day") - 2, F.col("day") + 2)).alias("day"), F.col("owner").alias("other"))
    any_other = own.select("id", day.alias("day"), "owner").join(reach, "day").where("owner != other").select("id").distinct()
    return own.select(F.col("id").alias("a")).join(best, "a", "left").join(any_other.select(F.col("id").alias("a"), F.lit(True).alias("candidate")), "a", "left").select("a", F.coalesce("best", F.lit(0.0)).alias("best"), "with_unit", F.coalesce("candidate", F.lit(False)).alias("candidate"))


@query(f"WITH {_BEST}, w AS (SELECT sz.id, coalesce(best, 0.0) AS best, u.a IS NOT NULL AS candidate FROM sz LEFT JOIN u ON u.a = sz.id) SELECT CAST(least(floor(best * 10 + 1e-9) / 10, 1.0) AS DOUBLE) AS bucket, count(*) AS units, count(*) FILTER (WHERE NOT candidate) AS without_candidate, count(*) FILTER (WHERE best >= 0.4) AS would_attach FROM w GROUP BY 1")
def jaccard_histogram(spark, sf):
    """Units by their best Jaccard with another owner's unit within 48 hours, in tenths."""
    return _best_matches(spark, sf).groupBy(F.least(F.floor(F.col("best") * 10 + 1e-9) / 10, F.lit(1.0)).alias("bucket")).agg(F.count("*").alias("units"), F.count_if(~F.col("candidate")).alias("without_candidate"), F.count_if(F.col("best") >= 0.4).alias("would_attach"))


@query(f"WITH {_BEST}, n AS (SELECT least(a, with_unit) AS a, greatest(a, with_unit) AS b, max(best) AS best FROM u WHERE best >= 0.2 AND best < 0.4 GROUP BY ALL) SELECT a, b, round(best, 6) AS jaccard FROM n ORDER BY round(best, 6) DESC, a, b LIMIT 25")
def near_misses_top25(spark, sf):
    """The 25 best pairs that fall short of attaching, each unordered pair once."""
    n = _best_matches(spark, sf).where("best >= 0.2 AND best < 0.4").groupBy(F.least("a", "with_unit").alias("a"), F.greatest("a", "with_unit").alias("b")).agg(F.round(F.max("best"), 6).alias("jaccard"))
    return n.orderBy(F.desc("jaccard"), "a", "b").limit(25)


@query(f"""WITH {_SETS}, pr AS (SELECT a.id AS a, b.id AS b, count(*) AS met FROM it a JOIN it b ON a.e = b.e AND a.id < b.id GROUP BY ALL), j AS (SELECT a, b, met / CAST(x.n + y.n - met AS DOUBLE) AS j FROM pr JOIN sz x ON x.id = a JOIN sz y ON y.id = b),
    g AS (SELECT unnest([0.2, 0.3, 0.4, 0.5, 0.6, 0.8]) AS threshold) SELECT CAST(threshold AS DOUBLE) AS threshold, count(*) AS pairs, count(DISTINCT a) AS left_stories FROM j JOIN g ON j.j >= threshold GROUP BY threshold""")
def merge_what_if(spark, sf):
    """How many pairs each threshold would merge: one pair table at the lowest, one row for each threshold it passes."""
    grid = [0.2, 0.3, 0.4, 0.5, 0.6, 0.8]
    p = S.jaccard_pairs(_sets(spark, sf)[0], grid[0])
    met = F.filter(F.array(*[F.lit(g) for g in grid]), lambda g: F.col("jaccard") >= g)
    return p.select("a", F.explode(met).alias("threshold")).groupBy("threshold").agg(F.count("*").alias("pairs"), F.countDistinct("a").alias("left_stories"))


_TFIDF = r"""w AS (SELECT id, owner, unnest(list_filter(regexp_split_to_array(lower(title), '[\s\p{Z}]+'), lambda x: x <> '')) AS term FROM a), tf AS (SELECT id, owner, term, count(*) AS n FROM w GROUP BY ALL), df AS (SELECT term, ln((1 + (SELECT count(DISTINCT id) FROM w)) / CAST(1 + count(*) AS DOUBLE)) + 1 AS idf FROM tf GROUP BY term),
    v AS (SELECT id, owner, term, n * idf AS x FROM tf JOIN df USING (term)), nm AS (SELECT id, sqrt(sum(x * x)) AS norm FROM v GROUP BY id)"""


@query(f"WITH {_TFIDF}, d AS (SELECT p.id AS a, q.id AS b, sum(p.x * q.x) AS dot FROM v p JOIN v q ON p.term = q.term AND p.id < q.id AND p.owner <> q.owner GROUP BY ALL) SELECT a, b, round(dot / (x.norm * y.norm), 6) AS cosine FROM d JOIN nm x ON x.id = a JOIN nm y ON y.id = b WHERE dot / (x.norm * y.norm) >= 0.8", articles=True)
def title_cosine_pairs(spark, sf):
    """Titles of different owners of cosine 0.8 and more between their term weights."""
    return S.cosine_pairs(articles(spark, sf).select("id", "owner", "title"), "title", "owner", 0.8).select("a", "b", F.round("cosine", 6).alias("cosine"))


@query("WITH o AS (SELECT label AS story, vec_id, CAST(embedding AS DOUBLE[]) AS e, vec_id % 4 = 0 AS tier1, vec_id % 10 AS source FROM embeddings), x AS (SELECT story, unnest(e) AS x, unnest(range(1, len(e) + 1)) AS k FROM o WHERE tier1), m AS (SELECT story, k, avg(x) AS x FROM x GROUP BY ALL), c AS (SELECT story, list(x ORDER BY k) AS c FROM m WHERE story IN (SELECT story FROM o WHERE tier1 GROUP BY story HAVING count(*) >= 2) GROUP BY story), s AS (SELECT source, list_cosine_similarity(e, c) AS s FROM o JOIN c USING (story)) SELECT source, count(*) AS compared, round(avg(s) * 100, 4) AS alignment, round(min(s) * 100, 4) AS low, round(max(s) * 100, 4) AS high, round(stddev_pop(s) * 100, 4) AS spread FROM s GROUP BY source")
def consensus_alignment(spark, sf):
    """Cosine of each source's vectors with the normalised mean of their story's tier-1 vectors, where there are two of these."""
    return S.consensus(table(spark, sf, "embeddings").select(F.col("label").alias("story"), "embedding", (F.col("vec_id") % 4 == 0).alias("tier1"), (F.col("vec_id") % 10).alias("source")))


@query("WITH o AS (SELECT label AS story, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id % 4 = 0), x AS (SELECT story, unnest(e) AS x, unnest(range(1, len(e) + 1)) AS k FROM o), m AS (SELECT story, k, avg(x) AS x FROM x GROUP BY ALL), n AS (SELECT story, sqrt(sum(x * x)) AS norm, count(*) AS dims FROM m GROUP BY story), h AS (SELECT story FROM o GROUP BY story HAVING count(*) >= 2) SELECT m.story, m.k - 1 AS place, round(m.x / norm, 6) AS value FROM m JOIN n USING (story) WHERE m.story IN (SELECT story FROM h)")
def story_centroids(spark, sf):
    """The normalised mean of a story's tier-1 vectors, a row for each place."""
    c = S.story_centroids(table(spark, sf, "embeddings").where("vec_id % 4 = 0").select(F.col("label").alias("story"), "embedding"))
    return c.select("story", F.posexplode("centroid").alias("place", "v")).select("story", F.col("place").cast("long").alias("place"), F.round("v", 6).alias("value"))
