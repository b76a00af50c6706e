"""Points of geometries, viewports, and counts up to a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _point(pair: Column) -> Column:
    """(lat, lon) of [lon, lat], or null where it is no place on earth."""
    lon, lat = F.get(pair, F.lit(0)), F.get(pair, F.lit(1))
    return F.when((F.size(pair) >= 2) & lat.between(-90, 90) & lon.between(-180, 180), F.struct(lat.alias("lat"), lon.alias("lon")))


def _centre(ring: Column) -> Column:
    """The mean of a ring's vertices, its closing one counted."""
    good = F.filter(ring, lambda p: (F.size(p) >= 2) & F.get(p, F.lit(0)).isNotNull() & F.get(p, F.lit(1)).isNotNull())
    mean = lambda k: F.aggregate(good, F.lit(0.0), lambda s, p: s + F.get(p, F.lit(k))) / F.size(good)
    return F.when(F.size(ring) == 1, _point(F.get(ring, F.lit(0)))).when(F.size(good) > 0, F.struct(mean(1).alias("lat"), mean(0).alias("lon")))


def _first(points: Column) -> Column:
    return F.get(F.filter(points, lambda p: p.isNotNull()), F.lit(0))


def representative_point(geojson: Column) -> Column:
    """(lat, lon) of a GeoJSON geometry: a point, the first of several, a line's middle vertex, a polygon's centre, the first good member."""
    kind, body = F.get_json_object(geojson, "$.type"), F.get_json_object(geojson, "$.coordinates")
    at = lambda depth: F.from_json(body, "array<" * depth + "double" + ">" * depth)
    middle = lambda line: _point(F.get(line, F.floor(F.size(line) / 2).cast("int")))
    return (
        F.when(kind == "Point", _point(at(1))).when(kind == "MultiPoint", _point(F.get(at(2), F.lit(0)))).when(kind == "LineString", middle(at(2))).when(kind == "MultiLineString", _first(F.transform(at(3), middle)))
        .when(kind == "Polygon", _centre(F.get(at(3), F.lit(0)))).when(kind == "MultiPolygon", _first(F.transform(at(4), lambda p: _centre(F.get(p, F.lit(0))))))
    )


def boxes(west: Column, east: Column) -> Column:
    """One (west, east), or two where a viewport lies over the antimeridian; bounds are clamped to the globe."""
    w, e = (F.greatest(F.lit(-180.0), F.least(F.lit(180.0), x)) for x in (west, east))
    box = lambda a, b: F.struct(a.alias("west"), b.alias("east"))
    return F.when(e < w, F.array(box(w, F.lit(180.0)), box(F.lit(-180.0), e))).otherwise(F.array(box(w, e)))


def as_of_counts(events: DataFrame, time: str, cursors: DataFrame, key: str, at: str, step: int) -> DataFrame:
    """(key, shown): events up to each cursor's time; none of a null time, on either side.

    Events and cursors of a bucket of time are put in one order, and a running count is what a cursor has of its own bucket: a row is
    seen once, however many fall into a bucket. The buckets before it are added up, one row for each of the span.
    """
    bucket = lambda t: F.floor(F.col(t) / step).alias("bucket")
    seen = events.where(F.col(time).isNotNull()).select(bucket(time), F.col(time).alias("t"), F.lit(1).alias("n"))
    asked = cursors.select(bucket(at), F.col(at).alias("t"), F.lit(0).alias("n"), F.col(key).alias("key"), F.lit(True).alias("asked"))
    rows = seen.unionByName(asked, allowMissingColumns=True)
    # Peers are counted too: a frame by range holds all events of the cursor's very time.
    own = rows.withColumn("own", F.sum("n").over(Window.partitionBy("bucket").orderBy("t"))).where("asked").select("bucket", "key", "own")
    per = rows.groupBy("bucket").agg(F.sum("n").alias("n"))
    before = per.select("bucket", (F.sum("n").over(Window.orderBy("bucket")) - F.col("n")).alias("before"))
    return own.join(before, "bucket", "left").select(F.col("key").alias(key), (F.col("own") + F.coalesce("before", F.lit(0))).alias("shown"))
