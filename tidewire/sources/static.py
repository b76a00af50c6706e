"""Static files: zipped tables, wiki tables of codes, answers in JSON lines, RDF and GeoJSON feeds, and the evidence poll."""

from __future__ import annotations

import io
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidewire.functions.text import content_hash
from tidewire.functions.url import canonical, host, url_hash
from tidewire.sources.feeds import valid

#: Lines of an archive in one Arrow batch.
LINES = 10_000


def zipped_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file_path, at, value): the lines of the first member, by name, of each zip file; an archive that cannot be read has none.

    Archives are spread over tasks, and a member is read as a stream of lines, never whole.
    """

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content.as_buffer())) as z:
                        with z.open(sorted(z.namelist())[0]) as f:
                            lines, at = [], 0
                            for line in io.TextIOWrapper(f, "utf-8", errors="replace", newline="\n"):
                                lines.append(line.rstrip("\r\n"))
                                if len(lines) == LINES:
                                    yield _lines(name, at, lines)
                                    lines, at = [], at + LINES
                            yield _lines(name, at, lines)
                except (zipfile.BadZipFile, IndexError, EOFError):
                    continue

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "file_path string, at long, value string")


def _lines(name: str, at: int, lines: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([name] * len(lines), pa.string()), pa.array(range(at, at + len(lines)), pa.int64()), pa.array(lines, pa.string())], names=["file_path", "at", "value"])


def zipped_table(spark: SparkSession, path: str | list[str], positions: dict[str, int], columns: int) -> DataFrame:
    """The named columns of zipped tab-separated files without quotes; rows of fewer columns are passed over."""
    cells = F.split("value", "\t")
    return zipped_lines(spark, path).select(cells.alias("c"), "file_path", "at").where(F.size("c") >= columns).select(*[F.nullif(F.trim(F.col("c")[k]), F.lit("")).alias(n) for n, k in positions.items()], "file_path", "at")


class ZippedLines(DataSource):
    """``spark.read.format("zipped_lines").option("paths", "a.zip,b.zip")``: one partition for each archive (paths that the executors share)."""

    @classmethod
    def name(cls) -> str:
        return "zipped_lines"

    def schema(self) -> str:
        return "file_path string, at long, value string"

    def reader(self, schema) -> DataSourceReader:
        return _ZippedReader(self.options)


class _ZippedReader(DataSourceReader):
    def __init__(self, options):
        self.paths = [p.strip() for p in options["paths"].split(",") if p.strip()]

    def partitions(self):
        return [InputPartition(p) for p in self.paths]

    def read(self, partition):
        with zipfile.ZipFile(partition.value) as z, z.open(sorted(z.namelist())[0]) as f:
            for at, line in enumerate(io.TextIOWrapper(f, "utf-8", errors="replace", newline="\n")):
                yield partition.value, at, line.rstrip("\r\n")


def wiki_codes(lines: DataFrame) -> DataFrame:
    """(code, name) of a wiki table whose records are two lines: ``| {{mono|XX}}``, then the name; lines has (file_path, at, value)."""
    nxt = lines.select("file_path", (F.col("at") - 1).alias("at"), F.col("value").alias("next"))
    code = F.regexp_extract("value", r"^\s*\|\s*\{\{mono\|([A-Z]{2})\}\}", 1)
    raw = F.regexp_extract(F.trim("next"), r"^\|\s*(.*)$", 1)
    flag, icon, italic = (F.regexp_extract(raw, p, 1) for p in (r"\{\{flag\|([^}|]+)", r"\{\{flagicon\|([^}|]+)", r"''\[\[([^\]|]+)"))
    name = F.when((italic != "") & F.contains(raw, F.lit("flagicon")), italic).when(flag != "", flag).when(icon != "", icon).otherwise(raw)
    clean = F.trim(F.regexp_replace(F.replace(F.regexp_replace(name, r"<ref.*", ""), F.lit("''"), F.lit("")), r"\{\{|\}\}", ""))
    rows = lines.where(code != "").withColumn("code", code).join(nxt, ["file_path", "at"]).where(F.trim("next").rlike(r"^\|"))
    return rows.groupBy("code").agg(F.max_by(clean, F.struct("file_path", "at")).alias("name"))


def composed_body(fields: dict[str, Column], code: Column, articles: Column) -> Column:
    """A body made of a record's metadata: title, event, themes, names, places and source, those that there are."""
    listed = lambda label, items, most=12: F.when(F.size(items) > 0, F.concat(F.lit(f"{label}: "), F.array_join(F.slice(items, 1, most), ", ")))
    places = F.array_join(F.transform(F.slice(fields["places"], 1, 5), lambda p: F.concat(F.lit("Location: "), p["name"], F.lit(" ("), F.coalesce(p["country"], F.lit("")), F.lit(") "), p["lat"].cast("string"), F.lit(","), p["lon"].cast("string"))), " ")
    return F.concat_ws(
        " ", F.nullif(fields["title"], F.lit("")), F.concat(F.lit("Event "), code), F.concat(articles.cast("string"), F.lit(" articles")), listed("Themes", fields["themes"]), listed("Persons", fields["persons"]),
        listed("Organizations", fields["organizations"]), F.nullif(places, F.lit("")), F.concat(F.lit("Source: "), F.nullif(fields["source"], F.lit(""))),
    )


def json_lines(spark: SparkSession, path: str | list[str], schema: str) -> tuple[DataFrame, DataFrame]:
    """Rows of JSON lines of a schema, and the lines that are none."""
    parsed = F.from_json("value", f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    rows = spark.read.text(path).where(F.trim("value") != "").select(parsed.alias("r")).select("r.*")
    return rows.where("_corrupt IS NULL").drop("_corrupt"), rows.where("_corrupt IS NOT NULL").select("_corrupt")


def place_features(features: DataFrame) -> DataFrame:
    """Articles of a GeoJSON answer's features (exploded to ``f``): name, link, place; one for each address, those off the globe go."""
    p, xy = F.col("f.properties"), F.col("f.geometry.coordinates")
    lon, lat = F.try_element_at(xy, F.lit(1)).cast("double"), F.try_element_at(xy, F.lit(2)).cast("double")
    url = F.coalesce(F.nullif(F.regexp_extract(p["html"], 'href="([^"]+)"', 1), F.lit("")), p["url"])
    rows = features.select(F.trim(url).alias("url"), p["name"].alias("title"), lat.alias("lat"), lon.alias("lon")).where(F.coalesce(valid(F.col("lat"), F.col("lon")), F.lit(False)) & (F.coalesce("url", F.lit("")) != ""))
    return rows.withColumns({"canonical_url": canonical(F.col("url")), "domain": host(F.col("url")), "url_hash": url_hash(F.col("url"))}).dropDuplicates(["url_hash"])


def evidence_entries(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Entries (title, url, published) of RSS 2, RDF and Atom files: an RDF item stands beside its channel, an Atom link is an attribute."""
    items = spark.read.schema("title string, link string, pubDate string, date string").option("rowTag", "item").xml(path)
    entries = spark.read.schema("title string, link struct<_href:string>, published string, updated string").option("rowTag", "entry").xml(path)
    a = items.select("title", F.trim("link").alias("url"), F.coalesce("pubDate", "date").alias("published"))
    b = entries.select("title", F.trim("link._href").alias("url"), F.coalesce("published", "updated").alias("published"))
    return a.unionByName(b).where("title IS NOT NULL AND url IS NOT NULL")


def stamped(observations: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, payload, leaf) of articles as they go to the log: their digest under their id, in canonical form."""
    payload = F.to_json(F.struct(content_hash(F.col(text_col)).alias("content_hash"), F.col(id_col).cast("string").alias("id")))
    return observations.select(F.col(id_col).alias("id"), payload.alias("payload"), F.sha2(payload.cast("binary"), 256).alias("leaf"))
