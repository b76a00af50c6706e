"""Ingest of quarter-hour windows: a streaming source whose offsets are the stamps of a manifest.

    spark.dataSource.register(Windows); spark.readStream.format("windows").option("path", folder).load()

The folder holds ``manifest.txt``, with a 14-digit stamp in each line that has one, and for each stamp archives ``<stamp>.<kind>.zip``
of tab-separated lines. A batch takes the stamps after the last one committed, each archive in a task of its own, read as a
stream of lines. An archive that is missing or broken gives one row that says so, and the window goes on without it; what was
read before a fault within an archive is given up with it, as rows are given out once the archive is whole.
"""

from __future__ import annotations

import io
import os
import re
import zipfile
import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

_STAMP = re.compile(r"\b(\d{14})\b")
SCHEMA = "stamp string, kind string, at long, value string, fault string"


class Windows(DataSource):
    @classmethod
    def name(cls) -> str:
        return "windows"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader(self.options)


class _Reader(DataSourceStreamReader):
    def __init__(self, options):
        self.path = options["path"].removeprefix("file://").removeprefix("file:")
        self.kinds = options.get("kinds", "export,gkg").split(",")

    def _stamps(self) -> list[str]:
        try:
            with open(f"{self.path}/manifest.txt") as f:
                return sorted({s for line in f for s in _STAMP.findall(line)})
        except FileNotFoundError:
            return []

    def initialOffset(self) -> dict:
        return {"stamp": ""}

    def latestOffset(self) -> dict:
        return {"stamp": max(self._stamps(), default="")}

    def partitions(self, start: dict, end: dict):
        return [InputPartition((s, k)) for s in self._stamps() if start["stamp"] < s <= end["stamp"] for k in self.kinds]

    def read(self, partition):
        stamp, kind = partition.value
        name = f"{self.path}/{stamp}.{kind}.zip"
        if not os.path.exists(name):
            yield stamp, kind, None, None, "missing"
            return
        try:
            with zipfile.ZipFile(name) as z:
                if z.testzip() is not None:
                    raise zipfile.BadZipFile("checksum")
                member = sorted(z.namelist())[0]
                with z.open(member) as f:
                    for at, line in enumerate(io.TextIOWrapper(f, "utf-8", errors="replace", newline="\n")):
                        yield stamp, kind, at, line.rstrip("\r\n"), None
        except (zipfile.BadZipFile, zlib.error, IndexError, EOFError, OSError) as e:
            yield stamp, kind, None, None, f"broken: {type(e).__name__}"

    def commit(self, end: dict) -> None:
        """Archives stay where they are."""


def joined(batch: DataFrame, columns: int, url: int, graph_url: int) -> DataFrame:
    """The rows of a batch's graph archives, each beside the last event of its URL in its window (null if none): (stamp, at, url, cells, event).

    Lines of fewer columns are passed over, as are graph rows without a URL.
    """
    cells = batch.where("fault IS NULL").select("stamp", "kind", "at", F.split("value", "\t").alias("cells")).where(F.size("cells") >= columns)
    events = cells.where("kind = 'export'").groupBy("stamp", F.col("cells")[url].alias("url")).agg(F.max_by("cells", "at").alias("event"))
    graph = cells.where("kind = 'gkg'").select("stamp", "at", F.col("cells")[graph_url].alias("url"), "cells").where("url <> ''")
    return graph.join(events, ["stamp", "url"], "left")
