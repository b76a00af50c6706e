"""A table that writers commit to: a Python data source with commit messages, abort and retry, and an upsert exact under repeats.

    df.write.format("committed").mode("append").option("path", folder).option("batch", id).save()

A task writes a file of its own in the table's folder and reports its name; a retried task writes another. The driver's commit puts
the names of those reported into one manifest, which it moves into place at once: readers see a batch whole or not at all. A
batch id that was committed before is not committed again, whatever its tasks wrote, and an aborted batch's files are deleted.
The folder is a path that driver and executors share.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

#: Rows of one file's row group; seconds between tries of a commit that fails, doubling, and tries.
ROWS, WAIT, TRIES = 100_000, 0.2, 4


def local(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:")


@dataclass
class Written(WriterCommitMessage):
    file: str
    rows: int


class Committed(DataSource):
    @classmethod
    def name(cls) -> str:
        return "committed"

    def schema(self) -> str:
        return "value string"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options, schema)


class _Writer(DataSourceArrowWriter):
    def __init__(self, options, schema):
        self.path, self.batch, self.fails = local(options["path"]), options["batch"], options.get("fails", "")
        from pyspark.sql.pandas.types import to_arrow_schema

        self.schema = to_arrow_schema(schema)

    def write(self, iterator):
        from pyspark import TaskContext

        os.makedirs(f"{self.path}/files", exist_ok=True)
        task, rows = TaskContext.get(), 0
        name = f"{self.batch}-{task.partitionId()}-{uuid.uuid4().hex}.parquet"
        with pq.ParquetWriter(f"{self.path}/files/{name}", self.schema, compression="zstd") as out:
            for batch in iterator:
                rows += batch.num_rows
                out.write_table(pa.Table.from_batches([batch]).cast(self.schema), row_group_size=ROWS)
                if self.fails and _first_time(f"{self.path}/{self.fails}"):
                    raise OSError("writing failed half way")  # an injected fault, for tests
        return Written(name, rows)

    def commit(self, messages) -> None:
        done = [m for m in messages if m is not None]
        manifest = {"batch": self.batch, "files": sorted(m.file for m in done if m.rows), "rows": sum(m.rows for m in done)}
        for m in done:
            if not m.rows:
                _remove(f"{self.path}/files/{m.file}")
        os.makedirs(f"{self.path}/manifests", exist_ok=True)
        with_retry(lambda: self._publish(manifest))

    def _publish(self, manifest: dict) -> None:
        final = f"{self.path}/manifests/{self.batch}.json"
        if os.path.exists(final):  # a repeat: the first one stays
            for name in manifest["files"]:
                if name not in json.load(open(final))["files"]:
                    _remove(f"{self.path}/files/{name}")
            return
        part = f"{final}.{uuid.uuid4().hex}.part"
        with open(part, "w") as f:
            json.dump(manifest, f)
        try:
            os.link(part, final)  # fails if another writer was first, unlike a rename
        except FileExistsError:
            self._publish(manifest)
        finally:
            _remove(part)

    def abort(self, messages) -> None:
        for m in messages:
            if m is not None:
                _remove(f"{self.path}/files/{m.file}")


def with_retry(action, tries: int = TRIES, wait: float = WAIT):
    """Run an action again after faults that may pass, waiting twice as long each time."""
    for k in range(tries):
        try:
            return action()
        except OSError:
            if k + 1 == tries:
                raise
            time.sleep(wait * 2**k)


def _remove(path: str) -> None:
    try:
        os.remove(path)
    except FileNotFoundError:
        pass


def _first_time(marker: str) -> bool:
    try:
        os.close(os.open(marker, os.O_CREAT | os.O_EXCL))
        return True
    except FileExistsError:
        return False


def put(df: DataFrame, folder: str, batch: str, **options) -> None:
    """Commit df as one batch; a batch that is there already costs no run."""
    if not os.path.exists(f"{local(folder)}/manifests/{batch}.json"):
        df.sparkSession.dataSource.register(Committed)
        w = df.write.format("committed").mode("append").option("path", folder).option("batch", batch)
        for k, v in options.items():
            w = w.option(k, v)
        w.save()


def manifests(folder: str) -> list[dict]:
    at = f"{local(folder)}/manifests"
    return [json.load(open(f"{at}/{n}")) for n in sorted(os.listdir(at)) if n.endswith(".json")] if os.path.isdir(at) else []


def read(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The rows of all committed batches, with the batch of each."""
    files = [f"{folder}/files/{n}" for m in manifests(folder) for n in m["files"]]
    if not files:
        return spark.createDataFrame([], f"{schema}, batch string")
    rows = spark.read.schema(schema).parquet(*files)
    return rows.withColumn("batch", F.regexp_extract(F.element_at(F.split(F.input_file_name(), "/"), -1), r"^(.*)-\d+-[0-9a-f]{32}\.parquet$", 1))


def counters(spark: SparkSession, folder: str, keys: str, amount: str) -> DataFrame:
    """Counters that batches add to: sums by key over what is committed, so a batch counts once however often it was sent."""
    names = [k.strip().split(" ")[0] for k in keys.split(",")]
    return read(spark, folder, f"{keys}, {amount} long").groupBy(*names).agg(F.sum(amount).alias(amount))
