"""An append log: batches are staged as files and count once their manifest is in place.

A table folder holds staged/<run>-<batch>-<attempt>/ with the files of an attempt and log/<run>-<batch>.json for each
batch that counts. The manifest is written beside its place and moved there last, so a batch is there wholly or not at all.
An attempt that was killed leaves files that no manifest names; when the batch comes again its manifest is written once, and if it is
there already the batch is skipped. Readers go by the manifests. The files are Spark's, in any store that Spark writes to; where several
writers send the same batch at the same time, the store's rename must not replace a file that is there, as HDFS's doesn't.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class Store:
    """Small files in a folder that Spark reaches, by Spark's own file systems."""

    def __init__(self, spark: SparkSession, folder: str):
        self.jvm, self.folder = spark._jvm, folder
        self.fs = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def names(self, name: str) -> list[str]:
        """Of the files in a folder, in order; none if there is no such folder."""
        return sorted(f.getPath().getName() for f in self.fs.listStatus(self.path(name))) if self.fs.exists(self.path(name)) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Writes a small file beside its place and moves it there; False if the place is taken."""
        beside = self.path(f"{name.rpartition('/')[0]}/.{uuid.uuid4()}")
        if self.fs.exists(self.path(name)):
            return False
        stream = self.fs.create(beside, True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()
        try:
            moved = self.fs.rename(beside, self.path(name))
        except Py4JJavaError:
            moved = False
        if not moved:
            self.fs.delete(beside, False)
        return moved

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def manifests(spark: SparkSession, folder: str) -> list[dict]:
    """What counts, in the order of runs and batches: {run, batch, files, rows, ...}. A small file for each batch."""
    store = Store(spark, folder)
    return [json.loads(store.read(f"log/{n}")) for n in store.names("log") if n.endswith(".json") and not n.startswith(".")]


def append(df: DataFrame, folder: str, run: str, batch: int, counts: dict[str, Column] | None = None) -> dict | None:
    """Appends df as a batch of a run, unless that batch counts already; returns its manifest, or None.

    Rows, and `counts` (aggregates by name), are observed on the pass that writes; nothing is read a second time.
    """
    spark, name = df.sparkSession, f"log/{run}-{batch:020d}.json"
    store = Store(spark, folder)
    if store.fs.exists(store.path(name)):
        return None
    staged, seen = f"staged/{run}-{batch:020d}-{uuid.uuid4()}", Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *(c.alias(k) for k, c in (counts or {}).items())).write.parquet(f"{folder}/{staged}")
    manifest = {"run": run, "batch": batch, "files": staged, **seen.get}
    return manifest if store.create(name, json.dumps(manifest)) else None


def read(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The rows that count."""
    files = [f"{folder}/{m['files']}" for m in manifests(spark, folder)]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def count(spark: SparkSession, folder: str) -> int:
    """How many rows count, by the manifests."""
    return sum(m["rows"] for m in manifests(spark, folder))


def vacuum(spark: SparkSession, folder: str) -> int:
    """Deletes what attempts left behind that no manifest names; only while nothing is being appended. Returns how many."""
    store, named = Store(spark, folder), {m["files"] for m in manifests(spark, folder)}
    lost = [n for n in store.names("staged") if f"staged/{n}" not in named]
    for n in lost:
        store.delete(f"staged/{n}")
    return len(lost)


def resume(planned: DataFrame, done: DataFrame, work: Callable[[DataFrame], DataFrame], folder: str, run: str, batch: int, key: str = "id") -> dict | None:
    """Works on the planned rows without a successful one among done, and appends the results as a batch."""
    from quillmill.operators.selection import pending

    return append(work(pending(planned, done, key)), folder, run, batch)


def write_stream(rows: DataFrame, folder: str, state: str, run: str = "stream", counts: dict[str, Column] | None = None):
    """A writer of streaming rows into the log: a micro-batch that comes again after a failure is not appended twice. `state` is the
    stream's checkpoint, which belongs to this folder and run."""
    return rows.writeStream.option("checkpointLocation", state).foreachBatch(lambda df, batch: append(df, folder, run, batch, counts) and None)
