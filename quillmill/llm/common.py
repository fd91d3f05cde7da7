"""What the operators of this subpackage share."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder all executors share: the session's spark.checkpoint.dir, or a new one where that is unset and the master is
    local (tests)."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        found = spark.conf.get("spark.checkpoint.dir", None)
        if not found and sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        sc.setCheckpointDir(found or tempfile.mkdtemp(prefix="spark-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared checkpoint folder, so that a lost executor costs no recomputation and
    later jobs see the same rows."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def delete(spark: SparkSession, path: str) -> None:
    """Removes a table of intermediate results that a later one has replaced."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def smallest(df: DataFrame, n: int, *columns: str) -> DataFrame:
    """The n rows with the smallest hashes of columns, in which rows differ: the same sample on any cluster. Of a large df (it is
    counted first) only about twice as many rows as wanted, those below a bound, reach the task that sorts."""
    h, total = F.xxhash64(*columns), df.count()
    if total > 4 * n:
        df = df.where(h < F.lit(-(1 << 63) + (1 << 64) // total * 2 * n))
    return df.orderBy(h, *columns).limit(n)


def fresh(df: DataFrame, name: str) -> str:
    """name, or name with underscores before it, so that no column of df has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def append_columns(df: DataFrame, read: str, fields: list[tuple[str, T.DataType]], make: Callable[[], Callable[[list], list[pa.Array]]], as_list: bool = True) -> DataFrame:
    """df with further columns that Python computes from column `read`, batch by batch.

    make() runs once in each task and returns a function from a list of values (an Arrow array where as_list is False) to
    one Arrow array for each field. All columns of df pass through untouched; the caller picks names that df does not have.
    """
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, t) for n, t in fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            new = work(batch.column(read).to_pylist() if as_list else batch.column(read))
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *(n for n, _ in fields)])

    return df.mapInArrow(run, schema)


def ascii_words(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` as UTF-8: bytes.split() parts at exactly these six characters."""
    return text.encode("utf-8", "surrogatepass").split() if text else []
