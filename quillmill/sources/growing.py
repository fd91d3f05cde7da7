"""Following JSONL files that grow: a streaming source whose offset is the byte reached in each file."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

READ = 1 << 20
RANGE = 64 << 20  # bytes of a file that a task reads


def place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it, of a URI or a path."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)


def files(path: str) -> list[fs.FileInfo]:
    """The file, or a folder's *.jsonl files in order."""
    store, root = place(path)
    found = store.get_file_info(root)
    if found.type == fs.FileType.Directory:
        return sorted((f for f in store.get_file_info(fs.FileSelector(root)) if f.is_file and f.path.endswith(".jsonl")), key=lambda f: f.path)
    return [found] if found.is_file else []


def last_line_end(store: fs.FileSystem, path: str, start: int, end: int) -> int:
    """The position behind the last line break in [start, end), or start."""
    with store.open_input_file(path) as file:
        while end > start:
            at = max(start, end - READ)
            hit = file.read_at(end - at, at).rfind(b"\n")
            if hit >= 0:
                return at + hit + 1
            end = at
    return start


def lines_of(store: fs.FileSystem, path: str, start: int, end: int, stop: int) -> Iterator[tuple[int, bytes]]:
    """(position, line) of the lines that begin in [start, end); nothing beyond stop is read. A line that begins before start,
    unless a batch begins there, belongs to the range before."""
    with store.open_input_file(path) as file:
        at, rest = start, b""
        while at < stop:
            data = rest + file.read_at(min(READ, stop - at - len(rest)), at + len(rest))
            if len(data) == len(rest):
                break
            *whole, rest = data.split(b"\n")
            for line in whole:
                if at >= end:
                    return
                yield at, line
                at += len(line) + 1
            if at + len(rest) >= stop:
                break
        if rest and at < end:
            yield at, rest


class Range(InputPartition):
    def __init__(self, path: str, first: int, start: int, end: int, stop: int):
        self.path, self.first, self.start, self.end, self.stop = path, first, start, end, stop


class Reader(DataSourceStreamReader):
    """Offsets are {file: bytes}: one number for each file, whatever its size."""

    def __init__(self, options: dict[str, str]):
        self.root = options["path"]
        self.from_start = options.get("fromstart", "true").lower() == "true"
        self.wait = options.get("halflines", "wait") == "wait"
        self.range = int(options.get("rangebytes", RANGE))
        self.seen: dict[str, int] = {}

    def initialOffset(self) -> dict:  # noqa: N802
        return {} if self.from_start else self.latestOffset()

    def latestOffset(self) -> dict:  # noqa: N802
        store, _ = place(self.root)
        for f in files(self.root):
            old = self.seen.get(f.path, 0)
            if f.size > old:
                self.seen[f.path] = last_line_end(store, f.path, old, f.size) if self.wait else f.size
        return dict(self.seen)

    def partitions(self, start: dict, end: dict) -> list[Range]:
        self.seen = {k: max(start.get(k, 0), end.get(k, 0)) for k in {*start, *end}}
        out = []
        for path, stop in sorted(end.items()):
            first = start.get(path, 0)
            out += [Range(path, first, a, min(a + self.range, stop), stop) for a in range(first, stop, self.range)]
        return out or [Range("", 0, 0, 0, 0)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        if part.end <= part.start:
            return
        store, _ = place(self.root)
        begin = part.start
        if begin > part.first:  # the line in which the range begins is its predecessor's
            with store.open_input_file(part.path) as file:
                begin -= 1
                while begin < part.stop and (hit := (data := file.read_at(min(READ, part.stop - begin), begin)).find(b"\n")) < 0:
                    begin += len(data)
                begin = begin + hit + 1 if begin < part.stop else part.stop
        name, rows, held = part.path.rpartition("/")[2], [], 0
        for at, line in lines_of(store, part.path, begin, part.end, part.stop):
            rows.append((at, line.decode("utf-8", "replace")))
            held += len(line)
            if held > READ or len(rows) == 10_000:
                yield self.batch(name, rows)
                rows, held = [], 0
        if rows:
            yield self.batch(name, rows)

    @staticmethod
    def batch(name: str, rows: list[tuple[int, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([name] * len(rows), pa.string()), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], names=["source_file", "position", "line"])


class GrowingLines(DataSource):
    """format("growing_lines"): options path, fromStart (true), halfLines (wait, or take), rangeBytes."""

    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return "source_file string, position long, line string"

    def streamReader(self, schema: StructType) -> Reader:  # noqa: N802
        return Reader({k.lower(): v for k, v in self.options.items()})


def follow_growing(spark: SparkSession, path: str, schema: str, from_start: bool = True, half_lines: str = "wait", include_errors: bool = False) -> DataFrame:
    """Streaming rows (source_file, position, error, and schema's columns) of the lines that a file, or a folder's *.jsonl files, gain.

    From the start, or only what comes after it; files that come later are read whole. A line without a line break at the end of a
    file is left until it has one (`wait`), or taken as it is (`take`), then most likely broken. A line that is no JSON object is
    a row of nulls with error `invalid_json` and the line; blank lines are skipped. Rows with an error are hidden unless
    asked for. A file that shrinks gives nothing until it is longer than it was. The stream's checkpoint holds the bytes
    reached, so that a restart loses and repeats none.
    """
    spark.dataSource.register(GrowingLines)
    read = spark.readStream.format("growing_lines").option("path", path).option("fromStart", str(from_start).lower()).option("halfLines", half_lines).load()
    whole = read.where(F.trim("line") != "").withColumn("_ok", F.coalesce(F.schema_of_variant(F.try_parse_json("line")).startswith("OBJECT"), F.lit(False)))
    parsed = whole.withColumn("_r", F.from_json(F.when(F.col("_ok"), F.col("line")), schema))
    broken = F.when(~F.col("_ok"), F.lit("invalid_json"))
    columns = [f.name for f in StructType.fromDDL(schema).fields]
    error = F.coalesce(broken, F.col("_r.error")) if "error" in columns else broken
    rows = parsed.select("source_file", "position", error.alias("error"), *(F.col("_r")[c].alias(c) for c in columns if c != "error"), F.when(~F.col("_ok"), F.col("line")).alias("line"))
    return rows if include_errors else rows.where("coalesce(error, '') = ''")

