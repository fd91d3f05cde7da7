"""WARC: parallel writer with revisit records, and a splittable reader.

Each record is a gzip member of its own. The reader deals byte ranges of the archives to tasks, one range to a task. A task
scans its range for the gzip magic, takes a hit as a record only if it decodes to a WARC header, and owns the records that
start in its range, which it reads to their ends beyond the range. So a large archive is read by many tasks without an index.
A header can have any length. A member that starts as a WARC record but is broken raises an error: no record is left out in
silence. (Payloads must not hold WARC members stored without compression, as binary data could; UTF-8 text can't hold the magic.)
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.llm.common import checkpoint_dir, cut, table

LEAST_REVISIT = 1000  # bytes of payload
SPLIT = 16 << 20  # bytes of a range
MAGIC = b"\x1f\x8b\x08"
READ = 1 << 20  # bytes read at a time
WINDOW = 1 << 12  # bytes searched for the magic at a time: mostly the next record starts where the last one ends
VERSION = b"WARC/1."
MOST_READERS = 1 << 17  # tasks of a reading; beyond that a task takes several ranges
DATE = "1970-01-01T00:00:00Z"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    """One gzip member. A revisit has the HTTP head alone, whose Content-Length says how long the full payload is."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if kind == "response" else head
    name = lambda x: f"<urn:page:{'' if x is None else x}>"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if kind == "revisit":
        lines += [f"WARC-Refers-To: {name(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join([*lines, "", ""]).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n") + pack.flush()


def with_revisits(pages: DataFrame, least: int) -> DataFrame:
    """pages (page_id, url, html) with digest, kind and refers_to. Digests that occur once, and short payloads, get a key of
    their own, so that the join has no hot key but those of large groups, which AQE splits."""
    keyed = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    long_ = F.octet_length("html") >= least
    last = keyed.where(long_).groupBy(F.col("digest").alias("key")).agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1").drop("n")
    own = keyed.withColumn("key", F.when(long_, F.col("digest")).otherwise(F.concat(F.lit("-"), F.xxhash64("page_id", "html").cast("string"))))
    revisit = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return own.join(last, "key", "left").select("page_id", "url", "html", "digest", F.when(revisit, "revisit").otherwise("response").alias("kind"), F.when(revisit, F.col("last")).alias("refers_to"))


def write_warc(pages: DataFrame, folder: str, least: int = LEAST_REVISIT) -> DataFrame:
    """Writes pages (page_id, url, html) as archives into folder, a URI that all executors reach, and returns (path, bytes,
    records) of each. A task's attempt writes a file of its own, and only those of attempts that succeeded are returned."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, path = fs.FileSystem.from_uri(f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz")
        store.create_dir(path.rpartition("/")[0])
        n = 0
        with store.open_output_stream(path, compression=None) as out:
            for batch in batches:
                for row in batch.to_pylist():
                    out.write(record(row["page_id"], row["url"], row["html"].encode("utf-8", "surrogatepass"), row["digest"], row["kind"], row["refers_to"]))
                    n += 1
            size = out.tell()
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{path.rpartition('/')[2]}"]), pa.array([size], pa.int64()), pa.array([n], pa.int64())], names=["path", "bytes", "records"])

    return cut(with_revisits(pages, least).mapInArrow(write, "path string, bytes long, records long"))


class Range:
    """Bytes of a file, read in steps."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at, self.data = file, size, 0, b""

    def get(self, at: int, n: int = READ) -> bytes:
        """Up to n bytes from position at."""
        if not (self.at <= at and min(at + n, self.size) <= self.at + len(self.data)):
            n = max(n, READ)
            self.at, self.data = at, self.file.read_at(max(0, min(n, self.size - at)), at)
        return self.data[at - self.at : at - self.at + n]


def member(source: Range, at: int) -> tuple[bytes, int] | None:
    """The content of the gzip member at `at` and the position behind it, if it is a WARC record: None as soon as it does not
    decode or does not start as one. What starts as one and does not end as one raises an error."""
    decode, raw = zlib.decompressobj(31), source.get(at, 1 << 16)
    try:
        first = decode.decompress(raw, len(VERSION))
    except zlib.error:
        return None
    if first != VERSION:
        return None
    out, pos, rest = [first], at + len(raw), decode.unconsumed_tail
    try:
        out.append(decode.decompress(rest))
        while not decode.eof:
            rest = source.get(pos, 1 << 16)
            if not rest:
                raise ValueError(f"the archive ends within the record at {at}")
            out.append(decode.decompress(rest))
            pos += len(rest)
    except zlib.error as e:
        raise ValueError(f"the record at {at} is broken: {e}") from e
    content = b"".join(out)
    if b"\r\n\r\n" not in content:
        raise ValueError(f"the record at {at} has a header without an end")
    return content, pos - len(decode.unused_data)


def records(source: Range, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(position, content) of each record that starts in [start, end)."""
    at = start
    while at < end:
        window = source.get(at, min(WINDOW, end - at) + len(MAGIC) - 1)
        hit = window.find(MAGIC)
        if hit < 0:
            at += max(1, len(window) - len(MAGIC) + 1)
            continue
        at += hit
        if at >= end:
            return
        flags = source.get(at, 4)
        found = member(source, at) if len(flags) == 4 and not flags[3] & 0xE0 else None
        if found:
            yield at, found[0]
            at = found[1]
        else:
            at += 1


def parsed(content: bytes) -> dict:
    """The fields of a record. payload is None for a revisit; its digest and length are those of the full payload."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda x: int(y) if (y := x.removeprefix("<urn:page:").removesuffix(">")) else None
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
    out = {"page_id": number(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "record_type": kind, "payload_digest": digest, "refers_to": number(fields["warc-refers-to"]) if kind == "revisit" else None}
    if kind == "revisit":
        length = next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        return out | {"payload": None, "payload_bytes": int(length.split(b":")[1])}
    if hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"the payload of page {out['page_id']} does not have its digest")
    return out | {"payload": payload, "payload_bytes": len(payload)}


def read_warc(files: DataFrame, split: int = SPLIT, with_payload: bool = True) -> DataFrame:
    """(page_id, url, record_type, payload_digest, payload_bytes, refers_to, path, position[, payload]) of the records in the
    archives files (path, bytes), each read by the task in whose range it starts. An empty archive has no records."""
    readers = files.agg(F.sum(F.ceil(F.col("bytes") / split))).first()[0] or 1
    ranges = files.where("bytes > 0").select("path", "bytes", F.explode(F.expr(f"sequence(0L, bytes - 1, {split}L)")).alias("start"))
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to", pa.int64()), ("path", pa.string()), ("position", pa.int64()), *([("payload", pa.binary())] if with_payload else [])])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = fs.FileSystem.from_uri(row["path"])
                with store.open_input_file(path) as file:
                    rows, size = [], 0
                    for at, content in records(Range(file, row["bytes"]), row["start"], min(row["start"] + split, row["bytes"])):
                        rows.append(parsed(content) | {"path": row["path"], "position": at})
                        size += len(content)
                        if size > 8 << 20 or len(rows) >= 5000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema)

    # A stated number of tasks, as Spark would otherwise join these tiny rows to one; ranges of the order, so that each has its share.
    return ranges.repartitionByRange(min(int(readers), MOST_READERS), "path", "start").mapInArrow(read, "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, path string, position long" + ", payload binary" * with_payload)


def round_trip(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_REVISIT, split: int = SPLIT, with_payload: bool = False) -> DataFrame:
    """Writes pages as WARC archives under the shared checkpoint folder and reads them back: a row for each row of pages.

    Only the three named columns are read. A null html is an empty payload; a null url gives no target URI. Of equal payloads
    of at least `least` bytes that with the largest page_id is the response; several rows with that page_id all are, and so
    are all rows of a group in which every page_id is null. No rows give no rows. If the archives give back another number of
    records than were written, that is an error.
    """
    folder = checkpoint_dir(pages.sparkSession).rstrip("/")
    folder = folder if "://" in folder else "file://" + folder.removeprefix("file:")
    files = write_warc(pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html")), f"{folder}/warc-{uuid.uuid4()}", least)
    rows = cut(read_warc(files, split, with_payload))
    written, found = files.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0], rows.count()
    if written != found:
        raise ValueError(f"{written} records were written, {found} were read")
    return rows


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = round_trip(table(spark, sf_dir, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND last IS NOT NULL AND page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND last IS NOT NULL AND page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM g
"""
