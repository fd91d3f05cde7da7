"""Sharding by longest processing time: groups that must stay together, largest first, each to the least loaded shard.

The heap needs no groups, only their sizes in descending order: distinct sizes with a count. Distinct sizes that add up to T bytes are
at most sqrt(2 T) many, 14 million for 100 TB, and one task takes them as a stream, with one number for each shard in memory. A
run of groups of equal size s doesn't go through the heap one by one if it is long: the t-th pop of shard j comes at the key
(load_j + t * s, j), so that the k-th pop of the run is the k-th of these keys in order. The stream writes down the loads before each
run; a group finds its shard from these and its place in the run, wherever it is. The result is that of a heap over all groups.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmill.llm.common import cut, table

SHARDS = 16
RUN = 64  # runs up to this length go through the heap
SPLIT = 50_000  # groups of one size that meet one row of the plan
HOT = 1_024  # a group with more than so many-th of all rows is hot: there are fewer of them than this


def pops(loads: np.ndarray, size: int, place: np.ndarray) -> np.ndarray:
    """The shards of the pops at `place` (from 0) of a run of groups of `size` from a heap with these loads.

    By bisection for the least key value v up to which more than `place` pops come; among the shards that have a pop at v
    the order is that of their numbers.
    """
    loads = np.asarray(loads, np.int64)
    until = lambda v: np.where(v[:, None] >= loads, (v[:, None] - loads) // size + 1, 0)  # noqa: E731  pops of each shard with a key value up to v
    low = np.full(len(place), loads.min() - 1, np.int64)  # no pop
    high = loads.min() + place * size  # the least loaded alone has so many
    while (low + 1 < high).any():
        middle = low + (high - low) // 2
        enough = until(middle).sum(1) > place
        high, low = np.where(enough, middle, high), np.where(enough, low, middle)
    before, at = until(high - 1), until(high)
    nth = place - before.sum(1)
    return np.argmax(np.cumsum(at - before, 1) > nth[:, None], 1)


def run_loads(loads: list[int], size: int, count: int) -> list[int]:
    """The loads after a run of `count` groups of `size`."""
    if count <= RUN:
        heap = [(x, j) for j, x in enumerate(loads)]
        heapq.heapify(heap)
        for _ in range(count):
            x, j = heap[0]
            heapq.heapreplace(heap, (x + size, j))
        return [x for x, _ in sorted(heap, key=lambda e: e[1])]
    low, high = min(loads) - 1, min(loads) + count * size
    until = lambda v: [max(0, (v - x) // size + 1) for x in loads]
    while low + 1 < high:  # the largest key value with at most `count` pops up to it
        middle = (low + high) // 2
        low, high = (middle, high) if sum(until(middle)) <= count else (low, middle)
    taken = until(low)
    left = count - sum(taken)
    for j, (a, b) in enumerate(zip(taken, until(low + 1), strict=True)):
        if left and b > a:
            taken[j], left = b, left - 1
    return [x + n * size for x, n in zip(loads, taken, strict=True)]


def plan(sizes: DataFrame, shards: int) -> DataFrame:
    """From (total, n) the loads of the shards before each run, (total, block, loads): one task, a stream in descending order; a
    run of over SPLIT groups has several blocks with the same loads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loads = [0] * shards
        for batch in batches:
            rows = []
            for total, n in zip(batch.column("total").to_pylist(), batch.column("n").to_pylist(), strict=True):
                rows += [(total, b, loads) for b in range(-(-n // SPLIT))]
                loads = run_loads(loads, total, n)
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.list_(pa.int64()))], names=["total", "block", "loads"])

    return sizes.repartition(1).sortWithinPartitions(F.desc("total")).mapInArrow(run, "total long, block long, loads array<long>")


def numbered(df: DataFrame, part: str, *order: str) -> DataFrame:
    """df with _place, the row's place (from 0) in its part by `order`; a part of any size is spread over tasks. Rows that
    agree in all of these take places of their own.

    Ranges of (part, order) are sorted by their tasks and kept; ids that grow by one give the place in a range, sums over the
    ranges before, of which there is one row for each range and part, the rest.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tie = F.monotonically_increasing_id()
    ranged = cut(cut(df.withColumn("_tie", tie)).repartitionByRange(n, part, *order, "_tie").sortWithinPartitions(part, *order, "_tie").withColumns({"_id": F.monotonically_increasing_id(), "_range": F.spark_partition_id()}).drop("_tie"))
    counts = ranged.groupBy(part, "_range").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = Window.partitionBy(part).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    start = counts.select(F.col(part).alias("_part"), F.col("_range").alias("_r"), (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_start"))
    return ranged.join(start, (F.col(part) == F.col("_part")) & (F.col("_range") == F.col("_r"))).withColumn("_place", F.col("_start") + F.col("_id")).drop("_id", "_range", "_part", "_r", "_start")


def assign_shards(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of each row: size is the bytes of the text in UTF-8 plus one, rows of equal text
    are a group and go to one shard, and slot is the place there, by doc_id (nulls first) and digest of the text.

    Groups are taken by their total size, largest first, ties by the text's SHA-256. A null text is as an empty one; repeated
    rows have slots of their own; an empty table gives no rows. Other columns are not read, and no text is shuffled.
    """
    plain = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    rows = cut(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), (F.octet_length(plain) + 1).cast("long").alias("size"), F.crc32(plain).alias("text_crc32"), F.unhex(F.sha2(plain, 256)).alias("text")))
    groups = rows.groupBy("text").agg(F.sum("size").alias("total"), F.count("*").alias("copies"))
    ranked = numbered(groups, "total", "text").withColumn("block", F.floor(F.col("_place") / SPLIT))
    loads = plan(ranked.groupBy("total").agg(F.count("*").alias("n")), shards)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, at = (batch.column(c).to_numpy() for c in ("total", "_place"))
            before = np.array(batch.column("loads").flatten().to_numpy()).reshape(-1, shards)
            shard = np.empty(len(total), np.int32)
            order = np.argsort(total, kind="stable")
            for mine in np.split(order, np.flatnonzero(np.diff(total[order])) + 1) if len(total) else []:
                shard[mine] = pops(before[mine[0]], int(total[mine[0]]), at[mine])
            yield pa.RecordBatch.from_arrays([batch.column("text"), batch.column("copies"), pa.array(shard)], names=["text", "copies", "shard"])

    placed = cut(ranked.join(loads, ["total", "block"]).mapInArrow(place, "text binary, copies long, shard int"))
    n = placed.agg(F.sum("copies")).first()[0] or 0
    # Groups of so many copies are fewer than HOT, whatever the table: their rows meet them without a shuffle.
    hot = F.broadcast(placed.where(F.col("copies") * HOT > n).select("text", "shard"))
    known = rows.join(hot, "text", "left")
    rest = known.where("shard IS NULL").drop("shard").join(placed.where(F.col("copies") * HOT <= n).select("text", "shard"), "text")
    both = known.where("shard IS NOT NULL").unionByName(rest)
    return numbered(both, "shard", "doc_id", "text").select("doc_id", "size", "text_crc32", "shard", F.col("_place").alias("slot"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = assign_shards(table(spark, sf_dir, "documents"))
    return sharded.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: A fold of all groups with the loads as a list, and CRC-32 as a fold over the bits of each text.
OP13_SQL = f"""WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, strlen(t) + 1 AS size, sha256(t) AS h, t FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
c AS MATERIALIZED (SELECT h, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: list_transform([0, 1, 2, 3, 4, 5, 6, 7], lambda k: (('0x' || x)::BIGINT >> k) & 1)))),
    lambda a, b: xor(a >> 1, (xor(a, b) & 1) * 3988292384)), 4294967295) AS crc
  FROM (SELECT h, any_value(t) AS t FROM d GROUP BY h)),
g AS MATERIALIZED (SELECT h, total, row_number() OVER (ORDER BY total DESC, h) AS k FROM (SELECT h, sum(size)::BIGINT AS total FROM d GROUP BY h)),
f AS (SELECT 0::BIGINT AS k, NULL::VARCHAR AS h, NULL::BIGINT AS shard, list_transform(range({SHARDS}), lambda j: 0::BIGINT) AS loads
UNION ALL SELECT k, h, j, list_transform(loads, lambda x, i: CASE WHEN i = j THEN x + total ELSE x END)
  FROM (SELECT g.k, g.h, g.total, f.loads, list_position(f.loads, list_min(f.loads)) AS j FROM f JOIN g ON g.k = f.k + 1))
SELECT doc_id, size, crc AS text_crc32, 'bytes' AS law, (shard - 1)::INTEGER AS shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, h) - 1 AS slot, NULL::INTEGER AS grown_shard
  FROM d JOIN f USING (h) JOIN c USING (h)"""
