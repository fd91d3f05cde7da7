"""Structured Streaming over a folder in which producers land finished JSONL files."""

from __future__ import annotations

import time
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmill.sources import commits


def follow(spark: SparkSession, folder: str, schema: T.StructType, include_errors: bool = False) -> DataFrame:
    """Rows of new files; rows with an error are hidden unless asked for. Lines appended to a file already read are not seen:
    producers land whole files."""
    rows = spark.readStream.schema(schema).json(folder)
    return rows if include_errors else rows.where("coalesce(error, '') = ''")


def follow_until(rows: DataFrame, out: str, state: str, need: int, every_s: float = 15.0, longest_s: float | None = None) -> int:
    """Appends the streaming rows to the Parquet table `out`, until it has `need` rows; returns how many it has.

    The stream looks for new files each every_s seconds. Its state is kept, so that a later call goes on where one ended, after
    a loss or a stop, and takes no file twice; rows that were there before count. Too few rows after longest_s are an error.
    The table is counted at the start and once the rows that batches report, as they are written, seem enough; a batch that
    comes again after a failure reports its rows again, so that only the count decides.
    """
    spark, began = rows.sparkSession, time.monotonic()

    def have() -> int:
        try:
            return spark.read.schema(rows.schema).parquet(out).count()
        except AnalysisException:  # nothing written yet
            return 0

    n, reported, counted = have(), {}, set()
    query = rows.observe("followed", F.count(F.lit(1)).alias("n")).writeStream.format("parquet").option("checkpointLocation", state).trigger(processingTime=f"{max(1, round(every_s * 1000))} milliseconds").start(out)
    try:
        while n < need:
            over = query.awaitTermination(min(every_s, 1.0))  # raises what the stream failed of
            for p in query.recentProgress:
                if "followed" in p.observedMetrics and p.batchId not in counted:
                    reported[p.batchId] = p.observedMetrics["followed"].n
            late = longest_s is not None and time.monotonic() - began > longest_s
            if n + sum(reported.values()) >= need or over or late:
                counted |= set(reported)
                n, reported = have(), {}
            if n < need and late:
                raise ValueError(f"{n} rows after {longest_s} seconds, {need} are needed")
            if over:
                break
    finally:
        query.stop()
    return have()


def notices(events: DataFrame, every_rows: int, every_s: float, targets: str = "target", timer: bool = True) -> DataFrame:
    """From rows (run_id, at double, ok boolean, target) the notices due, by state for each run: started, done once,
    progress after every_rows, heartbeat after every_s with any growth. A timer gives the heartbeat where no further row comes
    within every_s; without `timer` there is none, as a stream that is to end with its data (availableNow) needs. Rows of a run in one micro-batch are put in order in memory, so a source should bound its batches
    (maxFilesPerTrigger)."""

    def step(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        n, last_n, last_at, started, done = state.get if state.exists else (0, 0, 0.0, False, False)
        out = []
        if state.hasTimedOut:
            if n > last_n:
                last_n, last_at = n, last_at + every_s
                out.append((key[0], "heartbeat", n, last_at))
            state.update((n, last_n, last_at, started, done))
            yield pd.DataFrame(out, columns=["run_id", "label", "successful", "at"])
            return
        for at, ok, target in sorted((r.at, r.ok, r.target) for pdf in batches for r in pdf.itertuples()):
            n += bool(ok)
            due = "started" if not started else "done" if n >= target and not done else "progress" if n >= last_n + every_rows else "heartbeat" if n > last_n and at - last_at >= every_s else None
            if due:
                started, done = True, done or due == "done"
                last_n, last_at = n, at
                out.append((key[0], due, n, at))
        state.update((n, last_n, last_at, started, done))
        if timer and n > last_n:
            state.setTimeoutDuration(max(1, round(every_s * 1000)))
        yield pd.DataFrame(out, columns=["run_id", "label", "successful", "at"])

    rows = events.select("run_id", F.col("at").cast("double").alias("at"), "ok", F.col(targets).alias("target"))
    return rows.groupBy("run_id").applyInPandasWithState(step, "run_id string, label string, successful long, at double", "n long, last_n long, last_at double, started boolean, done boolean", "append", "ProcessingTimeTimeout" if timer else "NoTimeout")


def deliver(due: DataFrame, log: str, state: str, run: str = "notices"):
    """A writer of streaming notices into a delivery log (sources.commits), each once: after a restart the state of `notices` goes on,
    and a micro-batch that comes again is not delivered again. The log's manifests count the notices by label."""
    labels = {k: F.count_if(F.col("label") == k) for k in ("started", "progress", "heartbeat", "done")}
    return commits.write_stream(due, log, state, run, labels)
