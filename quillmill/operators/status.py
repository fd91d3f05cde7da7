"""Counts and progress of runs."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions import text as tx

OK = "coalesce(cast(id AS string), '') <> '' AND coalesce(error, '') = ''"


def shard_status(plan: DataFrame, rows: DataFrame) -> DataFrame:
    """plan (ix, target, ...) with rows, successful (distinct ids), errors (all other rows, so duplicates too) and done."""
    counts = rows.groupBy("shard").agg(F.count("*").alias("rows"), F.countDistinct(F.when(F.expr(OK), F.col("id"))).alias("successful"))
    out = plan.join(counts, plan["ix"] == counts["shard"], "left").drop("shard").fillna(0, ["rows", "successful"])
    return out.withColumns({"errors": F.greatest(F.lit(0), F.col("rows") - F.col("successful")), "done": F.col("successful") >= F.col("target")})


def run_totals(status: DataFrame) -> DataFrame:
    return status.agg(*(F.sum(c).alias(c) for c in ("target", "rows", "successful", "errors")), F.count_if("done").alias("done_shards"), F.count("*").alias("total_shards"))


def notifier_status(rows: DataFrame, target: int) -> DataFrame:
    """As the notifier counts: successful rows, not distinct ids."""
    ok = F.count_if(F.coalesce(F.col("error"), F.lit("")) == "")
    return rows.agg(F.count("*").alias("rows"), ok.alias("successful"), (F.count("*") - ok).alias("errors"), (100.0 * ok / max(1, target)).alias("pct"))


def histogram(df: DataFrame, column: str, ordinal: str) -> DataFrame:
    """Counts by value, most common first, ties by first appearance."""
    return df.groupBy(column).agg(F.count("*").alias("n"), F.min(ordinal).alias("first_seen")).orderBy(F.desc("n"), "first_seen")


def n_words(c: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))


def profile(df: DataFrame, text: str, answer: str | None = None) -> DataFrame:
    """Rows, mean words (of the answers too, if there are any), and how many texts have a question mark."""
    means = [F.avg(n_words(F.col(text))).alias("mean_words"), *([F.avg(n_words(F.col(answer))).alias("mean_answer_words")] if answer else [])]
    return df.agg(F.count("*").alias("rows"), *means, F.count_if(F.contains(F.col(text), F.lit("?"))).alias("with_question_mark"))


def common_starts(df: DataFrame, text: str, words: int, most: int) -> DataFrame:
    """(start, n): the `most` most common beginnings of so many words, in lower case; ties in the order of the letters."""
    first = F.slice(F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != ""), 1, words)
    starts = df.select(first.alias("w")).where(F.size("w") == words).groupBy(F.array_join("w", " ").alias("start")).agg(F.count("*").alias("n"))
    return starts.orderBy(F.desc("n"), "start").limit(most)


def combinations(axes: dict[str, list]) -> int:
    """How many rows can be drawn that differ."""
    return math.prod(len(set(v)) for v in axes.values())


def dedupe_counters(df: DataFrame, kept: DataFrame) -> DataFrame:
    """(read, kept, duplicates); empty questions count as duplicates."""
    one = df.agg(F.count("*").alias("read")).crossJoin(kept.agg(F.count("*").alias("kept")))  # one row each
    return one.withColumn("duplicates", F.col("read") - F.col("kept"))


def length_bands(df: DataFrame, text: str, bounds: list[int]) -> DataFrame:
    """(band, n): how many texts have a number of words up to the first bound, the second, ..., or beyond all."""
    n_words = F.size(tx.split_words(F.coalesce(F.col(text), F.lit(""))))
    band = F.lit(len(bounds))
    for k, most in reversed(list(enumerate(bounds))):
        band = F.when(n_words <= most, k).otherwise(band)
    return df.groupBy(band.alias("band")).agg(F.count("*").alias("n"))


def notice_text(label: Column, successful: Column, target: Column, rows: Column, errors: Column, shards: Column) -> Column:
    share = 100.0 * successful / F.greatest(F.lit(1), target)
    return F.format_string("%s: %d/%d (%.1f%%), rows=%d, errors=%d, shards_seen=%d", label, successful, target, share, rows, errors, shards)


def reviewed(rows: DataFrame, decisions: DataFrame, ordinal: str, start: int = 1, key: str = "id") -> dict[str, DataFrame]:
    """Rows by what reviewers decided: accepted (as they came), rejected (with review_note), reviews (id, decision, profile,
    category, note) and remaining (from the start-th row on, without a decision).

    decisions is an append log (id, decision, note, at): of several on a row the latest counts, of two at the same time the
    rejection, then the later note; `skip` and an unknown decision count as none. A null id has decisions of its own.
    The log is pre-aggregated to one entry for each id before it meets the rows.
    """
    known = decisions.where(F.col("decision").isin("accept", "reject"))
    latest = known.groupBy(F.col(key).alias("_key")).agg(F.max(F.struct(F.col("at"), (F.col("decision") == "reject").alias("no"), F.coalesce("note", F.lit("")).alias("note"))).alias("_last"))
    at = rows.join(latest, F.col(key).eqNullSafe(F.col("_key")), "left")
    own = [F.col(f"`{c}`") for c in rows.columns]
    profile = F.coalesce(*(F.col(c) for c in ("sweep_profile", "user_prompt_profile") if c in rows.columns), F.lit(None).cast("string"))
    category = F.col("category") if "category" in rows.columns else F.lit(None).cast("string")
    return {
        "accepted": at.where("NOT _last.no").select(*own),
        "rejected": at.where("_last.no").select(*own, F.col("_last.note").alias("review_note")),
        "reviews": at.where("_last IS NOT NULL").select(F.col(key).alias("id"), F.when(F.col("_last.no"), "reject").otherwise("accept").alias("decision"), profile.alias("profile"), category.alias("category"), F.when(F.col("_last.no"), F.col("_last.note")).otherwise("").alias("note")),
        "remaining": at.where(F.col("_last").isNull() & (F.col(ordinal) >= start)).select(*own),
    }
