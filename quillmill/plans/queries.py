"""The queries of the library, by name, and DuckDB SQL for those that have it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.functions import text as tx
from quillmill.operators import answers, conversations, echo, selection, status
from quillmill.plans import conversation_sql as cs
from quillmill.plans import run_queries


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def w1_first_wins_dedupe(spark, sf_dir):
    return selection.dedupe_questions(read(spark, sf_dir, "documents").select("doc_id", "text"), "text", "doc_id").select("doc_id", "dedupe_key")


def j1_top_up(spark, sf_dir):
    keyed = lambda df: df.withColumn("dedupe_key", tx.dedupe_key(tx.first_of(F.col("text"))))
    source = keyed(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return selection.top_up(keyed(read(spark, sf_dir, "benchmark")), source, "doc_id").select("doc_id", "dedupe_key")


def j7_previous_user(spark, sf_dir):
    return conversations.with_previous_user(read(spark, sf_dir, "conversations")).where("role = 'assistant'").select("conv_id", "turn", "user_text")


def l4_echo_audit(spark, sf_dir):
    return conversations.audit(read(spark, sf_dir, "conversations")).where("reason IS NOT NULL").select("conv_id", "turn", "reason")


def a7_echo_rate(spark, sf_dir):
    return conversations.audit_summary(read(spark, sf_dir, "conversations"))


def quality(spark, sf_dir):
    return conversations.with_quality(conversations.nested(read(spark, sf_dir, "conversations"), 14))


def j3_accepted_turns(spark, sf_dir):
    accepted, rejected = conversations.split_by_audit(read(spark, sf_dir, "conversations"))
    return accepted.select("conv_id", "turn", F.lit(True).alias("accepted")).unionByName(rejected.select("conv_id", "turn", F.lit(False).alias("accepted")))


def c1_clean_rows(spark, sf_dir):
    return quality(spark, sf_dir).select("conv_id", "n_turns", "reason")


WHOLE = "coalesce(salvaged_from_turns, 0) AS salvaged_from_turns"  # 0 where nothing was cut off


def c2_salvage(spark, sf_dir):
    return conversations.salvaged(quality(spark, sf_dir)).selectExpr("conv_id", "kept_turns", WHOLE)


def w5_balanced_selection(spark, sf_dir):
    rows = conversations.salvaged(quality(spark, sf_dir)).select("conv_id", "kept_turns")
    return selection.stratified(rows, "kept_turns", selection.quotas(500, cs.TURN_WEIGHTS), 500, "conv_id", "conv_id")


def l3_training_records(spark, sf_dir):
    rows = conversations.salvaged(quality(spark, sf_dir))
    return conversations.training_records(rows).select("source_id", "target_turn_index", "turns", F.expr(WHOLE), F.to_json("messages").alias("messages"))


def e2_chat_records(spark, sf_dir):
    rows = conversations.salvaged(quality(spark, sf_dir))
    return conversations.training_records(rows, cs.SYSTEM, explode=False).select("source_id", "turns", F.expr(WHOLE), F.to_json("messages").alias("messages"))


def c3_replay(spark, sf_dir):
    return conversations.replay(read(spark, sf_dir, "conversations"), 4).select("conv_id", "turn", "error")


def c4_next_fit(spark, sf_dir):
    rows = read(spark, sf_dir, "conversations").withColumn("cost", tx.estimate_tokens(F.coalesce("text", F.lit(""))))
    return selection.next_fit(rows.select("conv_id", "turn", "cost"), "conv_id", "turn", "cost", 4, 400).select("conv_id", "turn", "batch")


def c5_fixed_batches(spark, sf_dir):
    return selection.fixed_batches(read(spark, sf_dir, "documents").select("source", "doc_id"), 10, "doc_id", "source")


def p7_answer_validity(spark, sf_dir):
    return read(spark, sf_dir, "conversations").where("role = 'assistant'").select("conv_id", "turn", answers.answer_reason(F.col("text")).alias("reason"))


def f4_significant_tokens(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.size(tx.significant_tokens(F.coalesce("text", F.lit("")))).cast("long").alias("n_tokens"), F.size(tx.echo_words(F.coalesce("text", F.lit("")))).cast("long").alias("n_echo_words"))


def f19_estimate_tokens(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", tx.estimate_tokens(F.coalesce("text", F.lit(""))).alias("tokens"))


def a1_histogram(spark, sf_dir):
    return status.histogram(read(spark, sf_dir, "documents"), "source", "doc_id")


def a12_profile(spark, sf_dir):
    """User texts with the assistant's answers to them."""
    pairs = conversations.with_previous_user(read(spark, sf_dir, "conversations")).where("role = 'assistant' AND user_text IS NOT NULL")
    return status.profile(pairs.select(F.col("user_text").alias("text"), F.col("text").alias("answer")), "text", "answer")


def a11_review_counts(spark, sf_dir):
    labels = read(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "accept").otherwise("reject").alias("decision"))
    return read(spark, sf_dir, "documents").select("doc_id").join(labels, "doc_id", "left").groupBy(F.coalesce("decision", F.lit("absent")).alias("decision")).agg(F.count("*").alias("n"))


PROFILES = ["casual", "curious", "terse", "warm", "dry"]


def w7_shard_plan(spark, sf_dir):
    """A plan of as many rows as there are documents, and which documents each shard takes, in order."""
    docs = read(spark, sf_dir, "documents").select("doc_id", F.lit(0).alias("part"))
    n = docs.count()
    plan = selection.shard_plan(spark, n, 48, PROFILES, 1000)
    placed = selection.numbered(docs, "part", "doc_id", "place").withColumn("ix", selection.shard_of(n, 48, F.col("place")))
    return placed.join(F.broadcast(plan), "ix").select("doc_id", "ix", "profile", "target", "seed", "name")


def r6_misassigned(spark, sf_dir):
    turns = conversations.with_previous_user(read(spark, sf_dir, "conversations")).where("role = 'assistant' AND user_text IS NOT NULL")
    items = turns.select(F.floor(F.col("conv_id") / 8).alias("batch_id"), F.format_string("%d-%d", "conv_id", "turn").alias("item_id"), F.col("user_text").alias("user"), F.lit(None).cast("string").alias("topic"), F.col("text").alias("reply"))
    return echo.misassigned(items).select("batch_id", "item_id", "own", "best_other", "suspicious")


QUERIES = {f.__name__: f for f in (w1_first_wins_dedupe, j1_top_up, j7_previous_user, l4_echo_audit, a7_echo_rate, j3_accepted_turns, c1_clean_rows, c2_salvage, w5_balanced_selection, l3_training_records, e2_chat_records, c3_replay, c4_next_fit, c5_fixed_batches, p7_answer_validity, f4_significant_tokens, f19_estimate_tokens, a1_histogram, a12_profile, a11_review_counts, w7_shard_plan, r6_misassigned)} | run_queries.QUERIES

ORACLE_SQL = cs.SQL | run_queries.ORACLE_SQL | {
    "w1_first_wins_dedupe": f"""SELECT min(doc_id) AS doc_id, dedupe_key
  FROM (SELECT doc_id, {cs.KEY} AS dedupe_key
  FROM documents
  WHERE regexp_replace(coalesce(text, ''), '^\\s+|\\s+$', '', 'g') <> '')
  GROUP BY dedupe_key""",
    "j1_top_up": f"""SELECT min(doc_id) AS doc_id, dedupe_key
  FROM (SELECT doc_id, {cs.KEY} AS dedupe_key
  FROM documents)
  WHERE dedupe_key <> '' AND dedupe_key NOT IN (SELECT {cs.KEY}
  FROM benchmark)
  GROUP BY dedupe_key""",
    "c4_next_fit": """WITH RECURSIVE r AS (SELECT conv_id, turn, greatest(1, CAST(ceil(len(coalesce(text, '')) / 4) AS BIGINT)) AS cost, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations),
f AS (SELECT conv_id, turn, k, 1 AS items, cost AS used, CAST(0 AS BIGINT) AS batch FROM r WHERE k = 1
UNION ALL SELECT r.conv_id, r.turn, r.k, CASE WHEN f.items + 1 > 4 OR f.used + r.cost + 2 > 400 THEN 1 ELSE f.items + 1 END, CASE WHEN f.items + 1 > 4 OR f.used + r.cost + 2 > 400 THEN r.cost ELSE f.used + r.cost + 2 END, CASE WHEN f.items + 1 > 4 OR f.used + r.cost + 2 > 400 THEN f.batch + 1 ELSE f.batch END FROM f JOIN r ON r.conv_id = f.conv_id AND r.k = f.k + 1)
SELECT conv_id, turn, batch FROM f""",
    "c5_fixed_batches": """SELECT source, doc_id, (k // 10) AS batch, (k % 10) AS local_id
  FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS k
  FROM documents)""",
    "p7_answer_validity": f"""SELECT conv_id, turn, CASE WHEN bit IS NOT NULL THEN 'contains ' || bit WHEN regexp_matches(a, '[\\x{{1F300}}-\\x{{1FAFF}}]') THEN 'emoji' WHEN trim(a) = '' THEN 'empty' WHEN len(regexp_extract_all(a, '\\S+')) > 55 THEN 'too_long' ELSE 'ok' END AS reason
FROM (SELECT conv_id, turn, a, list_filter([{cs.listed(answers.BAD_BITS)}], lambda b: contains(a, b))[1] AS bit FROM (SELECT conv_id, turn, lower(coalesce(text, '')) AS a FROM conversations WHERE role = 'assistant'))""",
    "f4_significant_tokens": f"""SELECT doc_id, len({cs.significant("coalesce(text, '')")}) AS n_tokens, len({cs.echo_words(cs.words("coalesce(text, '')"))}) AS n_echo_words
  FROM documents""",
    "f19_estimate_tokens": "SELECT doc_id, greatest(1, CAST(ceil(len(coalesce(text, '')) / 4) AS BIGINT)) AS tokens FROM documents",
    "a1_histogram": "SELECT source, count(*) AS n, min(doc_id) AS first_seen FROM documents GROUP BY source",
    "a12_profile": f"""SELECT count(*) AS rows, avg(len(regexp_extract_all(user_text, '[^\\x20\\x09-\\x0D]+'))) AS mean_words, avg(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))) AS mean_answer_words,
    count(*) FILTER (WHERE contains(user_text, '?')) AS with_question_mark
  FROM ({cs.PREVIOUS})
  WHERE role = 'assistant' AND user_text IS NOT NULL""",
    "a11_review_counts": """SELECT coalesce(CASE WHEN quality = 1 THEN 'accept' WHEN quality IS NOT NULL THEN 'reject' END, 'absent') AS decision, count(*) AS n
  FROM documents
  LEFT JOIN labels USING (doc_id)
  GROUP BY 1""",
    "w7_shard_plan": f"""WITH n AS (SELECT count(*) AS n FROM documents),
p AS (SELECT ix, [{cs.listed(PROFILES)}][ix % 5 + 1] AS profile, n // 48 + (ix < n % 48)::BIGINT AS target, 1000 + ix AS seed FROM n, range(48) t(ix)),
b AS (SELECT *, format('shard_{{:04d}}_{{}}', ix, profile) AS name, sum(target) OVER (ORDER BY ix) AS e FROM p)
SELECT doc_id, ix, profile, target, seed, name FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS k FROM documents) JOIN b ON k > e - target AND k <= e""",
}
