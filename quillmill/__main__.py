"""The jobs from the command line: python -m quillmill JOB --help."""

from __future__ import annotations

import argparse
import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from quillmill.functions import text as tx
from quillmill.operators import answers, conversations, echo, selection, status
from quillmill.sources import growing, jsonl, shared
from quillmill.sources.shared import cut

#: Shares of conversations by their number of turns.
TURN_WEIGHTS = {4: 0.20, 6: 0.30, 8: 0.30, 10: 0.067, 12: 0.067, 14: 0.066}


def in_order(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """Rows of several inputs with ordinal, their place in the order of arguments and, within one, of files and lines."""
    return cut(jsonl.read_ordered(spark, paths, schema))


def dedupe(spark: SparkSession, args: argparse.Namespace) -> dict:
    """The first of each question, with all its fields."""
    rows = in_order(spark, args.input, jsonl.QUESTION)
    kept = selection.dedupe_questions(rows, ["question", "prompt"], "ordinal")
    kept = cut(kept.orderBy("ordinal").limit(args.limit) if args.limit else kept)
    jsonl.write_lines(kept.orderBy("ordinal").withColumn("line", jsonl.merged(F.col("line"), {"question": F.col("question"), "dedupe_key": F.col("dedupe_key")})), args.out)
    read, n = rows.count(), kept.count()
    return {"read": read, "kept": n, "duplicates": max(0, read - n)}


def top_up(spark: SparkSession, args: argparse.Namespace) -> dict:
    """New questions, each once, that the existing ones don't have."""
    keyed = lambda df, *order: df.withColumn("question", tx.first_set(*map(F.col, order))).withColumn("dedupe_key", tx.dedupe_key(F.col("question")))
    old = keyed(jsonl.read_strict(spark, args.existing, jsonl.QUESTION), "question", "prompt")
    new = keyed(in_order(spark, args.input, jsonl.QUESTION), "prompt", "question")
    found = selection.numbered(selection.top_up(old, new, "ordinal", args.count, exact=True).withColumn("part", F.lit(0)), "part", "ordinal", "k")
    rows = found.orderBy("k").select(F.format_string(f"{args.name}-%05d", "k").alias("id"), F.lit(args.prompt_type).alias("prompt_type"), "question", F.lit(args.source).alias("source"), F.col("id").alias("source_question_id"), "dedupe_key")
    jsonl.write_jsonl(rows, args.out)
    return {"kept": args.count}


def audit(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Conversations are judged as they lie in the rows: each assistant turn against the user turn before it. All rows of an id
    with an echo are rejected; rows without an id go together."""
    rows = in_order(spark, args.input, "id string, turns array<struct<role:string,content:string>>")
    issues, checked = conversations.row_issues(rows)
    name, issues = F.coalesce("id", F.lit("None")), cut(issues)
    judged = cut(rows.join(issues.select(F.col("id").alias("_bad")).distinct(), name == F.col("_bad"), "left").select("ordinal", "line", F.col("_bad").isNotNull().alias("echo")))
    paths = jsonl.output_paths(args.out)
    for path, echoes in ((args.accepted or paths["accepted"], False), (args.rejected or paths["rejected"], True)):
        jsonl.write_lines(judged.where(F.col("echo") == echoes).orderBy("ordinal"), path)
    listed = issues.orderBy("ordinal", "turn").drop("ordinal")
    if args.issues:
        jsonl.write_jsonl(listed, args.issues)
    counts = checked.first().asDict()
    for r in listed.limit(args.max_examples).collect():
        print(json.dumps(r.asDict(), ensure_ascii=False))
    args.exit = int(args.fail_on_issues and counts["issues"] > 0)
    return counts


def export(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Clean conversations, or their clean beginnings, in the balance of turns asked for, as records of training; a manifest beside
    them. Broken lines are skipped. The manifest's counts are observed while the rows are judged and the records written."""
    folder, began = shared.folder(spark, "export"), time.monotonic()
    while True:
        rows, _ = jsonl.read_ordered_lenient(spark, args.input, jsonl.CONVERSATION)
        whole = conversations.of_rows(rows.select("ordinal", "id", "category", "topic", "source_file", "source_line", "error", "turns"), args.max_turns)
        out = f"{folder}/{time.monotonic_ns()}"
        seen = conversations.write_clean(whole, out, args.min_turns, args.max_turns, args.strict_quality)
        if seen["eligible"] >= args.limit or not args.wait or (args.longest is not None and time.monotonic() - began > args.longest):
            break
        time.sleep(args.poll_seconds)
    if seen["eligible"] < args.limit:
        raise ValueError(f"only {seen['eligible']} clean rows available, {args.limit} are needed")
    clean = spark.read.parquet(out).withColumns({"turns": F.slice("turns", F.lit(1), F.col("kept_turns")), "id_": F.coalesce("id", F.lit("None"))})
    if args.balance_turns:
        chosen = selection.stratified(clean, "kept_turns", selection.quotas(args.limit, TURN_WEIGHTS), args.limit, "ordinal", "id_")
    else:
        chosen = clean.orderBy("ordinal").limit(args.limit).withColumn("selection_pass", F.lit(1))
    system = jsonl.read_prompt(args.system_prompt) if args.system_prompt else None
    ordered, counts = conversations.observe_selection(cut(chosen).orderBy("selection_pass", "ordinal"))
    written = Observation()
    records = conversations.export_records(ordered, system, args.explode)
    jsonl.write_jsonl(records.observe(written, F.count(F.lit(1)).alias("records")), args.out)
    manifest = {
        "output": args.out, "source_shards": args.input, "limit": args.limit, "records_written": written.get["records"], "balance_turns": args.balance_turns, "explode_assistant_turns": args.explode,
        "include_system": bool(system), "strict_quality": args.strict_quality, **counts(), **seen, "created_at": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()),
    }
    jsonl.write_document(args.manifest or jsonl.output_paths(args.out)["manifest"], manifest)
    return manifest


def combine(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Shards of a run, named shard_<number>_<profile>.jsonl, as one set: the first success of each id, with run and shard; and
    all errors, with the lines that are no JSON."""
    lines = cut(jsonl.judged(jsonl.ordered_lines(spark, args.input)))
    tag = {"shard": F.regexp_extract("source_file", r"^shard_(\d+)_", 1).cast("int"), "shard_profile": F.regexp_extract("source_file", r"^shard_\d+_(.*)\.jsonl$", 1)}
    rows = lines.where("_ok").select("ordinal", F.from_json("line", "id string, error string").alias("r"), jsonl.merged(F.col("line"), {"run_id": F.lit(args.run_id), **tag}).alias("line")).select("ordinal", "r.*", "line")
    rows = selection.combine(rows, "ordinal").select("ordinal", "line", (F.coalesce("error", F.lit("")) != "").alias("failed"))
    broken = lines.where("NOT _ok").select("ordinal", F.to_json(F.struct(tag["shard"].alias("shard"), tag["shard_profile"].alias("profile"), F.lit("invalid json").alias("error"), F.trim("line").alias("line"))).alias("line"), F.lit(True).alias("failed"))
    every = cut(rows.unionByName(broken))
    counts = {}
    for name, failed in (("dataset", False), ("errors", True)):
        seen = Observation()
        jsonl.write_lines(every.where(F.col("failed") == failed).orderBy("ordinal").observe(seen, F.count(F.lit(1)).alias("n")), f"{args.out}/{name}.jsonl")
        counts[name] = seen.get["n"]
    state = {"run_id": args.run_id, "dataset": f"{args.out}/dataset.jsonl", "errors": f"{args.out}/errors.jsonl", "successful": counts["dataset"], "errors_count": counts["errors"], "combined_at": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())}
    jsonl.write_document(f"{args.out}/combined_status.json", state)
    return state


def review(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Rows by the latest decision on each in a log of (id, decision, note): accepted, rejected with review_note, and reviews."""
    rows = in_order(spark, args.input, "id string, sweep_profile string, user_prompt_profile string, category string")
    log = jsonl.read_ordered(spark, args.decisions, "id string, decision string, note string").withColumn("at", F.col("ordinal")).select("id", "decision", "note", "at")
    found = status.reviewed(rows.withColumn("row", F.row_number().over(Window.orderBy("ordinal"))) if args.start > 1 else rows.withColumn("row", F.lit(1)), log, "row", args.start)
    jsonl.write_lines(found["accepted"].orderBy("ordinal"), f"{args.out}.accepted.jsonl")
    jsonl.write_lines(found["rejected"].orderBy("ordinal").withColumn("line", jsonl.merged(F.col("line"), {"review_note": F.col("review_note")})), f"{args.out}.rejected.jsonl")
    jsonl.write_jsonl(found["reviews"], f"{args.out}.reviews.jsonl")
    return {k: found[k].count() for k in ("accepted", "rejected", "remaining")}


def follow(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Shows the conversations that a file or folder gains, until stopped; with --once those that are there."""
    rows = growing.follow_growing(spark, args.input[0], jsonl.CONVERSATION, args.from_start or args.once, "wait", args.include_errors)
    none = F.lit(None).cast("string")
    said = F.when(F.col("turns").isNotNull(), F.col("turns")).otherwise(F.array(F.struct(F.lit("user").alias("role"), F.col("line").alias("content"), F.lit(None).cast("array<string>").alias("messages"))))
    shown = rows.select(jsonl.pretty(F.col("id"), F.col("source_file"), F.col("category"), F.col("user_prompt_profile"), F.col("topic"), F.col("error") if args.include_errors else none, said).alias("shown"))

    def show(df: DataFrame, _: int) -> None:
        for r in df.toLocalIterator():  # a terminal's worth, row by row
            print(r["shown"], flush=True)

    writer = shown.writeStream.foreachBatch(show).option("checkpointLocation", args.out)
    query = (writer.trigger(availableNow=True) if args.once else writer.trigger(processingTime="1 second")).start()
    query.awaitTermination()
    return {}


def refilter(spark: SparkSession, args: argparse.Namespace) -> dict:
    rows = in_order(spark, args.input, "ix bigint, user string, answer string")
    judged = cut(answers.refilter(rows, "user", "answer", "ordinal", args.limit))
    jsonl.write_answers(judged.drop(*jsonl.PLACE, "line"), args.out)
    return {r["reason"]: r["count"] for r in judged.groupBy("reason").count().collect()}  # as many rows as reasons


def replies(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Why single replies, as (user, reply) pairs, echo."""
    judged = echo.with_echo_reason(in_order(spark, args.input, "user string, reply string"), "user", "reply", "reason", "audit")
    jsonl.write_jsonl(judged.orderBy("ordinal").drop(*jsonl.PLACE, "line"), args.out)
    return {}


def main(given: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="quillmill", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    made: dict[str, Callable[[SparkSession, argparse.Namespace], dict]] = {f.__name__: f for f in (dedupe, top_up, audit, export, combine, review, follow, refilter, replies)}
    for name, job in made.items():
        p = jobs.add_parser(name.replace("_", "-"), help=job.__doc__)
        p.set_defaults(run=job)
        p.add_argument("--input", nargs="+", required=True)
        p.add_argument("--out", required=True)
        if name in ("dedupe", "refilter"):
            p.add_argument("--limit", type=int, default=0)
        if name == "top_up":
            p.add_argument("--existing", nargs="+", required=True)
            p.add_argument("--count", type=int, required=True)
            p.add_argument("--name", default="topup", help="what new ids begin with")
            p.add_argument("--prompt-type", default="dataset_topup")
            p.add_argument("--source", default="prompt_topup")
        if name == "audit":
            p.add_argument("--max-examples", type=int, default=20)
            p.add_argument("--fail-on-issues", action="store_true")
            p.add_argument("--issues", help="where to write the issues: id, source, line, turn, reason and both texts")
            p.add_argument("--accepted")
            p.add_argument("--rejected")
        if name == "export":
            p.add_argument("--limit", type=int, default=10_000)
            p.add_argument("--system-prompt")
            p.add_argument("--explode", action="store_true", help="a record for each assistant turn")
            p.add_argument("--no-balance-turns", dest="balance_turns", action="store_false")
            p.add_argument("--min-turns", type=int, default=4)
            p.add_argument("--max-turns", type=int, default=14)
            p.add_argument("--strict-quality", action=argparse.BooleanOptionalAction, default=True, help="reject echoes, repeats and leaks as well")
            p.add_argument("--manifest")
            p.add_argument("--wait", action="store_true", help="until there are enough clean rows")
            p.add_argument("--poll-seconds", type=float, default=60)
            p.add_argument("--longest", type=float, help="seconds to wait at most")
        if name == "combine":
            p.add_argument("--run-id", required=True)
        if name == "review":
            p.add_argument("--decisions", nargs="+", required=True)
            p.add_argument("--start", type=int, default=1)
        if name == "follow":
            p.add_argument("--from-start", action="store_true")
            p.add_argument("--include-errors", action="store_true")
            p.add_argument("--once", action="store_true")
    args = parser.parse_args(given)
    spark = SparkSession.builder.appName(f"quillmill {args.job}").getOrCreate()
    result = args.run(spark, args)
    print(json.dumps(result, ensure_ascii=False))
    if getattr(args, "exit", 0):
        raise SystemExit(args.exit)


if __name__ == "__main__":
    main()
