"""JSONL in and out."""

from __future__ import annotations

import json
import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmill.functions import text as tx
from quillmill.sources.shared import broadcast_if, cut

# Schemas as DDL, so that importing them needs no session.
TURN = "struct<role:string,content:string,messages:array<string>>"
CONVERSATION = f"id string, user string, category string, topic string, scenario string, user_spec map<string,string>, user_prompt_profile string, turns array<{TURN}>, poke_model string, user_model string, error string, total_prompt_tokens bigint, total_completion_tokens bigint"
QUESTION = "id string, prompt_type string, question string, prompt string, model string, source string, temperature double, top_p double"


def read_strict(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """Blank lines are skipped; a malformed one fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(paths)


def ordered_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(ordinal, input_ix, source_path, source_file, source_line from 1, line) of the lines that are not blank, in files of any size.

    The ordinal is the place of a line among all: by the place of the argument, then by the file's path (folders are read in sorted
    order), then by the line. Spark deals files to tasks by size, and splits them, so its own order says nothing; but it reads a
    block of a file in order, in one task, so that ids that grow by one from line to line give the place in the block. Sums over
    the blocks before, of which there is one row each (800,000 for 100 TB), give the rest.
    """
    block = [F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block")]
    one = lambda k, path: spark.read.option("lineSep", "\n").text(path).select(F.lit(k).alias("input_ix"), F.col("value").alias("line"), F.col("_metadata.file_name").alias("source_file"), *block)
    read = reduce(DataFrame.unionByName, (one(k, path) for k, path in enumerate(paths))).withColumn("_id", F.monotonically_increasing_id())
    blocks = read.groupBy("input_ix", "_path", "_block").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    named = blocks.withColumn("source_path", F.url_decode(F.replace("_path", F.lit("+"), F.lit("%2B"))))
    before = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.col("_first")
    starts = cut(named.withColumns({"_line": before(Window.partitionBy("input_ix", "source_path").orderBy("_block")), "_all": before(Window.orderBy("input_ix", "source_path", "_block"))}).drop("_first", "_n"))
    placed = read.join(broadcast_if(starts, 400), ["input_ix", "_path", "_block"]).where(F.trim("line") != "")
    return placed.select((F.col("_all") + F.col("_id")).alias("ordinal"), "input_ix", "source_path", "source_file", (F.col("_line") + F.col("_id") + 1).alias("source_line"), "line")


def lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(source_file, source_line from 1, line) of the lines that are not blank, in files of any size."""
    return ordered_lines(spark, [paths] if isinstance(paths, str) else paths).select("source_file", "source_line", "line")


PLACE = ["ordinal", "input_ix", "source_path", "source_file", "source_line"]


def judged(found: DataFrame) -> DataFrame:
    """found with _ok: whether its line is a JSON object."""
    return found.withColumn("_ok", F.coalesce(F.schema_of_variant(F.try_parse_json("line")).startswith("OBJECT"), F.lit(False)))


def read_ordered(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """Rows with their place: ordinal, input_ix, source_path, source_file, source_line and the line. A line that is no JSON object is an error, which
    names it."""
    place = F.concat(F.lit("invalid json in "), "source_path", F.lit(":"), F.col("source_line").cast("string"))
    whole = F.when(F.col("_ok"), F.col("line")).otherwise(F.raise_error(place).cast("string"))
    return judged(ordered_lines(spark, paths)).select(F.from_json(whole, schema).alias("_r"), *PLACE, "line").select("_r.*", *PLACE, "line")


def read_ordered_lenient(spark: SparkSession, paths: list[str], schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows with their place, error rows with their place and the line that is no JSON object)."""
    found = judged(ordered_lines(spark, paths))
    return found.where("_ok").select(F.from_json("line", schema).alias("_r"), *PLACE, "line").select("_r.*", *PLACE, "line"), found.where("NOT _ok").select(*PLACE, F.lit("invalid json").alias("error"), F.trim("line").alias("line"))


def merged(line: Column, fields: dict[str, Column]) -> Column:
    """A JSON object's text with further fields at its end, in place of those of the same name; all others stay as they are, nested
    ones too. Of a name that comes twice the later stays."""
    bare = lambda c: F.regexp_extract(F.to_json(F.array(c), {"ignoreNullFields": "false"}), r"(?s)^\[(.*)\]$", 1)
    entries = F.map_entries(F.from_json(line, "map<string,variant>"))
    kept = F.filter(entries, lambda e, i: ~e["key"].isin(*fields) & ~F.exists(F.slice(entries, i + 2, F.greatest(F.size(entries), F.lit(1))), lambda later: later["key"] == e["key"]))
    old = F.transform(kept, lambda e: F.concat(bare(e["key"]), F.lit(":"), F.to_json(e["value"])))
    return F.concat(F.lit("{"), F.array_join(F.concat(old, F.array(*(F.concat(bare(F.lit(k)), F.lit(":"), bare(c)) for k, c in fields.items()))), ","), F.lit("}"))


def write_lines(df: DataFrame, path: str, line: str = "line") -> None:
    """Lines as they are."""
    df.select(F.col(line).alias("value")).write.text(path)


def read_lenient(spark: SparkSession, paths: str | list[str], schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows with source_file and source_line, error rows with the line that is no JSON object)."""
    parsed = lines(spark, paths).withColumn("_r", F.from_json("line", schema)).withColumn("_ok", F.schema_of_variant(F.try_parse_json("line")).startswith("OBJECT"))
    good = parsed.where("_ok").select("_r.*", "source_file", "source_line")
    bad = parsed.where("NOT coalesce(_ok, false)").select("source_file", "source_line", F.lit("invalid json").alias("error"), "line")
    return good, bad


def read_in_order(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """Several inputs as one, with input_ix, the place of the argument; a malformed line fails the job."""
    parts = [read_strict(spark, p, schema).withColumn("input_ix", F.lit(k)) for k, p in enumerate(paths)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_split(df: DataFrame, outputs: dict[str, Column], mode: str = "errorifexists") -> None:
    """The rows that meet a condition go to its path; a row can go to several. df is computed once."""
    df = cut(df)
    for path, condition in outputs.items():
        write_jsonl(df.where(condition), path, mode)


def write_answers(judged: DataFrame, path: str) -> dict[str, str]:
    """Three outputs of judged answers (ok, ...): all as they came, those kept and those rejected; returns their paths."""
    paths = output_paths(path)
    ok = F.coalesce(F.col("ok"), F.lit(False))
    write_split(judged, {path: ok, paths["raw"]: F.lit(True), paths["answers_rejected"]: ~ok})
    return {"kept": path, "raw": paths["raw"], "rejected": paths["answers_rejected"]}


def output_paths(path: str) -> dict[str, str]:
    return {"accepted": f"{path}.no_echo.jsonl", "rejected": f"{path}.echo_rejected.jsonl", "raw": f"{path}.raw.jsonl", "answers_rejected": f"{path}.rejected.jsonl", "manifest": f"{path}.manifest.json"}


def pretty(id_: Column, file: Column, category: Column, profile: Column, topic: Column, error: Column, turns: Column) -> Column:
    """A conversation as text: a head, then each turn under its speaker."""
    shown = lambda c: F.coalesce(c.cast("string"), F.lit("None"))
    line = lambda name, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(name), c))
    head = F.concat(F.lit("id="), shown(id_), F.lit("  file="), shown(file), F.lit("  category="), shown(category), F.lit("  profile="), shown(profile))
    said = lambda t: F.when(tx.strip(F.coalesce(t["content"], F.lit(""))) != "", tx.strip(t["content"])).otherwise("[empty]")
    body = F.transform(turns, lambda t: F.concat(F.lit("\n"), F.when(t["role"] == "assistant", "POKE").otherwise("USER"), F.lit(":\n"), said(t)))
    return F.concat_ws("\n", F.lit("=" * 100), head, line("topic: ", topic), line("ERROR: ", error), F.lit("-" * 100), F.array_join(body, "\n"))


def read_document(path: str) -> dict:
    """A small JSON file of settings or state, read by the driver; {} where it is missing or broken."""
    try:
        with open(path, encoding="utf-8") as f:
            return json.load(f)
    except (OSError, json.JSONDecodeError):
        return {}


def read_settings(path: str) -> dict[str, str]:
    """KEY=VALUE lines of a settings file, quotes stripped; comments and other lines are skipped. Variables of the environment
    that are set win."""
    found = {}
    with open(path, encoding="utf-8") as f:
        for key, given, value in (line.strip().partition("=") for line in f):
            if given and not key.startswith("#"):
                found[key.strip()] = os.environ.get(key.strip(), value.strip().strip("\"'"))
    return found


def write_document(path: str, value: dict) -> None:
    """Written beside its place, then moved there, so that no reader sees half of it."""
    with open(f"{path}.tmp", "w", encoding="utf-8") as f:
        json.dump(value, f, ensure_ascii=False, indent=2)
    os.replace(f"{path}.tmp", path)


def read_prompt(path: str, shortest: int = 200) -> str:
    with open(path, encoding="utf-8") as f:
        text = f.read().strip()
    if len(text) < shortest:
        raise ValueError(f"{path} has {len(text)} characters; a prompt has {shortest} at least")
    return text
