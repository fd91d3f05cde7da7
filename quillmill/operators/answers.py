"""Answers of a model as an input table: validity, parsing of batch replies and of question lists."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmill.functions import text as tx

# Parts that make an answer invalid; the first in this order gives the reason.
BAD_BITS = [
    "<think>", "imagenew", "user:", "assistant:", "as an ai", "language model", "that's a great question", "what a great question", "i don't actually", "i do not actually", "i don't have",
    "i do not have", "i don’t have", "i don't really", "i do not really", "i don’t really", "don't really have", "do not really have", "i don't do", "i do not do", "i don’t do", "i don't need",
    "i do not need", "i don’t need", "i'm not really", "i am not really", "i don't unwind", "i do not unwind", "i'm just here", "i am just here", "i'm here to", "i am here to",
    "i can help you", "i can suggest", "just providing info", "providing info", "more about providing", "just helping", "no hobbies", "no animal adventures", "happy to chat about", "no reading list",
    "no opinions", "not really about", "not really for me", "not really, i'm", "not really, i’m", "not really, i am", "neither, just", "nothing recently", "not recall personal", "not remember personal",
    "if you want", "if you'd like", "if you need", "do you want me", "personal preferences", "personal experiences", "no personal", "none, i don't", "none, i do not", "none, i don’t",
    "i don't take", "i do not take", "i don’t take", "i don't travel", "i do not travel", "i don’t travel", "no secret talents", "no favorite", "no favourite", "no memories", "made to assist",
    "just chat", "no classes", "haven't met", "have not met", "no, haven't", "no, have not", "no, i haven't", "no, i have not", "honestly, i'm not", "honestly, i’m not", "that's hardcore", "my friends", "my family", "my childhood",
]


def answer_reason(answer: Column) -> Column:
    """`ok`, or why an answer is invalid."""
    plain = F.lower(F.coalesce(answer, F.lit("")))
    hit = F.try_element_at(F.filter(F.array(*map(F.lit, BAD_BITS)), lambda b: F.contains(plain, b)), F.lit(1))
    return F.when(hit.isNotNull(), F.concat(F.lit("contains "), hit)).when(plain.rlike(r"[\x{1F300}-\x{1FAFF}]"), "emoji").when(tx.strip(plain) == "", "empty").when(F.size(tx.split_words(plain)) > 55, "too_long").otherwise("ok")


def split_answers(rows: DataFrame, answer: str, filtered: bool = True) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) with ok and reason; unfiltered, any answer that is not blank is kept."""
    reason = answer_reason(F.col(answer)) if filtered else F.when(tx.strip(F.coalesce(F.col(answer), F.lit(""))) == "", "empty").otherwise("unfiltered")
    judged = rows.withColumn("reason", reason).withColumn("ok", F.col("reason").isin("ok", "unfiltered"))
    return judged.where("ok"), judged.where("NOT ok")


def _last_wins(entries: Column) -> Column:
    """A map of entries (id, v); of equal ids the last holds."""
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.greatest(F.size(entries), F.lit(1))), lambda x: x["id"] == e["id"]))
    return F.map_from_entries(last)


def _text(v: Column) -> Column:
    """A variant's string; null for any other kind."""
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))


def parse_batch_answers(raw: Column) -> Column:
    """A map from id to answer: the list `answers` of a JSON object, or a JSON list; of equal ids the last holds, and items
    without an id or a text go. Null if nothing is left."""
    plain = tx.strip_fence(raw)
    item = "array<struct<id:string,assistant:variant,answer:variant,response:variant>>"
    inner = F.regexp_extract(plain, r"(?s)(\{.*\})", 1)
    listed = F.coalesce(F.from_json(F.when(plain.startswith("["), plain), item), F.from_json(F.when(~plain.startswith("["), inner), f"struct<answers:{item}>")["answers"], F.array().cast(item))
    set_ = lambda v: v.isNotNull() & ~F.coalesce(F.try_variant_get(v, "$", "string"), F.lit("")).isin("", "0", "0.0", "false")
    text = lambda x: F.coalesce(*(F.when(set_(x[k]), F.struct(_text(x[k]).alias("v"))) for k in ("assistant", "answer", "response")))["v"]
    entries = F.filter(F.transform(listed, lambda x: F.struct(x["id"].alias("id"), tx.strip(text(x)).alias("v"))), lambda e: e["id"].isNotNull() & e["v"].isNotNull())
    return F.when(F.size(entries) > 0, _last_wins(entries))


@F.pandas_udf(T.ArrayType(T.StringType()))
def unescape(texts: pd.Series) -> pd.Series:
    """HTML entities in an array of texts; Spark has no function for them."""
    return texts.map(lambda xs: [None if x is None else html.unescape(x) for x in xs], na_action="ignore")


def with_batch_replies(df: DataFrame, raw: str, expected: str, out: str = "replies") -> DataFrame:
    """df with a map from expected id to reply: tagged items; if some are missing, the JSON list `items` besides; without any
    JSON, of a single id the whole text. Null if ids are still missing. df has no columns _ids, _texts and _bare."""
    plain = tx.strip_fence(F.col(raw), "^```(?:json|xml)?")
    tag = r"(?is)<item\s+id=[\"']([^\"']+)[\"']\s*>(.*?)</item>"
    group = lambda k: unescape(F.transform(F.regexp_extract_all(plain, F.lit(tag), F.lit(k)), tx.strip))
    bare = tx.strip(F.regexp_replace(tx.strip(F.regexp_replace(plain, r"(?i)^<item\s+id=[\"'][^\"']+[\"']\s*>", "")), r"(?i)</item>\s*$", ""))
    read = df.withColumns({"_ids": group(1), "_texts": group(2), "_bare": unescape(F.array(bare))})

    ids, entry = F.col(expected), "array<struct<id:string,v:string>>"
    wanted = lambda e: F.array_contains(ids, e["id"]) & (e["v"] != "")
    tagged = F.filter(F.arrays_zip("_ids", "_texts").cast(entry), wanted)
    inner = F.regexp_extract(plain, r"(?s)(\{.*\})", 1)
    items = F.from_json(inner, "struct<items:array<struct<id:string,message:variant>>>")["items"]
    listed = F.filter(F.transform(items, lambda x: F.struct(x["id"].alias("id"), tx.strip(_text(x["message"])).alias("v"))), wanted)
    both = F.concat(tagged, F.coalesce(listed, F.array().cast(entry)))
    whole = lambda es: F.size(F.array_distinct(F.transform(es, lambda e: e["id"]))) == F.size(F.array_distinct(ids))
    single = F.map_from_entries(F.transform(ids, lambda i: F.struct(i.alias("id"), F.element_at("_bare", 1).alias("v"))))
    replies = F.when(whole(tagged), _last_wins(tagged)).when(whole(both), _last_wins(both)).when((inner == "") & (F.size(ids) == 1) & (plain != ""), single)
    return tx.computed(read, {out: replies}).drop("_ids", "_texts", "_bare")


def extract_questions(raw: Column) -> Column:
    """The questions in a reply: a JSON list, a JSON object's list, a broken object's list, or lines without bullets and
    numbers."""
    plain = tx.strip_fence(raw)
    object_ = F.from_json(plain, "struct<questions:array<string>,messages:array<string>,prompts:array<string>>")
    lines = F.transform(F.split(plain, r"\R|[\x1C-\x1E]"), lambda x: tx.strip(F.regexp_replace(tx.strip(x), r"^(?:[-*•]|\d+[.)])\s*", "")))
    found = F.when(plain.startswith("["), F.from_json(plain, "array<string>")).when(plain.startswith("{"), F.coalesce(object_["questions"], object_["messages"], object_["prompts"]))
    parts = F.split(F.regexp_extract(plain, r"(?s)\[(.*)\]", 1), '","')
    bare = lambda x: F.regexp_replace(tx.strip(F.regexp_replace(tx.strip(x), r"^,+|,+$", "")), '^"|"$', "")
    loose = F.when(F.contains(plain, F.lit('"questions"')) & (F.size(parts) > 1), F.transform(parts, lambda x: F.regexp_replace(bare(x), "”$", "")))
    return F.filter(F.transform(F.coalesce(found, loose, lines), tx.strip), lambda x: x != "")


def refilter(rows: DataFrame, user: str, answer: str, ordinal: str, limit: int = 0) -> DataFrame:
    """rows with reason and ok: the first of each user text, then judged, so that an invalid first one hides later ones.
    With a limit, rows up to the limit-th kept one in order; the ordinal must be unique."""
    from quillmill.operators.selection import first_wins

    said = tx.strip(F.coalesce(F.col(user), F.lit("")))
    first = first_wins(rows.where(said != ""), F.lower(said), ordinal)
    judged = first.withColumn("reason", answer_reason(tx.strip(F.coalesce(F.col(answer), F.lit(""))))).withColumn("ok", F.col("reason") == "ok")
    if not limit:
        return judged
    last = judged.where("ok").orderBy(ordinal).limit(limit).agg(F.max(ordinal).alias("_last"), F.count("*").alias("_n"))
    return judged.join(F.broadcast(last), (F.col("_n") < limit) | (F.col(ordinal) <= F.col("_last"))).drop("_last", "_n")  # one row


def provider(model: Column) -> Column:
    return F.when(model.startswith("claude"), "anthropic").when(model.rlike("^(gpt|o1|o3|o4)"), "openai").otherwise(F.raise_error(F.concat(F.lit("no provider for "), model)))


def retryable(status: Column, message: Column) -> Column:
    """Whether a failed call is worth another try."""
    m = F.lower(F.coalesce(message, F.lit("")))
    said = F.contains(m, F.lit("rate limit")) | F.contains(m, F.lit("overloaded")) | F.contains(m, F.lit("timeout")) | F.contains(m, F.lit("timed out"))
    return F.coalesce((status == 429) | status.between(500, 599), F.lit(False)) | said


def sample_flags(c: Column) -> list[Column]:
    return [F.contains(c, F.lit("User:")).alias("has_user"), F.contains(c, F.lit("Assistant:")).alias("has_assistant"), (tx.strip(c) == "").alias("is_empty")]


def by_id(rows: DataFrame, replies: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the replies to each, by id; a row with several replies comes as often. What nobody asked for, and what nobody
    answered, falls out."""
    return rows.join(replies, keys)
