"""Conversations: the turn before, quality reasons, the longest clean prefix, training records, and replay.

Flat input has (conv_id, turn, role, text). Only as many turns of a conversation as can matter are brought together, so that
a conversation of any length is no burden for one task.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from quillmill.functions import text as tx
from quillmill.operators import echo
from quillmill.sources.shared import cut

# Fixed values.
GENERIC_REPLIES = ["thanks", "ok", "okay", "yeah", "yep", "sure"]
TRANSCRIPT_META = [
    "you're repeating yourself", "you are repeating yourself", "you already said", "you said that twice", "you've said that twice", "you listed it twice", "you just asked me", "you asked me",
    "you're looping", "you are looping", "i asked you", "i asked what", "i'm asking you", "i'm waiting on you", "you asked what", "not me",
]
IDENTITY_LEAKS = ["deadpool", "marvel"]


def contains_any(c: Column, parts: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(F.lower(c), F.lit(p)) for p in parts))


def with_previous_user(turns: DataFrame) -> DataFrame:
    """turns with user_text: the latest earlier user text of the conversation."""
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    return turns.withColumn("user_text", F.last(F.when(F.col("role") == "user", F.col("text")), True).over(before))


def audit(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, reason, user_text, text) of assistant turns that echo the user, in the audit's variant."""
    replies = with_previous_user(turns).where((F.col("role") == "assistant") & (F.coalesce("text", F.lit("")) != ""))
    return echo.with_echo_reason(replies, "user_text", "text", "reason", "audit").select("conv_id", "turn", "reason", "user_text", "text")


def audit_summary(turns: DataFrame) -> DataFrame:
    found = audit(turns)
    return found.agg(F.count("*").alias("checked"), F.count("reason").alias("issues"), F.when(F.count("*") > 0, F.count("reason") / F.count("*")).otherwise(0.0).alias("rate"))


def split_by_audit(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) turns: a conversation with any echo goes as a whole; null ids go together, as `None`."""
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit("None"))
    bad = audit(turns).where("reason IS NOT NULL").select(key.alias("_bad")).distinct()
    return turns.join(bad, key == F.col("_bad"), "left_anti"), turns.join(bad, key == F.col("_bad"), "left_semi")


def row_issues(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(issues, checked) of rows (ordinal, id, source_path, source_line, turns) as they lie in files: each assistant turn against the
    user turn before it; issues are (ordinal, id, source, line, turn, reason, user, assistant), checked counts the turns."""
    turns = rows.select(F.col("ordinal").alias("conv_id"), F.posexplode("turns").alias("turn", "t")).select("conv_id", "turn", "t.role", F.col("t.content").alias("text"))
    found = cut(audit(turns))
    where = rows.select("ordinal", F.coalesce("id", F.lit("None")).alias("id"), F.col("source_path").alias("source"), F.col("source_line").alias("line"))
    issues = found.where("reason IS NOT NULL").join(where, found["conv_id"] == where["ordinal"])
    return issues.select("ordinal", "id", "source", "line", "turn", "reason", F.col("user_text").alias("user"), F.col("text").alias("assistant")), found.agg(F.count("*").alias("checked"), F.count("reason").alias("issues"))


def nested(turns: DataFrame, most: int | None = None) -> DataFrame:
    """(conv_id, n_turns, turns): turns as an array in order; with `most` (for rules that look no further) only the first."""
    in_order = Window.partitionBy("conv_id").orderBy("turn")
    n = turns.groupBy("conv_id").agg(F.count("*").alias("n_turns"))
    head = turns.withColumn("_k", F.row_number().over(in_order)).where(F.lit(True) if most is None else F.col("_k") <= most)
    arrays = head.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(F.col("_k").alias("k"), "role", tx.clean_content(F.col("text")).alias("content")))).alias("turns"))
    return n.join(arrays, "conv_id")


def with_quality(rows: DataFrame, min_turns: int = 4, max_turns: int = 14, strict: bool = True) -> DataFrame:
    """rows (conv_id, n_turns, turns[, error]) with reason (`ok` or why not) and first_bad, the number of turns before the first bad one."""
    prepared = tx.computed(rows, {"_w": F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("c"), tx.words_kept(t["content"]).alias("w")))})
    prepared = tx.computed(prepared, {"_t": F.transform("_w", lambda t: F.struct(t["role"].alias("role"), t["c"].alias("c"), t["w"].alias("w"), tx.content_set(t["w"]).alias("s")))})

    def of_turn(t: Column, i: Column) -> Column:
        expected = F.when(i % 2 == 0, "user").otherwise("assistant")
        plain = F.lower(tx.strip(t["c"]))
        before = F.try_element_at(F.filter(F.slice("_t", 1, i), lambda u: u["role"] == "user"), F.lit(-1))
        assistant = t["role"] == "assistant"
        reason = F.when(~t["role"].eqNullSafe(expected), "bad_role_order").when(t["c"] == "", "empty_content").when(assistant & (plain.isin(GENERIC_REPLIES) | F.contains(plain, F.lit("[empty]"))), "generic_or_empty_assistant").when(assistant & (F.size(tx.split_words(t["c"])) < 2), "too_short_assistant")
        if strict:
            reason = reason.when(assistant & contains_any(t["c"], IDENTITY_LEAKS), "assistant_identity_leak").when(assistant & contains_any(t["c"], TRANSCRIPT_META), "transcript_meta_reply").when(assistant & before.isNotNull() & echo.too_echoed(before["w"], t["w"], before["s"], t["s"]), "assistant_echo")
        return reason

    def repeat_of(t: Column, i: Column) -> Column:
        same = F.filter(F.slice("_t", 1, i), lambda u: u["role"] == t["role"])
        user = F.exists(same, lambda u: echo.user_repeats(t["w"], t["s"], u["w"]))
        reply = F.exists(same, lambda u: echo.reply_repeats(t["w"], t["s"], u["w"], u["s"]))
        return F.when((t["role"] == "user") & user, "user_self_repeat").when((t["role"] == "assistant") & reply, "assistant_self_repeat")

    prepared = tx.computed(prepared, {"_r": F.transform("_t", of_turn), "_s": F.transform("_t", repeat_of) if strict else F.array().cast("array<string>")})
    first = lambda a: F.array_position(F.transform(a, lambda x: x.isNotNull()), True)  # noqa: E731  1-based, 0 if none
    at = [F.when(first(F.col(c)) > 0, first(F.col(c)) - 1) for c in ("_r", "_s")]
    first_bad = F.least(*(F.coalesce(x, F.size("_t").cast("long")) for x in at))
    error = F.coalesce(F.col("error"), F.lit("")) if "error" in rows.columns else F.lit("")
    reason = (
        F.when(error != "", "source_error").when(F.coalesce("n_turns", F.lit(0)) == 0, F.when(F.col("n_turns") == 0, "bad_turn_count").otherwise("missing_turns")).when((F.col("n_turns") < min_turns) | (F.col("n_turns") > max_turns) | (F.col("n_turns") % 2 == 1), "bad_turn_count")
        .when(first(F.col("_r")) > 0, F.try_element_at("_r", first(F.col("_r")).cast("int"))).when(F.array_contains("_s", "user_self_repeat"), "user_self_repeat").when(F.array_contains("_s", "assistant_self_repeat"), "assistant_self_repeat").otherwise("ok")
    )
    return tx.computed(prepared, {"reason": reason, "first_bad": first_bad}).drop("_w", "_t", "_r", "_s")


def of_rows(rows: DataFrame, max_turns: int = 14) -> DataFrame:
    """rows with turns, an array of (role, content, ...), as `nested` makes them, in place: n_turns, null without an array, and the first
    max_turns turns. No turn is shuffled."""
    turn = lambda t, i: F.struct((i + 1).alias("k"), t["role"].alias("role"), tx.clean_content(t["content"]).alias("content"))
    return rows.withColumn("n_turns", F.when(F.col("turns").isNotNull(), F.size("turns"))).withColumn("turns", F.transform(F.slice("turns", 1, max_turns), turn))


def with_salvage(rows: DataFrame, min_turns: int = 4, max_turns: int = 14) -> DataFrame:
    """rows of with_quality with kept_turns, null where nothing can be kept, and salvaged_from_turns where a prefix is."""
    start = F.least(F.lit(max_turns), F.col("n_turns"))
    start = start - start % 2
    start = F.when(start >= F.col("n_turns"), start - 2).otherwise(start)
    length = F.least(start, F.col("first_bad") - F.col("first_bad") % 2)
    usable = ~F.col("reason").isin("ok", "source_error", "missing_turns") & (length >= min_turns)
    return tx.computed(rows, {"kept_turns": F.when(F.col("reason") == "ok", F.col("n_turns")).when(usable, length).cast("int"), "salvaged_from_turns": F.when(usable, F.col("n_turns"))})


def salvaged(rows: DataFrame, min_turns: int = 4, max_turns: int = 14) -> DataFrame:
    """rows of with_quality that are ok, or have a clean even prefix, with kept_turns and salvaged_from_turns."""
    return with_salvage(rows, min_turns, max_turns).where("kept_turns IS NOT NULL").withColumn("turns", F.slice("turns", F.lit(1), F.col("kept_turns")))


def training_records(rows: DataFrame, system: str | None = None, explode: bool = True) -> DataFrame:
    """(source_id, target_turn_index, turns, salvaged_from_turns, messages): a record for each conversation, or for each
    assistant turn with the turns up to it; a system message comes first if there is one."""
    message = lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))
    lead = F.array(F.struct(F.lit("system").alias("role"), F.lit(system).alias("content"))) if system else F.array().cast("array<struct<role:string,content:string>>")
    made = lambda t: F.concat(lead, F.transform(t, message))
    if not explode:
        return rows.select(F.col("conv_id").cast("string").alias("source_id"), F.lit(None).cast("int").alias("target_turn_index"), F.size("turns").alias("turns"), "salvaged_from_turns", made(F.col("turns")).alias("messages"))
    each = rows.select("conv_id", "salvaged_from_turns", F.col("turns").alias("t"), F.posexplode("turns").alias("ix", "turn")).where(F.col("turn.role") == "assistant")
    return each.select(F.format_string("%s#assistant_turn_%d", F.col("conv_id").cast("string"), F.col("ix")).alias("source_id"), F.col("ix").alias("target_turn_index"), (F.col("ix") + 1).alias("turns"), "salvaged_from_turns", made(F.slice("t", F.lit(1), F.col("ix") + 1)).alias("messages"))


def _listed(values: list) -> dict[str, int]:
    """A histogram that was observed, the most common first."""
    return {str(r["item"]): r["count"] for r in sorted((r for r in values if r["item"] is not None), key=lambda r: (-r["count"], str(r["item"])))}


def write_clean(rows: DataFrame, path: str, min_turns: int = 4, max_turns: int = 14, strict: bool = True) -> dict:
    """Writes the rows (n_turns, turns[, error]) that are clean, or have a clean beginning, as Parquet, and returns what is observed on
    that pass: eligible (how many), rejects and salvaged (how many of each reason, of which there are fewer than are tracked)."""
    judged = with_salvage(with_quality(rows, min_turns, max_turns, strict), min_turns, max_turns)
    kept, seen = F.col("kept_turns").isNotNull(), Observation()
    judged = judged.withColumns({"rejected_": F.when(~kept, F.col("reason")), "salvaged_": F.when(F.col("salvaged_from_turns").isNotNull(), F.col("reason"))})
    top = lambda c: F.expr(f"approx_top_k({c}, 64, 1024)")  # noqa: E731  exact up to 768 values
    judged.observe(seen, F.count_if(kept).alias("eligible"), top("rejected_").alias("rejects"), top("salvaged_").alias("salvaged")).where(kept).drop("rejected_", "salvaged_").write.parquet(path)
    return {"eligible": seen.get["eligible"], "rejects": _listed(seen.get["rejects"]), "salvaged": _listed(seen.get["salvaged"])}


def observe_selection(rows: DataFrame, most: int = 10_000) -> tuple[DataFrame, Callable[[], dict]]:
    """(rows, counts): once rows are written, counts() has selected, turns (how many of each kept_turns) and categories; more than
    `most` categories, beyond which the histogram would not be exact, are counted by a scan."""
    seen = Observation()
    watched = rows.observe(seen, F.count(F.lit(1)).alias("selected"), F.expr("approx_top_k(kept_turns, 64, 1024)").alias("turns"), F.expr(f"approx_top_k(coalesce(category, 'None'), {most}, 131072)").alias("categories"))

    def counts() -> dict:
        categories = _listed(seen.get["categories"])
        if len(categories) >= most:
            name = F.coalesce("category", F.lit("None")).alias("name")
            categories = {r["name"]: r["count"] for r in rows.groupBy(name).count().orderBy(F.desc("count"), "name").collect()}
        return {"selected": seen.get["selected"], "turns": {str(k): n for k, n in sorted((r["item"], r["count"]) for r in seen.get["turns"])}, "categories": categories}

    return watched, counts


def export_records(rows: DataFrame, system: str | None, explode: bool) -> DataFrame:
    """Rows (id, category, topic, turns, salvaged_from_turns, source_file, source_line) as records of training, one for each conversation
    or each assistant turn, with the fields of an exported line. No shuffle, so that their order is that of rows."""
    lead = F.array(F.struct(F.lit("system").alias("role"), F.lit(system).alias("content"))) if system else F.array().cast("array<struct<role:string,content:string>>")
    made = lambda t: F.concat(lead, F.transform(t, lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))))
    after = ["salvaged_from_turns", "source_file", "source_line"]
    if not explode:
        return rows.select(made(F.col("turns")).alias("messages"), F.col("id").alias("source_id"), "category", "topic", F.size("turns").alias("turns"), *after)
    each = rows.withColumn("_all", F.col("turns")).select("*", F.posexplode("turns").alias("_ix", "_turn")).where("_turn.role = 'assistant'")
    return each.select(
        made(F.slice("_all", F.lit(1), F.col("_ix") + 1)).alias("messages"), F.concat("id", F.lit("#assistant_turn_"), F.col("_ix").cast("string")).alias("source_id"), "category", "topic", (F.col("_ix") + 1).alias("turns"), *after,
        F.col("id").alias("source_conversation_id"), F.col("_ix").alias("target_turn_index"), F.size("_all").alias("source_total_turns"),
    )


def replay(turns: DataFrame, target_replies: int, variant: str = "generator") -> DataFrame:
    """turns up to where a run would have stopped, with error on a stopping invalid reply: after an invalid reply, at the
    target number of replies, or with a reply under five characters once there are two."""
    in_order = Window.partitionBy("conv_id").orderBy("turn")
    seen = with_previous_user(turns)
    judged = echo.with_echo_reason(seen, "user_text", "text", "_echo", variant)
    assistant = F.col("role") == "assistant"
    judged = judged.withColumn("_bad", F.when(assistant, echo.reply_problem(F.col("text"), F.col("_echo"), F.col("user_text").isNotNull())))
    judged = judged.withColumn("_n", F.sum(F.when(assistant & F.col("_bad").isNull(), 1).otherwise(0)).over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    stop = assistant & (F.col("_bad").isNotNull() | (F.col("_n") >= target_replies) | ((F.col("_n") >= 2) & (F.length(tx.strip(F.col("text"))) < 5)))
    stopped = F.max(F.when(stop, 1).otherwise(0)).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    return judged.withColumn("_stopped", F.coalesce(stopped, F.lit(0))).where("_stopped = 0").withColumn("error", F.when(F.col("_bad").isNotNull(), F.concat(F.lit("invalid_poke_reply:"), "_bad"))).drop("_echo", "_bad", "_n", "_stopped")


def history(turns: Column) -> Column:
    """Turns as a prompt shows them, the assistant under its own name."""
    return F.transform(turns, lambda t: F.struct(F.when(t["role"] == "assistant", "poke").otherwise("user").alias("role"), F.coalesce(t["content"], F.lit("")).alias("content")))


def user_item(turns: str = "turns", **columns: str) -> Column:
    """What the user's side of a conversation is asked with. Columns have the fields' names, or those given for them."""
    field = lambda k: F.col(columns.get(k, k)).alias(k)
    fields = [field(k) for k in ("id", "topic", "category", "scenario", "user_spec", "user_prompt_profile")]
    return F.struct(*fields, (F.size(turns) == 0).alias("is_opener"), history(F.col(turns)).alias("history"))


def reply_item(turns: str = "turns", **columns: str) -> Column:
    """What the assistant's side is asked with."""
    return F.struct(*(F.col(columns.get(k, k)).alias(k) for k in ("id", "topic", "category")), history(F.col(turns)).alias("history"))


#: Fixed value: the fields of a stored conversation, in order.
ROW_FIELDS = "id user category topic scenario user_spec user_prompt_profile turns poke_model user_model error total_prompt_tokens total_completion_tokens".split()


def stored_row(df: DataFrame, poke_model: str, user_model: str) -> DataFrame:
    """The fields of a stored conversation in their order; the models are those of the run, a field that df lacks is null."""
    models = {"poke_model": F.lit(poke_model), "user_model": F.lit(user_model)}
    return df.select(*(models.get(c, F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(c) for c in ROW_FIELDS))


def token_shares(batches: DataFrame, members: str, prompt: str, completion: str) -> DataFrame:
    """(member, prompt_share, completion_share): a batch's tokens in even whole shares for its members; the rest is dropped."""
    n = F.greatest(F.lit(1), F.size(members))
    share = lambda c: F.floor(F.col(c) / n).cast("long")
    each = batches.select(F.explode(members).alias("member"), share(prompt).alias("p"), share(completion).alias("c"))
    return each.groupBy("member").agg(F.sum("p").alias("prompt_share"), F.sum("c").alias("completion_share"))


def envelope(instruction: str, items: Column) -> Column:
    """The JSON text of a batch: an instruction and its items."""
    return F.to_json(F.struct(F.lit(instruction).alias("instruction"), items.alias("items")), {"ignoreNullFields": "false"})


def sums(turns: DataFrame) -> DataFrame:
    """(conv_id, replies, prompt_tokens, reply_tokens) by conversation, aggregated before the shuffle."""
    reply, cost = F.col("role") == "assistant", tx.estimate_tokens(F.coalesce("text", F.lit("")))
    return turns.groupBy("conv_id").agg(F.count_if(reply).alias("replies"), F.sum(F.when(reply, 0).otherwise(cost)).alias("prompt_tokens"), F.sum(F.when(reply, cost).otherwise(0)).alias("reply_tokens"))
