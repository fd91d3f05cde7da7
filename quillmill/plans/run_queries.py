"""Queries of texts, answers, runs, sources and streams, and their DuckDB SQL.

The driver's tables stand in for the operators' inputs: conversations for replies and raw answers (a batch has at most twenty
turns of one conversation), documents and labels for the rows of a run in eight shards.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.functions import text as tx
from quillmill.operators import answers, conversations, echo, selection, status
from quillmill.plans import conversation_sql as cs
from quillmill.sources import commits, growing, jsonl, shared
from quillmill.sources.shared import cut
from quillmill.streaming import progress

SCENARIOS = {"en": "at the station", "de": "in the kitchen", "fr": "on the way home"}
LANGUAGES = {"en": 0.3, "de": 0.3, "fr": 0.25, "es": 0.15}
PLAN = {"work": 0.5, "home": 0.3, "travel": 0.2, "never": 0.0}
REPLIES = {"2": 0.2, "3": 0.3, "4": 0.3, "5": 0.2}
AXES = {"mood": ["calm", "rushed"], "style": ["plain", "odd", "short"]}
MIX = {"lang": {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}, "band": {"short": 0.35, "middle": 0.4, "long": 0.25}}
MIX_LIMIT = 40
ORDINAL = "conv_id * 1000000 + turn"  # of a turn among all turns


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def batches(spark: SparkSession, sf_dir: str, role: str) -> DataFrame:
    """(conv_id, part, turns) with the turns of a role that have a text, at most twenty turns a part."""
    said = read(spark, sf_dir, "conversations").where((F.col("role") == role) & (tx.strip(F.coalesce("text", F.lit(""))) != ""))
    return said.groupBy("conv_id", F.floor(F.col("turn") / 20).alias("part")).agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("said"))


def f2_words(spark, sf_dir):
    plain = F.coalesce("text", F.lit(""))
    rows = tx.computed(read(spark, sf_dir, "documents").select("doc_id", plain.alias("text")), {"w": tx.words_kept(F.col("text"))})
    return rows.select("doc_id", F.size(tx.words(F.col("text"))).alias("n_words"), F.size("w").alias("n_words_kept"), F.size(tx.content_set(F.col("w"))).alias("n_content"))


def f8_shared_runs(spark, sf_dir):
    turns = conversations.with_previous_user(read(spark, sf_dir, "conversations")).where("role = 'assistant' AND user_text IS NOT NULL")
    rows = tx.computed(turns, {"u": tx.words(F.col("user_text")), "r": tx.words(F.coalesce("text", F.lit("")))})
    return rows.select("conv_id", "turn", *(tx.share_run(F.col("u"), F.col("r"), n).alias(f"run_{n}") for n in (1, 2, 3)))


def f13_clean_answers(spark, sf_dir):
    raw = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("Assistant: "), "text")).when(F.col("turn") % 3 == 1, F.concat(F.lit("```json\n"), F.to_json(F.struct(F.lit(1).alias("assistant"), F.col("text").alias("answer"))), F.lit("\n```"))).otherwise(F.col("text"))
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", tx.clean_answer(raw).alias("answer"))


def by_kind(*kinds):
    """Conversations take turns at the kinds of a reply."""
    k = F.col("conv_id") % len(kinds)
    out = F.when(k == 0, kinds[0])
    for i, kind in enumerate(kinds[1:], 1):
        out = out.when(k == i, kind)
    return out


def f15_batch_answers(spark, sf_dir):
    """An object; a fenced list; words before an object in which an id comes twice and one is missing."""
    item = lambda id_, text: F.struct(id_.cast("bigint").alias("id"), text.alias("assistant"))
    items = F.transform("said", lambda t: item(t["turn"], t["text"]))
    more = F.concat(F.array(item(F.col("said")[0]["turn"], F.lit("an older answer"))), items, F.array(item(F.lit(None), F.lit("whose?"))))
    whole = lambda x: F.to_json(F.struct(x.alias("answers")))
    raw = by_kind(whole(items), F.concat(F.lit("```json\n"), F.to_json(items), F.lit("\n```")), F.concat(F.lit("Here they are: "), whole(more)))
    return batches(spark, sf_dir, "assistant").select("conv_id", F.explode(answers.parse_batch_answers(raw)).alias("id", "answer"))


def f16_batch_replies(spark, sf_dir):
    """Tagged items; a JSON list; one tagged, one that nobody asked for, and a list of the rest."""
    escaped = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    tag = lambda id_, text: F.concat(F.lit('<item id="'), id_.cast("string"), F.lit('">'), escaped(text), F.lit("</item>"))
    listed = lambda x: F.to_json(F.struct(F.transform(x, lambda t: F.struct(t["turn"].cast("string").alias("id"), t["text"].alias("message"))).alias("items")))
    first = F.col("said")[0]
    mixed = F.concat(tag(first["turn"], first["text"]), tag(F.lit("none"), F.lit("not asked for")), F.lit("\n"), listed(F.slice("said", F.lit(2), F.greatest(F.size("said") - 1, F.lit(1)))))
    raw = by_kind(F.array_join(F.transform("said", lambda t: tag(t["turn"], t["text"])), "\n"), listed(F.col("said")), mixed)
    rows = batches(spark, sf_dir, "assistant").select("conv_id", raw.alias("raw"), F.transform("said", lambda t: t["turn"].cast("string")).alias("expected"))
    return answers.with_batch_replies(rows, "raw", "expected").select("conv_id", F.explode("replies").alias("id", "reply"))


def f17_questions(spark, sf_dir):
    """An object; a fenced list; an object under another name."""
    texts = F.transform("said", lambda t: t["text"])
    raw = by_kind(F.to_json(F.struct(texts.alias("questions"))), F.concat(F.lit("```\n"), F.to_json(texts), F.lit("\n```")), F.to_json(F.struct(texts.alias("prompts"))))
    return batches(spark, sf_dir, "user").select("conv_id", "part", F.posexplode(answers.extract_questions(raw)).alias("k", "question"))


def f18_messages(spark, sf_dir):
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", F.posexplode(tx.split_messages(tx.clean_content(F.col("text")))).alias("k", "message"))


def f21_user_labels(spark, sf_dir):
    spec = F.create_map(F.lit("segment"), F.col("c_mktsegment"), F.lit("nation"), F.col("c_nationkey").cast("string"))
    return read(spark, sf_dir, "customer").select("c_custkey", tx.user_label(spec).alias("label"))


def p5_flags(spark, sf_dir):
    text = F.coalesce("text", F.lit(""))
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", tx.is_end(text).alias("is_end"), conversations.contains_any(text, conversations.IDENTITY_LEAKS).alias("identity_leak"), conversations.contains_any(text, conversations.TRANSCRIPT_META).alias("transcript_meta"), *answers.sample_flags(text))


def p6_reply_problems(spark, sf_dir):
    seen = echo.with_echo_reason(conversations.with_previous_user(read(spark, sf_dir, "conversations")), "user_text", "text", "_echo")
    return seen.where("role = 'assistant'").select("conv_id", "turn", echo.reply_problem(F.col("text"), F.col("_echo"), F.col("user_text").isNotNull()).alias("problem"))


def trajectories(spark, sf_dir):
    """Whole conversations with the fields of a run; topics and the like are made from the id."""
    rows = conversations.nested(read(spark, sf_dir, "conversations"))
    c = F.col("conv_id")
    return rows.select("conv_id", c.cast("string").alias("id"), F.concat(F.lit("topic "), c % 7).alias("topic"), F.lit("chat").alias("category"), F.lit(None).cast("string").alias("scenario"), F.create_map(F.lit("mood"), F.concat(F.lit("m"), c % 3)).alias("user_spec"), F.lit("casual").alias("user_prompt_profile"), "turns")


def p3_user_items(spark, sf_dir):
    return trajectories(spark, sf_dir).select("conv_id", conversations.envelope("Write the next text.", F.array(conversations.user_item())).alias("payload"))


def p3_reply_items(spark, sf_dir):
    return trajectories(spark, sf_dir).select("conv_id", conversations.envelope("Answer each.", F.array(conversations.reply_item())).alias("payload"))


def p4_stored_rows(spark, sf_dir):
    rows = conversations.stored_row(trajectories(spark, sf_dir).withColumn("turns", F.size("turns")), "model-a", "model-b")
    return rows.select("id", F.to_json(F.struct(*(c for c in rows.columns if c != "user_spec")), {"ignoreNullFields": "false"}).alias("row"))


def k6_pretty(spark, sf_dir):
    none = F.lit(None).cast("string")
    rows = conversations.nested(read(spark, sf_dir, "conversations"))
    return rows.select("conv_id", jsonl.pretty(F.col("conv_id"), F.lit("conversations"), none, none, none, none, F.col("turns")).alias("shown"))


def c3_token_shares(spark, sf_dir):
    """Batches of eight conversations, whose tokens are shared evenly."""
    batch = read(spark, sf_dir, "conversations").groupBy(F.floor(F.col("conv_id") / 8).alias("b")).agg(F.collect_set("conv_id").alias("members"), F.sum(F.length(F.coalesce("text", F.lit("")))).alias("p"), F.count("*").alias("c"))
    return conversations.token_shares(batch, "members", "p", "c")


def c4_pack_batches(spark, sf_dir):
    """Items by the length of their JSON, under bounds of items, of prompt tokens and of reply tokens."""
    said = F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", F.length(F.to_json(said)).alias("cost"))
    return selection.next_fit(rows, "conv_id", "turn", "cost", 6, 500, envelope=40, between=1, per=4, before=100, output_each=50, output_budget=260).select("conv_id", "turn", "batch")


def raw_answers(spark, sf_dir):
    turns = conversations.with_previous_user(read(spark, sf_dir, "conversations")).where("role = 'assistant'")
    return turns.select("conv_id", "turn", F.expr(ORDINAL).alias("ordinal"), "user_text", "text")


def w2_refilter(spark, sf_dir):
    return answers.refilter(raw_answers(spark, sf_dir), "user_text", "text", "ordinal").select("conv_id", "turn", "reason", "ok")


def w8_refilter_first_20(spark, sf_dir):
    return answers.refilter(raw_answers(spark, sf_dir), "user_text", "text", "ordinal", 20).select("conv_id", "turn", "reason", "ok")


def p8_unfiltered(spark, sf_dir):
    kept, rejected = answers.split_answers(read(spark, sf_dir, "conversations").where("role = 'assistant'"), "text", filtered=False)
    return kept.unionByName(rejected).select("conv_id", "turn", "ok", "reason")


def k3_split_answers(spark, sf_dir):
    """Judged answers in three outputs, read back."""
    kept, rejected = answers.split_answers(read(spark, sf_dir, "conversations").where("role = 'assistant'").select("conv_id", "turn", "text"), "text")
    paths = jsonl.write_answers(kept.unionByName(rejected), shared.folder(spark, "answers") + "/out.jsonl")
    parts = [jsonl.read_strict(spark, path, "conv_id bigint, turn bigint, reason string").withColumn("output", F.lit(name)) for name, path in paths.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def s4_numbered_lines(spark, sf_dir):
    """Two files, each in order, of which every ninth line is blank; lines with their file's folder and number."""
    folder, out = shared.folder(spark, "numbered"), []
    for role in ("user", "assistant"):
        line = F.when(F.col("turn") % 9 == 4, "").otherwise(F.concat_ws(":", "conv_id", "turn"))
        said = read(spark, sf_dir, "conversations").where(F.col("role") == role).repartition(1).sortWithinPartitions("conv_id", "turn")
        said.select(line.alias("value")).write.text(f"{folder}/{role}")
        out.append(jsonl.lines(spark, f"{folder}/{role}").select(F.lit(role).alias("role"), F.left("source_file", F.lit(10)).alias("file"), "source_line", "line"))
    return out[0].unionByName(out[1])


def s6_in_order(spark, sf_dir):
    """Inputs that have a conversation in common; of each the first input wins."""
    folder = shared.folder(spark, "inputs")
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn")
    for k in (2, 3, 5):
        jsonl.write_jsonl(turns.where(F.col("conv_id") % k == 0), f"{folder}/{k}")
    rows = jsonl.read_in_order(spark, [f"{folder}/{k}" for k in (5, 2, 3)], "conv_id bigint, turn bigint")
    return rows.groupBy("conv_id", "turn").agg(F.min("input_ix").cast("long").alias("first_input"), F.count("*").alias("n"))


def p1_question_orders(spark, sf_dir):
    """Two whole columns, either of which can be empty, read in either order."""
    rows = read(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 4 > 0, F.col("text")).alias("question"), F.when(F.col("doc_id") % 3 > 0, F.concat_ws(" ", "source", "lang")).otherwise("").alias("prompt"))
    both = [selection.dedupe_questions(rows, order, "doc_id").select("doc_id", "dedupe_key", F.lit(k).alias("order_ix")) for k, order in enumerate((["question", "prompt"], ["prompt", "question"]))]
    return both[0].unionByName(both[1])


def w5_by_language(spark, sf_dir):
    """A selection of 10,000 with caps of up to 3,000, as an export has them."""
    rows = read(spark, sf_dir, "documents").select("doc_id", "lang")
    return selection.stratified(rows, "lang", selection.quotas(10_000, LANGUAGES), 10_000, "doc_id", "doc_id")


def w9_slice(spark, sf_dir):
    return selection.rows_from(read(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", 20, 30)


def a12_common_starts(spark, sf_dir):
    return status.common_starts(read(spark, sf_dir, "conversations"), "text", 2, 25)


def t1_follow_until(spark, sf_dir):
    """Rows that land are followed until all clean ones are there."""
    folder = shared.folder(spark, "until")
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 5 == 2, "failed").alias("error"))
    jsonl.write_jsonl(turns, f"{folder}/in")
    schema = "conv_id bigint, turn bigint, error string"
    need = turns.where("error IS NULL").count()
    progress.follow_until(progress.follow(spark, f"{folder}/in", schema), f"{folder}/out", f"{folder}/state", need, 0.5, 300)
    return spark.read.schema(schema).parquet(f"{folder}/out").select("conv_id", "turn")


def f7_longest_runs(spark, sf_dir):
    """The longest run that a reply has in common with the user's text before it: how many words, and where it begins there."""
    turns = conversations.with_previous_user(read(spark, sf_dir, "conversations")).where("role = 'assistant' AND user_text IS NOT NULL")
    rows = tx.computed(turns, {"u": tx.words(F.col("user_text")), "r": tx.words(F.coalesce("text", F.lit("")))})
    return rows.select("conv_id", "turn", tx.longest_run(F.col("u"), F.col("r")).alias("run")).select("conv_id", "turn", "run.length", "run.start")


def c4_one_shard(spark, sf_dir):
    """All turns as one shard of many chunks: next-fit over the whole table, whose batches go on from chunk to chunk."""
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", F.lit(0).alias("part"), F.expr(ORDINAL).alias("ordinal"), tx.estimate_tokens(F.coalesce("text", F.lit(""))).alias("cost"))
    return selection.next_fit(rows, "part", "ordinal", "cost", 5, 120, chunk=100).select("conv_id", "turn", "batch")


def w15_mix(spark, sf_dir):
    """A mix by language and by length at once: how much of each was wanted and got, as the chosen rows say."""
    n = F.size(tx.split_words(F.coalesce("text", F.lit(""))))
    band = F.when(n <= 100, "short").when(n <= 300, "middle").otherwise("long")
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", band.alias("band"))
    rows, report = selection.mix(docs, MIX, MIX_LIMIT, "doc_id")
    rows = cut(rows)
    counts = [rows.groupBy(F.col(c).alias("value")).agg(F.count("*").alias("n")).withColumn("margin", F.lit(c)) for c in MIX]
    return report.join(counts[0].unionByName(counts[1]), ["margin", "value"], "left").select("margin", "value", "target", F.coalesce("n", F.lit(0)).alias("got"), "shortfall")


def c11_review(spark, sf_dir):
    """Decisions on documents in two rounds, the later of which counts; rows by what became of them."""
    labels = read(spark, sf_dir, "labels")
    first = labels.select(F.col("doc_id").alias("id"), F.when(F.col("quality") == 1, "accept").otherwise("reject").alias("decision"), F.lit("first look").alias("note"), F.lit(1).alias("at"))
    second = labels.where("doc_id % 3 = 0").select(F.col("doc_id").alias("id"), F.when(F.col("toxic") == 1, "reject").when(F.col("doc_id") % 2 == 0, "skip").otherwise("accept").alias("decision"), F.concat(F.lit("toxic: "), F.col("toxic").cast("string")).alias("note"), F.lit(2).alias("at"))
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("category"))
    found = status.reviewed(docs, first.unionByName(second), "id", start=50)
    whole = lambda k: found[k].select("id", F.lit(k).alias("output"), "category", F.col("review_note" if k == "rejected" else "note").alias("note") if k in ("rejected", "reviews") else F.lit(None).cast("string").alias("note"))
    return reduce(DataFrame.unionByName, map(whole, found))


def s5_audit_issues(spark, sf_dir):
    """Issues of conversations in two files, each with its file's folder and line; every seventh line of a file is blank."""
    folder = shared.folder(spark, "audited")
    rows = conversations.nested(read(spark, sf_dir, "conversations")).select("conv_id", F.when(F.col("conv_id") % 5 > 0, F.col("conv_id").cast("string")).alias("id"), F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))).alias("turns"))
    for k in (0, 1):
        mine = rows.where(F.col("conv_id") % 2 == k).repartition(1).sortWithinPartitions("conv_id")
        blank = F.when(F.col("conv_id") % 7 == 0, F.concat(F.lit("\n"), F.to_json(F.struct("id", "turns")))).otherwise(F.to_json(F.struct("id", "turns")))
        mine.select(blank.alias("value")).write.text(f"{folder}/{k}")
    found = jsonl.read_ordered(spark, [f"{folder}/1", f"{folder}/0"], "id string, turns array<struct<role:string,content:string>>")
    issues, _ = conversations.row_issues(cut(found))
    return issues.select("id", F.regexp_extract("source", r"/(\d)/[^/]*$", 1).alias("file"), "line", "turn", "reason", "user", "assistant")


def a1_export_counts(spark, sf_dir):
    """What an export's manifest says of the whole table, observed while the clean rows and their records are written."""
    folder = shared.folder(spark, "exported")
    rows = conversations.nested(read(spark, sf_dir, "conversations"), 14).withColumn("category", F.concat(F.lit("c"), (F.col("conv_id") % 300).cast("string")))
    seen = conversations.write_clean(rows, f"{folder}/clean")
    watched, counts = conversations.observe_selection(spark.read.parquet(f"{folder}/clean").orderBy("conv_id"))
    watched.select("conv_id").write.parquet(f"{folder}/records")
    found = [(kind, value, n) for kind, d in {**seen, **counts()}.items() if isinstance(d, dict) for value, n in d.items()]
    return spark.createDataFrame([*found, ("eligible", "", seen["eligible"])], "kind string, value string, n long")


def s4_total_order(spark, sf_dir):
    """Three files of very unequal size in a folder and one before it among the arguments: the place of each line among all,
    and whether it is the first of its language."""
    folder = shared.folder(spark, "shards")
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang")
    shard = F.when(F.col("doc_id") % 50 == 0, "a").when(F.col("doc_id") % 10 < 8, "b").otherwise("c")
    for name in ("z", "a", "b", "c"):
        mine = docs.where(F.col("doc_id") % 7 == 0) if name == "z" else docs.where((F.col("doc_id") % 7 > 0) & (shard == name))
        jsonl.write_jsonl(mine.repartition(1).sortWithinPartitions("doc_id"), f"{folder}/{'first' if name == 'z' else f'rest/{name}'}")
    rows = jsonl.read_ordered(spark, [f"{folder}/first", *[f"{folder}/rest/*"]], "doc_id bigint, lang string")
    rows = cut(rows)
    firsts = selection.first_wins(rows, F.col("lang"), "ordinal").select("doc_id", F.lit(True).alias("first"))
    return selection.numbered(rows, "input_ix", "ordinal", "k").join(firsts, "doc_id", "left").select("doc_id", F.col("input_ix").cast("long").alias("input_ix"), F.col("source_line"), F.col("k").alias("place"), F.coalesce("first", F.lit(False)).alias("first"))


def t3_growing_files(spark, sf_dir):
    """Files that grow in three steps, the last line of a step cut in two; a stream that is restarted after each step."""
    folder = shared.folder(spark, "growing")
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 5 == 2, "failed").alias("error"))
    line = F.when(F.col("turn") % 9 == 4, F.concat(F.lit("x"), F.to_json(F.struct("conv_id")))).otherwise(F.to_json(F.struct("conv_id", "turn", "error")))
    rows = turns.select((F.col("conv_id") % 4).alias("file"), (F.col("turn") % 3).alias("step"), line.alias("line"))

    def grow(step: int):
        def run(key, pdf):
            """Appends a file's lines; of the last one, half now and half with the next step."""
            store, path = growing.place(f"{folder}/in")
            store.create_dir(path)
            text = "".join(f"{x}\n" for x in sorted(pdf.loc[pdf["step"] == step, "line"]))
            held = "".join(f"{x}\n" for x in sorted(pdf.loc[pdf["step"] == step - 1, "line"]))[-10:] if step else ""
            with store.open_append_stream(f"{path}/{key[0]}.jsonl") as out:
                out.write((held + (text[:-10] if step < 2 else text)).encode())
            return pdf[["file"]].head(1)

        return run

    for step in range(3):
        rows.groupBy("file").applyInPandas(grow(step), "file long").collect()  # a row for each file
        stream = growing.follow_growing(spark, f"{folder}/in", "conv_id bigint, turn bigint, error string", include_errors=True)
        commits.write_stream(stream, f"{folder}/out", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    found = commits.read(spark, f"{folder}/out", "source_file string, position long, error string, conv_id long, turn long, line string")
    return found.select("source_file", "conv_id", "turn", "error", "line")


def k2_append_resume(spark, sf_dir):
    """A run in four batches, of which the second was killed after its files were written and before they counted, and the third
    was sent twice; then what is still pending, as the last batch."""
    folder = shared.folder(spark, "appended")
    planned = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("doc_id").alias("ordinal"))
    work = lambda df: df.select("id", F.when(F.col("ordinal") % 11 == 0, "failed").alias("error"), (F.col("ordinal") * 2).alias("result"))
    part = lambda k: work(planned.where(F.col("ordinal") % 4 == k))
    schema = "id string, error string, result long"
    commits.append(part(0), folder, "run", 0)
    part(1).write.parquet(f"{folder}/staged/run-{1:020d}-killed")
    for k in (1, 2, 2):
        commits.append(part(k), folder, "run", k)
    commits.resume(planned, commits.read(spark, folder, schema), lambda df: df.select("id", F.lit(None).cast("string").alias("error"), (F.col("ordinal") * 2).alias("result")), folder, "run", 3)
    commits.vacuum(spark, folder)
    total = commits.count(spark, folder)
    return commits.read(spark, folder, schema).select("id", "error", "result", F.lit(total).cast("long").alias("rows"))


def t2_notices(spark, sf_dir):
    """Notices of the runs of all sources, whose rows land in two parts, with a restart between them: none comes twice."""
    folder = shared.folder(spark, "notices")
    rows = read(spark, sf_dir, "documents").select(F.col("source").alias("run_id"), F.col("doc_id").cast("double").alias("at"), (F.col("doc_id") % 11 > 0).alias("ok"), F.lit(40).cast("long").alias("target"))
    half = rows.agg(F.max("at")).first()[0] // 2
    for part in (rows.where(F.col("at") <= half), rows.where(F.col("at") > half), None):  # the third time nothing is new
        if part is not None:
            part.repartition(1).write.mode("append").parquet(f"{folder}/in")
        due = progress.notices(spark.readStream.schema(rows.schema).parquet(f"{folder}/in"), 15, 60.0, timer=False)
        progress.deliver(due, f"{folder}/log", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    return commits.read(spark, f"{folder}/log", "run_id string, label string, successful long, at double")


def run_rows(spark, sf_dir):
    """Rows of a run: id, error, shard and ordinal; a third of the documents have an id in common with the one before."""
    error = F.when(F.col("doc_id") % 11 == 0, "failed").otherwise("")
    return read(spark, sf_dir, "documents").select(F.when(F.col("doc_id") % 3 == 1, F.col("doc_id") - 1).otherwise(F.col("doc_id")).cast("string").alias("id"), error.alias("error"), (F.col("doc_id") % 8).cast("int").alias("shard"), F.col("doc_id").alias("ordinal"))


def j2_pending(spark, sf_dir):
    planned = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"))
    return selection.pending(planned, run_rows(spark, sf_dir))


def w3_combine(spark, sf_dir):
    return selection.combine(run_rows(spark, sf_dir), "ordinal")


def shard_status(spark, sf_dir):
    plan = selection.shard_plan(spark, 800, 8, ["casual", "terse"], 0)
    return status.shard_status(plan, run_rows(spark, sf_dir))


def a4_shard_status(spark, sf_dir):
    return shard_status(spark, sf_dir).select("ix", "profile", "target", "rows", "successful", "errors", "done")


def a5_run_totals(spark, sf_dir):
    return status.run_totals(shard_status(spark, sf_dir))


def a6_notifier_status(spark, sf_dir):
    return status.notifier_status(run_rows(spark, sf_dir), 800)


def a8_dedupe_counters(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return status.dedupe_counters(docs, selection.dedupe_questions(docs, "text", "doc_id"))


def a9_conversation_sums(spark, sf_dir):
    return conversations.sums(read(spark, sf_dir, "conversations"))


def w15_length_bands(spark, sf_dir):
    return status.length_bands(read(spark, sf_dir, "documents"), "text", [12, 40, 400])


def j8_scenarios(spark, sf_dir):
    return selection.lookup(read(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", SCENARIOS, "scenario", "anywhere")


def f24_progress(spark, sf_dir):
    """Of each source's documents those labelled so far, as a run of 90 seconds."""
    labels = read(spark, sf_dir, "labels").select("doc_id").distinct().withColumn("hit", F.lit(1))
    by = read(spark, sf_dir, "documents").select("doc_id", "source").join(labels, "doc_id", "left").groupBy("source").agg(F.count("*").alias("total"), F.count("hit").alias("completed"))
    return by.select("source", "total", "completed", F.round(100.0 * F.col("completed") / F.greatest(F.lit(1), "total"), 6).alias("pct"), tx.eta(F.col("total"), F.col("completed"), F.col("completed"), F.lit(90.0)).alias("eta"))


def w13_plan_rows(spark, sf_dir):
    """A row of a run for each document: its category, number of replies and user are drawn by its number."""
    ix = F.col("doc_id")
    spec = selection.uniform_draws(7, F.format_string("pilot-7-%05d", ix), AXES)
    return read(spark, sf_dir, "documents").select(F.format_string("pilot-7-%05d", ix).alias("id"), selection.weighted_draw(7, ix, "category", PLAN).alias("category"), selection.weighted_draw(7, ix, "replies", REPLIES).cast("int").alias("target_replies"), tx.user_label(spec).alias("user"))


def f22_question_ids(spark, sf_dir):
    """Questions of replies, with the ids of the prompt, the call and their place."""
    found = f17_questions(spark, sf_dir)
    return found.select(F.format_string("%s-%04d-%03d", F.col("conv_id").cast("string"), "part", "k").alias("id"), "question")


def u1_union_tagged(spark, sf_dir):
    """Tables of different columns as one, each row with the name of its table."""
    parts = {"documents": read(spark, sf_dir, "documents").select("doc_id", "lang"), "labels": read(spark, sf_dir, "labels").select("doc_id", "quality"), "benchmark": read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"))}
    return selection.union_tagged(parts, "part")


def j6_lookup(spark, sf_dir):
    """Parsed replies joined to the rows they answer; replies to no row, and rows without one, fall out."""
    said = read(spark, sf_dir, "conversations")
    replies = said.where("role = 'assistant'").select(F.col("conv_id").alias("c"), (F.col("turn") - 1).cast("string").alias("id"), F.col("text").alias("reply"))
    asked = said.where("role = 'user'").select("conv_id", "turn", F.col("turn").cast("string").alias("id"), F.col("text").alias("question"))
    return answers.by_id(asked, replies.withColumnRenamed("c", "conv_id"), ["conv_id", "id"]).select("conv_id", "turn", "question", "reply")


def w14_job_grid(spark, sf_dir):
    return selection.job_grid(read(spark, sf_dir, "benchmark").select("item_id"), 3).select("item_id", "call_ix", F.format_string("%d-%04d", "item_id", "call_ix").alias("id"))


def k1_jsonl_round_trip(spark, sf_dir):
    folder = shared.folder(spark, "jsonl")
    jsonl.write_jsonl(read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"), folder)
    return jsonl.read_strict(spark, folder, "conv_id bigint, turn bigint, role string, text string")


def s2_lenient_scan(spark, sf_dir):
    """Each seventh line is broken; good rows and error rows, in order of their lines."""
    folder = shared.folder(spark, "lines")
    line = F.to_json(F.struct("conv_id", "turn"))
    rows = read(spark, sf_dir, "conversations").select(F.when(F.col("turn") % 7 == 3, F.concat(F.lit("x"), line)).otherwise(line).alias("value"))
    rows.write.text(folder)
    good, bad = jsonl.read_lenient(spark, folder, "conv_id bigint, turn bigint")
    return good.select(F.to_json(F.struct("conv_id", "turn")).alias("line"), F.lit("").alias("error")).unionByName(bad.select("line", "error"))


def t3_follow(spark, sf_dir):
    """Landed rows followed until nothing is new; rows with an error stay hidden."""
    folder = shared.folder(spark, "follow")
    error = F.when(F.col("turn") % 5 == 2, "failed")
    jsonl.write_jsonl(read(spark, sf_dir, "conversations").select("conv_id", "turn", error.alias("error")), f"{folder}/in")
    schema = "conv_id bigint, turn bigint, error string"
    rows = progress.follow(spark, f"{folder}/in", schema)
    rows.writeStream.format("parquet").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start(f"{folder}/out").awaitTermination()
    return spark.read.schema(schema).parquet(f"{folder}/out").select("conv_id", "turn")


QUERIES = {
    f.__name__: f
    for f in (
        f2_words, f8_shared_runs, f13_clean_answers, f15_batch_answers, f16_batch_replies, f17_questions, f18_messages, f21_user_labels, f24_progress, p3_user_items, p5_flags, p6_reply_problems, k6_pretty,
        w2_refilter, w8_refilter_first_20, j2_pending, w3_combine, a4_shard_status, a5_run_totals, a6_notifier_status, a8_dedupe_counters, a9_conversation_sums, w15_length_bands, j8_scenarios, w13_plan_rows,
        w14_job_grid, k1_jsonl_round_trip, s2_lenient_scan, t3_follow,
        p3_reply_items, p4_stored_rows, c3_token_shares, c4_pack_batches, p8_unfiltered, k3_split_answers, s4_numbered_lines, s6_in_order, p1_question_orders, w5_by_language, w9_slice, a12_common_starts,
        t1_follow_until,
        f7_longest_runs, c4_one_shard, w15_mix, c11_review, s4_total_order, t3_growing_files, k2_append_resume, t2_notices, f22_question_ids, u1_union_tagged, j6_lookup, s5_audit_issues, a1_export_counts,
    )
}

_SAID = f"FROM conversations WHERE role = '{{}}' AND {cs.strip("coalesce(text, '')")} <> ''"
_KEPT = "regexp_extract_all(lower(replace(coalesce(text, ''), '\\n', chr(10))), '[a-z0-9'']+')"
_RUN_ROWS = """r AS (SELECT CAST(CASE WHEN doc_id % 3 = 1 THEN doc_id - 1 ELSE doc_id END AS VARCHAR) AS id, CASE WHEN doc_id % 11 = 0 THEN 'failed' ELSE '' END AS error, doc_id % 8 AS shard,
    doc_id AS ordinal
  FROM documents)"""
_STATUS = f"""{_RUN_ROWS},
n AS (SELECT shard, count(*) AS rows, count(DISTINCT id) FILTER (WHERE error = '') AS successful FROM r GROUP BY shard),
s AS (SELECT ix, ['casual', 'terse'][ix % 2 + 1] AS profile, 100 AS target, coalesce(rows, 0) AS rows, coalesce(successful, 0) AS successful, greatest(0, coalesce(rows, 0) - coalesce(successful, 0)) AS errors, coalesce(successful, 0) >= 100 AS done FROM range(8) t(ix) LEFT JOIN n ON shard = ix)"""
_ANSWER = f"""CASE WHEN bit IS NOT NULL THEN 'contains ' || bit WHEN regexp_matches(a, '[\\x{{1F300}}-\\x{{1FAFF}}]') THEN 'emoji' WHEN trim(a) = '' THEN 'empty' WHEN len(regexp_extract_all(a,
    '\\S+')) > 55 THEN 'too_long' ELSE 'ok' END"""
_REFILTER = f"""WITH p AS ({cs.PREVIOUS}),
q AS (SELECT *, row_number() OVER (PARTITION BY lower({cs.strip("user_text")}) ORDER BY conv_id, turn) AS i, lower({cs.strip("coalesce(text, '')")}) AS a FROM p WHERE role = 'assistant' AND {cs.strip("coalesce(user_text, '')")} <> ''),
z AS (SELECT *, list_filter([{cs.listed(answers.BAD_BITS)}], lambda b: contains(a, b))[1] AS bit FROM q WHERE i = 1),
y AS (SELECT conv_id, turn, {_ANSWER} AS reason FROM z),
x AS (SELECT *, reason = 'ok' AS ok, count(*) FILTER (WHERE reason = 'ok') OVER (ORDER BY conv_id, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM y)"""
_HEAD = f"""WITH k AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k, {cs.strip("replace(coalesce(text, ''), '\\n', chr(10))")} AS c
  FROM conversations)"""
_HISTORY = "list({role: CASE WHEN role = 'assistant' THEN 'poke' ELSE 'user' END, content: c} ORDER BY k)"
_FULL = "f.items + 1 > 5 OR 100 + greatest(1, CAST(ceil((f.used + r.cost + 1) / 4) AS BIGINT)) > 500"


def _draw(axis: str, ix: str = "i") -> str:
    return f"('0x' || left(md5('7|' || {ix} || '|{axis}'), 13))::BIGINT"


def _drawn(axis: str, weights: dict[str, float]) -> str:
    below, cases = 0.0, []
    for k, w in weights.items():
        if w > 0:
            below += w / sum(weights.values())
            cases.append(f"WHEN {_draw(axis)} / 4503599627370496.0::DOUBLE < {below!r}::DOUBLE THEN '{k}'")
    return f"CASE {' '.join(cases)} ELSE '{[k for k, w in weights.items() if w > 0][-1]}' END"


def _picked(axis: str) -> str:
    return f"[{cs.listed(AXES[axis])}][{_draw(axis, "format('pilot-7-{:05d}', i)")} % {len(AXES[axis])} + 1]"


_LEFT = "(CASE WHEN completed > 0 THEN (total - completed) * 90.0 / completed ELSE 0 END)"
ORACLE_SQL = {
    "f2_words": f"""SELECT doc_id, len({cs.words("coalesce(text, '')")}) AS n_words, len({_KEPT}) AS n_words_kept, len(list_distinct(list_filter({_KEPT},
    lambda w: len(w) > 2 AND w NOT IN ({cs.listed(tx.CONTENT_STOPWORDS)})))) AS n_content
  FROM documents""",
    "f8_shared_runs": f"""SELECT conv_id, turn, {", ".join(f"{cs.run('u', 'r', n)} AS run_{n}" for n in (1, 2, 3))}
  FROM (SELECT conv_id, turn, {cs.words("user_text")} AS u, {cs.words("coalesce(text, '')")} AS r
  FROM ({cs.PREVIOUS})
  WHERE role = 'assistant' AND user_text IS NOT NULL)""",
    "f13_clean_answers": f"""SELECT conv_id, turn, CASE WHEN text IS NULL AND turn % 3 = 1 THEN '{{"assistant":1}}' ELSE {cs.strip("text")} END AS answer FROM conversations""",
    "f15_batch_answers": f"SELECT conv_id, turn::VARCHAR AS id, {cs.strip("text")} AS answer {_SAID.format('assistant')}",
    "f16_batch_replies": f"SELECT conv_id, turn::VARCHAR AS id, {cs.strip("text")} AS reply {_SAID.format('assistant')}",
    "f17_questions": f"""SELECT conv_id, turn // 20 AS part, row_number() OVER (PARTITION BY conv_id, turn // 20 ORDER BY turn) - 1 AS k, {cs.strip("text")} AS question {_SAID.format('user')}""",
    "f18_messages": f"""WITH m AS (SELECT conv_id, turn, {cs.strip("replace(coalesce(text, ''), '\\n', chr(10))")} AS c FROM conversations),
p AS (SELECT conv_id, turn, c, list_filter(list_transform(string_split(c, chr(10) || chr(10)), lambda x: {cs.strip("x")}), lambda x: x <> '') AS parts FROM m),
q AS (SELECT conv_id, turn, CASE WHEN len(parts) > 0 THEN parts ELSE [c] END AS parts FROM p)
SELECT conv_id, turn, unnest(range(len(parts))) AS k, unnest(parts) AS message FROM q""",
    "f21_user_labels": """SELECT c_custkey, 'user_' || left(sha1('{"nation": "' || c_nationkey || '", "segment": "' || c_mktsegment || '"}'), 10) AS label FROM customer""",
    "f24_progress": f"""WITH b AS (SELECT source, count(*) AS total, count(l.doc_id) AS completed FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id) GROUP BY source),
e AS (SELECT *, CAST(floor({_LEFT}) AS BIGINT) AS s FROM b)
SELECT source, total, completed, round(100.0 * completed / total, 6)::DOUBLE AS pct, CASE WHEN s < 60 THEN format('{{}}s', s) WHEN s < 3600 THEN format('{{}}m{{:02d}}s', s // 60, s % 60) ELSE format('{{}}h{{:02d}}m', s // 3600, s % 3600 // 60) END AS eta FROM e""",
    "p3_user_items": f"""{_HEAD}
SELECT conv_id, to_json({{instruction: 'Write the next text.', items: [{{id: conv_id::VARCHAR, topic: 'topic ' || conv_id % 7, category: 'chat', scenario: NULL::VARCHAR, user_spec: MAP {{'mood': 'm' || conv_id % 3}},
  user_prompt_profile: 'casual', is_opener: false, history: {_HISTORY}}}]}})::VARCHAR AS payload FROM k GROUP BY conv_id""",
    "p3_reply_items": f"""{_HEAD}
SELECT conv_id, to_json({{instruction: 'Answer each.', items: [{{id: conv_id::VARCHAR, topic: 'topic ' || conv_id % 7, category: 'chat', history: {_HISTORY}}}]}})::VARCHAR AS payload FROM k GROUP BY conv_id""",
    "p4_stored_rows": """SELECT conv_id::VARCHAR AS id, to_json({id: conv_id::VARCHAR, user: NULL::VARCHAR, category: 'chat', topic: 'topic ' || conv_id % 7, scenario: NULL::VARCHAR, user_prompt_profile: 'casual', turns: count(*),
  poke_model: 'model-a', user_model: 'model-b', error: NULL::VARCHAR, total_prompt_tokens: NULL::VARCHAR, total_completion_tokens: NULL::VARCHAR})::VARCHAR AS row FROM conversations GROUP BY conv_id""",
    "c3_token_shares": """WITH b AS (SELECT conv_id // 8 AS b, count(DISTINCT conv_id) AS n, sum(len(coalesce(text, ''))) AS p, count(*) AS c FROM conversations GROUP BY 1)
SELECT member, (p // n)::BIGINT AS prompt_share, (c // n)::BIGINT AS completion_share FROM (SELECT DISTINCT conv_id AS member FROM conversations) m JOIN b ON b.b = member // 8""",
    "c4_pack_batches": f"""WITH RECURSIVE r AS (SELECT conv_id, turn, len(to_json({{turn: turn, text: coalesce(text, '')}})::VARCHAR) AS cost, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations),
f AS (SELECT conv_id, turn, k, 1 AS items, 40 + cost AS used, CAST(0 AS BIGINT) AS batch FROM r WHERE k = 1
UNION ALL SELECT r.conv_id, r.turn, r.k, CASE WHEN {_FULL} THEN 1 ELSE f.items + 1 END, CASE WHEN {_FULL} THEN 40 + r.cost ELSE f.used + r.cost + 1 END, CASE WHEN {_FULL} THEN f.batch + 1 ELSE f.batch END
FROM f JOIN r ON r.conv_id = f.conv_id AND r.k = f.k + 1)
SELECT conv_id, turn, batch FROM f""",
    "p8_unfiltered": f"""SELECT conv_id, turn, {cs.strip("coalesce(text, '')")} <> '' AS ok, CASE WHEN {cs.strip("coalesce(text, '')")} = '' THEN 'empty' ELSE 'unfiltered' END AS reason
  FROM conversations
  WHERE role = 'assistant'""",
    "k3_split_answers": f"""WITH z AS (SELECT conv_id, turn, a, list_filter([{cs.listed(answers.BAD_BITS)}], lambda b: contains(a, b))[1] AS bit FROM (SELECT conv_id, turn, lower(coalesce(text, '')) AS a FROM conversations WHERE role = 'assistant')),
y AS (SELECT conv_id, turn, {_ANSWER} AS reason FROM z)
SELECT conv_id, turn, reason, 'raw' AS output FROM y UNION ALL SELECT conv_id, turn, reason, CASE WHEN reason = 'ok' THEN 'kept' ELSE 'rejected' END FROM y""",
    "s4_numbered_lines": """SELECT role, 'part-00000' AS file, source_line, line
  FROM (SELECT role, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) AS source_line, turn, conv_id || ':' || turn AS line
  FROM conversations
  WHERE role IN ('user', 'assistant'))
  WHERE turn % 9 <> 4""",
    "s6_in_order": """SELECT conv_id, turn, min(k) AS first_input, count(*) AS n
  FROM (SELECT conv_id, turn, unnest(list_filter([0, 1, 2], lambda i: conv_id % [5, 2, 3][i + 1] = 0)) AS k
  FROM conversations)
  GROUP BY ALL""",
    "p1_question_orders": f"""WITH r AS (SELECT doc_id, CASE WHEN doc_id % 4 > 0 THEN text END AS question, CASE WHEN doc_id % 3 > 0 THEN concat_ws(' ', source, lang) ELSE '' END AS prompt FROM documents),
q AS (SELECT doc_id, 0 AS order_ix, coalesce(nullif(question, ''), nullif(prompt, ''), '') AS text FROM r UNION ALL SELECT doc_id, 1, coalesce(nullif(prompt, ''), nullif(question, ''), '') FROM r)
SELECT min(doc_id) AS doc_id, {cs.KEY} AS dedupe_key, order_ix FROM q WHERE {cs.strip("text")} <> '' GROUP BY 2, 3""",
    "w5_by_language": f"""WITH caps(lang, cap) AS (VALUES {", ".join(f"('{k}', {v})" for k, v in selection.quotas(10_000, LANGUAGES).items())}),
one AS (SELECT doc_id, lang FROM (SELECT doc_id, lang, cap, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS i FROM documents JOIN caps USING (lang)) WHERE i <= cap),
two AS (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) AS i FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM one))
SELECT doc_id, lang, 1 AS selection_pass FROM one UNION ALL SELECT doc_id, lang, 2 FROM two WHERE i <= 10000 - (SELECT count(*) FROM one)""",
    "w9_slice": "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 30 OFFSET 20",
    "a12_common_starts": """SELECT start, count(*) AS n
  FROM (SELECT array_to_string(w[1:2], ' ') AS start
  FROM (SELECT regexp_extract_all(lower(coalesce(text, '')), '[^\\x20\\x09-\\x0D]+') AS w
  FROM conversations)
  WHERE len(w) >= 2)
  GROUP BY start
  ORDER BY n DESC, start LIMIT 25""",
    "t1_follow_until": "SELECT conv_id, turn FROM conversations WHERE turn % 5 <> 2",
    "w13_plan_rows": f"""SELECT format('pilot-7-{{:05d}}', i) AS id, {_drawn("category", PLAN)} AS category, CAST({_drawn("replies", REPLIES)} AS INT) AS target_replies,
  'user_' || left(sha1('{{"mood": "' || {_picked("mood")} || '", "style": "' || {_picked("style")} || '"}}'), 10) AS user FROM (SELECT doc_id AS i FROM documents)""",
    "p5_flags": f"""SELECT conv_id, turn, upper({cs.strip("coalesce(text, '')")}) IN ({cs.listed(tx.END_SENTINELS)}) AS is_end, {cs.contains_any("lower(coalesce(text, ''))",
    conversations.IDENTITY_LEAKS)} AS identity_leak, {cs.contains_any("lower(coalesce(text, ''))", conversations.TRANSCRIPT_META)} AS transcript_meta, contains(coalesce(text, ''),
    'User:') AS has_user, contains(coalesce(text, ''), 'Assistant:') AS has_assistant, {cs.strip("coalesce(text, '')")} = '' AS is_empty
  FROM conversations""",
    "p6_reply_problems": cs.REPLAY[: cs.REPLAY.index(",\nn AS")] + " SELECT conv_id, turn, bad AS problem FROM b WHERE role = 'assistant'",
    "k6_pretty": f"""{_HEAD}
SELECT conv_id, repeat('=', 100) || chr(10) || 'id=' || conv_id || '  file=conversations  category=None  profile=None' || chr(10) || repeat('-', 100) || chr(10) || string_agg(chr(10) || CASE WHEN role = 'assistant' THEN 'POKE' ELSE 'USER' END || ':' || chr(10) || CASE WHEN c = '' THEN '[empty]' ELSE c END, chr(10) ORDER BY k) AS shown FROM k GROUP BY conv_id""",
    "w2_refilter": f"{_REFILTER} SELECT conv_id, turn, reason, ok FROM x",
    "w8_refilter_first_20": f"{_REFILTER} SELECT conv_id, turn, reason, ok FROM x WHERE before < 20",
    "j2_pending": f"WITH {_RUN_ROWS} SELECT doc_id::VARCHAR AS id FROM documents WHERE doc_id::VARCHAR NOT IN (SELECT id FROM r WHERE error = '')",
    "w3_combine": f"""WITH {_RUN_ROWS} SELECT id, error, shard, ordinal
  FROM (SELECT *, row_number() OVER (PARTITION BY id, error ORDER BY ordinal) AS i
  FROM r)
  WHERE i = 1 OR error <> ''""",
    "a4_shard_status": f"WITH {_STATUS} SELECT * FROM s",
    "a5_run_totals": f"""WITH {_STATUS} SELECT sum(target) AS target, sum(rows) AS rows, sum(successful) AS successful, sum(errors) AS errors, count(*) FILTER (WHERE done) AS done_shards, count(*) AS total_shards
  FROM s""",
    "a6_notifier_status": f"""WITH {_RUN_ROWS} SELECT count(*) AS rows, count(*) FILTER (WHERE error = '') AS successful, count(*) FILTER (WHERE error <> '') AS errors,
    (100.0 * count(*) FILTER (WHERE error = '') / 800)::DOUBLE AS pct
  FROM r""",
    "a8_dedupe_counters": f"""SELECT count(*) AS read, count(DISTINCT k) FILTER (WHERE s <> '') AS kept, count(*) - count(DISTINCT k) FILTER (WHERE s <> '') AS duplicates
  FROM (SELECT {cs.strip("coalesce(text, '')")} AS s, {cs.KEY} AS k
  FROM documents)""",
    "a9_conversation_sums": """WITH c AS (SELECT conv_id, role = 'assistant' AS reply, greatest(1, CAST(ceil(len(coalesce(text, '')) / 4) AS BIGINT)) AS cost
  FROM conversations) SELECT conv_id, count(*) FILTER (WHERE reply) AS replies, sum(CASE WHEN reply THEN 0 ELSE cost END)::BIGINT AS prompt_tokens,
    sum(CASE WHEN reply THEN cost ELSE 0 END)::BIGINT AS reply_tokens
  FROM c
  GROUP BY conv_id""",
    "w15_length_bands": """SELECT CASE WHEN n <= 12 THEN 0 WHEN n <= 40 THEN 1 WHEN n <= 400 THEN 2 ELSE 3 END AS band, count(*) AS n
  FROM (SELECT len(regexp_extract_all(coalesce(text, ''), '\\S+')) AS n
  FROM documents)
  GROUP BY 1""",
    "j8_scenarios": f"SELECT doc_id, lang, CASE lang {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SCENARIOS.items())} ELSE 'anywhere' END AS scenario FROM documents",
    "w14_job_grid": "SELECT item_id, call_ix, format('{}-{:04d}', item_id, call_ix) AS id FROM benchmark, range(3) t(call_ix)",
    "k1_jsonl_round_trip": "SELECT conv_id, turn, role, text FROM conversations",
    "s2_lenient_scan": """SELECT CASE WHEN turn % 7 = 3 THEN 'x' ELSE '' END || '{"conv_id":' || conv_id || ',"turn":' || turn || '}' AS line, CASE WHEN turn % 7 = 3 THEN 'invalid json' ELSE '' END AS error FROM conversations""",
    "t3_follow": "SELECT conv_id, turn FROM conversations WHERE turn % 5 <> 2",
    "f7_longest_runs": f"""WITH r AS (SELECT conv_id, turn, {cs.words("user_text")} AS u, {cs.words("coalesce(text, '')")} AS r FROM ({cs.PREVIOUS}) WHERE role = 'assistant' AND user_text IS NOT NULL),
m AS (SELECT conv_id, turn, i, i - j AS d FROM (SELECT conv_id, turn, unnest(u) AS w, unnest(range(len(u))) AS i FROM r) JOIN (SELECT conv_id, turn, unnest(r) AS w, unnest(range(len(r))) AS j FROM r) USING (conv_id, turn, w)),
g AS (SELECT conv_id, turn, count(*) AS n, min(i) AS i FROM (SELECT *, i - row_number() OVER (PARTITION BY conv_id, turn, d ORDER BY i) AS k FROM m) GROUP BY conv_id, turn, d, k)
SELECT conv_id, turn, coalesce(max(n), 0)::INTEGER AS length, coalesce(arg_max(i, (n, -i)) FILTER (WHERE n IS NOT NULL), -1)::INTEGER AS start FROM r LEFT JOIN g USING (conv_id, turn) GROUP BY ALL""",
    "c4_one_shard": """WITH RECURSIVE r AS MATERIALIZED (SELECT conv_id, turn, greatest(1, CAST(ceil(len(coalesce(text, '')) / 4) AS BIGINT)) AS cost, row_number() OVER (ORDER BY conv_id, turn) AS k FROM conversations),
f AS (SELECT conv_id, turn, k, 1 AS items, cost AS used, CAST(0 AS BIGINT) AS batch FROM r WHERE k = 1
UNION ALL SELECT r.conv_id, r.turn, r.k, CASE WHEN f.items + 1 > 5 OR f.used + r.cost + 2 > 120 THEN 1 ELSE f.items + 1 END, CASE WHEN f.items + 1 > 5 OR f.used + r.cost + 2 > 120 THEN r.cost ELSE f.used + r.cost + 2 END, CASE WHEN f.items + 1 > 5 OR f.used + r.cost + 2 > 120 THEN f.batch + 1 ELSE f.batch END FROM f JOIN r ON r.k = f.k + 1)
SELECT conv_id, turn, batch FROM f""",
    "w15_mix": f"SELECT * FROM (VALUES {', '.join(f"('{c}', '{v}', {n}::BIGINT, {n}::BIGINT, 0::BIGINT)" for c, shares in MIX.items() for v, n in selection.quotas(MIX_LIMIT, shares).items())}) t(margin, value, target, got, shortfall)",
    "c11_review": """WITH d AS (SELECT doc_id AS id, CASE WHEN quality = 1 THEN 'accept' ELSE 'reject' END AS decision, 'first look' AS note, 1 AS k FROM labels
UNION ALL SELECT doc_id, CASE WHEN toxic = 1 THEN 'reject' WHEN doc_id % 2 = 0 THEN 'skip' ELSE 'accept' END, 'toxic: ' || toxic, 2 FROM labels WHERE doc_id % 3 = 0),
l AS (SELECT id, decision, note FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY k DESC, decision DESC, note DESC) AS i FROM d WHERE decision <> 'skip') WHERE i = 1),
r AS (SELECT doc_id AS id, lang AS category, decision, note FROM documents LEFT JOIN l ON l.id = doc_id)
SELECT id, 'accepted' AS output, category, NULL::VARCHAR AS note FROM r WHERE decision = 'accept' UNION ALL SELECT id, 'rejected', category, note FROM r WHERE decision = 'reject'
UNION ALL SELECT id, 'reviews', category, CASE WHEN decision = 'reject' THEN note ELSE '' END FROM r WHERE decision IS NOT NULL UNION ALL SELECT id, 'remaining', category, NULL FROM r WHERE decision IS NULL AND id >= 50""",
    "s4_total_order": """WITH r AS (SELECT doc_id, lang, CASE WHEN doc_id % 7 = 0 THEN 0 ELSE 1 END AS input_ix, CASE WHEN doc_id % 7 = 0 THEN 'z' WHEN doc_id % 50 = 0 THEN 'a' WHEN doc_id % 10 < 8 THEN 'b' ELSE 'c' END AS shard FROM documents)
SELECT doc_id, input_ix::BIGINT AS input_ix, row_number() OVER (PARTITION BY input_ix, shard ORDER BY doc_id) AS source_line, row_number() OVER (PARTITION BY input_ix ORDER BY shard, doc_id) - 1 AS place,
    row_number() OVER (PARTITION BY lang ORDER BY input_ix, shard, doc_id) = 1 AS first FROM r""",
    "t3_growing_files": """SELECT conv_id % 4 || '.jsonl' AS source_file, CASE WHEN turn % 9 <> 4 THEN conv_id END AS conv_id, CASE WHEN turn % 9 <> 4 THEN turn END AS turn,
    CASE WHEN turn % 9 = 4 THEN 'invalid_json' WHEN turn % 5 = 2 THEN 'failed' END AS error, CASE WHEN turn % 9 = 4 THEN 'x{"conv_id":' || conv_id || '}' END AS line
  FROM conversations""",
    "k2_append_resume": """WITH d AS (SELECT doc_id::VARCHAR AS id, CASE WHEN doc_id % 4 < 3 AND doc_id % 11 = 0 THEN 'failed' END AS error, doc_id * 2 AS result FROM documents),
a AS (SELECT * FROM d UNION ALL SELECT id, NULL, result FROM d WHERE error IS NOT NULL)
SELECT id, error, result, (SELECT count(*) FROM a) AS rows FROM a""",
    "t2_notices": """WITH RECURSIVE r AS MATERIALIZED (SELECT source AS run_id, doc_id::DOUBLE AS t, doc_id % 11 > 0 AS ok, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents),
f AS (SELECT run_id, 0::BIGINT AS k, NULL::DOUBLE AS t, 0::BIGINT AS n, 0::BIGINT AS last_n, 0::DOUBLE AS last_at, false AS started, false AS done, NULL::VARCHAR AS due FROM (SELECT DISTINCT run_id FROM r)
UNION ALL SELECT run_id, k, t, n, CASE WHEN due IS NOT NULL THEN n ELSE last_n END, CASE WHEN due IS NOT NULL THEN t ELSE last_at END, started OR due IS NOT NULL, done OR coalesce(due = 'done', false), due
  FROM (SELECT *, CASE WHEN NOT started THEN 'started' WHEN n >= 40 AND NOT done THEN 'done' WHEN n >= last_n + 15 THEN 'progress' WHEN n > last_n AND t - last_at >= 60 THEN 'heartbeat' END AS due
  FROM (SELECT f.run_id, r.k, r.t, f.n + r.ok::BIGINT AS n, f.last_n, f.last_at, f.started, f.done FROM f JOIN r ON r.run_id = f.run_id AND r.k = f.k + 1)))
SELECT run_id, due AS label, n AS successful, t AS "at" FROM f WHERE due IS NOT NULL""",
    "f22_question_ids": f"""SELECT format('{{}}-{{:04d}}-{{:03d}}', conv_id, turn // 20, row_number() OVER (PARTITION BY conv_id, turn // 20 ORDER BY turn) - 1) AS id, {cs.strip("text")} AS question {_SAID.format('user')}""",
    "u1_union_tagged": """SELECT doc_id, lang, NULL AS quality, 'documents' AS part FROM documents UNION ALL SELECT doc_id, NULL, quality, 'labels' FROM labels UNION ALL SELECT item_id, NULL, NULL, 'benchmark' FROM benchmark""",
    "j6_lookup": """SELECT u.conv_id, u.turn, u.text AS question, a.text AS reply FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant'""",
    "s5_audit_issues": f"""WITH c AS (SELECT conv_id, sum(1 + (conv_id % 7 = 0)::INT) OVER (PARTITION BY conv_id % 2 ORDER BY conv_id)::BIGINT AS line FROM (SELECT DISTINCT conv_id FROM conversations)),
k AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place FROM conversations),
a AS ({cs.SQL["l4_echo_audit"]}),
p AS ({cs.PREVIOUS})
SELECT CASE WHEN conv_id % 5 > 0 THEN conv_id::VARCHAR ELSE 'None' END AS id, (conv_id % 2)::VARCHAR AS file, line, place::INTEGER AS turn, reason, {cs.strip("replace(coalesce(user_text, ''), '\\n', chr(10))")} AS user, {cs.strip("replace(coalesce(text, ''), '\\n', chr(10))")} AS assistant
  FROM a JOIN c USING (conv_id) JOIN k USING (conv_id, turn) JOIN p USING (conv_id, turn)""",
    "a1_export_counts": f"""WITH c AS ({cs.SQL["c1_clean_rows"]}), k AS ({cs.SQL["c2_salvage"]})
SELECT 'rejects' AS kind, reason AS value, count(*) AS n FROM c WHERE conv_id NOT IN (SELECT conv_id FROM k) GROUP BY reason
UNION ALL SELECT 'salvaged', reason, count(*) FROM c JOIN k USING (conv_id) WHERE reason <> 'ok' GROUP BY reason
UNION ALL SELECT 'turns', kept_turns::VARCHAR, count(*) FROM k GROUP BY kept_turns
UNION ALL SELECT 'categories', 'c' || conv_id % 300, count(*) FROM k GROUP BY conv_id % 300
UNION ALL SELECT 'eligible', '', count(*) FROM k""",
}
