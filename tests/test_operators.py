import hashlib
import json
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from quillmill.functions import text as tx
from quillmill.operators import answers, conversations, echo, selection, status
from quillmill.sources import jsonl
from quillmill.streaming import progress


def one(spark, column, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(column.alias("x")).first()["x"]


def test_text_functions(spark):
    assert one(spark, tx.dedupe_key(F.col("c0")), '  What is  “It”?? ') == "what is it"
    assert one(spark, tx.dedupe_key(F.col("c0")), 'foo? "') == "foo? "
    assert one(spark, tx.words(F.col("c0")), "I don't see 'it' a b2") == ["dont", "see", "it", "b2"]
    assert one(spark, tx.words_kept(F.col("c0")), "a\\nb don't") == ["a", "b", "don't"]
    assert one(spark, F.size(tx.ngrams(tx.words(F.col("c0")), 3)), "two words") == 0
    assert one(spark, tx.split_messages(F.col("c0")), "a\n\n b \n\n") == ["a", "b"]
    assert one(spark, tx.first_set(F.col("c0"), F.col("c1")), "", " x ") == "x"
    assert one(spark, tx.first_set(F.col("c0"), F.col("c1")), "  ", "x") == ""
    assert one(spark, tx.clean_answer(F.col("c0")), '```json\n{"assistant": 3, "answer": "poke: hi"}\n```') == "hi"
    assert [one(spark, tx.duration(F.col("c0").cast("int")), s) for s in ("5", "65", "3725")] == ["5s", "1m05s", "1h02m"]


PAIRS = [
    ("so cool", "so cool indeed friend", "generator", "short_exact_echo"),
    ("my garden hedgehog escaped yesterday morning", "your garden hedgehog escaped yesterday morning wow", "generator", "long_common_phrase"),
    ("it was the one that you were with", "wow the one that you were", "audit", "exact_5gram"),
    ("it was the one that you were with", "wow the one that you were", "generator", None),
    ("garden hedgehog escaped yesterday", "yeah garden hedgehog escaped", "generator", "reflective_exact_3gram"),
    ("purple tractor wheel broken hedgehog", "basically tractor purple nonsense wheel", "generator", "agreement_rephrase"),
    ("purple tractor wheel broken hedgehog", "basically tractor purple nonsense wheel", "audit", None),
    ("anything", "", "generator", None),
]


def test_echo_reasons(spark):
    for variant in ("generator", "audit"):
        rows = [(i, u, r) for i, (u, r, v, _) in enumerate(PAIRS) if v == variant]
        got = {x["i"]: x["reason"] for x in echo.with_echo_reason(spark.createDataFrame(rows, "i int, u string, r string"), "u", "r", variant=variant).collect()}
        assert got == {i: PAIRS[i][3] for i, *_ in rows}


def test_misassigned(spark):
    rows = [("b", "1", "purple tractor wheel broken", None, "lunar eclipse telescope tonight"), ("b", "2", "lunar eclipse telescope visible", None, "nice lunar eclipse")]
    got = {r["item_id"]: r["suspicious"] for r in echo.misassigned(spark.createDataFrame(rows, "batch_id string, item_id string, user string, topic string, reply string")).collect()}
    assert got == {"1": True, "2": False}


def conversation(spark, *texts, start="user"):
    roles = ["user", "assistant"] if start == "user" else ["assistant", "user"]
    return spark.createDataFrame([(1, i, roles[i % 2], t) for i, t in enumerate(texts)], "conv_id long, turn long, role string, text string")


def test_quality_and_salvage(spark):
    good = ["tell me of ducks", "ducks swim on ponds", "and geese then", "geese fly far south"]
    for texts, reason, kept in [
        (good, "ok", 4), (good[:3], "bad_turn_count", None), (good[:2] + ["", "why not me"], "empty_content", None), (good + ["more please now", "ok"], "generic_or_empty_assistant", 4),
        (good + ["more please now", "single"], "too_short_assistant", 4), (good + ["what else", "a marvelous thing"], "assistant_identity_leak", 4), (good + ["what else", "you asked me that"], "transcript_meta_reply", 4),
        (good + ["again then", "ducks swim on ponds"], "assistant_self_repeat", 4), (good + ["tell me of ducks", "rabbits dig deep holes"], "user_self_repeat", 4), (good + ["x y", "x y then what"], "assistant_echo", 4),
    ]:
        rows = conversations.with_quality(conversations.nested(conversation(spark, *texts), 14))
        assert rows.first()["reason"] == reason
        assert [r["kept_turns"] for r in conversations.salvaged(rows).collect()] == ([kept] if kept else [])
    assert conversations.with_quality(conversations.nested(conversation(spark, *good, start="assistant"), 14)).first()["reason"] == "bad_role_order"
    records = conversations.training_records(conversations.salvaged(conversations.with_quality(conversations.nested(conversation(spark, *good), 14))), system="s").orderBy("turns").collect()
    assert [(r["source_id"], r["turns"], len(r["messages"])) for r in records] == [("1#assistant_turn_1", 2, 3), ("1#assistant_turn_3", 4, 5)]


def test_replay(spark):
    got = conversations.replay(conversation(spark, "hi there", "well hello friend", "and", "[END]", "more"), 5).orderBy("turn").collect()
    assert [(r["turn"], r["error"]) for r in got][-1] == (3, "invalid_poke_reply:end_reply")


def test_selection(spark):
    assert selection.quotas(10_000, {4: 0.20, 6: 0.30, 8: 0.30, 10: 0.067, 12: 0.067, 14: 0.066}) == {4: 2000, 6: 3000, 8: 3000, 10: 670, 12: 670, 14: 660}
    df = spark.createDataFrame([(i, i % 3, i % 5) for i in range(30)], "o int, s int, k int")
    got = selection.stratified(df, "s", {0: 2, 1: 1}, 5, "o", "k").orderBy("o").collect()
    assert [(r["o"], r["selection_pass"]) for r in got] == [(0, 1), (1, 1), (2, 2), (3, 1), (4, 2)]
    rows = spark.createDataFrame([(0, "a", "bad"), (1, "a", None), (2, "a", None), (3, None, None), (4, None, None)], "o int, id string, error string")
    assert sorted(r["o"] for r in selection.combine(rows, "o").collect()) == [0, 1, 3]
    assert selection.pending(spark.createDataFrame([("a",), ("b",)], "id string"), rows).first()["id"] == "b"
    assert [r["target"] for r in selection.shard_plan(spark, 10, 3, ["x"], 0).orderBy("ix").collect()] == [4, 3, 3]
    drawn = selection.plan_rows(spark, 4000, 1, {"a": 0.75, "b": 0.25, "c": 0.0}, {"2": 1.0}).groupBy("category").count().collect()
    assert {r["category"] for r in drawn} == {"a", "b"} and abs(dict(map(tuple, drawn))["a"] - 3000) < 150
    assert selection.job_grid(spark.createDataFrame([("p",)], "prompt string"), 3).count() == 3


def replies(spark, expected, text):
    return answers.with_batch_replies(spark.createDataFrame([(text,)], "raw string").withColumn("expected", expected), "raw", "expected").first()["replies"]


def test_numbered_with_a_hot_part(spark):
    rows = [(None if i % 7 == 0 else "hot" if i % 3 else "cold", i * 17 % 2003) for i in range(2003)]
    got = selection.numbered(spark.createDataFrame(rows, "s string, o int").repartition(5), "s", "o", "k").collect()
    for part in ("hot", "cold", None):
        assert [r["k"] for r in sorted((r for r in got if r["s"] == part), key=lambda r: r["o"])] == list(range(sum(x == part for x, _ in rows)))
    assert selection.numbered(spark.createDataFrame([], "s string, o int"), "s", "o", "k").count() == 0


def test_answers(spark):
    for text, reason in [("As an AI I say", "contains as an ai"), ("fine \U0001f600", "emoji"), (" ", "empty"), ("w " * 56, "too_long"), ("w " * 55, "ok")]:
        assert one(spark, answers.answer_reason(F.col("c0")), text) == reason
    assert one(spark, answers.parse_batch_answers(F.col("c0")), 'x {"answers": [{"id": 1, "answer": "a"}, {"id": 1, "response": "b"}, {"id": 2}, {"id": 3, "assistant": 7, "answer": "c"}, {"id": 4, "assistant": "", "answer": " d "}]}') == {"1": "b", "4": "d"}
    assert one(spark, answers.parse_batch_answers(F.col("c0")), "no json") is None
    assert one(spark, answers.parse_batch_answers(F.col("c0")), '```json\n[{"id": "x", "answer": "a"}]\n```') == {"x": "a"}
    assert replies(spark, F.array(F.lit("u")), '<item id="u"> a &amp; b </item>') == {"u": "a & b"}
    both = F.array(F.lit("u"), F.lit("v"))
    assert replies(spark, both, '<item id="u">a</item> {"items": [{"id": "v", "message": "b"}, {"id": "w", "message": "c"}]}') == {"u": "a", "v": "b"}
    assert replies(spark, both, '{"items": [{"id": "u", "message": "a"}, {"id": "v", "message": 3}]}') is None
    assert replies(spark, F.array(F.lit("u")), '<item id="u">open &lt;end') == {"u": "open <end"}
    assert replies(spark, F.array(F.lit("u"), F.lit("v")), '<item id="u">a</item>') is None
    assert one(spark, answers.extract_questions(F.col("c0")), "1. one?\n- two?\n\n") == ["one?", "two?"]
    assert one(spark, answers.extract_questions(F.col("c0")), '{"questions": ["q"]}') == ["q"]
    assert one(spark, answers.extract_questions(F.col("c0")), '{"questions": ["one?","two "yes"?","three?"') == ['{"questions": ["one?","two "yes"?","three?"']
    assert one(spark, answers.extract_questions(F.col("c0")), '{"questions": ["one?","two "yes"?","three?",]') == ["one?", 'two "yes"?', "three?"]
    assert one(spark, answers.provider(F.col("c0")), "o3-x") == "openai"
    assert one(spark, answers.retryable(F.lit(None).cast("int"), F.col("c0")), "Rate limit hit") and one(spark, answers.retryable(F.lit(529), F.col("c0")), "") and not one(spark, answers.retryable(F.lit(400), F.col("c0")), "bad")


def test_refilter(spark):
    rows = [(0, "Hi", "as an ai"), (1, "hi ", "fine"), (2, "", "fine"), (3, "b", "good"), (4, "c", ""), (5, "d", "good"), (6, "e", "good")]
    df = spark.createDataFrame(rows, "o int, u string, a string")
    assert [(r["o"], r["reason"]) for r in answers.refilter(df, "u", "a", "o").orderBy("o").collect()] == [(0, "contains as an ai"), (3, "ok"), (4, "empty"), (5, "ok"), (6, "ok")]
    assert [r["o"] for r in answers.refilter(df, "u", "a", "o", 2).orderBy("o").collect()] == [0, 3, 4, 5]
    assert answers.refilter(df, "u", "a", "o", 9).count() == 5


def test_documents(spark, tmp_path):
    path = str(tmp_path / "state.json")
    assert jsonl.read_document(path) == {}
    jsonl.write_document(path, {"a": "ö"})
    assert jsonl.read_document(path) == {"a": "ö"}
    try:
        jsonl.read_prompt(path)
        raise AssertionError
    except ValueError:
        pass
    (tmp_path / ".env").write_text("# note\nA='one two'\nHOME = x\nnothing\nB=\"3=4\"\n")
    assert jsonl.read_settings(str(tmp_path / ".env")) == {"A": "one two", "HOME": os.environ["HOME"], "B": "3=4"}
    turns = F.array(F.struct(F.lit("user").alias("role"), F.lit(" hi ").alias("content")), F.struct(F.lit("assistant").alias("role"), F.lit("").alias("content")))
    none = F.lit(None).cast("string")
    shown = one(spark, jsonl.pretty(F.col("c0"), F.lit("f"), none, none, F.lit("t"), none, turns), "7").split("\n")
    assert shown[1:3] == ["id=7  file=f  category=None  profile=None", "topic: t"] and shown[4:] == ["", "USER:", "hi", "", "POKE:", "[empty]"]
    assert one(spark, tx.user_label(F.create_map(F.lit("b"), F.lit("2"), F.lit("a"), F.col("c0"))), "1") == "user_" + hashlib.sha1(b'{"a": "1", "b": "2"}').hexdigest()[:10]
    assert one(spark, tx.eta(F.lit(100), F.lit(50), F.lit(10), F.col("c0").cast("double")), "20") == "1m40s"
    assert one(spark, status.notice_text(F.col("c0"), F.lit(1), F.lit(4), F.lit(2), F.lit(1), F.lit(1)), "done") == "done: 1/4 (25.0%), rows=2, errors=1, shards_seen=1"
    drawn = one(spark, selection.uniform_draws(3, F.col("c0"), {"x": ["p", "q"], "y": ["r"]}), "1")
    assert drawn["x"] in "pq" and drawn["y"] == "r"


def test_status(spark):
    plan = spark.createDataFrame([(0, 2), (1, 1)], "ix int, target int")
    rows = spark.createDataFrame([(0, "a", None), (0, "a", None), (0, "b", "e")], "shard int, id string, error string")
    got = {r["ix"]: (r["rows"], r["successful"], r["errors"], r["done"]) for r in status.shard_status(plan, rows).collect()}
    assert got == {0: (3, 1, 2, False), 1: (0, 0, 0, False)}
    assert status.notifier_status(rows, 4).first()["successful"] == 2


def test_jsonl(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": "1", "question": "q"}\n\nnot json\n{"id": "2"}\n')
    good, bad = jsonl.read_lenient(spark, str(tmp_path / "a.jsonl"), jsonl.QUESTION)
    assert sorted((r["id"], r["source_line"]) for r in good.collect()) == [("1", 1), ("2", 4)]
    assert [r["source_line"] for r in bad.collect()] == [3]
    jsonl.write_jsonl(good.select("id", "model").coalesce(1), str(tmp_path / "out"))
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    assert json.loads(text.splitlines()[0]) == {"id": "1", "model": None}


def test_notices(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    (source / "a.jsonl").write_text("\n".join(json.dumps({"run_id": "r", "at": t, "ok": True, "target": 5}) for t in range(6)))
    stream = spark.readStream.schema("run_id string, at double, ok boolean, target long").json(str(source))
    q = progress.notices(stream, 2, 100, timer=False).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(out))
    q.awaitTermination()
    assert [r["label"] for r in spark.read.parquet(str(out)).orderBy("at").collect()] == ["started", "progress", "done"]


def test_heartbeat_without_rows(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    (source / "a.jsonl").write_text("\n".join(json.dumps({"run_id": "r", "at": t, "ok": True, "target": 50}) for t in range(3)))
    stream = spark.readStream.schema("run_id string, at double, ok boolean, target long").json(str(source))
    q = progress.notices(stream, 10, 2).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="500 milliseconds").start(str(out))
    found, began = [], time.time()
    while len(found) < 2 and time.time() - began < 60:
        time.sleep(1)
        found = [(r["label"], r["successful"]) for r in spark.read.schema("run_id string, label string, successful long, at double").parquet(str(out)).orderBy("at").collect()] if out.exists() and list(out.glob("*.parquet")) else []
    q.stop()
    assert found == [("started", 1), ("heartbeat", 3)]


def test_follow_until(spark, tmp_path):
    source, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()
    land = lambda name, ids: (source / name).write_text("\n".join(json.dumps({"id": i, "error": "bad" if i % 4 == 3 else None}) for i in ids))
    rows = lambda: progress.follow(spark, str(source), "id long, error string")
    land("a.jsonl", range(4))
    assert progress.follow_until(rows(), out, state, 3, 0.2, 60) == 3
    with pytest.raises(ValueError, match="3 rows"):
        progress.follow_until(rows(), out, state, 5, 0.2, 2)
    threading.Timer(1.0, land, ("b.jsonl", range(4, 8))).start()
    assert progress.follow_until(rows(), out, state, 5, 0.2, 60) == 6  # goes on where it ended, and takes no file twice
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [0, 1, 2, 4, 5, 6]


def test_too_few_rows(spark):
    old, new = spark.createDataFrame([("a",), (None,)], "dedupe_key string"), spark.createDataFrame([(0, "a"), (1, "b"), (2, "b"), (3, ""), (4, "c")], "o int, dedupe_key string")
    assert [r["o"] for r in selection.top_up(old, new, "o", 2, exact=True).orderBy("o").collect()] == [1, 4]
    assert selection.top_up(old, new, "o", 1, exact=True).count() == 1
    for short in (lambda: selection.top_up(old, new, "o", 3, exact=True), lambda: selection.stratified(new, "o", {0: 1}, 6, "o", "dedupe_key", exact=True)):
        with pytest.raises(ValueError, match="are needed"):
            short()


def test_selection_of_null_ids_and_large_caps(spark):
    df = spark.createDataFrame([(i, i % 2, None if i % 3 == 0 else i) for i in range(12)], "o int, s int, k int")
    got = selection.stratified(df, "s", {0: 1}, 6, "o", "k").orderBy("o").collect()
    assert [(r["o"], r["selection_pass"]) for r in got] == [(0, 1), (1, 2), (2, 2), (4, 2), (5, 2), (7, 2)]
    many = spark.range(20_000).select(F.col("id").alias("o"), (F.col("id") % 2).alias("s"))
    ranked = selection.numbered(many, "s", "o", "k").where("k < 3000")
    assert "WindowGroupLimit" not in ranked._jdf.queryExecution().toString() and "_range" in ranked._jdf.queryExecution().toString()  # ranks within ranges
    assert selection.stratified(many, "s", {0: 3000, 1: 3000}, 10_000, "o", "o").groupBy("selection_pass").count().orderBy("selection_pass").collect() == [(1, 6000), (2, 4000)]


def test_lines_over_blocks(spark, tmp_path):
    text = [f'{{"id": "{i}"}}' if i % 10 else "" for i in range(3000)]
    for name in ("a", "b"):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(text) + "\n")
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = jsonl.lines(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8
        want = [(f"{n}.jsonl", i + 1, text[i]) for n in "ab" for i in range(3000) if text[i]]
        assert sorted(map(tuple, rows.collect())) == sorted(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    good, bad = jsonl.read_lenient(spark, str(tmp_path), "id string")
    assert good.count() == 5400 and bad.count() == 0
    (tmp_path / "c.jsonl").write_text("broken\n")
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        jsonl.read_in_order(spark, [str(tmp_path / "a.jsonl"), str(tmp_path / "c.jsonl")], "id string").collect()


def test_outputs(spark, tmp_path):
    judged = spark.createDataFrame([(0, True), (1, False), (2, None)], "ix int, ok boolean")
    paths = jsonl.write_answers(judged, str(tmp_path / "x"))
    ids = {k: sorted(r["ix"] for r in spark.read.json(p).collect()) for k, p in paths.items()}
    assert ids == {"kept": [0], "raw": [0, 1, 2], "rejected": [1, 2]} and paths["rejected"] == f"{tmp_path}/x.rejected.jsonl"
    kept, rejected = answers.split_answers(spark.createDataFrame([("as an ai",), (" ",), (None,)], "a string"), "a", filtered=False)
    assert [r["reason"] for r in kept.collect()] == ["unfiltered"] and {r["reason"] for r in rejected.collect()} == {"empty"}


def test_batches_and_shares(spark):
    df = spark.createDataFrame([(0, i, c) for i, c in enumerate([30, 30, 500, 30, 30, 30])], "p int, o int, c int")
    ids = lambda **k: [r["batch"] for r in selection.next_fit(df, "p", "o", "c", **k).orderBy("o").collect()]
    assert ids(most_items=9, budget=100, per=4, before=80, envelope=10) == [0, 0, 1, 2, 2, 3]  # 80 + ceil(72 / 4) is 98
    assert ids(most_items=9, budget=9999, output_each=50, output_budget=110) == [0, 0, 1, 1, 2, 2]
    shares = conversations.token_shares(spark.createDataFrame([([1, 2, 3], 10, 4), ([3], 5, 5)], "m array<int>, p int, c int"), "m", "p", "c").collect()
    assert {(r["member"], r["prompt_share"], r["completion_share"]) for r in shares} == {(1, 3, 1), (2, 3, 1), (3, 8, 6)}
    assert status.combinations({"a": [1, 2, 2], "b": [1, 2, 3]}) == 6
