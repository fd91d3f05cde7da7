import json

import pytest

from quillmill.__main__ import main


def write(path, rows):
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))
    return str(path)


def read(spark, path):
    return [json.loads(r["value"]) for r in spark.read.text(path).collect()]


def test_questions(spark, tmp_path, capsys):
    first = write(tmp_path / "a.jsonl", [{"id": "1", "question": "What is it?"}, {"id": "2", "question": "", "prompt": "what is it"}, {"id": "3"}])
    second = write(tmp_path / "b.jsonl", [{"id": "4", "prompt": "Else?", "question": "what is it"}, {"id": "5", "prompt": "And else"}, {"id": "6", "prompt": "else!"}])
    main(["dedupe", "--input", first, second, "--out", str(tmp_path / "kept")])
    assert [(r["id"], r["dedupe_key"]) for r in read(spark, str(tmp_path / "kept"))] == [("1", "what is it"), ("5", "and else"), ("6", "else")]
    assert json.loads(capsys.readouterr().out.splitlines()[-1]) == {"read": 6, "kept": 3, "duplicates": 3}
    main(["top-up", "--existing", first, "--input", second, "--count", "2", "--out", str(tmp_path / "new")])
    assert [(r["id"], r["source_question_id"], r["question"]) for r in read(spark, str(tmp_path / "new"))] == [("topup-00000", "4", "Else?"), ("topup-00001", "5", "And else")]
    with pytest.raises(ValueError, match="2 rows where 3 are needed"):
        main(["top-up", "--existing", first, "--input", second, "--count", "3", "--out", str(tmp_path / "no")])


def test_conversations(spark, tmp_path, capsys):
    said = ["the purple tractor wheel broke", "mine did last week", "a hedgehog escaped the garden", "did you find where"]
    turns = lambda texts: [{"role": ["user", "assistant"][i % 2], "content": t} for i, t in enumerate(texts)]
    rows = [{"id": "good", "turns": turns(said)}, {"id": "echo", "turns": turns([*said[:3], "a hedgehog escaped the garden"])}, {"id": "bad", "turns": turns(said), "error": "failed"}]
    source = write(tmp_path / "c.jsonl", rows)
    main(["audit", "--input", source, "--out", str(tmp_path / "c")])
    assert json.loads(capsys.readouterr().out.splitlines()[-1]) == {"checked": 6, "issues": 1}
    assert {r["id"] for r in read(spark, f"{tmp_path}/c.no_echo.jsonl")} == {"good", "bad"} and {r["id"] for r in read(spark, f"{tmp_path}/c.echo_rejected.jsonl")} == {"echo"}
    main(["export", "--input", source, "--limit", "1", "--explode", "--out", str(tmp_path / "records")])
    records = read(spark, str(tmp_path / "records"))
    assert sorted((r["source_id"], len(r["messages"])) for r in records) == [("good#assistant_turn_1", 2), ("good#assistant_turn_3", 4)]
    with pytest.raises(ValueError, match="are needed"):
        main(["export", "--input", source, "--limit", "2", "--out", str(tmp_path / "no")])


def test_answers(spark, tmp_path, capsys):
    source = write(tmp_path / "raw.jsonl", [{"ix": 0, "user": "Hi", "answer": "As an AI I can't"}, {"ix": 1, "user": "hi ", "answer": "fine"}, {"ix": 2, "user": "so", "answer": "good"}])
    main(["refilter", "--input", source, "--out", str(tmp_path / "out.jsonl")])
    assert json.loads(capsys.readouterr().out.splitlines()[-1]) == {"contains as an ai": 1, "ok": 1}
    assert [r["ix"] for r in read(spark, f"{tmp_path}/out.jsonl")] == [2] and [r["ix"] for r in read(spark, f"{tmp_path}/out.jsonl.rejected.jsonl")] == [0]
    pairs = write(tmp_path / "p.jsonl", [{"user": "a hedgehog escaped the garden", "reply": "a hedgehog escaped the garden"}, {"user": "so", "reply": "what now"}])
    main(["replies", "--input", pairs, "--out", str(tmp_path / "judged")])
    assert [r["reason"] is None for r in read(spark, str(tmp_path / "judged"))] == [False, True]


SAID = ["the purple tractor wheel broke", "mine did last week", "a hedgehog escaped the garden", "did you find where"]


def turns(texts):
    return [{"role": ["user", "assistant"][i % 2], "content": t} for i, t in enumerate(texts)]


def result(capsys):
    return json.loads(capsys.readouterr().out.splitlines()[-1])


def test_audit_rejects_all_rows_of_an_id(spark, tmp_path, capsys):
    echo = turns([*SAID[:3], "a hedgehog escaped the garden"])
    rows = [{"id": "x", "turns": turns(SAID), "more": {"kept": [1, None]}}, {"id": "x", "turns": echo}, {"turns": turns(SAID)}, {"id": "y", "turns": turns(SAID)}]
    source = write(tmp_path / "c.jsonl", rows)
    with pytest.raises(SystemExit):
        main(["audit", "--input", source, "--out", str(tmp_path / "c"), "--fail-on-issues", "--issues", str(tmp_path / "issues"), "--rejected", str(tmp_path / "bad")])
    assert result(capsys) == {"checked": 8, "issues": 1}
    assert read(spark, str(tmp_path / "bad")) == rows[:2] and read(spark, f"{tmp_path}/c.no_echo.jsonl") == rows[2:]  # as they came
    (issue,) = read(spark, str(tmp_path / "issues"))
    assert issue["source"].endswith("/c.jsonl") and (issue["id"], issue["line"], issue["turn"], issue["reason"], issue["user"]) == ("x", 2, 3, "exact_4gram", SAID[2])
    write(tmp_path / "d.jsonl", [{"turns": echo}, {"id": None, "turns": turns(SAID)}, {"id": "z", "turns": turns(SAID)}])
    main(["audit", "--input", str(tmp_path / "d.jsonl"), "--out", str(tmp_path / "d")])
    assert [r.get("id") for r in read(spark, f"{tmp_path}/d.no_echo.jsonl")] == ["z"]  # rows without an id go together


def test_export_by_ids_over_shards(spark, tmp_path, capsys):
    """Shards in the order of their names, broken lines skipped; the second pass takes an id once, and none that the first took."""
    row = lambda i, texts=SAID, **more: {"id": i, "turns": turns(texts), "category": "chat", **more}
    (tmp_path / "in").mkdir()
    write(tmp_path / "in/a.jsonl", [row("p")])
    write(tmp_path / "in/b.jsonl", [*[row("p", category="old")] * 30, row("q"), row("bad", error="failed"), row("cut", [*SAID, "again", "again"])])
    write(tmp_path / "in/c.jsonl", [row("p"), row("r"), row("short", SAID[:2])])
    with open(tmp_path / "in/b.jsonl", "a") as f:
        f.write("broken\n")
    out = str(tmp_path / "records")
    main(["export", "--input", str(tmp_path / "in"), "--limit", "3", "--out", out])
    assert [(r["source_id"], r["source_file"], r["source_line"]) for r in read(spark, out)] == [("p", "a.jsonl", 1), ("q", "b.jsonl", 31), ("cut", "b.jsonl", 33)]
    made = json.load(open(f"{out}.manifest.json"))
    assert made["rejects"] == {"source_error": 1, "bad_turn_count": 1} and made["salvaged"] == {"too_short_assistant": 1} and made["turns"] == {"4": 3} and made["categories"] == {"chat": 3}
    assert (made["eligible"], made["selected"], made["records_written"]) == (35, 3, 3)
    out = str(tmp_path / "all")
    main(["export", "--input", str(tmp_path / "in"), "--limit", "3", "--no-balance-turns", "--explode", "--out", out, "--manifest", str(tmp_path / "m.json")])
    got = read(spark, out)
    assert [(r["source_id"], r["target_turn_index"], r["turns"], r["source_total_turns"], len(r["messages"])) for r in got[:2]] == [("p#assistant_turn_1", 1, 2, 4, 2), ("p#assistant_turn_3", 3, 4, 4, 4)]
    assert len(got) == 6 and json.load(open(tmp_path / "m.json"))["records_written"] == 6 and json.load(open(tmp_path / "m.json"))["categories"] == {"old": 2, "chat": 1}
    with pytest.raises(ValueError, match="only 35 clean rows"):
        main(["export", "--input", str(tmp_path / "in"), "--limit", "50", "--wait", "--poll-seconds", "0.1", "--longest", "1", "--out", str(tmp_path / "no")])


def test_combine(spark, tmp_path, capsys):
    (tmp_path / "s").mkdir()
    write(tmp_path / "s/shard_0001_dry.jsonl", [{"id": "a", "n": 2}, {"id": "b", "error": "failed"}, {"n": 3}, {"n": 4}])
    write(tmp_path / "s/shard_0000_very_warm.jsonl", [{"id": "a", "n": [1, {"x": None}]}])
    with open(tmp_path / "s/shard_0000_very_warm.jsonl", "a") as f:
        f.write(' {"id": \n[3]\n')
    main(["combine", "--input", str(tmp_path / "s"), "--run-id", "r", "--out", str(tmp_path / "out")])
    assert read(spark, f"{tmp_path}/out/dataset.jsonl") == [{"id": "a", "n": [1, {"x": None}], "run_id": "r", "shard": 0, "shard_profile": "very_warm"}, {"n": 3, "run_id": "r", "shard": 1, "shard_profile": "dry"}]
    broken = {"shard": 0, "profile": "very_warm", "error": "invalid json"}
    assert read(spark, f"{tmp_path}/out/errors.jsonl") == [{**broken, "line": '{"id":'}, {**broken, "line": "[3]"}, {"id": "b", "error": "failed", "run_id": "r", "shard": 1, "shard_profile": "dry"}]
    assert {k: result(capsys)[k] for k in ("run_id",)} == {"run_id": "r"} and json.load(open(f"{tmp_path}/out/combined_status.json"))["errors_count"] == 3


def test_review_and_follow(spark, tmp_path, capsys):
    rows = write(tmp_path / "r.jsonl", [{"id": "a", "z": 1}, {"id": "b", "z": {"y": 2}}, {"id": "c"}])
    log = write(tmp_path / "log.jsonl", [{"id": "a", "decision": "reject", "note": "no"}, {"id": "b", "decision": "accept"}, {"id": "b", "decision": "reject", "note": 'too "dull"'}, {"id": "a", "decision": "accept"}])
    main(["review", "--input", rows, "--decisions", log, "--out", str(tmp_path / "r")])
    assert result(capsys) == {"accepted": 1, "rejected": 1, "remaining": 1}
    assert read(spark, f"{tmp_path}/r.accepted.jsonl") == [{"id": "a", "z": 1}] and read(spark, f"{tmp_path}/r.rejected.jsonl") == [{"id": "b", "z": {"y": 2}, "review_note": 'too "dull"'}]
    write(tmp_path / "f.jsonl", [{"id": "a", "turns": turns(SAID[:2])}, {"id": "e", "error": "failed"}])
    main(["follow", "--input", str(tmp_path / "f.jsonl"), "--once", "--out", str(tmp_path / "state")])
    shown = capsys.readouterr().out
    assert "id=a  file=f.jsonl" in shown and "POKE:\nmine did last week" in shown and "id=e" not in shown
