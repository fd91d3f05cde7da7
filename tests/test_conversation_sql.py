"""Conversations made to meet every rule: Spark and SQL agree on each of them."""

import random

import pytest

from compare import same
from quillmill.plans import conversation_sql
from quillmill.plans.queries import ORACLE_SQL, QUERIES

WORDS = "purple tractor wheel broken hedgehog garden escaped yesterday morning lunar eclipse telescope visible tonight ducks swim ponds the that were you with was it one don't".split()
ODD = ["", "  ", "ok", "Thanks", "[END]", "end", "yep", "hm", "single", "a marvelous thing", "you asked me that", "so [empty] here", "it's\\nfine then", None]
NAMES = sorted(set(conversation_sql.SQL) & set(QUERIES)) + """p3_user_items p5_flags p6_reply_problems p7_answer_validity k6_pretty w2_refilter w8_refilter_first_20 f8_shared_runs f13_clean_answers
f15_batch_answers f16_batch_replies f17_questions f18_messages a9_conversation_sums c4_next_fit k1_jsonl_round_trip s2_lenient_scan t3_follow""".split()


def text(rng, said):
    kind = rng.random()
    if kind < 0.06:
        return rng.choice(ODD)
    if said and kind < 0.22:  # say it again, in part
        ws = rng.choice(said).split()
        cut = ws[rng.randrange(len(ws)) :][: rng.randint(1, 12)] if ws else []
        return " ".join([*rng.sample(["yeah", "basically", "exactly", "I"], rng.randint(0, 1)), *cut, *rng.sample(WORDS, rng.randint(0, 3))])
    if said and kind < 0.27:
        return rng.choice(said)
    if said and kind < 0.40:  # the same words in another order
        ws = rng.choice(said).split()
        rng.shuffle(ws)
        return " ".join([*rng.sample(["right", "basically", "that's"], rng.randint(0, 1)), *ws])
    return " ".join(f"{rng.choice(WORDS)}{rng.choice(['', '', 's', rng.randrange(40)])}" for _ in range(rng.randint(2, 14)))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng, rows = random.Random(5), []
    for conv in range(900):
        said = []
        for turn in range(rng.choice([1, 3, 4, 4, 6, 6, 8, 10, 14, 15, 16, 20])):
            role = ["user", "assistant"][turn % 2] if rng.random() < 0.98 else rng.choice(["system", "user", "assistant"])
            said.append(text(rng, said))
            rows.append((conv, turn, role, said[-1]))
            said[-1] = said[-1] or ""
    folder = tmp_path_factory.mktemp("made")
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(2).write.parquet(f"{folder}/c")
    spark.read.parquet(f"{folder}/c").toPandas().to_parquet(f"{folder}/conversations.parquet")
    (folder / "c").rename(folder.parent / "unused")
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_equal(spark, tables, name):
    same(spark, QUERIES[name], ORACLE_SQL[name], tables)


def test_all_reasons_occur(spark, tables):
    echoes = {r["reason"] for r in QUERIES["l4_echo_audit"](spark, tables).collect()}
    assert echoes == {"short_exact_echo", "long_common_phrase", "exact_5gram", "exact_4gram", "reflective_exact_3gram", "reflective_high_overlap", "agreement_rephrase", "high_overlap"}
    reasons = {r["reason"] for r in QUERIES["c1_clean_rows"](spark, tables).collect()}
    assert reasons == {"ok", "bad_turn_count", "bad_role_order", "empty_content", "generic_or_empty_assistant", "too_short_assistant", "assistant_identity_leak", "transcript_meta_reply", "assistant_echo", "assistant_self_repeat", "user_self_repeat"}
