"""DuckDB SQL of the conversation queries: quality, salvage, selection, training records, replay, assignment."""

from __future__ import annotations

from quillmill.functions import text as tx
from quillmill.operators import conversations, selection

TURN_WEIGHTS = {4: 0.20, 6: 0.30, 8: 0.30, 10: 0.067, 12: 0.067, 14: 0.066}
KEY = """regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(coalesce(text, '')), '^\\s+|\\s+$', '', 'g'), '\\s+', ' ', 'g'), '["''“”‘’]', '', 'g'), '[?.!,;:]+$', '')"""


def listed(ws: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in ws)


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def words(c: str) -> str:
    return f"list_filter(list_transform(regexp_extract_all(lower({c}), '[a-z0-9][a-z0-9'']+'), lambda w: replace(w, '''', '')), lambda w: w <> '')"


def singular(c: str) -> str:
    return f"list_transform({c}, lambda w: CASE WHEN len(w) > 4 AND w[-1] = 's' THEN w[:-2] ELSE w END)"


def echo_words(c: str) -> str:
    return f"list_filter({singular(c)}, lambda w: len(w) >= 3 AND w NOT IN ({listed(tx.ECHO_STOPWORDS)}))"


def significant(c: str) -> str:
    return f"list_distinct(list_filter({singular(words(c))}, lambda w: len(w) >= 4 AND w NOT IN ({listed(tx.GROUNDING_STOPWORDS)})))"


def grams(ws: str, n: int | str) -> str:
    return f"list_transform(range(1, greatest(len({ws}) - {n} + 2, 1)), lambda i: array_to_string({ws}[i : i + {n} - 1], ' '))"


def run(a: str, b: str, n: int | str) -> str:
    return f"list_has_any({grams(a, n)}, {grams(b, n)})"


def contains_any(c: str, parts: list[str]) -> str:
    return "(" + " OR ".join(f"contains({c}, {listed([p])})" for p in parts) + ")"


PREVIOUS = "SELECT conv_id, turn, role, text, last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS user_text FROM conversations"


def echo(variant: str) -> str:
    """CTEs p (turns with user_text) and a (conv_id, turn, reason) of the assistant turns that have a text."""
    generator = variant == "generator"
    return f"""
p AS ({PREVIOUS}),
w AS (SELECT conv_id, turn, {words("coalesce(user_text, '')")} AS un, {words("text")} AS rn FROM p WHERE role = 'assistant' AND coalesce(text, '') <> ''),
e AS (SELECT *, {echo_words("un")} AS uc, {echo_words("rn")} AS rc FROM w),
s AS (SELECT *, len(list_intersect(list_distinct(uc), list_distinct(rc))) AS shared, len(list_distinct(uc)) AS nu, len(list_distinct(rc)) AS nr, coalesce(rn[1] IN ({listed(tx.REFLECTIVE_LEADS)}), false) AS lead, coalesce(rn[1] IN ({listed(tx.AGREEMENT_LEADS + ["basically"] * generator)}), false) AS agree FROM e),
a AS (SELECT conv_id, turn, CASE
  WHEN len(un) = 0 OR len(rn) = 0 THEN NULL
  WHEN len(un) <= 3 AND rn[1 : len(un)] = un THEN 'short_exact_echo'
  {"WHEN len(uc) = 0 OR len(rc) = 0 THEN NULL" if generator else ""}
  WHEN {run("uc", "rc", 4)} THEN 'long_common_phrase'
  WHEN {run("un", "rn", 5)} THEN 'exact_5gram'
  WHEN {run("un", "rn", 4)} THEN 'exact_4gram'
  WHEN lead AND {run("uc", "rc", 3)} THEN 'reflective_exact_3gram'
  WHEN shared = 0 THEN NULL
  WHEN lead AND shared >= 5 AND shared / nr >= 0.60 THEN 'reflective_high_overlap'
  WHEN agree AND shared >= 3 AND shared / nr >= 0.45 THEN 'agreement_rephrase'
  WHEN shared >= 5 AND shared / nu >= 0.55 AND shared / nr >= 0.45 THEN 'high_overlap' END AS reason FROM s)"""


_PLAIN = strip("lower(c)")
# One row for each conversation in j, with reason and first_bad; h has its first 14 turns.
QUALITY = f"""
k AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k, count(*) OVER (PARTITION BY conv_id) AS n_turns, {strip("replace(coalesce(text, ''), '\\n', chr(10))")} AS c FROM conversations),
h AS (SELECT *, regexp_extract_all(lower(replace(c, '\\n', chr(10))), '[a-z0-9'']+') AS w FROM k WHERE k <= 14),
s AS (SELECT *, list_distinct(list_filter(w, lambda x: len(x) > 2 AND x NOT IN ({listed(tx.CONTENT_STOPWORDS)}))) AS s FROM h),
b AS (SELECT *, last_value(CASE WHEN role = 'user' THEN w END IGNORE NULLS) OVER earlier AS uw, last_value(CASE WHEN role = 'user' THEN s END IGNORE NULLS) OVER earlier AS us FROM s WINDOW earlier AS (PARTITION BY conv_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
r AS (SELECT conv_id, k, n_turns, role, CASE
  WHEN role IS DISTINCT FROM (CASE WHEN k % 2 = 1 THEN 'user' ELSE 'assistant' END) THEN 'bad_role_order'
  WHEN c = '' THEN 'empty_content'
  WHEN role <> 'assistant' THEN NULL
  WHEN {_PLAIN} IN ({listed(conversations.GENERIC_REPLIES)}) OR contains({_PLAIN}, '[empty]') THEN 'generic_or_empty_assistant'
  WHEN len(regexp_extract_all(c, '\\S+')) < 2 THEN 'too_short_assistant'
  WHEN {contains_any("lower(c)", conversations.IDENTITY_LEAKS)} THEN 'assistant_identity_leak'
  WHEN {contains_any("lower(c)", conversations.TRANSCRIPT_META)} THEN 'transcript_meta_reply'
  WHEN uw IS NULL OR len(uw) = 0 OR len(w) = 0 THEN NULL
  WHEN len(uw) <= 3 AND w[1 : len(uw)] = uw THEN 'assistant_echo'
  WHEN {run("uw", "w", 5)} THEN 'assistant_echo'
  WHEN len(us) >= 4 AND len(s) >= 4 AND len(list_intersect(us, s)) >= 5 AND len(list_intersect(us, s)) / len(s) >= 0.60 THEN 'assistant_echo' END AS reason FROM b),
x AS (SELECT y.conv_id, y.k, y.role, y.w, y.s, z.w AS ew, z.s AS es, greatest(9, CAST(ceil(0.9 * least(len(y.w), len(z.w))) AS BIGINT)) AS least_run FROM s y JOIN s z ON y.conv_id = z.conv_id AND y.role = z.role AND z.k < y.k),
q AS (SELECT conv_id, k, role FROM x WHERE
  (role = 'user' AND len(w) >= 4 AND len(ew) >= 4 AND (w = ew OR (len(s) >= 4 AND {run("w", "ew", "least_run")})))
  OR (role = 'assistant' AND ((len(s) >= 4 AND len(list_intersect(s, es)) / greatest(1, least(len(s), len(es))) >= 0.60) OR (len(w) >= 6 AND {run("w", "ew", 5)}) OR (len(w) >= 4 AND w = ew)))),
g AS (SELECT conv_id, any_value(n_turns) AS n_turns, count(*) AS held, min(k) FILTER (WHERE reason IS NOT NULL) AS first_r, arg_min(reason, k) FILTER (WHERE reason IS NOT NULL) AS reason_r FROM r GROUP BY conv_id),
o AS (SELECT conv_id, min(k) AS first_s, bool_or(role = 'user') AS user_repeats FROM q GROUP BY conv_id),
j AS (SELECT conv_id, n_turns, least(coalesce(first_r - 1, held), coalesce(first_s - 1, held)) AS first_bad, CASE
  WHEN n_turns < 4 OR n_turns > 14 OR n_turns % 2 = 1 THEN 'bad_turn_count'
  WHEN reason_r IS NOT NULL THEN reason_r WHEN user_repeats THEN 'user_self_repeat' WHEN first_s IS NOT NULL THEN 'assistant_self_repeat' ELSE 'ok' END AS reason FROM g LEFT JOIN o USING (conv_id))"""
# Kept conversations in v, with kept_turns and salvaged_from_turns.
SALVAGE = QUALITY + """,
u AS (SELECT *, least(CASE WHEN least(14, n_turns) // 2 * 2 >= n_turns THEN least(14, n_turns) // 2 * 2 - 2 ELSE least(14, n_turns) // 2 * 2 END, first_bad // 2 * 2) AS prefix FROM j),
v AS (SELECT conv_id, CASE WHEN reason = 'ok' THEN n_turns ELSE prefix END AS kept_turns, CASE WHEN reason <> 'ok' THEN n_turns ELSE 0 END AS salvaged_from_turns FROM u WHERE reason = 'ok' OR prefix >= 4)"""

SYSTEM = "Answer briefly."
MESSAGES = "list({role: h.role, content: h.c} ORDER BY h.k)"
_caps = ", ".join(f"({k}, {v})" for k, v in selection.quotas(500, TURN_WEIGHTS).items())
REPLAY = f"""
WITH {echo("generator")},
b AS (SELECT p.*, CASE WHEN role = 'assistant' THEN CASE WHEN {strip("coalesce(text, '')")} = '' THEN 'empty_reply' WHEN upper({strip("text")}) IN ({listed(tx.END_SENTINELS)}) THEN 'end_reply' WHEN user_text IS NOT NULL THEN a.reason END END AS bad FROM p LEFT JOIN a USING (conv_id, turn)),
n AS (SELECT *, count(*) FILTER (WHERE role = 'assistant' AND bad IS NULL) OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM b),
t AS (SELECT *, role = 'assistant' AND (bad IS NOT NULL OR n >= 4 OR (n >= 2 AND len({strip("text")}) < 5)) AS stops FROM n),
f AS (SELECT *, coalesce(bool_or(stops) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS stopped FROM t)
SELECT conv_id, turn, 'invalid_poke_reply:' || bad AS error FROM f WHERE NOT stopped"""
MISASSIGNED = f"""
WITH p AS ({PREVIOUS}),
i AS (SELECT conv_id // 8 AS batch_id, format('{{}}-{{}}', conv_id, turn) AS item_id, {significant("user_text")} AS ground, {significant("coalesce(text, '')")} AS said FROM p WHERE role = 'assistant' AND user_text IS NOT NULL),
t AS (SELECT batch_id, item_id, unnest(said) AS token FROM i),
g AS (SELECT batch_id, item_id AS other, unnest(ground) AS token FROM i),
n AS (SELECT batch_id, item_id, other, count(*) AS n FROM t JOIN g USING (batch_id, token) GROUP BY ALL),
m AS (SELECT batch_id, item_id, max(n) FILTER (WHERE other = item_id) AS own, max(n) FILTER (WHERE other <> item_id) AS best_other FROM n GROUP BY ALL),
z AS (SELECT batch_id, item_id, coalesce(own, 0) AS own, coalesce(best_other, 0) AS best_other, len(ground) AS n_ground, len(said) AS n_said FROM i LEFT JOIN m USING (batch_id, item_id))
SELECT batch_id, item_id, own, best_other, n_said > 0 AND ((best_other >= 2 AND best_other >= own + 2) OR (own = 0 AND n_ground >= 4 AND best_other >= 2)) AS suspicious FROM z"""

SQL = {
    "j7_previous_user": f"SELECT conv_id, turn, user_text FROM ({PREVIOUS}) WHERE role = 'assistant'",
    "l4_echo_audit": f"WITH {echo('audit')} SELECT conv_id, turn, reason FROM a WHERE reason IS NOT NULL",
    "a7_echo_rate": f"WITH {echo('audit')} SELECT count(*) AS checked, count(reason) AS issues, CASE WHEN count(*) > 0 THEN count(reason) / count(*) ELSE 0.0 END AS rate FROM a",
    "j3_accepted_turns": f"WITH {echo('audit')} SELECT conv_id, turn, conv_id NOT IN (SELECT conv_id FROM a WHERE reason IS NOT NULL) AS accepted FROM conversations",
    "c1_clean_rows": f"WITH {QUALITY} SELECT conv_id, n_turns, reason FROM j",
    "c2_salvage": f"WITH {SALVAGE} SELECT conv_id, kept_turns, salvaged_from_turns FROM v",
    "w5_balanced_selection": f"""WITH {SALVAGE},
caps AS (SELECT * FROM (VALUES {_caps}) t(kept_turns, cap)),
one AS (SELECT conv_id, kept_turns FROM (SELECT conv_id, kept_turns, cap, row_number() OVER (PARTITION BY kept_turns ORDER BY conv_id) AS i FROM v JOIN caps USING (kept_turns)) WHERE i <= cap),
two AS (SELECT conv_id, kept_turns, row_number() OVER (ORDER BY conv_id) AS i FROM v WHERE conv_id NOT IN (SELECT conv_id FROM one))
SELECT conv_id, kept_turns, 1 AS selection_pass FROM one UNION ALL SELECT conv_id, kept_turns, 2 FROM two WHERE i <= 500 - (SELECT count(*) FROM one)""",
    "l3_training_records": f"""WITH {SALVAGE},
t AS (SELECT v.*, h.k AS at FROM v JOIN h ON h.conv_id = v.conv_id AND h.k <= kept_turns AND role = 'assistant')
SELECT t.conv_id || '#assistant_turn_' || (t.at - 1) AS source_id, t.at - 1 AS target_turn_index, t.at AS turns, t.salvaged_from_turns, to_json({MESSAGES})::VARCHAR AS messages FROM t JOIN h ON h.conv_id = t.conv_id AND h.k <= t.at GROUP BY ALL""",
    "e2_chat_records": f"""WITH {SALVAGE}
SELECT v.conv_id::VARCHAR AS source_id, v.kept_turns AS turns, v.salvaged_from_turns, to_json(list_concat([{{role: 'system', content: '{SYSTEM}'}}], {MESSAGES}))::VARCHAR AS messages FROM v JOIN h ON h.conv_id = v.conv_id AND h.k <= kept_turns GROUP BY ALL""",
    "c3_replay": REPLAY,
    "r6_misassigned": MISASSIGNED,
}
