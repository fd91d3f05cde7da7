"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation estimates their accuracies over all
rows, and the posterior probability of good quality decides instead of a demand that all rules pass."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmill.llm.common import append_columns, cut, fresh, table
from quillmill.llm.weak import VoteModel, count_patterns, fit_votes

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ended_lines", "n_alpha_words", "n_upper", "n_letters", "n_bars", "n_distinct_words"]
THRESHOLD = 0.5
_symbols = re.compile(rb"[#*$%&|<>]")
_bars = re.compile(rb"[ \t\n]\|[ \t\n]")
_ended = re.compile(rb"[.!?\"')\]][ \t\r\x0b\x0c]*$")


def repeat_words(ids: np.ndarray, n_distinct: int, width: int = 3) -> int:
    """Words that lie in a window of `width` words which occurs twice or more."""
    n = len(ids) - width + 1
    if n < 2:
        return 0
    if n_distinct < 1 << 21:
        code = (ids[:n].astype(np.int64) * n_distinct + ids[1 : n + 1]) * n_distinct + ids[2 : n + 2]
    else:  # pairs first, so that the codes stay below 2 ** 63
        pair = np.unique(ids[: n + 1].astype(np.int64) * n_distinct + ids[1 : n + 2], return_inverse=True)[1]
        code = pair[:n].astype(np.int64) * n_distinct + ids[2 : n + 2]
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    if not same.any():
        return 0
    hit = np.zeros(n, bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    covered = np.zeros(len(ids), bool)
    for k in range(width):
        covered[k : k + n] |= hit
    return int(covered.sum())


def measures(text: str | None) -> tuple[int, ...]:
    """The counts MEASURES of one text; of a null or empty text all are zero."""
    return measures_and_words(text)[0]


def measures_and_words(text: str | None) -> tuple[tuple[int, ...], Counter]:
    """The same, and how often each word occurs, for further rules."""
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    words = raw.split()
    if not words:
        return (0, 0, len(_symbols.findall(raw)), 0, 0, 0, 0, 0, 0, 0, 0, 0), Counter()
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    joined = np.frombuffer(b"".join(words), np.uint8)
    word_chars = int(np.count_nonzero((joined & 0xC0) != 0x80))
    upper = int(np.count_nonzero((joined >= 65) & (joined <= 90)))
    letters = int(np.count_nonzero(((joined | 32) >= 97) & ((joined | 32) <= 122))) + int(np.count_nonzero(joined >= 0xC0))
    lines = [x for x in raw.split(b"\n") if x.split(None, 1)]
    count = Counter(words)
    alpha = sum(c for w, c in count.items() if w.isalpha() or any(97 <= (x | 32) <= 122 or x >= 128 for x in w))
    return (len(words), word_chars, len(_symbols.findall(raw)), len(lines) - len(set(lines)), repeat_words(ids, len(number)), len(lines), sum(1 for x in lines if _ended.search(x)), alpha, upper, letters, len(_bars.findall(raw)), len(number)), count


def vote(good: Column, bad: Column) -> Column:
    return F.when(good, 1).when(bad, -1).otherwise(0).cast("int")


def rule_votes(c) -> dict[str, Column]:
    """The rules. c(name) gives a measure; a rule abstains between its two bounds, and on texts it can't judge."""
    n, lines = F.greatest(c("n_words"), F.lit(1)), F.greatest(c("n_lines"), F.lit(1))
    some = c("n_words") >= 20
    return {
        "length": vote(c("n_words") >= 100, c("n_words") < 30),
        "word_length": vote(some & (c("word_chars") / n).between(3, 9), some & ~(c("word_chars") / n).between(2, 14)),
        "symbols": vote(some & (c("n_symbols") / n < 0.05), c("n_symbols") / n > 0.2),
        "dup_lines": vote((c("n_lines") >= 3) & (c("n_dup_lines") / lines < 0.05), (c("n_lines") >= 5) & (c("n_dup_lines") / lines > 0.3)),
        "letters": vote(some & (c("n_letters") / F.greatest(c("word_chars"), F.lit(1)) > 0.85), some & (c("n_letters") / F.greatest(c("word_chars"), F.lit(1)) < 0.75)),
        "repeats": vote(some & (c("n_repeat_words") / n < 0.1), c("n_repeat_words") / n > 0.3),
        "alphabetic": vote(some & (c("n_alpha_words") / n > 0.9), c("n_alpha_words") / n < 0.7),
        "upper_case": vote((c("n_letters") >= 60) & (c("n_upper") / F.greatest(c("n_letters"), F.lit(1)) < 0.15), c("n_upper") / F.greatest(c("n_letters"), F.lit(1)) > 0.5),
        "bars": vote(some & (c("n_bars") == 0), c("n_bars") / n > 0.1),
        "line_ends": vote((c("n_lines") >= 3) & (c("n_ended_lines") / lines > 0.7), (c("n_lines") >= 3) & (c("n_ended_lines") / lines < 0.2)),
        "variety": vote((c("n_words") >= 50) & (c("n_distinct_words") / n > 0.25), (c("n_words") >= 50) & (c("n_distinct_words") / n < 0.08)),
    }


def measured(docs: DataFrame, text: str, prefix: str) -> DataFrame:
    def make():
        def run(texts: list) -> list[pa.Array]:
            rows = np.array([measures(t) for t in texts], np.int64).reshape(-1, len(MEASURES))
            return [pa.array(rows[:, i]) for i in range(len(MEASURES))]

        return run

    return append_columns(docs, text, [(prefix + m, T.LongType()) for m in MEASURES], make)


def base_failed(c) -> Column:
    return (c("n_words") < 50) | (100 * c("n_repeat_words") > 50 * c("n_words"))


def judged(docs: DataFrame, text: str, prefix: str, keep: list[str], threshold: float) -> tuple[DataFrame, VoteModel]:
    """keep, the measures, base_failed, quality (the posterior) and kept, each under the prefix."""
    rows = measured(docs, text, prefix)
    c = lambda m: F.col(prefix + m)
    rules = rule_votes(c)
    voted = rows.select(*(F.col(f"`{k}`") for k in keep), *(prefix + m for m in MEASURES), base_failed(c).alias(prefix + "base_failed"), *(v.alias(f"{prefix}v_{r}") for r, v in rules.items()))
    voted = cut(voted)  # measured once: the estimate reads all votes, then the verdict each row's
    names = [f"{prefix}v_{r}" for r in rules]
    model = fit_votes(count_patterns(voted, names), list(rules))
    voted = voted.withColumn(prefix + "quality", model.posterior([F.col(x) for x in names]))
    return voted.withColumn(prefix + "kept", ~F.col(prefix + "base_failed") & (F.col(prefix + "quality") >= threshold)), model


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, the measures, base_failed, kept, quality, votes) for each row of docs.

    Only the two named columns are read. A null, empty or blank text has no words: base_failed. Repeated rows each return a
    row and count as often in the estimate; a null doc_id stays null; no rows give no rows. Ties (quality equal to the
    threshold) are kept.
    """
    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows, model = judged(read, "text", "_q_", ["doc_id"], threshold)
    votes = F.create_map(*(x for r in model.names for x in (F.lit(r), F.col(f"_q_v_{r}"))))
    return rows.select("doc_id", *(F.col("_q_" + m).alias(m) for m in MEASURES), F.col("_q_base_failed").alias("base_failed"), F.col("_q_kept").alias("kept"), F.round("_q_quality", 6).alias("quality"), votes.alias("votes"))


def keep_good(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that quality_rules keeps, with all columns of docs whatever their names."""
    prefix = fresh(docs, "_q_")
    while any(x.lower().startswith(prefix) for x in docs.columns):
        prefix = "_" + prefix
    return judged(docs, text, prefix, docs.columns, threshold)[0].where(F.col(prefix + "kept")).select(*(F.col(f"`{c}`") for c in docs.columns))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")
