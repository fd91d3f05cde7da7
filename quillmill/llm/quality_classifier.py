"""Quality classifier from weak labels: heuristic labellers, expectation-maximisation, and a hashed linear scorer.

Two tasks, quality and toxicity, each with labellers of its own that vote or abstain on every text. For each task
expectation-maximisation over the counts of vote patterns of all rows gives the labellers' accuracies and the posterior of
each row. The posteriors, as soft labels, train a logistic scorer over hashed words and word shapes, on a sample of at most
TRAIN_ROWS rows. The scorer rates every row; a row is kept if it is likely good and unlikely toxic.

Two labellers of toxicity go by lists of English words and abstain where a text isn't English and has none of them. Two others go
by terms (words and beginnings of words, in any language) that are far more common in toxic rows of a table of labels, if there
is one: at most LABELLED of its rows are read, and at most TERMS terms kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmill.llm.common import append_columns, cut, smallest, table
from quillmill.llm.quality_rules import measures_and_words
from quillmill.llm.weak import count_patterns, fit_votes

BUCKETS = 1 << 15
TRAIN_ROWS = 2_000  # rows each scorer is fitted on: the one bound of this operator
LABELLED = 10_000  # labelled rows from which terms of toxicity are learned
TERMS = 4_096
TIMES = 15  # so many times as common in toxic rows as in others is a term
SEEN = 4  # toxic rows that have it
EPOCHS = 5
RATE = 0.5
QUALITY = ("words", "symbol_words", "letter_share", "repeated_windows", "repeated_lines", "shouting", "separators", "sentences", "word_lengths", "variety")
TOXICITY = ("insult", "insults_dense", "abuse", "many_kinds", "terms", "terms_dense")
#: Common English insults, in two lists that overlap in use but not in words.
INSULTS = frozenset(b"idiot idiots moron morons imbecile stupid dumb loser losers clown clowns fool fools jerk jerks dimwit halfwit".split())
ABUSE = frozenset(b"trash garbage scum vermin filth filthy pathetic worthless disgusting despicable vile wretch hate loathe pig swine".split())
#: The most common English words.
ENGLISH = frozenset(b"the and of to in is that for it was".split())
MARKED = INSULTS | ABUSE | ENGLISH
_edges = b".,;:!?\"'()[]{}*#$%&|<>"


def features(word: bytes) -> set[bytes]:
    """A word and its beginnings of 4 to 8 bytes."""
    return {word, *(word[:n] for n in range(4, min(9, len(word))))}


class Terms:
    """The terms, and their first four bytes, which tell nearly all other words by one look into a small set."""

    def __init__(self, terms: frozenset[bytes]):
        self.terms, self.heads = terms, frozenset(t[:4] for t in terms)

    def __contains__(self, word: bytes) -> bool:
        return word[:4] in self.heads and not self.terms.isdisjoint(features(word))


def labeller_votes(text: str | None, terms: Terms) -> tuple[list[int], list[int]]:
    """The votes for quality (1 good) and for being free of toxicity (1 clean, -1 toxic)."""
    (n, chars, symbols, dup, repeat, lines, ended, alpha, upper, letters, bars, distinct), count = measures_and_words(text)
    v = lambda good, bad: 1 if good else -1 if bad else 0
    per, some = max(n, 1), n >= 20
    quality = [
        v(n >= 80, n < 3), v(some and symbols < 0.05 * per, symbols > 0.25 * per), v(some and letters > 0.85 * chars, some and letters < 0.7 * chars),
        v(some and repeat < 0.1 * per, repeat > 0.4 * per), v(lines >= 3 and not dup, lines >= 5 and dup > 0.3 * lines), v(letters >= 60 and upper < 0.15 * letters, letters >= 20 and upper > 0.5 * letters),
        v(some and not bars, bars > 0.1 * per), v(ended >= 2 and ended >= 0.6 * lines, lines >= 3 and ended < 0.2 * lines), v(some and 3 * per <= chars <= 9 * per, some and not 2 * per <= chars <= 14 * per), v(n >= 50 and distinct > 0.3 * per, n >= 50 and distinct < 0.1 * per),
    ]
    plain, heads = [w.lower().strip(_edges) for w in count], terms.heads
    said = [(w, c) for w, c in zip(plain, count.values(), strict=True) if w in MARKED or w[:4] in heads]
    a, b, common = (sum(c for w, c in said if w in words) for words in (INSULTS, ABUSE, ENGLISH))
    found, several = a + b, len({w for w, _ in said if w in INSULTS or w in ABUSE}) >= 2
    english = bool(found) or not n or 25 * common >= n
    # A single hit can be a word of another language: it takes two, or a large share of a short text
    toxicity = [v(not a and english, a >= 2), v(not found and english, found > 0.01 * per and (found >= 2 or n < 20)), v(not b and english, b >= 2), v(not found and english, several), 0, 0]
    if terms.terms:
        hits = len({w for w, _ in said if w in terms})
        toxicity[4:] = [v(not hits, hits >= 2), v(not hits, hits >= 2 and 50 * hits >= len(count))]
    return quality, toxicity


def toxic_terms(read: DataFrame, labels: DataFrame | None, doc_id: str, toxic: str, labelled: int) -> frozenset[bytes]:
    """The terms, from the `labelled` rows of labels with the smallest hashes of doc_id. Rows without a label count for nothing."""
    if labels is None:
        return frozenset()
    some = labels.select(F.col(doc_id).alias("_id"), F.col(toxic).cast("int").alias("_toxic")).where("_id IS NOT NULL AND _toxic IS NOT NULL").distinct()
    some = smallest(some, labelled, "_id", "_toxic")
    marked = read.join(F.broadcast(some), F.col("doc_id") == F.col("_id")).select("text", "_toxic")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, toxic = [], []
            for text, mark in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = {x.strip(_edges) for x in text.encode("utf-8", "surrogatepass").lower().split()} if text else set()
                own = set().union(*map(features, words)) - {b""}
                terms += [b"", *own]  # the empty term counts rows
                toxic += [mark] * (len(own) + 1)
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.binary()), pa.array(toxic, pa.int32())], names=["term", "toxic"])

    counts = cut(marked.mapInArrow(run, "term binary, toxic int").groupBy("term").agg(F.count_if(F.col("toxic") == 1).alias("bad"), F.count_if(F.col("toxic") != 1).alias("good")))
    rows = counts.where(F.octet_length("term") == 0).first()
    if not rows or not rows["bad"]:
        return frozenset()
    often = F.col("bad") / rows["bad"] >= TIMES * (F.col("good") + 0.5) / max(1, rows["good"])
    return frozenset(bytes(r["term"]) for r in counts.where((F.col("bad") >= SEEN) & often & (F.octet_length("term") > 0)).orderBy(F.desc("bad"), "term").limit(TERMS).collect())


class Features(dict):
    """The bucket of a word, remembered; forgets all when it has a million."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1_000_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.strip(_edges), 1) % BUCKETS
        return value


_shape = re.compile(rb"[A-Z]+|[a-z\x80-\xff]+|[0-9]+|[^A-Za-z0-9\x80-\xff]")
_kind = {**{c: b"A" for c in range(65, 91)}, **{c: b"a" for c in range(97, 123)}, **{c: b"0" for c in range(48, 58)}}


def shape(word: bytes) -> bytes:
    return b"#" + b"".join(b"a" if m[0] >= 128 else _kind.get(m[0], m[:1]) for m in _shape.findall(word[:64]))[:12]


class Shapes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1_000_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(shape(word), 2) % BUCKETS
        return value


def bag(text: str | None, words: Features, shapes: Shapes) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, weights) of a text: shares of its words and of its words' shapes, and a constant."""
    raw = text.encode("utf-8", "surrogatepass").split() if text else []
    if not raw:
        return np.zeros(1, np.int64), np.ones(1, np.float32)
    n = len(raw)
    a = np.fromiter(map(words.__getitem__, (w.lower() for w in raw)), np.int64, n)
    b = np.fromiter(map(shapes.__getitem__, raw), np.int64, n)
    at, count = np.unique(np.concatenate([a, b]), return_counts=True)
    return np.append(at, 0), np.append(np.sqrt(count / n), 1).astype(np.float32)


def train_scorer(rows: list[tuple[np.ndarray, np.ndarray, float]]) -> np.ndarray:
    """Logistic regression by AdaGrad over soft labels."""
    w, memory, rng = np.zeros(BUCKETS, np.float32), np.full(BUCKETS, 1e-2, np.float32), np.random.default_rng(3)
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            at, x, label = rows[k]
            g = (1 / (1 + np.exp(-np.clip(float(w[at] @ x), -30, 30))) - label) * x
            memory[at] += g * g
            w[at] -= RATE * g / np.sqrt(memory[at])
    return w


def with_bags(df: DataFrame) -> DataFrame:
    """df and the columns at and x, the bag of its column text, as little-endian uint16 and float16: the sample has at most
    TRAIN_ROWS bags of BUCKETS entries for each task, 262 MB in all."""

    def make():
        words, shapes = Features(), Shapes()

        def run(texts: list) -> list[pa.Array]:
            bags = [bag(t, words, shapes) for t in texts]
            return [pa.array([at.astype("<u2").tobytes() for at, _ in bags], pa.binary()), pa.array([x.astype("<f2").tobytes() for _, x in bags], pa.binary())]

        return run

    return append_columns(df, "text", [("at", T.BinaryType()), ("x", T.BinaryType())], make)


def fit_task(read: DataFrame, posterior: DataFrame, task: str, train_rows: int) -> np.ndarray:
    """The scorer's weights from at most train_rows rows with sure posteriors, half of them from each side: those with the
    smallest hashes, so the same on every run. A bag has at most BUCKETS entries, which bounds what the driver gets."""
    sides = [smallest(posterior.where(s).select("hash", F.col(task).alias("label")), train_rows // 2, "hash") for s in (F.col(task) < 0.2, F.col(task) > 0.8)]
    picked = F.broadcast(sides[0].unionByName(sides[1]))
    rows = with_bags(read.withColumn("hash", F.xxhash64("doc_id", "text")).join(picked, "hash")).drop("text").dropDuplicates(["hash"]).select("hash", "label", "at", "x").collect()
    rows.sort(key=lambda r: r["hash"])
    return train_scorer([(np.frombuffer(r["at"], "<u2"), np.frombuffer(r["x"], "<f2").astype(np.float32), r["label"]) for r in rows])


def classify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", train_rows: int = TRAIN_ROWS, labels: DataFrame | None = None, toxic: str = "toxic", labelled: int = LABELLED) -> DataFrame:
    """(doc_id, quality_score, clean_score, quality_posterior, clean_posterior, kept) for each row of docs.

    Scores are the linear scorers' probabilities of good quality and of no toxicity, posteriors those of the vote models;
    kept asks that for both tasks the mean of their log-odds is not negative. Only the two named columns are read. A null,
    empty or blank text has no words: its votes call it bad. Repeated rows each return a row and count as often; a null
    doc_id stays null; ties are kept; no rows give no rows. A scorer without any sure row answers one half. Of labels only
    doc_id and `toxic` (1 or not) are read, and no more than `labelled` rows.
    """
    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    names = [f"q_{x}" for x in QUALITY] + [f"t_{x}" for x in TOXICITY]

    terms = read.sparkSession.sparkContext.broadcast(toxic_terms(read, labels, doc_id, toxic, labelled))

    def vote_columns():
        known = Terms(terms.value)

        def run(texts: list) -> list[pa.Array]:
            votes = np.array([sum(labeller_votes(t, known), []) for t in texts], np.int32).reshape(-1, len(names))
            return [pa.array(votes[:, i]) for i in range(len(names))]

        return run

    votes = cut(append_columns(read, "text", [(x, T.IntegerType()) for x in names], vote_columns).withColumn("hash", F.xxhash64("doc_id", "text")).drop("doc_id", "text"))
    models = {}
    for task, own, prior, detection in (("quality", names[: len(QUALITY)], 0.8, 0.2), ("clean", names[len(QUALITY) :], 0.9, 0.8)):
        model = fit_votes(count_patterns(votes, own), own, prior=prior, detection=detection)
        models[task] = model.posterior([F.col(x) for x in own])
    posterior = votes.select("hash", *(p.alias(task) for task, p in models.items())).dropDuplicates(["hash"])
    shared = read.sparkSession.sparkContext.broadcast([fit_task(read, posterior, task, train_rows) for task in models])

    def score_columns():
        words, shapes, weights = Features(), Shapes(), shared.value

        def run(texts: list) -> list[pa.Array]:
            bags = [bag(t, words, shapes) for t in texts]
            return [pa.array([1 / (1 + float(np.exp(-np.clip(float(w[at] @ x), -30, 30)))) for at, x in bags], pa.float64()) for w in weights]

        return run

    scored = append_columns(read, "text", [("quality_score", T.DoubleType()), ("clean_score", T.DoubleType())], score_columns)
    rows = scored.withColumn("hash", F.xxhash64("doc_id", "text")).drop("text").join(posterior, "hash")
    odds = lambda p: F.log(F.greatest(F.col(p), F.lit(1e-9)) / F.greatest(1 - F.col(p), F.lit(1e-9)))
    kept = [odds(f"{t}_score") + odds(t) >= 0 for t in models]
    return rows.select("doc_id", *(F.round(f"{t}_score", 6).alias(f"{t}_score") for t in models), *(F.round(t, 6).alias(f"{t}_posterior") for t in models), (kept[0] & kept[1]).alias("kept"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), labels=table(spark, sf_dir, "labels"))
