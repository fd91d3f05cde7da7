"""Language-model scoring: a log-bilinear neural model, trained in numpy with noise-contrastive estimation.

Spark counts all training tokens. The HEAD most frequent types are classes of the neural model of their own; every other type,
known or not, belongs to one of TAIL classes by its last SUFFIX bytes, which tell languages and kinds of words apart. Within such
a class a type's probability is its add-one share of the class's training tokens, with one place for unknown types. So
P(token | two tokens before) = P(class | classes before) * P(token | class) sums to one. The neural part has one size for any
input; the shares within the classes grow with the vocabulary.

Texts are read twice: for the counts, and to encode each as its classes, which are kept. Training is data-parallel: every task
trains on all training rows of its partition by noise-contrastive estimation, and the weights are averaged over the tasks
(weighted by tokens) in a two-step aggregation, ROUNDS times: so the score depends a little on how rows are dealt out. The normaliser of each of the (HEAD + TAIL) ** 2 contexts is then
computed once, in batched matrix products that Spark deals out by rows.

The most frequent types, at most TABLE, are known in the tasks (a broadcast of bounded size); only rarer tokens are joined with
the counts, so that the join has no hot keys. Which these are a histogram of the counts tells: no task sorts all types.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmill.llm.common import append_columns, cut, table

HEAD, TAIL = 640, 384  # classes: frequent types, and groups of all others
SUFFIX = 3  # bytes of a type that choose its group
DIM = 24
NOISE = 64
BATCH = 8192
ROUNDS = 2
RATE = 0.05
TABLE = 1 << 17
LONGEST = 64  # bytes; a longer type goes by its digest, so that the table has at most 8 MB of text
STEPS = 16  # buckets of the histogram for each doubling of a count
FLUSH = 400_000  # distinct types that a task keeps; more are passed on
END = b""
CHUNK = 2048  # weights in a row of the averaging
PIECE = 4 << 20  # bytes of text that are cut into words at once, if not one longer text


def digest(word: bytes) -> bytes:
    """Of a long word: a blank and its digest, which no word can be."""
    return b" " + xxhash.xxh3_128_digest(word)


def tokens(text: str | None) -> list[bytes]:
    """Words, lower-cased in A-Z, long ones by their digest, and the end token."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    return [*(w if len(w) <= LONGEST else digest(w) for w in words), END]


def token_arrays(texts: pa.Array, size: int = PIECE) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """tokens() of all texts, in runs of at most so many bytes or of one text: where each text's tokens begin, with the end of the last; the tokens."""
    ends = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64).cumsum()
    lo, none, blank = 0, pa.scalar("", texts.type), pa.scalar(" ", texts.type)
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + size, "right")))
        text = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts[lo:hi], none)))
        text = pc.if_else(pc.equal(text, none), text, pc.binary_join_element_wise(text, none, blank))  # a blank behind the last word leaves END behind it
        lists = pc.ascii_split_whitespace(text)
        words = lists.values.cast(pa.binary())
        long = pc.greater(pc.binary_length(words), LONGEST)
        if pc.any(long).as_py():
            words = pc.replace_with_mask(words, long, pa.array([digest(w) for w in words.filter(long).to_pylist()], pa.binary()))
        yield lists.offsets.to_numpy().astype(np.int64), words
        lo = hi


def group_of(word: bytes, tail: int) -> int:
    return zlib.crc32(word[-SUFFIX:]) % tail


def held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 7 is 2; a null doc_id is in training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def count_tokens(docs: DataFrame, text: str, flush: int = FLUSH) -> DataFrame:
    """(token binary, c) over all rows. A task keeps about as many types as flush says and passes on what it has beyond that."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.Table] = []

        def merged() -> pa.Table:
            return pa.concat_tables(parts).group_by("token", use_threads=False).aggregate([("c", "sum")]).rename_columns(["token", "c"])

        for batch in batches:
            for _, words in token_arrays(batch.column(0)):
                parts.append(pa.table(words.value_counts().flatten(), names=["token", "c"]))
                if sum(map(len, parts)) > 2 * flush:
                    parts = [merged()]
                    if len(parts[0]) > flush:
                        yield from parts.pop().to_batches()
        if parts:
            yield from merged().to_batches()

    return docs.select(text).mapInArrow(run, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


class Weights:
    """Context embeddings R, output embeddings O, position matrices C (two), biases b: one flat float32 vector."""

    def __init__(self, n: int, dim: int, flat: np.ndarray | None = None):
        self.n, self.dim = n, dim
        size = 2 * n * dim + 2 * dim * dim + n
        self.flat = np.zeros(size, np.float32) if flat is None else flat
        at = 0
        for name, shape in (("R", (n, dim)), ("O", (n, dim)), ("C", (2, dim, dim)), ("b", (n,))):
            k = int(np.prod(shape))
            setattr(self, name, self.flat[at : at + k].reshape(shape))
            at += k

    @classmethod
    def start(cls, share: np.ndarray, dim: int) -> Weights:
        """A unigram model, with small embeddings to learn from."""
        w, rng = cls(len(share), dim), np.random.default_rng(11)
        w.R[:] = rng.normal(0, 0.3, w.R.shape)
        w.O[:] = rng.normal(0, 0.05, w.O.shape)
        w.C[:] = np.stack([np.eye(dim) * 0.5, np.eye(dim)])
        w.b[:] = np.log(share)
        return w

    def query(self, before: np.ndarray, last: np.ndarray) -> np.ndarray:
        return self.R[before] @ self.C[0] + self.R[last] @ self.C[1]


class Trainer:
    """Noise-contrastive estimation with AdaGrad, from the weights flat on; share: of each class among the tokens.

    Arrays of a batch's size are made once. What is linear in the rows of R is done for the classes, not for each token:
    products with C before rows are looked up, and after gradients are summed by class.
    """

    def __init__(self, flat: np.ndarray, share: np.ndarray, dim: int):
        n = len(share)
        self.w, self.g, self.memory = Weights(n, dim, flat.copy()), Weights(n, dim), np.full(len(flat), 1.0, np.float32)
        self.expected = np.log(NOISE * share.astype(np.float32))
        self.q, self.own, self.dq = (np.empty((BATCH, dim), np.float32) for _ in range(3))
        self.other = np.empty((BATCH, NOISE), np.float32)
        self.kind = np.dtype(np.float32 if dim % 2 else np.complex64)  # sums take two numbers at a time, which a complex one is
        self.width = dim * 4 // self.kind.itemsize
        self.place = np.empty((BATCH, self.width), np.int64)

    def scatter(self, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Sum of rows by at."""
        place, out = self.place[: len(at)], np.zeros((self.w.n, self.w.dim), np.float32)
        np.add((at * self.width)[:, None], np.arange(self.width), out=place)
        np.add.at(out.view(self.kind).reshape(-1), place.reshape(-1), rows.view(self.kind).reshape(-1))
        return out

    def step(self, before: np.ndarray, last: np.ndarray, target: np.ndarray, noise: np.ndarray, rate: float) -> None:
        """One step over at most BATCH tokens, with NOISE noise samples shared by them."""
        w, g, m = self.w, self.g, len(target)
        q, own, dq, other = self.q[:m], self.own[:m], self.dq[:m], self.other[:m]
        np.take(w.R @ w.C[0], before, axis=0, out=q, mode="clip")
        np.take(w.R @ w.C[1], last, axis=0, out=own, mode="clip")
        q += own
        np.take(w.O, target, axis=0, out=own, mode="clip")
        bias, away = w.b - self.expected, w.O[noise]
        data = np.einsum("ij,ij->i", q, own) + bias[target]
        np.matmul(q, -away.T, out=other)
        other -= bias[noise]
        with np.errstate(over="ignore"):
            up = 1 / (1 + np.exp(data))  # towards the data
            np.exp(other, out=other)
        other += 1
        down = np.divide(-1, other, out=other)  # away from the noise
        np.matmul(down, away, out=dq)
        own *= up[:, None]
        dq += own
        np.multiply(q, up[:, None], out=own)
        g.O[:] = self.scatter(target, own)
        np.add.at(g.O, noise, down.T @ q)
        g.b[:] = np.bincount(target, up, w.n) + np.bincount(noise, np.ones(m, np.float32) @ down, w.n)
        g.R[:] = 0
        for i, context in enumerate((before, last)):
            total = self.scatter(context, dq)
            g.C[i] = w.R.T @ total
            g.R += total @ w.C[i].T
        self.memory += g.flat * g.flat
        w.flat += rate * g.flat / np.sqrt(self.memory)


def contexts(rows: list[bytes], start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of encoded texts, each with a token: the two classes before each token, its own, and where each text begins."""
    size = np.fromiter(map(len, rows), np.int64, len(rows)) // 2
    first = np.cumsum(size) - size
    ids = np.frombuffer(b"".join(rows), "<u2").astype(np.int64)
    before, last = np.empty_like(ids), np.empty_like(ids)
    last[1:] = ids[:-1]
    last[first] = start
    before[1:] = last[:-1]
    before[first] = start
    return before, last, ids, first


def gathered(rows: Iterable[bytes], least: int) -> Iterator[list[bytes]]:
    """Encoded texts in runs of at least so many tokens, except for the last."""
    some, size = [], 0
    for row in rows:
        some.append(row)
        size += len(row) // 2
        if size >= least:
            yield some
            some, size = [], 0
    if some:
        yield some


def train_round(encoded: DataFrame, start_id: int, share: np.ndarray, flat: np.ndarray, dim: int, rate: float) -> np.ndarray:
    """The mean of the weights that each partition of encoded (ids) arrives at from flat."""
    sc = encoded.sparkSession.sparkContext
    shared = sc.broadcast((flat, share))
    n = len(share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        start, part = shared.value[0], TaskContext.get().partitionId()
        trainer, rng, edges, seen = Trainer(start, share, dim), np.random.default_rng(part), np.cumsum(share), 0
        w = trainer.w
        for some in gathered((row for batch in batches for row in batch.column(0).to_pylist()), 8 * BATCH):
            before, last, target, _ = contexts(some, start_id)
            seen += len(target)
            for lo in range(0, len(target), BATCH):
                at = slice(lo, lo + BATCH)
                noise = np.minimum(np.searchsorted(edges, rng.random(NOISE)), n - 1)
                trainer.step(before[at], last[at], target[at], noise, rate)
        if seen:
            parts = [w.flat[i : i + CHUNK].astype(np.float64) * seen for i in range(0, len(w.flat), CHUNK)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array([part % 64] * len(parts), pa.int32()), pa.array([seen] * len(parts), pa.int64()), pa.array([x.tobytes() for x in parts], pa.binary())], names=["chunk", "salt", "n", "v"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(v, np.float64) for v in pdf["v"])
        return pd.DataFrame({"chunk": pdf["chunk"].iloc[:1], "salt": [0], "n": [pdf["n"].sum()], "v": [total.tobytes()]})

    schema = "chunk int, salt int, n long, v binary"
    sums = encoded.select("ids").mapInArrow(run, schema).groupBy("chunk", "salt").applyInPandas(add, schema).groupBy("chunk").applyInPandas(add, schema)
    rows = sums.orderBy("chunk").collect()  # the weights: of one size for any input
    return np.concatenate([np.frombuffer(r["v"], np.float64) / r["n"] for r in rows]).astype(np.float32) if rows else flat


def normalisers(spark: SparkSession, w: Weights) -> np.ndarray:
    """log of the sum of exp(score) over all classes, for each context (before, last)."""
    shared, n, dim = spark.sparkContext.broadcast(w.flat), w.n, w.dim

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Weights(n, dim, shared.value.copy())
        last = own.R @ own.C[1]
        for batch in batches:
            for row in batch.column(0).to_pylist():
                scores = (last + own.R[row] @ own.C[0]) @ own.O.T + own.b
                top = scores.max(axis=1)
                z = np.log(np.exp(scores - top[:, None]).sum(axis=1, dtype=np.float64)) + top
                yield pa.RecordBatch.from_arrays([pa.array([row], pa.int64()), pa.array([z.astype(np.float32).tobytes()], pa.binary())], names=["id", "z"])

    rows = spark.range(0, n, 1, min(n, 16)).mapInArrow(run, "id long, z binary").collect()
    return np.stack([np.frombuffer(r["z"], np.float32) for r in sorted(rows, key=lambda r: r["id"])])


def frequent_types(counts: DataFrame, most: int) -> tuple[pa.Table, DataFrame]:
    """(the most frequent types (token, c), all that a histogram of the counts allows without exceeding `most`; the others)."""
    bucket = F.floor(F.log2(F.col("c").cast("double")) * STEPS)
    sizes = sorted(((r["b"], r["n"]) for r in counts.groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).collect()), reverse=True)  # 64 * STEPS rows at most
    total, least = 0, (sizes[0][0] + 1 if sizes else 0)
    for b, n in sizes:
        total += n
        if total > most:
            break
        least = b
    return counts.where(bucket >= least).toArrow(), counts.where(bucket < least)


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", head: int = HEAD, tail: int = TAIL, dim: int = DIM, rounds: int = ROUNDS, rate: float = RATE, table_size: int = TABLE, model_out: dict | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of docs.

    Only the two named columns are read. Null, empty and blank texts are the end token alone. A null doc_id is in training
    and stays null. Repeated rows each count and each return a row. Token types of equal count go by their bytes. Where no
    row is in training every token is unknown, and its base probability is one. No rows give no rows. A dictionary given as
    model_out gets the model: weights, the classes of frequent types, and the groups' training tokens and types.
    """
    spark = docs.sparkSession
    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), held_out(F.col(doc_id)).alias("held_out"))
    counts = cut(count_tokens(read.where(~F.col("held_out")), "text"))
    group = (F.crc32(F.substring("token", -SUFFIX, SUFFIX)) % tail).cast("int")
    groups = counts.groupBy(group.alias("k")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()  # one row for each group
    top, others = frequent_types(counts, table_size)
    c_of = dict(zip(top.column(0).to_pylist(), top.column(1).to_pylist(), strict=True))
    own = sorted(c_of, key=lambda x: (-c_of[x], x))[:head]
    if END in c_of and END not in own:
        own[-1:] = [END]
    known = {x: tail + i for i, x in enumerate(own)}
    n_of, v_of = np.zeros(tail), np.zeros(tail)  # training tokens and types of the groups
    for r in groups:
        n_of[r["k"]], v_of[r["k"]] = r["n"], r["v"]
    n_all, v_all = int(n_of.sum()), int(v_of.sum())
    for x in own:
        k = group_of(x, tail)
        n_of[k], v_of[k] = n_of[k] - c_of[x], v_of[k] - 1
    weight = np.concatenate([n_of + 1, [c_of[x] for x in own]])
    share = weight / weight.sum()
    model = spark.sparkContext.broadcast((c_of, known, np.log10(n_of + v_of + 1)))
    rare_struct = T.ArrayType(T.StructType([T.StructField("token", T.BinaryType()), T.StructField("n", T.LongType())]))
    arrow = pa.list_(pa.struct([("token", pa.binary()), ("n", pa.int64())]))

    def encode():
        c_of, known, below = model.value
        words = list(c_of)
        place, outside = pa.array(words, pa.binary()), len(words)
        value = np.append(np.log10(np.array([c_of[x] for x in words], np.float64) + 1), 0.0)
        kind = np.array([*(known[x] if x in known else group_of(x, tail) for x in words), 0], np.uint16)
        below = np.concatenate([below, np.zeros(len(known))])

        def piece(first: np.ndarray, words: pa.Array) -> list[pa.Array]:
            at = pc.fill_null(pc.index_in(words, value_set=place), outside).to_numpy()
            ids, far, n = kind[at], np.flatnonzero(at == outside), len(first) - 1
            rare = words.take(far).dictionary_encode()
            ends = pc.binary_slice(rare.dictionary, -SUFFIX).dictionary_encode()
            groups = np.array([group_of(x, tail) for x in ends.dictionary.to_numpy(zero_copy_only=False)], np.uint16)
            which, types = rare.indices.to_numpy(), max(1, len(rare.dictionary))
            ids[far] = groups[ends.indices.to_numpy()[which]]
            row = np.searchsorted(first, far, "right") - 1
            pairs, times = np.unique(row * types + which, return_counts=True)
            rest = pa.StructArray.from_arrays([rare.dictionary.take(pairs % types), pa.array(times, pa.int64())], fields=list(arrow.value_type))
            logs, size = value[at], np.diff(first)
            group_logs = np.where(ids < tail, logs, 0.0) - below[ids]
            return [
                pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((2 * first).astype(np.int32)), pa.py_buffer(ids.astype("<u2"))]), pa.array(size),
                pa.array(size - np.bincount(row, minlength=n)), pa.array(np.add.reduceat(logs, first[:-1])), pa.array(np.add.reduceat(group_logs, first[:-1])),
                pa.ListArray.from_arrays(pa.array(np.searchsorted(pairs, types * np.arange(n + 1)), pa.int32()), rest, type=arrow),
            ]

        def run(texts: pa.Array) -> list[pa.Array]:
            pieces = [piece(*x) for x in token_arrays(texts)]
            return [pa.concat_arrays(x) for x in zip(*pieces, strict=True)] if pieces else [pa.array([], t) for t in (pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), arrow)]

        return run

    fields = [("ids", T.BinaryType()), ("n_tokens", T.LongType()), ("in_table", T.LongType()), ("logs", T.DoubleType()), ("group_logs", T.DoubleType()), ("outside", rare_struct)]
    encoded = cut(append_columns(read, "text", fields, encode, as_list=False).drop("text"))
    start_id = known.get(END, group_of(END, tail))
    w = Weights.start(share, dim)
    for r in range(rounds if n_all else 0):
        w = Weights(len(share), dim, train_round(encoded.where(~F.col("held_out")), start_id, share, w.flat, dim, rate / (1 + r)))
    if model_out is not None:
        model_out |= {"weights": w, "classes": known, "group_tokens": n_of, "group_types": v_of}
    trained = spark.sparkContext.broadcast((w.flat, normalisers(spark, w)))
    n_classes = len(share)

    def score():
        flat, z = trained.value
        own = Weights(n_classes, dim, flat.copy())
        far, near = own.R @ own.C[0], own.R @ own.C[1]

        def run(rows: list) -> list[pa.Array]:
            out = []
            for some in gathered(rows, 1 << 16):
                before, last, ids, first = contexts(some, start_id)
                logs = np.empty(len(ids), np.float32)
                for lo in range(0, len(ids), 1 << 13):  # a part that caches hold
                    at = slice(lo, lo + (1 << 13))
                    logs[at] = np.einsum("ij,ij->i", far[before[at]] + near[last[at]], own.O[ids[at]]) + own.b[ids[at]] - z[before[at], last[at]]
                out.append(np.add.reduceat(logs, first, dtype=np.float64) / np.log(10))
            return [pa.array(np.concatenate(out) if out else [], pa.float64())]

        return run

    numbered = encoded.withColumn("row", F.monotonically_increasing_id())  # of a checkpoint, so always the same
    far = numbered.select("row", F.explode("outside").alias("o")).select("row", "o.token", "o.n")
    met = far.join(others, "token").groupBy("row").agg(F.sum("n").alias("more"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("more_logs"))
    rows = append_columns(numbered.drop("outside"), "ids", [("class_score", T.DoubleType())], score).drop("ids").join(met, "row", "left")
    more, more_logs = F.coalesce("more", F.lit(0)), F.coalesce("more_logs", F.lit(0.0))
    return rows.select(
        "doc_id", "held_out", "n_tokens", (F.col("in_table") + more).alias("n_known"), F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("logs") + more_logs - F.col("n_tokens") * F.lit(float(np.log10(n_all + v_all + 1)))).alias("base_score"),
        (F.col("class_score") + F.col("group_logs") + more_logs).alias("score"),
    )


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
