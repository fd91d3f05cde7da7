"""Ranked lexical search over an inverted index: a document-at-a-time merge of compressed postings.

Tasks cut their documents into shards of about POSTINGS postings. A shard has a row for each of its terms, with the documents (by
their place in the shard's order of doc_ids) and frequencies as bytes, and one row with doc_ids and lengths. A search keeps the
rows whose term is asked for, weighs terms by sums over them, and merges each shard's postings in its own task: lists lie in a
heap by their next document, whole documents are scored in ascending order, and the best are kept in a bounded heap. Lists whose
bounds together can't reach the worst of a full heap leave the merge; documents that others bring up are looked up in them. All shards'
best are merged at the end. Both the index and a search's work are dealt by shards, so no term is too frequent.
"""

from __future__ import annotations

import heapq
import uuid
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmill.llm.common import checkpoint_dir, cut, table

BEST = 20
POSTINGS = 1_000_000  # of a shard; the document that exceeds it is its last
DOCUMENT = 4  # postings that a document counts for beside its own, so that short ones don't fill a shard without end
BLOCK = 16 << 20  # bytes of the items that are searched for at once, beside the last of them
MERGE = 1_024  # lists of best documents that meet before all do
DOCUMENTS = b""  # in place of a term, as no term is empty: the row of a shard's documents

#: Each byte that belongs to a term as it is, A-Z in lower case, any other as a blank.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

INDEX = "shard long, term binary, n long, tokens long, postings binary, doc_ids array<{id}>, lengths array<int>"


def terms(text: bytes | None) -> list[bytes]:
    """Terms `[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+` of a UTF-8 text, only A-Z lower-cased."""
    return text.translate(TERM_BYTES).split() if text else []


def packed(values: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Whole numbers from 0 in seven bits a byte, the high bit set where more follow; and where each starts."""
    values = values.astype(np.uint64)
    n = np.ones(len(values), np.int64)
    for k in range(1, 10):
        n += values >= (1 << 7 * k)
    ends = np.cumsum(n)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(int(n.max(initial=0))):
        has = n > k
        out[ends[has] - n[has] + k] = (values[has] >> np.uint64(7 * k)).astype(np.uint8) & 127 | np.where(n[has] > k + 1, 128, 0).astype(np.uint8)
    return out.tobytes(), ends - n


def unpacked(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(b < 128)
    starts = np.concatenate(([0], ends[:-1] + 1))
    at = np.arange(len(b)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((b & 127).astype(np.int64) << 7 * at, starts)


def shard_rows(shard: int, documents: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """The rows of one shard from (doc_id, {term: frequency}, length), which are put in the order of doc_ids, nulls last."""
    documents.sort(key=lambda d: (d[0] is None, d[0] if d[0] is not None else 0))
    every = [t for _, counts, _ in documents for t in counts]
    names = sorted(set(every))
    number = {t: k for k, t in enumerate(names)}
    of_term = np.fromiter(map(number.__getitem__, every), np.int64, len(every))
    n = np.fromiter((x for _, counts, _ in documents for x in counts.values()), np.int64, len(every))
    at = np.repeat(np.arange(len(documents)), [len(counts) for _, counts, _ in documents])
    order = np.argsort(of_term, kind="stable")  # by term, documents ascending
    at, n = at[order], n[order]
    sizes = np.bincount(of_term, minlength=len(names))
    first = np.cumsum(sizes) - sizes
    gaps = np.diff(at, prepend=0)
    gaps[first] = at[first]
    data, where = packed(np.column_stack([gaps, n]).ravel())
    cuts = [*where[2 * first].tolist(), len(data)]
    tokens = np.add.reduceat(n, first).tolist()
    columns = [
        [shard] * (len(names) + 1), [DOCUMENTS, *names], [len(documents), *sizes.tolist()], [sum(d[2] for d in documents), *tokens], [None, *(data[a:b] for a, b in zip(cuts, cuts[1:], strict=False))],
        [[d[0] for d in documents], *[None] * len(names)], [[d[2] for d in documents], *[None] * len(names)],
    ]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", postings: int = POSTINGS) -> DataFrame:
    """The index of all documents with a term: a row for each shard and term, (shard, term, n, tokens, postings), n its documents
    and tokens its occurrences there; and one with the empty term for the documents themselves, (doc_ids, lengths).

    Null texts, and such without a term, are not in it; neither doc_ids nor texts need differ, and a doc_id may be null.
    Whole texts are read, and terms have any length. A shard has at most `postings` (each document counts for a few beside its
    own) and one document.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("text"))
    id_type = rows.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        schema = pa.schema([("shard", pa.int64()), ("term", pa.binary()), ("n", pa.int64()), ("tokens", pa.int64()), ("postings", pa.binary()), ("doc_ids", pa.list_(to_arrow_type(id_type))), ("lengths", pa.list_(pa.int32()))])
        shard, held, waiting = TaskContext.get().partitionId() << 32, 0, []
        for batch in batches:
            for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                found = terms(t.as_py())
                if found:
                    waiting.append((i, Counter(found), len(found)))
                    held += len(waiting[-1][1]) + DOCUMENT
                if held >= postings:
                    yield shard_rows(shard, waiting, schema)
                    shard, held, waiting = shard + 1, 0, []
        if waiting:
            yield shard_rows(shard, waiting, schema)

    return rows.mapInArrow(run, INDEX.format(id=id_type.simpleString()))


Wanted = dict[bytes, tuple[int, list[tuple[int, int]]]]  # of a term: its weight, and (item, how often) of the items with it


def merge(lists: list[tuple[list[int], list[int], int]], best: int) -> list[tuple[int, int]]:
    """(score, document) of the `best` highest sums, over lists of (documents ascending, what each adds, the largest of these);
    of equal sums the earlier documents, and none of 0. In no order."""
    lists = sorted(lists, key=lambda x: x[2])
    reach = [0]
    for x in lists:
        reach.append(reach[-1] + x[2])
    at, least, out, worst = [0] * len(lists), 0, [], 0
    while least < len(lists) and reach[least + 1] <= worst:
        least += 1
    heap = [(lists[k][0][0], k) for k in range(least, len(lists))]
    heapq.heapify(heap)
    while heap:
        document, score = heap[0][0], 0
        while heap and heap[0][0] == document:
            k = heap[0][1]
            documents, adds, _ = lists[k]
            score += adds[at[k]]
            at[k] += 1
            if at[k] < len(documents):
                heapq.heapreplace(heap, (documents[at[k]], k))
            else:
                heapq.heappop(heap)
        for k in range(least - 1, -1, -1):
            if score + reach[k + 1] <= worst:
                break
            documents, adds, _ = lists[k]
            at[k] = bisect_left(documents, document, at[k])
            if at[k] < len(documents) and documents[at[k]] == document:
                score += adds[at[k]]
        if score <= worst:  # documents come in ascending order, so that an equal one is no better
            continue
        (heapq.heappush if len(out) < best else heapq.heapreplace)(out, (score, -document))
        if len(out) == best:
            worst, before = out[0][0], least
            while least < len(lists) and reach[least + 1] <= worst:
                least += 1
            if least > before:
                heap = [x for x in heap if x[1] >= least]
                heapq.heapify(heap)
    return [(score, -document) for score, document in out]


def search_shard(rows: pd.DataFrame, wanted: Wanted, total: int, tokens: int, best: int) -> Iterable[tuple]:
    """(item, doc_id, score) of a shard's best documents of each item, from the shard's rows of terms that are asked for."""
    head = rows[rows["term"] == DOCUMENTS].iloc[0]
    length = np.array(head["lengths"], np.int64)
    m = 100 - 25 + (25 * length * total) // tokens
    of_item: dict[int, list] = defaultdict(list)
    for term, data in zip(rows["term"], rows["postings"], strict=True):
        if term != DOCUMENTS:
            weight, items = wanted[bytes(term)]
            pairs = unpacked(data).reshape(-1, 2)
            documents, n = np.cumsum(pairs[:, 0]), pairs[:, 1]
            adds = weight * ((1_000_000_000 * n) // (1_000 * n + 12 * m[documents]))
            one = (documents.tolist(), adds.tolist(), int(adds.max()))
            for item, times in items:
                of_item[item].append(one if times == 1 else (one[0], (adds * times).tolist(), one[2] * times))
    for item, lists in of_item.items():
        for score, document in merge(lists, best):
            yield item, head["doc_ids"][document], score


def asked(items: DataFrame, item_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(item, item_id) of the rows of items, item a number of the row, and (item, term, times) of their distinct terms."""
    rows = cut(items.select(F.monotonically_increasing_id().alias("item"), F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{text}`").cast("binary").alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, t in zip(batch.column("item").to_pylist(), batch.column("text"), strict=True):
                found = Counter(terms(t.as_py()))
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(found), pa.int64()), pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["item", "term", "times"])

    return rows.select("item", "item_id"), cut(rows.select("item", "text").mapInArrow(run, "item long, term binary, times long"))


def blocks(found: DataFrame, most: int) -> tuple[DataFrame, int]:
    """found with block, a number below the second result: a block has at most `most` bytes, and its last item."""
    sizes = cut(found.groupBy("item").agg(F.sum(F.octet_length("term") + 64).alias("bytes")))
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    if total <= most:
        return found.withColumn("block", F.lit(0)), 1
    # Sums run over heaps of about half a block, however many items there are.
    heaps = Window.partitionBy(F.pmod(F.xxhash64("item"), F.lit(2 * total // most + 1)).alias("heap")).orderBy("item").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.select("item", F.pmod(F.xxhash64("item"), F.lit(2 * total // most + 1)).alias("heap"), F.floor(F.coalesce(F.sum("bytes").over(heaps), F.lit(0)) / most).alias("part"))
    names = [(r["heap"], r["part"], k) for k, r in enumerate(placed.select("heap", "part").distinct().collect())]  # a row for each block
    named = found.sparkSession.createDataFrame(names, "heap long, part long, block int")
    return cut(found.join(placed.join(F.broadcast(named), ["heap", "part"]).select("item", "block"), "item")), len(names)


def search(indexed: DataFrame, items: DataFrame, item_id: str = "item_id", text: str = "text", best: int = BEST, block: int = BLOCK) -> DataFrame:
    """(item_id, rank, doc_id, score) of the `best` documents with the highest score above 0 of each row of items; equal scores by
    ascending doc_id, nulls last. The score of a document adds up, over the item's terms with repeats, floor(1000 ln((2 N + 2) /
    (2 df + 1))) times (10^9 tf) div (1000 tf + 12 m), m being 75 + (25 n N) div L.

    Items of a null text, and such without a term that occurs, have no rows. indexed should be a written table, as it is read for the
    weights and for the postings of each block. Items are searched for in blocks of a checked size.
    """
    spark = indexed.sparkSession
    total, tokens = indexed.where(F.col("term") == DOCUMENTS).agg(F.sum("n"), F.sum("tokens")).first()
    names, found = asked(items, item_id, text)
    id_type = indexed.schema["doc_ids"].dataType.elementType.simpleString()
    schema, parts = f"item long, doc_id {id_type}, score long, shard long", []
    found, n = blocks(found, block)
    for b in range(n if total else 0):
        mine = found.where(F.col("block") == b)
        sums = indexed.join(F.broadcast(mine.select("term").distinct()), "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"))
        weight = F.floor(1000 * F.log((2 * F.lit(total) + 2).cast("double") / (2 * F.col("df") + 1))).cast("long")
        wanted: Wanted = {}
        for r in mine.join(F.broadcast(sums.select("term", weight.alias("weight"))), "term").collect():  # a block, of checked size
            wanted.setdefault(bytes(r["term"]), (r["weight"], []))[1].append((r["item"], r["times"]))
        parts.append(_search(indexed, mine, spark.sparkContext.broadcast(wanted), total, tokens, best, schema))
    if not parts:
        parts = [spark.createDataFrame([], schema)]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    by = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    some = every.withColumn("_k", F.row_number().over(Window.partitionBy("item", F.pmod(F.xxhash64("shard"), F.lit(MERGE))).orderBy(*by))).where(F.col("_k") <= best)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*by))).where(F.col("rank") <= best)
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")


def _search(indexed: DataFrame, mine: DataFrame, wanted, total: int, tokens: int, best: int, schema: str) -> DataFrame:
    """The best documents of each shard for a block of items."""
    head = indexed.sparkSession.createDataFrame([(bytearray(DOCUMENTS),)], "term binary")
    rows = indexed.join(F.broadcast(mine.select("term").unionByName(head).distinct()), "term", "left_semi")

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        found = list(search_shard(rows, wanted.value, total, tokens, best))
        return pd.DataFrame({"item": pd.array([x[0] for x in found], "Int64"), "doc_id": pd.Series([x[1] for x in found], dtype=object), "score": pd.array([x[2] for x in found], "Int64"), "shard": key[0]})

    return rows.groupBy("shard").applyInPandas(run, schema)


def search_documents(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", best: int = BEST, postings: int = POSTINGS, block: int = BLOCK) -> DataFrame:
    """search() over an index of docs written into the shared folder. Empty tables give no rows; other columns are not read."""
    folder = f"{checkpoint_dir(docs.sparkSession)}/index-{uuid.uuid4()}"
    made = index(docs, doc_id, text, postings)
    made.write.parquet(folder)
    return search(docs.sparkSession.read.schema(made.schema).parquet(folder), items, item_id, item_text, best, block)


def op12_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP12_SQL = f"""WITH t AS MATERIALIZED (SELECT doc_id, len(w) AS n, w FROM (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents) WHERE len(w) > 0),
p AS MATERIALIZED (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(w) AS term FROM t) GROUP BY ALL),
q AS MATERIALIZED (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
s AS (SELECT count(*) AS total, sum(n)::BIGINT AS tokens FROM t),
f AS (SELECT term, floor(1000 * ln((2 * total + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight FROM p, s WHERE term IN (SELECT term FROM q) GROUP BY term, total),
x AS (SELECT item_id, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * total) // tokens))))::BIGINT AS score FROM q JOIN f USING (term) JOIN p USING (term), s GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
  FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM x WHERE score > 0)
  WHERE rank <= {BEST}"""
