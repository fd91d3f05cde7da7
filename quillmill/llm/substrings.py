"""Substring duplicates as sliding sentence spans.

A text is cut into sentences, and those of over LONG words (lists, texts without end marks) into parts: behind commas and the
like, and parts that are still longer behind words with certain last letters, so that a passage is cut alike wherever it stands. From each sentence goes a span: the shortest run of
consecutive sentences with at least LEAST_WORDS words, and one more that ends where the text ends. Every span is hashed; equal
spans are found by a global aggregation and a join on the hash; and sentences that lie in any span which is not the first of
its kind are removed. The first span is that of the smallest (doc_id, text hash, position).

With sentences of k words a passage of LEAST_WORDS + 2 * k words holds a whole span wherever it begins. Spans of fewer than
LEAST_WORDS words are no passages, so texts below that stay as they are.
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

from quillmill.llm.common import append_columns, cut, table

LEAST_WORDS = 25  # of a span
SPAN_CODE = 1 << 20  # a span has fewer sentences: no more than LEAST_WORDS
LONG = 30  # words of a sentence that is not cut
BLANK = r"\x20\x09-\x0D"
#: A sentence ends behind . ! or ? (with quotes or brackets) and white space, or behind a line break.
END = rf"[.!?][\"')\]]*[{BLANK}]+|\n[{BLANK}]*"
#: Where long ones are cut, first so, then so: behind about two in five words of English.
CUTS = (rf"[,;:][{BLANK}]+", rf"[adrst05ADRST][{BLANK}]+")
_end, _cuts = re.compile(END.encode()), [re.compile(x.encode()) for x in CUTS]


def parts_of(raw: bytes, ends: re.Pattern, start: int, stop: int) -> list[int]:
    """Where the parts of raw[start:stop] end."""
    found = [m.end() for m in ends.finditer(raw, start, stop)]
    return found if found and found[-1] == stop else [*found, stop]


def sentences(text: str | None, long_: int = LONG) -> tuple[bytes, list[int], list[list[bytes]]]:
    """(the text in UTF-8, n + 1 bounds of its n sentences, the words of each in A-Z lower case). White space belongs to the
    sentence before it, and that at the start of the text to none."""
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    start = len(raw) - len(raw.lstrip())
    bounds, words = [start], []
    if start == len(raw):
        return raw, bounds, words
    lower = raw.lower()

    def add(at: int, stop: int, cuts: list[re.Pattern]) -> None:
        own = lower[at:stop].split()
        if len(own) > long_ and cuts:
            for end in parts_of(raw, cuts[0], at, stop):
                add(at, end, cuts[1:])
                at = end
        else:
            bounds.append(stop)
            words.append(own)

    at = start
    for end in parts_of(raw, _end, start, len(raw)):
        add(at, end, _cuts)
        at = end
    return raw, bounds, words


def spans(words: list[list[bytes]], least_words: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """(first sentence, number of sentences, 128-bit hash) of each span."""
    total = np.cumsum([0, *map(len, words)])
    if total[-1] < least_words:
        return []
    plain = [b" ".join(w) for w in words]
    stops = np.searchsorted(total, total[:-1] + least_words)
    last = int(np.searchsorted(total, total[-1] - least_words, "right")) - 1  # the latest span that ends with the text
    found = [(i, j) for i, j in enumerate(stops.tolist()) if j <= len(words)]
    if (last, len(words)) not in found[-1:]:
        found.append((last, len(words)))
    digest = xxhash.xxh3_128_intdigest
    return [(i, j - i, digest(b" ".join(plain[i:j]))) for i, j in found]


def all_spans(read: DataFrame, least_words: int, long_: int) -> DataFrame:
    """(doc_id, text_hash, at, n, h1, h2) of every span of read (doc_id, text, text_hash)."""
    schema = T.StructType([read.schema["doc_id"], T.StructField("text_hash", T.LongType()), T.StructField("at", T.IntegerType()), T.StructField("n", T.IntegerType()), T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType())])
    low = (1 << 64) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, rows = [], []

            def flush() -> pa.RecordBatch:
                at, n, h1, h2 = (np.array([r[k] for r in rows], np.uint64) for k in range(4))
                who = pa.array(row, pa.int64())
                out = [batch.column("doc_id").take(who), batch.column("text_hash").take(who), pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))]
                row.clear(), rows.clear()
                return pa.RecordBatch.from_arrays(out, names=[f.name for f in schema])

            for k, text in enumerate(batch.column("text").to_pylist()):
                for i, n, h in spans(sentences(text, long_)[2], least_words):
                    row.append(k)
                    rows.append((i, n, h >> 64, h & low))
                if len(rows) > 100_000:
                    yield flush()
            yield flush()

    return read.mapInArrow(run, schema)


def repeated_spans(read: DataFrame, least_words: int = LEAST_WORDS, long_: int = LONG) -> DataFrame:
    """(doc_id, text_hash, at, n) of the spans that are not the first of their kind."""
    # Most spans occur once. Half of the hash tells them apart at the least cost; only what is left is kept and compared by the
    # whole hash. Spans are made twice, as all of them take more room than the texts. Both right sides are checkpoints, so that
    # Spark can split a hash that a large part of the texts share.
    found = all_spans(read, least_words, long_)
    twice = cut(found.groupBy("h1").agg(F.count("*").alias("k")).where("k > 1").select("h1"))
    several = cut(found.join(twice, "h1"))
    place = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "text_hash", "at")
    first = cut(several.groupBy("h1", "h2").agg(F.min(place).alias("first")))
    return several.join(first, ["h1", "h2"]).where(~place.eqNullSafe(F.col("first"))).select("doc_id", "text_hash", "at", "n").distinct()


def without(text: str | None, gone: list[int] | None, long_: int) -> tuple[int, int, str | None]:
    """(number of sentences, how many go, the text without them). gone has first sentence * SPAN_CODE + number of sentences of
    each span."""
    raw, bounds, words = sentences(text, long_)
    if not gone:
        return len(words), 0, text
    step, (at, n) = np.zeros(len(words) + 1, np.int64), np.divmod(np.array(gone, np.int64), SPAN_CODE)
    np.add.at(step, at, 1)
    np.add.at(step, at + n, -1)
    stays = np.cumsum(step[:-1]) == 0
    kept = [raw[: bounds[0]], *(raw[a:b] for a, b, s in zip(bounds, bounds[1:], stays.tolist(), strict=False) if s)]
    return len(words), int((~stays).sum()), b"".join(kept).decode("utf-8", "surrogatepass")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS, long_: int = LONG) -> DataFrame:
    """(doc_id, n_sentences, n_removed, text) for each row of docs; text is what stays, with its white space.

    Only the two named columns are read. A null text stays null with no sentences; an empty one stays empty, and one of white
    space has no sentences. Repeated rows with equal doc_id and text are taken as one place and get the same result; of equal
    texts under several doc_ids that of the smallest doc_id stays (null doc_ids come last). Ties within a text go by position.
    No rows give no rows.
    """
    if least_words >= SPAN_CODE:
        raise ValueError(f"least_words is {least_words}; it must be below {SPAN_CODE}")
    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("text_hash"))
    covered = repeated_spans(read, least_words, long_).groupBy("doc_id", "text_hash").agg(F.collect_list(F.col("at").cast("long") * SPAN_CODE + F.col("n")).alias("gone"))
    gone = covered.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "gone")
    rows = read.join(gone, read["doc_id"].eqNullSafe(gone["_id"]) & (read["text_hash"] == gone["_hash"]), "left").select("doc_id", F.struct("text", "gone").alias("both"))

    def make():
        def run(values: list) -> list[pa.Array]:
            done = [without(v["text"], v["gone"], long_) for v in values]
            return [pa.array([r[k] for r in done], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string()))]

        return run

    return append_columns(rows, "both", [("n_sentences", T.LongType()), ("n_removed", T.LongType()), ("text", T.StringType())], make).drop("both")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


_word = f"[^{BLANK}]+"
_quoted = lambda pattern: pattern.replace("'", "''")
_cut_sql = lambda column, at: rf"flatten(list_transform({column}, lambda x: CASE WHEN len(regexp_extract_all(x, '{_word}')) > {LONG} THEN list_filter(string_split(regexp_replace(x, '({at})', '\1' || chr(1), 'g'), chr(1)), lambda y: y <> '') ELSE [x] END))"
OP4_SQL = rf"""
WITH d AS (SELECT doc_id, text, regexp_extract(coalesce(text, ''), '^[{BLANK}]*') AS lead, regexp_replace(coalesce(text, ''), '^[{BLANK}]*', '') AS body FROM documents),
s AS (SELECT doc_id, list_filter(string_split(regexp_replace(body, '({_quoted(END)})', '\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS whole FROM d),
c AS (SELECT doc_id, {_cut_sql('whole', CUTS[0])} AS pieces FROM s),
p AS (SELECT doc_id, {_cut_sql('pieces', CUTS[1])} AS parts FROM c),
w AS (
  SELECT doc_id, parts, list_transform(parts, lambda x: array_to_string(regexp_extract_all(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_word}'), ' ')) AS plain
  FROM p),
u AS (
  SELECT doc_id, pos, words, sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS upto, sum(words) OVER (PARTITION BY doc_id) AS total
  FROM (SELECT doc_id, pos, len(string_split(plain[pos], ' ')) AS words FROM (SELECT doc_id, plain, unnest(range(1, len(plain) + 1)) AS pos FROM w))),
spans AS (
  SELECT a.doc_id, a.pos AS i, b.pos AS j FROM (SELECT *, upto - words + {LEAST_WORDS} AS need FROM u) a ASOF JOIN u b ON a.doc_id = b.doc_id AND a.need <= b.upto
  UNION
  SELECT doc_id, max(pos), max(n) FROM (SELECT *, max(pos) OVER (PARTITION BY doc_id) AS n FROM u) WHERE total - upto + words >= {LEAST_WORDS} GROUP BY doc_id),
f AS (SELECT doc_id, i, j, row_number() OVER (PARTITION BY array_to_string(plain[i : j], ' ') ORDER BY doc_id, i) AS k FROM spans JOIN w USING (doc_id)),
g AS (SELECT doc_id, list(DISTINCT gone_at) AS gone FROM (SELECT doc_id, unnest(range(i, j + 1)) AS gone_at FROM f WHERE k > 1) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(parts) AS BIGINT) AS n_sentences, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  CASE WHEN gone IS NULL THEN text ELSE lead || array_to_string(list_transform(list_filter(range(1, len(parts) + 1), lambda i: NOT list_contains(gone, i)), lambda i: parts[i]), '') END AS text
FROM d JOIN w USING (doc_id) LEFT JOIN g USING (doc_id)
"""
