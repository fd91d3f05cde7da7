"""Best-fit packing of tokenised documents into sequences of fixed length by swap-based local search.

Documents are tokenised and cut to pieces in parallel. Pieces are dealt by a hash to shards of about SHARD pieces, so that
a shard fits in one task at any input size. Within a shard best fit in the order of the documents gives a first packing; then
local search moves pieces between underfull bins, exchanges one for one and two for one, each time so that the sum of squared
fills grows, until bins empty or nothing improves. The bins that are still underfull then, of all shards together, are packed
anew in fewer shards, round by round until one shard holds them or a round leaves most of its pieces in such bins.
"""

from __future__ import annotations

import base64
import heapq
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmill.llm.common import append_columns, cut, table

MAX_TOKENS = 2048
EOS = 0
SHARD = 40_000
#: The vocabulary of byte_bpe_50k.json as ranks: the same ids, at a quarter of the CPU time (tests compare the two).
VOCABULARY = "byte_bpe_50k.tiktoken"
#: The characters of Unicode's White_Space.
LONG_BLANK = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")
_loaded: dict[str, tiktoken.Encoding] = {}


def encoding(path: str) -> tiktoken.Encoding:
    """The vocabulary at path; a Python worker loads it once."""
    if path not in _loaded:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _loaded[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _loaded[path]


def encoder(path: str) -> Callable[[str], list[int]]:
    """From a text to its ids. The pattern's backtracking overflows on a very long run of blanks; such a run is therefore
    cut out where the pattern cuts it: all of it but the last blank, which goes with what follows, is one part of the text."""
    found = encoding(path)

    def encode(text: str) -> list[int]:
        out, at = [], 0
        for run in LONG_BLANK.finditer(text):
            end = run.end() - (run.end() < len(text))
            out += found.encode_ordinary(text[at : run.start()])
            out += found._encode_single_piece(text[run.start() : end])
            at = end
        return out + found.encode_ordinary(text[at:])

    return encode


def tokenized_pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None, max_tokens: int = MAX_TOKENS, eos: int = EOS, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) for each piece of each row; ids is little-endian uint32.

    A null or empty text is the end token alone. Longer documents than max_tokens are cut so that all pieces but the first
    are full. A null doc_id stays null.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    piece = T.StructType([T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()), *([T.StructField("ids", T.BinaryType())] if with_ids else [])])
    arrow = pa.list_(pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), *([("ids", pa.binary())] if with_ids else [])]))

    def make():
        encode = encoder(path)

        def one(value: str | None) -> list[dict]:
            ids = np.array([*encode(value or ""), eos], "<u4")
            n = len(ids)
            first = n % max_tokens or min(n, max_tokens)
            bounds = [0, *range(first, n + 1, max_tokens)]
            out = []
            for i, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                raw = ids[a:b].tobytes()
                out.append({"piece": i, "start": a, "length": b - a, "ids_crc32": zlib.crc32(raw)} | ({"ids": raw} if with_ids else {}))
            return out

        return lambda texts: [pa.array([one(t) for t in texts], arrow)]

    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return append_columns(read, "text", [("_pieces", T.ArrayType(piece))], make).select("doc_id", F.explode("_pieces").alias("p")).select("doc_id", "p.*")


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Best fit in the given order: positions in lengths, by bin. The bit i of `open_` says that a bin with i tokens free exists."""
    bins: list[list[int]] = []
    free: dict[int, list[int]] = defaultdict(list)
    open_ = 0
    for at, n in enumerate(lengths.tolist()):
        fits = open_ >> n
        if fits:
            room = n + ((fits & -fits).bit_length() - 1)
            k = free[room].pop()
            if not free[room]:
                open_ &= ~(1 << room)
        else:
            room, k = capacity, len(bins)
            bins.append([])
        bins[k].append(at)
        if left := room - n:
            free[left].append(k)
            open_ |= 1 << left
    return bins


def bits(mask: int) -> Iterator[int]:
    """The places of the bits of mask, lowest first."""
    while mask:
        low = mask & -mask
        yield low.bit_length() - 1
        mask ^= low


class Search:
    """Local search: donors are emptied into underfull bins, the receivers.

    A receiver offers rooms: its gap, or its gap with one of its pieces taken out. The index has the receivers by room, then by
    gap; bit masks say which there are. Entries of a bin that has changed since are dropped when they are met. Distinct sizes in
    a bin add up to its fill at most, so that a bin of 2,048 tokens has at most 63 of them and some 2,000 pairs.
    """

    def __init__(self, bins: list[list[int]], lengths: np.ndarray, capacity: int):
        self.bins, self.size, self.capacity = bins, lengths.tolist(), capacity
        self.fill = [sum(self.size[i] for i in b) for b in bins]
        self.version = [0] * len(bins)
        self.rooms: dict[int, dict[int, list[tuple[int, int, int | None]]]] = {}
        self.masks: dict[int, int] = {}
        self.open = 0
        for k in range(len(bins)):
            self.enter(k)

    def enter(self, k: int) -> None:
        """Enters a bin as a receiver, if it is neither full nor empty."""
        self.version[k] += 1
        gap = self.capacity - self.fill[k]
        if gap and self.bins[k]:
            for room, out in ({self.size[i] + gap: i for i in self.bins[k]} | {gap: None}).items():
                self.rooms.setdefault(room, {}).setdefault(gap, []).append((k, self.version[k], out))
                self.masks[room] = self.masks.get(room, 0) | 1 << gap
                self.open |= 1 << room

    def receiver(self, room: int, gaps: int = -1) -> tuple[int, int | None] | None:
        """A receiver (bin, piece that leaves it) with this room and one of these gaps."""
        for gap in bits(self.masks.get(room, 0) & gaps):
            found = self.rooms[room][gap]
            while found and self.version[found[-1][0]] != found[-1][1]:
                found.pop()
            if found:
                return found[-1][0], found[-1][2]
            self.masks[room] ^= 1 << gap
        if not self.masks.get(room):
            self.open &= ~(1 << room)
        return None

    def pairs(self, k: int) -> dict[int, tuple[int, int]]:
        """Two pieces of a bin for each sum of two."""
        by_size: dict[int, list[int]] = defaultdict(list)
        for i in self.bins[k]:
            by_size[self.size[i]].append(i)
        sizes = list(by_size)
        return {a + b: (by_size[a][0], by_size[b][a == b]) for x, a in enumerate(sizes) for b in sizes[: x + 1] if a != b or len(by_size[a]) > 1}

    def step(self, donor: int) -> bool:
        """The best step from the donor: one that fills a receiver, else the move of the largest piece that fits, else the
        exchange that leaves the smallest gap. The receiver gets fuller than the donor was, so that the squared fill grows; only
        a full donor's first step leaves it as it is."""
        own_gap = self.capacity - self.fill[donor]
        one = {self.size[i]: (i,) for i in self.bins[donor]}
        for s in sorted(one, reverse=True):
            if found := self.receiver(s):
                return self.make(donor, one[s], *found)
        two = {s: x for s, x in self.pairs(donor).items() if s <= self.capacity and s not in one}
        for s in sorted(two, reverse=True):
            if found := self.receiver(s):
                return self.make(donor, two[s], *found)
        for s in sorted(one, reverse=True):
            for waste in bits((self.open >> s) & ((1 << own_gap) - 1)):  # a room that is a gap takes a piece without giving one
                if found := self.receiver(s + waste, 1 << (s + waste)):
                    return self.make(donor, one[s], *found)
        best = None
        for s, pieces in [*one.items(), *two.items()]:
            for waste in bits((self.open >> s) & ((1 << own_gap) - 1)):
                if best and waste >= best[0]:
                    break
                if found := self.receiver(s + waste, ~((2 << waste) - 1)):  # the gap gets smaller
                    best = (waste, pieces, found)
                    break
        return self.make(donor, best[1], *best[2]) if best else False

    def make(self, donor: int, pieces: tuple[int, ...], k: int, out: int | None) -> bool:
        for a, b, moved in ((donor, k, pieces), (k, donor, () if out is None else (out,))):
            for i in moved:
                self.bins[a].remove(i)
                self.bins[b].append(i)
                self.fill[a] -= self.size[i]
                self.fill[b] += self.size[i]
        self.enter(k)
        return True

    def run(self) -> list[list[int]]:
        """Donors go by the mean size of their pieces, the smallest first, as these fit best. A donor gives until it is empty or
        has no step left; then it is a receiver again. The search ends at the least possible number of bins, or when a turn of
        all donors has emptied none."""
        least = -(-sum(self.fill) // self.capacity)
        alive = sum(1 for b in self.bins if b)
        emptied = True
        while emptied and alive > least:
            emptied = False
            for donor in sorted((k for k, b in enumerate(self.bins) if b), key=lambda k: self.fill[k] / len(self.bins[k])):
                if alive == least:
                    break
                self.version[donor] += 1  # it is no receiver
                while self.bins[donor] and self.step(donor):
                    pass
                if self.bins[donor]:
                    self.enter(donor)
                else:
                    alive, emptied = alive - 1, True
        return [b for b in self.bins if b]


def local_search(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """The bins after moves and exchanges between those that are underfull; no more than before, and no piece is left out."""
    return Search([list(b) for b in bins], lengths, capacity).run()


def pack(pieces: DataFrame, max_tokens: int = MAX_TOKENS, shard: int = SHARD) -> DataFrame:
    """pieces with sequence_id and offset. pieces has length (1 to max_tokens) and any other columns that Arrow can carry,
    but none named sequence_id, offset, _shard or _full."""
    pieces = cut(pieces.drop("ids"))
    columns = pieces.columns
    schema = T.StructType([*pieces.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("_full", T.BooleanType())])

    def packed(left: DataFrame, n: int, turn: int) -> DataFrame:
        """left in shards, each packed; _full says that a piece lies in a full sequence."""

        def place(key, pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values([c for c in ("doc_id", "piece", "length") if c in pdf], kind="stable").reset_index(drop=True)
            lengths = pdf["length"].to_numpy(np.int64)
            sequence, offset, full = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64), np.zeros(len(pdf), bool)
            for k, members in enumerate(local_search(best_fit(lengths, max_tokens), lengths, max_tokens)):
                ends = np.cumsum(lengths[members])
                sequence[members], offset[members], full[members] = (turn << 56) + (int(key[0]) << 32) + k, ends - lengths[members], ends[-1] == max_tokens
            return pdf.assign(sequence_id=sequence, offset=offset, _full=full)[[f.name for f in schema]]

        # left is a checkpoint, so that its row numbers stay the same; equal rows go to different shards
        dealt = left.select(*columns).withColumn("_shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(max(1, round(n / shard)))))
        return cut(dealt.groupBy("_shard").applyInPandas(lambda key, pdf: place(key, pdf.drop(columns="_shard")), schema))

    done, left, n, turn = [], pieces, pieces.count(), 0
    while True:
        placed = packed(left, n, turn)
        rest = placed.where("NOT _full")
        m = rest.count() if round(n / shard) > 1 else n
        if not m or 2 * m > n:  # none is left, one shard, or hardly any full sequence: another round would not help
            done.append(placed)
            break
        done.append(placed.where("_full"))
        left, n, turn = cut(rest), m, turn + 1
    return reduce(DataFrame.unionByName, done).drop("_full")


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str | None = None, max_tokens: int = MAX_TOKENS, eos: int = EOS, shard: int = SHARD, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]) for each piece of each row of docs.

    sequence_id and offset say where a piece lies; offsets in a sequence have no gap. Only the two named columns are read.
    A null or empty text is one piece, the end token; a null doc_id stays null; repeated rows are packed as often as they
    occur; ties are broken by length, doc_id and piece; no rows give no rows. With with_ids the token ids are added by a
    join on (doc_id, piece, crc), for which repeated rows give equal ids.
    """
    placed = pack(tokenized_pieces(docs, doc_id, text, vocabulary, max_tokens, eos), max_tokens, shard)
    if not with_ids:
        return placed
    key = ["doc_id", "piece", "ids_crc32"]
    ids = tokenized_pieces(docs, doc_id, text, vocabulary, max_tokens, eos, True).select(*(F.col(c).alias(f"_{c}") for c in key), "ids").dropDuplicates([f"_{c}" for c in key])
    return placed.join(ids, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]).drop(*(f"_{c}" for c in key))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
