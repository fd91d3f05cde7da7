"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

Items are grouped by size, sizes within a group differing by at most a fifth. For each group every text is cut into windows
of the group's size, one beginning at each sixth of that size, and each window gets a 64-bit SimHash of its word shingles.
Fingerprints are cut into four blocks of 16 bits: if two differ in at most RADIUS = 15 bits, some block differs in at most 3.
So an item is entered in each block's table under all values within 3 bits of its own, and one look-up for each block finds
every item within the radius. Candidates are then checked exactly: the weighted Jaccard similarity of the shingle multisets
of the item and of a window of the item's own size, at every offset around the candidate.

Windows can miss a match: one on the grid is up to a twelfth of its size off, and fingerprints scatter. So an index from
shingles to items also gives every text and item with so many shingles in common as a match has at least; these are checked
exactly over the whole stretch where such shingles lie, and no match is left to chance.

An item of over LONGEST shingles is cut into overlapping parts, whose windows are found so; a part's candidate has the whole item
checked at the place where it would lie.

The items are a query set of bounded size (MOST_BYTES, checked) that is broadcast; documents are never shuffled. What takes room
in a worker are the tables, with 2,788 entries for each part of an item: a worker holds those of about MOST_PARTS parts at once,
and searches for more of them one such shard after the other.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmill.llm.common import append_columns, fresh, table

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 15
BLOCKS = 4
CHUNK = 16_000  # words fingerprinted at a time: short texts together, long ones in overlapping pieces
MOST_BYTES = 64 << 20  # of items in the broadcast
MOST_PARTS = 10_000  # parts of items whose tables (110 MB) a worker holds at once
LONGEST = 5_000  # shingles of a part
MASKS = np.array([sum(1 << b for b in bits) for k in range(RADIUS // BLOCKS + 1) for bits in combinations(range(16), k)], np.uint16)


BYTES = np.random.default_rng(42).integers(0, 1 << 64, 256, np.uint64)  # a fixed random number for each byte
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
FACTOR = 0x9E3779B97F4A7C15
BUFFER = 1 << 18  # bytes hashed at a time
_powers: list[np.ndarray] = []


def powers(n: int) -> list[np.ndarray]:
    """FACTOR ** i and its inverse modulo 2 ** 64, for i below n at least."""
    if not _powers or len(_powers[0]) < n:
        with np.errstate(over="ignore"):
            _powers[:] = [np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(n, f, np.uint64)))) for f in (FACTOR, pow(FACTOR, -1, 1 << 64))]
    return _powers


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of raw, and the words' first bytes: polynomials of random numbers for the bytes, which a
    running sum gives for all words at once."""
    data = np.frombuffer(raw, np.uint8)
    inside = np.concatenate(([False], ~SPACE[data], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = powers(max(len(data), BUFFER))
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTES[data] * up[: len(data)], out=total[1:])
        return mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts


def hashed_texts(texts: list) -> Iterator[tuple[int, np.ndarray]]:
    """(position, word hashes) of each text that has words, in A-Z lower case. Short texts are hashed together, and long ones
    in slices that end at white space."""
    waiting: list[tuple[int, bytes]] = []

    def flush() -> Iterator[tuple[int, np.ndarray]]:
        h, starts = word_hashes(b"\n".join(raw for _, raw in waiting))
        bounds = np.searchsorted(starts, np.cumsum([0, *(len(raw) + 1 for _, raw in waiting)]))
        for (k, _), a, b in zip(waiting, bounds, bounds[1:], strict=False):
            if b > a:
                yield k, h[a:b]
        waiting.clear()

    size = 0
    for k, text in enumerate(texts):
        raw = text.encode("utf-8", "surrogatepass").lower() if text else b""
        if size + len(raw) > BUFFER and waiting:
            yield from flush()
            size = 0
        if len(raw) > BUFFER:
            parts, at = [], 0
            while at < len(raw):
                end = min(len(raw), at + BUFFER)
                while end < len(raw) and not SPACE[raw[end]]:
                    end += 1
                parts.append(word_hashes(raw[at:end])[0])
                at = end
            if sum(map(len, parts)):
                yield k, np.concatenate(parts)
        else:
            waiting.append((k, raw))
            size += len(raw) + 1
    yield from flush()


def mixed(h: np.ndarray) -> np.ndarray:
    """The finishing step of SplitMix64: spreads sums over all bits."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each run of `width` words, from the words' hashes."""
    n = len(hashes) - width + 1
    if n < 1:
        return hashes[:0]
    total, factor = np.zeros(n, np.uint64), np.uint64(1)
    with np.errstate(over="ignore"):
        for k in range(width):
            total += hashes[k : k + n] * factor
            factor = factor * np.uint64(0x9E3779B97F4A7C15)
    return mixed(total)


def bit_sums(h: np.ndarray) -> np.ndarray:
    """(len + 1, 64): how often each bit is set among the first hashes; h has fewer than 2 ** 15 of them."""
    bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    out = np.zeros((len(h) + 1, 16), np.uint64)  # four sums in each number, which never carry over; twice as fast
    np.cumsum(bits.astype(np.uint16).view(np.uint64), axis=0, out=out[1:])
    return out.view(np.int16)


def fingerprints(sums: np.ndarray, size: int, stride: int) -> np.ndarray:
    """The fingerprints of the windows of `size` hashes that begin at each `stride`."""
    if len(sums) <= size:
        return np.zeros(0, np.uint64)
    return np.packbits(sums[size::stride] - sums[:-size:stride] > size // 2, axis=1, bitorder="little").view("<u8").ravel()


def grid(h: np.ndarray, sums: np.ndarray | None, size: int, stride: int) -> np.ndarray:
    """The same from hashes; where these are too many for sums of all, slice by slice."""
    if sums is not None:
        return fingerprints(sums, size, stride)
    step = stride * max(1, (1 << 14) // stride)
    parts = [h[lo : lo + step + size - 1] for lo in range(0, max(0, len(h) - size + 1), step)]
    return np.concatenate([h[:0], *(fingerprints(bit_sums(x), size, stride) for x in parts)])


def fingerprint(h: np.ndarray) -> int:
    ones = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def parts_of(n: int) -> list[tuple[int, int]]:
    """(start, end) of the parts of an item of n shingles."""
    if n <= LONGEST:
        return [(0, n)]
    return [(a, a + LONGEST) for a in [*range(0, n - LONGEST, LONGEST // 2), n - LONGEST]]


class Items:
    """The benchmark's items by shingle width and size, with their block tables."""

    def __init__(self, items: list[tuple[int, str]], shingle: int, least: float):
        self.least, self.width = least, shingle
        self.items: list[tuple[int, np.ndarray, Counter]] = []  # (item_id, shingles, their counts)
        by_size: dict[tuple[int, int], list] = defaultdict(list)
        by_width: dict[int, list[int]] = defaultdict(list)
        for k, words in hashed_texts([text for _, text in items]):
            width = min(shingle, len(words))
            h = shingles(words, width)
            for a, b in parts_of(len(h)):
                by_size[width, b - a].append((len(self.items), a, h[a:b]))
            by_width[width].append(len(self.items))
            self.items.append((items[k][0], h, Counter(h.tolist())))
        self.groups: list[tuple[int, int, list, np.ndarray, list]] = []
        open_: dict[int, list] = {}
        for (width, n), found in sorted(by_size.items()):
            if width not in open_ or n > 1.2 * open_[width][0]:
                open_[width] = [n, []]
                self.groups.append((width, open_[width]))
            open_[width][1] += found
        self.groups = [self.prepare(width, found) for width, (_, found) in self.groups]
        # For each width: distinct shingles, where the items of each begin in `who`, and the items.
        self.index: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]] = {}
        for width, members in by_width.items():
            own = [np.unique(self.items[k][1]) for k in members]
            every, who = np.concatenate(own), np.repeat(np.arange(len(own)), [len(x) for x in own])
            order = np.argsort(every, kind="stable")
            keys, many = np.unique(every, return_counts=True)
            self.index[width] = keys, np.concatenate(([0], np.cumsum(many))), who[order], members

    @staticmethod
    def prepare(width: int, found: list) -> tuple:
        """(width, size, [(item, start, shingles)], fingerprints, tables) of a group of parts."""
        size = round(np.median([len(h) for *_, h in found]))
        fps = np.array([fingerprint(h) for *_, h in found], np.uint64)
        tables = []
        for b in range(BLOCKS):
            value = (fps >> np.uint64(16 * b)).astype(np.uint16)
            near = (value[:, None] ^ MASKS[None, :]).ravel()
            order = np.argsort(near, kind="stable")  # 16 bits are sorted by radix
            many = np.bincount(near, minlength=1 << 16).astype(np.int32)
            tables.append((np.cumsum(many) - many, many, (order // len(MASKS)).astype(np.int32)))
        return width, size, found, fps, tables

    def search(self, hashes: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, float, int, int]]:
        """(text, item_id, similarity, first word, number of words) of windows that match, the best for each text and item.

        hashes are those of the words of several texts, one after another; text k has the words from bounds[k] to
        bounds[k + 1]. Windows lie on one grid over them all, and texts that are shorter than a window are fingerprinted by
        themselves; the exact check looks at one text only.
        """
        out: dict[tuple[int, int], tuple[float, int, int]] = {}
        widths: dict[int, tuple] = {}
        lengths = np.diff(bounds)
        for width, size, items, fps, tables in self.groups:
            if width not in widths:
                h = shingles(hashes, width)
                widths[width] = (h, bit_sums(h) if len(h) < 1 << 15 else None)
            h, sums = widths[width]
            stride = max(1, size // 6)
            own = grid(h, sums, size, stride)
            starts = np.arange(len(own)) * stride
            least = self.least * min(len(x) for *_, x in items)
            short = np.flatnonzero((lengths - width + 1 < size) & (lengths - width + 1 >= least))
            if len(short):
                own = np.concatenate([own, np.array([fingerprint(h[bounds[k] : bounds[k + 1] - width + 1]) for k in short], np.uint64)])
                starts = np.concatenate([starts, bounds[short]])
            for at, k in self.candidates(own, fps, tables):
                number, part, ph = items[k]
                item_id, ih, counts = self.items[number]
                middle = int(starts[at]) + (size // 2 if at < len(own) - len(short) else 0)
                text = int(np.searchsorted(bounds, middle, "right")) - 1
                lo, hi = int(bounds[text]), int(bounds[text + 1]) - width + 1
                if hi > lo and (best := self.best(h[lo:hi], int(starts[at]) - part - lo, max(stride, abs(len(ph) - size)), ih, counts)):
                    if (text, item_id) not in out or best[0] > out[text, item_id][0]:
                        out[text, item_id] = (best[0], best[1], min(len(ih), hi - lo - best[1]) + width - 1)
        for width, (h, _) in widths.items():
            for text, number, first, last in self.common(h, bounds, width):
                item_id, ih, counts = self.items[number]
                lo, hi = int(bounds[text]), int(bounds[text + 1]) - width + 1
                middle = (first + last - len(ih)) // 2 - lo
                if best := self.best(h[lo:hi], middle, (last - first + len(ih)) // 2 + 1, ih, counts):
                    if (text, item_id) not in out or best[0] > out[text, item_id][0]:
                        out[text, item_id] = (best[0], best[1], min(len(ih), hi - lo - best[1]) + width - 1)
        return [(*key, *found) for key, found in sorted(out.items())]

    def common(self, h: np.ndarray, bounds: np.ndarray, width: int) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, first and last place of a shared shingle) for texts with `least` times as many places with a shingle
        of the item as the item has shingles. A window is no longer than its item, so that a match has no fewer."""
        keys, offsets, who, members = self.index[width]
        if not len(h):
            return
        at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        place = np.flatnonzero(keys[at] == h)
        text = np.searchsorted(bounds, place, "right") - 1
        inside = place <= bounds[text + 1] - width  # no shingle that runs into the next text
        place, text = place[inside], text[inside]
        at = at[place]
        n = offsets[at + 1] - offsets[at]
        rows = np.repeat(np.arange(len(place)), n)
        item = who[np.arange(len(rows)) - np.repeat(np.cumsum(n) - n - offsets[at], n)]
        code = text[rows] * len(members) + item
        order = np.argsort(code, kind="stable")
        codes, starts, many = np.unique(code[order], return_index=True, return_counts=True)
        for c, a, m in zip(codes.tolist(), starts.tolist(), many.tolist(), strict=True):
            number = members[c % len(members)]
            if m >= self.least * len(self.items[number][1]):
                yield c // len(members), number, int(place[rows[order[a]]]), int(place[rows[order[a + m - 1]]])

    @staticmethod
    def candidates(own: np.ndarray, fps: np.ndarray, tables: list) -> list[tuple[int, int]]:
        """All (window, item) within the radius."""
        found = []
        for b, (offsets, many, who) in enumerate(tables):
            value = (own >> np.uint64(16 * b)).astype(np.uint16)
            hit = np.flatnonzero(many[value])
            value = value[hit]
            n = many[value]
            rows = np.repeat(hit, n)
            k = who[np.arange(len(rows)) - np.repeat(np.cumsum(n) - n - offsets[value], n)]
            near = np.bitwise_count(own[rows] ^ fps[k]) <= RADIUS
            found.append(rows[near] * len(fps) + k[near])
        codes = np.unique(np.concatenate(found))
        return list(zip((codes // len(fps)).tolist(), (codes % len(fps)).tolist(), strict=True))

    def best(self, h: np.ndarray, start: int, stride: int, item: np.ndarray, counts: Counter) -> tuple[float, int] | None:
        """The most similar window of the item's size that begins within a stride of start, if similar enough."""
        n = len(item)
        hi = min(max(0, len(h) - n), max(0, start + stride))
        lo = max(0, min(hi, start - stride))
        window, both, size, best = dict.fromkeys(counts, 0), 0, 0, None
        found = h[lo : hi + n].tolist()
        if sum(map(counts.__contains__, found)) < self.least * n / (1 + self.least):
            return None
        for at, new in enumerate(found):  # the window slides: what both have in common changes by two shingles
            if new in window:
                window[new] += 1
                both += window[new] <= counts[new]
            size += 1
            if size > n:
                size, old = n, found[at - n]
                if old in window:
                    both -= window[old] <= counts[old]
                    window[old] -= 1
            if size == n or at == len(found) - 1:
                s = both / (size + n - both)
                if s >= self.least and (best is None or s > best[0]):
                    best = (s, lo + at + 1 - size)
        return best


def read_items(benchmark: DataFrame, item_id: str, text: str) -> list[tuple[int, str]]:
    """The items for the broadcast; more than MOST_BYTES of them raise an error."""
    size = benchmark.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    if size > MOST_BYTES:
        raise ValueError(f"the benchmark has {size} bytes; at most {MOST_BYTES} can be searched for at once: split it")
    return [(r[0], r[1]) for r in benchmark.select(item_id, text).where(F.col(text).isNotNull()).orderBy(item_id).collect()]


def search_texts(items: Items, texts: list, found: list[dict]) -> None:
    """Puts the best match of each item in each text, item_id to (similarity, first word, number of words), into found."""
    over = 2 * max((len(h) + items.width for _, h, _ in items.items), default=0)
    piece = CHUNK + over
    waiting: list[tuple[int, int, np.ndarray]] = []  # (text, first word, hashes)

    def flush() -> None:
        bounds = np.cumsum([0, *(len(h) for *_, h in waiting)])
        for k, item, s, a, n in items.search(np.concatenate([h for *_, h in waiting]), bounds) if waiting else ():
            text, first, _ = waiting[k]
            if item not in found[text] or s > found[text][item][0]:
                found[text][item] = (s, first + a, n)
        waiting.clear()

    size = 0
    for text, words in hashed_texts(texts) if items.groups else ():
        for lo in range(0, max(1, len(words) - over), CHUNK):  # pieces overlap: no window is lost
            hashes = words[lo : lo + piece]
            if size + len(hashes) > piece:
                flush()
                size = 0
            waiting.append((text, lo, hashes))
            size += len(hashes)
    flush()


MATCH = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("similarity", T.DoubleType()), T.StructField("first_word", T.LongType()), T.StructField("n_words", T.LongType())]))


def shards_of(items: list[tuple[int, str]], most: int) -> list[list[tuple[int, str]]]:
    """items in shards of about `most` parts; there are fewer parts of an item than words and one for each 2,500 at most."""
    out, size = [[]], 0
    for item in items:
        parts = 1 + len(item[1]) // LONGEST  # each shingle takes two characters at least
        if size + parts > most and out[-1]:
            out.append([])
            size = 0
        out[-1].append(item)
        size += parts
    return out


def with_matches(docs: DataFrame, benchmark: DataFrame, out: str, text: str, item_id: str, item_text: str, shingle: int, least: float, most_parts: int = MOST_PARTS) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(read_items(benchmark, item_id, item_text))
    arrow = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("first_word", pa.int64()), ("n_words", pa.int64())]))

    def make():
        shards = shards_of(shared.value, most_parts)
        kept = [Items(shards[0], shingle, least)] if len(shards) == 1 else None

        def run(texts: list) -> list[pa.Array]:
            found: list[dict] = [{} for _ in texts]
            for items in kept or (Items(x, shingle, least) for x in shards):
                search_texts(items, texts, found)
            return [pa.array([[{"item_id": i, "similarity": s, "first_word": a, "n_words": n} for i, (s, a, n) in sorted(f.items())] for f in found], arrow)]

        return run

    return append_columns(docs, text, [(out, MATCH)], make)


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", shingle: int = SHINGLE, least: float = SIMILARITY) -> DataFrame:
    """(doc_id, contaminated, item_ids, matches) for each row of docs; matches has similarity and words of the best window.

    Only the named columns are read. Null and empty texts match nothing, and nothing matches null, empty or blank items. An item with fewer than `shingle` words matches a run of the same words. Repeated rows each return a row, repeated items
    each an id; ids go by size; a null doc_id stays null. A benchmark without rows leaves all rows clean.
    """
    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = with_matches(read, benchmark, "matches", "text", item_id, item_text, shingle, least)
    return rows.select("doc_id", (F.size("matches") > 0).alias("contaminated"), F.col("matches.item_id").alias("item_ids"), "matches")


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", shingle: int = SHINGLE, least: float = SIMILARITY) -> DataFrame:
    """The rows of docs in which no item was found, with all columns of docs."""
    out = fresh(docs, "_matches")
    return with_matches(docs, benchmark, out, text, item_id, item_text, shingle, least).where(F.size(out) == 0).drop(out)


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "contaminated", "item_ids", F.transform("matches", lambda m: F.round(m["similarity"], 6)).alias("similarities"))
