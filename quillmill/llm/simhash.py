"""SimHash near-duplicates, found by vantage-point trees over Hamming distance.

1. Each text gets a 64-bit SimHash of its word shingles.
2. The distinct fingerprints are dealt to the leaves of a vantage-point tree. The tree is built from a bounded sample; a
   node keeps a vantage fingerprint and a threshold mu. A fingerprint with distance d goes left if d <= mu, else right, and
   those with mu < d <= mu + radius go left as well: by the triangle inequality, of any two fingerprints within the radius
   one such copy meets the other in some leaf, so that no link is lost.
3. A leaf tests its own pairs exactly, skips blocks that triangle bounds rule out, and returns a star for each of its
   components, never all pairs. A leaf that grew too large (a dense group) is dealt out as pairs of blocks.
4. Alternating large-star and small-star steps join the stars to components.

near_duplicates links fingerprints alone. keep_one, which removes texts, decides by the exact similarity of the shingle sets.
Its candidates are the tree's links, and texts that agree in a band of MinHashes: at similarity 0.8 fingerprints lie 10 bits
apart, give or take 3, beyond any radius at which triangle bounds prune. Only candidates' sets of shingle hashes are shuffled.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmill.llm.common import append_columns, cut, fresh, smallest, table

RADIUS = 4
SHINGLE = 4
SEED = 42
SAMPLE = 20_000  # fingerprints that shape the tree; at most these reach the driver
LEAF = 60_000  # fingerprints a leaf should hold
BLOCK = 60_000  # fingerprints of each side of a pair of blocks of an oversized leaf
DEPTH = 14  # so there are at most 2 ** DEPTH leaves
SIMILARITY = 0.8  # of near copies that keep_one removes, over sets of words' shingles
NEAR_SHINGLE = 5
BANDS, ROWS = 36, 5  # of MinHashes: 1 - (1 - 0.8 ** 5) ** 36, all but 6 in 10 million, of pairs of similarity 0.8 agree in a band
SKETCH = 256  # parts of a sketch: at similarity 0.8 its estimate has a standard error of 0.025
SLACK = 0.12  # so far below SIMILARITY an estimate still has the sets compared: nearly five standard errors
SETS = 1 << 19  # shingle hashes of a bin of candidate groups, or of each side of a pair of blocks of a larger group
_rng = np.random.default_rng(42)
FLIPS, FACTORS = _rng.integers(0, 1 << 64, BANDS * ROWS, np.uint64), _rng.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(text: str | None, shingle: int, seed: int) -> np.ndarray:
    """The XXH64 of each shingle, repeats included; a text of fewer words is one shingle, one without words has none."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    k = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[:k].tolist(), (ends[len(words) - k :] - 1).tolist(), strict=True)), np.uint64, k)


def majority(h: np.ndarray) -> int:
    """The number whose bits are set in over half of the hashes."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 15):
        counts += np.unpackbits(h[i : i + (1 << 15)].astype("<u8", copy=False).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view("<u8")[0])


def simhash(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint as an unsigned number. Null, empty and blank texts have fingerprint zero."""
    return majority(shingle_hashes(text, shingle, seed))


def sketch(distinct: np.ndarray) -> np.ndarray:
    """SKETCH bytes of a set of hashes: one byte of the least hash of each of SKETCH parts of it, 0 for an empty part. Two
    sets agree in a share of parts (without those that both lack) that estimates their Jaccard similarity."""
    least = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    part = (distinct % np.uint64(SKETCH)).astype(np.int64)
    np.minimum.at(least, part, distinct)
    out = (1 + (least >> np.uint64(16)) % np.uint64(255)).astype(np.uint8)
    out[np.bincount(part, minlength=SKETCH) == 0] = 0
    return out


def bands(distinct: np.ndarray) -> np.ndarray:
    """A key for each band of MinHashes of a set of hashes; none for an empty set."""
    if not len(distinct):
        return np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        least = np.stack([((distinct[i : i + 4096, None] ^ FLIPS) * FACTORS).min(axis=0) for i in range(0, len(distinct), 4096)]).min(axis=0)
        key = (least.reshape(BANDS, ROWS) * FACTORS[:ROWS]).sum(axis=1) + np.arange(BANDS, dtype=np.uint64)
        key = (key ^ (key >> np.uint64(31))) * FACTORS[ROWS]
        return (key ^ (key >> np.uint64(29))).view(np.int64)


def agreement(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The estimated similarity of a sketch to each of many; two without any shingle are equal."""
    held = ((many != 0) | (one != 0)).sum(axis=1)
    return np.where(held > 0, ((many == one) & (one != 0)).sum(axis=1) / np.maximum(held, 1), 1.0)


def with_fingerprint(df: DataFrame, text: str, out: str, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """df and a long column with the bits of each fingerprint."""

    def make():
        return lambda texts: [pa.array(np.array([simhash(t, shingle, seed) for t in texts], np.uint64).view(np.int64))]

    return append_columns(df, text, [(out, T.LongType())], make)


# The tree: a list of (vantage, mu, left, right); a negative child -k - 1 is leaf k.
def build_tree(sample: np.ndarray, n: int, radius: int, leaf: int) -> list[tuple[int, int, int, int]]:
    nodes: list = []
    leaves = 0
    rng = np.random.default_rng(7)

    def grow(part: np.ndarray, depth: int) -> int:
        nonlocal leaves
        if depth < DEPTH and len(part) * n > leaf * len(sample) and len(part) >= 16:
            best = None
            for v in rng.choice(part, min(8, len(part)), replace=False):
                d = np.bitwise_count(part ^ v)
                mu = int(np.median(d))
                cost = np.count_nonzero(d <= mu + radius) ** 2 + np.count_nonzero(d > mu) ** 2
                if best is None or cost < best[0]:
                    best = (cost, v, mu, d)
            cost, v, mu, d = best
            if cost < 0.98 * len(part) ** 2:
                at = len(nodes)
                nodes.append(None)
                left = grow(part[d <= mu + radius], depth + 1)
                nodes[at] = (int(v), mu, left, grow(part[d > mu], depth + 1))
                return at
        leaves += 1
        return -leaves

    grow(sample, 0)
    return nodes


def route(tree: list, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(leaf, position in fps) of each copy."""
    todo, out = [(0 if tree else -1, np.arange(len(fps)))], []
    while todo:
        node, at = todo.pop()
        if not len(at):
            continue
        if node < 0:
            out.append((np.full(len(at), -node - 1, np.int32), at))
            continue
        v, mu, left, right = tree[node]
        d = np.bitwise_count(fps[at] ^ np.uint64(v))
        todo += [(left, at[d <= mu + radius]), (right, at[d > mu])]
    return (np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])) if out else (np.zeros(0, np.int32), np.zeros(0, np.int64))


def linked(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars (member, root) that join whatever is within the radius: in a if b is None, else between a and b."""
    fps = np.unique(a if b is None else np.concatenate([a, b]))
    if len(fps) < 2:
        return fps[:0], fps[:0]
    side = None if b is None else (np.isin(fps, a), np.isin(fps, b))
    # Two local vantage points: fingerprints sorted by distance to the first, in blocks sorted by distance to the second.
    d0 = np.bitwise_count(fps ^ fps[0]).astype(np.int16)
    d1 = np.bitwise_count(fps ^ fps[int(np.argmax(np.abs(d0 - 32) * -1))]).astype(np.int16)
    order = np.lexsort((d1, d0))
    fps, d0, d1 = fps[order], d0[order], d1[order]
    if side is not None:
        side = (side[0][order], side[1][order])
    parent = np.arange(len(fps))
    near = np.zeros(len(fps), bool)

    def candidates(lo: int, hi: int) -> np.ndarray:
        x, y = np.searchsorted(d0, [d0[lo] - radius, d0[hi - 1] + radius + 1])
        e = d1[lo:hi]
        at = np.flatnonzero((d1[x:y] >= e.min() - radius) & (d1[x:y] <= e.max() + radius)) + x
        return at

    for lo in range(0, len(fps), 64):  # which fingerprints have any neighbour
        hi = min(lo + 64, len(fps))
        at = candidates(lo, hi)
        at = at[at >= lo]
        hit = np.bitwise_count(fps[lo:hi, None] ^ fps[None, at]) <= radius
        hit[np.arange(lo, hi) - lo, np.searchsorted(at, np.arange(lo, hi))] = False
        near[lo:hi] |= hit.any(axis=1)
        near[at[hit.any(axis=0)]] = True
    left = np.flatnonzero(near)
    while len(left):  # breadth first; what has been reached is not tested again
        root, left = left[0], left[1:]
        front = np.array([root])
        while len(front) and len(left):
            part, front = front[:64], front[64:]
            hit = np.bitwise_count(fps[part, None] ^ fps[None, left]) <= radius
            if side is not None:
                hit &= (side[0][part, None] & side[1][None, left]) | (side[1][part, None] & side[0][None, left])
            got = hit.any(axis=0)
            parent[left[got]] = root
            front = np.concatenate([front, left[got]])
            left = left[~got]
    moved = parent != np.arange(len(fps))
    return fps[moved], fps[parent[moved]]


def near_links(distinct: DataFrame, fp: str = "fp", radius: int = RADIUS, leaf: int = LEAF, block: int = BLOCK) -> DataFrame:
    """Links (a, b) whose connected components are those of all pairs of distinct fingerprints within the radius."""
    n = distinct.count()
    sample = [r[0] for r in smallest(distinct.select(fp), SAMPLE, fp).collect()]
    tree = build_tree(np.array(sample, np.int64).view(np.uint64), n, radius, leaf)

    def deal(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            k, at = route(tree, fps, radius)
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(fps[at].view(np.int64))], names=["leaf", "fp"])

    dealt = cut(distinct.select(fp).mapInArrow(deal, "leaf int, fp long"))  # dealt once: for the leaves' sizes and for the search
    sizes = {r["leaf"]: r["count"] for r in dealt.groupBy("leaf").count().collect()}  # at most 2 ** DEPTH rows
    parts = {k: math.ceil(m / block) for k, m in sizes.items() if m > 2 * block}

    def spread(batches):
        for batch in batches:
            k, fps = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            hot = np.isin(k, list(parts)) if parts else np.zeros(len(k), bool)
            out = [(k[~hot], np.zeros((~hot).sum(), np.int32), np.zeros((~hot).sum(), np.int32), fps[~hot], np.zeros((~hot).sum(), np.int8))]
            for x in np.unique(k[hot]):
                b, own = parts[int(x)], fps[hot & (k == x)]
                mine = ((own.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % b
                for j in range(b):
                    out.append((np.full(len(own), x, np.int32), np.minimum(mine, j).astype(np.int32), np.maximum(mine, j).astype(np.int32), own, (mine > j).astype(np.int8)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[i] for o in out]), t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int8()))], names=["leaf", "i", "j", "fp", "side"])

    def star(key, pdf: pd.DataFrame) -> pd.DataFrame:
        fps, side = pdf["fp"].to_numpy(np.int64).view(np.uint64), pdf["side"].to_numpy()
        a, b = linked(fps, None, radius) if key[1] == key[2] else linked(fps[side == 0], fps[side == 1], radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return dealt.mapInArrow(spread, "leaf int, i int, j int, fp long, side byte").groupBy("leaf", "i", "j").applyInPandas(star, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of links (a, b), root the smallest node of its component; nodes that are roots are not
    returned. Alternates large-star and small-star steps, each a grouped minimum and a join on the node, until a step
    changes nothing. A large-star step keeps its minima in a checkpoint: so its join has two sides that are dealt for it alone,
    and Spark can split the rows of a hub."""

    def larger(e: DataFrame) -> DataFrame:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        return both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()

    def smaller(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        return down.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct()

    mark = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    e = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    was = mark(e)
    while was[0]:
        e = cut(smaller(larger(e)))
        now = mark(e)
        if now == was:
            break
        was = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))


def grouped(docs: DataFrame, doc_id: str, text: str, shingle: int, radius: int, seed: int, leaf: int, block: int) -> DataFrame:
    """(doc_id, text_hash, fp, component_id) for each row of docs."""
    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("text_hash"))
    signed = cut(with_fingerprint(read, "text", "fp", shingle, seed).drop("text"))
    distinct = cut(signed.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(near_links(distinct, "fp", radius, leaf, block))
    rooted = cut(distinct.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    by_root = cut(rooted.groupBy("root").agg(F.min("least").alias("component_id")))  # so that a large component is split in the join
    known = rooted.join(by_root, "root").select("fp", "root", "component_id")
    return signed.join(known, "fp")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED, leaf: int = LEAF, block: int = BLOCK) -> DataFrame:
    """A row (doc_id, fingerprint, component_id) for each row of docs.

    Only the two named columns are read, so other columns of docs can have any name. Null, empty and blank texts have
    fingerprint zero and are linked like others. Repeated rows each return a row. component_id is the smallest doc_id that
    links reach; a null doc_id is never the smallest, so that a group of nulls only has component_id null.
    """
    return grouped(docs, doc_id, text, shingle, radius, seed, leaf, block).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def stars(df: DataFrame, key: str, node: str) -> DataFrame:
    """Links (a, b) of each node to the smallest node with its key. The right side is a checkpoint, so that hot keys are split."""
    least = cut(df.groupBy(key).agg(F.min(node).alias("b"), F.max(node).alias("most")).where("b < most").select(key, "b"))
    return df.join(least, key).where(F.col(node) != F.col("b")).select(F.col(node).alias("a"), "b")


def candidate_links(distinct: DataFrame, radius: int, leaf: int, block: int) -> DataFrame:
    """Links (a, b) between the nodes of distinct (node, fp, bands): fingerprints within the radius, from the vantage-point
    tree, and equal bands. Texts that share a band are linked to the smallest of them, never in pairs."""
    fps = cut(distinct.groupBy("fp").agg(F.min("node").alias("node")))
    end = lambda x: fps.select(F.col("fp").alias(x), F.col("node").alias(f"{x}_node"))
    tree = near_links(fps, "fp", radius, leaf, block).join(end("a"), "a").join(end("b"), "b").select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
    return tree.unionByName(stars(distinct, "fp", "node")).unionByName(stars(distinct.select("node", F.explode("bands").alias("key")), "key", "node"))


def alike(sizes: np.ndarray, sketches: np.ndarray, sets: list[np.ndarray], side: np.ndarray | None, least: float, accept: float) -> tuple[np.ndarray, np.ndarray]:
    """Stars (member, root), as positions, that join whatever has an exact similarity of `least` or more, between two sides if
    sides are given. Rows come sorted by size; sets are sorted and distinct. Sketches that agree to less than `accept` spare
    the exact comparison."""
    left, parent = np.arange(len(sizes)), np.arange(len(sizes))
    while len(left):  # breadth first; what has been reached is not tested again
        root, left = left[0], left[1:]
        front = [root]
        while front and len(left):
            p = front.pop()
            a, b = np.searchsorted(sizes[left], [sizes[p] * least, sizes[p] / least + 1e-9])
            at = np.arange(a, b)
            if side is not None:
                at = at[side[left[at]] != side[p]]
            at = at[agreement(sketches[p], sketches[left[at]]) >= accept]
            if len(at) and sizes[p]:  # rows without shingles have candidates without shingles only, and are equal
                many = sizes[left[at]]
                all_ = np.concatenate([sets[q] for q in left[at]])
                own = sets[p]
                hit = own[np.minimum(np.searchsorted(own, all_), len(own) - 1)] == all_
                both = np.add.reduceat(hit.astype(np.int64), np.cumsum(many) - many)
                at = at[both >= least * (many + sizes[p] - both)]
            parent[left[at]] = root
            front += left[at].tolist()
            left = np.delete(left, at)
    moved = np.flatnonzero(parent != np.arange(len(sizes)))
    return moved, parent[moved]


def shared(one: np.ndarray, other: np.ndarray) -> int:
    """How many hashes two sorted sets have in common."""
    if not len(one) or not len(other):
        return 0
    return int((other[np.minimum(np.searchsorted(other, one), len(other) - 1)] == one).sum())


def exact_links(docs: DataFrame, distinct: DataFrame, groups: DataFrame, shingle: int, seed: int, least: float, most: int = SETS) -> DataFrame:
    """Links (a, b) whose connected components are those of all pairs within a group that have an exact similarity of `least`
    or more. docs is (doc_id, text, h1, h2), groups are the candidates' components (node, root).

    The sets of shingle hashes are made for the candidates only, each from the copies of its text with the least doc_id; texts
    meet the candidates in one shuffle. Small groups share bins of about `most` hashes. Of a larger group each member is first
    compared with its root alone, which links most members of a dense group; what is left over then meets itself and the linked
    ones, in pairs of blocks of about `most` hashes. Two members that are both linked to the root need no comparison.
    """
    inside = groups.union(groups.select(F.col("root").alias("node"), "root").distinct())
    members = cut(distinct.join(inside, "node").select("node", "h1", "h2", "root", "least", "size", "sketch"))
    sizes = cut(members.groupBy("root").agg(F.sum("size").alias("n")))
    bins = max(1, math.ceil((sizes.where(F.col("n") <= most).agg(F.sum("n")).first()[0] or 0) / most))

    def make():
        return lambda values: [pa.array([np.unique(shingle_hashes(t, shingle, seed)).astype("<u8").tobytes() for t in values], pa.binary())]

    texts = docs.withColumnRenamed("doc_id", "_id").join(members.select("node", "h1", "h2", "least"), ["h1", "h2"]).where(F.col("_id").eqNullSafe(F.col("least"))).select("node", "text")
    sets = append_columns(texts, "text", [("hashes", T.BinaryType())], make).groupBy("node").agg(F.first("hashes").alias("hashes"))
    whole = members.join(sets, "node").join(sizes, "root").select("node", "root", "size", "sketch", "hashes", "n")
    some_hot = sizes.where(F.col("n") > most).limit(1).count() > 0
    whole = cut(whole) if some_hot else whole
    cells = whole.where(F.col("n") <= most).select(F.lit("bin").alias("kind"), F.pmod(F.xxhash64("root"), F.lit(bins)).alias("bin"), F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(False).alias("side"), "root", "node", "size", "sketch", "hashes")
    if not some_hot:
        return cells.groupBy("kind", "bin", "i", "j").applyInPandas(star_of(least), "a long, b long")

    def near_head():
        def run(pairs: list) -> list[pa.Array]:
            out = []
            for x in pairs:
                one, head = np.frombuffer(x["hashes"], "<u8"), np.frombuffer(x["head"], "<u8")
                both = shared(one, head)
                out.append(both >= least * (len(one) + len(head) - both))
            return [pa.array(out, pa.bool_())]

        return run

    large = whole.where(F.col("n") > most).drop("n")
    heads = cut(large.where("node = root").select("root", F.col("hashes").alias("head")))
    paired = large.join(heads, "root").select("node", "root", "size", "sketch", F.struct("hashes", "head").alias("pair"))
    judged = cut(append_columns(paired, "pair", [("near", T.BooleanType())], near_head).select("node", "root", "size", "sketch", "pair.hashes", "near"))
    count = lambda c: F.ceil(F.coalesce(F.sum(F.when(c, F.col("size"))), F.lit(0)) / most).cast("int")
    parts = cut(judged.groupBy("root").agg(count(F.col("near")).alias("linked"), count(~F.col("near")).alias("left")).where(F.col("left") > 0))
    dealt = judged.join(parts, "root")
    mine = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["root", "node", "size", "sketch", "hashes"]
    rest = dealt.where(~F.col("near")).withColumn("mine", mine("left"))
    among = rest.withColumn("other", each("left")).select(F.lit("left").alias("kind"), F.col("root").alias("bin"), F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), (F.col("mine") > F.col("other")).alias("side"), *columns)
    out = rest.withColumn("other", each("linked")).select(F.lit("both").alias("kind"), F.col("root").alias("bin"), F.col("mine").alias("i"), F.col("other").alias("j"), F.lit(False).alias("side"), *columns)
    back = dealt.where("near").withColumn("mine", mine("linked")).withColumn("other", each("left")).select(F.lit("both").alias("kind"), F.col("root").alias("bin"), F.col("other").alias("i"), F.col("mine").alias("j"), F.lit(True).alias("side"), *columns)
    found = cells.unionByName(among).unionByName(out).unionByName(back).groupBy("kind", "bin", "i", "j").applyInPandas(star_of(least), "a long, b long")
    return found.unionByName(judged.where("near AND node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))


def star_of(least: float):
    """For a cell (kind, bin, i, j): stars within each of its groups, between its two sides where it has two."""

    def star(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["root", "size", "node"], kind="stable")
        root, node, size, side = (pdf[c].to_numpy() for c in ("root", "node", "size", "side"))
        two = key[0] == "both" or key[2] != key[3]
        sketches = np.frombuffer(b"".join(pdf["sketch"]), np.uint8).reshape(-1, SKETCH)
        hashes = [np.frombuffer(x, "<u8") for x in pdf["hashes"]]
        edges = np.flatnonzero(np.concatenate(([True], root[1:] != root[:-1], [True])))
        out = [(node[:0], node[:0])]
        for lo, hi in zip(edges, edges[1:], strict=False):
            a, b = alike(size[lo:hi], sketches[lo:hi], hashes[lo:hi], side[lo:hi].astype(bool) if two else None, least, least - SLACK)
            out.append((node[lo + a], node[lo + b]))
        return pd.DataFrame({"a": np.concatenate([a for a, _ in out]), "b": np.concatenate([b for _, b in out])})

    return star


def with_signature(df: DataFrame, text: str, shingle: int, seed: int) -> DataFrame:
    """df and the columns fp, size, sketch and bands of the set of distinct shingles."""

    def make():
        def one(value: str | None) -> tuple[int, int, bytes, np.ndarray]:
            distinct = np.unique(shingle_hashes(value, shingle, seed))
            return majority(distinct), len(distinct), sketch(distinct).tobytes(), bands(distinct)

        def run(texts: list) -> list[pa.Array]:
            rows = [one(t) for t in texts]
            return [pa.array(np.array([r[0] for r in rows], np.uint64).view(np.int64)), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary()), pa.array([r[3] for r in rows], pa.list_(pa.int64()))]

        return run

    return append_columns(df, text, [("fp", T.LongType()), ("size", T.LongType()), ("sketch", T.BinaryType()), ("bands", T.ArrayType(T.LongType()))], make)


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = NEAR_SHINGLE, radius: int = RADIUS, least: float = SIMILARITY, seed: int = SEED, leaf: int = LEAF, block: int = BLOCK, most: int = SETS) -> DataFrame:
    """docs with one row of each group of near duplicates: that with the smallest doc_id, and of several texts with that
    doc_id the one with the smallest hash.

    Near duplicates have a similarity of `least` or more over their sets of shingles, computed from the sets. Pairs are
    compared if candidate links join them. Null, empty and blank texts are one group. A group whose doc_ids are all null keeps
    one row as well. Of rows with equal doc_id and text one is kept: where other columns differ, that with the smallest hash of
    these as JSON. No rows give no rows.
    """
    k, h1, h2, row = (fresh(docs, x) for x in ("_kept", "_h1", "_h2", "_row"))
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (doc_id, text)]
    # A text is known by two hashes, 128 bits.
    own = docs.withColumns({h1: F.xxhash64(F.col(text)), h2: F.xxhash64(F.lit(1), F.col(text))})
    tie = F.xxhash64(F.to_json(F.struct(*others))) if others else F.lit(0)
    read = own.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(h1).alias("h1"), F.col(h2).alias("h2"), tie.alias("tie"))
    # One row for each text: a text of many copies is hashed by many tasks, and its signature aggregated before the shuffle.
    signed = with_signature(read, "text", shingle, seed).drop("text")
    place = lambda d, t: F.struct(d.isNull().alias("z"), d.alias("doc_id"), t.alias("tie"))
    by_text = signed.groupBy("h1", "h2").agg(F.min(place(F.col("doc_id"), F.col("tie"))).alias("first"), F.count("*").alias("n"), *(F.first(c).alias(c) for c in ("fp", "size", "sketch", "bands")))
    distinct = cut(by_text.select(F.monotonically_increasing_id().alias("node"), "h1", "h2", F.col("first.doc_id").alias("least"), "first", "n", "fp", "size", "sketch", "bands"))
    candidates = components(candidate_links(distinct, radius, leaf, block))
    roots = components(exact_links(read.drop("tie"), distinct, candidates, shingle, seed, least, most))
    rooted = distinct.select("node", "h1", "h2", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    kept = rooted.groupBy("root").agg(F.min(F.struct(F.col("least").isNull().alias("z"), "least", "h1", "h2", "node")).alias("kept")).select("kept.node", F.lit(True).alias("stays"))
    # A verdict for each text that goes or has several rows; any other row stays.
    verdict = cut(distinct.select("node", "h1", "h2", "first", "n").join(kept, "node", "left").where("stays IS NULL OR n > 1").select(F.col("h1").alias(h1), F.col("h2").alias(h2), F.col("first").alias(k), "stays"))
    single = own.join(verdict.select(h1, h2), [h1, h2], "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
    # Of several rows that stays which is not above the minimum, known beforehand. As no equality it stays out of the join's key, so
    # that both joins read one shuffle of docs. Rows that are wholly alike become one by an aggregation with a key of its own: so
    # Spark can split a hot text in the join, and pre-aggregates it.
    several = own.join(verdict.where("stays").select(h1, h2, k), [h1, h2]).where(place(F.col(doc_id), tie) <= F.col(k))
    one = several.groupBy(F.array(h1, h2).alias(k)).agg(F.first(F.struct(*(F.col(f"`{c}`") for c in docs.columns))).alias(row))
    return single.unionByName(one.select(*(F.col(f"{row}.`{c}`") for c in docs.columns)))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
