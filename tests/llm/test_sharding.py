import hashlib
import heapq
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillmill.llm import sharding

SCHEMA = "doc_id long, text string, shard int, slot long, size long, total long, _place long"


def by_heap(texts, shards):
    """{text: shard} of a heap over all groups."""
    copies = Counter(t or "" for t in texts)
    total = {t: n * (len(t.encode()) + 1) for t, n in copies.items()}
    heap, out = [(0, j) for j in range(shards)], {}
    for t in sorted(total, key=lambda t: (-total[t], hashlib.sha256(t.encode()).hexdigest())):
        x, out[t] = heap[0]
        heapq.heapreplace(heap, (x + total[t], out[t]))
    return out


def check(spark, rows, shards):
    df = spark.createDataFrame([(i, t, 9, 9, 9, 9, 9) for i, t in rows], SCHEMA).repartition(3)
    got = sharding.assign_shards(df, shards=shards).collect()
    where = by_heap([t for _, t in rows], shards)
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), where[t or ""]) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"]) for r in got) == want
    slots = defaultdict(list)
    for r in sorted(got, key=lambda r: r["slot"]):
        slots[r["shard"]].append((r["doc_id"] is not None, r["doc_id"] or 0))
        assert r["slot"] == len(slots[r["shard"]]) - 1
    assert all(ids == sorted(ids) for ids in slots.values())


@settings(deadline=None, max_examples=150)
@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=16), st.integers(1, 10**4), st.integers(1, 500))
def test_runs_are_those_of_a_heap(loads, size, count):
    heap, order = [(x, j) for j, x in enumerate(loads)], []
    heapq.heapify(heap)
    for _ in range(count):
        x, j = heap[0]
        order.append(j)
        heapq.heapreplace(heap, (x + size, j))
    assert sharding.pops(np.array(loads), size, np.arange(count)).tolist() == order
    assert sharding.run_loads(loads, size, count) == [x for x, _ in sorted(heap, key=lambda e: e[1])]


def test_long_runs():
    """A thousand million groups of one size, beside a shard that is ahead."""
    loads = sharding.run_loads([10**9, 0, 0, 5], 7, 10**9)
    assert sum(loads) == 10**9 + 5 + 7 * 10**9 and max(loads) - min(loads) <= 7
    assert sharding.pops(np.array([10**9, 0, 0, 5]), 7, np.array([0, 1, 2, 10**9 - 1])).tolist()[:3] == [1, 2, 3]


@pytest.mark.parametrize("split", [3, 50_000])
def test_against_a_heap(spark, monkeypatch, split):
    """A text with a third of all rows, groups of equal total size, repeated rows and null ids."""
    monkeypatch.setattr(sharding, "SPLIT", split)
    rng = random.Random(split)
    rows = [(rng.choice([None, *range(60)]), f"{'ab' * rng.randrange(5)}{rng.randrange(90)}") for _ in range(400)] + [(i, "the hot text") for i in range(150)] + [(None, "the hot text")] * 50
    for shards in (1, 3, 16):
        check(spark, rows, shards)


def test_odd_and_empty_tables(spark):
    check(spark, [(1, None), (2, ""), (None, None), (None, None), (3, "é\U0001f600" * 3), (4, "x" * 3_000_000), (5, " \n"), (5, " \n"), (6, "x\x00y")], 4)
    assert sharding.assign_shards(spark.createDataFrame([], SCHEMA)).collect() == []
