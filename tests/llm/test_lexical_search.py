import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillmill.llm import lexical_search

DOCS = "doc_id long, text string, item_id long, term string, n int, shard int, rank int, score string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, best=20):
    """{item: [(score, doc_id), ...]} by a look at every document for every item."""
    read = [(i, Counter(words(t)), len(words(t))) for i, t in docs if words(t)]
    total, tokens = len(read), sum(n for _, _, n in read)
    df = Counter(w for _, c, _ in read for w in c)
    out = []
    for item, text in items:
        scored = []
        for i, counts, n in read:
            m, score = 100 - 25 + (25 * n * total) // tokens, 0
            for w in words(text):
                if w in counts:
                    score += math.floor(1000 * math.log((2 * total + 2) / (2 * df[w] + 1))) * ((10**9 * counts[w]) // (1000 * counts[w] + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, rank, None if none else i, -score) for rank, (score, none, i) in enumerate(sorted(scored)[:best], 1)]
    return sorted(out, key=repr)


def check(spark, docs, items, **options):
    df = spark.createDataFrame([(i, t, 1, "x", 1, 1, 1, "x") for i, t in docs], DOCS).repartition(3)
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    got = lexical_search.search_documents(df, asked, **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs, items, options.get("best", 20))


@settings(deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**62))))
def test_bytes_round_trip(values):
    data, starts = lexical_search.packed(np.array(values, np.int64))
    assert (lexical_search.unpacked(data).tolist() if values else []) == values and [lexical_search.unpacked(data[s:])[0] for s in starts] == values


@settings(deadline=None, max_examples=300)
@given(st.lists(st.dictionaries(st.integers(0, 60), st.integers(0, 9), min_size=1), max_size=8), st.integers(1, 6))
def test_merge_against_all_sums(lists, best):
    sums = Counter()
    for one in lists:
        sums.update(one)
    want = sorted((-s, d) for d, s in sums.items() if s > 0)[:best]
    given_ = [(sorted(one), [one[d] for d in sorted(one)], max(one.values())) for one in lists]
    assert sorted((-s, d) for s, d in lexical_search.merge(given_, best)) == want


@pytest.mark.parametrize("options", [{}, {"postings": 40, "block": 6_000, "best": 5}, {"postings": 1}])
def test_against_all_documents(spark, options):
    """Zipf-like words, many ties and repeated texts; shards of a few documents, blocks of a few items."""
    rng = random.Random(5)
    word = lambda: f"W{int(rng.paretovariate(0.7)) % 200}"
    docs = [(i, " ".join(word() for _ in range(rng.randrange(1, 40)))) for i in rng.sample(range(1000), 250)]
    docs += [(2000 + i, docs[i % 7][1].lower()) for i in range(40)]
    items = [(k, "-".join(word() for _ in range(rng.randrange(1, 12)))) for k in range(30)] + [(3, "w1 w1 w1 w2"), (None, "w2 w7")]
    check(spark, docs, items, **options)


def test_odd_and_empty_tables(spark):
    docs = [(1, None), (2, ""), (3, " \n-.!"), (None, "a B c"), (None, "a b c"), (4, "A b C"), (4, "a b c"), (5, "é É ß 　x\U0001f600 a"), (6, "a " * 200_000 + "b"), (7, "x" * 2_000_000), (8, "a\x00b\x7fc")]
    items = [(1, "a"), (2, None), (3, ""), (4, "nowhere"), (5, "É x b b"), (6, "x" * 2_000_000), (1, "c"), (7, "　x\U0001f600")]
    check(spark, docs, items)
    check(spark, docs, items, block=200, postings=2)
    check(spark, [], items)
    check(spark, docs[:3], items)
    check(spark, docs, [])
