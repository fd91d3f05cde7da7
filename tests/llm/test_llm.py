import base64
import hashlib
import math
import os
import re
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql.functions import count_distinct, spark_partition_id, xxhash64
from pyspark.sql.functions import max as spark_max
from pyspark.sql.functions import sum as spark_sum
from tokenizers import Tokenizer

from compare import same
from quillmill.llm import decontamination, language_model, licenses, packing, pipeline, quality_classifier, quality_rules, queries, secrets, simhash, substrings, warc
from quillmill.llm.common import smallest
from quillmill.llm.weak import fit_votes

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id long, n_words long, path string"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
ODD = [(1, None), (None, "a b c"), (2, ""), (3, " \n\t "), (4, LONG), (5, "same text here. " * 3), (5, "same text here. " * 3), (6, "same text here. " * 3), (None, None)]


def odd(spark, rows=ODD):
    """Nulls, empty and long texts, repeated rows, and extra columns whose names clash with results."""
    return spark.createDataFrame([(d, t, None, None, None, 7, 7, None) for d, t in rows], SCHEMA)


def documents(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    same(spark, queries.QUERIES[name], queries.ORACLE_SQL[name], SF)


OPERATORS = [packing.pack_documents, quality_rules.quality_rules, secrets.scan_secrets, substrings.remove_repeats, quality_classifier.classify, simhash.near_duplicates, licenses.scan_licenses, language_model.score_documents]


@pytest.mark.parametrize("operator", OPERATORS, ids=lambda f: f.__name__)
def test_odd_and_empty_tables(spark, operator):
    kept = operator(odd(spark)).collect()
    assert len(kept) == len(ODD) + (sum(r["piece"] > 0 for r in kept) if "piece" in kept[0] else 0)
    assert operator(odd(spark).limit(0)).collect() == []


def test_odd_tables_in_stages(spark):
    items = spark.createDataFrame([(1, "same text here. same text here. same"), (2, None), (3, ""), (4, "c")], "item_id long, text string")
    for df in (odd(spark), odd(spark).limit(0)):
        for stage in (quality_rules.keep_good, simhash.keep_one, secrets.redact_secrets, lambda d: decontamination.keep_clean(d, items)):
            assert stage(df).columns == df.columns
            stage(df).collect()
    found = {(r["doc_id"], r["contaminated"], tuple(r["item_ids"])) for r in decontamination.decontaminate(odd(spark), items).collect()}
    assert (5, True, (1,)) in found and (None, True, (4,)) in found and (4, False, ()) in found
    assert decontamination.decontaminate(odd(spark), items.limit(0)).where("contaminated").count() == 0
    assert sorted(str(r["doc_id"]) for r in simhash.keep_one(odd(spark)).collect()) == ["1", "4", "5", "None"]


def test_op1(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    rows = queries.QUERIES["op1_best_fit_packing"](spark, SF).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for doc_id, text in documents(spark):
        ids, at = [*tokenizer.encode(text, add_special_tokens=False).ids, 0], 0
        pieces = sorted(by_doc[doc_id], key=lambda r: r["piece"])
        for k, r in enumerate(pieces):
            assert (r["piece"], r["start"]) == (k, at) and (k == 0 or r["length"] == 2048)
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[at : at + r["length"]], "<u4").tobytes())
            at += r["length"]
        assert at == len(ids) and (len(pieces) == 1) == (len(ids) <= 2048)
    for members in by_sequence.values():
        at = 0
        for r in sorted(members, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    assert len(by_sequence) <= math.ceil(sum(r["length"] for r in rows) / 2048) + 1


@pytest.mark.parametrize("text", [" " * 2_000_000, "a" + "\n" * 500_000 + "b", "a b" + " \t" * 900 + " word" + "\u3000" * 1500 + "1" + " " * 999 + "x", "\n" * 4000 + " it's", "x" + " " * 1200])
def test_long_blanks(text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert packing.encoder(public_tokenizers.path(packing.VOCABULARY))(text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_pieces_with_ids(spark):
    got = packing.pack_documents(odd(spark), with_ids=True).collect()
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in got)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_local_search(lengths):
    lengths = np.array(lengths, np.int64)
    first = packing.best_fit(lengths, 64)
    n = len(first)
    bins = packing.local_search(first, lengths, 64)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths))) and all(lengths[b].sum() <= 64 for b in bins) and len(bins) <= n
    squares = lambda bins: sum(int(lengths[b].sum()) ** 2 for b in bins)
    assert squares(bins) >= squares(first) and packing.local_search([], lengths, 64) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 32), min_size=1, max_size=4), min_size=2, max_size=12))
def test_no_move_or_exchange_is_left(groups):
    """Brute force: when the search ends above the bound, no move or exchange from the bin it tried last grows the squared fill."""
    groups = [g for g in groups if sum(g) <= 64] or [[1]]
    lengths, at, bins = np.array([n for g in groups for n in g]), 0, []
    for g in groups:
        bins.append(list(range(at, at + len(g))))
        at += len(g)
    got = packing.local_search(bins, lengths, 64)
    fills = [int(lengths[b].sum()) for b in got]
    if len(got) == -(-int(lengths.sum()) // 64):
        return
    for d, donor in enumerate(got):
        for k, other in enumerate(got):
            if d != k and fills[k] < 64 and fills[d] < 64:
                whole = [i for i in donor if lengths[i] <= 64 - fills[k]]
                assert not (whole and fills[d] == lengths[donor[0]]), "a bin of one piece would fit"


def test_local_search_swaps():
    for bins, lengths in (([[0], [1], [2, 3]], [5, 5, 6, 4]), ([[0, 1], [2], [3, 4]], [6, 3, 7, 2, 2]), ([[0, 1, 2], [3, 4], [5]], [5, 2, 2, 5, 3, 3])):
        got = packing.local_search(bins, np.array(lengths), 10)
        assert len(got) == 2 and sorted(i for b in got for i in b) == list(range(len(lengths)))


def test_local_search_starts_above_and_ends_at_the_bound(spark):
    rng = np.random.default_rng(8)
    lengths = np.minimum(2048, rng.lognormal(5.5, 1, 20_000).astype(np.int64) + 1)
    first, bound = packing.best_fit(lengths, 2048), -(-int(lengths.sum()) // 2048)
    assert len(first) > bound == len(packing.local_search(first, lengths, 2048))
    pieces = spark.createDataFrame([(i, 0, n) for i, n in enumerate(lengths.tolist())], "doc_id long, piece int, length long")
    for shard in (30_000, 1000):  # many shards: their underfull sequences are packed together
        placed = packing.pack(pieces, shard=shard)
        fills = [r["f"] for r in placed.groupBy("sequence_id").agg(spark_sum("length").alias("f"), count_distinct("offset"), spark_max(placed["offset"] + placed["length"]).alias("end")).where("f = end").collect()]
        assert placed.count() == len(lengths) and sum(fills) == lengths.sum() and bound <= len(fills) <= bound + 1, (shard, len(fills), bound)


def brute_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_op2(spark):
    got = {r["doc_id"]: r for r in queries.QUERIES["op2_quality_rules"](spark, SF).collect()}
    for doc_id, text in documents(spark):
        r, b = got[doc_id], brute_measures(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == b
        assert r["base_failed"] == (b[0] < 50 or 100 * b[4] > 50 * b[0]) and not (r["base_failed"] and r["kept"])
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    judged = [(labels[r["doc_id"]], r["kept"]) for r in queries.QUERIES["op2_quality_rules"](spark, "/root/testdata/sf0.01").collect() if r["doc_id"] in labels and not r["base_failed"]]
    assert np.mean([k for q, k in judged if q]) > 0.98 and np.mean([not k for q, k in judged if not q]) > 0.9


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab \n\t#| é.", max_size=60))
def test_measures(text):
    assert quality_rules.measures(text)[:5] == brute_measures(text)


def test_votes():
    rng = np.random.default_rng(0)
    good = rng.random(5000) < 0.8
    votes = [tuple(int(np.where(rng.random() < a, 1, -1)) if g else int(np.where(rng.random() < b, -1, 1)) for a, b in ((0.99, 0.7), (0.95, 0.6), (0.97, 0.8), (0.99, 0.5))) for g in good]
    model = fit_votes(Counter(votes), list("abcd"), strength=0.001)  # hardly any prior
    assert abs(model.prior - 0.8) < 0.06 and abs(model.bad[2] - 0.8) < 0.12 and abs(model.good[1] - 0.95) < 0.04
    assert fit_votes({}, list("ab")).prior == 0.8


def brute_em(rows, prior, detection, accuracy=0.99, strength=0.05):
    """Posteriors of rows of votes, row by row: what weak.fit_votes computes from counts of patterns."""
    k, pi, extra = len(rows[0]), prior, max(1.0, strength * len(rows))
    good, bad = [accuracy] * k, [detection] * k

    def posterior(votes):
        up, down = pi, 1 - pi
        for v, g, b in zip(votes, good, bad, strict=True):
            up, down = (up * g, down * (1 - b)) if v == 1 else (up * (1 - g), down * b) if v == -1 else (up, down)
        return up / (up + down)

    for _ in range(100):
        p = [posterior(r) for r in rows]
        was = [*good, *bad, pi]
        for j in range(k):
            said = [(x, r[j]) for x, r in zip(p, rows, strict=True) if r[j]]
            good[j] = min(0.9999, max(0.5, (sum(x for x, v in said if v == 1) + accuracy * extra) / (sum(x for x, _ in said) + extra)))
            bad[j] = min(0.99, max(0.01, (sum(1 - x for x, v in said if v == -1) + detection * extra) / (sum(1 - x for x, _ in said) + extra)))
        pi = min(1 - 1e-3, max(1e-3, (sum(p) + prior * extra) / (len(rows) + extra)))
        if max(abs(a - b) for a, b in zip(was, [*good, *bad, pi], strict=True)) < 1e-7:
            break
    return [posterior(r) for r in rows]


def test_op2_verdicts(spark):
    rows = quality_rules.quality_rules(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    names = list(rows[0]["votes"])
    want = brute_em([[r["votes"][n] for n in names] for r in rows], 0.8, 0.2)
    assert all(math.isclose(r["quality"], p, abs_tol=1e-5) and r["kept"] == (not r["base_failed"] and p >= 0.5) for r, p in zip(rows, want, strict=True))
    for r in rows:  # the votes, by the rules as they are written down
        n, lines = max(1, r["n_words"]), max(1, r["n_lines"])
        some, v = r["n_words"] >= 20, r["votes"]
        assert v["length"] == (1 if r["n_words"] >= 100 else -1 if r["n_words"] < 30 else 0)
        assert v["symbols"] == (1 if some and r["n_symbols"] / n < 0.05 else -1 if r["n_symbols"] / n > 0.2 else 0)
        assert v["dup_lines"] == (1 if r["n_lines"] >= 3 and r["n_dup_lines"] / lines < 0.05 else -1 if r["n_lines"] >= 5 and r["n_dup_lines"] / lines > 0.3 else 0)
        assert v["repeats"] == (1 if some and r["n_repeat_words"] / n < 0.1 else -1 if r["n_repeat_words"] / n > 0.3 else 0)


def test_op5_posteriors(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in quality_classifier.classify(docs, labels=labels).collect()}
    terms = quality_classifier.Terms(quality_classifier.toxic_terms(docs.select("doc_id", "text"), labels, "doc_id", "toxic", 10_000))
    texts = documents(spark)
    votes = [quality_classifier.labeller_votes(t, terms) for _, t in texts]
    for part, name, prior, detection in ((0, "quality", 0.8, 0.2), (1, "clean", 0.9, 0.8)):
        for (d, _), p in zip(texts, brute_em([v[part] for v in votes], prior, detection), strict=True):
            assert math.isclose(got[d][f"{name}_posterior"], p, abs_tol=1e-5)


def brute_spans(text):
    out = [(m.start(), m.end(), 0) for m in re.finditer(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.ASCII) if len(m[2]) >= 12]
    out += [(m.start(), m.end(), 1) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    return sorted([*out, *((m.start(), m.end(), 2) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16)], key=lambda x: (x[0], x[2]))


def test_op3(spark):
    got = {r["doc_id"]: r for r in queries.QUERIES["op3_secret_scans"](spark, SF).collect()}
    for doc_id, text in documents(spark):
        base = brute_spans(text)
        assert got[doc_id]["base_sha256"] == hashlib.sha256(secrets.label(base).encode()).hexdigest()
        assert [got[doc_id][f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(x[2] == i for x in base) for i in range(3)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["token", "TOKEN", ":", "=", " ", '"', "secret", "AKIA", "Z9QX", "abcdef012345", "é", "\n", "api_key", "."]), max_size=20).map("".join))
def test_base_spans(text):
    encode = packing.encoding(public_tokenizers.path(packing.VOCABULARY)).encode_ordinary
    assert [x for x in secrets.spans(text, encode) if x[2] < 3] == brute_spans(text)


def test_random_strings():
    encode = packing.encoding(public_tokenizers.path(packing.VOCABULARY)).encode_ordinary
    kinds = lambda t: {k for *_, k in secrets.spans(t, encode)}
    assert 3 in kinds("see xK9qP2vLz8RtW4mBn7YcHd3J for it")
    for clean in ("internationalization_of_configuration", "550e8400-e29b-41d4-a716-446655440000", "1234567890123456789012345", "https://example.org/path/to/something/readable"):
        assert 3 not in kinds(clean)
    assert secrets.redact("a token = abcdefgh12345 b", secrets.spans("a token = abcdefgh12345 b", encode)) == "a token = [SECRET] b"


def test_recall_of_random_strings():
    """Recall by alphabet, length and place, and false alarms on words, names, paths, dates and the texts of the tables."""
    encode = packing.encoding(public_tokenizers.path(packing.VOCABULARY)).encode_ordinary
    rng, path = np.random.default_rng(1), "/documentation/administration/configuration/"
    found = lambda t: [t[a:b] for a, b, k in secrets.spans(t, encode) if k == 3]
    draw = lambda letters, n: "".join(rng.choice(list(letters), n))
    low, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    kinds = {"lower": low, "upper": low.upper(), "base32": low.upper() + "234567", "lower and digits": low + digits, "mixed": low + low.upper(), "base62": low + low.upper() + digits, "base64": low + low.upper() + digits + "+/"}
    for kind, letters in kinds.items():
        for n in (20, 24, 33, 40, 65):
            assert np.mean([bool(found(f"see {draw(letters, n)} for it")) for _ in range(200)]) > 0.95, (kind, n)
            if n > 20 and kind != "base64":
                keys = [draw(letters, n) for _ in range(100)]
                assert np.mean([any(k in x for x in found(path + k)) for k in keys]) > 0.95, (kind, n)
    clean = ["internationalization", "INTERNATIONALIZATION", "CONFIGURATION_SETTINGS_MAXIMUM_NUMBER", "getElementsByTagNameAndClassName", "Donaudampfschifffahrtsgesellschaft", "2024-01-01T00-00-00Z", path + "a/b/c/d/e/f/g/h", "keitstlichschenverpf", "20240101T000000000000Z", "x86_64-pc-linux-gnu-gcc-13", "01234567890123456789012345kg", "sha256-" + "a1" * 32, "a1" * 16]
    assert [x for x in clean if found(x)] == []


def test_op4_spans(spark):
    passage = " ".join(f"Sentence number {i} of the shared passage says this much." for i in range(6))
    rows = [(1, f"Own start one here. {passage} Own end."), (2, f"Another start. {passage} Another end."), (3, "Nothing shared at all. Quite clean. Very clean.")]
    got = {r["doc_id"]: r for r in substrings.remove_repeats(odd(spark, rows)).collect()}
    assert got[1]["n_removed"] == got[3]["n_removed"] == 0 and got[2]["text"] == "Another start. Another end."


def test_op4_passages(spark):
    """Passages of 60 words that begin and end within sentences, of short sentences, without end marks, and whole texts."""
    rng = np.random.default_rng(4)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    word = lambda: "".join(rng.choice(letters, rng.integers(2, 9)))
    prose = lambda n, each: " ".join(word() + (". " if each and i % each == each - 1 else "") for i in range(n))
    rows = []
    for k in range(60):
        shared = prose(60, (1, 4, 9, 14, 0)[k % 5])
        rows += [(10 * k, f"{prose(40, 7)} {shared} {prose(30, 11)}"), (10 * k + 1, f"{prose(23, 12)} {shared} {prose(57, 8)}"), (10 * k + 2, prose(150, 10))]
        rows += [(10 * k + 3, whole := prose(26, (26, 13, 0)[k % 3])), (10 * k + 4, whole)]
    got = {r["doc_id"]: r["n_removed"] for r in substrings.remove_repeats(odd(spark, rows)).collect()}
    assert all((n > 0) == (d % 10 in (1, 4)) for d, n in got.items()), {d: n for d, n in got.items() if (n > 0) != (d % 10 in (1, 4))}


@pytest.mark.parametrize("text", [" " * 2_000_000, "a" + " " * 2_000_000 + "b", "\n" * 2_000_000, "Word. " * 100_000, ".)" * 1_000_000, "x" * 2_000_000], ids=len)
def test_op4_long_texts(text):
    began = time.time()
    raw, bounds, words = substrings.sentences(text)
    substrings.spans(words)
    assert time.time() - began < 10 and bounds[-1] == len(raw) and all(words)
    assert substrings.without(text, [i * substrings.SPAN_CODE + 1 for i in range(len(words))], substrings.LONG)[2] == text[: bounds[0]]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["Ab", "cd", "é", ".", "!", ")", " ", "\n", ", ", "x\t"]), max_size=60).map("".join), st.integers(1, 6))
def test_op4_spans_are_shortest(text, least):
    raw, bounds, words = substrings.sentences(text, 3)
    assert [w for x in words for w in x] == raw.lower().split() and b"".join(raw[a:b] for a, b in zip([0, *bounds], bounds)) == raw  # noqa: B905
    found = {(i, n) for i, n, _ in substrings.spans(words, least)}
    size = lambda i, n: sum(map(len, words[i : i + n]))
    want = {(i, n) for i in range(len(words)) for n in range(1, len(words) - i + 1) if size(i, n) >= least > size(i, n - 1)}
    ends = [i for i in range(len(words)) if size(i, len(words)) >= least]
    assert found == want | ({(ends[-1], len(words) - ends[-1])} if ends else set())


def test_op5_held_out(spark):
    labels = {r["doc_id"]: (r["quality"], r["toxic"]) for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = [(labels[r["doc_id"]], r) for r in queries.QUERIES["op5_quality_classifier"](spark, "/root/testdata/sf0.01").collect() if r["doc_id"] in labels]
    assert np.mean([r["kept"] for l, r in rows if l == (1, 0)]) > 0.95 and np.mean([r["quality_score"] < 0.5 for l, r in rows if l[0] == 0]) > 0.85
    insulted = quality_classifier.classify(odd(spark, [(1, "you idiot and moron, stupid pathetic loser " * 4), *((k, f"a plain and friendly note about gardens and rivers number {k} " * 4) for k in range(2, 30))])).collect()
    assert {r["doc_id"]: r["kept"] for r in insulted}[1] is False


def test_op5_by_language(spark):
    """Terms are learned from one half of the labels; the other half has the toxic rows found and the others left alone."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_classifier.classify(docs, labels=labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id").join(docs.select("doc_id", "lang"), "doc_id").collect()
    odds = lambda r: sum(math.log(max(r[x], 1e-9) / max(1 - r[x], 1e-9)) for x in ("clean_score", "clean_posterior"))
    found = lambda lang: np.mean([odds(r) < 0 for r in rows if r["toxic"] and r["lang"] == lang])
    assert [lang for lang in ("en", "de", "fr") if found(lang) < 0.85] == [] and np.mean([odds(r) < 0 for r in rows if not r["toxic"]]) < 0.02
    assert np.mean([r["kept"] for r in rows if r["quality"] and not r["toxic"]]) > 0.95 and np.mean([r["kept"] for r in rows if not r["quality"] or r["toxic"]]) < 0.15


def test_op5_terms(spark):
    rows = [(k, f"{'grzimm grzork' if k % 4 == 0 else 'plain words'} number{k} and so on") for k in range(80)]
    labels = spark.createDataFrame([*((k, 1 if k % 4 == 0 else 0) for k in range(80)), (None, 1), (3, None), (900, 1)], "doc_id long, toxic int")
    read = odd(spark, rows).select("doc_id", "text")
    assert quality_classifier.toxic_terms(read, labels, "doc_id", "toxic", 1000) == {b"grzimm", b"grzork", b"grzi", b"grzim", b"grzo", b"grzor"}
    for none in (None, labels.limit(0)):
        assert quality_classifier.toxic_terms(read, none, "doc_id", "toxic", 1000) == frozenset()


def test_op6_splits(spark):
    body = "<p>equal payload</p>" * 80
    rows = [(1, "u", body), (2, None, body), (2, None, body), (None, "u\nv", body), (3, "x", None), (4, "x", ""), (5, "x", "short"), (6, "x", "short"), (7, "y", "".join(hashlib.sha256(str(i).encode()).hexdigest() for i in range(4000)))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for split in (997, 1 << 20):
        got = sorted(warc.round_trip(pages, split=split, with_payload=True).collect(), key=lambda r: (r["page_id"] or 0, r["payload_digest"]))
        assert len(got) == len(rows)
        for r in got:
            html = next((h or "") for p, _, h in rows if p == r["page_id"])
            assert (r["payload_bytes"], r["payload_digest"]) == (len(html), hashlib.sha1(html.encode()).hexdigest())
            assert (r["record_type"], r["refers_to"]) == (("revisit", 2) if html == body and r["page_id"] != 2 else ("response", None))
            assert r["record_type"] == "revisit" or bytes(r["payload"]).decode() == html
    assert warc.round_trip(pages.limit(0)).collect() == []
    odd_pages = spark.createDataFrame([(1, None, "a" * 2000, "x", 5, None), (2, "u", "a" * 2000, None, None, "y")], "page_id long, url string, html string, payload_digest string, refers_to long, kind string")
    assert {(r["page_id"], r["record_type"], r["refers_to"]) for r in warc.round_trip(odd_pages).collect()} == {(1, "revisit", 2), (2, "response", None)}
    assert warc.round_trip(odd_pages.limit(0)).collect() == []


def test_op6_long_headers(spark):
    rng = np.random.default_rng(6)
    urls = ["http://x.example/" + "".join(rng.choice(list("abcdefgh0123456789"), n)) for n in (60_000, 100_000, 300_000)]
    pages = spark.createDataFrame([(k, u, f"page {k}") for k, u in enumerate(urls)], "page_id long, url string, html string")
    for split in (10_007, 1 << 20):
        assert {r["page_id"]: r["url"] for r in warc.round_trip(pages, split=split).collect()} == dict(enumerate(urls))


def test_op6_long_page(spark):
    """A page whose record, compressed, is longer than a range: the ranges that it runs through own none of its bytes."""
    html = base64.b64encode(np.random.default_rng(16).bytes(18_000_000)).decode()
    pages = spark.createDataFrame([(1, "u", "before"), (2, "u", html), (3, "u", "behind")], "page_id long, url string, html string").coalesce(1)
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"]) for r in warc.round_trip(pages).collect()}
    assert got == {k: (len(x), hashlib.sha1(x.encode()).hexdigest()) for k, x in ((1, "before"), (2, html), (3, "behind"))}


def test_op6_spreads_ranges(spark):
    pages = spark.createDataFrame([(k, "u", hashlib.sha256(str(k).encode()).hexdigest() * 8) for k in range(400)], "page_id long, url string, html string").coalesce(1)
    folder = f"file://{warc.checkpoint_dir(spark).removeprefix('file:')}/spread-{time.time_ns()}"
    files = warc.write_warc(pages, folder)
    rows = warc.read_warc(files, split=4096, with_payload=False)
    ranges = math.ceil(files.first()["bytes"] / 4096)
    assert ranges > 10 and len({r[0] for r in rows.select(spark_partition_id()).collect()}) > 0.8 * ranges and rows.count() == 400


def test_op6_broken_archives():
    class File:
        def __init__(self, data):
            self.data = data

        def read_at(self, n, at):
            return self.data[at : at + n]

    one = warc.record(1, "u", b"payload " * 400, "d", "response", None)
    records = lambda data: list(warc.records(warc.Range(File(data), len(data)), 0, len(data)))
    assert [at for at, _ in records(b"\x1f\x8b\x08junk" + one + b"\x1f\x8b" + one)] == [7, 9 + len(one)]
    for data in (one[:-20], one[:-8] + bytes(8)):
        with pytest.raises(ValueError):
            records(data)


def brute_simhash(text, k=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, radius):
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    fps = list(fps)
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= radius:
                parent[root(a)] = root(b)
    return {f: root(f) for f in fps}


def test_op7(spark):
    docs = documents(spark)
    fps = {d: brute_simhash(t) for d, t in docs}
    roots = brute_components(set(fps.values()), 4)
    least = defaultdict(lambda: 1 << 60)
    for d, f in fps.items():
        least[roots[f]] = min(least[roots[f]], d)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.QUERIES["op7_simhash_near_dedup"](spark, SF).collect()}
    assert got == {d: (f"{f:016x}", least[roots[f]]) for d, f in fps.items()}


@pytest.mark.parametrize("leaf,block", [(40, 1000), (10**6, 30), (60, 25)])
def test_tree_loses_no_link(spark, leaf, block):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 60)
    fps = {int(c) for c in centres}
    for c in centres[:30]:
        x = int(c)
        for _ in range(8):  # chains of near fingerprints
            for b in rng.choice(63, rng.integers(1, 7), replace=False):
                x ^= 1 << int(b)
            fps.add(x)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    links = simhash.near_links(df, "fp", 4, leaf, block).collect()
    assert all((r["a"] ^ r["b"]).bit_length() for r in links)
    found = {r["node"]: r["root"] for r in simhash.components(simhash.near_links(df, "fp", 4, leaf, block)).collect()}
    groups, want = defaultdict(set), defaultdict(set)
    for f in fps:
        groups[found.get(f, f)].add(f)
    for f, r in brute_components(fps, 4).items():
        want[r].add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_op8_inheritance(spark):
    rows = [("a/LICENSE", "Released under the MIT License."), ("a/b/x.c", "int main"), ("a/b/y.c", "// Licensed under the Apache License, Version 2.0."), ("c/z.c", "plain"), ("a/d/COPYING", "Licensed under CC BY-NC 4.0."), ("a/d/e/f", "text"), (None, None)]
    files = spark.createDataFrame([(i, p, t) for i, (p, t) in enumerate(rows)], "doc_id long, path string, text string")
    got = {r["doc_id"]: (r["license"], r["origin"]) for r in licenses.scan_licenses(files).collect()}
    assert got == {0: ("MIT", "file"), 1: ("MIT", "inherited"), 2: ("Apache-2.0", "header"), 3: (None, "none"), 4: ("CC-BY-NC-4.0", "file"), 5: ("CC-BY-NC-4.0", "inherited"), 6: (None, "none")}


def test_op8_odd_files(spark):
    rows = [(0, "a/LICENSE", None), (1, "a/x", "text"), (2, "LICENSE", "Released under the MIT License."), (2, "LICENSE", "Released under the MIT License."), (3, None, "plain"), (4, "b/LICENSE", ""), (None, "b/y", "copyright " * 20_000), (5, "c/LICENSE", "SPDX-License-Identifier: Apache-2.0"), (6, "c/LICENSE", "Released under the MIT License.")]
    files = spark.createDataFrame([(*r, "x", 1.0, None) for r in rows], "doc_id long, path string, text string, license string, score double, given string")
    got = sorted((str(r["doc_id"]), r["license"], r["origin"]) for r in licenses.scan_licenses(files).collect())
    assert [g for g in got if g[0] not in ("None", "5", "6")] == [("0", "MIT", "inherited"), ("1", "MIT", "inherited"), ("2", "MIT", "file"), ("2", "MIT", "file"), ("3", "MIT", "inherited"), ("4", "MIT", "inherited")]
    assert {g for g in got if g[0] in "56"} == {("5", "Apache-2.0", "file"), ("6", "MIT", "file")} and len(got) == len(rows)


def names(spark, texts, path="src/x{}.c"):
    files = spark.createDataFrame([(i, path.format(i), t) for i, t in enumerate(texts)], "doc_id long, path string, text string")
    return [r["license"] for r in licenses.scan_licenses(files).orderBy("doc_id").collect()]


def test_op8_wrapped_headers(spark):
    gpl = "// This program is free software{} you can redistribute it and/or modify\n// it under the terms of the GNU General Public License as published by\n// the Free Software Foundation{} either version {} of the License, or\n// (at your option) any later version."
    mit = "/* Permission is hereby granted, free of charge, to any person obtaining a copy\n * of this software and associated documentation files, to deal\n * in the Software without restriction */"
    bsd = "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the following conditions\n# are met:"
    code = "\nint main(void) {\n  return 0;\n}\n" * 20
    found = names(spark, [x + code for x in (gpl.format(";", ";", 2), gpl.format(":", ",", 3), mit, bsd, "// Licensed under the GNU General Public License.")] + [code, "", None])
    assert found == ["GPL-2.0", "GPL-3.0", "MIT", "BSD", "GPL", None, None, None]


@pytest.mark.skipif(not os.path.isdir("/usr/share/common-licenses"), reason="no licence texts here")
def test_op8_full_texts(spark):
    want = {"Apache-2.0": "Apache-2.0", "Artistic": "Artistic-1.0", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0", "GFDL-1.2": "GFDL-1.2", "GFDL-1.3": "GFDL-1.3", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0"}
    there = [n for n in sorted(want) if os.path.exists(f"/usr/share/common-licenses/{n}")]
    texts = [open(f"/usr/share/common-licenses/{n}", encoding="utf-8", errors="replace").read() for n in there]  # noqa: SIM115
    mit = next(t for x, t in licenses.TEMPLATES if x == "MIT" and len(t) > 800).replace("(c)", "(c) 2020 Some One").replace(". ", ".\n\n").replace(", ", ",\n")
    assert names(spark, [*texts, mit], "p{}/LICENSE") == [*(want[n] for n in there), "MIT"]


def test_op9(spark):
    docs, out = documents(spark), lambda d: zlib.crc32(str(d).encode()) % 7 == 2
    tokens = lambda t: [*(t or "").encode().lower().split(), b""]
    c = Counter(x for d, t in docs if not out(d) for x in tokens(t))
    n, v = sum(c.values()), len(c)
    read = spark.read.parquet(f"{SF}/documents.parquet")
    for size in (1 << 17, 300):  # a small table makes the join do the work
        rows = {r["doc_id"]: r for r in language_model.score_documents(read, head=48, tail=16, dim=8, table_size=size).collect()}
        for d, t in docs:
            r, own = rows[d], tokens(t)
            assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out(d), len(own), sum(x in c for x in own), n)
            assert math.isclose(r["base_score"], sum(math.log10((c[x] + 1) / (n + v + 1)) for x in own), rel_tol=1e-9)
        assert sum(r["score"] for r in rows.values() if r["held_out"]) > sum(r["base_score"] for r in rows.values() if r["held_out"])


def test_op9_score(spark):
    """The score by its definition: a softmax over all classes for each token, and the add-one share within a group."""
    docs, model = spark.read.parquet(f"{SF}/documents.parquet"), {}
    rows = {r["doc_id"]: r for r in language_model.score_documents(docs, head=48, tail=16, dim=8, table_size=300, model_out=model).collect()}
    counts = Counter(x for d, t in documents(spark) if zlib.crc32(str(d).encode()) % 7 != 2 for x in language_model.tokens(t))
    group = lambda x: zlib.crc32(x[-3:]) % 16
    rare = {x: c for x, c in counts.items() if x not in model["classes"]}
    size = [sum(c + 1 for x, c in rare.items() if group(x) == k) + 1 for k in range(16)]
    w, kind = model["weights"], lambda x: model["classes"].get(x, group(x))
    assert len(model["classes"]) == 48 and list(model["group_tokens"] + model["group_types"] + 1) == size

    def probability(before, last, x):
        e = np.exp((w.R[before] @ w.C[0] + w.R[last] @ w.C[1]) @ w.O.T.astype(np.float64) + w.b)
        return e[kind(x)] / e.sum() * (1 if x in model["classes"] else (rare.get(x, 0) + 1) / size[group(x)])

    start = kind(b"")
    for d, t in documents(spark)[:60]:
        words = language_model.tokens(t)[-400:] if t and len(t) < 4000 else None
        if words is None or len(language_model.tokens(t)) > 400:
            continue
        ids = [start, start, *map(kind, words)]
        want = sum(math.log10(probability(ids[i], ids[i + 1], x)) for i, x in enumerate(words))
        assert math.isclose(rows[d]["score"], want, rel_tol=1e-4), d
    total = sum(probability(3, 5, x) for x in counts) + sum(probability(3, 5, x) for x in {group(x): x for x in (b"unseen%d" % i for i in range(2000))}.values())
    assert math.isclose(total, 1, rel_tol=1e-5)


ODD_TEXTS = ["".join(chr(i) + "aB" for i in range(256)), "  Ab  c\u00e9 D\x1cE\x85 \u00dc ", "", " \n\t", None, "x", "x" * 70 + " Y", "\u00c9" * 40, "y" * 64 + "\x00 " + "Z" * 65, "\x00", " \x00 ", "a b"]


@pytest.mark.parametrize("size", [1, 50, 1 << 20])
@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_op9_tokens_by_arrays(kind, size):
    found = [words[a:b].to_pylist() for first, words in language_model.token_arrays(pa.array(ODD_TEXTS, kind), size) for a, b in zip(first[:-1], first[1:], strict=True)]
    assert found == [language_model.tokens(x) for x in ODD_TEXTS]
    plain = [(x or "").encode().lower().split() for x in ODD_TEXTS]
    assert [[w if len(w) <= 64 else None for w in p] + [b""] for p in plain] == [[None if len(w) == 17 and w[:1] == b" " else w for w in f] for f in found]


def test_op9_counts_in_parts(spark):
    texts = [*ODD_TEXTS, *(" ".join(f"w{(i * k) % 31}" for k in range(12)) for i in range(40))]
    docs, want = spark.createDataFrame([(x,) for x in texts], "text string").repartition(2), Counter(w for x in texts for w in language_model.tokens(x))
    for flush in (1, 20, 400_000):
        assert {bytes(r["token"]): r["c"] for r in language_model.count_tokens(docs, "text", flush).collect()} == want


def test_op9_long_text_among_short_ones(spark):
    """More text in a batch than is cut into words at once: rows keep their own tokens."""
    texts = {i: x for i, x in enumerate([*ODD_TEXTS, "lorem ipsum dolor " * 250_000, *ODD_TEXTS, "unseen words only"])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    rows = {r["doc_id"]: r for r in language_model.score_documents(docs, head=8, tail=4, dim=3, table_size=6).collect()}
    c = Counter(w for d, x in texts.items() if zlib.crc32(str(d).encode()) % 7 != 2 for w in language_model.tokens(x))
    n = sum(c.values()) + len(c) + 1
    for d, x in texts.items():
        own = language_model.tokens(x)
        assert (rows[d]["n_tokens"], rows[d]["n_known"]) == (len(own), sum(w in c for w in own)), d
        assert math.isclose(rows[d]["base_score"], sum(math.log10((c[w] + 1) / n) for w in own), rel_tol=1e-9), d
        assert math.isfinite(rows[d]["score"]), d


@pytest.mark.parametrize("dim", [24, 5])
def test_op9_step(dim):
    """A step is the gradient of the noise-contrastive objective, and makes no array of batch times noise."""
    rng, n, m, k = np.random.default_rng(3), 50, language_model.BATCH, language_model.NOISE
    share = rng.random(n) + 0.1
    share /= share.sum()
    trainer = language_model.Trainer(language_model.Weights.start(share, dim).flat, share, dim)
    old = language_model.Weights(n, dim, trainer.w.flat.astype(np.float64))
    before, last, target, noise = (rng.integers(0, n, size) for size in (m, m, m, k))
    tracemalloc.start()
    trainer.step(before, last, target, noise, 0.05)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    q, g = old.query(before, last), language_model.Weights(n, dim, np.zeros(len(old.flat)))
    up = 1 / (1 + np.exp((q * old.O[target]).sum(axis=1) + old.b[target] - np.log(k * share[target])))
    down = -1 / (1 + np.exp(-(q @ old.O[noise].T + old.b[noise] - np.log(k * share[noise]))))
    dq = up[:, None] * old.O[target] + down @ old.O[noise]
    np.add.at(g.O, target, up[:, None] * q)
    np.add.at(g.O, noise, down.T @ q)
    np.add.at(g.b, target, up)
    np.add.at(g.b, noise, down.sum(axis=0))
    for i, context in enumerate((before, last)):
        np.add.at(g.R, context, dq @ old.C[i].T)
        g.C[i] += old.R[context].T @ dq
    assert np.allclose(trainer.g.flat, g.flat, rtol=1e-3, atol=1e-2)
    assert np.allclose(trainer.w.flat, old.flat + 0.05 * g.flat / np.sqrt(1 + g.flat**2), atol=1e-4)
    assert most < 4 * m * k


def test_normalised(spark):
    w = language_model.Weights.start(np.full(9, 1 / 9), 4)
    z = language_model.normalisers(spark, w)
    for a in range(9):
        q = w.query(np.full(9, a), np.arange(9))
        assert np.allclose(np.exp(q @ w.O.T + w.b - z[a][:, None]).sum(axis=1), 1, atol=1e-5)


def brute_matches(texts, items):
    grams = lambda w: Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    want = defaultdict(set)
    split = [(i, t.lower().split()) for i, t in items]
    for d, t in texts:
        words = t.lower().split()
        for i, w in split:
            own = grams(w)
            if len(set(own) & set(grams(words))) < 0.4 * len(own):
                continue
            for a in range(max(1, len(words) - len(w) + 1)):
                s = grams(words[a : a + len(w)])
                both = (s & own).total()
                if both >= 0.8 * (s | own).total():
                    want[d].add(i)
    return dict(want)


def test_op10(spark):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {r["doc_id"]: set(r["item_ids"]) for r in queries.QUERIES["op10_benchmark_decontamination"](spark, SF).collect()}
    assert {d: x for d, x in got.items() if x} == brute_matches(documents(spark), items)


def test_blocks_find_all_within_the_radius():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 1 << 63, 20).astype(np.uint64)
    own = np.array([int(fps[k % 20]) ^ sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 24), replace=False)) for k in range(400)], np.uint64)
    h = [(k, 0, np.array([f], np.uint64)) for k, f in enumerate(fps)]
    *_, kept, tables = decontamination.Items.prepare(1, h)
    found = set(decontamination.Items.candidates(own, kept, tables))
    assert found == {(i, k) for i, a in enumerate(own) for k, f in enumerate(kept) if int(np.bitwise_count(a ^ f)) <= decontamination.RADIUS}


def test_items_at_the_ends_of_texts():
    for n, other in ((100, 120), (100, 104), (61, 73)):
        members = decontamination.Items([(k, " ".join(f"i{k}w{x}" for x in range(m + 4))) for k, m in enumerate([n, *[other] * 40])], 5, 0.8)
        words = lambda k, m: " ".join(f"i{k}w{x}" for x in range(m + 4))
        lost = 0
        for at in range(40):  # the short item, verbatim, last in the last text of a buffer
            text = " ".join(f"o{at}x{x}" for x in range(300 + 7 * at)) + " " + words(0, n)
            hashes = next(decontamination.hashed_texts([text]))[1]
            lost += 0 not in {item for _, item, *_ in members.search(hashes, np.array([0, len(hashes)]))}
        assert not lost, (n, other)


@pytest.mark.parametrize("least,changed", [(0.8, 2), (0.84, 1)])
def test_matches_just_above_the_threshold(least, changed):
    n = 90 if changed == 2 else 60  # each change in the middle costs five shingles: 80 of 90 (similarity 0.8) and 55 of 60 (0.846) stay
    words = lambda k: [f"i{k}w{x}" for x in range(n + 4)]
    members = decontamination.Items([(k, " ".join(words(k))) for k in range(60)], 5, least)
    for k in range(60):
        own = words(k)
        for x in range(changed):
            own[20 + 30 * x] = f"new{k}x{x}"
        text = [f"o{k}x{x}" for x in range(200 + 3 * k)]
        hashes = next(decontamination.hashed_texts([" ".join([*text, *own, *text])]))[1]
        got = {item: (round(s, 6), first) for _, item, s, first, _ in members.search(hashes, np.array([0, len(hashes)]))}
        both = n - 5 * changed
        assert got == {k: (round(both / (2 * n - both), 6), len(text))}


def test_op10_long_items_and_shards(spark):
    rng = np.random.default_rng(10)
    draw = lambda n: [f"w{x}" for x in rng.integers(0, 5000, n)]
    items = [draw(n) for n in (30, 12_000, 7000, 50_000, 5, 400)]
    changed = list(items[1])
    for x in range(500, 12_000, 700):
        changed[x] = "other"
    docs = [[*draw(3000), *items[1], *draw(500)], changed, [*draw(100), *items[3]], [*items[2][:4000], *draw(3000)], [*draw(20_000), *items[0], *draw(5), *items[4]], draw(100)]
    want = {0: [1], 1: [1], 2: [3], 3: [], 4: [0, 4], 5: []}
    table = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    texts = odd(spark, [(d, " ".join(x)) for d, x in enumerate(docs)])
    for most in (decontamination.MOST_PARTS, 3):
        rows = decontamination.with_matches(texts, table, "found", "text", "item_id", "text", 5, 0.8, most).collect()
        assert {r["doc_id"]: [m["item_id"] for m in r["found"]] for r in rows} == want
    first = {r["doc_id"]: [m["first_word"] for m in r["found"]] for r in rows}
    assert (first[0], first[2], first[4]) == ([3000], [100], [20_000, 20_035])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), min_size=1, max_size=30), st.lists(st.sampled_from("abc"), min_size=1, max_size=8))
def test_op10_best_window(text, item):
    """The sliding window against a count of each window anew."""
    members = decontamination.Items([(0, " ".join(item))], 1, 0.5)
    words = lambda x: next(decontamination.hashed_texts([" ".join(x)]))[1]
    h = decontamination.shingles(words(text), 1)
    _, own, counts = members.items[0]
    got = members.best(h, 0, len(text), own, counts)
    n, want = len(item), 0.0
    for a in range(max(1, len(text) - n + 1)):
        both = (Counter(text[a : a + n]) & Counter(item)).total()
        want = max(want, both / (len(text[a : a + n]) + n - both))
    assert (got[0] if got else 0.0) == (want if want >= 0.5 else 0.0)


def brute_shingles(text, k=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute_groups(texts, least):
    """The smallest id that links of similarity `least` or more reach."""
    root, ids = {d: d for d in texts}, sorted(texts)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(texts[a] & texts[b])
            if both >= least * (len(texts[a]) + len(texts[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in ids}


@pytest.mark.parametrize("leaf,block", [(60_000, 60_000), (40, 15)])
def test_near_copies(spark, leaf, block):
    rng = np.random.default_rng(9)
    rows, want = [], {}
    for k in range(25):
        n = int(rng.integers(30, 400))
        words = [f"w{x}" for x in rng.integers(0, 3000, n)]
        for c in range(4):
            own = list(words)
            for at in rng.choice(n, max(1, n // 60), replace=False) if c else ():  # similarity of about 0.85
                own[at] = f"new{rng.integers(1 << 30)}"
            rows.append((4 * k + c, " ".join(own)))
        rows.append((1000 + k, " ".join(words[: n // 2])))  # half a text is another text
    texts = {d: brute_shingles(t) for d, t in rows}
    kept = {r["doc_id"] for r in simhash.keep_one(odd(spark, rows), leaf=leaf, block=block).collect()}
    want = brute_groups(texts, 0.8)
    assert kept == set(want.values())


@pytest.mark.parametrize("most", [1 << 19, 5000])
def test_near_copies_at_the_threshold(spark, most):
    rows, hub = [], [f"hub{x}" for x in range(944)]
    for k in range(40):
        for kind, (n, shared) in enumerate([(90, 80), (90, 79), (90, 78), (900, 800), (900, 790)]):  # similarity 0.8, 0.782, 0.765, 0.8, 0.782
            words = [f"w{k}k{kind}x{x}" for x in range(n + 4)]
            rows += [(1000 * k + 2 * kind, " ".join(words)), (1000 * k + 2 * kind + 1, " ".join(words[: shared + 4] + [f"own{x}" + w for x, w in enumerate(words[shared + 4 :])]))]
        rows.append((1000 * k + 20, " ".join(hub[: 800 + 2 * k])))  # a group of over 5,000 shingles
        rows.append((1000 * k + 21, " ".join(f"r{k}" if x % 3 else f"r{k}x{x % 60}" for x in range(400))))  # shingles repeat
    texts = {d: brute_shingles(t) for d, t in rows}
    kept = {r["doc_id"] for r in simhash.keep_one(odd(spark, rows), most=most).collect()}
    assert kept == set(brute_groups(texts, 0.8).values())


def test_smallest(spark):
    df = spark.range(20_000).select("id").repartition(7)
    want = [r["id"] for r in df.orderBy(xxhash64("id"), "id").limit(300).collect()]
    assert [r["id"] for r in smallest(df, 300, "id").collect()] == want and smallest(df.limit(50), 300, "id").count() == 50 and smallest(df.limit(0), 5, "id").count() == 0


@pytest.mark.parametrize("most", [1 << 19, 6000])
def test_near_copies_in_chains(spark, most):
    """Texts that are like their neighbours only: most of a large group is not like its root."""
    rows = []
    for chain in range(3):
        words = [f"c{chain}x{x}" for x in range(3200)]
        rows += [(100 * chain + k, " ".join(words[40 * k : 40 * k + 800])) for k in range(60)]
        rows += [(1000 + 100 * chain + k, " ".join([*words[:700], *(f"own{chain}y{k}y{x}" for x in range(60))])) for k in range(20)]
    kept = {r["doc_id"] for r in simhash.keep_one(odd(spark, rows), most=most).collect()}
    assert kept == set(brute_groups({d: brute_shingles(t) for d, t in rows}, 0.8).values())


def test_sketches():
    rng = np.random.default_rng(2)
    for n in (3, 40, 5000):
        both, a, b = (rng.integers(0, 1 << 63, m).astype(np.uint64) for m in (8 * n, n, n))
        got = simhash.agreement(simhash.sketch(np.unique(np.concatenate([both, a]))), simhash.sketch(np.unique(np.concatenate([both, b])))[None])
        assert abs(got[0] - 0.8) < 0.1
    assert simhash.agreement(simhash.sketch(np.zeros(0, np.uint64)), simhash.sketch(np.zeros(0, np.uint64))[None])[0] == 1


def test_pipeline_stages(spark):
    """Each stage against a brute-force version on what the stage before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}
    stages = [f for _, f in pipeline.STAGES]
    good = stages[0](spark, docs, SF)
    kept = rows(good)
    assert set(kept) == {r["doc_id"] for r in queries.QUERIES["op2_quality_rules"](spark, SF).collect() if r["kept"]}
    single = stages[1](spark, good, SF)
    groups = brute_groups({d: brute_shingles(t) for d, t in kept.items()}, 0.8)
    assert rows(single) == {d: kept[d] for d in set(groups.values())} and len(groups) > len(set(groups.values()))
    clean = stages[2](spark, single, SF)
    found = brute_matches(rows(single).items(), [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    assert found and rows(clean) == {d: t for d, t in rows(single).items() if d not in found}
    safe = stages[3](spark, clean, SF)
    encode = packing.encoding(public_tokenizers.path(packing.VOCABULARY)).encode_ordinary
    assert rows(safe) == {d: secrets.redact(t, secrets.spans(t, encode)) for d, t in rows(clean).items()}
    assert all(r["n_chars"] == len(r["text"]) for r in safe.collect() if "[SECRET]" in r["text"])
    for df in (good, single, clean, safe):
        assert df.columns == docs.columns
    encode, packed = packing.encoder(public_tokenizers.path(packing.VOCABULARY)), stages[4](spark, safe, SF).collect()
    assert {d: len(encode(t)) + 1 for d, t in rows(safe).items()} == {d: sum(r["length"] for r in packed if r["doc_id"] == d) for d in {r["doc_id"] for r in packed}}
    place = lambda r: (r["doc_id"], r["piece"], r["ids_crc32"], r["length"])
    assert sorted(map(place, pipeline.run(spark, SF).collect())) == sorted(map(place, packed))


def test_pipeline_on_empty_and_odd_tables(spark, tmp_path):
    good = [r for r in spark.read.parquet(f"{SF}/documents.parquet").where("length(text) > 500").limit(40).collect()]
    table = spark.createDataFrame([*((r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in good), *((d, t, None, None, None) for d, t in ODD)], "doc_id long, text string, lang string, source string, n_chars long")
    for name, df in (("odd", table), ("empty", table.limit(0))):
        df.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(1, None), (2, ""), (3, "not in any text at all")], "item_id long, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    assert pipeline.run(spark, f"{tmp_path}/empty").count() == 0
    packed = {r["doc_id"] for r in pipeline.run(spark, f"{tmp_path}/odd").collect()}
    assert 10 < len(packed) <= 42 and packed <= {r["doc_id"] for r in good} | {4, 5, 6, None}


def test_rows_of_one_text(spark):
    """Rows that differ in other columns only: the smallest doc_id stays, and of equal ids one row, always the same."""
    rows = [(d, "one two three four five six", "en", s, n) for d, s, n in ((5, "b", 1), (3, "b", 2), (3, "a", 9), (3, "a", 9), (None, "c", 4))] + [(8, "something else that is not like it", "en", "z", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    first = [tuple(r) for r in simhash.keep_one(df).orderBy("doc_id").collect()]
    assert [r[0] for r in first] == [3, 8]
    assert first == [tuple(r) for r in simhash.keep_one(df.repartition(5)).orderBy("doc_id").collect()]
    many = df.unionByName(df.where("doc_id = 3").crossJoin(spark.range(3000)).drop("id"))  # a hot text, and rows wholly alike
    assert first == [tuple(r) for r in simhash.keep_one(many.repartition(5)).orderBy("doc_id").collect()]


def test_near_dedup_shuffles_texts_once_for_its_result(spark):
    """Both joins of the result read one exchange of the rows."""
    rows = spark.createDataFrame([(k, f"text number {k % 7} of some words", "x") for k in range(40)], "doc_id long, text string, lang string")
    df = simhash.keep_one(rows)
    assert sorted(r["doc_id"] for r in df.collect()) == list(range(7))
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan
