"""Order of files, growing files, the append log, batches over chunks, mixes, runs in common and reviews."""

import json
import math
import random
from collections import Counter, defaultdict, deque

import pytest
from pyspark.sql import functions as F

from quillmill.functions import text as tx
from quillmill.operators import echo, selection, status
from quillmill.sources import commits, growing, jsonl


def put(path, ids):
    path.parent.mkdir(exist_ok=True)
    path.write_text("".join(json.dumps({"id": i}) + "\n" for i in ids))


def test_order_of_files(spark, tmp_path):
    """Files of a folder are read in the order of their names, whatever their sizes, and arguments in theirs."""
    put(tmp_path / "in/a.jsonl", ["a0"])
    put(tmp_path / "in/b.jsonl", [f"b{i}" for i in range(50)])
    put(tmp_path / "in/c +%.jsonl", [f"c{i}" for i in range(5)])
    put(tmp_path / "z.jsonl", ["z0", "z1"])
    rows = jsonl.read_ordered(spark, [str(tmp_path / "z.jsonl"), str(tmp_path / "in")], "id string").orderBy("ordinal").collect()
    assert [r["id"] for r in rows] == ["z0", "z1", "a0", *(f"b{i}" for i in range(50)), *(f"c{i}" for i in range(5))]
    assert len({r["ordinal"] for r in rows}) == 58 and [r["source_line"] for r in rows[-5:]] == [1, 2, 3, 4, 5] and rows[-1]["source_path"].endswith("/in/c +%.jsonl")
    with open(tmp_path / "in/b.jsonl", "a") as f:
        f.write('\n[1]\n{"id": broken\n')
    good, bad = jsonl.read_ordered_lenient(spark, [str(tmp_path / "in")], "id string")
    assert good.count() == 56 and [(r["source_line"], r["error"], r["line"]) for r in bad.orderBy("ordinal").collect()] == [(52, "invalid json", "[1]"), (53, "invalid json", '{"id": broken')]
    with pytest.raises(Exception, match=r"invalid json in .*b.jsonl:52"):
        jsonl.read_ordered(spark, [str(tmp_path / "in")], "id string").orderBy("ordinal").collect()
    put(tmp_path / "none.jsonl", [])
    assert jsonl.read_ordered(spark, [str(tmp_path / "none.jsonl")], "id string").collect() == []


def followed(spark, tmp_path, **options):
    rows = growing.follow_growing(spark, str(tmp_path / "in"), "id string, error string", include_errors=True, **options)
    commits.write_stream(rows, str(tmp_path / "out"), str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    found = commits.read(spark, str(tmp_path / "out"), "source_file string, position long, error string, id string, line string").collect()
    return Counter((r["source_file"], r["id"], r["error"], r["line"]) for r in found)


def test_growing_files(spark, tmp_path):
    """Only new lines come, each once, over restarts; half a line waits."""
    put(tmp_path / "in/a.jsonl", ["1", "2"])
    (tmp_path / "in/other.txt").write_text("no\n")
    want = Counter({("a.jsonl", "1", None, None): 1, ("a.jsonl", "2", None, None): 1})
    assert followed(spark, tmp_path) == want
    with open(tmp_path / "in/a.jsonl", "a") as f:
        f.write('{"id": "3", "error": "bad"}\n\nbroken\n{"id": "é')
    put(tmp_path / "in/b.jsonl", ["9"])
    want.update([("a.jsonl", "3", "bad", None), ("a.jsonl", None, "invalid_json", "broken"), ("b.jsonl", "9", None, None)])
    assert followed(spark, tmp_path) == want
    assert followed(spark, tmp_path) == want
    with open(tmp_path / "in/a.jsonl", "a") as f:
        f.write('4"}\n')
    want.update([("a.jsonl", "é4", None, None)])
    assert followed(spark, tmp_path) == want


def test_half_lines_taken_and_start_at_the_end(spark, tmp_path):
    put(tmp_path / "in/a.jsonl", ["1"])
    options = {"half_lines": "take", "from_start": False}
    assert followed(spark, tmp_path, **options) == Counter()
    with open(tmp_path / "in/a.jsonl", "a") as f:
        f.write('{"id": "2"}\n{"id": ')
    assert followed(spark, tmp_path, **options) == Counter([("a.jsonl", "2", None, None), ("a.jsonl", None, "invalid_json", '{"id": ')])


@pytest.mark.parametrize("size", [1, 3, 7, 20, 1000])
def test_ranges_of_a_file(tmp_path, size):
    """Whatever the ranges, each line is in one of them."""
    rng = random.Random(size)
    text = [b"x" * rng.randrange(0, 25) for _ in range(60)]
    (tmp_path / "a.jsonl").write_bytes(b"\n".join(text))
    reader = growing.Reader({"path": str(tmp_path), "rangebytes": str(size), "halflines": "take"})
    ends = [0, 100, 101, 333, len(b"\n".join(text))]
    got = []
    for a, b in zip(ends, ends[1:], strict=False):
        for part in reader.partitions({str(tmp_path / "a.jsonl"): a}, {str(tmp_path / "a.jsonl"): b}):
            got += [(r["position"], r["line"]) for batch in reader.read(part) for r in batch.to_pylist()]
    whole = b"\n".join(text)
    lines = []
    for a, b in zip(ends, ends[1:], strict=False):
        at = a
        for line in whole[a:b].split(b"\n"):
            if line or at < b:
                lines.append((at, line.decode()))
            at += len(line) + 1
    assert sorted(got) == sorted(lines)


def test_append_log(spark, tmp_path):
    folder, df = str(tmp_path / "t"), lambda *ids: spark.createDataFrame([(i,) for i in ids], "id string")
    ids = lambda: sorted(r["id"] for r in commits.read(spark, folder, "id string").collect())
    assert ids() == [] and commits.count(spark, folder) == 0
    df("x").write.parquet(f"{folder}/staged/r-{0:020d}-killed")  # staged, and killed before it counted
    assert ids() == []
    assert commits.append(df("a", "b"), folder, "r", 0, {"longest": F.max(F.length("id"))})["longest"] == 1
    assert commits.append(df("a", "b"), folder, "r", 0) is None and commits.append(df("a"), folder, "s", 0)["rows"] == 1
    assert ids() == ["a", "a", "b"] and commits.count(spark, folder) == 3
    assert commits.append(df().limit(0), folder, "r", 1)["rows"] == 0
    assert commits.vacuum(spark, folder) == 1 and ids() == ["a", "a", "b"] and commits.vacuum(spark, folder) == 0
    done = spark.createDataFrame([("a", None), ("b", "failed"), (None, None)], "id string, error string")
    commits.resume(df("a", "b", "c"), done, lambda rows: rows, folder, "r", 2)
    assert ids() == ["a", "a", "b", "b", "c"]


def test_two_writers_of_one_batch(spark, tmp_path):
    """Of two that come to write a manifest at the same time one does."""
    store = commits.Store(spark, str(tmp_path))
    assert store.create("log/a.json", "1") and not store.create("log/a.json", "2") and store.read("log/a.json") == "1" and store.names("log") == ["a.json"]


def fold(costs, most, budget, envelope, between, per, before):
    out, batch, items, used = [], 0, 0, envelope
    for c in costs:
        more = c + (between if items else 0)
        tokens = used + more if per == 1 else before + max(1, math.ceil((used + more) / per))
        if items and (items + 1 > most or tokens > budget):
            batch, items, used, more = batch + 1, 0, envelope, c
        items, used = items + 1, used + more
        out.append(batch)
    return out


@pytest.mark.parametrize("options", [(4, 60, 0, 2, 1, 0, 10), (3, 50, 10, 1, 4, 20, 7), (9, 1000, 0, 0, 1, 0, 50), (1, 5, 0, 2, 1, 0, 50)])
def test_next_fit_over_chunks(spark, options):
    *rule, chunk = options
    rng = random.Random(chunk)
    parts = {p: [rng.randrange(0, 40) for _ in range(n)] for p, n in ((1, 400), (2, 3), (None, 117), (3, chunk * 2))}
    df = spark.createDataFrame([(p, i, c) for p, costs in parts.items() for i, c in enumerate(costs)], "p int, o int, c int")
    got = defaultdict(list)
    names = dict(zip(("most_items", "budget", "envelope", "between", "per", "before"), rule, strict=True))
    for r in selection.next_fit(df, "p", "o", "c", chunk=chunk, **names).orderBy("o").collect():
        got[r["p"]].append(r["batch"])
    assert got == {p: fold(costs, *rule) for p, costs in parts.items()}


def test_next_fit_of_a_large_shard(spark):
    """A shard of 300,000 items is cut into chunks, and no task has more than one."""
    df = spark.range(300_000).select(F.lit(0).alias("p"), F.col("id").alias("o"), (F.col("id") * 7919 % 97).alias("c"))
    got = [r["batch"] for r in selection.next_fit(df, "p", "o", "c", 8, 300, chunk=20_000).orderBy("o").collect()]
    assert got == fold([i * 7919 % 97 for i in range(300_000)], 8, 300, 0, 2, 1, 0)


def largest(available, targets):
    """The largest total that both margins allow, as a flow."""
    room = Counter({("S", ("a", v)): n for v, n in targets[0].items()} | {(("b", v), "T"): n for v, n in targets[1].items()} | {(("a", a), ("b", b)): n for (a, b), n in available.items()})
    total = 0
    while True:
        came, queue = {"S": None}, deque(["S"])
        while queue:
            u = queue.popleft()
            for (x, y), n in list(room.items()):
                if x == u and n > 0 and y not in came:
                    came[y] = u
                    queue.append(y)
        if "T" not in came:
            return total
        at = "T"
        while came[at]:
            room[came[at], at] -= 1
            room[at, came[at]] += 1
            at = came[at]
        total += 1


def test_fitted_cells():
    rng = random.Random(3)
    for _ in range(60):
        available = {(a, b): rng.randrange(0, 30) for a in "xyz" for b in "pqrs"}
        limit = rng.randrange(1, 120)
        targets = [selection.quotas(limit, {"x": 0.6, "y": 0.25, "z": 0.15}), selection.quotas(limit, {"p": 0.5, "q": 0.35, "r": 0.15})]
        taken = selection.fitted(available, targets)
        assert all(0 <= n <= available[c] for c, n in taken.items()) and sum(taken.values()) == largest(available, targets)
        assert all(sum(n for c, n in taken.items() if c[m] == v) <= target for m in (0, 1) for v, target in targets[m].items())
    plenty = {(a, b, c): 1000 for a in "xy" for b in "pq" for c in "mn"}
    taken = selection.fitted(plenty, [{"x": 60, "y": 40}, {"p": 30, "q": 70}, {"m": 50, "n": 50}])
    assert sum(taken.values()) == 100 and sum(n for c, n in taken.items() if c[1] == "p") == 30


def test_mix(spark):
    df = spark.createDataFrame([(i, "en" if i % 3 else "de", i % 4, "keep") for i in range(400)] + [(900, None, 1, ""), (901, "fr", None, "")], "o int, lang string, band int, _cell string")
    rows, report = selection.mix(df, {"lang": {"en": 0.5, "de": 0.5}, "band": {0: 0.25, 1: 0.75}}, 100, "o")
    got = rows.collect()
    assert rows.columns == df.columns and Counter(r["lang"] for r in got) == {"en": 50, "de": 50} and Counter(r["band"] for r in got) == {0: 25, 1: 75}
    assert all(r["shortfall"] == 0 for r in report.collect()) and len({r["o"] for r in got}) == 100
    cell = [r["o"] for r in got if (r["lang"], r["band"]) == ("en", 1)]
    assert sorted(cell) == [i for i in range(400) if i % 3 and i % 4 == 1][: len(cell)]  # the first of the cell
    _, report = selection.mix(df, {"lang": {"fr": 1.0}, "band": {0: 1.0}}, 10, "o")
    assert {(r["margin"], r["target"], r["got"], r["shortfall"]) for r in report.collect()} == {("lang", 10, 0, 10), ("band", 10, 0, 10)}


def test_longest_run(spark):
    def slow(a, b):
        best = (0, -1)
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
                    k += 1
                best = max(best, (k, i), key=lambda x: x[0]) if k else best
        return best

    rng = random.Random(1)
    rows = [tuple([rng.choice("abcde") for _ in range(rng.randrange(0, 30))] for _ in range(2)) for _ in range(200)]
    rows += [(None, ["a"]), (["a"], None), (["w"] * 3000, ["w"] * 2999), ([str(i) for i in range(3000)], [str(i) for i in range(1500, 4000)])]
    got = spark.createDataFrame(rows, "a array<string>, b array<string>").select("a", "b", tx.longest_run(F.col("a"), F.col("b")).alias("x")).collect()
    assert all((r["x"]["length"], r["x"]["start"]) == slow(r["a"] or [], r["b"] or []) for r in got if len(r["a"] or []) < 100)
    assert {tuple(r["x"]) for r in got if len(r["a"] or []) > 100} == {(2999, 0), (1500, 1500)}


def test_reviews(spark):
    rows = spark.createDataFrame([(1, "a", "p"), (2, "b", "p"), (3, "c", None), (4, "d", None), (5, None, "p"), (6, "e", "p")], "o int, id string, user_prompt_profile string")
    log = [("a", "reject", "dull", 1), ("a", "accept", "", 2), ("b", "accept", "", 1), ("b", "reject", "late", 3), ("b", "reject", "later", 3), ("c", "skip", "", 1), ("x", "accept", "", 1), (None, "accept", None, 1)]
    found = status.reviewed(rows, spark.createDataFrame(log, "id string, decision string, note string, at int"), "o", start=4)
    got = {k: sorted((tuple(r) for r in df.collect()), key=repr) for k, df in found.items()}
    assert got["accepted"] == [(1, "a", "p"), (5, None, "p")] and got["rejected"] == [(2, "b", "p", "later")]
    assert got["remaining"] == [(4, "d", None), (6, "e", "p")] and ("b", "reject", "p", None, "later") in got["reviews"] and len(got["reviews"]) == 3


def test_misassigned_in_blocks(spark):
    """As by all pairs of a batch, whatever the blocks; a batch with a token that all items have is no square."""
    rng = random.Random(9)
    words = [f"topic{a}{b}" for a in "abcdefgh" for b in "klmnop"]
    pick = lambda n: " ".join(["common", *(rng.choice(words) for _ in range(n))])
    rows = [(b, f"{b}-{i}", pick(rng.randrange(0, 6)), None, rng.choice([None, "", pick(rng.randrange(0, 8))])) for b, n in ((0, 60), (1, 1), (None, 5)) for i in range(n)]
    df = spark.createDataFrame(rows, "batch_id int, item_id string, user string, topic string, reply string")
    tokens = df.select("batch_id", "item_id", tx.significant_tokens(F.col("user")).alias("g"), tx.significant_tokens(F.coalesce("reply", F.lit(""))).alias("s")).collect()
    want = {r["item_id"]: (len({*r["s"]} & {*r["g"]}), max([0, *(len({*r["s"]} & {*o["g"]}) for o in tokens if o["batch_id"] == r["batch_id"] and o["item_id"] != r["item_id"])])) for r in tokens}
    for block in (4096, 7, 1):
        assert {r["item_id"]: (r["own"], r["best_other"]) for r in echo.misassigned(df, block).collect()} == want
    many = spark.range(20_000).select(F.lit(1).alias("batch_id"), "id", F.concat(F.lit("common shared "), F.col("id"), F.lit("word token"), F.col("id") % 100).alias("user"))
    items = many.select("batch_id", F.col("id").cast("string").alias("item_id"), "user", F.lit(None).cast("string").alias("topic"), F.col("user").alias("reply"))
    assert echo.misassigned(items).agg(F.count_if("suspicious").alias("n"), F.min("own").alias("own"), F.min("best_other").alias("best")).first() == (0, 4, 3)


def test_shards_of_places(spark):
    for total, shards in ((10, 3), (48, 48), (7, 9), (0, 2), (1000, 48)):
        plan = [r["target"] for r in selection.shard_plan(spark, total, shards, ["x"], 0).orderBy("ix").collect()]
        got = Counter(r["ix"] for r in spark.range(total).select(selection.shard_of(total, shards, F.col("id")).alias("ix")).collect())
        assert [got[i] for i in range(shards)] == plan
