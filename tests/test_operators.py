import random
import time
from functools import partial

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from pcmarts.operators import ranks, shapes
from pcmarts.operators.ingest import KeyIndex, latest_per_key, merge_new, unseen
from pcmarts.operators.jobs import side_by_side
from pcmarts.operators.quality import DROP, Rule, enforce, report
from pcmarts.sources.tables import exists, versions


@pytest.mark.parametrize("size", [shapes.LIST, 2])
def test_with_every_is_the_product(spark, rows, monkeypatch, size):
    monkeypatch.setattr(shapes, "LIST", size)
    left = spark.createDataFrame([(i % 3, f"e{i}") for i in range(7)], "k int, e string")
    right = spark.createDataFrame([(f"s{i}", float(i)) for i in range(5)], "s string, v double")
    expected = sorted([(i % 3, f"e{i}", f"s{j}", float(j)) for i in range(7) for j in range(5)], key=repr)
    assert rows(shapes.with_every(left, right)) == expected


def test_with_every_of_nothing(spark):
    left = spark.createDataFrame([(1,)], "k int")
    empty = spark.createDataFrame([], "s string")
    assert shapes.with_every(left, empty).count() == 0
    assert shapes.with_every(empty, left).count() == 0


def test_mentions_equals_brute_force(spark, rows):
    rng = random.Random(7)
    texts = [" ".join(rng.choice(["NATION_1", "NATION_10", "N01", "N10", "TX", "Texas", "x"]) for _ in range(rng.randint(0, 4))) for _ in range(60)]
    texts += [None, "", "NATION_1", "NATION_1"]  # equal rows stay two rows
    names = [("N01", "NATION_1"), ("N10", "NATION_10"), ("TX", "Texas"), ("XX", None), (None, "x"), ("TXT", "TX")]
    left = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    right = spark.createDataFrame(names, "code string, name string")
    expected = [
        (i, t, c, n) for i, t in enumerate(texts) if t is not None for c, n in names
        if (n is not None and n in t) or (c is not None and c in t)
    ]
    got = shapes.mentions(left, "t", right, "name", "code").select("i", "t", "code", "name")
    assert rows(got) == sorted(expected, key=repr)


def test_a_long_text_meets_names_in_one_pass(spark):
    """200 KB of text and 25 names of different lengths: as many substrings as the text is long, not that times the lengths."""
    rng = random.Random(1)
    letters = "abcdefghij klmnop,.;-ABCDE"
    names = [("".join(rng.choice(letters) for _ in range(2 + k)), "".join(rng.choice("XYZAB") for _ in range(1 + k % 3))) for k in range(25)]
    names += [names[0], (None, "X"), ("X", None), ("", "Q"), (None, None), ("\n.", "😀")]  # equal names stay two rows
    long = "".join(rng.choice(letters) for _ in range(200_000)) + names[20][0]
    texts = [long, long[:500], None, "", f"é{names[3][0]}😀X", "a\n.b"]
    left = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    right = spark.createDataFrame(names, "name string, code string")
    got = shapes.mentions(left, "t", right, "name", "code").select("i", "name", "code")
    want = [(i, a, b) for i, t in enumerate(texts) if t is not None for a, b in names if (a is not None and a in t) or (b is not None and b in t)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    start = time.monotonic()
    got.count()
    assert time.monotonic() - start < 20  # the substrings of all lengths took minutes


@pytest.mark.parametrize("ranges", [1, 4, 13, 64])
def test_ranks_of_a_hot_group(spark, rows, tmp_path, ranges):
    rng = random.Random(ranges)
    data = [(rng.choice(["hot"] * 8 + ["a", None]), v, rng.randint(1, 5)) for v in rng.sample(range(-10_000, 10_000), 900)]
    data += [("one", 7, 1), ("a", None, 2)]
    ranged = ranks.dealt(spark.createDataFrame(data, "g string, v int, n int"), str(tmp_path / "r"), "g", "v", ranges)
    assert ranged.count() == len(data) and ranged.select(ranks.RANGE).distinct().count() <= ranges
    groups = {}
    for g, v, n in sorted(data, key=lambda r: (r[1] is not None, r[1] or 0)):
        groups.setdefault(g, []).append((v, n))
    want = []
    for g, cells in groups.items():
        upto = 0
        for v, n in cells:
            upto += n
            want.append((g, v, n, upto, sum(m for _, m in cells)))
    assert rows(ranks.cumulated(ranged, "g", "v", F.col("n")), "g", "v", "n", "upto", "all") == sorted(want, key=repr)
    for share in (0, 50, 95, 100):
        least = {g: next(v for v, upto in ((r[1], r[3]) for r in want if r[0] == g) if upto >= max(1, -(-share * sum(n for _, n in c) // 100))) for g, c in groups.items()}
        assert rows(ranks.at_share(ranged, "g", "v", F.col("n"), share), "g", "v") == sorted(least.items(), key=repr)


def test_jobs_side_by_side():
    done = []

    def job(k):
        if k == 1:
            raise ValueError("one fails")
        done.append(k)
        return k

    assert side_by_side({str(k): partial(job, k) for k in (3, 0, 2)}) == {"3": 3, "0": 0, "2": 2}
    with pytest.raises(ValueError, match="one fails"):
        side_by_side({str(k): partial(job, k) for k in range(4)})
    assert sorted(done) == [0, 0, 2, 2, 3, 3] and side_by_side({}) == {}


def test_stack_fills_missing_columns(spark, rows):
    a = spark.createDataFrame([(1, "x")], "n int, a string")
    b = spark.createDataFrame([(2, 0.5)], "n int, b double")
    assert rows(shapes.stack(a, b)) == [(1, "x", None), (2, None, 0.5)]


RULES = (Rule("key", "k IS NOT NULL", DROP), Rule("lat", "lat BETWEEN -90 AND 90"))


def quality_rows(spark):
    return spark.createDataFrame([(1, -91.0), (2, 90.0), (3, None), (None, 10.0)], "k int, lat double")


def test_drop_rule_removes_and_warn_rule_keeps(spark, rows):
    seen = Observation("quality_test")
    kept = enforce(quality_rows(spark), RULES, seen)
    assert rows(kept, "k") == [(1,), (2,), (3,)]
    assert seen.get == {"rows": 4, "key__failed": 1, "lat__failed": 2}  # NULL breaks a rule


def test_report_counts_before_dropping(spark, rows):
    assert rows(report({"t": (quality_rows(spark), RULES)})) == [("t", "key", "drop", 3, 1), ("t", "lat", "warn", 2, 2)]


def test_latest_per_key_is_deterministic(spark, rows):
    data = [("a", "2024-01-01", "old"), ("a", "2024-01-02", "new"), ("b", "2024-01-01", "x"), ("b", "2024-01-01", "y")]
    df = spark.createDataFrame(data, "k string, fetched_at_utc string, v string")
    want = [("a", "2024-01-02", "new"), ("b", "2024-01-01", "y")]
    assert rows(latest_per_key(df, "k")) == want
    assert rows(latest_per_key(df.repartition(4).orderBy(F.rand(3)), "k")) == want


def test_merge_new_is_idempotent(spark, rows, tmp_path):
    target, rejected = str(tmp_path / "t"), str(tmp_path / "r")
    schema = "k string, fetched_at_utc string, v int"
    first = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("b", "1", 3), (None, "1", 9)], schema)
    c = merge_new(spark, first, target, "k", rejected)
    assert (c.scanned, c.rejected, c.appended, c.total) == (4, 1, 2, 2)
    c = merge_new(spark, first, target, "k", rejected)
    assert (c.appended, c.total) == (0, 2)
    second = spark.createDataFrame([("b", "9", 99), ("c", "1", 4)], schema)  # b is known: never updated
    c = merge_new(spark, second, target, "k", rejected)
    assert (c.appended, c.total) == (1, 3)
    assert rows(spark.read.parquet(target)) == [("a", "2", 2), ("b", "1", 3), ("c", "1", 4)]
    assert spark.read.parquet(rejected).count() == 2
    empty = merge_new(spark, first.limit(0), target, "k", rejected)
    assert (empty.scanned, empty.appended, empty.total) == (0, 0, 3)


def test_merge_of_nothing_creates_the_table(spark, tmp_path):
    target = str(tmp_path / "t")
    assert not exists(spark, target)
    merge_new(spark, spark.createDataFrame([], "k string, v int"), target, "k", str(tmp_path / "rejected"))
    assert spark.read.parquet(target).columns == ["k", "v"]


def test_unseen_with_a_hot_target_key(spark, rows):
    target = spark.createDataFrame([("hot",)] * 1000 + [("a",)], "k string")
    batch = spark.createDataFrame([("hot", 1), ("new", 2)], "k string, v int")
    assert rows(unseen(batch, target, "k")) == [("new", 2)]


def _index_after(spark, tmp_path, batches):
    target = str(tmp_path / "t")
    schema = "k string, fetched_at_utc string, v int"
    counts = [merge_new(spark, spark.createDataFrame(b, schema), target, "k", str(tmp_path / "r")) for b in batches]
    return target, schema, counts


def test_merge_reads_the_buckets_of_the_batch_only(spark, tmp_path):
    target, schema, _ = _index_after(spark, tmp_path, [[(f"k{i}", "1", i) for i in range(300)]])
    index = KeyIndex(spark, target, "k")
    spark.createDataFrame([("k7", "2", 0), ("new", "2", 0)], schema).write.parquet(str(tmp_path / "batch"))
    batch = spark.read.parquet(str(tmp_path / "batch"))
    fresh = index.unseen(batch)
    text = fresh._jdf.queryExecution().executedPlan().toString()
    filters = [line.split("PartitionFilters: [")[1].split("]")[0] for line in text.splitlines() if "FileScan" in line]
    assert [f for f in filters if "_bucket" in f and " IN " in f]
    assert not [f for f in fresh.inputFiles() if f.startswith(f"file://{target}/")]  # the table itself is not read
    read = [f for f in fresh.inputFiles() if "t_keys" in f]
    assert {f.split("/")[-2] for f in read} <= {f"_bucket16={k}" for k in range(16)} and len(index.held().inputFiles()) == 16
    assert index.held([3]).select(F.input_file_name()).distinct().count() == 1
    assert [r.k for r in fresh.collect()] == ["new"]


@pytest.mark.parametrize("step", ["_to_target", "_to_keys", "_note", "_log"])
@pytest.mark.parametrize("late", [False, True])
def test_an_interrupted_merge_is_finished_by_the_next(spark, rows, tmp_path, monkeypatch, step, late):
    target, schema, _ = _index_after(spark, tmp_path, [[("a", "1", 1)]])
    real = getattr(KeyIndex, step)

    def crash(self, *args):
        if late:
            real(self, *args)
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(KeyIndex, step, crash)
        with pytest.raises(OSError):
            _index_after(spark, tmp_path, [[("a", "2", 0), ("b", "2", 2), ("c", "2", 3)]])
    _, _, (c,) = _index_after(spark, tmp_path, [[("c", "3", 9), ("d", "3", 4)]])
    assert (c.appended, c.total) == (1, 4)
    assert rows(spark.read.parquet(target).select("k", "v")) == [("a", 1), ("b", 2), ("c", 3), ("d", 4)]
    assert KeyIndex(spark, target, "k").held().count() == 4


def test_an_index_is_made_for_an_old_table_and_compacted(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    spark.createDataFrame([("a", "1", 1), (None, "1", 2)], "k string, fetched_at_utc string, v int").write.parquet(target)
    monkeypatch.setattr(KeyIndex, "COMPACT_AFTER", 3)
    monkeypatch.setattr(KeyIndex, "BUCKETS", 2)
    monkeypatch.setattr(KeyIndex, "BUCKET_ROWS", 1)  # the compacted version has as many buckets as its keys fill
    _, _, counts = _index_after(spark, tmp_path, [[("a", "2", 0), (f"n{i}", "2", i)] for i in range(5)])
    assert [(c.appended, c.total) for c in counts] == [(1, 3 + i) for i in range(5)]
    assert len(versions(spark, f"{target}_keys/runs")) == 2 and KeyIndex(spark, target, "k").held().count() == 6
    assert KeyIndex(spark, target, "k").bucket == "_bucket8"
