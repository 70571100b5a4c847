"""Aggregates kept by increments equal those of all rows, after updates, deletes, repeats and restarts."""

import random

import pytest
from conftest import values

from sluice import Condition
from sluice.operators.aggregate import Aggregation, pivot
from sluice.operators.windows import top_per_group
from sluice.sources.datasets import Dataset
from sluice.streaming import ingest
from sluice.streaming.incremental import KeptPivot, KeptTop, deleted_increment, merged_increment

SCHEMA = "id long, g string, h int, v int, x double"
GROUPS = ["g", "h"]
AGGREGATIONS = [
    Aggregation("v", "SUM", "total"),
    Aggregation("v", "COUNT", "n"),
    Aggregation("v", "AVG", "mean"),
    Aggregation("v", "MIN", "low"),
    Aggregation("v", "MAX", "high"),
    Aggregation("g", "COUNT_DISTINCT", "kinds"),
    Aggregation("v", "COUNT_DISTINCT", "some", condition=Condition("x", "GT", 0.5)),
    Aggregation("v", "MEDIAN", "middle"),
    Aggregation("v", "STDDEV", "spread"),
]


def some(rng, n, first=0):
    return [(first + k, rng.choice(["a", "b", None]), rng.choice([1, 2, None]), rng.choice([None, *range(6)]), rng.random()) for k in range(n)]


def rounded(df):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=repr)


def opened(spark, root, groups=GROUPS):
    return KeptPivot(spark, f"{root}/pivot", groups, AGGREGATIONS), KeptTop(spark, f"{root}/top", 3, ["g"], [["v", "DESC"], "id"])


def check(target, kept, groups=GROUPS):
    rows = target.read()
    assert rounded(kept[0].result()) == rounded(pivot(rows, groups, AGGREGATIONS))
    assert rounded(kept[1].result()) == rounded(top_per_group(rows, 3, ["g"], [["v", "DESC"], "id"]))


def test_updates_deletes_repeats_and_restarts(spark, table, tmp_path):
    rng = random.Random(1)
    target, root = Dataset(spark, str(tmp_path / "t")), str(tmp_path / "kept")
    steps = [some(rng, 40), some(rng, 25, 20), some(rng, 10, 5), some(rng, 1, 1000)]
    for k, rows in enumerate(steps):
        # new objects each time, and every increment twice
        for _ in range(2):
            kept = opened(spark, root)
            merged_increment(target, table(rows, SCHEMA), ["id"], [["x", "DESC"]], kept, f"epoch-{k}")
        check(target, opened(spark, root))
    for _ in range(2):
        deleted_increment(target, lambda df: (df["g"] == "a") | (df["v"] == 5), opened(spark, root), "gone")
    check(target, opened(spark, root))
    for one in opened(spark, root):
        one.fold()
    check(target, opened(spark, root))
    assert len(Dataset(spark, f"{root}/pivot/sums").names()) == 2
    merged_increment(target, table(some(rng, 30, 10), SCHEMA), ["id"], [["x", "DESC"]], opened(spark, root), "epoch-9")
    check(target, opened(spark, root))


def test_failure_between_state_and_merge(spark, table, tmp_path, monkeypatch):
    rng = random.Random(2)
    target, root = Dataset(spark, str(tmp_path / "t")), str(tmp_path / "kept")
    merged_increment(target, table(some(rng, 30), SCHEMA), ["id"], [["x", "DESC"]], opened(spark, root), "epoch-0")
    rows = table(some(rng, 20, 10), SCHEMA)
    whole = Dataset.merge

    def fail(*args, **kwargs):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(Dataset, "merge", fail)
    with pytest.raises(RuntimeError):
        merged_increment(target, rows, ["id"], [["x", "DESC"]], opened(spark, root), "epoch-1")
    monkeypatch.setattr(Dataset, "merge", whole)
    merged_increment(target, rows, ["id"], [["x", "DESC"]], opened(spark, root), "epoch-1")
    check(target, opened(spark, root))


def test_whole_table_and_condition(spark, table, tmp_path):
    rng = random.Random(3)
    kept = KeptPivot(spark, str(tmp_path / "k"), [], AGGREGATIONS, Condition("v", "GT", 1))
    rows = [some(rng, 30), some(rng, 30, 50)]
    for k, part in enumerate(rows):
        kept.apply(f"e{k}", table(part, SCHEMA))
    want = pivot(table(rows[0] + rows[1], SCHEMA), [], AGGREGATIONS, Condition("v", "GT", 1))
    assert rounded(kept.result()) == rounded(want)
    kept.apply("e2", table([], SCHEMA), table(rows[1], SCHEMA))
    assert rounded(kept.result()) == rounded(pivot(table(rows[0], SCHEMA), [], AGGREGATIONS, Condition("v", "GT", 1)))


def test_top_of_rows_that_never_go(spark, table, tmp_path):
    rng = random.Random(4)
    kept = KeptTop(spark, str(tmp_path / "k"), 2, ["g"], ["v", "id"], goes=False)
    everything = []
    for k in range(3):
        everything += some(rng, 20, 100 * k)
        kept.apply(f"e{k}", table(everything[-20:], SCHEMA))
    assert rounded(kept.result()) == rounded(top_per_group(table(everything, SCHEMA), 2, ["g"], ["v", "id"]))
    # a state holds the first rows only
    assert Dataset(spark, str(tmp_path / "k" / "rows")).read().count() <= 3 * 3 * 2
    with pytest.raises(ValueError, match="goes"):
        kept.apply("e4", table([], SCHEMA), table([], SCHEMA))


def test_equal_rows_count(spark, table, tmp_path):
    kept = KeptTop(spark, str(tmp_path / "k"), 2, ["g"], ["v"])
    row = (1, "a", 1, 1, 0.5)
    kept.apply("e0", table([row, row, row], SCHEMA))
    kept.apply("e1", table([(2, "a", 1, 3, 0.5)], SCHEMA), table([row], SCHEMA))
    assert values(kept.result()) == [row, row]
    kept.apply("e2", table([], SCHEMA), table([row], SCHEMA))
    assert values(kept.result()) == [row, (2, "a", 1, 3, 0.5)]


def test_stream_of_steps(spark, table, tmp_path):
    target, kept = Dataset(spark, str(tmp_path / "t")), opened(spark, str(tmp_path / "k"), ["g"])
    rng = random.Random(5)
    for k in range(2):
        table(some(rng, 20, 100 * k), SCHEMA).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
        ingest.run_steps(stream, lambda df: df.filter("id % 2 = 0"), target, str(tmp_path / "p"), kept=kept)
    check(target, opened(spark, str(tmp_path / "k"), ["g"]), ["g"])


def test_errors(spark):
    with pytest.raises(ValueError, match="kept by increments"):
        KeptPivot(spark, "x", ["g"], [Aggregation("v", "CONCAT", "all")])
