"""Merges that name replaced rows instead of rewriting them."""

import random

import pytest
from conftest import values

from sluice.sources import datasets
from sluice.sources.datasets import Dataset, merge_by_key

SCHEMA = "id long, name string, n int"


@pytest.fixture
def dataset(spark, tmp_path):
    return Dataset(spark, str(tmp_path / "d"))


def files(dataset):
    return {r[0] for r in dataset.read(True).select("_metadata.file_path").distinct().collect()}


def ranged(dataset, table, batches=6, rows=50):
    """Batches that hold ranges of keys of their own."""
    for b in range(batches):
        dataset.append(table([(b * 1000 + k, f"b{b}", k) for k in range(rows)], SCHEMA).coalesce(2), batch=f"b{b}")


def test_reads_only_files_that_may_match_and_writes_only_changed_rows(spark, dataset, table):
    ranged(dataset, table)
    before = dataset._state()
    new = table([(3005, "new", 0), (3006, "new", 0), (9999, "new", 0)], SCHEMA)
    want = values(merge_by_key(dataset.read(), new, ["id"]))
    # ranges are taken once, then a merge looks at the files of one batch
    merged = dataset.merge(new, ["id"])
    after = dataset._state()
    assert values(dataset.read()) == want
    assert {b: s.folder for b, s in after.batches.items() if b != merged} == before.folders
    assert [b for b, s in after.batches.items() if s.deleted] == ["b3"]
    assert spark.read.parquet(f"{dataset.root}/{after.batches[merged].folder}").count() == 3
    assert spark.read.parquet(f"{dataset.root}/{after.batches['b3'].deleted[0]}").count() == 2
    taken = [s.ranges["id"] for b, s in after.batches.items() if b != merged]
    found = dataset.candidates(table([(1005,), (1020,)], "id long"), "id", taken)
    assert found and all("=b1/" in f for f in found)
    assert dataset.candidates(table([(77_777,), (500,)], "id long"), "id", taken) == []
    # the second merge takes the ranges of the new batch only
    dataset.merge(table([(1001, "again", 1)], SCHEMA), ["id"])
    assert all(s.ranges["id"] == after.batches[b].ranges["id"] for b, s in dataset._state().batches.items() if b in after.batches and b != merged)


def test_merged_files_are_not_scanned(dataset, table, monkeypatch):
    ranged(dataset, table)
    dataset.merge(table([(1, "x", 1)], SCHEMA), ["id"])
    seen = []
    whole = Dataset._scan

    def scan(self, state, paths):
        seen.extend(paths)
        return whole(self, state, paths)

    monkeypatch.setattr(Dataset, "_scan", scan)
    dataset.merge(table([(4010, "y", 1)], SCHEMA), ["id"])
    rows = [p for p in seen if p.endswith(".parquet")]
    assert rows and all("=b4/" in p for p in rows)


@pytest.mark.parametrize("seed", range(3))
def test_many_merges_equal_the_full_rewrite(spark, dataset, table, seed, monkeypatch):
    monkeypatch.setattr(datasets, "_SNAPSHOT", 4)
    rng = random.Random(seed)
    kinds = "id long, g string, n int"

    def some(n, version):
        rows = {}
        for _ in range(n):
            key = (rng.choice([None, *range(30)]), rng.choice(["a", "b", None]))
            rows[key] = (*key, version)
        return table(list(rows.values()), kinds)

    content = some(25, 0)
    dataset.append(content, batch="first")
    want = content.collect()
    for version in range(1, 7):
        new = some(rng.choice([1, 5, 20]), version)
        rows = {(r["id"], r["g"]): tuple(r) for r in want} | {(r["id"], r["g"]): tuple(r) for r in new.collect()}
        dataset.merge(new, ["id", "g"])
        want = table(list(rows.values()), kinds).collect()
        if version == 3:
            assert dataset.compact() and not any(s.deleted for s in dataset._state().batches.values())
        if version == 5:
            dataset.compact(list(dataset._state().batches), key="id")
        assert values(dataset.read()) == sorted([tuple(r) for r in want], key=repr)


def test_compact_by_key_narrows_the_ranges(dataset, table):
    rows = [(k, "x", 0) for k in range(4000)]
    random.Random(1).shuffle(rows)
    dataset.append(table(rows, SCHEMA).repartition(4), batch="all")
    dataset.merge(table([(5, "y", 1)], SCHEMA), ["id"])
    wide = [s.ranges["id"] for b, s in dataset._state().batches.items() if b == "all"]
    assert len(dataset.candidates(table([(70,)], "id long"), "id", wide)) == 4
    before = values(dataset.read())
    dataset.compact(["all"], key="id", file_bytes=4000)
    assert values(dataset.read()) == before
    dataset.merge(table([(3999, "z", 1)], SCHEMA), ["id"])
    narrow = [s.ranges["id"] for b, s in dataset._state().batches.items() if b == "all"]
    assert len(dataset.candidates(table([(70,)], "id long"), "id", narrow)) == 1
    assert dataset.read().count() == 4000 and dataset.compact(["all"]) == ["all"]


def test_text_keys_and_replaced_batches(dataset, table):
    dataset.append(table([(1, "a", 1), (2, "b", 1)], SCHEMA), batch="x")
    dataset.merge(table([(9, "b", 2)], SCHEMA), ["name"])
    assert values(dataset.read()) == [(1, "a", 1), (9, "b", 2)]
    # a batch that is written again starts without deletions
    dataset.append(table([(3, "b", 3)], SCHEMA), batch="x")
    assert values(dataset.read()) == [(3, "b", 3), (9, "b", 2)]
    with pytest.raises(ValueError, match="no batches"):
        dataset.compact(["nothing"])


def test_a_conflicting_change_is_merged_again(dataset, table, monkeypatch):
    dataset.append(table([(1, "a", 1)], SCHEMA), batch="x")
    whole = Dataset._record
    turns = []

    def record(self, state, schema, entries):
        if not turns:
            turns.append(1)
            Dataset(self.spark, self.root).append(table([(1, "late", 5), (2, "late", 5)], SCHEMA), batch="y")
        return whole(self, state, schema, entries)

    monkeypatch.setattr(Dataset, "_record", record)
    dataset.merge(table([(1, "m", 9)], SCHEMA), ["id"])
    assert values(dataset.read()) == [(1, "m", 9), (2, "late", 5)]
