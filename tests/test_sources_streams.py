import datetime as dt

import pytest
from conftest import values
from pyspark.sql import functions as F

from sluice import Condition
from sluice.sources import readers, writers
from sluice.sources.datasets import Dataset, branch_out, merge_by_key
from sluice.streaming import ingest

SCHEMA = "id bigint, name string, n double"


@pytest.fixture
def dataset(spark, tmp_path):
    return Dataset(spark, str(tmp_path / "data"))


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_csv_types(spark, tmp_path):
    path = put(tmp_path / "a.csv", "id,at,day,name\n1,2024-01-05 10:11:12.123456,01/02/2024,x\n2,,,\n")
    df = readers.read_csv(spark, path)
    assert dict(df.dtypes) == {"id": "int", "at": "timestamp_ntz", "day": "string", "name": "string"}
    assert df.first()["at"] == dt.datetime(2024, 1, 5, 10, 11, 12, 123456)
    us = readers.read_csv(spark, path, date_format="US").first()["day"]
    uk = readers.read_csv(spark, path, date_format="UK").first()["day"]
    assert (us, uk) == (dt.datetime(2024, 1, 2), dt.datetime(2024, 2, 1))
    with pytest.raises(ValueError, match="delimiter"):
        readers.read_csv(spark, path, delimiter="~")


def test_csv_skips_lines_of_each_file(spark, tmp_path):
    for name in "ab":
        put(tmp_path / f"{name}.csv", f"junk\nmore\nid;s\n1;'{name};'\n2;'{name}'\n")
    df = readers.read_csv(spark, str(tmp_path), delimiter=";", skip_rows=2, quote="'")
    assert values(df) == [(1, "a;"), (1, "b;"), (2, "a"), (2, "b")]
    bare = readers.read_csv(
        spark, str(tmp_path), delimiter=";", skip_rows=3, quote="'", has_header=False
    )
    assert bare.columns == ["_c0", "_c1"]
    assert bare.count() == 4


def test_folder_with_file_names(spark, tmp_path):
    put(tmp_path / "x" / "a.csv", "id\n1\n")
    put(tmp_path / "x" / "y" / "b.csv", "id\n2\n")
    put(tmp_path / "x" / "c.txt", "id\n3\n")
    df = readers.read_folder(spark, str(tmp_path / "x"), pattern="*.csv")
    name = F.regexp_extract(readers.FILE_COLUMN, "([ab])\\.csv", 1)
    assert values(df.select("id", name)) == [(1, "a"), (2, "b")]


def test_jdbc_options(spark):
    with pytest.raises(ValueError, match="exactly one"):
        readers.read_jdbc(spark, "jdbc:x", table="t", query="select 1")
    with pytest.raises(ValueError, match="bounds"):
        readers.read_jdbc(spark, "jdbc:x", table="t", partition_column="id")


def test_batches(dataset, table):
    one = table([(1, "a", 1.0)], SCHEMA)
    two = table([(2, "b", 2.0)], SCHEMA)
    assert not dataset.exists()
    with pytest.raises(ValueError, match="no dataset"):
        dataset.read()
    dataset.append(one, batch="one")
    dataset.append(two, batch="two")
    dataset.append(two, batch="two")
    assert values(dataset.batches()) == [("one", 1), ("two", 1)]
    dataset.delete(["one"])
    assert values(dataset.read()) == [(2, "b", 2.0)]
    dataset.replace(one)
    assert values(dataset.read()) == [(1, "a", 1.0)]
    dataset.append(table([(5, "e")], "k bigint, s string").withColumn("n", F.lit(0.5)), {
        "k": "id", "s": "name", "n": "n"
    }, change={"s": F.upper("s")})
    assert values(dataset.read()) == [(1, "a", 1.0), (5, "E", 0.5)]
    with pytest.raises(ValueError, match="columns differ"):
        dataset.append(table([(1,)], "id bigint"))
    with pytest.raises(ValueError, match="another type"):
        dataset.append(table([("1", "a", 1.0)], "id string, name string, n double"))


def test_merge(dataset, table):
    old = table([(1, "a", 1.0), (2, "b", 2.0), (None, "n", 0.0)], SCHEMA)
    new = table([(2, "B", 9.0), (2, "B", 8.0), (3, "c", 3.0)], SCHEMA)
    merged = merge_by_key(old, new, ["id"], [["n", "DESC"]])
    want = [(1, "a", 1.0), (2, "B", 9.0), (3, "c", 3.0), (None, "n", 0.0)]
    assert values(merged) == want
    dataset.replace(old)
    dataset.merge(new, ["id"], [["n", "DESC"]])
    assert values(dataset.read()) == want


def test_incremental_pull(dataset, table):
    rows = [(i, str(i), float(i)) for i in range(5)]
    dataset.pull(table(rows[:3], SCHEMA), "id")
    dataset.pull(table(rows, SCHEMA), "id")
    assert values(dataset.read()) == rows
    assert dataset.batches().count() == 2
    dataset.pull(table(rows[:1], SCHEMA), "id", on_refresh="replace")
    assert values(dataset.read()) == rows[:1]


def test_branch_out_splits_into_parts(dataset, table, spark, tmp_path):
    df = table([(i, "x", float(i)) for i in range(9)], SCHEMA)
    low = Condition("n", "LT", 4)
    rest = Dataset(spark, str(tmp_path / "rest"))
    copy = branch_out(df, dataset, condition=low)
    others = branch_out(df, rest, condition=~low)
    assert sorted(values(copy) + values(others)) == values(df)
    renamed = branch_out(df, dataset, column_mapping={"id": "key"})
    assert renamed.columns == ["key"]
    with pytest.raises(ValueError, match="APPEND"):
        branch_out(df, Dataset(spark, str(tmp_path / "none")), mode="APPEND")


@pytest.mark.parametrize("kind", ["csv", "json", "parquet"])
def test_files(spark, table, tmp_path, kind):
    at = dt.datetime(2024, 1, 5, 10, 11, 12, 123456)
    df = table([(1, at, "x")], "id int, at timestamp_ntz, s string")
    path = str(tmp_path / kind)
    writers.write_file(df, path, kind, hidden=["s"])
    back = spark.read.schema("id int, at timestamp_ntz").options(header=True).format(kind).load(path)
    assert values(back) == [(1, at)]
    with pytest.raises(ValueError, match="file_type"):
        writers.write_file(df, path, "xlsx")


def test_database_options():
    given = {"host": "h", "username": "u", "password": "p", "database": "d", "table": "t"}
    assert writers.database_target("redshift", given)["port"] == 5439
    assert writers.database_target("mysql", given | {"port": 1})["port"] == 1
    with pytest.raises(ValueError, match="needs password, table"):
        writers.database_target("mysql", given | {"password": " ", "table": None})
    with pytest.raises(ValueError, match="does not take schema"):
        writers.database_target("mysql", given | {"schema": "x"})
    with pytest.raises(ValueError, match="unknown database"):
        writers.database_target("oracle", given)


def test_tables(spark, table, tmp_path):
    df = table([(1, "a", 1.0), (12, "b", 2.0)], SCHEMA)
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    options = {"partition_column": "id", "interval": 10}
    writers.write_table(df, a, **options)
    writers.write_table(df, a, "COMBINE", **options)
    assert values(spark.read.parquet(a).groupBy(writers.PARTITION).count()) == [(0, 2), (1, 2)]
    writers.write_table(df, a, "REPLACE", **options)
    new = table([(12, "B", 5.0)], SCHEMA)
    writers.write_table(new, b, "UPSERT", ["id"], current=a, **options)
    assert values(spark.read.parquet(b), "id", "name") == [(1, "a"), (12, "B")]
    for bad in (
        lambda: writers.write_table(df, a, "UPSERT", current=b),
        lambda: writers.write_table(df, a, "UPSERT", ["id"], current=a),
        lambda: writers.write_table(df, a, "MERGE"),
        lambda: writers.write_table(df, a, partition_column="id", granularity="DAY"),
        lambda: writers.write_table(df, a, partition_column="id"),
        lambda: writers.request_bodies(df, ["id"], 0),
        lambda: writers.request_bodies(df, ["id"], 10_001),
    ):
        with pytest.raises(ValueError):
            bad()


def test_request_bodies_have_no_gaps(table):
    df = table([(i, "x", None) for i in range(7)], SCHEMA)
    bodies = values(writers.request_bodies(df, ["id"], 3, "a.b"))
    assert [b[:2] for b in bodies] == [(0, 3), (1, 3), (2, 1)]
    assert bodies[2][2] == '{"a":{"b":[{"id":6,"name":"x"}]}}'


def test_conditional_export(table, tmp_path, spark):
    df = table([(1, "a", 1.0), (2, "b", 2.0)], SCHEMA)
    path = str(tmp_path / "out")
    with pytest.raises(ValueError):
        writers.conditional_export(df, path, Condition("x", "EQ", 1), validate_only=True)
    writers.conditional_export(df, path, Condition("n", "GT", 1), validate_only=True)
    assert not (tmp_path / "out").exists()
    writers.conditional_export(df, path, Condition("n", "GT", 1))
    assert spark.read.parquet(path).count() == 1


@pytest.mark.parametrize(
    ("match", "case", "hits"),
    [
        ("contains", True, {"my-sales-1.csv", "sales.csv"}),
        ("contains", False, {"my-sales-1.csv", "sales.csv", "SALES.csv"}),
        ("starts_with", True, {"sales.csv"}),
        ("ends_with", True, set()),
        ("exact", True, set()),
    ],
)
def test_name_patterns(table, match, case, hits):
    names = ["my-sales-1.csv", "sales.csv", "SALES.csv", "sales/other.csv"]
    df = table([(f"file:/in/{n}",) for n in names], "f string")
    pattern = ingest.name_pattern("sales", match, case)
    found = {r.f.removeprefix("file:/in/") for r in df.filter(F.col("f").rlike(pattern)).collect()}
    assert found == hits


def test_pushed_rows(spark, dataset, tmp_path):
    landing, progress = tmp_path / "in", str(tmp_path / "progress")

    def run(mode="combine"):
        ingest.land_pushed_rows(spark, str(landing), SCHEMA, dataset, progress, mode)
        return values(dataset.read())

    put(landing / "1.json", '{"id":1,"name":"a","n":1}\n')
    assert run() == [(1, "a", 1.0)]
    assert run() == [(1, "a", 1.0)]
    put(landing / "2.json", '{"id":2,"name":"b","n":2}\n')
    assert run() == [(1, "a", 1.0), (2, "b", 2.0)]
    put(landing / "3.json", '{"id":3,"name":"c","n":3}\n')
    assert run("replace") == [(3, "c", 3.0)]


def test_consolidation_sets_bad_rows_aside(spark, dataset, tmp_path):
    from pyspark.sql import types as T

    schema = T._parse_datatype_string("id bigint, n double")
    landing = tmp_path / "in"
    put(landing / "sales 1.csv", "id,n\n1,1.5\nx,2\n")
    put(landing / "sub" / "sales2.csv", "id,n\n2,2.5\n")
    put(landing / "other.csv", "id,n\n9,9\n")
    options = {"name": "sales", "match": "starts_with", "quarantine": str(tmp_path / "aside")}
    ingest.consolidate_files(
        spark, str(landing), schema, dataset, str(tmp_path / "p"), **options
    )
    assert values(dataset.read()) == [(1, 1.5), (2, 2.5)]
    aside = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "aside"))
    assert values(aside, "_corrupt_record") == [("x,2",)]


def test_refresh_and_merge_streams(spark, dataset, table, tmp_path):
    landing = str(tmp_path / "in")
    merged = Dataset(spark, str(tmp_path / "merged"))
    waves = [[(1, "a", 1.0), (2, "b", 2.0)], [(1, "A", 1.0), (2, "B", 2.0), (3, "c", 3.0)]]
    for wave in waves:
        table(wave, SCHEMA).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(SCHEMA).parquet(landing)
        ingest.refresh(stream, dataset, str(tmp_path / "p1"), "id")
        ingest.merge_increments(stream, merged, str(tmp_path / "p2"), ["id"], [["n", "DESC"]])
    assert values(dataset.read()) == [(1, "a", 1.0), (2, "b", 2.0), (3, "c", 3.0)]
    assert values(merged.read()) == [(1, "A", 1.0), (2, "B", 2.0), (3, "c", 3.0)]


def test_merge_rewrites_no_batch(dataset, table):
    for batch, ids in (("a", (1, 2)), ("b", (3, 4)), ("c", (5,))):
        dataset.append(table([(i, batch, 0.0) for i in ids], SCHEMA), batch=batch)
    before = dataset._state().folders
    merged = dataset.merge(table([(4, "new", 1.0), (5, "new", 1.0), (6, "new", 1.0)], SCHEMA), ["id"])
    after = dataset._state().folders
    assert after == {**before, merged: after[merged]}
    assert values(dataset.read(), "id", "name") == [
        (1, "a"), (2, "a"), (3, "b"), (4, "new"), (5, "new"), (6, "new")
    ]
    dataset.delete(["a"])
    assert dataset._state().folders == {b: f for b, f in after.items() if b != "a"}
    dataset.delete(["b", "c", merged])
    assert dataset.read().count() == 0
    assert dataset.read().columns == ["id", "name", "n"]
    with pytest.raises(ValueError, match="batch name"):
        dataset.append(table([(1, "a", 0.0)], SCHEMA), batch="a/b")


ODD = [(1, "a\nb", "x"), (2, 'say "hi", you', ""), (3, None, "\\"), (4, "", '"'), (5, " lead, ", 'a\\"b'), (6, '5" pipe', 'q"')]


def test_csv_reads_back_what_was_written(spark, table, tmp_path):
    path = str(tmp_path / "odd")
    writers.write_file(table(ODD, "id int, t string, u string"), path)
    assert values(readers.read_csv(spark, path, multiline=True)) == sorted(ODD, key=repr)
    folder = readers.read_folder(spark, path, pattern="*.csv", multiLine=True)
    assert values(folder.drop(readers.FILE_COLUMN)) == sorted(ODD, key=repr)
    with pytest.raises(ValueError, match="multiline"):
        readers.read_csv(spark, path)
    with pytest.raises(ValueError, match="multiline"):
        readers.read_folder(spark, path, pattern="*.csv")


def test_csv_quotes_inside_plain_cells(spark, tmp_path):
    path = put(tmp_path / "a.csv", 'id,t\n1,5" pipe\n2,"x ""y"" z"\n3,a "b" c\n')
    assert values(readers.read_csv(spark, path)) == [(1, '5" pipe'), (2, 'x "y" z'), (3, 'a "b" c')]


def test_csv_skips_lines_before_records_with_line_ends(spark, tmp_path):
    for name in "ab":
        put(tmp_path / "s" / f"{name}.csv", f'made by\nnobody\nid,"t\nu"\n1,"x\n{name}"\n2,""\n')
    df = readers.read_csv(spark, str(tmp_path / "s"), skip_rows=2, multiline=True)
    assert df.columns[0] == "id" and df.columns[1].split() == ["t", "u"]


def test_two_writers_lose_nothing(spark, table, tmp_path):
    root = str(tmp_path / "shared")
    one, two = Dataset(spark, root), Dataset(spark, root)
    one.append(table([(0, "z", 0.0)], SCHEMA), batch="zero")
    before = two._state()
    two._state = lambda: states.pop(0) if states else Dataset._state(two)
    states = [before, before]  # what the second writer saw before the first one's change
    one.append(table([(1, "a", 1.0)], SCHEMA), batch="one")
    two.append(table([(2, "b", 2.0)], SCHEMA), batch="two")
    assert values(one.read()) == [(0, "z", 0.0), (1, "a", 1.0), (2, "b", 2.0)]


def test_log_is_written_anew_from_time_to_time(spark, table, tmp_path, monkeypatch):
    from sluice.sources import datasets

    monkeypatch.setattr(datasets, "_SNAPSHOT", 3)
    target = Dataset(spark, str(tmp_path / "many"))
    for k in range(7):
        target.append(table([(k, "x", 1.0)], SCHEMA), batch=f"b{k}")
    target.delete(["b0"])
    assert [n for n, whole, _ in target._files() if whole] == [3, 6]
    assert sorted(r["id"] for r in target.read().collect()) == [1, 2, 3, 4, 5, 6]


def test_changes_need_a_dataset_and_its_batches(table, dataset):
    rows = table([(1, "a", 1.0)], SCHEMA)
    with pytest.raises(ValueError, match="no dataset"):
        dataset.delete(["x"])
    with pytest.raises(ValueError, match="no dataset"):
        dataset.merge(rows, ["id"])
    dataset.append(rows, batch="a")
    with pytest.raises(ValueError, match="no batches"):
        dataset.delete(["b"])


def test_merging_null_keys_again_changes_nothing(table, dataset):
    dataset.append(table([(None, "a", 1.0), (1, "b", 1.0)], SCHEMA), batch="a")
    for _ in range(2):
        dataset.merge(table([(None, "c", 2.0)], SCHEMA), ["id"])
    assert values(dataset.read()) == [(1, "b", 1.0), (None, "c", 2.0)]
    merged = merge_by_key(dataset.read(), table([(None, "d", 3.0)], SCHEMA), ["id"])
    assert values(merged) == [(1, "b", 1.0), (None, "d", 3.0)]
