"""CSV with line ends in quoted cells: files in many splits equal the read in one task."""

import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from sluice.sources import readers
from sluice.sources.quoted import _states, open_after, records


@pytest.fixture
def tiny_splits(spark):
    """Splits of a few bytes, so that an edge lies in nearly every cell."""
    names = {"spark.sql.files.maxPartitionBytes": "24", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def one_task(spark, path, **options):
    """Spark's own read, where a file is one task."""
    reader = spark.read.options(header=True, **{**readers.csv_options(multiline=True), **options})
    return reader.schema("a string, b string, c string").csv(path)


def written(path, rows, end="\n", header="a,b,c"):
    path.mkdir(exist_ok=True)
    for k, part in enumerate(rows):
        (path / f"f{k}.csv").write_bytes((end.join([header, *part]) + end).encode())
    return str(path)


def some_row(rng):
    cells = []
    for _ in range(3):
        cells.append(
            rng.choice(
                ["", "x", "plain text", '"quoted"', '"a ""b"" c"', '"line\nend"', '"\n"', '"x,\n\ny"', '""', '"""\n"""', 'say "hi"', '5" pipe', ' "sp', "é日本", '"' + "long " * 9 + '\n"']
            )
        )
    return ",".join(cells)


def test_effects_of_lines(spark):
    cases = {
        "a,b": (False, True), '"a': (True, False), '"a"': (False, False), 'a"b': (False, False), '"a""': (True, False), '"a"",b': (True, False),
        '""': (False, True), '"""': (True, False), ',"x': (True, False), 'x"': (False, False), 'x","y': (True, True), 'x""': (False, True), "": (False, True),
        '"a"b,"c': (True, True), ' "a': (False, False),
    }
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = df.select("v", open_after(F.col("v"), ",", '"', False), open_after(F.col("v"), ",", '"', True)).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == cases
    long = '"' + "x" * 200_000 + '""' * 50_000
    assert spark.createDataFrame([(long,)], "v string").select(open_after(F.col("v"), ",", '"', False)).first()[0]


def test_states_compose():
    import numpy as np

    rng = random.Random(2)
    for _ in range(300):
        effect = np.array([rng.randrange(4) for _ in range(rng.randrange(0, 12))], np.int8)
        for begin in (False, True):
            state, want = begin, []
            for e in effect:
                want.append(state)
                state = bool(e >> state & 1) if e != 2 else state
                if e == 1:
                    state = not want[-1]
            got, after = _states(effect, begin)
            assert got.tolist() == want and after == state


@pytest.mark.parametrize("seed", range(4))
def test_many_splits_equal_one_task(spark, tmp_path, tiny_splits, seed):
    rng = random.Random(seed)
    path = written(tmp_path / "in", [[some_row(rng) for _ in range(rng.choice([1, 12, 25]))] for _ in range(2)])
    want = values(one_task(spark, path))
    assert records(lambda: spark.read, path, ",", '"').rdd.getNumPartitions() > 1
    assert values(readers.read_csv(spark, path, schema="a string, b string, c string", multiline=True)) == want


def test_a_cell_over_many_splits(spark, tmp_path, tiny_splits):
    cell = "\n".join(f"line {k}, with ""quotes""" for k in range(60))
    path = written(tmp_path / "in", [[f'1,"{cell}",z', '2,"",y', f'3,x,"{cell}"']])
    assert values(readers.read_csv(spark, path, schema="a string, b string, c string", multiline=True)) == values(one_task(spark, path))


def test_types_names_and_skipped_lines(spark, tmp_path, tiny_splits):
    path = written(tmp_path / "in", [['1,"a\nb",2024-01-02 03:04:05', '2,"c",2024-01-03 00:00:00']], header='id,"na\nme",at')
    df = readers.read_csv(spark, path, multiline=True)
    assert df.columns == ["id", "na\nme", "at"]
    assert [f.dataType.simpleString() for f in df.schema] == ["int", "string", "timestamp_ntz"]
    assert sorted(r[1] for r in df.collect()) == ["a\nb", "c"]
    skipped = written(tmp_path / "skip", [['1,"a\nb",z'], ['2,"c\n",y']], header='made by "x\nsecond line\na,b,c')
    got = readers.read_csv(spark, skipped, skip_rows=2, multiline=True)
    assert values(got) == [(1, "a\nb", "z"), (2, "c\n", "y")] and got.columns == ["a", "b", "c"]
    bare = readers.read_csv(spark, written(tmp_path / "bare", [['2,"c\n",y']], header='1,"a\nb",z'), has_header=False, multiline=True)
    assert values(bare) == [(1, "a\nb", "z"), (2, "c\n", "y")] and bare.columns == ["_c0", "_c1", "_c2"]


def test_folder_keeps_file_names(spark, tmp_path, tiny_splits):
    path = written(tmp_path / "in", [['1,"a\nb",z'], ['2,"c",y', '3,"\n\n",x']])
    df = readers.read_folder(spark, path, pattern="*.csv", multiLine=True)
    names = {r["a"]: r[readers.FILE_COLUMN].rsplit("/", 1)[1] for r in df.collect()}
    assert names == {1: "f0.csv", 2: "f1.csv", 3: "f1.csv"}


def test_other_line_ends_and_blank_lines(spark, tmp_path, tiny_splits):
    path = written(tmp_path / "in", [["1,x,y", "", '2,"a",b', "3,z,w"]], end="\r\n")
    assert values(readers.read_csv(spark, path, schema="a string, b string, c string", multiline=True)) == [("1", "x", "y"), ("2", "a", "b"), ("3", "z", "w")]


def test_no_shuffle_of_whole_records(spark, tmp_path):
    path = written(tmp_path / "in", [['1,"a\nb",z'] * 50])
    text = records(lambda: spark.read, path, ",", '"')._jdf.queryExecution().executedPlan().toString()
    # pieces of records alone are brought together
    assert text.count("Exchange") <= 3 and "Union" in text
