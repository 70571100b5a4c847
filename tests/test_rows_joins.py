import datetime as dt

import pytest
from conftest import values

from sluice import Condition
from sluice.operators import aggregate, date_ops, joins, json_ops, rows
from sluice.operators.aggregate import Aggregation, Cell
from sluice.operators.columns import Part

PEOPLE = [
    ("alice", "Engineering", 100.0),
    ("bob", "Sales", 90.0),
    ("alice", "Engineering", 100.0),
    ("carol", "Marketing", 80.0),
]
SCHEMA = "name string, department string, salary double"


@pytest.fixture
def people(table):
    return table(PEOPLE, SCHEMA)


def test_duplicates(people):
    assert rows.discard_duplicates(people).count() == 3
    kept = rows.discard_duplicates(people, ["salary"])
    assert values(kept, "name") == [("alice",), ("bob",), ("carol",)]
    with pytest.raises(ValueError, match="unknown column"):
        rows.discard_duplicates(people, ["pay"])


def test_survivor_is_the_first_in_order(table):
    df = table([("a", 3, "x"), ("a", 1, "y"), ("a", None, "z")], "k string, n int, v string")
    assert values(rows.keep_first(df, ["k"], ["n"])) == [("a", 1, "y")]
    assert values(rows.keep_first(df, ["k"], [["n", "DESC"]])) == [("a", 3, "x")]


def test_limits(people):
    top = rows.limit_rows(people, 2, order_by=[["salary", "DESC"], "name"])
    assert [r.name for r in top.collect()] == ["alice", "alice"]
    bottom = rows.limit_rows(people, 2, bottom=True, order_by=[["salary", "DESC"], "name"])
    assert [r.name for r in bottom.collect()] == ["bob", "carol"]
    with pytest.raises(ValueError, match="order_by"):
        rows.limit_rows(people, 2)
    second = rows.page(people, 2, 3, ["name"], order_by=["name", "department"])
    assert [r.name for r in second.collect()] == ["bob", "carol"]


def test_null_sorts_last_both_ways(table):
    df = table([(1,), (None,), (2,)], "n int")
    assert [r.n for r in rows.sort(df, ["n"]).collect()] == [1, 2, None]
    assert [r.n for r in rows.sort(df, [["n", "DESC"]]).collect()] == [2, 1, None]


def test_unnest_keeps_empty_cells_and_common_type(table):
    df = table([(1, 2.0, None)], "id int, a double, b double")
    out = rows.unnest(df, ["a", "b"])
    assert values(out) == [(1, "a", 2.0), (1, "b", None)]
    mixed = rows.unnest(table([(1, 2.0, "x")], "id int, a double, b string"), ["a", "b"])
    assert values(mixed) == [(1, "a", "2.0"), (1, "b", "x")]


def test_flatten(table):
    df = table([(1, "a;b"), (2, None)], "id int, s string")
    assert values(rows.flatten(df, "s", ";")) == [(1, "a"), (1, "b"), (2, None)]
    nested = table([(1, [("x", 1)]), (2, [])], "id int, s array<struct<p:string,q:int>>")
    assert values(rows.flatten(nested, "s", prefix="s_")) == [(1, "x", 1), (2, None, None)]


def test_preview_of_a_step(people):
    out = rows.preview(people, 2, 2, lambda df: df.withColumnRenamed("name", "who"))
    assert (out.columns, out.count()) == (["who", "department"], 2)


def test_pivot_names_nulls_and_having(table):
    df = table([("a", 1.0), ("a", None), (None, 5.0)], "k string, v double")
    specs = [Aggregation("v", "SUM"), Aggregation("v", "COUNT"), Aggregation("v", "AVG", "m")]
    out = aggregate.pivot(df, ["k"], specs)
    assert out.columns == ["k", "SUM_v", "COUNT_v", "m"]
    assert values(out) == [("a", 1.0, 1, 1.0), (None, 5.0, 1, 5.0)]
    some = aggregate.pivot(df, ["k"], specs, having=Condition("SUM_v", "GT", 2))
    assert values(some, "k") == [(None,)]
    single = aggregate.pivot(df, ["k"], [Aggregation("v", "STDDEV", "s")])
    assert values(single) == [("a", None), (None, None)]


def test_first_last_concat(table):
    df = table([("a", 2, "x"), ("a", 1, "y"), ("a", None, "z")], "k string, n int, v string")
    specs = [Aggregation("v", f, f) for f in ("FIRST", "LAST")]
    assert values(aggregate.pivot(df, ["k"], specs, order_by=["n"])) == [("a", "y", "z")]
    assert values(aggregate.pivot(df, ["k"], specs, order_by=[["n", "DESC"]])) == [("a", "x", "z")]
    joined = aggregate.pivot(df, ["k"], [Aggregation("v", "CONCAT", "c", "+")])
    assert values(joined) == [("a", "x+y+z")]
    with pytest.raises(ValueError, match="order_by"):
        aggregate.pivot(df, ["k"], specs)


def test_crosstab_cells_add_up(spark, table):
    data = [(f"r{i % 3}", f"c{i % 4}", float(i)) for i in range(50)] + [("r0", None, 1.0)]
    df = table(data, "r string, c string, v double")
    sums = aggregate.crosstab(df, ["r"], "c", Cell("SUM", "v"))
    total = sum(x for row in sums.collect() for x in row[1:] if x is not None)
    assert total == sum(d[2] for d in data)
    counts = aggregate.crosstab(df, ["r"], "c", Cell("COUNT"))
    assert sum(x for row in counts.collect() for x in row[1:]) == len(data)
    assert sums.count() == 3
    several = aggregate.crosstab(df, ["r"], "c", [Cell("COUNT"), Cell("MAX", "v")], values=["c0"])
    assert several.columns == ["r", "c0_COUNT", "c0_MAX_v"]


@pytest.mark.parametrize(
    "cell", [[], Cell("MEDIAN", "salary"), Cell("COUNT", "salary"), Cell("SUM")]
)
def test_crosstab_checks(people, cell):
    with pytest.raises(ValueError):
        aggregate.crosstab(people, ["name"], "department", cell)


def test_crosstab_of_too_many_values(people, monkeypatch):
    monkeypatch.setattr(aggregate, "MAX_CROSSTAB_COLUMNS", 2)
    with pytest.raises(ValueError, match="more than 2 values"):
        aggregate.crosstab(people, ["name"], "department", Cell("COUNT"))


def test_joins(table):
    left = table([(1, "a"), (2, "b"), (None, "n")], "id int, v string")
    right = table([(1, "x"), (1, "y"), (3, "z"), (None, "m")], "key int, v string")
    on, pick = [("id", "key")], ["v"]

    def kept(how):
        return values(joins.join(left, right, on, how, pick))

    assert kept("INNER") == [(1, "a", "x"), (1, "a", "y")]
    assert kept("LEFT") == [(1, "a", "x"), (1, "a", "y"), (2, "b", None), (None, "n", None)]
    assert len(kept("OUTER")) == 6
    assert (None, None, "z") in kept("RIGHT")
    named = joins.join(left, right, on, "INNER", [("v", "w"), ("v", "v")], column_prefix="r_")
    assert named.columns == ["id", "v", "r_w", "r_v"]
    assert joins.join(left, right, on, "INNER", ["v"]).columns == ["id", "v", "v_1"]
    with pytest.raises(ValueError, match="key pair"):
        joins.join(left, right, [], "INNER")
    with pytest.raises(ValueError, match="join_type"):
        joins.join(left, right, on, "CROSS")


def test_lookup_never_adds_rows(table):
    left = table([(1,), (2,), (None,), (1,)], "id int")
    right = table([(1, 9.0), (1, 4.0), (None, 1.0)], "key int, v double")
    out = joins.lookup(left, "id", right, "key", "v", "found")
    assert values(out) == [(1, 4.0), (1, 4.0), (2, None), (None, None)]
    typed = joins.lookup(left, "id", right, "key", "v", "found", new_column_type="TEXT")
    assert values(typed)[0] == (1, "4.0")
    mapped = joins.lookup_mapping(left, "id", {"1": "one"}, "word")
    assert values(mapped, "word") == [("one",), ("one",), (None,), (None,)]


def test_append_checks_names_and_types(table):
    a = table([(1, "x")], "id int, s string")
    b = table([("y", 2)], "s string, id int")
    assert values(joins.append(a, b)) == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError, match="differ"):
        joins.append(a, table([(1,)], "id int"))
    with pytest.raises(ValueError, match="another type"):
        joins.append(a, table([("1", "x")], "id string, s string"))


def test_json(table):
    df = table(
        [('{"name":"Alice","age":"30"}',), ("broken",), (None,)],
        "j string",
    )
    out = json_ops.json_extract(df, "j", [Part("Name", key="name"), Part("age", "NUMERIC")])
    assert values(out) == [("Alice", 30.0), (None, None), (None, None)]
    kept = json_ops.json_extract(df, "j", ["name"], keep_source=True)
    assert kept.columns == ["j", "name"]
    nested = table([('{"a":{"b":1}}',)], "j string")
    assert values(json_ops.json_extract(nested, "j", ["a"])) == [('{"b":1}',)]
    lists = table([(1, '["x", 2]'), (2, "[]"), (3, "no")], "id int, j string")
    rows_ = json_ops.json_list_to_rows(lists, "j")
    assert values(rows_) == [(1, "2"), (1, "x"), (2, None), (3, None)]
    with pytest.raises(ValueError, match="TEXT or NUMERIC"):
        json_ops.json_extract(df, "j", [Part("d", "DATE")])


def test_date_scaffold_fills_gaps_per_key(table):
    day = dt.datetime(2024, 1, 1)
    later = day + dt.timedelta(days=3)
    df = table([("a", day, 5), ("a", later, 6), (None, day, 7)], "k string, d timestamp_ntz, n int")
    out = date_ops.date_scaffold(df, "d", "day", ["k"], fill={"n": 0})
    assert [r[2] for r in values(out)] == [5, 0, 0, 6, 7]


def test_approximate_aggregates_stay_close(spark):
    df = spark.range(20_000).selectExpr("id % 2 AS k", "id % 5000 AS v")
    specs = [
        Aggregation("v", "COUNT_DISTINCT", "n", approximate=True),
        Aggregation("v", "MEDIAN", "m", approximate=True),
    ]
    for row in aggregate.pivot(df, ["k"], specs).collect():
        assert row["n"] == pytest.approx(2500, rel=0.05)
        assert row["m"] == pytest.approx(2500, rel=0.05)
