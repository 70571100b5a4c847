import datetime as dt

import pytest
from conftest import values

from sluice import Condition, all_of, any_of, condition_from_dict
from sluice.functions.conditions import Group, Negation
from sluice.operators.values import filter_rows

ROWS = [
    (1, "Boston", 10.0, dt.datetime(2024, 1, 31, 8)),
    (2, "boston", None, dt.datetime(2024, 2, 1, 9)),
    (3, "", 30.0, None),
    (4, None, 30.0, dt.datetime(2023, 2, 5, 9)),
    (5, "  ", -5.0, dt.datetime(2024, 2, 1, 23, 59)),
]
SCHEMA = "id int, city string, n double, at timestamp_ntz"


@pytest.fixture
def df(table):
    return table(ROWS, SCHEMA)


def ids(df, condition, kind="SHOW", **more):
    return [r[0] for r in values(filter_rows(df, condition, kind, **more), "id")]


@pytest.mark.parametrize(
    ("condition", "expected"),
    [
        (Condition("city", "EQ", "Boston"), [1]),
        (Condition("city", "EQ", "Boston", case_sensitive=False), [1, 2]),
        (Condition("city", "NE", "Boston"), [2, 3, 5]),
        (Condition("city", "ICONTAINS", "BOST"), [1, 2]),
        (Condition("city", "CONTAINS", ["Bos", "bos"]), [1, 2]),
        (Condition("city", "NOT_CONTAINS", "os"), [3, 5]),
        (Condition("city", "STARTS_WITH", "B"), [1]),
        (Condition("city", "NOT_ENDS_WITH", "n"), [3, 5]),
        (Condition("city", "IS_EMPTY"), [3, 4, 5]),
        (Condition("city", "IS_NOT_EMPTY"), [1, 2]),
        (Condition("n", "IS_EMPTY"), [2]),
        (Condition("n", "IN_LIST", 30), [3, 4]),
        (Condition("n", "NOT_IN_LIST", [30, 10]), [5]),
        (Condition("n", "IN_RANGE", [-5, 10]), [1, 5]),
        (Condition("n", "IS_MAXVAL"), [3, 4]),
        (Condition("n", "IS_NOT_MINVAL"), [1, 3, 4]),
        (Condition("n", "GT", "id", value_is_column=True), [1, 3, 4]),
        (Condition("at", "GTE", "2024-02-01"), [2, 5]),
        (Condition("at", "EQ", 2, component="month"), [2, 4, 5]),
        (Condition("at", "EQ", "February", component="month_text"), [2, 4, 5]),
        (Condition("at", "EQ", "2024-02-01 11:00:00", truncate="DAY"), [2, 5]),
        (Condition("at", "EQ", "MAX", value_is_date_fn=True), [5]),
        (Condition("at", "LT", "TODAY", value_is_date_fn=True), [1, 2, 4, 5]),
        (~Condition("n", "GT", 5), [5]),
    ],
)
def test_operators(df, condition, expected):
    assert ids(df, condition) == expected


def test_remove_keeps_rows_where_the_condition_is_unknown(df):
    assert ids(df, Condition("n", "GT", 5), "REMOVE") == [2, 5]


def test_show_and_remove_split_the_table(df):
    condition = Condition("n", "GT", 5) & ~Condition("city", "EQ", "Boston")
    both = ids(df, condition) + ids(df, condition, "REMOVE")
    assert sorted(both) == [1, 2, 3, 4, 5]


def test_first_flag_decides_case_for_the_whole_tree(df):
    either = Condition("city", "EQ", "BOSTON", case_sensitive=False) | Condition(
        "city", "EQ", "NOWHERE", case_sensitive=True
    )
    assert ids(df, either) == [1, 2]


def test_system_date_is_a_run_argument(df):
    run_at = dt.datetime(2024, 2, 1, 10)
    on = Condition("at", "GT", "SYSTEM_TIME", value_is_date_fn=True)
    assert ids(df, on, run_at=run_at) == [5]
    day = Condition("at", "GTE", "SYSTEM_DATE", value_is_date_fn=True)
    assert ids(df, day, run_at=run_at) == [2, 5]


def test_groups_flatten_and_negation_cancels():
    a, b, c = (Condition("x", "GT", i) for i in range(3))
    assert (a & b & c) == Group("AND", (a, b, c)) == all_of(a, b & c)
    assert (a | b) & c == Group("AND", (Group("OR", (a, b)), c))
    assert ~~a is a
    assert any_of(a) is a
    assert isinstance(~(a & b), Negation)


def test_round_trip_through_dictionaries():
    tree = ~(Condition("a", "EQ", "x", case_sensitive=False) | Condition("b", "IS_EMPTY")) & Condition(
        "d", "GTE", "2024-01-01", truncate="MONTH"
    )
    assert condition_from_dict(tree.to_dict()) == tree


@pytest.mark.parametrize(
    "bad",
    [
        lambda: Condition("", "EQ", 1),
        lambda: Condition("a", "EQ"),
        lambda: Condition("a", "LIKE", 1),
        lambda: Condition("a", "IN_RANGE", [1]),
        lambda: Condition("a", "IN_RANGE", 1),
        lambda: Group("XOR", (Condition("a", "EQ", 1),) * 2),
        lambda: Group("AND", (Condition("a", "EQ", 1),)),
        lambda: Condition("a", "GT", "SOMEDAY", value_is_date_fn=True),
    ],
)
def test_bad_conditions(bad):
    with pytest.raises(ValueError):
        bad()


def test_more_validation(df):
    with pytest.raises(TypeError):
        Condition("a", "EQ", 1) & "b"
    with pytest.warns(UserWarning):
        Condition("a", "IS_EMPTY", 3)
    with pytest.raises(ValueError, match="IN_RANGE"):
        filter_rows(df, Condition("city", "IN_RANGE", ["a", "b"]))
    with pytest.raises(ValueError, match="unknown column"):
        filter_rows(df, Condition("town", "EQ", "x"))


def test_truncated_dates_and_years_reach_the_scan(spark):
    import re as _re

    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    made = [
        Condition("o_orderdate", "GTE", "1996-03-10", truncate="MONTH"),
        Condition("o_orderdate", "LT", "1996-03-10", truncate="WEEK"),
        Condition("o_orderdate", "EQ", 1998, component="year"),
        Condition("o_orderdate", "IN_RANGE", [1993, 1994], component="year"),
    ]
    for condition in made:
        plan = df.filter(condition.column(df))._jdf.queryExecution().executedPlan().toString()
        assert _re.search(r"PushedFilters: \[[^\]]*(GreaterThan|LessThan)[^\]]*o_orderdate", plan), plan


def test_bounds_agree_with_the_truncated_values(table):
    import datetime as dt

    from pyspark.sql import functions as F

    stamps = [dt.datetime(2024, 1, 1) + dt.timedelta(hours=7 * k, microseconds=k) for k in range(200)] + [None]
    df = table([(s,) for s in stamps], "t timestamp_ntz")
    for unit in ("DAY", "WEEK", "MONTH", "HOUR"):
        for op, sign in (("EQ", "="), ("NE", "<>"), ("GT", ">"), ("GTE", ">="), ("LT", "<"), ("LTE", "<=")):
            got = df.filter(Condition("t", op, "2024-02-07 05:00:00", truncate=unit).column(df)).count()
            text = f"date_trunc('{unit}', t) {sign} date_trunc('{unit}', timestamp_ntz'2024-02-07 05:00:00')"
            assert got == df.filter(F.expr(text)).count(), (unit, op)
