import datetime as dt

import pytest
from conftest import values

from sluice import Condition
from sluice.functions.dates import Delta
from sluice.operators import columns, date_ops, text
from sluice.operators import values as ops
from sluice.operators.text import Variants
from sluice.operators.values import Value


def calculated(table, expression, rows=((7.0, 2.0),), schema="a double, `b c` double"):
    df = ops.math(table(list(rows), schema), expression, "out")
    return [r.out for r in df.collect()]


@pytest.mark.parametrize(
    ("expression", "expected"),
    [
        ("a + b c * 2", 11.0),
        ("(a + b c) * 2", 18.0),
        ("a / b c", 3.5),
        ("a % b c", 1.0),
        ("-a + 10", 3.0),
        ("a / (b c - 2)", None),
        ("a % 0", None),
        ("INT(-2.7)", -2),
        ("ABS(b c - a)", 5.0),
        ("SMALL(a, b c, 5, 2)", 5.0),
        ("LARGE(a, b c, 5, 1)", 7.0),
        ("LARGE(a, b c, 3)", None),
        ("ROUND(a / 3, 1)", 2.3),
        ("CEILING(a / 2)", 4),
        ("POWER(b c, 3)", 8.0),
        ("SQRT(0 - a)", None),
        ("MAX(a, b c)", 7.0),
        ("IF(a > b c, 1, 0)", 1),
    ],
)
def test_arithmetic(table, expression, expected):
    assert calculated(table, expression) == [expected]


def test_nulls_in_arithmetic(table):
    rows = [(None, 2.0)]
    assert calculated(table, "a + b c", rows) == [None]
    assert calculated(table, "SUM(a, b c, 1)", rows) == [3.0]
    assert calculated(table, "AVG(a, b c)", rows) == [2.0]
    assert calculated(table, "COUNT(a, b c)", rows) == [1]
    assert calculated(table, "MIN(a, b c)", rows) == [2.0]
    assert calculated(table, "SUM(a, a)", rows) == [None]


def test_longest_column_name_wins(table):
    df = table([(1.0, 20.0, 300.0)], "Sales double, `Sales Tax` double, Salesman double")
    assert [r.t for r in ops.math(df, "Sales Tax + Sales", "t").collect()] == [21.0]
    assert [r.t for r in ops.math(df, "Salesman - Sales", "t").collect()] == [299.0]


@pytest.mark.parametrize("expression", ["a +", "(a", "x + 1", "a ** 2", "FOO(a)", "a if a else 1"])
def test_bad_arithmetic(table, expression):
    with pytest.raises(ValueError):
        calculated(table, expression)


def test_targets(table):
    df = table([(1, 2.0)], "id int, n double")
    with pytest.raises(ValueError, match="exactly one"):
        ops.math(df, "n + 1")
    with pytest.raises(ValueError, match="exists"):
        ops.math(df, "n + 1", new_column="n")
    written = ops.math(df, "n + 1", existing_column="n", condition=Condition("id", "GT", 5))
    assert values(written) == [(1, 2.0)]
    fresh = ops.math(df, "n + 1", new_column="m", condition=Condition("id", "GT", 5))
    assert values(fresh) == [(1, 2.0, None)]


def test_set_values_tiers(table):
    df = table([(1, 5.0), (2, 50.0), (3, None)], "id int, n double")
    high, some = Condition("n", "GT", 10), Condition("n", "GT", 1)
    tiers = [Value("high", high), Value("some", some)]
    assert values(ops.set_values(df, tiers, "t"), "t") == [("high",), ("some",), (None,)]
    assert ("none",) in values(ops.set_values(df, [*tiers, Value("none")], "t"), "t")
    kept = ops.set_values(df, [Value(0, high)], existing_column="n")
    assert values(kept) == [(1, 5.0), (2, 0.0), (3, None)]


def test_fill_value_counts_blank_text_as_empty(table):
    df = table([("a",), ("",), (" ",), (None,)], "s string")
    assert values(ops.fill_value(df, "s", "x")) == [("a",), ("x",), ("x",), ("x",)]


def test_convert_type_never_fails(table):
    df = table([("1.5", "12/31/2024"), ("x", "2024-12-31"), (None, "Jan 15, 2025")], "n string, d string")
    out = columns.convert_type(
        df, [columns.Conversion("n", "NUMERIC"), columns.Conversion("d", "DATE")]
    )
    assert values(out, "n") == [(1.5,), (None,), (None,)]
    assert {r.d for r in out.collect()} == {
        dt.datetime(2024, 12, 31),
        dt.datetime(2025, 1, 15),
    }
    strict = columns.convert_type(df, [columns.Conversion("d", "DATE", "MM/DD/YYYY")])
    assert [r.d for r in strict.collect()].count(None) == 2
    same = columns.convert_type(df, [columns.Conversion("n", "TEXT")])
    assert values(same, "n") == values(df, "n")


def test_currency_cleaning_chain(table):
    df = table([("$1,234.56",), ("(1,234)",)], "amount string")
    for find, replace in (("$", ""), (",", ""), ("(", "-"), (")", "")):
        df = text.replace_values(df, ["amount"], find, replace)
    out = columns.convert_type(df, [columns.Conversion("amount", "NUMERIC")])
    assert values(out) == [(-1234.0,), (1234.56,)]


def test_split_and_copy(table):
    df = table([("a-b-c",), ("a",), (None,)], "s string")
    out = columns.split_column(df, "s", "-", ["x", "y"])
    assert values(out) == [("a", "a", None), ("a-b-c", "a", "b"), (None, None, None)]
    assert columns.copy_columns(df, [columns.Copy("s")]).columns == ["s", "s Copy"]
    with pytest.raises(ValueError, match="not both"):
        columns.copy_columns(df, [columns.Copy("s", as_name="x", destination="s")])
    dotted = columns.split_column(table([("a.b",)], "s string"), "s", ".", ["x", "y"])
    assert values(dotted, "x", "y") == [("a", "b")]


def test_combine_with_missing_parts(table):
    df = table([("a", None, "c")], "x string, y string, z string")
    skip = columns.combine_columns(df, ["x", "y", "z"], "o", separator="-")
    keep = columns.combine_columns(df, ["x", "y", "z"], "o", separator="-", nulls="empty")
    assert (values(skip, "o"), values(keep, "o")) == ([("a-c",)], [("a--c",)])


@pytest.mark.parametrize(
    ("options", "expected"),
    [
        ({"find": "a.b", "replace": "$1"}, "$1 $1$ axb"),
        ({"find": "A.B", "replace": "z", "match_case": True}, "a.b z$ axb"),
        ({"find": "axb", "replace": "y", "match_words": True}, "a.b A.B$ y"),
        ({"find": "ax", "replace": "y", "match_words": True}, "a.b A.B$ axb"),
        ({"find": "", "replace": "y"}, "a.b A.B$ axb"),
    ],
)
def test_replace_is_literal(table, options, expected):
    df = table([("a.b A.B$ axb",)], "s string")
    assert values(text.replace_values(df, ["s"], **options)) == [(expected,)]


def test_bulk_replace_does_not_chain(table):
    df = table([("NY to LA",)], "s string")
    out = text.bulk_replace(df, ["s"], [Variants(["NY"], "LA"), Variants(["LA"], "SF")])
    assert values(out) == [("LA to SF",)]


def test_bulk_replace_from_table(table):
    df = table([("Msft", 1), ("other", 2), (None, 3)], "s string, id int")
    mapping = table([("Msft", "Microsoft"), ("MSFT", "Microsoft")], "variant string, suggested string")
    assert values(text.bulk_replace_from(df, ["s"], mapping)) == [
        ("Microsoft", 1),
        ("other", 2),
        (None, 3),
    ]


@pytest.mark.parametrize(
    ("options", "expected"),
    [
        ({"direction": "START", "num_char": 3}, "ann"),
        ({"direction": "END", "num_char": 3}, "org"),
        ({"direction": "LEFT", "char_position": 4}, "ann"),
        ({"direction": "RIGHT", "char_position": 4}, "@x.org"),
        ({"direction": "LEFT", "wildcard": "@"}, "ann"),
        ({"direction": "RIGHT", "wildcard": "@"}, "x.org"),
        ({"direction": "RIGHT", "wildcard": "@", "include_wildcard": True}, "@x.org"),
        ({"direction": "RIGHT", "wildcard": "#"}, None),
        ({"regex_pattern": "@(.+)"}, "x.org"),
        ({"regex_pattern": "@.+", "regex_invert": True}, "ann"),
    ],
)
def test_substring(table, options, expected):
    df = table([("ann@x.org",)], "s string")
    assert values(text.substring(df, "s", new_column="o", **options), "o") == [(expected,)]


def test_text_transform(table):
    df = table([("  new YORK\x07 ",)], "s string")
    out = text.text_transform(df, ["s"], case="TITLE", trim=True, clean=True)
    assert values(out) == [("New York",)]


PAIRS = [
    (dt.datetime(2024, 1, 31, 23, 59, 59), dt.datetime(2024, 2, 29), "MONTH", 1.0),
    (dt.datetime(2024, 2, 29), dt.datetime(2024, 1, 31), "MONTH", -1.0),
    (dt.datetime(2023, 12, 31), dt.datetime(2024, 1, 1), "YEAR", 1.0),
    (dt.datetime(2023, 12, 31), dt.datetime(2024, 1, 1), "QUARTER", 1.0),
    (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 7), "WEEK", 0.0),
    (dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 1), "WEEK", -1.0),
    (dt.datetime(2024, 1, 1, 0, 59), dt.datetime(2024, 1, 1, 1), "HOUR", 1.0),
    (dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 1, 0, 59), "HOUR", -1.0),
    (dt.datetime(1969, 12, 31, 23, 59, 59), dt.datetime(1970, 1, 1), "SECOND", 1.0),
]


@pytest.mark.parametrize(("start", "end", "unit", "expected"), PAIRS)
def test_date_diff_counts_boundaries(table, start, end, unit, expected):
    df = table([(start, end)], "a timestamp_ntz, b timestamp_ntz")
    assert values(date_ops.date_diff(df, unit, "a", "b", "o"), "o") == [(expected,)]


def test_increment_clamps_to_month_end(table):
    df = table([(dt.datetime(2024, 1, 31, 10),)], "a timestamp_ntz")
    out = date_ops.increment_date(df, "a", Delta(months=1, hours=-1), "o")
    assert out.schema["o"].dataType.simpleString() == "timestamp_ntz"
    assert values(out, "o") == [(dt.datetime(2024, 2, 29, 9),)]


def test_day_of_week_starts_on_sunday(table):
    df = table([(dt.datetime(2024, 1, 7),)], "a timestamp_ntz")
    assert values(date_ops.extract_date(df, "a", "day_of_week", "o"), "o") == [(0.0,)]
    with pytest.raises(ValueError, match="component"):
        date_ops.extract_date(df, "a", "decade", "o")
    with pytest.raises(ValueError, match="not a DATE"):
        date_ops.extract_date(table([("x",)], "a string"), "a", "year", "o")


def test_business_days_against_a_day_by_day_count(table):
    start = dt.datetime(2024, 1, 1)
    spans = [
        (start + dt.timedelta(days=a), start + dt.timedelta(days=b))
        for a in range(-9, 30, 4)
        for b in range(-12, 40, 5)
    ]
    free = [start + dt.timedelta(days=d) for d in (0, 5, 14, 15, 15)]
    df = table(spans, "a timestamp_ntz, b timestamp_ntz")
    holidays = table([(d,) for d in free], "day timestamp_ntz")
    out = date_ops.business_days(df, "a", "b", "n", holidays, "day")

    def counted(a, b):
        low, high = min(a, b), max(a, b)
        days = [low + dt.timedelta(days=i) for i in range((high - low).days + 1)]
        n = sum(d.weekday() < 5 and d not in free for d in days)
        return float(-n if b < a else n)

    assert {(r.a, r.b): r.n for r in out.collect()} == {(a, b): counted(a, b) for a, b in spans}


def test_small_large_checks(table):
    df = table([(3.0, None, 1.0)], "a double, b double, c double")
    assert values(ops.small_large(df, "SMALL", ["a", "b", "c"], 2, "o"), "o") == [(3.0,)]
    assert values(ops.small_large(df, "LARGE", ["a", "b", "c", 9], 1, "o"), "o") == [(9.0,)]
    for bad in (
        lambda: ops.small_large(df, "SMALL", [], 1, "o"),
        lambda: ops.small_large(df, "SMALL", ["a"], 0, "o"),
        lambda: ops.small_large(df, "SMALL", [True], 1, "o"),
        lambda: ops.small_large(df, "SMALL", ["a"], 1),
    ):
        with pytest.raises(ValueError):
            bad()


@pytest.mark.parametrize(
    ("text_", "layout"),
    [
        ("2024-01-05", None),
        ("2024-01-05 00:00:00", None),
        ("2024-01-05T00:00:00", None),
        ("2024/01/05", None),
        ("01/05/2024", None),
        ("Jan 5, 2024", None),
        ("January 5, 2024", None),
        ("5 Jan 2024", None),
        ("05.01.2024", None),
        ("05/01/2024", "UK"),
        ("05/01/2024", "DD/MM/YYYY"),
        ("5-1-24", "D-M-YY"),
        ("2024|01|05", "yyyy|MM|dd"),
        ("20240105", "yyyyMMdd"),
    ],
)
def test_date_layouts(table, text_, layout):
    df = table([(text_,), ("nonsense",), ("13/13/2024",)], "d string")
    out = columns.normalize_date(df, "d", [layout] if layout else None)
    read = [r.d for r in out.collect()]
    assert read == [dt.datetime(2024, 1, 5), None, None]


def test_numbers_as_text_have_no_exponent(table):
    from sluice.operators.columns import convert_type

    df = table([(12345678.0,), (0.0001,), (100.0,), (-2.5e-7,), (1e22,), (None,)], "x double")
    got = [r["x"] for r in convert_type(df, [{"column": "x", "to": "TEXT"}]).collect()]
    assert got[:4] == ["12345678.0", "0.0001", "100.0", "-0.00000025"] and got[5] is None


def test_dates_survive_numbers(table):
    from sluice.operators.columns import convert_type

    df = table([("2024-01-05 10:11:12",)], "d string").selectExpr("cast(d as timestamp_ntz) d")
    back = convert_type(convert_type(df, [{"column": "d", "to": "NUMERIC"}]), [{"column": "d", "to": "DATE"}])
    assert back.first() == df.first()


def test_math_leaves_quoted_text_alone(table):
    from sluice.operators.values import math

    df = table([("Price", 2.0), ("x", 3.0)], "k string, Price double")
    got = [r["n"] for r in math(df, "IF(k == 'Price', Price, 0)", new_column="n").collect()]
    assert [float(x) for x in got] == [2.0, 0.0]


def test_bulk_replace_with_private_characters(table):
    from sluice.operators.text import Variants, bulk_replace

    df = table([("x",), ("a",), ("ab",)], "t string")
    made = bulk_replace(df, ["t"], [Variants(["a"], "b"), Variants(["b"], "Z")])
    assert [r["t"] for r in made.collect()] == ["x", "b", "bZ"]
    many = bulk_replace(table([("w7 w299",)], "t string"), ["t"], [Variants([f"w{k}"], f"v{k}") for k in range(299, -1, -1)])
    assert many.first()["t"] == "v7 v299"


def test_trim_of_one_side_and_of_all(table):
    from sluice.operators.text import text_transform

    df = table([(" \ta b\n ",)], "t string")
    got = {k: text_transform(df, ["t"], trim=k).first()["t"] for k in ("left", "right", "both", "all")}
    assert got == {"left": "a b\n ", "right": " \ta b", "both": "a b", "all": "ab"}
    with pytest.raises(ValueError, match="trim"):
        text_transform(df, ["t"], trim="middle")


def test_split_at_positions(table):
    from sluice.operators.columns import split_column

    df = table([("abcdef",), ("abc",), ("a",), (None,)], "t string")
    made = split_column(df, "t", positions=[2, 3], new_columns=["x", "y", "z"])
    assert [tuple(r)[1:] for r in made.collect()] == [("ab", "c", "def"), ("ab", "c", None), ("a", None, None), (None, None, None)]
    with pytest.raises(ValueError, match="grow"):
        split_column(df, "t", positions=[3, 2], new_columns=["x"])
