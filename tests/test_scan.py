"""The bucketed plan must give what one long sorted list gives."""

import datetime as dt
import random
import statistics

import pytest
from conftest import values
from pyspark.sql import functions as F

from sluice.operators import rows, scan, windows
from sluice.operators.aggregate import Aggregation, percentile, pivot
from sluice.operators.ordering import Key, with_buckets


def made(seed, n=400):
    """A group with most rows, NULL groups, tied and missing order keys, missing values."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        group = rng.choice(["hot", "hot", "hot", "b", "c", None])
        first = rng.choice([5.0, 5.0, 5.0, None, float("nan"), float("inf"), float("-inf"), rng.uniform(-9, 9)])
        value = None if rng.random() < 0.4 else float(rng.randint(-50, 50))
        out.append((i, group, first, value))
    return out


SCHEMA = "id int, g string, k double, v double"


def sort_key(row, descending):
    k = row[2]
    missing = k is None
    number = 0.0 if missing else k
    is_nan = number != number
    rank = (2 if is_nan else 1, 0.0 if is_nan else number)
    if descending:
        rank = (-rank[0], -rank[1])
    return (missing, rank, row[0])


def grouped(data, descending, by_group=True):
    groups = {}
    for row in sorted(data, key=lambda r: sort_key(r, descending)):
        groups.setdefault(row[1] if by_group else 0, []).append(row)
    return groups.values()


def result(df, name):
    return {r["id"]: r[name] for r in df.select("id", name).collect()}


def order(descending):
    return [["k", "DESC" if descending else "ASC"], "id"]


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_ranks(table, by, descending):
    data = made(1)
    df = table(data, SCHEMA)
    number, tile, share = {}, {}, {}
    for group in grouped(data, descending, bool(by)):
        size, extra = divmod(len(group), 7)
        for i, row in enumerate(group):
            number[row[0]] = i + 1
            edge = extra * (size + 1)
            tile[row[0]] = i // (size + 1) + 1 if i < edge else extra + (i - edge) // size + 1
            share[row[0]] = i / (len(group) - 1)
    options = {"partition_by": by, "order_by": order(descending), "split": True}
    assert result(windows.window(df, "ROW_NUMBER", None, "o", **options), "o") == number
    assert result(windows.window(df, "NTILE", None, "o", buckets=7, **options), "o") == tile
    got = result(windows.window(df, "PERCENT_RANK", None, "o", **options), "o")
    assert got == pytest.approx(share)


@pytest.mark.parametrize("function", ["RANK", "DENSE_RANK"])
def test_ranks_with_ties(table, function):
    df = table(made(2), SCHEMA)
    options = {"partition_by": ["g"], "order_by": [["k", "DESC"]]}
    split = result(windows.window(df, function, None, "o", split=True, **options), "o")
    plain = result(windows.window(df, function, None, "o", split=False, **options), "o")
    assert split == plain


@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("descending", [False, True])
def test_running_aggregates(table, by, descending):
    data = made(3)
    expected = {}
    for group in grouped(data, descending, bool(by)):
        seen = []
        for row in group:
            seen += [] if row[3] is None else [row[3]]
            expected[row[0]] = (
                sum(seen) if seen else None,
                len(seen),
                statistics.fmean(seen) if seen else None,
                min(seen, default=None),
                max(seen, default=None),
                statistics.variance(seen) if len(seen) > 1 else None,
            )
    names = {"s": "SUM", "n": "COUNT", "a": "AVG", "lo": "MIN", "hi": "MAX", "var": "VARIANCE"}
    df = windows.running_aggregates(
        table(data, SCHEMA), "v", names, by, order(descending), split=True
    )
    for r in df.collect():
        for got, want in zip([r[n] for n in names], expected[r["id"]], strict=True):
            assert got == (want if want is None else pytest.approx(want, abs=1e-9))


@pytest.mark.parametrize("direction", ["LAST_VALUE", "FIRST_VALUE"])
@pytest.mark.parametrize("by", [None, "g"])
def test_fill_missing(table, by, direction):
    data = made(4)
    up = direction == "FIRST_VALUE"
    expected = {}
    for group in grouped(data, False, by is not None):
        last = None
        for row in reversed(group) if up else group:
            last = last if row[3] is None else row[3]
            expected[row[0]] = last
    df = table(data, SCHEMA)
    for split in (True, False):
        out = windows.fill_missing(df, "v", direction, by, order(False), split=split)
        assert result(out, "v") == expected


def test_blank_text_is_filled(table):
    df = table([(1, "a"), (2, " "), (3, None), (4, "b")], "id int, s string")
    filled = windows.fill_missing(df, "s", order_by=["id"])
    assert values(filled) == [(1, "a"), (2, "a"), (3, "a"), (4, "b")]


@pytest.mark.parametrize("function", ["LAG", "LEAD"])
@pytest.mark.parametrize("offset", [1, 5])
def test_shifts_over_small_chunks(table, monkeypatch, function, offset):
    monkeypatch.setattr(scan, "CHUNK_ROWS", 8)
    data = made(5, 200)
    expected = {}
    for group in grouped(data, True):
        for i, row in enumerate(group):
            j = i - offset if function == "LAG" else i + offset
            expected[row[0]] = group[j][3] if 0 <= j < len(group) else None
    move = windows._shift(function, F.col("v"), offset)
    before, after = (offset, 0) if function == "LAG" else (0, offset)
    keys = [Key("k", True), Key("id")]
    out = scan.framed(table(data, SCHEMA), move, ["g"], keys, before, after, "o", chunk=8)
    assert result(out, "o") == expected


def test_moving_frame_over_small_chunks(table):
    data = made(6, 300)
    expected = {}
    for group in grouped(data, False, False):
        for i, row in enumerate(group):
            seen = [r[3] for r in group[max(0, i - 9) : i + 1] if r[3] is not None]
            expected[row[0]] = sum(seen) if seen else None
    out = scan.framed(
        table(data, SCHEMA),
        lambda spec: F.sum("v").over(spec.rowsBetween(-9, 0)),
        [],
        [Key("k"), Key("id")],
        9,
        0,
        "o",
        chunk=16,
    )
    assert result(out, "o") == expected


@pytest.mark.parametrize("function", ["FIRST_VALUE", "LAST_VALUE", "NTH_VALUE"])
def test_edges(table, function):
    data = made(7)
    at = {"FIRST_VALUE": 0, "LAST_VALUE": -1, "NTH_VALUE": 2}[function]
    expected = {r[0]: g[at][3] for g in grouped(data, False) for r in g}
    for split in (True, False):
        df = windows.window(
            table(data, SCHEMA), function, "v", "o", None, None, ["g"], order(False), offset=3, split=split
        )
        assert result(df, "o") == expected


def test_whole_group_totals(table):
    data = made(8)
    df = table(data, SCHEMA)
    for by in ([], ["g"]):
        want = {}
        for group in grouped(data, False, bool(by)):
            total = sum(r[3] for r in group if r[3] is not None)
            want |= {r[0]: total for r in group}
        for split in (True, False):
            out = windows.window(df, "SUM", "v", "o", partition_by=by, split=split)
            assert result(out, "o") == want


@pytest.mark.parametrize("kind", ["text", "date", "long"])
def test_order_by_other_kinds(table, kind):
    rng = random.Random(9)
    make = {
        "text": lambda: rng.choice(["Cust#", "Cust#é", "Cust#01"]) + str(rng.randint(0, 99)),
        "date": lambda: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randint(0, 10**7)),
        "long": lambda: rng.randint(-(2**62), 2**62),
    }[kind]
    data = [(i, make()) for i in range(300)]
    schema = {"text": "string", "date": "timestamp_ntz", "long": "bigint"}[kind]
    df = table(data, f"id int, k {schema}")
    got = result(windows.window(df, "ROW_NUMBER", None, "o", order_by=["k", "id"]), "o")
    by = (lambda r: (r[1].encode(), r[0])) if kind == "text" else (lambda r: (r[1], r[0]))
    assert got == {r[0]: i + 1 for i, r in enumerate(sorted(data, key=by))}


def test_a_tied_first_key_is_cut_along_the_second(table):
    """A third of the rows and more share one value; no bucket may hold them all."""
    data = [(i, "x", 5.0 if i % 2 else float(i), 1.0) for i in range(2000)]
    df = table(data, SCHEMA)
    cut = with_buckets(df, [Key("k"), Key("id")], "b", 16)
    sizes = [r["count"] for r in cut.groupBy("b").count().collect()]
    assert max(sizes) <= 2000 / 16 * 2.5
    ascending = cut.orderBy("k", "id").collect()
    assert [r.b for r in ascending] == sorted(r.b for r in ascending)


def test_many_buckets(table):
    data = made(10, 3000)
    df = table(data, SCHEMA)
    out = scan.numbered(df, [], [Key("k"), Key("id")], count=900)
    ordered = [r for g in grouped(data, False, False) for r in g]
    assert result(out, scan.ROW) == {r[0]: i + 1 for i, r in enumerate(ordered)}


def test_empty_and_single_row(table):
    empty = table([], SCHEMA)
    one = table([(1, None, None, 3.0)], SCHEMA)
    for df, n in ((empty, 0), (one, 1)):
        out = windows.window(df, "SUM", "v", "o", order_by=["k", "id"], range_type="RUNNING")
        assert out.count() == n
        assert windows.window(df, "ROW_NUMBER", None, "o", order_by=["k"]).count() == n


@pytest.mark.parametrize("fraction", [0.0, 0.3, 0.5, 0.95, 1.0])
def test_percentiles_by_rank(table, fraction):
    data = made(11)
    df = table(data, SCHEMA)
    by_rank = {r["g"]: r["p"] for r in percentile(df, "v", fraction, ["g"], "p", split=True).collect()}
    in_memory = {
        r["g"]: r["p"] for r in percentile(df, "v", fraction, ["g"], "p", split=False).collect()
    }
    assert by_rank == pytest.approx(in_memory)
    whole = percentile(df, "v", fraction, as_name="p", split=True).first()["p"]
    assert whole == pytest.approx(percentile(df, "v", fraction, as_name="p", split=False).first()["p"])


def test_median_next_to_other_aggregates(table):
    df = table(made(12), SCHEMA)
    specs = [Aggregation("v", "MEDIAN", "m"), Aggregation("v", "COUNT", "n")]
    assert values(pivot(df, ["g"], specs, split=True)) == values(pivot(df, ["g"], specs, split=False))
    assert values(pivot(df, [], specs, split=True)) == values(pivot(df, [], specs, split=False))


def test_large_limits_and_pages(table, monkeypatch):
    monkeypatch.setattr(rows, "LARGE_LIMIT", 10)
    df = table(made(13), SCHEMA)
    keys = [["k", "DESC"], "id"]
    ordered = [r.id for r in rows.sort(df, keys).collect()]
    top = rows.limit_rows(df, 50, order_by=keys)
    bottom = rows.limit_rows(df, 50, bottom=True, order_by=keys)
    assert [r.id for r in top.collect()] == ordered[:50]
    assert [r.id for r in bottom.collect()] == ordered[-50:]
    assert [r.id for r in rows.page(df, 20, 101, order_by=keys).collect()] == ordered[100:120]


def test_large_groups_are_measured(table, monkeypatch):
    df = table(made(14), SCHEMA)
    assert not scan.needs_split(df, ["g"])
    assert scan.needs_split(df, [])
    monkeypatch.setattr(scan, "SMALL_INPUT", 0)
    assert not scan.needs_split(df, ["g"])
    monkeypatch.setattr(scan, "MAX_GROUP_ROWS", 100)
    assert scan.needs_split(df, ["g"])
    assert not scan.needs_split(df, ["id"])


def test_running_spread_far_from_zero(table):
    """Both plans over values whose spread is tiny next to their size."""
    from sluice.operators import scan
    from sluice.operators.ordering import Key
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    rows = [(k, 1.7e9 + (k * 7) % 11) for k in range(200)]
    df = table(rows, "k int, v double")
    got = scan.accumulated(df, {"var": "VARIANCE"}, F.col("v"), [], [Key("k")], count=16)
    window = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    expected = {r["k"]: r["e"] for r in df.select("k", F.var_samp("v").over(window).alias("e")).collect()}
    for r in got.collect():
        if r["k"]:
            assert abs(r["var"] - expected[r["k"]]) < 1e-4


def test_percentile_keeps_groups_without_values(table):
    from sluice.operators.aggregate import percentile

    df = table([("a", 1.0), ("a", 2.0), ("b", None), (None, 4.0)], "g string, v double")
    both = [sorted(map(tuple, percentile(df, "v", 0.5, ["g"], "p", split=s).collect()), key=repr) for s in (True, False)]
    assert both[0] == both[1] and len(both[0]) == 3


def test_crosstab_leaves_sums_of_nothing_empty(table):
    from sluice.operators.aggregate import crosstab

    df = table([("a", "x", 1.0), ("b", "y", 2.0)], "r string, c string, MY_COUNT double")
    cells = [{"function": "SUM", "column": "MY_COUNT"}, {"function": "COUNT"}]
    got = {r["r"]: r.asDict() for r in crosstab(df, ["r"], "c", cells).collect()}
    assert got["a"]["y_SUM_MY_COUNT"] is None and got["a"]["y_COUNT"] == 0


def test_text_keys_with_a_long_common_beginning(spark):
    """Most texts begin alike, two do not; buckets stay even and in order."""
    from sluice.operators.ordering import Key, with_buckets
    from pyspark.sql import functions as F

    n = 40_000
    same = F.concat(F.lit("https://www.example.com/a/very/long/common/path/"), F.lpad(F.col("id").cast("string"), 9, "0"))
    odd = F.when(F.col("id") == 5, "é").when(F.col("id") == 6, "").otherwise(same)
    df = spark.range(n).select("id", odd.alias("u"))
    for descending in (False, True):
        got = with_buckets(df, [Key("u", descending), Key("id")], "b", 16)
        stats = got.groupBy("b").agg(F.count("*").alias("n"), F.min("u").alias("lo"), F.max("u").alias("hi")).orderBy("b").collect()
        assert len(stats) > 8 and max(r["n"] for r in stats) <= 1.5 * n / 16 + 2
        ends = [(r["lo"].encode(), r["hi"].encode()) for r in (reversed(stats) if descending else stats)]
        assert all(x[1] < y[0] for x, y in zip(ends, ends[1:]))


def test_frequent_texts_are_cut_by_what_follows(spark):
    from sluice.operators.ordering import Key, with_buckets
    from pyspark.sql import functions as F

    n = 30_000
    df = spark.range(n).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("u"))
    got = with_buckets(df, [Key("u"), Key("id", True)], "b", 12)
    stats = got.groupBy("b").agg(F.count("*").alias("n"), F.min_by("u", F.struct("u", -F.col("id"))).alias("lo"), F.max("u").alias("hi")).collect()
    assert max(r["n"] for r in stats) <= 2 * n / 12
    rows = sorted(((r["u"].encode(), -r["id"]), r["b"]) for r in got.collect())
    assert [b for _, b in rows] == sorted(b for _, b in rows)
