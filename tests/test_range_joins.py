"""Range, overlap and nearest joins against plain loops, and their plans."""

import random

import pytest

from sluice.operators import range_joins
from sluice.operators.range_joins import join_nearest, join_overlap, join_range


@pytest.fixture
def fine(monkeypatch):
    """Cells of a few rows, so that small tables use runs of many sizes."""
    monkeypatch.setattr(range_joins, "CELL_ROWS", 3)
    monkeypatch.setattr(range_joins, "POINTS", 9)


def collected(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def plan(df):
    df._jdf.queryExecution().executedPlan()
    return df._jdf.queryExecution().toString()


def sides(seed=1, left=300, right=120):
    rng = random.Random(seed)
    points = [(k, rng.choice(["a", "a", "b", None]), rng.choice([None, 50.0, rng.uniform(0, 100), rng.uniform(0, 100)])) for k in range(left)]
    ranges = []
    for k in range(right):
        low = rng.choice([None, 50.0, rng.uniform(-10, 110)])
        width = rng.choice([0.0, 0.5, 3.0, 40.0, 500.0, -1.0])
        ranges.append((1000 + k, rng.choice(["a", "b", None]), low, None if low is None else low + width))
    return points, ranges


@pytest.mark.parametrize("ends", ["BOTH", "LOW", "HIGH", "NEITHER"])
@pytest.mark.parametrize("keyed", [True, False])
def test_range_against_loops(table, fine, ends, keyed):
    points, ranges = sides()
    df, other = table(points, "id int, g string, v double"), table(ranges, "id int, g string, lo double, hi double")
    got = join_range(df, other, "v", "lo", "hi", ["g"] if keyed else [], "LEFT", select=["id", "lo"], ends=ends)
    assert got.columns == ["id", "g", "v", "id_1", "lo"]
    want = []
    for i, g, v in points:
        hits = []
        for j, h, lo, hi in ranges:
            if None in (v, lo, hi) or (keyed and (g is None or g != h)):
                continue
            if (lo <= v if ends in ("BOTH", "LOW") else lo < v) and (v <= hi if ends in ("BOTH", "HIGH") else v < hi):
                hits.append((i, g, v, j, lo))
        want += hits or [(i, g, v, None, None)]
    assert collected(got, *got.columns) == sorted(want, key=repr)


@pytest.mark.parametrize("ends", ["BOTH", "LOW"])
def test_overlap_against_loops(table, fine, ends):
    rng = random.Random(3)

    def some(n, first):
        out = []
        for k in range(n):
            low = rng.choice([None, *range(0, 40)])
            out.append((first + k, rng.choice("xy"), low, None if low is None else low + rng.choice([-1, 0, 0, 1, 2, 30])))
        return out

    ones, twos = some(80, 0), some(60, 500)
    df, other = table(ones, "id int, g string, lo int, hi int"), table(twos, "id int, g string, lo int, hi int")
    got = join_overlap(df, other, ("lo", "hi"), ("lo", "hi"), ["g"], "LEFT", select=[("id", "other")], ends=ends)
    want = []
    for i, g, a, b in ones:
        hits = []
        for j, h, c, d in twos:
            if g != h or None in (a, b, c, d):
                continue
            if (a <= b and c <= d and a <= d and c <= b) if ends == "BOTH" else (a < b and c < d and a < d and c < b):
                hits.append((i, g, a, b, j))
        want += hits or [(i, g, a, b, None)]
    assert collected(got, *got.columns) == sorted(want, key=repr)


@pytest.mark.parametrize("direction", ["BACKWARD", "FORWARD"])
@pytest.mark.parametrize("within", [None, 7])
@pytest.mark.parametrize("keyed", [True, False])
def test_nearest_against_loops(table, direction, within, keyed):
    rng = random.Random(5)
    ones = [(k, rng.choice(["a", "b", "c", None]), rng.choice([None, *range(0, 200, 3)])) for k in range(200)]
    twos = [(k, rng.choice(["a", "a", "b", None]), rng.choice([None, *range(0, 200, 5)])) for k in range(90)]
    df, other = table(ones, "id int, g string, at long"), table(twos, "id int, g string, at int")
    got = join_nearest(df, other, "at", "at", ["g"] if keyed else [], direction, select=[("id", "near"), ("at", "near_at")], within=within)
    want = []
    for i, g, x in ones:
        fits = [
            (y, j)
            for j, h, y in twos
            if None not in (x, y) and (not keyed or (g is not None and g == h)) and (y <= x if direction == "BACKWARD" else y >= x)
        ]
        best = max(fits, key=lambda f: (f[0] if direction == "BACKWARD" else -f[0], f[1])) if fits else None
        if best and within is not None and abs(best[0] - x) > within:
            best = None
        want.append((i, g, x, best[1] if best else None, best[0] if best else None))
    assert collected(got, *got.columns) == sorted(want, key=repr)
    inner = join_nearest(df, other, "at", "at", ["g"] if keyed else [], direction, "INNER", [("id", "near")], within=within)
    assert collected(inner, "id", "near") == sorted(((w[0], w[3]) for w in want if w[3] is not None), key=repr)


def test_text_ranges(table, fine):
    rng = random.Random(8)
    for begin in ("", "Customer#0000", "été "):
        words = ["".join(rng.choices("abé日\x00 ", k=rng.randrange(0, 9))) for _ in range(150)]
        points = [(k, begin + w) for k, w in enumerate(words)] + [(999, None)]
        bounds = [sorted([begin + rng.choice(words), begin + rng.choice(words)], key=lambda t: t.encode()) for _ in range(50)]
        ranges = [(k, lo, hi) for k, (lo, hi) in enumerate(bounds)]
        got = join_range(table(points, "id int, t string"), table(ranges, "r int, lo string, hi string"), "t", "lo", "hi", select=["r"])
        want = [(i, t, r) for i, t in points for r, lo, hi in ranges if t is not None and lo.encode() <= t.encode() <= hi.encode()]
        assert collected(got, *got.columns) == sorted(want, key=repr)


def test_no_nested_loops(spark):
    points = spark.range(1000).selectExpr("id", "id % 7 AS g", "id * 1.5 AS v")
    ranges = spark.range(50).selectExpr("id", "id % 7 AS g", "id * 10.0 AS lo", "id * 10.0 + 25 AS hi")
    for df in (
        join_range(points, ranges, "v", "lo", "hi", select=[("id", "r")]),
        join_range(points, ranges, "v", "lo", "hi", ["g"], "LEFT", select=[("id", "r")]),
        join_overlap(ranges, ranges, ("lo", "hi"), ("lo", "hi"), select=[("id", "r")]),
        join_nearest(points, ranges, "v", "lo", ["g"], select=[("id", "r")]),
    ):
        text = plan(df)
        assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_hot_key_is_cut_by_value(spark):
    # two thirds of the rows share a key; what a pair of equal key and run has stays small
    points = spark.range(30_000).selectExpr("id", "IF(id % 3 = 0, id, 0) AS g", "id * 1.0D AS v")
    ranges = spark.range(3000).selectExpr("id AS rid", "0L AS g", "id * 10.0D AS lo", "id * 10.0D + 5 AS hi")
    got = join_range(points, ranges, "v", "lo", "hi", ["g"], select=["rid"])
    want = sum(1 for k in range(30_000) if (k % 3 or k == 0) and k % 10 <= 5)
    assert got.count() == want
    met = range_joins._meet(
        points.selectExpr("struct(*) AS row", "g AS key0", "v AS at"), ranges.selectExpr("g AS key0", "lo AS low", "hi AS high", "rid AS found"), ["key0"], __import__("pyspark").sql.functions.lit(True)
    )
    # candidates are a small multiple of the pairs
    assert met.count() < 60 * want
    assert met.groupBy("key0", "run").count().agg({"count": "max"}).first()[0] < 3 * 256 * 40


def test_keys_with_few_rows_meet_by_key(spark):
    # what a row costs does not depend on how many keys there are
    points = spark.range(20_000).selectExpr("id", "id % 2000 AS g", "id * 1.0D AS v")
    ranges = spark.range(4000).selectExpr("id AS rid", "id % 2000 AS g", "id * 4.0D AS lo", "id * 4.0D + 300 AS hi")
    got = join_range(points, ranges, "v", "lo", "hi", ["g"], select=["rid"])
    assert "Generate" not in plan(got)
    rids = [(rid, rid % 2000) for rid in range(4000)]
    want = [(i, rid) for rid, g in rids for i in range(g, 20_000, 2000) if rid * 4 <= i <= rid * 4 + 300]
    assert collected(got, "id", "rid") == sorted(want, key=repr)


def test_keys_with_few_and_many_rows_together(spark):
    points = spark.range(6000).selectExpr("id", "IF(id % 2 = 0, 0, id % 500) AS g", "id % 997 * 1.0D AS v")
    ranges = spark.range(2000).selectExpr("id AS rid", "IF(id % 2 = 0, 0L, id % 500) AS g", "id % 991 * 1.0D AS lo", "id % 991 + 3.0D AS hi")
    got = join_range(points, ranges, "v", "lo", "hi", ["g"], "LEFT", select=["rid"])
    points, ranges = [tuple(r) for r in points.collect()], [tuple(r) for r in ranges.collect()]
    by_key = {}
    for rid, g, lo, hi in ranges:
        by_key.setdefault(g, []).append((rid, lo, hi))
    want = []
    for i, g, v in points:
        found = [rid for rid, lo, hi in by_key.get(g, []) if lo <= v <= hi]
        want += [(i, rid) for rid in found or [None]]
    assert collected(got, "id", "rid") == sorted(want, key=repr)


def test_hot_group_of_a_nearest_join(spark):
    left = spark.range(20_000).selectExpr("id", "0 AS g", "id * 2 AS at")
    right = spark.range(5000).selectExpr("id AS rid", "0 AS g", "id * 8 + 1 AS at")
    got = join_nearest(left, right, "at", "at", ["g"], select=["rid"])
    wrong = got.filter("NOT (rid <=> IF(at = 0, NULL, LEAST((at - 1) div 8, 4999)))")
    assert got.count() == 20_000 and wrong.count() == 0
    assert "_scan_bucket" in plan(got)


def test_dates_names_and_errors(spark, table):
    df = table([(1, "2024-01-01 10:00:00", 5)], "id int, t string, none int").selectExpr("id", "CAST(t AS TIMESTAMP_NTZ) AS `my.t`", "none")
    days = table([(7, "2024-01-01"), (8, "2024-01-02")], "id int, d string").selectExpr("id", "date(d) AS d", "date(d) + 1 AS e", "1 AS row")
    got = join_range(df, days, "my.t", "d", "e", select=["id", ("row", "found")])
    assert collected(got, *[f"`{c}`" for c in got.columns])[0][3:] == (7, 1)
    near = join_nearest(df, days, "my.t", "d", select=["id"], within="12 hours")
    assert [tuple(r)[-1] for r in near.collect()] == [7]
    assert [tuple(r)[-1] for r in join_nearest(df, days, "my.t", "d", select=["id"], within="9 hours").collect()] == [None]
    with pytest.raises(ValueError, match="of one kind"):
        join_range(df, days, "id", "d", "e")
    with pytest.raises(ValueError, match="INNER or LEFT"):
        join_range(df, days, "my.t", "d", "e", join_type="OUTER")
    with pytest.raises(ValueError, match="direction"):
        join_nearest(df, days, "my.t", "d", direction="SIDEWAYS")


def test_empty_sides(table):
    points, ranges = table([(1, 2.0)], "id int, v double"), table([], "rid int, lo double, hi double")
    assert join_range(points, ranges, "v", "lo", "hi", select=["rid"]).count() == 0
    assert collected(join_range(points, ranges, "v", "lo", "hi", join_type="LEFT", select=["rid"]), "id", "v", "rid") == [(1, 2.0, None)]
    assert collected(join_nearest(points, ranges, "v", "lo", select=["rid"]), "id", "rid") == [(1, None)]
    assert join_range(ranges, points, "lo", "v", "v").count() == 0
