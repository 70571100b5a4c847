"""Parts, pages and widget sets against their plain counterparts."""

import random

import pytest
from conftest import values

from sluice import Condition
from sluice.operators import quality
from sluice.operators.aggregate import Aggregation, Cell, concat_parts, crosstab, crosstab_pages, pivot
from sluice.operators.paging import PageIndex
from sluice.operators.quality import Widget
from sluice.operators.rows import limit_rows
from sluice.session import scratch_path


def test_parts_join_to_the_whole(table):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, "x", "yy", "é" * 7, "long " * 9]), k) for k in range(200)]
    df = table(rows, "g string, t string, n int")
    for delimiter, size in ((", ", 40), ("", 1), ("--", 10_000)):
        parts = concat_parts(df, ["g"], "t", delimiter, part_chars=size).collect()
        for g in ("a", "b", None):
            own = sorted((r for r in parts if r["g"] == g), key=lambda r: r["part"])
            assert [r["part"] for r in own] == list(range(len(own)))
            whole = delimiter.join(sorted(t for x, t, _ in rows if x == g and t is not None))
            assert "".join(r["text"] for r in own) == whole
            assert all(whole[r["begin"] :].startswith(r["text"]) for r in own)
            if size == 40:
                assert len(own) > 3
    ordered = concat_parts(df, [], "t", "|", [["n", "DESC"]], part_chars=50).orderBy("part").collect()
    assert "".join(r["text"] for r in ordered) == "|".join(t for _, t, _ in reversed(rows) if t is not None)


def test_crosstab_pages_equal_the_crosstab(spark, table):
    rng = random.Random(2)
    rows = [(rng.choice(["p", "q", None]), rng.choice([None, *range(40)]), rng.random()) for _ in range(300)]
    df = table(rows, "g string, k int, x double")
    for cells in (Cell("COUNT"), [Cell("COUNT"), Cell("MAX", "x")]):
        whole = crosstab(df, ["g"], "k", cells)
        pages = crosstab_pages(df, ["g"], "k", cells, width=7)
        assert pages.pages() == 6
        seen = ["g"]
        for number in range(6):
            page = pages.page(number)
            assert values(page) == values(whole.select(page.columns))
            seen += page.columns[1:]
        assert sorted(seen) == sorted(whole.columns)
    assert [r["value"] for r in pages.columns.orderBy("position").collect()][:3] == ["0", "1", "2"]
    with pytest.raises(ValueError, match="pages are"):
        pages.page(6)


def test_more_values_than_a_crosstab_takes(spark):
    df = spark.range(12_000).selectExpr("id % 3 AS g", "id % 5000 AS k")
    with pytest.raises(ValueError, match="crosstab_pages"):
        crosstab(df, ["g"], "k", Cell("COUNT"))
    pages = crosstab_pages(df, ["g"], "k", Cell("COUNT"), width=500)
    assert pages.pages() == 10 and pages.columns.count() == 5000
    last = pages.page(9)
    assert len(last.columns) == 501 and last.columns[-1] == "4999"
    assert sum(sum(r[1:]) for r in last.collect()) == 500 * 2


def test_pages_of_rows(spark, table):
    rng = random.Random(3)
    rows = [(k, rng.choice([None, 1, 2, 2, 2, 3]), rng.choice("abc")) for k in range(3000)]
    df = table(rows, "id int, v int, t string")
    index = PageIndex(spark, scratch_path(spark, "pages")).build(df, [["v", "DESC"]], Condition("t", "NE", "c"), bucket_rows=200)
    want = sorted((r for r in rows if r[2] != "c"), key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert index.rows() == len(want)
    for offset in (1, 190, 777, len(want) - 3, len(want) + 5):
        got = [tuple(r) for r in PageIndex(spark, index.root).page(50, offset).collect()]
        assert got == want[offset - 1 : offset + 49]
    assert index.page(3, 1, ["t"]).columns == ["t"] and index.page(0).count() == 0
    with pytest.raises(ValueError, match="offset"):
        index.page(10, 0)


def test_a_page_reads_its_buckets_only(spark):
    df = spark.range(40_000).selectExpr("id", "id * 7 % 40000 AS v")
    index = PageIndex(spark, scratch_path(spark, "pages")).build(df, ["v"], bucket_rows=1000)
    for offset in (1, 30_001):
        page = index.page(100, offset)
        assert [r["v"] for r in page.collect()] == list(range(offset - 1, offset + 99))
        # the files of one or two buckets, not those of the table
        assert len({f.rsplit("/", 2)[1] for f in page.inputFiles()}) <= 2
        assert spark.read.parquet(*page.inputFiles()).count() < 4000


def test_a_value_that_fills_many_buckets(spark):
    df = spark.range(6000).selectExpr("id", "IF(id % 3 = 0, id, -1) AS v")
    index = PageIndex(spark, scratch_path(spark, "pages")).build(df, ["v"], bucket_rows=300)
    counts = [r["n"] for r in spark.read.parquet(f"{index.root}/counts").collect()]
    assert max(counts) < 3 * 300
    assert [r["id"] for r in index.page(3, 2001).collect()] == [i for i in range(6000) if i % 3][2000:2003]


def widgets():
    out = {}
    for k, groups in enumerate([["g"], ["h"], ["g", "h"], []]):
        for j, spec in enumerate(
            [
                Aggregation("x", "SUM", "a"), Aggregation("g", "COUNT_DISTINCT", "a"), Aggregation("x", "MEDIAN", "a"), Aggregation("h", "COUNT", "a"),
                Aggregation("g", "CONCAT", "a", "/"), Aggregation("x", "MAX", "a", condition=Condition("h", "GT", 1)), Aggregation("x", "STDDEV"),
            ]
        ):
            for c, condition in enumerate([None, Condition("x", "GT", 0.5), Condition("x", "GT", 9)]):
                out[f"w{k}{j}{c}"] = Widget(groups, [spec, Aggregation("x", "COUNT", "n")], condition)
    out["top"] = Widget(["g"], [Aggregation("x", "SUM", "a")], None, [["a", "DESC"]], 1)
    return out


def test_one_read_for_many_widgets(spark, table, tmp_path):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2, 3, None]), rng.choice([None, rng.random()]), k) for k in range(200)]
    table(rows, "g string, h int, x double, _widget int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    asked = widgets()
    assert len(asked) == 85
    made = quality.widget_data(df, asked, [Condition("_widget", "LT", 190)])
    kept = df.filter("_widget < 190")
    for name, widget in asked.items():
        want = pivot(kept, widget.group_by, widget.aggregations, widget.condition)
        if widget.limit:
            want = limit_rows(want, widget.limit, order_by=widget.order_by)
        assert made[name].schema.simpleString() == want.schema.simpleString(), name
        assert rounded(made[name]) == rounded(want), name
        # the table itself is not among what a widget reads
        assert not any(str(tmp_path / "t") in f for f in made[name].inputFiles())
    assert quality.widget_data(df, {}) == {}


def rounded(df):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=repr)
