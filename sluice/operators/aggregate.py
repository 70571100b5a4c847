"""Group aggregates, crosstabs, metrics and exact order statistics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.conditions import Predicate, as_predicate
from sluice.functions.kinds import TEXT, col, converted, kind_of, require
from sluice.operators import scan
from sluice.operators.ordering import Key, order_keys
from sluice.session import materialize, planned_bytes, settled

# fixed values: aggregate names
SIMPLE = {
    "SUM": F.sum,
    "AVG": F.avg,
    "MIN": F.min,
    "MAX": F.max,
    "COUNT": F.count,
    "COUNT_DISTINCT": F.count_distinct,
    "STDDEV": F.stddev_samp,
    "VARIANCE": F.var_samp,
}
FUNCTIONS = (*SIMPLE, "MEDIAN", "FIRST", "LAST", "CONCAT")
# a median in memory holds every different value of its group
MAX_VALUES_IN_MEMORY = 2_000_000
# above this many different values a crosstab would be wider than a table can be
MAX_CROSSTAB_COLUMNS = 2000


@dataclass(frozen=True)
class Aggregation:
    """One aggregate; ``condition`` limits it to some of the rows.

    ``approximate`` trades COUNT_DISTINCT and MEDIAN for sketches of fixed size.
    """

    column: str
    function: str
    as_name: str | None = None
    delimiter: str | None = None
    condition: Predicate | dict | None = None
    approximate: bool = False

    @property
    def name(self) -> str:
        return self.as_name or f"{self.function}_{self.column}"


def as_aggregation(spec: Aggregation | dict) -> Aggregation:
    return Aggregation(**spec) if isinstance(spec, dict) else spec


def pivot(
    df: DataFrame,
    group_by: Sequence[str],
    aggregations: Sequence[Aggregation | dict],
    condition: Predicate | dict | None = None,
    order_by: Sequence | None = None,
    having: Predicate | dict | None = None,
    derived: dict[str, str] | None = None,
    split: bool | None = None,
) -> DataFrame:
    """Group and aggregate; NULL is a group of its own.

    ``order_by`` gives FIRST and LAST their order, ``having`` filters groups and
    ``derived`` adds arithmetic over the results. Medians of groups too large
    for one task are found by rank instead of in memory.
    """
    specs = [as_aggregation(a) for a in aggregations]
    require(df, *group_by, *[s.column for s in specs])
    wrong = [s.function for s in specs if s.function not in FUNCTIONS]
    if wrong:
        raise ValueError(f"unknown aggregate {wrong[0]!r}; one of {FUNCTIONS}")
    if not specs:
        raise ValueError("pivot needs at least one aggregation")
    predicate = as_predicate(condition)
    if predicate is not None:
        df = df.filter(predicate.column(df))
    keys = order_keys(df, order_by)
    apart = [s for s in specs if s.function == "MEDIAN" and not s.approximate]
    if split is None and apart:
        split = _too_large(df, group_by)
    apart = apart if split else []
    together = [s for s in specs if s not in apart]
    groups = [col(g) for g in group_by]
    out = df.groupBy(*groups).agg(
        *[_aggregate(df, s, keys) for s in together] or [F.count(F.lit(1)).alias("_rows")]
    )
    for spec in apart:
        out = _join_groups(out, _median(df, spec, group_by), group_by)
    out = out.select(*groups, *[col(s.name) for s in specs])
    if derived:
        from sluice.operators.values import math

        for name, text in derived.items():
            out = math(out, text, new_column=name)
    kept = as_predicate(having)
    return out if kept is None else out.filter(kept.column(out))


def _aggregate(df: DataFrame, spec: Aggregation, keys: list[Key]) -> Column:
    value = col(spec.column)
    only = as_predicate(spec.condition)
    if only is not None:
        value = F.when(only.column(df), value)
    if spec.approximate and spec.function == "COUNT_DISTINCT":
        result = sketched_distinct(value)
    elif spec.approximate and spec.function == "MEDIAN":
        result = F.percentile_approx(value, 0.5, 10_000)
    elif spec.function in SIMPLE:
        result = SIMPLE[spec.function](value)
    elif spec.function == "MEDIAN":
        result = F.median(value)
    elif spec.function == "CONCAT":
        text = converted(value, kind_of(df, spec.column), TEXT)
        glue = ", " if spec.delimiter is None else spec.delimiter
        # the cell itself holds the whole group; order by value for a stable result
        result = F.array_join(F.array_sort(F.collect_list(text)), glue)
        result = F.when(F.count(text) > 0, result)
    else:
        result = _first_or_last(value, spec.function == "LAST", keys)
    return result.alias(spec.name)


def sketched_distinct(value: Column) -> Column:
    """Number of distinct values from a sketch of some kilobytes, within about a percent."""
    hashed = F.when(value.isNotNull(), F.xxhash64(value))
    return F.hll_sketch_estimate(F.hll_sketch_agg(hashed, F.lit(13)))


def _first_or_last(value: Column, last: bool, keys: list[Key]) -> Column:
    if not keys:
        raise ValueError("FIRST and LAST need order_by: rows have no order of their own")
    if len({k.descending for k in keys}) > 1:
        raise ValueError("FIRST and LAST take one direction for all order columns")
    # NULL order values come last in both directions
    descending = keys[0].descending
    missing = [col(k.name).isNull() for k in keys]
    marks = [(~m if descending else m) for m in missing]
    order = F.struct(*[x for k, m in zip(keys, marks, strict=True) for x in (m, col(k.name))])
    pick = F.max_by if last != descending else F.min_by
    return pick(value, order)


def _join_groups(left: DataFrame, right: DataFrame, group_by: Sequence[str]) -> DataFrame:
    if not group_by:
        value = right.columns[0]
        return left.withColumn(value, right.select(value).scalar())
    group = F.struct(*[col(g) for g in group_by])
    return (
        left.withColumn("_group", group)
        .join(
            right.withColumn("_group", group).drop(*group_by),
            "_group",
            "left",
        )
        .drop("_group")
    )


def _median(df: DataFrame, spec: Aggregation, group_by: Sequence[str]) -> DataFrame:
    only = as_predicate(spec.condition)
    rows = df if only is None else df.filter(only.column(df))
    return percentile(rows, spec.column, 0.5, group_by, spec.name, split=True)


def _too_large(df: DataFrame, group_by: Sequence[str]) -> bool:
    """Whether some group may hold more different values than a task should."""
    large = planned_bytes(df) > scan.SMALL_INPUT
    return large and scan.longest_group(df, group_by) > MAX_VALUES_IN_MEMORY


def percentile(
    df: DataFrame,
    column: str,
    fraction: float,
    group_by: Sequence[str] = (),
    as_name: str | None = None,
    split: bool | None = None,
) -> DataFrame:
    """The exact, interpolated percentile of each group.

    Equal values are counted together first, the counts are summed up along the
    order in buckets, and the one or two values at the wanted rank are kept: no
    task holds a group. Unless told to ``split``, small inputs and small groups
    use Spark's in-memory aggregate.
    """
    require(df, column, *group_by)
    if not 0 <= fraction <= 1:
        raise ValueError(f"the fraction lies between 0 and 1, not {fraction}")
    name = as_name or f"PERCENTILE_{column}"
    groups = [col(g) for g in group_by]
    if split is None:
        split = _too_large(df, group_by)
    if not split:
        return df.groupBy(*groups).agg(F.percentile(col(column), fraction).alias(name))
    counts = (
        df.filter(col(column).isNotNull())
        .groupBy(*groups, col(column).cast("double").alias("_value"))
        .agg(F.count(F.lit(1)).alias("_count"))
    )
    counts = settled(counts, "counts")
    upto = scan.accumulated(
        counts, {"_upto": "SUM"}, F.col("_count"), group_by, [Key("_value")]
    )
    group = F.struct(*groups) if groups else F.lit(0)
    totals = counts.groupBy(group.alias("_group")).agg(F.sum("_count").alias("_total"))
    rank = (F.col("_total") - 1) * F.lit(float(fraction))
    below = F.col("_upto") - F.col("_count")
    low, high = F.floor(rank), F.ceil(rank)
    joined = upto.withColumn("_group", group).join(totals, "_group")
    kept = joined.filter((below <= high) & (F.col("_upto") > low))
    low_value, high_value = F.min("_value"), F.max("_value")
    share = F.max(rank - low)
    result = low_value + (high_value - low_value) * share
    made = kept.groupBy(*groups).agg(result.alias(name))
    if not groups:
        return made
    # groups without any value are there too, with NULL
    return _join_groups(df.select(*groups).distinct(), made, group_by)


def metric(df: DataFrame, expression: str, as_name: str = "value") -> DataFrame:
    """One row with one aggregate expression."""
    return df.agg(F.expr(expression).alias(as_name))


@dataclass(frozen=True)
class Cell:
    """One crosstab aggregate; COUNT counts rows and takes no column."""

    function: str
    column: str | None = None


CROSSTAB_FUNCTIONS = tuple(SIMPLE)


def crosstab(
    df: DataFrame,
    rows: Sequence[str],
    pivot_column: str,
    select: Cell | dict | Sequence[Cell | dict],
    condition: Predicate | dict | None = None,
    values: Sequence | None = None,
) -> DataFrame:
    """Long to wide: one column per value of ``pivot_column`` and aggregate.

    With one aggregate the columns carry the value's name, with several
    ``<value>_<function>_<column>``. Known ``values`` save the job that finds them.
    """
    specs = [select] if isinstance(select, (Cell, dict)) else list(select)
    cells = [Cell(**s) if isinstance(s, dict) else s for s in specs]
    if not cells:
        raise ValueError("crosstab needs at least one aggregate")
    for cell in cells:
        if cell.function not in CROSSTAB_FUNCTIONS:
            raise ValueError(f"crosstab does not do {cell.function}; one of {CROSSTAB_FUNCTIONS}")
        if (cell.function == "COUNT") != (cell.column is None):
            raise ValueError("in a crosstab COUNT is given without a column and every other function with one")
    require(df, *rows, pivot_column, *[c.column for c in cells if c.column])
    predicate = as_predicate(condition)
    if predicate is not None:
        df = df.filter(predicate.column(df))
    if values is None:
        found = (
            df.select(col(pivot_column)).distinct().orderBy(col(pivot_column))
            .limit(MAX_CROSSTAB_COLUMNS + 1).collect()
        )
        if len(found) > MAX_CROSSTAB_COLUMNS:
            raise ValueError(
                f"{pivot_column!r} has more than {MAX_CROSSTAB_COLUMNS} values; "
                "use crosstab_pages, which has them in pages of columns"
            )
        values = [r[0] for r in found]
    aggregates = []
    for cell in cells:
        value = F.lit(1) if cell.column is None else col(cell.column)
        name = "_".join(x for x in (cell.function, cell.column) if x)
        aggregates.append(SIMPLE[cell.function](value).alias(name))
    wide = df.groupBy(*[col(r) for r in rows]).pivot(pivot_column, list(values)).agg(*aggregates)
    # nothing to count is zero, not empty; every value has the cells in their order
    zero = [c for i, c in enumerate(wide.columns[len(rows) :]) if cells[i % len(cells)].function.startswith("COUNT")]
    return wide.fillna(0, subset=zero) if zero else wide


class CrosstabPages:
    """A crosstab of any width: its cells, its columns as a table, and pages of columns.

    ``cells`` has one row per group and value that occur together, ``columns``
    the values in order with ``position`` from 0 and the ``page`` they are on.
    """

    def __init__(self, cells: DataFrame, columns: DataFrame, rows: Sequence[str], names: Sequence[str], kinds: Sequence[str], width: int) -> None:
        self.cells, self.columns = cells, columns
        self._rows, self._names, self._kinds, self._width = list(rows), list(names), list(kinds), width

    def pages(self) -> int:
        return self.columns.agg(F.coalesce(F.max("page") + 1, F.lit(0))).first()[0]

    def page(self, number: int) -> DataFrame:
        """All groups with the columns of one page; reads that page's cells only."""
        if not 0 <= number < self.pages():
            raise ValueError(f"pages are 0 to {self.pages() - 1}, got {number}")
        # a page holds ``width`` columns at most
        here = self.columns.filter(F.col("page") == number).orderBy("position").collect()
        cells = self.cells.filter(F.col("page") == number)
        made = []
        for place in here:
            label = "null" if place["value"] is None else place["value"]
            for name, kind in zip(self._names, self._kinds, strict=True):
                value = F.max(F.when(F.col("position") == place["position"], F.col(name)))
                value = F.coalesce(value, F.lit(0)) if kind.startswith("COUNT") else value
                made.append(value.alias(label if len(self._names) == 1 else f"{label}_{name}"))
        wide = cells.groupBy(*[col(r) for r in self._rows]).agg(*made)
        if not self._rows:
            return wide
        # groups without a cell on this page
        groups = self.cells.select(*[col(r) for r in self._rows]).distinct()
        joined = _join_groups(groups, wide, self._rows)
        counts = [c for i, c in enumerate(wide.columns[len(self._rows) :]) if self._kinds[i % len(self._kinds)].startswith("COUNT")]
        return joined.withColumns({c: F.coalesce(col(c), F.lit(0)) for c in counts}) if counts else joined


def crosstab_pages(
    df: DataFrame,
    rows: Sequence[str],
    pivot_column: str,
    select: Cell | dict | Sequence[Cell | dict],
    condition: Predicate | dict | None = None,
    width: int = 500,
) -> CrosstabPages:
    """A crosstab without a bound on its columns: cells are counted once, columns come in pages.

    The values of ``pivot_column`` are a table in their order and never come to
    the driver; a page of ``width`` of them does.
    """
    specs = [select] if isinstance(select, (Cell, dict)) else list(select)
    cells = [Cell(**s) if isinstance(s, dict) else s for s in specs]
    for cell in cells:
        if cell.function not in CROSSTAB_FUNCTIONS or (cell.function == "COUNT") != (cell.column is None):
            raise ValueError("in a crosstab COUNT is given without a column and every other function with one")
    if not cells or width < 1:
        raise ValueError("crosstab_pages needs an aggregate and a width of one or more")
    clash = {"value", "position", "page"} & {r.lower() for r in rows}
    if clash:
        raise ValueError(f"rows of a crosstab have other names than {sorted(clash)}")
    require(df, *rows, pivot_column, *[c.column for c in cells if c.column])
    predicate = as_predicate(condition)
    if predicate is not None:
        df = df.filter(predicate.column(df))
    value = converted(col(pivot_column), kind_of(df, pivot_column), TEXT)
    names = ["_".join(x for x in (c.function, c.column) if x) for c in cells]
    made = [SIMPLE[c.function](F.lit(1) if c.column is None else col(c.column)).alias(n) for c, n in zip(cells, names, strict=True)]
    sparse = settled(df.groupBy(*[col(r) for r in rows], col(pivot_column).alias("_sorted")).agg(*made), "cells")
    found = sparse.select("_sorted").distinct()
    numbered = scan.numbered(found, [], [Key("_sorted")])
    position = (F.col(scan.ROW) - 1).cast("bigint")
    text = converted(F.col("_sorted"), kind_of(df, pivot_column), TEXT)
    columns = numbered.select("_sorted", text.alias("value"), position.alias("position"), F.floor(position / width).alias("page"))
    columns = settled(columns, "columns")
    placed = sparse.join(columns.withColumnRenamed("_sorted", "_other"), F.col("_sorted").eqNullSafe(F.col("_other")))
    placed = placed.select(*[col(r) for r in rows], "value", "position", "page", *names)
    return CrosstabPages(settled(placed, "cells"), columns.drop("_sorted"), rows, names, [c.function for c in cells], width)


def concat_parts(
    df: DataFrame,
    group_by: Sequence[str],
    column: str,
    delimiter: str = ", ",
    order_by: Sequence | None = None,
    part_chars: int = 1 << 20,
) -> DataFrame:
    """The values of a group joined by ``delimiter``, in parts: the groups, ``part``, ``begin`` and ``text``.

    For groups whose text does not fit into a cell. Parts count from 0 and begin
    at character ``begin`` of the whole; joined in order they are the whole text.
    A part holds whole values and ends with the delimiter, but for the last one;
    a value belongs to the part that its first character lies in. Values are in
    the order of ``order_by``, else in their own; NULLs are left out. Offsets
    come from running lengths over order buckets, so no task sees a whole group.
    """
    require(df, *group_by, column)
    if part_chars < 1:
        raise ValueError(f"a part has one character or more, not {part_chars}")
    named = {"_text", "_length", "_end", "part", "begin", "text"} & {g.lower() for g in group_by}
    if named:
        raise ValueError(f"groups have other names than {sorted(named)}")
    text = converted(col(column), kind_of(df, column), TEXT)
    given = order_keys(df, order_by) if order_by else []
    order = {f"_order{k}": col(key.name) for k, key in enumerate(given)}
    rows = df.select(*[col(g) for g in group_by], text.alias("_text"), *[c.alias(n) for n, c in order.items()]).filter("_text IS NOT NULL")
    rows = rows.withColumn("_length", F.length("_text").cast("bigint") + len(delimiter))
    keys = [*(Key(f"_order{k}", key.descending) for k, key in enumerate(given)), Key("_text")]
    # written once: where rows tie, their offsets must stay as they are
    placed = scan.accumulated(rows, {"_end": "SUM"}, F.col("_length"), group_by, keys)
    placed = materialize(placed.withColumn("begin", F.col("_end") - F.col("_length")), "offsets")
    last = placed.groupBy(*[col(g) for g in group_by]).agg(F.max("_end").alias("_last")) if group_by else placed.agg(F.max("_end").alias("_last"))
    inside = F.floor(F.col("begin") / part_chars).cast("bigint")
    pieces = F.sort_array(F.collect_list(F.struct("begin", "_text")))
    parts = placed.groupBy(*[col(g) for g in group_by], inside.alias("_cell")).agg(pieces.alias("_pieces"), F.max("_end").alias("_end"), F.min("begin").alias("begin"))
    parts = _join_groups(parts, last, group_by)
    joined = F.array_join(F.transform("_pieces", lambda p: p["_text"]), delimiter)
    whole = F.when(F.col("_end") == F.col("_last"), joined).otherwise(F.concat(joined, F.lit(delimiter)))
    number = F.row_number().over(Window.partitionBy(*[col(g) for g in group_by]).orderBy("_cell")) - 1
    return parts.select(*[col(g) for g in group_by], number.cast("bigint").alias("part"), "begin", whole.alias("text"))


def sample_rows(df: DataFrame, fraction: float, keys: Sequence[str], seed: int = 0) -> DataFrame:
    """A repeatable sample: the same rows on every run and on every retry of a task."""
    require(df, *keys)
    text = F.concat_ws("|", F.lit(str(seed)), *[col(k).cast("string") for k in keys])
    draw = F.conv(F.left(F.md5(text), F.lit(8)), 16, 10).cast("bigint")
    return df.filter(draw < int(fraction * 2**32))
