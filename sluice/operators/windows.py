"""Window functions that keep every row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from sluice.functions.kinds import DATE, NUMERIC, TEXT, col, is_empty, kind_of, require
from sluice.operators import scan
from sluice.operators.ordering import Key, order_keys, sorts
from sluice.operators.targets import assigned
from sluice.session import planned_bytes

# fixed values: function and frame names
RANKS = ("ROW_NUMBER", "RANK", "DENSE_RANK", "PERCENT_RANK", "NTILE")
SHIFTS = ("LAG", "LEAD")
EDGES = ("FIRST_VALUE", "LAST_VALUE", "NTH_VALUE")
AGGREGATES = {
    "SUM": F.sum,
    "AVG": F.avg,
    "MIN": F.min,
    "MAX": F.max,
    "COUNT": F.count,
    "STDDEV": F.stddev_samp,
    "VARIANCE": F.var_samp,
}
FRAMES = ("UNBOUNDED", "RUNNING")
_OUT = "_window_value"
# Spark cuts groups to this many rows before the shuffle, and no further
MAX_GROUP_LIMIT = 1000


def window(
    df: DataFrame,
    function: str,
    column: str | None = None,
    new_column: str | None = None,
    existing_column: str | None = None,
    column_type: str | None = None,
    partition_by: Sequence[str] = (),
    order_by: Sequence | None = None,
    range_type: str = "UNBOUNDED",
    offset: int = 1,
    buckets: int = 4,
    rows: int | None = None,
    split: bool | None = None,
) -> DataFrame:
    """A window function into a new or existing column.

    ``range_type`` is the whole group (UNBOUNDED) or all rows so far (RUNNING);
    ``rows`` limits aggregates to the last so many rows instead. ``offset`` is
    the distance of LAG and LEAD and the position of NTH_VALUE; ``buckets`` the
    number of NTILE groups. ``order_by`` should end in a unique column, else
    ties fall in any order.

    ``split`` decides between Spark's own window, which sorts each group inside
    one task, and the bucketed plan, which has no such limit. Left open, groups
    are measured once the input is large, and unpartitioned windows are always
    split.
    """
    function = str(getattr(function, "value", function)).upper()
    known = (*RANKS, *SHIFTS, *EDGES, *AGGREGATES)
    if function not in known:
        raise ValueError(f"unknown window function {function!r}; one of {known}")
    if range_type not in FRAMES:
        raise ValueError(f"range_type is one of {FRAMES}, not {range_type!r}")
    partition_by = list(partition_by)
    require(df, *partition_by, *([column] if column else []))
    if column is None and function not in (*RANKS, "COUNT"):
        raise ValueError(f"{function} needs a column")
    kind = NUMERIC if function in (*RANKS, *AGGREGATES) else kind_of(df, column)
    if function in ("MIN", "MAX"):
        kind = kind_of(df, column)
    value = F.lit(1) if column is None else col(column)

    whole = function in AGGREGATES and rows is None and range_type == "UNBOUNDED"
    if whole:
        framed = _whole_group(df, AGGREGATES[function](value), partition_by, split)
    else:
        keys = order_keys(df, order_by, needed_by=function)
        cut = scan.needs_split(df, partition_by) if split is None else split
        build = _bucketed if cut else _plain
        framed = build(df, function, value, partition_by, keys, range_type, offset, buckets, rows)
    out = assigned(framed, col(_OUT), kind, new_column, existing_column, column_type)
    return framed.withColumns(out).drop(_OUT)


def _whole_group(
    df: DataFrame, aggregate: Column, partition_by: list[str], split: bool | None
) -> DataFrame:
    """One value per group on each of its rows."""
    if not partition_by:
        return df.withColumn(_OUT, df.agg(aggregate).scalar())
    if not split and planned_bytes(df) <= scan.SMALL_INPUT:
        return df.withColumn(_OUT, aggregate.over(Window.partitionBy(*[col(p) for p in partition_by])))
    # partial sums before the shuffle, and a join whose hot keys Spark can split
    group = F.struct(*[col(p) for p in partition_by])
    totals = df.groupBy(group.alias("_group")).agg(aggregate.alias(_OUT))
    return df.withColumn("_group", group).join(totals, "_group", "left").drop("_group")


def _plain(
    df: DataFrame,
    function: str,
    value: Column,
    partition_by: list[str],
    keys: list[Key],
    range_type: str,
    offset: int,
    buckets: int,
    rows: int | None,
) -> DataFrame:
    base = Window.partitionBy(*[col(p) for p in partition_by]).orderBy(*sorts(keys))
    start, end = Window.unboundedPreceding, Window.unboundedFollowing
    frame = base.rowsBetween(start, end if range_type == "UNBOUNDED" else Window.currentRow)
    if rows is not None:
        frame = base.rowsBetween(-(rows - 1), Window.currentRow)
    ranks = {
        "ROW_NUMBER": F.row_number,
        "RANK": F.rank,
        "DENSE_RANK": F.dense_rank,
        "PERCENT_RANK": F.percent_rank,
        "NTILE": lambda: F.ntile(buckets),
    }
    if function in ranks:
        result = ranks[function]().over(base)
        # the type of the bucketed plan
        result = result if function == "PERCENT_RANK" else result.cast("bigint")
    elif function in SHIFTS:
        result = _shift(function, value, offset)(base)
    elif function == "FIRST_VALUE":
        result = F.first(value).over(frame)
    elif function == "LAST_VALUE":
        result = F.last(value).over(frame)
    elif function == "NTH_VALUE":
        result = F.nth_value(value, offset).over(frame)
    else:
        result = AGGREGATES[function](value).over(frame)
    return df.withColumn(_OUT, result)


def _shift(function: str, value: Column, offset: int):
    move = F.lag if function == "LAG" else F.lead
    return lambda spec: move(value, offset).over(spec)


def _bucketed(
    df: DataFrame,
    function: str,
    value: Column,
    partition_by: list[str],
    keys: list[Key],
    range_type: str,
    offset: int,
    buckets: int,
    rows: int | None,
) -> DataFrame:
    if function in RANKS:
        return scan.ranked(df, function, partition_by, keys, _OUT, buckets)
    if function in SHIFTS:
        before, after = (offset, 0) if function == "LAG" else (0, offset)
        moved = _shift(function, value, offset)
        return scan.framed(df, moved, partition_by, keys, before, after, _OUT)
    if rows is not None:
        if function not in AGGREGATES:
            raise ValueError(f"rows applies to aggregates, not to {function}")
        return scan.framed(
            df,
            lambda spec: AGGREGATES[function](value).over(spec.rowsBetween(-(rows - 1), 0)),
            partition_by,
            keys,
            rows - 1,
            0,
            _OUT,
        )
    if function == "LAST_VALUE" and range_type == "RUNNING":
        return df.withColumn(_OUT, value)
    if function in ("FIRST_VALUE", "LAST_VALUE"):
        return scan.edge_value(df, value, function == "LAST_VALUE", partition_by, keys, _OUT)
    if function == "NTH_VALUE":
        return _nth(df, value, partition_by, keys, range_type, offset)
    return scan.accumulated(df, {_OUT: function}, value, partition_by, keys)


def _nth(
    df: DataFrame,
    value: Column,
    partition_by: list[str],
    keys: list[Key],
    range_type: str,
    position: int,
) -> DataFrame:
    rows = scan.numbered(df, partition_by, keys)
    picked = rows.filter(F.col(scan.ROW) == position).select(scan.GROUP, value.alias("_nth"))
    joined = rows.join(picked, scan.GROUP, "left")
    reached = F.lit(True) if range_type == "UNBOUNDED" else F.col(scan.ROW) >= position
    return joined.withColumn(_OUT, F.when(reached, F.col("_nth"))).drop(
        "_nth", scan.ROW, scan.GROUP
    )


def running_aggregates(
    df: DataFrame,
    column: str,
    functions: Mapping[str, str],
    partition_by: Sequence[str] = (),
    order_by: Sequence | None = None,
    split: bool | None = None,
) -> DataFrame:
    """Several running aggregates of one column at once: ``{new column: function}``.

    The same as one ``window`` step each, in a single pass over the buckets.
    """
    require(df, column, *partition_by)
    wrong = [f for f in functions.values() if f not in AGGREGATES]
    if wrong:
        raise ValueError(f"unknown aggregate {wrong[0]!r}; one of {tuple(AGGREGATES)}")
    keys = order_keys(df, order_by, needed_by="running_aggregates")
    if scan.needs_split(df, partition_by) if split is None else split:
        return scan.accumulated(df, functions, col(column), partition_by, keys)
    base = Window.partitionBy(*[col(p) for p in partition_by]).orderBy(*sorts(keys))
    run = base.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns(
        {out: AGGREGATES[f](col(column)).over(run) for out, f in functions.items()}
    )


def fill_missing(
    df: DataFrame,
    column: str,
    direction: str = "LAST_VALUE",
    partition_by: Sequence[str] | str | None = None,
    order_by: Sequence | None = None,
    split: bool | None = None,
) -> DataFrame:
    """Copy the nearest value into empty cells: down (LAST_VALUE) or up (FIRST_VALUE)."""
    if direction not in ("LAST_VALUE", "FIRST_VALUE"):
        raise ValueError(f"direction is LAST_VALUE or FIRST_VALUE, not {direction!r}")
    groups = [partition_by] if isinstance(partition_by, str) else list(partition_by or ())
    require(df, column, *groups)
    keys = order_keys(df, order_by, needed_by="fill_missing")
    kind = kind_of(df, column)
    present = F.when(~is_empty(col(column), kind), col(column)) if kind == TEXT else col(column)
    up = direction == "FIRST_VALUE"
    if scan.needs_split(df, groups) if split is None else split:
        filled = scan.last_present(df, present, groups, keys, _OUT, reverse=up)
    else:
        spec: WindowSpec = Window.partitionBy(*[col(g) for g in groups]).orderBy(*sorts(keys, up))
        spec = spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        filled = df.withColumn(_OUT, F.last(present, ignorenulls=True).over(spec))
    # a blank with nothing to copy stays as it is
    return filled.withColumn(column, F.coalesce(col(_OUT), col(column))).drop(_OUT)


def top_per_group(
    df: DataFrame, n: int, partition_by: Sequence[str], order_by: Sequence
) -> DataFrame:
    """The first ``n`` rows of each group; groups are cut to ``n`` before the shuffle."""
    require(df, *partition_by)
    keys = order_keys(df, order_by, needed_by="top_per_group")
    if n > MAX_GROUP_LIMIT and scan.needs_split(df, partition_by):
        rows = scan.numbered(df, partition_by, keys)
        return rows.filter(F.col(scan.ROW) <= n).drop(scan.ROW, scan.GROUP)
    spec = Window.partitionBy(*[col(p) for p in partition_by]).orderBy(*sorts(keys))
    return df.withColumn("_place", F.row_number().over(spec)).filter(F.col("_place") <= n).drop(
        "_place"
    )


def growth(
    df: DataFrame, date_column: str, value_column: str, unit: str = "month", digits: int = 1
) -> DataFrame:
    """Totals per period with the previous period and the change in percent."""
    from sluice.functions.dates import truncated

    if kind_of(df, date_column) != DATE:
        raise ValueError(f"{date_column!r} is not a DATE column")
    period = truncated(unit, col(date_column))
    totals = df.groupBy(period.alias("period")).agg(F.sum(col(value_column)).alias("total"))
    # one row per period: the sequence is as short as the calendar
    spec = Window.partitionBy(F.lit(1)).orderBy("period")
    change = F.try_divide(F.col("total") - F.col("previous"), F.col("previous")) * 100
    return totals.withColumn("previous", F.lag("total").over(spec)).withColumn(
        "growth_pct", F.round(change, digits)
    )


def cohorts(df: DataFrame, key: str, date_column: str, unit: str = "MONTH") -> DataFrame:
    """Distinct keys still active so many periods after their first one."""
    from sluice.functions.dates import between, truncated

    period = truncated(unit, col(date_column))
    # one row per key and period first: hot keys shrink before the window
    active = df.select(col(key).alias("_key"), period.alias("_period")).distinct()
    first = F.min("_period").over(Window.partitionBy("_key"))
    return (
        active.withColumn("cohort", first)
        .withColumn("period_offset", between(unit, F.col("cohort"), F.col("_period")))
        .groupBy("cohort", "period_offset")
        .agg(F.count_distinct("_key").alias("active"))
    )


def recency_frequency_monetary(
    df: DataFrame, key: str, date_column: str, amount_column: str, as_of: str
) -> DataFrame:
    """Days since the last purchase, number of purchases and their total, per key."""
    from sluice.functions.dates import between

    moment = F.lit(as_of).cast("timestamp_ntz")
    return df.groupBy(col(key)).agg(
        between("DAY", F.max(col(date_column)), moment).alias("recency"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum(col(amount_column)).alias("monetary"),
    )
