"""Profiles, data checks, cell tags, row-level access and dashboard queries."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.conditions import Predicate, as_predicate
from sluice.functions.kinds import NUMERIC, TEXT, col, converted, kind_of, require
from sluice.operators.aggregate import Aggregation, as_aggregation, pivot, sketched_distinct
from sluice.operators.joins import unused
from sluice.operators.rows import limit_rows
from sluice.session import materialize, settled

MAX_WIDGETS = 100  # fixed value: widgets in one request
# relative standard error of a distinct count from a sketch of 2^13 places
DISTINCT_ERROR = 0.0115


def profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    top: int = 5,
    exact: bool = False,
    samples: int = 0,
) -> DataFrame:
    """One row per column: kind, nulls, distinct values, range, mean, spread, top values.

    Distinct counts are sketched unless ``exact``, and ``distinct_error`` is their
    relative standard error; top values are then counted exactly, but looked for
    among the frequent values of a sketch: no value left out occurs more often
    than the larger of ``top_bound`` and the last one listed. The range is over the values
    as text for TEXT, as numbers otherwise; top values come as ``value (count)``.
    ``samples`` adds that many different values, the same ones on every run.
    An exact profile reads the table twice, whatever its number of columns.
    """
    names = list(columns or df.columns)
    require(df, *names)
    kinds = {n: kind_of(df, n) for n in names}

    def measures(name: str) -> Column:
        value, number = col(name), kinds[name] == NUMERIC
        blank = F.lit(None).cast("double")
        text = converted(value, kinds[name], TEXT)
        low, high = (F.min(value), F.max(value)) if kinds[name] != TEXT else (F.min(text), F.max(text))
        distinct = F.lit(0).cast("bigint") if exact else sketched_distinct(value)
        return F.struct(
            F.lit(name).alias("column"),
            F.lit(kinds[name]).alias("kind"),
            F.count(F.lit(1)).alias("rows"),
            F.count_if(value.isNull()).alias("nulls"),
            distinct.alias("distinct_values"),
            converted(low, kinds[name], TEXT).alias("min"),
            converted(high, kinds[name], TEXT).alias("max"),
            (F.avg(value) if number else blank).alias("mean"),
            (F.stddev_samp(value) if number else blank).alias("stddev"),
        )

    one = df.agg(*[measures(n).alias(f"m{i}") for i, n in enumerate(names)])
    rows = one.select(F.inline(F.array(*[F.col(f"m{i}") for i in range(len(names))])))
    percent = F.round(F.try_divide(F.col("nulls") * 100, F.col("rows")), 2)
    rows = rows.withColumn("null_pct", percent)
    if not exact:
        rows = rows.withColumn("distinct_error", F.lit(DISTINCT_ERROR)).join(frequent_values(df, names, top), "column", "left")
        if not samples:
            return rows
    counts = settled(value_counts(df, names), "counts")
    if exact:
        distinct = counts.groupBy("column").agg(F.count(F.lit(1)).alias("_distinct"))
        order = rows.columns
        rows = rows.join(distinct, "column", "left").withColumn("distinct_values", F.coalesce("_distinct", F.lit(0).cast("bigint")))
        rows = rows.select(*order).join(_tops(counts, top), "column", "left")
    if not samples:
        return rows
    # the values with the smallest hashes, a handful per column
    place = Window.partitionBy("column").orderBy(F.xxhash64("value"), "value")
    few = counts.withColumn("place", F.row_number().over(place)).filter(F.col("place") <= samples)
    listed = few.groupBy("column").agg(F.array_sort(F.collect_list("shown")).alias("sample_values"))
    return rows.join(listed, "column", "left")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, value, shown, n`` of all values of all columns, counted in one shuffle.

    ``value`` tells values apart, ``shown`` is how they read as TEXT.
    """
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            col(c).cast("string").alias("value"),
            converted(col(c), kind_of(df, c), TEXT).alias("shown"),
        )
        for c in columns
    ]
    long = df.select(F.inline(F.array(*entries))).filter("value IS NOT NULL")
    return long.groupBy("column", "value").agg(F.any_value("shown").alias("shown"), F.count(F.lit(1)).alias("n"))


def frequent_values(df: DataFrame, columns: Sequence[str], top: int = 5, tracked: int = 1000) -> DataFrame:
    """``column, top_values, top_bound``: frequent values of all columns with exact counts, in two passes.

    A sketch of ``tracked`` values a column, which tasks fill and which are merged,
    names the candidates; only these are then counted. No value left out occurs
    more often than the larger of ``top_bound`` and the last one listed.
    """
    require(df, *columns)
    tracked = max(tracked, 20 * top)
    texts = df.select(*[converted(col(c), kind_of(df, c), TEXT).alias(f"t{i}") for i, c in enumerate(columns)])
    # a sketch is wrong by 3.5 / its places of the rows, and may name a value only if that is certain
    places = 1 << (math.ceil(tracked / 0.75) - 1).bit_length()
    sketches = [F.expr(f"approx_top_k(t{i}, {tracked}, {tracked})").alias(f"s{i}") for i in range(len(columns))]
    counts = [F.count(f"t{i}").alias(f"n{i}") for i in range(len(columns))]
    one = settled(texts.agg(*sketches, *counts), "sketches")

    def items(i: int) -> Column:
        return F.transform(F.col(f"s{i}"), lambda e: F.struct(F.lit(i).alias("i"), e["item"].alias("value")))

    named = one.select(F.inline(F.flatten(F.array(*[items(i) for i in range(len(columns))])))).filter("value IS NOT NULL")
    long = texts.select(F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"t{i}").alias("value")) for i in range(len(columns))])))
    # some thousand candidates at most for each column
    counted = long.join(named, ["i", "value"], "left_semi").groupBy("i", "value").agg(F.count(F.lit(1)).alias("n"))
    label = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("i") + 1)
    tops = _tops(counted.select(label.alias("column"), F.col("value").alias("shown"), "n"), top)
    bounds = one.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.floor(F.col(f"n{i}") * 7 / places).cast("bigint").alias("top_bound"))
                    for i, c in enumerate(columns)
                ]
            )
        )
    )
    return bounds.join(tops, "column", "left").select("column", "top_values", "top_bound")


def top_values(df: DataFrame, columns: Sequence[str], top: int = 5) -> DataFrame:
    """The most frequent values of each column, counted for all columns in one shuffle."""
    return _tops(value_counts(df, columns), top)


def _tops(counts: DataFrame, top: int) -> DataFrame:
    shown = counts.groupBy("column", F.col("shown").alias("value")).agg(F.sum("n").alias("count"))
    place = Window.partitionBy("column").orderBy(F.desc("count"), F.asc("value"))
    kept = shown.withColumn("place", F.row_number().over(place)).filter(F.col("place") <= top)
    entry = F.struct("place", F.concat("value", F.lit(" ("), F.col("count"), F.lit(")")).alias("t"))
    listed = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["t"])
    return kept.groupBy("column").agg(F.array_join(listed, ", ").alias("top_values"))


def join_key_quality(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str
) -> DataFrame:
    """One row on whether two key columns join well: NULLs, uniqueness and overlap."""
    require(left, left_key)
    require(right, right_key)

    def counted(df: DataFrame, key: str, n: str) -> DataFrame:
        return df.groupBy(col(key).alias(f"key_{n}")).agg(F.count(F.lit(1)).alias(n))

    both = counted(left, left_key, "l").join(
        counted(right, right_key, "r"), F.col("key_l") == F.col("key_r"), "full"
    )
    on_left = F.col("l").isNotNull() & F.col("key_l").isNotNull()
    on_right = F.col("r").isNotNull() & F.col("key_r").isNotNull()
    matched = on_left & on_right
    rows = F.when(matched, F.col("l") * F.col("r"))
    return both.agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("r"), F.lit(0)).alias("right_rows"),
        F.coalesce(F.sum(F.when(F.col("key_l").isNull(), F.col("l"))), F.lit(0)).alias("left_nulls"),
        F.coalesce(F.sum(F.when(F.col("key_r").isNull(), F.col("r"))), F.lit(0)).alias("right_nulls"),
        F.count_if(on_left).alias("left_keys"),
        F.count_if(on_right).alias("right_keys"),
        F.count_if(matched).alias("matched_keys"),
        F.coalesce(F.max(F.when(on_left, F.col("l"))), F.lit(0)).alias("left_most_per_key"),
        F.coalesce(F.max(F.when(on_right, F.col("r"))), F.lit(0)).alias("right_most_per_key"),
        F.coalesce(F.sum(rows), F.lit(0)).alias("inner_join_rows"),
    )


# fixed values: kinds of checks
CHECKS = ("not_null", "unique", "in_set", "range", "regex", "reference", "condition", "row_count")


@dataclass(frozen=True)
class Check:
    """A rule every row should meet; ``row_count`` bounds the table instead."""

    name: str
    kind: str
    column: str | None = None
    values: Sequence[Any] = ()
    low: Any = None
    high: Any = None
    pattern: str | None = None
    condition: Predicate | dict | None = None
    reference: DataFrame | None = field(default=None, compare=False)
    reference_column: str | None = None

    def __post_init__(self) -> None:
        if self.kind not in CHECKS:
            raise ValueError(f"unknown check {self.kind!r}; one of {CHECKS}")


def _with_marks(df: DataFrame, checks: Sequence[Check]) -> tuple[DataFrame, dict[str, Column]]:
    """``df`` with helper columns, and for each row check the predicate that it failed."""
    failed: dict[str, Column] = {}
    for number, check in enumerate(checks):
        mark = f"_check_{number}"
        if check.kind == "row_count":
            continue
        if check.column is not None:
            require(df, check.column)
            value, kind = col(check.column), kind_of(df, check.column)
        if check.kind == "not_null":
            bad = value.isNull() | (F.trim(value) == "") if kind == TEXT else value.isNull()
        elif check.kind == "in_set":
            bad = ~value.isin(list(check.values))
        elif check.kind == "range":
            bad = F.lit(False)
            if check.low is not None:
                bad = bad | (value < F.lit(check.low))
            if check.high is not None:
                bad = bad | (value > F.lit(check.high))
        elif check.kind == "regex":
            bad = ~value.rlike(check.pattern)
        elif check.kind == "condition":
            bad = ~as_predicate(check.condition).column(df)
        else:
            if check.kind == "unique":
                known = df.groupBy(value.alias(f"{mark}_key")).count().filter("count > 1")
            else:
                known = check.reference.select(
                    col(check.reference_column or check.column).alias(f"{mark}_key")
                ).distinct()
            known = known.select(f"{mark}_key", F.lit(True).alias(mark))
            df = df.join(known, value == F.col(f"{mark}_key"), "left").drop(f"{mark}_key")
            hit = F.col(mark).isNotNull()
            bad = hit if check.kind == "unique" else (value.isNotNull() & ~hit)
        failed[check.name] = F.coalesce(bad, F.lit(False))
    return df, failed


def as_checks(checks: Sequence[Check | Mapping]) -> list[Check]:
    """Checks, also given as dictionaries, as saved recipes hold them."""
    return [Check(**c) if isinstance(c, Mapping) else c for c in checks]


def _distinct_names(checks: Sequence[Check]) -> None:
    names = [c.name for c in as_checks(checks)]
    again = sorted({n for n in names if names.count(n) > 1})
    if again:
        raise ValueError(f"checks need names of their own; given more than once: {again}")


def flag_rows(df: DataFrame, checks: Sequence[Check], out: str = "failed_checks") -> DataFrame:
    """The rows that fail some check, with the names of the checks they fail."""
    _distinct_names(checks)
    checks = as_checks(checks)
    names = df.columns
    marked, failed = _with_marks(df, checks)
    listed = F.array_compact(F.array(*[F.when(bad, F.lit(n)) for n, bad in failed.items()]))
    flagged = marked.withColumn(out, listed).filter(F.size(out) > 0)
    return flagged.select(*[col(c) for c in names], F.array_join(out, ", ").alias(out))


def check_summary(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check: rows looked at, rows that failed, and whether it passed."""
    _distinct_names(checks)
    checks = as_checks(checks)
    marked, failed = _with_marks(df, checks)
    total = F.count(F.lit(1))
    entries = []
    for check in checks:
        if check.kind == "row_count":
            low = 0 if check.low is None else check.low
            high = 2**62 if check.high is None else check.high
            bad = F.when(total.between(low, high), 0).otherwise(1)
        else:
            bad = F.count_if(failed[check.name])
        entries.append(
            F.struct(
                F.lit(check.name).alias("check"),
                total.alias("rows"),
                bad.cast("bigint").alias("failed"),
                (bad == 0).alias("passed"),
            )
        )
    one = marked.agg(*[e.alias(f"c{i}") for i, e in enumerate(entries)])
    return one.select(F.inline(F.array(*[F.col(f"c{i}") for i in range(len(entries))])))


def conditional_format(
    df: DataFrame, rules: Sequence[tuple[str, str, Predicate | dict]], out: str = "format_tags"
) -> DataFrame:
    """Tags ``column:tag`` for every (tag, column, condition) rule a row matches."""
    tags = []
    for tag, column, condition in rules:
        require(df, column)
        matched = as_predicate(condition).column(df)
        tags.append(F.when(matched, F.lit(f"{column}:{tag}")))
    return df.withColumn(out, F.array_join(F.array_compact(F.array(*tags)), ", "))


def row_level_security(
    df: DataFrame,
    column: str,
    viewer: str,
    assignments: DataFrame,
    viewer_column: str = "viewer",
    value_column: str = "value",
    all_access_column: str = "all_access",
) -> DataFrame:
    """The rows a viewer may see: all with all-access, else those with an assigned value."""
    require(df, column)
    require(assignments, viewer_column, value_column, all_access_column)
    own = assignments.filter(col(viewer_column) == viewer)
    everything = own.agg(F.count_if(col(all_access_column))).scalar() > 0
    allowed = own.select(col(value_column).alias("_allowed")).distinct()
    # with all access one side of the union is the whole table, else the rows with a match
    whole = df.filter(everything)
    return whole.unionAll(df.join(allowed, col(column) == F.col("_allowed"), "left_semi").filter(~everything))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    require(df, column)
    return df.select(col(column)).distinct()


@dataclass(frozen=True)
class Widget:
    """One chart's query: groups, aggregates, own filter, order and limit."""

    group_by: Sequence[str]
    aggregations: Sequence[Aggregation | dict]
    condition: Predicate | dict | None = None
    order_by: Sequence | None = None
    limit: int | None = None


def widget_data(
    df: DataFrame, widgets: Mapping[str, Widget], filters: Sequence[Predicate | dict] = ()
) -> dict[str, DataFrame]:
    """One table per widget, all under the same global and drill-down filters.

    The table is read once: each row goes to the widgets whose filter it passes,
    and one aggregate by widget and group makes all results, which are written
    and read back, a widget's own rows each.
    """
    if len(widgets) > MAX_WIDGETS:
        raise ValueError(f"at most {MAX_WIDGETS} widgets at once, got {len(widgets)}")
    if not widgets:
        return {}
    for condition in filters:
        df = df.filter(as_predicate(condition).column(df))
    listed = list(widgets.values())
    # the results of each widget alone have the names and types that are wanted
    shapes = [pivot(df, w.group_by, w.aggregations, w.condition) for w in listed]
    passed = []
    for k, widget in enumerate(listed):
        predicate = as_predicate(widget.condition)
        passed.append(F.lit(k) if predicate is None else F.when(predicate.column(df), F.lit(k)))
    number = unused("_widget", df.columns)
    dealt = df.withColumn(number, F.explode(F.array_compact(F.array(*passed))))
    bases = list(dict.fromkeys(g for w in listed for g in w.group_by))
    keys = []
    for j, base in enumerate(bases):
        users = [k for k, w in enumerate(listed) if base in w.group_by]
        keys.append(F.when(F.col(number).isin(users), col(base)).alias(f"key{j}"))
    # equal aggregates of several widgets are one
    wanted: list[tuple[Aggregation, list[int]]] = []
    place: dict[tuple[int, int], int] = {}
    for k, widget in enumerate(listed):
        for i, spec in enumerate(map(as_aggregation, widget.aggregations)):
            bare = replace(spec, as_name=None)
            at = next((j for j, (other, _) in enumerate(wanted) if other == bare), len(wanted))
            if at == len(wanted):
                wanted.append((bare, []))
            wanted[at][1].append(k)
            place[k, i] = at
    taken = {}
    for j, (spec, users) in enumerate(wanted):
        only = as_predicate(spec.condition)
        value = col(spec.column) if only is None else F.when(only.column(df), col(spec.column))
        taken[f"value{j}"] = value if len(users) == len(listed) else F.when(F.col(number).isin(users), value)
    narrow = dealt.select(number, *keys, *[c.alias(n) for n, c in taken.items()])
    specs = [Aggregation(f"value{j}", s.function, f"made{j}", s.delimiter, None, s.approximate) for j, (s, _) in enumerate(wanted)]
    made = materialize(pivot(narrow, [number, *[f"key{j}" for j in range(len(bases))]], specs), "widgets")
    out = {}
    for k, (name, widget) in enumerate(widgets.items()):
        own = made.filter(F.col(number) == k)
        if not widget.group_by:
            # a total is there even if there is nothing to add up
            one = df.sparkSession.range(1).select(F.lit(k).alias("w"))
            own = one.join(own, F.col("w") == F.col(number), "left")
        fields = {f.name: f.dataType for f in shapes[k].schema.fields}
        columns = [F.col(f"key{bases.index(g)}").alias(g) for g in widget.group_by]
        for i, spec in enumerate(map(as_aggregation, widget.aggregations)):
            result = F.col(f"made{place[k, i]}")
            if spec.function.startswith("COUNT"):
                result = F.coalesce(result, F.lit(0))
            columns.append(result.cast(fields[spec.name]).alias(spec.name))
        table = own.select(*columns)
        if widget.limit is not None:
            table = limit_rows(table, widget.limit, order_by=widget.order_by)
        out[name] = table
    return out
