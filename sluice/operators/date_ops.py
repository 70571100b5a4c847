"""Date components, differences, shifts, working days and filled calendars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import dates
from sluice.functions.conditions import Predicate, needs_date
from sluice.functions.kinds import DATE, NUMERIC, col, require
from sluice.operators.targets import Expressions, assigned, column_step
from sluice.session import settled


@column_step
def extract_date(
    df: DataFrame,
    column: str,
    component: str,
    new_column: str | None = None,
    existing_column: str | None = None,
) -> Expressions:
    """One of the components in ``dates.COMPONENTS``; each has a fixed result type."""
    needs_date(df, column)
    kind = dates.component_kind(component)
    return assigned(
        df, dates.component(col(column), component), kind, new_column, existing_column, kind
    )


@column_step
def date_diff(
    df: DataFrame,
    unit: str,
    start: str | None,
    end: str | None,
    new_column: str | None = None,
    existing_column: str | None = None,
) -> Expressions:
    """``end`` minus ``start`` in a unit; ``None`` stands for the current time."""

    def side(name: str | None) -> Column:
        if name is None:
            return F.localtimestamp()
        needs_date(df, name)
        return col(name)

    value = dates.between(unit, side(start), side(end))
    return assigned(df, value, NUMERIC, new_column, existing_column, NUMERIC)


@column_step
def increment_date(
    df: DataFrame,
    column: str,
    delta: dates.Delta | dict,
    new_column: str | None = None,
    existing_column: str | None = None,
    condition: Predicate | dict | None = None,
) -> Expressions:
    """Shift a date; months clamp to the last day of the month."""
    needs_date(df, column)
    step = dates.Delta(**delta) if isinstance(delta, dict) else delta
    shifted = step.shift(col(column)).cast("timestamp_ntz")
    return assigned(df, shifted, DATE, new_column, existing_column, DATE, condition)


def _weekdays_before(day: Column) -> Column:
    """Mondays to Fridays from 1970-01-05, a Monday, up to but without ``day``."""
    since = F.datediff(day, F.lit("1970-01-05").cast("date"))
    weeks = F.floor(since / F.lit(7)).cast("bigint")
    return weeks * 5 + F.least(F.pmod(since, F.lit(7)), F.lit(5))


def business_days(
    df: DataFrame,
    start: str,
    end: str,
    new_column: str,
    holidays: DataFrame | None = None,
    holiday_column: str | None = None,
) -> DataFrame:
    """Working days from ``start`` to ``end``, both included; negative when reversed.

    Weekends come from a closed formula. Holidays are counted up once per
    calendar day, so that the rows need two equality joins and no range join.
    """
    needs_date(df, start)
    needs_date(df, end)
    low, high = F.least(col(start), col(end)), F.greatest(col(start), col(end))
    sign = F.when(col(end) < col(start), -1).otherwise(1)
    days = _weekdays_before(F.date_add(high, 1)) - _weekdays_before(low)
    if holidays is None:
        return df.withColumn(new_column, (days * sign).cast("double"))

    # read five times below, and small: one row per calendar day
    calendar = settled(_holidays_until(holidays, holiday_column or holidays.columns[0]), "calendar")
    for when, day, taken in (
        (F.date_sub(low, 1), "_before_day", "_before"),
        (F.to_date(high), "_until_day", "_until"),
    ):
        side = calendar.select(F.col("first").alias(day), F.col("taken").alias(taken))
        # the calendar covers every day between the first and the last holiday
        bounds = calendar.agg(
            F.min("first").alias("a"), F.max("first").alias("b"), F.max("taken").alias("n")
        )
        first = bounds.select("a").scalar()
        last, total = bounds.select("b").scalar(), bounds.select("n").scalar()
        df = (
            df.join(side, when == F.col(day), "left")
            .withColumn(
                taken,
                F.coalesce(
                    F.col(taken),
                    F.when(when < first, 0).when(when > last, total).otherwise(0),
                ),
            )
            .drop(day)
        )
    taken = F.col("_until") - F.col("_before")
    return df.withColumn(new_column, ((days - taken) * sign).cast("double")).drop(
        "_until", "_before"
    )


def _holidays_until(holidays: DataFrame, column: str) -> DataFrame:
    """One row per calendar day: how many weekday holidays lie on it or before it."""
    from pyspark.sql import Window

    days = (
        holidays.select(F.to_date(col(column)).alias("day"))
        .filter(F.weekday("day") < 5)
        .distinct()
    )
    # at most one row per distinct holiday: hundreds, whatever the data size
    running = Window.partitionBy(F.lit(1)).orderBy("day")
    counted = days.select(
        "day",
        F.row_number().over(running).alias("taken"),
        F.lead("day").over(running).alias("next"),
    )
    until = F.coalesce(F.date_sub("next", 1), F.col("day"))
    return counted.select(F.explode(F.sequence("day", until)).alias("first"), "taken")


def date_scaffold(
    df: DataFrame,
    date_column: str,
    unit: str = "day",
    partition_by: Sequence[str] = (),
    fill: dict[str, object] | None = None,
) -> DataFrame:
    """Insert a row for every missing date step between the first and last date of a key.

    ``df`` should hold one row per key and step. Steps are generated per key
    from its own range; columns in ``fill`` get a constant in the added rows.
    """
    needs_date(df, date_column)
    require(df, *partition_by)
    keys = list(partition_by)
    step = dates.truncated(unit, col(date_column))
    span = df.groupBy(*[col(k) for k in keys]).agg(
        F.min(step).alias("_from"), F.max(step).alias("_to")
    )
    stride = F.expr(f"interval 1 {unit}")
    spine = span.select(
        *[col(k) for k in keys],
        F.explode(F.sequence("_from", "_to", stride)).alias("_step"),
    )
    right = df.withColumn("_at", step).withColumn("_present", F.lit(True))
    for key in keys:
        right = right.withColumnRenamed(key, f"_key_{key}")
    same = F.col("_step") == F.col("_at")
    for key in keys:
        same &= col(key).eqNullSafe(col(f"_key_{key}"))
    joined = spine.join(right, same, "left")
    out = []
    for name in df.columns:
        if name in keys:
            out.append(col(name))
        elif name == date_column:
            out.append(F.coalesce(col(name), F.col("_step")).alias(name))
        elif fill and name in fill:
            value = F.when(F.col("_present").isNull(), F.lit(fill[name])).otherwise(col(name))
            out.append(value.alias(name))
        else:
            out.append(col(name))
    return joined.select(*out)
