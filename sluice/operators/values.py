"""Filters, labels, fills, arithmetic and row-wise ranks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import arithmetic
from sluice.functions.conditions import Predicate, as_predicate
from sluice.functions.kinds import (
    DATE,
    NUMERIC,
    TEXT,
    col,
    is_empty,
    kind_of,
    literal,
    require,
    spark_type,
)
from sluice.operators.targets import Expressions, assigned, column_step, where

NOW = "__TIME__"  # fixed value: the system expression for the current time


@dataclass(frozen=True)
class Value:
    """One tier of ``set_values``: a value, and the rows that get it."""

    value: object = None
    condition: Predicate | dict | None = None
    provider: str = "FIXED"


def filter_rows(
    df: DataFrame, condition: Predicate | dict, filter_type: str = "SHOW", run_at: object = None
) -> DataFrame:
    """Keep the rows that match (SHOW) or those that do not (REMOVE).

    A condition that is NULL for a row counts as no match in both cases.
    """
    matched = as_predicate(condition).column(df, run_at)
    if filter_type == "SHOW":
        return df.filter(matched)
    if filter_type == "REMOVE":
        return df.filter(~F.coalesce(matched, F.lit(False)))
    raise ValueError(f"filter_type is SHOW or REMOVE, not {filter_type!r}")


@column_step
def set_values(
    df: DataFrame,
    values: Sequence[Value | dict],
    new_column: str | None = None,
    existing_column: str | None = None,
    column_type: str = TEXT,
    condition: Predicate | dict | None = None,
) -> Expressions:
    """The value of the first tier whose condition holds.

    A tier without condition is the fallback. With no fallback, a new column
    stays NULL and an existing one keeps its value.
    """
    kind = column_type if new_column else kind_of(df, existing_column)

    def provided(tier: Value) -> Column:
        if tier.provider == "EXPRESSION":
            if tier.value != NOW:
                raise ValueError(f"unknown system expression {tier.value!r}")
            return F.localtimestamp()
        return literal(tier.value, kind).cast(spark_type(kind))

    chosen: Column | None = None
    fallback = F.lit(None).cast(spark_type(kind)) if new_column else col(existing_column)
    for spec in values:
        tier = Value(**spec) if isinstance(spec, dict) else spec
        matched = where(df, tier.condition)
        if matched is None:
            fallback = provided(tier)
            break
        value = provided(tier)
        chosen = F.when(matched, value) if chosen is None else chosen.when(matched, value)
    result = fallback if chosen is None else chosen.otherwise(fallback)
    return assigned(df, result, kind, new_column, existing_column, None, condition)


@column_step
def fill_value(df: DataFrame, column: str, value: object) -> Expressions:
    """A constant in every empty cell of a column."""
    kind = kind_of(df, column)
    filled = literal(value, kind)
    return {column: F.when(is_empty(col(column), kind), filled).otherwise(col(column))}


@column_step
def math(
    df: DataFrame,
    expression: str,
    new_column: str | None = None,
    existing_column: str | None = None,
    column_type: str = NUMERIC,
    condition: Predicate | dict | None = None,
) -> Expressions:
    used = arithmetic.columns_in(expression, df.columns)
    wrong = sorted(n for n in used if kind_of(df, n) == DATE)
    if wrong:
        raise ValueError(f"arithmetic needs NUMERIC columns; use date_diff for {wrong}")
    value = arithmetic.expression(expression, df.columns)
    return assigned(df, value, NUMERIC, new_column, existing_column, column_type, condition)


@column_step
def small_large(
    df: DataFrame,
    function: str,
    values: Sequence[str | float],
    index: int = 1,
    new_column: str | None = None,
    existing_column: str | None = None,
    column_type: str = NUMERIC,
) -> Expressions:
    """The ``index``-th smallest or largest of columns and constants, row by row."""
    if not values:
        raise ValueError("small_large needs at least one value")
    if function not in arithmetic.RANKED:
        raise ValueError(f"function is SMALL or LARGE, not {function!r}")
    wrong = [v for v in values if isinstance(v, bool) or not isinstance(v, (str, int, float))]
    if wrong:
        raise ValueError(f"values are column names or numbers, not {wrong[0]!r}")
    require(df, *[v for v in values if isinstance(v, str)])
    sources = [col(v) if isinstance(v, str) else F.lit(float(v)) for v in values]
    picked = arithmetic.ordered_pick(sources, index, function == "SMALL")
    return assigned(df, picked, NUMERIC, new_column, existing_column, column_type)
