"""Writing results into a new or an existing column, under an optional condition."""

from __future__ import annotations

import functools
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.conditions import Predicate, as_predicate
from sluice.functions.kinds import col, converted, kind_of, require, spark_type

Expressions = dict[str, Column]


def column_step(build: Callable[..., Expressions]) -> Callable[..., DataFrame]:
    """Make an operator out of a function that returns ``{column name: expression}``.

    A recipe can merge neighbouring column steps into one projection through
    the ``expressions`` attribute.
    """

    @functools.wraps(build)
    def operator(df: DataFrame, *args: Any, **kwargs: Any) -> DataFrame:
        return df.withColumns(build(df, *args, **kwargs))

    operator.expressions = build  # type: ignore[attr-defined]
    return operator


def where(df: DataFrame, condition: Predicate | dict | None) -> Column | None:
    predicate = as_predicate(condition)
    return None if predicate is None else predicate.column(df)


def assigned(
    df: DataFrame,
    value: Column,
    value_kind: str,
    new_column: str | None = None,
    existing_column: str | None = None,
    new_kind: str | None = None,
    condition: Predicate | dict | None = None,
) -> Expressions:
    """``value`` in exactly one of a new or an existing column.

    Rows that miss the condition keep the old value, or NULL in a new column.
    """
    if bool(new_column) == bool(existing_column):
        raise ValueError("give exactly one of new_column and existing_column")
    if new_column:
        if new_column in df.columns:
            raise ValueError(f"column {new_column!r} exists; write to it with existing_column")
        if new_kind:
            spark_type(new_kind)
            value = converted(value, value_kind, new_kind)
        name, old = new_column, None
    else:
        require(df, existing_column)
        name, old = existing_column, col(existing_column)
        value = converted(value, value_kind, kind_of(df, existing_column))
    matched = where(df, condition)
    if matched is not None:
        chosen = F.when(matched, value)
        value = chosen if old is None else chosen.otherwise(old)
    return {name: value}


def rewritten(
    df: DataFrame,
    columns: list[str],
    change: Callable[[Column], Column],
    condition: Predicate | dict | None = None,
) -> Expressions:
    """The same in-place change on several columns."""
    require(df, *columns)
    matched = where(df, condition)
    out = {}
    for name in columns:
        value = change(col(name))
        out[name] = value if matched is None else F.when(matched, value).otherwise(col(name))
    return out
