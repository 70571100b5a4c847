"""Joins, lookups, unions and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.kinds import TEXT, col, converted, kind_of, kind_of_type, require
from sluice.operators.targets import Expressions, assigned, column_step

# fixed values: join types
JOINS = {"INNER": "inner", "LEFT": "left", "RIGHT": "right", "OUTER": "full"}


def join(
    df: DataFrame,
    other: DataFrame,
    on: Sequence[tuple[str, str] | str | Mapping[str, str]],
    join_type: str = "LEFT",
    select: Sequence[str | tuple[str, str] | Mapping[str, str]] = (),
    column_prefix: str | None = None,
) -> DataFrame:
    """Equality join that brings chosen columns of ``other`` over.

    NULL keys never match. Names that are taken get a numbered suffix. Spark
    picks the strategy from the measured sizes and splits hot keys.
    """
    how = JOINS.get(str(getattr(join_type, "value", join_type)).upper())
    if how is None:
        raise ValueError(f"join_type is one of {tuple(JOINS)}, not {join_type!r}")
    if not on:
        raise ValueError("a join needs at least one key pair")
    pairs = [_pair(item, "left", "right") for item in on]
    require(df, *[left for left, _ in pairs])
    require(other, *[right for _, right in pairs])
    extra = brought(df, other, select, column_prefix)
    keys = [f"_join_key_{i}" for i in range(len(pairs))]
    right = other.select(
        *[col(r).alias(k) for k, (_, r) in zip(keys, pairs, strict=True)],
        *[c.alias(n) for n, c in extra.items()],
    )
    same = reduce(
        lambda a, b: a & b,
        [col(left) == F.col(k) for k, (left, _) in zip(keys, pairs, strict=True)],
    )
    return df.join(right, same, how).drop(*keys)


def brought(
    df: DataFrame,
    other: DataFrame,
    select: Sequence[str | tuple[str, str] | Mapping[str, str]],
    column_prefix: str | None,
) -> dict[str, Column]:
    """Columns of ``other`` under the names they get beside those of ``df``."""
    chosen = [_pair(item, "column", "alias") for item in select]
    require(other, *[name for name, _ in chosen])
    out: dict[str, Column] = {}
    for name, alias in chosen:
        free = f"{column_prefix or ''}{alias}"
        number = 0
        while free in df.columns or free in out:
            number += 1
            free = f"{column_prefix or ''}{alias}_{number}"
        out[free] = col(name)
    return out


def unused(stem: str, names: Sequence[str]) -> str:
    """``stem``, longer if one of the names is the same but for case."""
    taken = {n.lower() for n in names}
    while stem.lower() in taken:
        stem += "_"
    return stem


def _pair(item: object, first: str, second: str) -> tuple[str, str]:
    if isinstance(item, str):
        return item, item
    if isinstance(item, Mapping):
        return item[first], item.get(second) or item[first]
    left, right = item
    return left, right or left


def lookup(
    df: DataFrame,
    source: str,
    other: DataFrame,
    key: str,
    value: str,
    new_column: str | None = None,
    existing_column: str | None = None,
    new_column_type: str | None = None,
) -> DataFrame:
    """One value per key from another table; the number of rows never changes.

    A key that occurs more than once gives its smallest value.
    """
    require(df, source)
    require(other, key, value)
    table = (
        other.filter(col(key).isNotNull())
        .groupBy(col(key).alias("_key"))
        .agg(F.min(col(value)).alias("_found"))
    )
    joined = df.join(table, col(source) == F.col("_key"), "left")
    kind = kind_of(other, value)
    out = assigned(joined, F.col("_found"), kind, new_column, existing_column, new_column_type)
    return joined.withColumns(out).drop("_key", "_found")


@column_step
def lookup_mapping(
    df: DataFrame,
    source: str,
    mapping: Mapping[str, object],
    new_column: str | None = None,
    existing_column: str | None = None,
    new_column_type: str = TEXT,
) -> Expressions:
    """Lookup in a mapping that is part of the step itself."""
    require(df, source)
    pairs = [F.lit(x) for k, v in mapping.items() for x in (str(k), None if v is None else str(v))]
    text = converted(col(source), kind_of(df, source), TEXT)
    found = F.try_element_at(F.create_map(*pairs), text)
    return assigned(df, found, TEXT, new_column, existing_column, new_column_type)


def matching(
    df: DataFrame, other: DataFrame, on: Sequence[tuple[str, str] | str], matched: bool = True, null_safe: bool = False
) -> DataFrame:
    """Rows with a match in ``other``, or those without one; ``null_safe`` lets NULL match NULL."""
    pairs = [_pair(item, "left", "right") for item in on]
    keys = [f"_join_key_{i}" for i in range(len(pairs))]
    right = other.select(*[col(r).alias(k) for k, (_, r) in zip(keys, pairs, strict=True)])
    same = reduce(
        lambda a, b: a & b,
        [
            col(left).eqNullSafe(F.col(k)) if null_safe else col(left) == F.col(k)
            for k, (left, _) in zip(keys, pairs, strict=True)
        ],
    )
    return df.join(right, same, "left_semi" if matched else "left_anti")


def append(*tables: DataFrame) -> DataFrame:
    """Stack tables; names and types must agree, the order of columns need not."""
    if not tables:
        raise ValueError("nothing to append")
    first = tables[0]
    for table in tables[1:]:
        extra = sorted(set(table.columns) ^ set(first.columns))
        if extra:
            raise ValueError(f"columns differ: {extra}")
        for field in first.schema.fields:
            if kind_of(table, field.name) != kind_of_type(field.dataType):
                raise ValueError(f"column {field.name!r} has another type")
    return reduce(DataFrame.unionByName, tables)


def combine_sets(left: DataFrame, right: DataFrame, operation: str) -> DataFrame:
    """SQL set operations by position: UNION, UNION ALL, INTERSECT, EXCEPT, EXCEPT ALL."""
    operations = {
        "UNION": lambda: left.union(right).distinct(),
        "UNION ALL": lambda: left.union(right),
        "INTERSECT": lambda: left.intersect(right),
        "EXCEPT": lambda: left.subtract(right),
        "EXCEPT ALL": lambda: left.exceptAll(right),
    }
    if operation not in operations:
        raise ValueError(f"operation is one of {tuple(operations)}, not {operation!r}")
    return operations[operation]()
