"""One query per operator over the test tables, each with its SQL counterpart."""

from sluice.catalog import (
    aggregation,
    columns,
    filters,
    joining,
    joining_ranges,
    large_results,
    recipes,
    row_values,
    rows,
    sources,
    streams,
    windowing,
)
from sluice.catalog.registry import QUERIES, SQL

__all__ = [
    "QUERIES",
    "SQL",
    "aggregation",
    "columns",
    "filters",
    "joining",
    "joining_ranges",
    "large_results",
    "recipes",
    "row_values",
    "rows",
    "sources",
    "streams",
    "windowing",
]
