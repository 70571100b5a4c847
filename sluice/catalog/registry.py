"""Where the catalog modules put their queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The Parquet tables of one folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


# Rounding at a half is a matter of the last bit. Means and spreads often end
# in such a half, so both sides round at a place where no short decimal lies.
_PLACE = 0.4321


def steady(value: Column | str, digits: int = 4) -> Column:
    number = (F.col(value) if isinstance(value, str) else value).cast("double")
    scale = float(10**digits)
    return F.floor(number * scale + _PLACE).cast("double") / scale


def steadied(df: DataFrame, *names: str, digits: int = 4) -> DataFrame:
    return df.withColumns({n: steady(n, digits) for n in names})


def steady_sql(expression: str, digits: int = 4) -> str:
    return f"floor(({expression})::DOUBLE * 1e{digits} + {_PLACE}) / 1e{digits}"


def query(name: str, sql: str | None = None):
    """Register a function of the tables, with the SQL that gives the same result."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return build

    return register
