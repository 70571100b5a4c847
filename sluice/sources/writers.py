"""Writing tables to files, databases, partitioned tables and request bodies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.conditions import Predicate, as_predicate
from sluice.functions.kinds import DATE, col, kind_of, require
from sluice.operators import scan
from sluice.operators.ordering import order_keys
from sluice.sources.datasets import merge_by_key

# fixed values: file types, database ports, write modes and request sizes
FILE_TYPES = ("csv", "json", "parquet")
PORTS = {"postgres": 5432, "mysql": 3306, "mssql": 1433, "redshift": 5439}
SCHEMES = {"postgres": "postgresql", "mysql": "mysql", "mssql": "sqlserver", "redshift": "redshift"}
TABLE_MODES = ("REPLACE", "COMBINE", "UPSERT")
GRANULARITIES = ("DAY", "MONTH", "YEAR")
REQUEST_ROWS = (1, 10_000)
PARTITION = "_partition"


def write_file(
    df: DataFrame,
    path: str,
    file_type: str = "csv",
    hidden: Sequence[str] = (),
    include_hidden: bool = False,
    formats: Mapping[str, str] | None = None,
    mode: str = "errorifexists",
) -> None:
    """Files in a folder, one per task; ``formats`` writes dates as text of that layout."""
    if file_type not in FILE_TYPES:
        raise ValueError(f"file_type is one of {FILE_TYPES}, not {file_type!r}")
    if not include_hidden:
        df = df.drop(*hidden)
    for name, layout in (formats or {}).items():
        require(df, name)
        df = df.withColumn(name, F.date_format(col(name), layout))
    writer = df.write.mode(mode)
    if file_type != "parquet":
        writer = writer.options(header=True, timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSSSSS")
    if file_type == "csv":
        # quotes are doubled, empty text is "" and spaces stay, so that reading gives the same rows
        writer = writer.options(
            quote='"', escape='"', nullValue="", emptyValue='""', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
    writer.format(file_type).save(path)


def database_target(kind: str, options: Mapping[str, Any]) -> dict[str, Any]:
    """Checked connection options with the default port filled in."""
    if kind not in PORTS:
        raise ValueError(f"unknown database {kind!r}; one of {tuple(PORTS)}")
    needed = ("host", "username", "password", "database", "table")
    allowed = {*needed, "port"}
    target = dict(options)
    missing = [n for n in needed if not str(target.get(n) or "").strip()]
    if missing:
        raise ValueError(f"{kind} needs {', '.join(missing)}")
    unknown = sorted(set(target) - allowed)
    if unknown:
        raise ValueError(f"{kind} does not take {', '.join(unknown)}")
    target.setdefault("port", PORTS[kind])
    return target


def write_jdbc(df: DataFrame, kind: str, mode: str = "append", **options: Any) -> None:
    """A database table. Bad options fail before any job starts."""
    target = database_target(kind, options)
    place = f"{target['host']}:{target['port']}"
    if kind == "mssql":
        url = f"jdbc:sqlserver://{place};databaseName={target['database']}"
    else:
        url = f"jdbc:{SCHEMES[kind]}://{place}/{target['database']}"
    login = {"user": target["username"], "password": target["password"]}
    df.write.jdbc(url, target["table"], mode=mode, properties=login)


def partition_value(
    df: DataFrame, column: str, granularity: str | None, interval: int | None, start: int = 0
):
    """The partition of a row: a truncated date, or the number of its integer range."""
    require(df, column)
    if granularity is not None:
        if granularity not in GRANULARITIES or kind_of(df, column) != DATE:
            raise ValueError(f"date partitions need a DATE column and one of {GRANULARITIES}")
        layout = {"DAY": "yyyy-MM-dd", "MONTH": "yyyy-MM", "YEAR": "yyyy"}[granularity]
        return F.date_format(col(column), layout)
    if not interval or interval < 1:
        raise ValueError("integer partitions need an interval of at least 1")
    return F.floor((col(column) - start) / F.lit(interval)).cast("bigint")


def write_table(
    df: DataFrame,
    path: str,
    export_type: str = "REPLACE",
    upsert_keys: Sequence[str] = (),
    partition_column: str | None = None,
    granularity: str | None = None,
    interval: int | None = None,
    start: int = 0,
    current: str | None = None,
) -> None:
    """A warehouse table: REPLACE, COMBINE (append) or UPSERT by keys.

    UPSERT reads the table at ``current`` and writes the merged one to ``path``,
    which must be another folder.
    """
    if export_type not in TABLE_MODES:
        raise ValueError(f"export_type is one of {TABLE_MODES}, not {export_type!r}")
    if partition_column:
        made = partition_value(df, partition_column, granularity, interval, start)
        df = df.withColumn(PARTITION, made)
    if export_type == "UPSERT":
        if not upsert_keys:
            raise ValueError("UPSERT needs upsert_keys")
        if current is None or current.rstrip("/") == path.rstrip("/"):
            raise ValueError("UPSERT reads the current table and writes to another folder")
        old = df.sparkSession.read.parquet(current)
        if PARTITION in old.columns:
            old = old.withColumn(PARTITION, col(PARTITION).cast(df.schema[PARTITION].dataType))
        df = merge_by_key(old, df, upsert_keys)
    if partition_column:
        # few files per partition; hot partitions are split over tasks
        df = df.hint("rebalance", col(PARTITION))
    writer = df.write.mode("append" if export_type == "COMBINE" else "overwrite")
    if partition_column:
        writer = writer.partitionBy(PARTITION)
    writer.parquet(path)


def request_bodies(
    df: DataFrame,
    order_by: Sequence,
    batch_size: int = 1000,
    wrap_path: str = "records",
    extra_body_fields: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Rows as JSON request bodies of ``batch_size`` records: (batch_no, records, body).

    Batches follow the order without gaps. Sending them is the caller's
    ``foreachPartition``.
    """
    low, high = REQUEST_ROWS
    if not low <= batch_size <= high:
        raise ValueError(f"batch_size lies between {low} and {high}, not {batch_size}")
    keys = order_keys(df, order_by, needed_by="request_bodies")
    record = F.struct(*[col(c) for c in df.columns])
    rows = scan.numbered(df, [], keys).select(
        F.floor((F.col(scan.ROW) - 1) / batch_size).alias("batch_no"),
        F.struct(F.col(scan.ROW).alias("n"), record.alias("r")).alias("item"),
    )
    grouped = rows.groupBy("batch_no").agg(F.array_sort(F.collect_list("item")).alias("items"))
    content = F.transform("items", lambda i: i["r"])
    for name in reversed(wrap_path.split(".")):
        content = F.struct(content.alias(name))
    if extra_body_fields:
        fixed = [F.lit(v).alias(k) for k, v in extra_body_fields.items()]
        content = F.struct(content.getField(wrap_path.split(".")[0]).alias(wrap_path.split(".")[0]), *fixed)
    return grouped.select("batch_no", F.size("items").alias("records"), F.to_json(content).alias("body"))


def conditional_export(
    df: DataFrame,
    path: str,
    condition: Predicate | dict,
    file_type: str = "parquet",
    validate_only: bool = False,
    **options: Any,
) -> list[str]:
    """Write the rows that match; with ``validate_only`` just analyse. Returns the columns."""
    try:
        matching = df.filter(as_predicate(condition).column(df))
        names = matching.columns
    except AnalysisException as error:
        raise ValueError(f"the export does not fit the table: {error}") from error
    if not validate_only:
        write_file(matching, path, file_type, **options)
    return names
