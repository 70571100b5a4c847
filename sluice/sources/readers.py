"""Reading files and tables into DataFrames with the three column kinds."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.kinds import col, java_layout, parse_date
from sluice.sources.quoted import open_after, parsed, records

DELIMITERS = (",", "\t", "|", ";")  # fixed values: separators a CSV file may use
FILE_COLUMN = "_source_file"
NULL_MARK = "\x00"


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    delimiter: str = ",",
    has_header: bool = True,
    skip_rows: int = 0,
    quote: str = '"',
    schema: str | T.StructType | None = None,
    date_format: str | None = None,
    date_formats: Mapping[str, str] | None = None,
    multiline: bool = False,
) -> DataFrame:
    """CSV files as a table.

    A quote inside quotes is doubled, an empty cell is NULL and ``""`` is empty
    text. With ``multiline`` quoted cells may hold line ends; files are split all
    the same, and records are cut in two passes (see ``quoted``). Without it one
    pass is enough, and a cell whose quote is still open at the end of its line
    fails the read instead of giving broken rows.

    Without a schema numbers and ISO timestamps are typed and everything else
    is TEXT. ``date_formats`` (per column) and ``date_format`` (all columns with
    a slash date) read other dates: a layout, ``US`` or ``UK``. ``skip_rows``
    drops that many lines at the top of every file, before the header.
    """
    if delimiter not in DELIMITERS:
        raise ValueError(f"delimiter is one of {DELIMITERS}, not {delimiter!r}")
    options = csv_options(delimiter, quote)
    if multiline:
        found = records(lambda: spark.read, path, delimiter, quote, skip_rows)
        df = _naive_dates(_cells(found, options, has_header, schema, prefersDate=False).drop(FILE_COLUMN))
        return with_dates(df, date_format, date_formats)
    check_closed_quotes(spark.read.text(path), delimiter, quote)
    if skip_rows:
        df = _skipping(spark, path, skip_rows, has_header, options, schema)
        df = df if schema is not None else inferred(df)
    else:
        reader = spark.read.options(header=has_header, **options)
        if schema is not None:
            df = reader.schema(schema).csv(path)
        else:
            df = reader.options(inferSchema=True, prefersDate=False).csv(path)
            df = _naive_dates(df)
    return with_dates(df, date_format, date_formats)


def csv_options(delimiter: str = ",", quote: str = '"', multiline: bool = False) -> dict[str, object]:
    """How CSV is read and written here: what one side writes the other reads back."""
    # a NULL is nothing between two delimiters; a mark no cell holds keeps "" apart from it
    return {"sep": delimiter, "quote": quote, "escape": quote, "nullValue": NULL_MARK, "emptyValue": "", "multiLine": multiline}


def check_closed_quotes(lines: DataFrame, delimiter: str = ",", quote: str = '"') -> None:
    """Fail if a line ends inside quotes; one pass that stops at the first such line."""
    left_open = open_after(F.col("value"), delimiter, quote, False)
    bad = lines.filter(F.col("value").contains(quote) & left_open).limit(1).collect()
    if bad:
        start = bad[0]["value"][:60]
        raise ValueError(f"a quoted cell holds a line end; read the files with multiline=True: {start!r}")


def _naive_dates(df: DataFrame) -> DataFrame:
    dated = [f.name for f in df.schema if isinstance(f.dataType, (T.TimestampType, T.DateType))]
    return df.withColumns({n: col(n).cast("timestamp_ntz") for n in dated})


def _skipping(
    spark: SparkSession,
    path: str | Sequence[str],
    skip_rows: int,
    has_header: bool,
    options: Mapping[str, str],
    schema: str | T.StructType | None,
) -> DataFrame:
    """Lines after the first ones of each file, parsed on the executors.

    The file's first split holds its first lines: lines are numbered inside a
    split only, so no split needs to know about another.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id"),
    )
    drop = skip_rows + (1 if has_header else 0)
    heads = lines.filter("start = 0").groupBy("file").agg(F.min("id").alias("first"))
    # one row per file
    body = lines.join(heads, "file", "left").filter(
        (F.col("start") > 0) | (F.col("id") - F.col("first") >= drop)
    )
    if schema is None:
        first_file = lines.filter("start = 0").orderBy("file", "id").limit(drop + 1)
        top = [r["value"] for r in first_file.select("value").collect()]
        names = top[skip_rows] if has_header else top[-1]
        cells = next(csv.reader([names], delimiter=options["sep"], quotechar=options["quote"]))
        if not has_header:
            cells = [f"_c{i}" for i in range(len(cells))]
        typed = T.StructType([T.StructField(c, T.StringType()) for c in cells])
    else:
        typed = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    parsed = F.from_csv("value", _ddl(typed), dict(options))
    return body.select(parsed.alias("row")).select("row.*")


def _cells(
    found: DataFrame,
    options: Mapping[str, object],
    has_header: bool,
    schema: str | T.StructType | None,
    **inference: object,
) -> DataFrame:
    """Records as rows, with the file each came from; without a schema columns are typed as Spark types them."""
    spark = found.sparkSession
    body = found.filter(~F.col("first")) if has_header else found
    if schema is not None:
        typed = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    else:
        plain = lambda: spark.read.options(**options)
        names = None
        if has_header:
            top = found.filter("first").orderBy("file").limit(1)
            cells = [str(c) for c in (parsed(plain(), top).first() or ())]
            names = [c if cells.count(c) == 1 else f"{c}{k}" for k, c in enumerate(cells)]
        seen = parsed(plain().options(inferSchema=True, **inference), body).schema.fields
        if names is None:
            names = [f.name for f in seen]
        kinds = [f.dataType for f in seen]
        # rows shorter or longer than the header say nothing about columns they lack
        kinds = kinds if len(kinds) == len(names) else [T.StringType()] * len(names)
        typed = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)])
    row = F.from_csv("record", _ddl(typed), {k: str(v) for k, v in options.items()})
    rows = body.select(row.alias("row"), F.col("file").alias(FILE_COLUMN))
    return rows.select(*[F.col("row")[f.name].alias(f.name) for f in typed.fields], FILE_COLUMN)


def inferred(df: DataFrame) -> DataFrame:
    """TEXT columns whose filled cells all read as numbers or ISO times, as such; one pass."""
    kinds = ("bigint", "double", "timestamp_ntz")
    checks = [F.count(col(c)).alias(f"n{i}") for i, c in enumerate(df.columns)]
    for i, name in enumerate(df.columns):
        for kind in kinds:
            fits = F.count(F.trim(col(name)).try_cast(kind))
            checks.append(fits.alias(f"{kind}{i}"))
    seen = df.agg(*checks).first()
    casts = {}
    for i, name in enumerate(df.columns):
        for kind in kinds:
            if seen[f"n{i}"] and seen[f"{kind}{i}"] == seen[f"n{i}"]:
                casts[name] = F.trim(col(name)).try_cast(kind)
                break
    return df.withColumns(casts)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def with_dates(
    df: DataFrame, date_format: str | None, date_formats: Mapping[str, str] | None
) -> DataFrame:
    """Parse TEXT columns by their layouts; unreadable dates become NULL."""
    for name, layout in (date_formats or {}).items():
        df = df.withColumn(name, parse_date(col(name).cast("string"), [layout]))
    if date_format is None:
        return df
    left = [
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.StringType) and f.name not in (date_formats or {})
    ]
    if not left:
        return df
    # a column is a date column when every filled cell reads as a date
    java_layout(date_format)
    checks = [
        F.count_if(col(n).isNotNull() & parse_date(col(n), [date_format]).isNull()).alias(f"b{i}")
        for i, n in enumerate(left)
    ]
    filled = [F.count(col(n)).alias(f"n{i}") for i, n in enumerate(left)]
    seen = df.agg(*checks, *filled).first()
    dated = [n for i, n in enumerate(left) if seen[f"b{i}"] == 0 and seen[f"n{i}"] > 0]
    return df.withColumns({n: parse_date(col(n), [date_format]) for n in dated})


def read_folder(
    spark: SparkSession,
    path: str,
    file_format: str = "csv",
    pattern: str | None = None,
    schema: str | T.StructType | None = None,
    **options: object,
) -> DataFrame:
    """Every matching file below a folder as one table, with the file it came from."""
    reader = spark.read.format(file_format).option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if file_format == "csv":
        given = {"multiLine": "false", "sep": ",", "quote": '"', **options}

        def lines() -> DataFrameReader:
            made = spark.read.option("recursiveFileLookup", True)
            return made.option("pathGlobFilter", pattern) if pattern else made

        if str(given["multiLine"]).lower() == "true":
            found = records(lines, path, str(given["sep"]), str(given["quote"]))
            return _cells(found, {**csv_options(str(given["sep"]), str(given["quote"])), **options, "multiLine": False}, True, schema)
        check_closed_quotes(lines().text(path), str(given["sep"]), str(given["quote"]))
        options = {**csv_options(str(given["sep"]), str(given["quote"])), "multiLine": given["multiLine"], **options}
        reader = reader.options(header=True, inferSchema=schema is None)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.options(**options).load(path)
    return df.withColumn(FILE_COLUMN, F.col("_metadata.file_path"))


def read_json(
    spark: SparkSession, path: str, schema: str | T.StructType | None = None, **options: object
) -> DataFrame:
    reader = spark.read.options(**options)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str | None = None,
    query: str | None = None,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 16,
    sample: int | None = None,
) -> DataFrame:
    """A database table or query; with a partition column in parallel range reads."""
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table and query")
    source = table if table else f"({query}) q"
    reader = spark.read.format("jdbc").options(url=url, dbtable=source, **(properties or {}))
    if partition_column:
        if bounds is None:
            raise ValueError("a partitioned read needs bounds")
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=partitions,
        )
    df = reader.load()
    return df if sample is None else df.limit(sample)
