"""Landing folders read as streams: pushed rows, arriving files, refreshes and merges.

Every query runs over what is there (``availableNow``) and stops; a scheduler or
a loop starts it again. Each micro-batch writes under its own batch id, so a
batch that runs again after a failure replaces itself.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from concurrent.futures import Future

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.rows import keep_first
from sluice.sources.datasets import BATCH, Dataset, newer_rows
from sluice.sources.readers import csv_options
from sluice.streaming.incremental import KeptPivot, KeptTop, keep, merged_increment

# fixed values: how a file name may match, and webhook modes
NAME_MATCHES = ("contains", "starts_with", "ends_with", "exact")
MODES = ("replace", "combine")


def name_pattern(text: str, match: str = "contains", case_sensitive: bool = True) -> str:
    """A regular expression over file names."""
    if match not in NAME_MATCHES:
        raise ValueError(f"match is one of {NAME_MATCHES}, not {match!r}")
    word = re.escape(text)
    shape = {
        "contains": f"[^/]*{word}[^/]*",
        "starts_with": f"{word}[^/]*",
        "ends_with": f"[^/]*{word}",
        "exact": word,
    }[match]
    return ("" if case_sensitive else "(?i)") + f"(^|.*/){shape}$"


def _run(
    stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, str], None]
) -> None:
    """Run over what is there; ``each`` gets the rows and a batch name of their own.

    The name is the query's id, which its checkpoint keeps, and the epoch: the
    same for a micro-batch that runs again, another for any other stream.
    """
    query_id: Future[str] = Future()

    def named(rows: DataFrame, epoch: int) -> None:
        each(rows, f"{query_id.result()}-epoch-{epoch}")

    query = (
        stream.writeStream.foreachBatch(named)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query_id.set_result(str(query.id))
    query.awaitTermination()


def land_pushed_rows(
    spark: SparkSession,
    folder: str,
    schema: str | T.StructType,
    target: Dataset,
    checkpoint: str,
    mode: str = "combine",
    files_per_batch: int | None = None,
) -> None:
    """JSON rows pushed into ``folder`` go to a dataset: added, or in its place."""
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}, not {mode!r}")
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def each(rows: DataFrame, batch: str) -> None:
        # writing a batch again replaces the same batch
        if mode == "replace":
            target.replace(rows, batch=batch)
        else:
            target.append(rows, batch=batch)

    _run(reader.json(folder), checkpoint, each)


def consolidate_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    target: Dataset,
    checkpoint: str,
    name: str = "",
    match: str = "contains",
    case_sensitive: bool = True,
    subfolders: bool = True,
    file_format: str = "csv",
    quarantine: str | None = None,
    multiline: bool = False,
) -> None:
    """Append arriving files with matching names; rows off the schema are set aside.

    ``multiline`` lets quoted CSV cells hold line ends, with one task per file.

    CSV and JSON rows that do not fit the schema go to ``quarantine`` with the
    name of their file, or fail the run without one.
    """
    reader = spark.readStream.option("recursiveFileLookup", subfolders)
    corrupt = "_corrupt_record"
    if file_format in ("csv", "json"):
        reader = reader.schema(T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())]))
        reader = reader.option("columnNameOfCorruptRecord", corrupt).option("header", True)
        if file_format == "csv":
            reader = reader.options(**csv_options(multiline=multiline))
    else:
        reader = reader.schema(schema)
    stream = reader.format(file_format).load(folder)
    stream = stream.withColumn("_file", F.col("_metadata.file_path"))
    if name:
        stream = stream.filter(
            F.url_decode("_file").rlike(name_pattern(name, match, case_sensitive))
        )

    def each(rows: DataFrame, batch: str) -> None:
        names = [f.name for f in schema.fields]
        if corrupt in rows.columns:
            bad = rows.filter(F.col(corrupt).isNotNull()).select("_file", corrupt)
            if quarantine is not None:
                bad.write.mode("overwrite").parquet(f"{quarantine}/{batch}")
            elif not bad.isEmpty():
                raise ValueError("some rows do not fit the schema and no quarantine is set")
            rows = rows.filter(F.col(corrupt).isNull())
        target.append(rows.select(*names), batch=batch)

    _run(stream, checkpoint, each)


def refresh(
    stream: DataFrame,
    target: Dataset,
    checkpoint: str,
    sequence_column: str,
    on_refresh: str = "append",
) -> None:
    """Rows past the largest sequence value seen are appended, or each batch replaces all."""

    def each(rows: DataFrame, batch: str) -> None:
        if on_refresh == "replace" or not target.exists():
            target.replace(rows, batch=batch)
            return
        # what this epoch wrote before a failure does not count as seen
        seen = target.read(True).filter(F.col(BATCH) != batch).drop(BATCH)
        target.append(newer_rows(rows, seen, sequence_column), batch=batch)

    _run(stream, checkpoint, each)


def merge_increments(
    stream: DataFrame,
    target: Dataset,
    checkpoint: str,
    keys: Sequence[str],
    order_by: Sequence,
    kept: Sequence[KeptPivot | KeptTop] = (),
) -> None:
    """Upsert every increment by key; merging the same increment again changes nothing.

    Aggregates in ``kept`` are corrected by the rows an increment adds and replaces.
    """

    def each(rows: DataFrame, batch: str) -> None:
        if kept:
            merged_increment(target, rows, keys, order_by, kept, batch)
        elif not target.exists():
            target.replace(keep_first(rows, keys, order_by))
        else:
            target.merge(rows, keys, order_by)

    _run(stream, checkpoint, each)


def run_steps(
    stream: DataFrame,
    steps: Callable[[DataFrame], DataFrame],
    target: Dataset,
    checkpoint: str,
    whole: Callable[[DataFrame], DataFrame] | None = None,
    result: Dataset | None = None,
    kept: Sequence[KeptPivot | KeptTop] = (),
) -> None:
    """Row-wise steps on each increment; steps over all rows on the dataset after it.

    Aggregates in ``kept`` take up each increment and read nothing else.
    """

    def each(rows: DataFrame, batch: str) -> None:
        target.append(steps(rows), batch=batch)
        keep(kept, batch, target.batch(batch))
        if whole is not None and result is not None:
            result.replace(whole(target.read()), batch=batch)

    _run(stream, checkpoint, each)
