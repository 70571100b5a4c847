"""Datasets made of batches: append, replace, delete, merge and incremental pulls.

Every batch is a Parquet folder of its own, and a small log says which folders
make up the dataset. A change writes new folders and then adds one numbered file
to the log, which must not exist yet: of two writers with the same number one
fails, reads the log again and takes the next. So readers never see half a
change, no change is lost, nothing is overwritten while it is read, and batches
that a change does not touch are not copied. Every so often a file holds all live
batches, and readers start there.

A merge copies no rows either. It adds the new rows as a batch, and the places of
the rows they replace as a deletion of each batch concerned, which readers leave
out. To find them it reads only the files whose range of keys holds a merged key;
ranges are kept per file, once taken. ``compact`` writes batches with deletions
anew, in the order of a key if asked, so that ranges stay narrow.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.conditions import Predicate, as_predicate
from sluice.functions.kinds import col, kind_of, require
from sluice.operators.joins import matching
from sluice.operators.range_joins import join_range
from sluice.operators.rows import keep_first

BATCH = "_batch_id"
# an entry with deletions or ranges adds to its batch; of the others one without a folder
# drops its batch, and one without a batch drops all before it
_LOG = "number bigint, line int, batch string, folder string, schema string, deleted string, ranges string, key string"
_FILE, _PLACE = "_file_name", "_file_row"
_DELETED = f"{_FILE} string, {_PLACE} bigint"


# every so many changes the log says everything anew
_SNAPSHOT = 50


def _hadoop(spark: SparkSession, path: str) -> tuple:
    """The file system Spark uses for a path, and the path there."""
    jvm = spark._jvm
    made = jvm.org.apache.hadoop.fs.Path(path)
    return made.getFileSystem(spark._jsc.hadoopConfiguration()), made


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new small file; false if there is one already."""
    system, made = _hadoop(spark, path)
    try:
        out = system.create(made, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in str(error.java_exception.getClass().getName()) or system.exists(made):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


@dataclass
class _Batch:
    folder: str
    #: folders with places of rows that do not count
    deleted: list[str] = field(default_factory=list)
    #: folder with the ranges of a key in each file, by key
    ranges: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class _State:
    number: int
    batches: dict[str, _Batch]
    schema: T.StructType

    @property
    def folders(self) -> dict[str, str]:
        return {name: batch.folder for name, batch in self.batches.items()}


@dataclass(frozen=True)
class _Entry:
    """One line of the log."""

    batch: str | None = None
    folder: str | None = None
    deleted: str | None = None
    ranges: str | None = None
    key: str | None = None

    def apply(self, live: dict[str, _Batch]) -> None:
        if self.batch is None:
            live.clear()
        elif self.deleted is not None:
            live[self.batch].deleted.append(self.deleted)
        elif self.ranges is not None:
            live[self.batch].ranges[self.key or ""] = self.ranges
        elif self.folder is None:
            live.pop(self.batch, None)
        else:
            live[self.batch] = _Batch(self.folder)


def _entries(live: Mapping[str, _Batch]) -> list[_Entry]:
    """Lines that say all there is about the batches."""
    out = [_Entry()]
    for name, batch in live.items():
        out.append(_Entry(name, batch.folder))
        out += [_Entry(name, deleted=d) for d in batch.deleted]
        out += [_Entry(name, ranges=r, key=k) for k, r in batch.ranges.items()]
    return out


class Dataset:
    """A named folder of batches."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    # -- which folders count ------------------------------------------------

    def _files(self) -> list[tuple[int, bool, str]]:
        """Number, whether it holds everything, and path of each log file, in order."""
        system, path = _hadoop(self.spark, f"{self.root}/log")
        if not system.exists(path):
            return []
        names = [str(f.getPath()) for f in system.listStatus(path)]
        found = [(re.search(r"/(\d+)(-all)?\.json$", n), n) for n in names]
        return sorted((int(m[1]), m[2] is not None, n) for m, n in found if m)

    def _state(self) -> _State | None:
        """The live batches: the last entry of each since everything was last replaced."""
        files = self._files()
        if not files:
            return None
        start = max((n for n, whole, _ in files if whole), default=0)
        log = self.spark.read.schema(_LOG).json([path for n, _, path in files if n >= start])
        rows = sorted(log.collect(), key=lambda r: (r["number"], r["line"] or 0))
        live: dict[str, _Batch] = {}
        schema = ""
        for r in rows:
            schema = r["schema"] or schema
            _Entry(r["batch"], r["folder"], r["deleted"], r["ranges"], r["key"]).apply(live)
        return _State(files[-1][0], live, T.StructType.fromJson(json.loads(schema)))

    def _record(self, state: _State | None, schema: T.StructType, entries: Sequence[_Entry]) -> bool:
        """Make a change count, all at once; false if another change came first."""
        number = (state.number if state else 0) + 1
        whole = number % _SNAPSHOT == 0
        if whole:
            live = {n: _Batch(b.folder, list(b.deleted), dict(b.ranges)) for n, b in state.batches.items()} if state else {}
            for entry in entries:
                entry.apply(live)
            entries = _entries(live)
        made = schema.json()
        lines = []
        for k, entry in enumerate(entries):
            row = {"number": number, "line": k, **asdict(entry), "schema": made if k == 0 else None}
            lines.append(json.dumps({n: v for n, v in row.items() if v is not None}))
        name = f"{number:012d}{'-all' if whole else ''}.json"
        # the same number under either name is a conflict
        taken = {n for n, _, _ in self._files()}
        return number not in taken and _create(self.spark, f"{self.root}/log/{name}", "\n".join(lines) + "\n")

    def _change(self, build: Callable[[_State | None], tuple[T.StructType, list[_Entry]]]) -> None:
        """Commit what ``build`` makes of the state, again if the state has changed meanwhile."""
        while True:
            state = self._state()
            if self._record(state, *build(state)):
                return

    def _write(self, rows: DataFrame, batch: str) -> str:
        folder = f"data/{uuid.uuid4().hex}/{BATCH}={batch}"
        rows.write.parquet(f"{self.root}/{folder}")
        return folder

    def _open(self, state: _State, batches: Sequence[str]) -> DataFrame:
        """Rows of the batches that count, with the name of their batch."""
        if not batches:
            return self._empty(state.schema).withColumn(BATCH, F.lit(""))
        clean = [b for b in batches if not state.batches[b].deleted]
        parts = []
        if clean:
            parts.append(self._scan(state, [f"{self.root}/{state.folders[b]}" for b in clean]).drop(_FILE, _PLACE))
        if len(clean) < len(batches):
            rest = [b for b in batches if state.batches[b].deleted]
            parts.append(self._counting(state, rest, [f"{self.root}/{state.folders[b]}" for b in rest]).drop(_FILE, _PLACE))
        return reduce(DataFrame.unionAll, parts)

    def _scan(self, state: _State, paths: Sequence[str]) -> DataFrame:
        df = self.spark.read.schema(state.schema).parquet(*paths)
        path = F.col("_metadata.file_path")
        return df.select(
            *[col(f.name) for f in state.schema.fields],
            F.regexp_extract(path, f"/{BATCH}=([^/]+)/", 1).alias(BATCH),
            F.regexp_extract(path, "/data/([^/]+/[^/]+/[^/]+)$", 1).alias(_FILE),
            F.col("_metadata.row_index").alias(_PLACE),
        )

    def _counting(self, state: _State, batches: Sequence[str], paths: Sequence[str]) -> DataFrame:
        """Rows of the paths without those that the batches' deletions name."""
        rows = self._scan(state, paths)
        gone = [f"{self.root}/{d}" for b in batches for d in state.batches[b].deleted]
        if not gone:
            return rows
        return rows.join(self.spark.read.schema(_DELETED).parquet(*gone), [_FILE, _PLACE], "left_anti")

    def _empty(self, schema: T.StructType) -> DataFrame:
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
        return self.spark.range(0).select(*nothing)

    def exists(self) -> bool:
        return self._state() is not None

    def read(self, with_batch: bool = False) -> DataFrame:
        state = self._state()
        if state is None:
            raise ValueError(f"no dataset at {self.root}")
        df = self._open(state, list(state.folders))
        return df if with_batch else df.drop(BATCH)

    def batch(self, name: str) -> DataFrame:
        """The rows of one batch."""
        state = self._needed(self._state())
        if name not in state.batches:
            raise ValueError(f"the dataset has no batches {[name]}")
        return self._open(state, [name]).drop(BATCH)

    def batches(self) -> DataFrame:
        """Batches with their row counts."""
        return self.read(True).groupBy(BATCH).agg(F.count(F.lit(1)).alias("rows"))

    # -- changes --------------------------------------------------------------

    def append(
        self,
        source: DataFrame,
        mapping: Mapping[str, str] | None = None,
        batch: str | None = None,
        validate: bool = True,
        change: Mapping[str, Column] | None = None,
    ) -> str:
        """Add rows as one batch; writing a batch again replaces just that batch.

        ``mapping`` is source to target column, ``change`` adjusts columns on
        the way, ``validate`` compares names and kinds with the target.
        """
        rows = source.withColumns(dict(change or {}))
        if mapping:
            require(rows, *mapping)
            rows = rows.select(*[col(s).alias(t) for s, t in mapping.items()])
        state, name = self._state(), _batch_name(batch)
        if state is not None:
            if validate:
                check_schema(rows, self._empty(state.schema))
            rows = _shaped(rows, state.schema)
        folder = self._write(rows, name)

        def build(now: _State | None) -> tuple:
            if now is not None and now.schema != (state.schema if state else rows.schema):
                raise ValueError("the dataset got other columns while rows were appended")
            return rows.schema, [_Entry(name, folder)]

        self._change(build)
        return name

    def replace(self, source: DataFrame, batch: str | None = None) -> str:
        """All content at once."""
        name = _batch_name(batch)
        folder = self._write(source, name)
        self._change(lambda _: (source.schema, [_Entry(), _Entry(name, folder)]))
        return name

    def delete(self, batches: Sequence[str]) -> None:
        """Everything but the given batches; no data is rewritten."""

        def build(state: _State | None) -> tuple:
            unknown = sorted(set(batches) - set(self._needed(state).folders))
            if unknown:
                raise ValueError(f"the dataset has no batches {unknown}")
            return state.schema, [_Entry(b) for b in batches]

        self._change(build)

    def _needed(self, state: _State | None) -> _State:
        if state is None:
            raise ValueError(f"no dataset at {self.root}")
        return state

    def names(self) -> list[str]:
        """Live batches, oldest first."""
        return list(self._needed(self._state()).batches)

    def shaped(self, rows: DataFrame) -> DataFrame:
        """Columns in the order and types of the dataset."""
        return _shaped(rows, self._needed(self._state()).schema)

    def fold(self, batches: Sequence[str], build: Callable[[DataFrame], DataFrame], batch: str | None = None) -> str:
        """One batch made of others takes their place."""
        name = _batch_name(batch)

        def change(state: _State | None) -> tuple[T.StructType, list[_Entry]]:
            state = self._needed(state)
            unknown = sorted(set(batches) - set(state.batches))
            if unknown:
                raise ValueError(f"the dataset has no batches {unknown}")
            folder = self._write(_shaped(build(self._open(state, list(batches))), state.schema), name)
            # first in order, as what it is made of
            rest = {n: b for n, b in state.batches.items() if n not in batches}
            return state.schema, _entries({name: _Batch(folder), **rest})

        self._change(change)
        return name

    def remove(self, condition: Callable[[DataFrame], Column], batch: str | None = None) -> str:
        """Delete rows; their places are named as deleted. ``batch`` names the change, an empty batch."""
        name = _batch_name(batch)

        def change(state: _State | None) -> tuple[T.StructType, list[_Entry]]:
            state = self._needed(state)
            entries = [_Entry(name, self._write(self._empty(state.schema), name))]
            old = self._counting(state, list(state.batches), [f"{self.root}/{f}" for f in state.folders.values()])
            return state.schema, entries + self._deletions(old.filter(condition(old)), list(state.batches))

        self._change(change)
        return name

    def _deletions(self, rows: DataFrame, batches: Sequence[str]) -> list[_Entry]:
        """Name rows of some batches as deleted; few files per batch."""
        folder = f"deleted/{uuid.uuid4().hex}"
        # large batches are split over tasks, small ones share one
        places = rows.select(BATCH, _FILE, _PLACE).hint("rebalance", F.col(BATCH))
        places.write.partitionBy(BATCH).parquet(f"{self.root}/{folder}")
        left = self._written(folder)
        return [_Entry(b, deleted=f"{folder}/{BATCH}={b}") for b in batches if b in left]

    def merge(
        self, source: DataFrame, keys: Sequence[str], order_by: Sequence | None = None, batch: str | None = None
    ) -> str:
        """New keys are added, rows with known keys replaced.

        Keys that are NULL match each other, so merging again changes nothing.
        Nothing is rewritten: the new rows are a batch, and the rows that they
        replace are named as deleted. Only files whose range of the first key
        holds a merged key are read, and of these only the keys.
        """
        name = _batch_name(batch)
        self._change(lambda state: self._merged(self._needed(state), name, source, list(keys), order_by))
        return name

    def _merged(
        self, state: _State, name: str, source: DataFrame, keys: list[str], order_by: Sequence | None
    ) -> tuple[T.StructType, list[_Entry]]:
        latest = _shaped(newest(source, keys, order_by), state.schema)
        entries = [_Entry(name, self._write(latest, name))]
        known = self.spark.read.schema(state.schema).parquet(f"{self.root}/{entries[0].folder}").select(*[col(k) for k in keys])
        entries += self._take_ranges(state, keys[0])
        seen = {**{b: s.ranges.get(keys[0]) for b, s in state.batches.items()}, **{e.batch: e.ranges for e in entries if e.ranges}}
        files = self.candidates(known, keys[0], [r for r in seen.values() if r])
        if files:
            batches = sorted({f.split("/")[1].removeprefix(f"{BATCH}=") for f in files})
            old = self._counting(state, batches, [f"{self.root}/data/{f}" for f in files])
            hit = matching(old.select(*[col(k) for k in keys], BATCH, _FILE, _PLACE), known, keys, null_safe=True)
            entries += self._deletions(hit, batches)
        return state.schema, entries

    def candidates(self, known: DataFrame, key: str, ranges: Sequence[str]) -> list[str]:
        """Files whose range holds one of the known keys; NULL is held by files with NULLs."""
        if not ranges:
            return []
        files = self.spark.read.parquet(*[f"{self.root}/{r}" for r in ranges])
        held = join_range(known.select(col(key).alias("known")).distinct(), files, "known", "low", "high", select=[_FILE])
        found = held.select(_FILE)
        if not known.filter(col(key).isNull()).limit(1).isEmpty():
            found = found.unionAll(files.filter("empty > 0").select(_FILE))
        return sorted(r[0] for r in found.distinct().collect())

    def _take_ranges(self, state: _State, key: str) -> list[_Entry]:
        """The range of a key in each file of the batches for which it is not known yet; reads one column."""
        new = [b for b, s in state.batches.items() if key not in s.ranges]
        if not new:
            return []
        rows = self._scan(state, [f"{self.root}/{state.folders[b]}" for b in new])
        value = col(key)
        per_file = rows.groupBy(BATCH, _FILE).agg(
            F.min(value).alias("low"), F.max(value).alias("high"), F.count_if(value.isNull()).alias("empty")
        )
        folder = f"ranges/{uuid.uuid4().hex}"
        per_file.hint("rebalance", F.col(BATCH)).write.partitionBy(BATCH).parquet(f"{self.root}/{folder}")
        left = self._written(folder)
        return [_Entry(b, ranges=f"{folder}/{BATCH}={b}", key=key) for b in new if b in left]

    def compact(self, batches: Sequence[str] | None = None, key: str | None = None, file_bytes: int = 128 << 20) -> list[str]:
        """Write batches anew without the rows that do not count; by default those that have some.

        With ``key`` a batch's files hold ranges of that key in its order, about
        ``file_bytes`` each. Returns the batches written; the content stays the same.
        """
        chosen: list[str] = []

        def build(state: _State | None) -> tuple[T.StructType, list[_Entry]]:
            state = self._needed(state)
            unknown = sorted(set(batches or ()) - set(state.batches))
            if unknown:
                raise ValueError(f"the dataset has no batches {unknown}")
            chosen[:] = sorted(batches if batches is not None else [b for b, s in state.batches.items() if s.deleted])
            if not chosen:
                return state.schema, []
            rows, folder = self._open(state, chosen), f"data/{uuid.uuid4().hex}"
            if key is None:
                rows = rows.hint("rebalance", F.col(BATCH))
            else:
                size = sum(self._size(state.folders[b]) for b in chosen)
                rows = rows.repartitionByRange(max(1, -(-size // file_bytes)), F.col(BATCH), col(key)).sortWithinPartitions(BATCH, col(key))
            rows.write.partitionBy(BATCH).parquet(f"{self.root}/{folder}")
            left = self._written(folder)
            return state.schema, [_Entry(b, f"{folder}/{BATCH}={b}" if b in left else None) for b in chosen]

        self._change(build)
        return chosen

    def _size(self, folder: str) -> int:
        system, path = _hadoop(self.spark, f"{self.root}/{folder}")
        return int(system.getContentSummary(path).getLength())

    def _written(self, folder: str) -> set[str]:
        """Batches that have a folder below the given one."""
        system, path = _hadoop(self.spark, f"{self.root}/{folder}")
        names = [str(f.getPath().getName()) for f in system.listStatus(path)]
        return {n.removeprefix(f"{BATCH}=") for n in names if n.startswith(f"{BATCH}=")}

    def pull(
        self,
        source: DataFrame,
        sequence_column: str,
        on_refresh: str = "append",
        batch: str | None = None,
    ) -> str | None:
        """Refresh from a source: only rows past the largest sequence value, or all anew."""
        if on_refresh == "replace" or not self.exists():
            return self.replace(source, batch)
        if on_refresh != "append":
            raise ValueError(f"on_refresh is replace or append, not {on_refresh!r}")
        fresh = newer_rows(source, self.read(), sequence_column)
        return self.append(fresh, batch=batch)


def _batch_name(name: str | None) -> str:
    """Names become folder names, so only plain characters."""
    made = name or uuid.uuid4().hex
    if not re.fullmatch(r"[\w.-]+", made, re.ASCII):
        raise ValueError(f"a batch name has letters, digits, dots, dashes only, not {made!r}")
    return made


def _shaped(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in the order and types of the dataset."""
    return rows.select(*[col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def newest(source: DataFrame, keys: Sequence[str], order_by: Sequence | None) -> DataFrame:
    """One row per key: the first in ``order_by``, else in the order of the other columns."""
    return keep_first(source, keys, order_by or [c for c in source.columns if c not in keys])


def check_schema(rows: DataFrame, target: DataFrame) -> None:
    """Names and kinds must agree."""
    differing = sorted(set(rows.columns) ^ set(target.columns))
    if differing:
        raise ValueError(f"columns differ from the target: {differing}")
    for name in target.columns:
        if kind_of(rows, name) != kind_of(target, name):
            raise ValueError(f"column {name!r} has another type than in the target")


def newer_rows(source: DataFrame, target: DataFrame, sequence_column: str) -> DataFrame:
    """Source rows past the largest value seen; the value is a constant in the scan filter."""
    require(source, sequence_column)
    seen = target.agg(F.max(col(sequence_column))).first()[0]
    return source if seen is None else source.filter(col(sequence_column) > F.lit(seen))


def merge_by_key(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence | None = None
) -> DataFrame:
    """Upsert: rows of ``source`` replace those with the same keys and add new ones.

    When a key occurs more than once in the source, the first row in ``order_by``
    counts, so name the newest first. Keys that are NULL match each other.
    """
    require(target, *keys)
    require(source, *keys)
    latest = newest(source, keys, order_by)
    kept = matching(target, source.select(*keys).distinct(), list(keys), matched=False, null_safe=True)
    return kept.unionByName(latest)


def branch_out(
    df: DataFrame,
    target: Dataset,
    mode: str = "REPLACE",
    column_mapping: Mapping[str, str] | None = None,
    condition: Predicate | dict | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Save a table, or a selection of it, as a dataset; returns what was saved there."""
    if mode not in ("REPLACE", "APPEND"):
        raise ValueError(f"mode is REPLACE or APPEND, not {mode!r}")
    if mode == "APPEND" and not target.exists():
        raise ValueError("APPEND needs an existing dataset to append to")
    predicate = as_predicate(condition)
    if predicate is not None:
        df = df.filter(predicate.column(df))
    if transform is not None:
        df = transform(df)
    if column_mapping:
        require(df, *column_mapping)
        df = df.select(*[col(s).alias(t) for s, t in column_mapping.items()])
    if mode == "APPEND":
        target.append(df)
    else:
        target.replace(df)
    return target.read()
