"""Records of CSV files whose quoted cells hold line ends, read in splits.

Whether a line begins inside quotes depends on all lines before it. But what a
line does to that is a function of one bit, known from the line alone, and such
functions can be composed. So one pass composes the functions of each split, the
compositions give the state at the beginning of every split, and a second pass
cuts each split into records on its own. Of a record that runs over the edge of a
split there is a piece on either side; only these pieces, two per split at most,
are brought together.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, DataFrameReader, Window
from pyspark.sql import functions as F

from sluice.session import settled

# what a line does: ends outside, changes sides, stays, or ends inside quotes
_OUT, _TURN, _STAY, _IN = 0, 1, 2, 3


def open_after(line: Column, delimiter: str, quote: str, inside: bool) -> Column:
    """Whether a line that begins outside (or inside) a quoted cell ends inside one.

    A cell is quoted if the quote is its first character, a quote in it is
    doubled, and what follows its closing quote belongs to it unquoted.
    """
    q, d = re.escape(quote), re.escape(delimiter)
    body = f"[^{q}]*+(?:{q}{q}[^{q}]*+)*+{q}"
    if not inside:
        # what is left after all closed cells must not begin a quoted cell
        return F.regexp_replace(line, f"(^|{d}){q}{body}", "$1").rlike(f"(^|{d}){q}")
    rest = F.regexp_replace(line, f"^{body}", "x")
    return F.when(line.rlike(f"^{body}"), open_after(rest, delimiter, quote, False)).otherwise(F.lit(True))


def _states(effect: np.ndarray, state: bool) -> tuple[np.ndarray, bool]:
    """Whether each line begins inside quotes, and whether the last one ends there."""
    n = len(effect)
    fixed = (effect == _OUT) | (effect == _IN)
    last = np.concatenate([[-1], np.maximum.accumulate(np.where(fixed, np.arange(n), -1))])
    turns = np.concatenate([[0], np.cumsum(effect == _TURN)])
    known = last >= 0
    at = np.maximum(last, 0)
    base = np.where(known, effect[at] == _IN if n else state, state)
    since = turns - np.where(known, turns[np.minimum(at + 1, n)], 0)
    states = base ^ (since % 2 == 1)
    return states[:-1], bool(states[-1])


def _segments(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Rows of a batch that lie in the same split."""
    key = batch.column("split").to_numpy()
    cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
    return zip(cuts[:-1], cuts[1:], strict=True)


def records(lines: Callable[[], DataFrameReader], path: str | Sequence[str], delimiter: str, quote: str, skip: int = 0) -> DataFrame:
    """``record, first, file``: the records of CSV files, ``first`` for the first of each file.

    ``lines`` makes a reader with the options that choose files. The first
    ``skip`` lines of every file are left out, whatever they hold.
    """
    read = lines().option("lineSep", "\n").text(path)
    value = F.col("value")
    effect = F.when(~value.contains(quote), F.lit(_STAY)).otherwise(
        open_after(value, delimiter, quote, False).cast("int") + 2 * open_after(value, delimiter, quote, True).cast("int")
    )
    named = read.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    told = named.select("value", "file", "start", F.xxhash64("file", "start").alias("split"), effect.cast("byte").alias("effect"))

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple[int, str, int] | None = None
        ends, seen = [False, True], 0

        def row() -> pa.RecordBatch:
            arrays = [pa.array([now[0]]), pa.array([now[1]]), pa.array([now[2]]), pa.array([ends[0]]), pa.array([ends[1]])]
            return pa.RecordBatch.from_arrays(arrays, ["split", "file", "start", "from_out", "from_in"])

        for batch in batches:
            for a, b in _segments(batch):
                if a == b:
                    continue
                split = batch.column("split")[a].as_py()
                if now is None or now[0] != split:
                    if now is not None:
                        yield row()
                    now, ends, seen = (split, batch.column("file")[a].as_py(), batch.column("start")[a].as_py()), [False, True], 0
                effects = batch.column("effect").to_numpy()[a:b].copy()
                if now[2] == 0 and seen < skip:
                    effects[: skip - seen] = _STAY
                seen += b - a
                ends = [_states(effects, end)[1] for end in ends]
        if now is not None:
            yield row()

    splits = told.select("split", "file", "start", "effect").mapInArrow(compose, "split long, file string, start long, from_out boolean, from_in boolean")
    # one row per split from here on
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fixed, turned = F.col("from_out") == F.col("from_in"), F.col("from_out") & ~F.col("from_in")
    running = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    counted = splits.withColumn("turns", F.count_if(turned).over(running))
    known = F.last(F.when(fixed, F.struct("from_out", "turns")), ignorenulls=True).over(before)
    prior = counted.withColumns({"known": known, "passed": F.coalesce(F.lag("turns").over(Window.partitionBy("file").orderBy("start")), F.lit(0))})
    state = F.coalesce(F.col("known.from_out"), F.lit(False)) != (F.pmod(F.col("passed") - F.coalesce(F.col("known.turns"), F.lit(0)), F.lit(2)) == 1)
    # a number for each split that begins inside quotes
    inside = frozenset(r["split"] for r in prior.filter(state).select("split").collect())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, seen = None, False, 0
        file, start = "", 0
        # the record that is still open: its lines, whether it began in this split, whether it is the file's first
        held: list[str] = []
        own, top = True, False
        out: list[tuple] = []

        def close(complete: bool) -> None:
            nonlocal held
            if held:
                whole = complete and own
                out.append(("\n".join(held), top, file, start, None if whole else int(own)))
            held = []

        for batch in batches:
            values = batch.column("value").to_pylist()
            for a, b in _segments(batch):
                if a == b:
                    continue
                split = batch.column("split")[a].as_py()
                if now != split:
                    close(not state)
                    now, state, seen = split, split in inside, 0
                    file, start = batch.column("file")[a].as_py(), batch.column("start")[a].as_py()
                effects = batch.column("effect").to_numpy()[a:b].copy()
                left_out = max(0, min(skip - seen, b - a)) if start == 0 else 0
                effects[:left_out] = _STAY
                states, after = _states(effects, state)
                for k in range(left_out, b - a):
                    if states[k] and held:
                        held.append(values[a + k])
                        continue
                    if not states[k]:
                        close(True)
                    own, top = not states[k], start == 0 and seen + k == skip
                    held = [values[a + k]]
                state, seen = after, seen + b - a
            yield _rows(out)
            out = []
        close(not state)
        yield _rows(out)

    # the pass above yields records of whole batches; what spans an edge has a place
    cells = settled(told.mapInArrow(cut, "record string, first boolean, file string, start long, piece int"), "records")
    whole = cells.filter("piece IS NULL").select("record", "first", "file")
    pieces = cells.filter("piece IS NOT NULL")
    # a piece that begins a record comes last in its split
    order = Window.partitionBy("file").orderBy("start", "piece")
    joined = pieces.withColumn("number", F.sum("piece").over(order)).groupBy("file", "number").agg(
        F.sort_array(F.collect_list(F.struct("start", "piece", "record"))).alias("parts"), F.bool_or("first").alias("first")
    )
    text = F.array_join(F.transform("parts", lambda p: p["record"]), "\n")
    made = whole.unionByName(joined.select(text.alias("record"), "first", "file"))
    # the line end of other systems is no part of the last cell
    return made.withColumn("record", F.regexp_replace("record", "\\r\\z", "")).filter("record <> '' OR first")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 5
    kinds = (pa.string(), pa.bool_(), pa.string(), pa.int64(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["record", "first", "file", "start", "piece"])


def parsed(reader: DataFrameReader, found: DataFrame) -> DataFrame:
    """CSV records, one per row of ``record``, parsed by Spark's reader; without a header."""
    # the reader takes a column of texts in place of a path
    spark = found.sparkSession
    texts = found.select("record")._jdf.__getattr__("as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    return DataFrame(reader.option("header", False)._jreader.csv(texts), spark)
