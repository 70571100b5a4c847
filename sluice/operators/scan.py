"""Running results over long ordered sequences, computed bucket by bucket."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from sluice.functions.kinds import col
from sluice.operators.ordering import Key, sorts, with_buckets
from sluice.session import planned_bytes, settled

# Below this estimate of the whole input no group can overload a task.
SMALL_INPUT = 256 << 20
# A larger group is not sorted in one task.
MAX_GROUP_ROWS = 20_000_000
CHUNK_ROWS = 1_000_000

GROUP, BUCKET, ROW = "_scan_group", "_scan_bucket", "_scan_row"
_START, _NOW = Window.unboundedPreceding, Window.currentRow


def needs_split(df: DataFrame, partition_by: Sequence[str]) -> bool:
    """Whether some group is too long for one task.

    Decided by the planned size first; only a large input pays for a count.
    """
    if not partition_by:
        return True
    return planned_bytes(df) > SMALL_INPUT and longest_group(df, partition_by) > MAX_GROUP_ROWS


def longest_group(df: DataFrame, partition_by: Sequence[str]) -> int:
    """Rows of the largest group: partial counts and one number."""
    counts = df.groupBy(*[col(p) for p in partition_by]).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max("n")).first()[0] or 0


class Scan:
    """A table cut into (group, order bucket) cells."""

    def __init__(
        self,
        df: DataFrame,
        partition_by: Sequence[str],
        keys: Sequence[Key],
        reverse: bool = False,
        count: int | None = None,
    ) -> None:
        # cut points, cell totals and rows are three reads of the input
        df = settled(df, "scan")
        self.grouped = bool(partition_by)
        # a struct key keeps NULL groups together under plain equality
        group = F.struct(*[col(p) for p in partition_by]) if partition_by else F.lit(0)
        self.keys, self.reverse = keys, reverse
        self.base = with_buckets(df, keys, BUCKET, count).withColumn(GROUP, group)
        if reverse:
            self.base = self.base.withColumn(BUCKET, -F.col(BUCKET))
        self.cell = [GROUP, BUCKET] if self.grouped else [BUCKET]
        self.order = sorts(keys, reverse)

    @property
    def inside(self) -> WindowSpec:
        return Window.partitionBy(*self.cell).orderBy(*self.order)

    @property
    def running(self) -> WindowSpec:
        return self.inside.rowsBetween(_START, _NOW)

    @property
    def _cells(self) -> WindowSpec:
        return Window.partitionBy(GROUP).orderBy(BUCKET)

    @property
    def cells_before(self) -> WindowSpec:
        return self._cells.rowsBetween(_START, -1)

    def edge(self, value: Column, last: bool, present_only: bool = False) -> DataFrame:
        """The first or last row of each cell, cut to one row per task before the shuffle."""
        rows = self.base.filter(value.isNotNull()) if present_only else self.base
        order = sorts(self.keys, self.reverse != last)
        ranked = Window.partitionBy(*self.cell).orderBy(*order)
        place = F.row_number().over(ranked).alias("n")
        return rows.select(GROUP, BUCKET, value.alias("edge"), place).filter("n = 1").drop("n")

    def totals(self, **aggregates: Column) -> DataFrame:
        return self.base.groupBy(GROUP, BUCKET).agg(
            *[value.alias(name) for name, value in aggregates.items()]
        )

    def carried(
        self, cells: DataFrame, build: Callable[[WindowSpec, WindowSpec], dict[str, Column]]
    ) -> DataFrame:
        """Rows with what the cells of their group say about earlier buckets.

        ``build`` gets the window of all earlier cells and that of all cells.
        """
        earlier = self.cells_before
        everything = Window.partitionBy(GROUP).orderBy(BUCKET).rowsBetween(
            _START, Window.unboundedFollowing
        )
        carry = cells.select(
            *self.cell, *[v.alias(k) for k, v in build(earlier, everything).items()]
        )
        return self.base.join(carry, self.cell, "left")


def _zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def numbered(
    df: DataFrame, partition_by: Sequence[str], keys: Sequence[Key], count: int | None = None
) -> DataFrame:
    """``df`` with the row number of each row in its group, in column ``ROW``."""
    scan = Scan(df, partition_by, keys, count=count)
    rows = scan.carried(
        scan.totals(n=F.count(F.lit(1))), lambda before, _: {"_off": _zero(F.sum("n").over(before))}
    )
    number = F.row_number().over(scan.inside) + _zero(F.col("_off"))
    return rows.withColumn(ROW, number).drop("_off", BUCKET)


def with_halo(rows: DataFrame, before: int, after: int, chunk: int) -> DataFrame:
    """Numbered rows in chunks, each with its neighbours' rows that frames reach into.

    Copies have ``_halo`` true. Only rows near a chunk edge are copied.
    """
    place = F.floor((F.col(ROW) - 1) / F.lit(chunk))
    offset = F.pmod(F.col(ROW) - 1, F.lit(chunk))
    homes = F.array_compact(
        F.array(
            place,
            F.when(offset >= chunk - before, place + 1),
            F.when(offset < after, place - 1),
        )
    )
    return rows.withColumn("_home", place).withColumn("_chunk", F.explode(homes)).withColumn(
        "_halo", F.col("_home") != F.col("_chunk")
    )


def framed(
    df: DataFrame,
    value: Callable[[WindowSpec], Column],
    partition_by: Sequence[str],
    keys: Sequence[Key],
    before: int,
    after: int,
    out: str,
    chunk: int = CHUNK_ROWS,
    count: int | None = None,
) -> DataFrame:
    """A frame of bounded reach (moving averages, LAG, LEAD) over chunks of fixed length."""
    chunk = max(chunk, before, after)
    rows = with_halo(numbered(df, partition_by, keys, count), before, after, chunk)
    window = Window.partitionBy(GROUP, "_chunk").orderBy(ROW)
    return (
        rows.withColumn(out, value(window))
        .filter(~F.col("_halo"))
        .drop(GROUP, ROW, "_home", "_chunk", "_halo")
    )


def ranked(
    df: DataFrame,
    function: str,
    partition_by: Sequence[str],
    keys: Sequence[Key],
    out: str,
    tiles: int = 4,
    count: int | None = None,
) -> DataFrame:
    """ROW_NUMBER, RANK, DENSE_RANK, PERCENT_RANK and NTILE."""
    scan = Scan(df, partition_by, keys, count=count)
    totals = {"n": F.count(F.lit(1))}
    if function == "DENSE_RANK":
        totals = {"n": F.count_distinct(F.struct(*[col(k.name) for k in keys]))}
    rows = scan.carried(
        scan.totals(**totals),
        lambda before, everything: {
            "_off": _zero(F.sum("n").over(before)),
            "_all": F.sum("n").over(everything),
        },
    )
    pick = {"DENSE_RANK": F.dense_rank, "ROW_NUMBER": F.row_number, "NTILE": F.row_number}
    place = pick.get(function, F.rank)().over(scan.inside) + F.col("_off")
    if function == "PERCENT_RANK":
        place = F.when(F.col("_all") > 1, (place - 1) / (F.col("_all") - 1)).otherwise(0.0)
    elif function == "NTILE":
        place = tile(place, F.col("_all"), tiles)
    if function != "PERCENT_RANK":
        place = place.cast("bigint")
    return rows.withColumn(out, place).drop("_off", "_all", GROUP, BUCKET)


def tile(row: Column, total: Column, tiles: int) -> Column:
    """The tile of row number ``row``: the first ``total % tiles`` tiles hold one row more."""
    size = F.floor(total / F.lit(tiles))
    larger = F.pmod(total, F.lit(tiles))
    edge = larger * (size + 1)
    low = F.ceil(row / (size + 1))
    high = larger + F.ceil((row - edge) / F.greatest(size, F.lit(1)))
    return F.when(row <= edge, low).otherwise(high).cast("bigint")


def accumulated(
    df: DataFrame,
    functions: Mapping[str, str],
    value: Column,
    partition_by: Sequence[str],
    keys: Sequence[Key],
    count: int | None = None,
) -> DataFrame:
    """Running SUM, COUNT, AVG, MIN, MAX, STDDEV and VARIANCE: ``{new column: function}``."""
    scan = Scan(df, partition_by, keys, count=count)
    run, wanted = scan.running, set(functions.values())
    n, s = F.count(value), F.sum(value)
    parts: dict[str, Column] = {}
    if wanted - {"MIN", "MAX"}:
        parts |= {"n": n, "s": s}
    if wanted & {"STDDEV", "VARIANCE"}:
        parts["q"] = F.var_pop(value) * n
    if "MIN" in wanted:
        parts["low"] = F.min(value)
    if "MAX" in wanted:
        parts["high"] = F.max(value)

    def carry(before: WindowSpec, _: WindowSpec) -> dict[str, Column]:
        made = {}
        if "n" in parts:
            made = {"_n": _zero(F.sum("n").over(before)), "_s": F.sum("s").over(before)}
        if "q" in parts:
            made["_q"] = F.sum("q").over(before)
        if "low" in parts:
            made["_low"] = F.min("low").over(before)
        if "high" in parts:
            made["_high"] = F.max("high").over(before)
        return made

    cells = scan.totals(**parts)
    if "q" in parts:
        # what a cell adds to the spread of all before it: sums of terms that are never negative
        earlier = scan.cells_before
        n_before, s_before = F.sum("n").over(earlier), F.sum("s").over(earlier)
        gap = F.try_divide(F.col("s"), F.col("n")) - F.try_divide(s_before, n_before)
        between = gap * gap * F.try_divide(F.col("n") * n_before, F.col("n") + n_before)
        cells = cells.withColumn("q", _zero(F.col("q")) + _zero(between))
    rows = scan.carried(cells, carry)
    here_n, here_s = n.over(run), s.over(run)
    all_n = here_n + F.col("_n")
    all_s = F.coalesce(here_s + F.col("_s"), here_s, F.col("_s"))

    def variance() -> Column:
        gap = F.try_divide(here_s, here_n) - F.try_divide(F.col("_s"), F.col("_n"))
        between = gap * gap * F.try_divide(here_n * F.col("_n"), all_n)
        inside = F.var_pop(value).over(run) * here_n
        spread = _zero(inside) + _zero(F.col("_q")) + _zero(between)
        return F.when(all_n > 1, F.greatest(spread, F.lit(0.0)) / (all_n - 1))

    results: dict[str, Callable[[], Column]] = {
        "SUM": lambda: all_s,
        "COUNT": lambda: all_n,
        "AVG": lambda: F.try_divide(all_s, all_n),
        "MIN": lambda: F.least(F.min(value).over(run), F.col("_low")),
        "MAX": lambda: F.greatest(F.max(value).over(run), F.col("_high")),
        "VARIANCE": variance,
        "STDDEV": lambda: F.sqrt(variance()),
    }
    made = rows.withColumns({out: results[f]() for out, f in functions.items()})
    return made.drop("_n", "_s", "_q", "_low", "_high", GROUP, BUCKET)


def edge_value(
    df: DataFrame,
    value: Column,
    last: bool,
    partition_by: Sequence[str],
    keys: Sequence[Key],
    out: str,
    count: int | None = None,
) -> DataFrame:
    """The first or the last value of the whole group."""
    scan = Scan(df, partition_by, keys, count=count)
    # every cell of a group needs the value, also cells that add nothing to it
    pick = F.last if last else F.first
    rows = scan.carried(scan.edge(value, last), lambda _, all_: {out: pick("edge").over(all_)})
    return rows.drop(GROUP, BUCKET)


def last_present(
    df: DataFrame,
    value: Column,
    partition_by: Sequence[str],
    keys: Sequence[Key],
    out: str,
    reverse: bool = False,
    count: int | None = None,
) -> DataFrame:
    """The nearest non-NULL value at or before each row (after, with ``reverse``)."""
    scan = Scan(df, partition_by, keys, reverse, count)
    # buckets without any value still pass on what came before them
    known = scan.totals(n=F.count(F.lit(1))).join(
        scan.edge(value, True, present_only=True), [GROUP, BUCKET], "left"
    )
    rows = scan.carried(
        known, lambda before, _: {"_last": F.last("edge", ignorenulls=True).over(before)}
    )
    here = F.last(value, ignorenulls=True).over(scan.running)
    return rows.withColumn(out, F.coalesce(here, F.col("_last"))).drop("_last", GROUP, BUCKET)
