"""Aggregates kept by increments.

Each increment leaves a partial state, a batch of its own in a dataset, and the
result is what the states of all increments add up to. Rows that come count once,
rows that go count minus once. Sums and counts are kept as such. What cannot be
taken back from a single number (extremes, distinct values, medians, spreads, the
first rows of a group) is kept as values with their counts, so that a value whose
count falls to nothing is gone and the next one takes its place.

An increment that runs again replaces its own state, and ``fold`` adds the states
of all but the newest increments up into one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.conditions import Predicate, as_predicate
from sluice.functions.kinds import col, require
from sluice.operators.aggregate import Aggregation, as_aggregation
from sluice.operators.joins import matching
from sluice.operators.ordering import order_keys
from sluice.operators.windows import top_per_group
from sluice.sources.datasets import BATCH, Dataset, newest

# fixed values: aggregates of sums, and those that need the values
SUMMED = ("SUM", "COUNT", "AVG")
VALUED = ("MIN", "MAX", "COUNT_DISTINCT", "MEDIAN", "STDDEV", "VARIANCE")
_SIGN, _ROWS, _VALUE, _N = "_sign", "_rows", "_value", "_n"


class _Kept:
    """States of increments in datasets below one folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _part(self, name: str) -> Dataset:
        return Dataset(self.spark, f"{self.root}/{name}")

    def _parts(self) -> list[str]:
        raise NotImplementedError

    def _added(self, name: str, rows: DataFrame) -> DataFrame:
        raise NotImplementedError

    def seen(self, increment: str) -> bool:
        part = self._part(self._parts()[-1])
        return part.exists() and increment in {r[0] for r in part.read(True).select(BATCH).distinct().collect()}

    def fold(self, newest: int = 1) -> None:
        """Add up all states but those of the ``newest`` increments, which may still run again."""
        for name in self._parts():
            part = self._part(name)
            old = part.names()[: -newest or None] if part.exists() else []
            if len(old) > 1:
                part.fold(old, lambda rows, name=name: self._added(name, rows))


class KeptPivot(_Kept):
    """``pivot`` over all rows that increments brought and did not take away."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        group_by: Sequence[str],
        aggregations: Sequence[Aggregation | dict],
        condition: Predicate | dict | None = None,
    ) -> None:
        super().__init__(spark, root)
        self.group_by, self.condition = list(group_by), as_predicate(condition)
        self.specs = [as_aggregation(a) for a in aggregations]
        wrong = [s.function for s in self.specs if s.function not in (*SUMMED, *VALUED)]
        if wrong or not self.specs:
            raise ValueError(f"aggregates kept by increments are {(*SUMMED, *VALUED)}, not {wrong or 'none'}")

    def _parts(self) -> list[str]:
        return [*[f"values-{k}" for k, s in enumerate(self.specs) if s.function in VALUED], "sums"]

    def _groups(self) -> list[Column]:
        return [col(g) for g in self.group_by]

    def apply(self, increment: str, came: DataFrame, went: DataFrame | None = None) -> None:
        """Count the rows of an increment; the same increment again replaces what it did."""
        require(came, *self.group_by, *[s.column for s in self.specs])
        rows = came.withColumn(_SIGN, F.lit(1).cast("bigint"))
        if went is not None:
            rows = rows.unionByName(went.select(*[col(c) for c in came.columns]).withColumn(_SIGN, F.lit(-1).cast("bigint")))
        if self.condition is not None:
            rows = rows.filter(self.condition.column(came))
        sums = [F.sum(_SIGN).alias(_ROWS)]
        for k, spec in enumerate(self.specs):
            value = self._value(came, spec)
            if spec.function in VALUED:
                state = rows.filter(value.isNotNull()).groupBy(*self._groups(), value.alias(_VALUE)).agg(F.sum(_SIGN).alias(_N))
                self._part(f"values-{k}").append(state.filter(F.col(_N) != 0), batch=increment)
                continue
            sums.append(F.sum(F.when(value.isNotNull(), F.col(_SIGN)).otherwise(0)).alias(f"_n{k}"))
            if spec.function != "COUNT":
                sums.append(F.sum(value * F.col(_SIGN)).alias(f"_s{k}"))
        # written last: an increment counts as seen once it is here
        self._part("sums").append(rows.groupBy(*self._groups()).agg(*sums), batch=increment)

    def _value(self, df: DataFrame, spec: Aggregation) -> Column:
        only = as_predicate(spec.condition)
        return col(spec.column) if only is None else F.when(only.column(df), col(spec.column))

    def _added(self, name: str, rows: DataFrame) -> DataFrame:
        numbers = [c for c in rows.columns if c not in (*self.group_by, _VALUE, BATCH)]
        keys = [*self._groups(), *([F.col(_VALUE)] if name != "sums" else [])]
        kinds = {f.name: f.dataType for f in rows.schema.fields}
        made = rows.groupBy(*keys).agg(*[F.sum(col(n)).cast(kinds[n]).alias(n) for n in numbers])
        return made.filter(F.col(_ROWS if name == "sums" else _N) != 0)

    def result(self) -> DataFrame:
        """The aggregates now; groups without rows are gone."""
        out = self._added("sums", self._part("sums").read()).filter(F.col(_ROWS) > 0)
        made = {}
        for k, spec in enumerate(self.specs):
            if spec.function in VALUED:
                # null-safe: a group may be NULL
                found = self._of_values(k, spec).withColumnsRenamed({g: f"_g{j}" for j, g in enumerate(self.group_by)})
                same = [col(g).eqNullSafe(F.col(f"_g{j}")) for j, g in enumerate(self.group_by)]
                out = out.join(found, reduce(lambda a, b: a & b, same) if same else F.lit(True), "left").drop(*[f"_g{j}" for j in range(len(self.group_by))])
                made[spec.name] = F.coalesce(F.col(f"_v{k}"), F.lit(0)) if spec.function == "COUNT_DISTINCT" else F.col(f"_v{k}")
            elif spec.function == "COUNT":
                made[spec.name] = F.col(f"_n{k}")
            else:
                total = F.when(F.col(f"_n{k}") > 0, F.col(f"_s{k}"))
                made[spec.name] = total if spec.function == "SUM" else total / F.col(f"_n{k}")
        return out.select(*self._groups(), *[c.alias(n) for n, c in made.items()])

    def _of_values(self, k: int, spec: Aggregation) -> DataFrame:
        counted = self._added(f"values-{k}", self._part(f"values-{k}").read()).filter(F.col(_N) > 0)
        value, n = F.col(_VALUE), F.col(_N)
        if spec.function in ("STDDEV", "VARIANCE"):
            mean = (F.sum(value * n) / F.sum(n)).alias("_mean")
            means = counted.groupBy(*self._groups()).agg(mean, F.sum(n).alias("_all")).withColumnsRenamed({g: f"_m{j}" for j, g in enumerate(self.group_by)})
            same = [col(g).eqNullSafe(F.col(f"_m{j}")) for j, g in enumerate(self.group_by)]
            counted = counted.join(means, reduce(lambda a, b: a & b, same) if same else F.lit(True))
            spread = F.sum((value - F.col("_mean")) ** 2 * n) / (F.first("_all") - 1)
            result = F.when(F.first("_all") > 1, F.sqrt(spread) if spec.function == "STDDEV" else spread)
        else:
            pick = {"MIN": F.min(value), "MAX": F.max(value), "COUNT_DISTINCT": F.count(value), "MEDIAN": F.percentile(value, F.lit(0.5), n)}
            result = pick[spec.function]
        return counted.groupBy(*self._groups()).agg(result.alias(f"_v{k}"))


class KeptTop(_Kept):
    """``top_per_group`` over all rows that increments brought and did not take away.

    With ``goes`` false no row is ever taken away, and an increment's state is its
    own first rows; otherwise it is all its rows with their counts.
    """

    def __init__(self, spark: SparkSession, root: str, n: int, partition_by: Sequence[str], order_by: Sequence, goes: bool = True) -> None:
        super().__init__(spark, root)
        self.n, self.partition_by, self.order_by, self.goes = n, list(partition_by), order_by, goes

    def _parts(self) -> list[str]:
        return ["rows"]

    def apply(self, increment: str, came: DataFrame, went: DataFrame | None = None) -> None:
        """Count the rows of an increment; the same increment again replaces what it did."""
        order_keys(came, self.order_by, needed_by="KeptTop")
        if not self.goes:
            if went is not None:
                raise ValueError("rows that go need goes=True")
            self._part("rows").append(self._first(came).withColumn(_N, F.lit(1).cast("bigint")), batch=increment)
            return
        rows = came.withColumn(_SIGN, F.lit(1).cast("bigint"))
        if went is not None:
            rows = rows.unionByName(went.select(*[col(c) for c in came.columns]).withColumn(_SIGN, F.lit(-1).cast("bigint")))
        state = rows.groupBy(*[col(c) for c in came.columns]).agg(F.sum(_SIGN).alias(_N)).filter(F.col(_N) != 0)
        self._part("rows").append(state, batch=increment)

    def _first(self, rows: DataFrame) -> DataFrame:
        return top_per_group(rows, self.n, self.partition_by, self.order_by)

    def _added(self, name: str, rows: DataFrame) -> DataFrame:
        rows = rows.drop(BATCH)
        if not self.goes:
            return self._first(rows)
        return rows.groupBy(*[col(c) for c in rows.columns if c != _N]).agg(F.sum(_N).alias(_N)).filter(F.col(_N) != 0)

    def result(self) -> DataFrame:
        """The first rows of each group now."""
        rows = self._added("rows", self._part("rows").read())
        # more than n copies of a row are never needed
        copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.least(F.col(_N), F.lit(self.n).cast("bigint"))))
        return self._first(rows.filter(F.col(_N) > 0).withColumn(_N, copies).drop(_N))


def keep(kept: Sequence[KeptPivot | KeptTop], increment: str, came: DataFrame, went: DataFrame | None = None) -> None:
    for one in kept:
        one.apply(increment, came, went)


def merged_increment(target: Dataset, rows: DataFrame, keys: Sequence[str], order_by: Sequence, kept: Sequence[KeptPivot | KeptTop], increment: str) -> None:
    """Upsert an increment and correct what is kept by the rows it adds and replaces.

    The merge is committed last and under the increment's name: an increment that
    runs again finds either nothing done or all of it.
    """
    if not target.exists():
        came = newest(rows, keys, order_by)
        keep(kept, increment, came)
        target.replace(came, batch=increment)
        return
    if increment in target.names():
        return
    came = target.shaped(newest(rows, keys, order_by))
    went = matching(target.read(), came.select(*[col(k) for k in keys]), keys, null_safe=True)
    keep(kept, increment, came, went)
    target.merge(rows, keys, order_by, batch=increment)


def deleted_increment(target: Dataset, condition: Callable[[DataFrame], Column], kept: Sequence[KeptPivot | KeptTop], increment: str) -> None:
    """Take rows away from a dataset and from what is kept."""
    if increment in target.names():
        return
    rows = target.read()
    went = rows.filter(condition(rows))
    keep(kept, increment, rows.limit(0), went)
    target.remove(condition, batch=increment)
