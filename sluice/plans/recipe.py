"""Recipes: ordered steps over a table, saved as JSON and applied lazily."""

from __future__ import annotations

import hashlib
import inspect
import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, fields, is_dataclass, replace
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame

from sluice.functions.arithmetic import columns_in
from sluice.functions.conditions import Predicate
from sluice.functions.kinds import DATE, NUMERIC, TEXT, kind_of
from sluice.operators import (
    aggregate,
    columns,
    date_ops,
    joins,
    json_ops,
    quality,
    range_joins,
    rows,
    similar,
    sql,
    text,
    values,
    windows,
)
from sluice.sources.writers import conditional_export

# Step name -> operator. Parameters that are tables name a view of the run.
OPERATORS: dict[str, Callable[..., DataFrame]] = {
    f.__name__: f
    for f in (
        columns.add_column,
        columns.delete_columns,
        columns.copy_columns,
        columns.combine_columns,
        columns.convert_type,
        columns.normalize_date,
        columns.split_column,
        columns.select_columns,
        columns.arrange,
        values.filter_rows,
        values.set_values,
        values.fill_value,
        values.math,
        values.small_large,
        text.text_transform,
        text.replace_values,
        text.bulk_replace,
        text.bulk_replace_from,
        text.substring,
        date_ops.extract_date,
        date_ops.date_diff,
        date_ops.increment_date,
        date_ops.business_days,
        date_ops.date_scaffold,
        json_ops.json_extract,
        json_ops.json_list_to_rows,
        rows.sort,
        rows.limit_rows,
        rows.page,
        rows.discard_duplicates,
        rows.dedupe_latest,
        rows.unnest,
        rows.flatten,
        aggregate.pivot,
        aggregate.crosstab,
        aggregate.metric,
        aggregate.percentile,
        aggregate.sample_rows,
        windows.window,
        windows.running_aggregates,
        windows.fill_missing,
        windows.top_per_group,
        windows.growth,
        quality.profile,
        quality.flag_rows,
        quality.check_summary,
        quality.conditional_format,
        quality.row_level_security,
        joins.join,
        joins.lookup,
        joins.lookup_mapping,
        joins.matching,
        joins.append,
        joins.combine_sets,
        range_joins.join_range,
        range_joins.join_overlap,
        range_joins.join_nearest,
        similar.dedupe_fuzzy,
        sql.sql_query,
    )
}
PARAMETER = "$"  # marks a parameter name inside a step


@dataclass(frozen=True)
class Step:
    """One operator call with plain, JSON-ready parameters."""

    name: str
    params: Mapping[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.name not in OPERATORS:
            raise ValueError(f"unknown step {self.name!r}; one of {sorted(OPERATORS)}")

    def to_dict(self) -> dict[str, Any]:
        return {"name": self.name, "params": plain(self.params)}


def step(operator: str, /, **params: Any) -> Step:
    return Step(operator, plain(params))


def plain(value: Any) -> Any:
    """Conditions and specs as dictionaries."""
    if isinstance(value, Predicate):
        return value.to_dict()
    if is_dataclass(value) and not isinstance(value, type):
        return {
            f.name: plain(getattr(value, f.name))
            for f in fields(value)
            if getattr(value, f.name) is not None
        }
    if isinstance(value, Mapping):
        return {k: plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return value


def _bind(value: Any, tables: Mapping[str, DataFrame], params: Mapping[str, Any]) -> Any:
    if isinstance(value, Mapping):
        if set(value) == {"view"}:
            if value["view"] not in tables:
                raise ValueError(f"the run provides no table {value['view']!r}")
            return tables[value["view"]]
        return {k: _bind(v, tables, params) for k, v in value.items()}
    if isinstance(value, list):
        return [_bind(v, tables, params) for v in value]
    if isinstance(value, str) and value.startswith(PARAMETER) and value[1:] in params:
        return params[value[1:]]
    return value


# fixed values: kinds of named parameters
PARAMETER_KINDS = {
    TEXT: str,
    NUMERIC: (int, float),
    DATE: str,
}


def checked_parameters(declared: Mapping[str, str], given: Mapping[str, Any]) -> dict[str, Any]:
    """Given values, after a check against the declared kinds."""
    for name, kind in declared.items():
        if name not in given:
            raise ValueError(f"parameter {name!r} has no value")
        if not isinstance(given[name], PARAMETER_KINDS[kind]) or isinstance(given[name], bool):
            raise ValueError(f"parameter {name!r} is {kind}, not {given[name]!r}")
    return dict(given)


@dataclass(frozen=True)
class Recipe:
    """An immutable list of steps; every edit gives a new recipe."""

    steps: tuple[Step, ...] = ()
    parameters: Mapping[str, str] = field(default_factory=dict)

    # -- building and editing ----------------------------------------------

    def add(self, operator: str, /, **params: Any) -> Recipe:
        return replace(self, steps=(*self.steps, step(operator, **params)))

    def __getattr__(self, name: str) -> Callable[..., Recipe]:
        """``recipe.math("a + b", "c")`` for ``recipe.add("math", expression=..., new_column=...)``."""
        if name not in OPERATORS:
            raise AttributeError(name)
        names = list(inspect.signature(OPERATORS[name]).parameters)[1:]

        def add(*args: Any, **params: Any) -> Recipe:
            return self.add(name, **dict(zip(names, args, strict=False)), **params)

        return add

    def delete(self, number: int) -> Recipe:
        """Without step ``number``, counted from 1."""
        self._known(number)
        return replace(self, steps=self.steps[: number - 1] + self.steps[number:])

    def replace_step(self, number: int, operator: str, /, **params: Any) -> Recipe:
        self._known(number)
        changed = list(self.steps)
        changed[number - 1] = step(operator, **params)
        return replace(self, steps=tuple(changed))

    def insert(self, number: int, operator: str, /, **params: Any) -> Recipe:
        made = step(operator, **params)
        return replace(self, steps=(*self.steps[: number - 1], made, *self.steps[number - 1 :]))

    def at(self, number: int) -> Recipe:
        """The first ``number`` steps; 0 is the table as it came."""
        if not 0 <= number <= len(self.steps):
            raise ValueError(f"the recipe has {len(self.steps)} steps, not {number}")
        return replace(self, steps=self.steps[:number])

    def _known(self, number: int) -> None:
        if not 1 <= number <= len(self.steps):
            raise ValueError(f"the recipe has no step {number}")

    # -- running -------------------------------------------------------------

    def apply(
        self,
        df: DataFrame,
        tables: Mapping[str, DataFrame] | None = None,
        params: Mapping[str, Any] | None = None,
        fuse: bool = True,
    ) -> DataFrame:
        """The table after all steps; nothing runs until an action.

        Neighbouring column steps that do not read each other's results become
        one projection, which keeps the plans of long recipes small.
        """
        given = checked_parameters(self.parameters, params or {})
        pending: dict[str, Any] = {}
        for one in self.steps:
            operator = OPERATORS[one.name]
            bound = _bind(plain(one.params), tables or {}, given)
            build = getattr(operator, "expressions", None) if fuse else None
            if build is None:
                df = operator(_flush(df, pending), **bound)
                pending = {}
                continue
            if pending and _mentions(bound, pending, df.columns):
                df, pending = _flush(df, pending), {}
            made = build(df, **bound)
            if set(made) & set(pending):
                df, pending = _flush(df, pending), {}
                made = build(df, **bound)
            pending |= made
        return _flush(df, pending)

    def lint(self, df: DataFrame, tables: Mapping[str, DataFrame] | None = None) -> list[str]:
        """What would fail or be slow, step by step, without running anything."""
        notes = []
        seen_join = False
        for number, one in enumerate(self.steps, start=1):
            where = f"step {number} ({one.name})"
            if one.name == "filter_rows" and seen_join:
                notes.append(f"{where}: filter before the join where its columns allow")
            seen_join |= one.name == "join"
            if one.name == "math":
                used = columns_in(one.params["expression"], df.columns)
                for name in sorted(n for n in used if kind_of(df, n) == TEXT):
                    notes.append(f"{where}: {name!r} is TEXT; convert it to NUMERIC first")
            try:
                df = OPERATORS[one.name](df, **_bind(plain(one.params), tables or {}, {}))
            except (ValueError, TypeError, KeyError, AnalysisException) as error:
                notes.append(f"{where}: {str(error).splitlines()[0]}")
                break
        return notes

    def export(
        self,
        df: DataFrame,
        path: str,
        condition: Predicate | Mapping[str, Any],
        after: int | None = None,
        tables: Mapping[str, DataFrame] | None = None,
        params: Mapping[str, Any] | None = None,
        **options: Any,
    ) -> list[str]:
        """Write the matching rows as of the end, or as of step ``after``."""
        part = self if after is None else self.at(after)
        return conditional_export(part.apply(df, tables, params), path, condition, **options)

    # -- saving ----------------------------------------------------------------

    def to_json(self) -> str:
        return json.dumps(
            {"steps": [s.to_dict() for s in self.steps], "parameters": dict(self.parameters)},
            indent=1,
            default=_saved,
        )

    @classmethod
    def from_json(cls, text: str) -> Recipe:
        data = json.loads(text)
        made = tuple(Step(s["name"], s["params"]) for s in data["steps"])
        return cls(made, data.get("parameters", {}))

    def fingerprint(self, params: Mapping[str, Any] | None = None, source: str = "") -> str:
        """Changes whenever the steps, the parameters or the source change."""
        text = json.dumps([self.to_json(), dict(params or {}), source], sort_keys=True, default=str)
        return hashlib.sha256(text.encode()).hexdigest()[:20]

    # -- checkpoints -------------------------------------------------------------

    def checkpointed(
        self,
        df: DataFrame,
        folder: str,
        source: str,
        every: Sequence[int] = (),
        tables: Mapping[str, DataFrame] | None = None,
        params: Mapping[str, Any] | None = None,
        table_sources: Mapping[str, str] | None = None,
    ) -> DataFrame:
        """Apply, writing the result after the step numbers in ``every``.

        A run starts from the latest checkpoint whose steps, parameters, tables
        and ``source`` label still hold, so an edit reruns only what follows it.
        Other files or another plan make a table another one; ``table_sources``
        labels tables that change without either, like ``source`` does.
        """
        labels = {n: [_table_label(t), (table_sources or {}).get(n, "")] for n, t in (tables or {}).items()}
        label = json.dumps([source, labels], sort_keys=True) if labels else source
        spark = df.sparkSession
        start = 0
        for number in sorted(every, reverse=True):
            path = f"{folder}/{self.at(number).fingerprint(params, label)}"
            try:
                df, start = spark.read.parquet(path), number
                break
            except AnalysisException:
                continue
        for number in sorted(n for n in every if n > start):
            part = replace(self, steps=self.steps[start:number])
            path = f"{folder}/{self.at(number).fingerprint(params, label)}"
            part.apply(df, tables, params).write.mode("overwrite").parquet(path)
            df, start = spark.read.parquet(path), number
        return replace(self, steps=self.steps[start:]).apply(df, tables, params)


def _saved(value: Any) -> str:
    """Dates and the like as text; a table cannot be part of a saved recipe."""
    if isinstance(value, DataFrame):
        raise TypeError("a recipe with a DataFrame cannot be saved: name a table with {'view': name}")
    return str(value)


def _table_label(table: DataFrame) -> str:
    """Changes with the files and the plan of a table."""
    return json.dumps([sorted(table.inputFiles()), table.semanticHash()])


def _flush(df: DataFrame, pending: Mapping[str, Any]) -> DataFrame:
    return df.withColumns(dict(pending)) if pending else df


def _mentions(params: Any, pending: Mapping[str, Any], names: Sequence[str]) -> bool:
    """Whether a step may read a column that is still pending."""
    if isinstance(params, Mapping):
        return any(_mentions(v, pending, names) for v in params.values())
    if isinstance(params, (list, tuple)):
        return any(_mentions(v, pending, names) for v in params)
    return isinstance(params, str) and any(name in params for name in pending)
