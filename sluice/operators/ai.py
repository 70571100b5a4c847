"""A text column made by a model that the caller supplies."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.kinds import col, require

MAX_CONTEXT_COLUMNS = 20  # fixed value: context columns per prompt

Model = Callable[[str, pd.DataFrame], Sequence[str | None]]


def ai_transform(
    df: DataFrame,
    prompt: str,
    context_columns: Sequence[str],
    model: Model,
    new_column: str = "AI Result",
    row_limit: int | None = None,
) -> DataFrame:
    """A new TEXT column of ``model(prompt, context)`` answers, one per row.

    The model gets batches of distinct inputs as a pandas frame and returns one
    answer each; equal inputs are asked once. Rows whose context is all NULL get
    NULL. ``row_limit`` rejects larger inputs, as hosted models often do.
    """
    require(df, *context_columns)
    if not 0 < len(context_columns) <= MAX_CONTEXT_COLUMNS:
        raise ValueError(f"give 1 to {MAX_CONTEXT_COLUMNS} context columns")
    if new_column in df.columns:
        raise ValueError(f"column {new_column!r} exists")
    if row_limit is not None and df.limit(row_limit + 1).count() > row_limit:
        raise ValueError(f"more than {row_limit} rows; filter first")

    @F.pandas_udf("string")
    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(list(model(prompt, batch)), dtype=object)

    context = F.struct(*[col(c) for c in context_columns])
    known = F.coalesce(*[col(c).cast("string") for c in context_columns]).isNotNull()
    asked = df.filter(known).select(context.alias("_context")).distinct()
    answers = asked.select("_context", answer(F.col("_context")).alias(new_column))
    joined = df.withColumn("_context", context).join(answers, "_context", "left")
    return joined.select(*[col(c) for c in df.columns], col(new_column))
