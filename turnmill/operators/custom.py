"""Rendering by a function of the caller's."""

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnmill.functions.render import render_plain

Formatter = Callable[[dict[str, list]], list[str]]


def render_with(
    df: DataFrame, fn: Formatter, columns: Sequence[str] = ("messages",), output: str = "text"
) -> DataFrame:
    """Add a text column computed by a caller's batch formatter.

    `fn` gets one batch of rows as a dict of column lists and gives one text per
    row. Only `columns` leave the JVM, in Arrow batches, and partitions take the
    place of a worker count. The built-in renderers need no Python and are
    faster; this is for templates they do not cover.
    """

    plain_rows = _plain_rows()

    @F.pandas_udf("string")
    def formatted(batch: pd.DataFrame) -> pd.Series:
        return pd.Series(fn(plain_rows(batch)), dtype=object)

    return df.withColumn(output, formatted(F.struct(*columns)))


def _plain_rows() -> Callable[[pd.DataFrame], dict[str, list]]:
    # Nested, so that it reaches the workers by value and they need not have this package.
    def plain_lists(value):
        """Arrow hands lists over as numpy arrays; the caller gets lists of dicts."""
        if isinstance(value, dict):
            return {name: plain_lists(field) for name, field in value.items()}
        if isinstance(value, np.ndarray | list):
            return [plain_lists(item) for item in value]
        return value

    return lambda batch: {name: [plain_lists(value) for value in batch[name]] for name in batch.columns}


def render_or_fall_back(
    df: DataFrame,
    fn: Formatter,
    columns: Sequence[str] = ("messages",),
    output: str = "text",
    flag: str = "used_fallback",
    messages: str = "messages",
) -> DataFrame:
    """As `render_with`, but a row on which `fn` raises gets the plain form of its `messages` and a flag.

    `fn` is called with whole batches. When a call raises, the batch is halved and each half tried again,
    down to the single rows that fail, so the others keep their texts at the cost of a few more calls: for k failing
    rows of n some 2 k log2(n). `fn` may therefore see a row more than once. It must give one text per row; if it
    does not, the job fails, since which text is whose cannot be told. NULL given as a text stays NULL and
    is no failure.
    """
    plain_rows = _plain_rows()

    @F.pandas_udf("text string, failed boolean")
    def formatted(batch: pd.DataFrame) -> pd.DataFrame:
        rows, size = plain_rows(batch), len(batch)
        texts, failed = [None] * size, [False] * size
        open_runs = [(0, size)] if size else []
        while open_runs:
            first, end = open_runs.pop()
            try:
                found = fn({name: values[first:end] for name, values in rows.items()})
            except Exception:
                if end - first == 1:
                    failed[first] = True
                else:
                    middle = (first + end) // 2
                    open_runs += [(first, middle), (middle, end)]
                continue
            if len(found) != end - first:
                raise ValueError(f"the formatter gave {len(found)} texts for {end - first} rows")
            texts[first:end] = found
        return pd.DataFrame({"text": pd.Series(texts, dtype=object), "failed": failed})

    shown = df.withColumn("_formatted", formatted(F.struct(*columns)))
    failed = F.col("_formatted.failed")
    text = F.when(failed, render_plain(messages)).otherwise(F.col("_formatted.text"))
    return shown.withColumns({output: text, flag: failed}).drop("_formatted")
