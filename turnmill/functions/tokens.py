"""Token counts and limits.

No model tokenizer is at hand on the JVM side, so both functions count pieces
that approximate tokens, inside Spark's own expressions. A caller who needs a
model's exact counts passes `spans`: a function that takes one text and gives
the (start, end) character offsets of its tokens. It runs in Arrow batches.
"""

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from turnmill.functions.columns import ColumnOrName, as_column
from turnmill.functions.text import WHITESPACE_CLASS

Spans = Callable[[str], Sequence[tuple[int, int]]]

# Fixed value: the training limit.
MAX_TOKENS = 2048

SPACE = f"[{WHITESPACE_CLASS}]"
NON_SPACE = f"[^{WHITESPACE_CLASS}]"
# Unicode letters, marks, digits and connectors make words; any other visible mark counts alone.
WORD_OR_MARK = r"(?U)\w++|[^\w\s\x1c-\x1f]"


def truncate_tokens(
    text: ColumnOrName, n: int = MAX_TOKENS, spans: Spans | None = None
) -> Column:
    """Cut a text to at most n tokens; the result is always a true prefix.

    Counts whitespace-separated pieces, an approximation of model tokens,
    unless `spans` is given. Whitespace before a kept piece stays as it is, and
    a text within the limit comes back unchanged, trailing whitespace included.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    text = as_column(text)
    if spans is not None:
        return _prefix_udf(spans, n)(text)
    # Possessive repeats match in a loop, without recursion or backtracking, and stop
    # after n pieces. Without a further piece nothing matches and the text stays whole.
    piece = f"{SPACE}*+{NON_SPACE}++"
    beyond_limit = rf"(?s)\A((?:{piece}){{{n}}}+){piece}.*+"
    # n + 1 pieces and what separates them take more than 2n characters.
    return F.when(F.length(text) <= 2 * n, text).otherwise(
        F.regexp_replace(text, F.lit(beyond_limit), F.lit("$1"))
    )


def count_tokens(text: ColumnOrName, spans: Spans | None = None) -> Column:
    """Number of tokens in a text.

    Counts words and single punctuation marks, an approximation of model
    tokens, unless `spans` is given.
    """
    text = as_column(text)
    if spans is not None:
        return _count_udf(spans)(text)
    return F.regexp_count(text, F.lit(WORD_OR_MARK)).cast("bigint")


def _prefix_udf(spans: Spans, n: int):
    def cut(text: str | None) -> str | None:
        if text is None:
            return None
        tokens = spans(text)
        return text if len(tokens) <= n else text[: tokens[n - 1][1]]

    @F.pandas_udf("string")
    def prefixes(texts: pd.Series) -> pd.Series:
        return texts.map(cut)

    return prefixes


def _count_udf(spans: Spans):
    @F.pandas_udf("bigint")
    def counts(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else len(spans(t)) for t in texts], dtype="Int64")

    return counts
