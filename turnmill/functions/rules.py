"""Quality rules for one model reply. A NULL input fails a rule; no rule gives NULL."""

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnmill.functions.columns import ColumnOrName, as_column
from turnmill.functions.tokens import NON_SPACE

# The default terms, the length band in words, the time limits in seconds.
DEFAULT_TERMS = ("volatility", "market", "stock", "price", "economic", "factor", "analysis")
MIN_WORDS, MAX_WORDS = 20, 200
LOAD_LIMIT_S, GENERATION_LIMIT_S = 30, 10

# Up to this many terms a chain of substring searches is used, beyond it one pattern.
TERM_CHAIN = 32


def _or_false(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def has_any_term(text: ColumnOrName, terms: Sequence[str] = DEFAULT_TERMS) -> Column:
    """True when the lower-cased text contains any term, also inside a word.

    Terms are compared as given, so they should be lower case.
    """
    lowered = F.lower(as_column(text))
    if not terms:
        return F.lit(False)
    if len(terms) <= TERM_CHAIN:
        return _or_false(reduce(or_, [F.contains(lowered, F.lit(term)) for term in terms]))
    return _or_false(lowered.rlike("|".join(re.escape(term) for term in terms)))


def word_count(text: ColumnOrName) -> Column:
    """Number of words, as in len(text.split()) of Python; 0 for NULL."""
    words = F.regexp_count(as_column(text), F.lit(f"{NON_SPACE}+"))
    return F.coalesce(words, F.lit(0)).cast("bigint")


def in_length_band(words: ColumnOrName, lo: int = MIN_WORDS, hi: int = MAX_WORDS) -> Column:
    """True for a word count within lo..hi, both ends included."""
    return _or_false(as_column(words).between(lo, hi))


def has_sentences(text: ColumnOrName) -> Column:
    """True when the text has a full stop."""
    return _or_false(F.contains(as_column(text), F.lit(".")))


def within_latency(
    load_s: ColumnOrName,
    generation_s: ColumnOrName,
    load_limit_s: float = LOAD_LIMIT_S,
    generation_limit_s: float = GENERATION_LIMIT_S,
) -> Column:
    """True when loading and generating both took less than their limits."""
    return _or_false(
        (as_column(load_s) < load_limit_s) & (as_column(generation_s) < generation_limit_s)
    )
