"""Verdicts over a table of replies."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnmill.functions.rules import (
    DEFAULT_TERMS,
    GENERATION_LIMIT_S,
    LOAD_LIMIT_S,
    MAX_WORDS,
    MIN_WORDS,
    has_any_term,
    has_sentences,
    in_length_band,
    within_latency,
    word_count,
)

RULES = ("has_terms", "good_length", "has_sentences", "in_time")


def validate_replies(
    df: DataFrame,
    terms: Sequence[str] = DEFAULT_TERMS,
    words: tuple[int, int] = (MIN_WORDS, MAX_WORDS),
    load_limit_s: float = LOAD_LIMIT_S,
    generation_limit_s: float = GENERATION_LIMIT_S,
) -> DataFrame:
    """Add the outcome of each quality rule and of all together.

    Needs `reply`, `load_s` and `gen_s`. Adds `word_count`, one flag per rule
    and `is_valid`. One projection: nothing is shuffled, and no flag is NULL.
    """
    checked = df.withColumns(
        {
            "word_count": word_count("reply"),
            "has_terms": has_any_term("reply", terms),
            "has_sentences": has_sentences("reply"),
            "in_time": within_latency("load_s", "gen_s", load_limit_s, generation_limit_s),
        }
    ).withColumn("good_length", in_length_band("word_count", *words))
    all_passed = F.col(RULES[0])
    for rule in RULES[1:]:
        all_passed = all_passed & F.col(rule)
    return checked.withColumn("is_valid", all_passed)


def verdict_summary(flags: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """How many replies there are and how many pass each rule, in all or per group."""
    return flags.groupBy(*by).agg(
        F.count("*").alias("n_replies"),
        *[F.count_if(F.col(rule)).alias(f"n_{rule}") for rule in (*RULES, "is_valid")],
    )
