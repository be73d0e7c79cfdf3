"""From stored completions to verdicts and throughput, in one aggregate."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnmill.functions.clocks import elapsed_seconds
from turnmill.functions.rules import (
    DEFAULT_TERMS,
    GENERATION_LIMIT_S,
    LOAD_LIMIT_S,
    MAX_WORDS,
    MIN_WORDS,
)
from turnmill.functions.text import completion_text, parse_completion, py_strip, strip_prompt
from turnmill.functions.tokens import Spans, count_tokens
from turnmill.operators.replies import RULES, validate_replies


def judge_completions(
    runs: DataFrame,
    terms: Sequence[str] = DEFAULT_TERMS,
    words: tuple[int, int] = (MIN_WORDS, MAX_WORDS),
    load_limit_s: float = LOAD_LIMIT_S,
    generation_limit_s: float = GENERATION_LIMIT_S,
    marks: Sequence[str] = (),
    spans: Spans | None = None,
) -> DataFrame:
    """Add `reply`, `stripped`, `elapsed_s`, `gen_s`, `tokens` and the verdicts of `validate_replies` to stored runs.

    Needs `completion` (JSON text with `choices`), `prompt`, `load_s`, `started_at` and `ended_at`. The reply is the first choice's
    text without the prompt it may start with (`marks`: see `strip_prompt`), stripped of white space. A NULL prompt
    strips nothing; a completion that cannot be read has no reply, no tokens and passes no rule on
    its text. Nothing is shuffled.
    """
    raw = completion_text(parse_completion("completion"))
    cut = strip_prompt("_raw", F.coalesce("prompt", F.lit("")), marks)
    timed = runs.withColumns({"_raw": raw, "elapsed_s": elapsed_seconds("started_at", "ended_at")})
    read = timed.withColumn("_cut", cut).withColumns(
        {
            "reply": py_strip("_cut.text"),
            "stripped": F.col("_cut.stripped") & F.col("prompt").isNotNull(),
            "gen_s": F.col("elapsed_s"),
        }
    )
    counted = read.drop("_raw", "_cut").withColumn("tokens", count_tokens("reply", spans))
    return validate_replies(counted, terms, words, load_limit_s, generation_limit_s)


def evaluate_completions(
    runs: DataFrame,
    by: Sequence[str] = (),
    terms: Sequence[str] = DEFAULT_TERMS,
    words: tuple[int, int] = (MIN_WORDS, MAX_WORDS),
    load_limit_s: float = LOAD_LIMIT_S,
    generation_limit_s: float = GENERATION_LIMIT_S,
    marks: Sequence[str] = (),
    spans: Spans | None = None,
) -> DataFrame:
    """Verdict counts and throughput of stored completions, in all or per group: (*by, n_replies, one n_<rule>
    per rule, n_is_valid, n_stripped, mean_s, mean_tokens, tokens_per_s).

    See `judge_completions` for what is needed and how a run is judged. The rate is the ratio of the sums over runs that have
    tokens and a time, NULL where no time passed. One partial and one final aggregate, so a group of any size
    leaves each task as one row; no `by` gives one row, also for no runs.
    """
    judged = judge_completions(runs, terms, words, load_limit_s, generation_limit_s, marks, spans)
    timed = F.col("tokens").isNotNull() & F.col("elapsed_s").isNotNull()
    tokens, seconds = F.when(timed, F.col("tokens")), F.when(timed, F.col("elapsed_s"))
    return judged.groupBy(*by).agg(
        F.count("*").alias("n_replies"),
        *[F.count_if(F.col(rule)).alias(f"n_{rule}") for rule in (*RULES, "is_valid")],
        F.count_if("stripped").alias("n_stripped"),
        F.avg(seconds).alias("mean_s"),
        F.avg(tokens).alias("mean_tokens"),
        F.try_divide(F.sum(tokens), F.sum(seconds)).alias("tokens_per_s"),
    )
