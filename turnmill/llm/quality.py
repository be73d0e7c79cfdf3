"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Everything runs as built-in expressions; Python sees one row per pattern of votes.
"""

import math
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnmill.checkpoints import store

SEPARATORS = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]"

# A text fails outright below this many words, or above this share of repeated words, in percent.
LEAST_WORDS = 50
MOST_REPEATED = 50


def _split_words(text: Column) -> Column:
    """Words between runs of separators. Splitting at one character needs no pattern matching."""
    for separator in SEPARATORS[1:]:
        text = F.replace(text, F.lit(separator), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


# Up to so many words, a window's hash and place fit into one number with 52 bits of hash or more.
CODED_WORDS = 4096


def _window_hash(hashes: Column, place: Column) -> Column:
    return F.xxhash64(*[F.get(hashes, place + i) for i in range(3)])


def _window_places(hashes: Column) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), F.size(hashes).cast("bigint") - 3)


def _window_codes(hashes: Column, bits: Column) -> Column:
    """Sorted codes of all 3-word windows of a text of CODED_WORDS words or fewer: the hash of the words in the
    high bits, the place in the low bits, as many as the text needs. Equal windows are neighbours."""

    def code(place: Column) -> Column:
        return F.call_function("shiftleft", _window_hash(hashes, place), bits).bitwiseOR(place)

    coded = F.size(hashes).between(4, CODED_WORDS)
    return F.when(coded, F.sort_array(F.transform(_window_places(hashes), code)))


def _window_rows(hashes: Column) -> Column:
    """Sorted (hash, place) of all 3-word windows of a longer text, with all bits of the hash."""

    def row(place: Column) -> Column:
        return F.struct(_window_hash(hashes, place).alias("hash"), place.alias("place"))

    return F.when(F.size(hashes) > CODED_WORDS, F.sort_array(F.transform(_window_places(hashes), row)))


def _place_bits(words: Column) -> Column:
    return F.ceil(F.log2(F.greatest(F.size(words), F.lit(1)))).cast("int")


def _repeated_places(codes: Column, bits: Column, rows: Column) -> Column:
    """Places of the windows that occur more than once, in order, from their codes or their rows."""
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1

    def same_code(a: Column, b: Column) -> Column:
        equal = F.call_function("shiftrightunsigned", a.bitwiseXOR(b), bits) == 0
        return F.when(equal, F.array(a.bitwiseAND(mask), b.bitwiseAND(mask)))

    def same_row(a: Column, b: Column) -> Column:
        return F.when(a["hash"] == b["hash"], F.array(a["place"], b["place"]))

    def neighbours(values: Column, same) -> Column:
        # The last value has no following one.
        firsts = F.slice(values, F.lit(1), F.size(values) - 1)
        return F.zip_with(firsts, F.slice(values, F.lit(2), F.size(values)), same)

    pairs = F.coalesce(neighbours(codes, same_code), neighbours(rows, same_row))
    return F.sort_array(F.array_distinct(F.flatten(F.array_compact(pairs))))


def _covered_words(places: Column) -> Column:
    """How many words the windows at these places cover."""
    following = F.slice(places, F.lit(2), F.greatest(F.size(places), F.lit(1)))
    steps = F.zip_with(places, following, lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
    total = F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, step: total + step)
    return F.coalesce(total, F.lit(0).cast("bigint"))


def with_measures(docs: DataFrame) -> DataFrame:
    """Add STRUCT `measures` of counts over the whole `text`; a null text has no words.

    n_words, word_chars (code points in words), n_symbols (of #*$%&|<>), n_lines (with a word),
    n_dup_lines (of those, equal to an earlier one), n_repeat_words (in 3-word windows that occur
    twice or more), and n_upper, n_letters, n_digits, n_shouts (pairs of ! or ?), n_stops (ends of
    sentences). `docs` may not have columns named measures or starting with `_q_`.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    hashes = F.transform("_q_words", lambda word: F.xxhash64(word))
    # Each step uses the one before more than once, so Spark computes it once and for all.
    steps = (
        docs.withColumns({"_q_words": _split_words(text), "_q_lines": lines})
        .withColumns({"_q_hashes": hashes, "_q_n": F.size("_q_words"), "_q_bits": _place_bits(F.col("_q_words"))})
        .withColumns(
            {
                "_q_codes": _window_codes(F.col("_q_hashes"), F.col("_q_bits")),
                "_q_rows": _window_rows(F.col("_q_hashes")),
            }
        )
        .withColumn("_q_places", _repeated_places(F.col("_q_codes"), F.col("_q_bits"), F.col("_q_rows")))
    )

    def count(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)).cast("bigint")

    measures = F.struct(
        F.col("_q_n").cast("bigint").alias("n_words"),
        F.length(F.array_join("_q_words", "")).cast("bigint").alias("word_chars"),
        count(r"[#*$%&|<>]").alias("n_symbols"),
        F.size("_q_lines").cast("bigint").alias("n_lines"),
        (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("bigint").alias("n_dup_lines"),
        _covered_words(F.col("_q_places")).alias("n_repeat_words"),
        count(r"\p{Lu}").alias("n_upper"),
        F.length(F.regexp_replace(text, r"\P{L}+", "")).cast("bigint").alias("n_letters"),
        count("[0-9]").alias("n_digits"),
        count("[!?]{2}").alias("n_shouts"),
        count(r"[.!?…](?=\s|$)").alias("n_stops"),
    )
    return steps.withColumn("measures", measures).select(*[F.col(f"`{c}`") for c in docs.columns], "measures")


@dataclass(frozen=True)
class Rule:
    """Votes -1 (bad) or 1 (good) where its SQL condition over the measures holds, else it
    abstains (0)."""

    name: str
    vote: int
    condition: str


# Bad signs are one-sided: that a text lacks one says little. Good signs need several measures.
RULES = (
    Rule("short", -1, "n_words < 50"),
    Rule("repeats", -1, "3 * n_repeat_words > n_words"),
    Rule("symbols", -1, "8 * n_symbols > n_words"),
    Rule("capitals", -1, "3 * n_upper > n_letters"),
    Rule("shouts", -1, "10 * n_shouts > n_words"),
    Rule("lines", -1, "3 * n_dup_lines > n_lines"),
    Rule("no_stops", -1, "60 * n_stops < n_words"),
    Rule("few_letters", -1, "10 * n_letters < 7 * word_chars"),
    Rule("word_length", -1, "word_chars > 15 * n_words OR word_chars < 2 * n_words"),
    Rule("digits", -1, "5 * n_digits > word_chars"),
    Rule(
        "prose", 1,
        "10 * n_letters >= 9 * word_chars AND 40 * n_stops >= n_words AND 50 * n_symbols <= n_words "
        "AND 6 * n_upper < n_letters AND n_shouts = 0",
    ),
    Rule(
        "varied", 1,
        "n_words >= 80 AND 4 * n_repeat_words < n_words AND 8 * n_dup_lines <= n_lines "
        "AND 20 * n_symbols <= n_words AND 20 * n_shouts <= n_words",
    ),
)


def vote(rule: Rule, measures: str = "measures") -> Column:
    condition = re.sub(r"\b(n_\w+|word_chars)\b", rf"{measures}.\1", rule.condition)
    return F.when(F.expr(condition), F.lit(rule.vote)).otherwise(F.lit(0))


@dataclass(frozen=True)
class VoteModel:
    """Share of good texts, and how often each rule's vote is right."""

    prior: float
    accuracies: tuple[float, ...]


# Where expectation-maximisation starts, and the class balance, which is given and not fitted:
# a share fitted to unlabelled texts would let the larger class outvote every single rule.
FIRST_ACCURACY = 0.8
PRIOR = 0.5
# A rule is taken to be better than chance and never certain.
LEAST_ACCURACY, MOST_ACCURACY = 0.55, 0.95
ROUNDS = 200


def fit_votes(patterns: Mapping[tuple[int, ...], int], rules: int, prior: float = PRIOR) -> VoteModel:
    """Accuracies by expectation-maximisation from counts of vote patterns.

    Given the class, rules vote independently; a rule that votes is right with its accuracy, and
    abstaining says nothing. Without any vote of a rule its accuracy stays where it starts.
    """
    accuracies = [FIRST_ACCURACY] * rules
    ordered = sorted(patterns.items())
    for _ in range(ROUNDS):
        model = VoteModel(prior, tuple(accuracies))
        right, votes_cast = [FIRST_ACCURACY] * rules, [1.0] * rules
        for votes, count in ordered:
            good = posterior(model, votes)
            for rule, value in enumerate(votes):
                if value:
                    right[rule] += count * (good if value > 0 else 1 - good)
                    votes_cast[rule] += count
        fitted = [
            min(MOST_ACCURACY, max(LEAST_ACCURACY, r / n)) for r, n in zip(right, votes_cast, strict=True)
        ]
        moved = max(abs(x - y) for x, y in zip(fitted, accuracies, strict=True))
        accuracies = fitted
        if moved < 1e-9:
            break
    return VoteModel(prior, tuple(accuracies))


def _weight(chance: float) -> float:
    return math.log(chance) - math.log(1 - chance)


def posterior(model: VoteModel, votes: Sequence[int]) -> float:
    odds = _weight(model.prior)
    for accuracy, value in zip(model.accuracies, votes, strict=True):
        odds += value * _weight(accuracy)
    return 1 / (1 + math.exp(-odds))


def count_votes(voted: DataFrame) -> dict[tuple[int, ...], int]:
    """How often each pattern of `votes` occurs: one number per pattern, at most 2 ^ rules."""
    counted = voted.groupBy("votes").agg(F.count("*").alias("n"))
    return {tuple(row["votes"]): row["n"] for row in counted.collect()}


def quality_column(model: VoteModel, votes: str = "votes") -> Column:
    """Posterior probability that a text is good, from its ARRAY of votes."""
    odds = F.lit(_weight(model.prior))
    for rule, accuracy in enumerate(model.accuracies):
        odds = odds + F.get(F.col(votes), F.lit(rule)) * F.lit(_weight(accuracy))
    return 1 / (1 + F.exp(-odds))


def base_failed(measures: str = "measures") -> Column:
    return F.expr(
        f"{measures}.n_words < {LEAST_WORDS} OR 100 * {measures}.n_repeat_words > {MOST_REPEATED} * {measures}.n_words"
    )


def with_votes(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Add `measures` and `votes` (one of -1, 0, 1 per rule)."""
    return with_measures(docs).withColumn("votes", F.array(*[vote(rule) for rule in rules]))


def judge_quality(voted: DataFrame, model: VoteModel, threshold: float = 0.5) -> DataFrame:
    """Add `base_failed`, `quality` (posterior) and `kept` to rows with measures and votes."""
    judged = voted.withColumns({"base_failed": base_failed(), "quality": quality_column(model)})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def filter_quality(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """`docs` without the texts that are rejected; its columns stay as they are, whatever their names.

    Each row is measured once and written to the checkpoint folder with its votes when this is called; votes are
    counted there, and the rows judged by them. Nothing but vote patterns is shuffled. An empty or null
    text is rejected; equal rows are judged alike; an empty table stays empty.
    """
    rows = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"))
    voted = with_votes(rows.select("row", F.col("row.text").alias("text")), rules).drop("text")
    voted = store(voted.select("row", "votes", base_failed().alias("failed")))
    model = fit_votes(count_votes(voted), len(rules))
    kept = voted.where(~F.col("failed") & (quality_column(model) >= 0.5))
    return kept.select(*[F.col(f"row.`{name}`") for name in docs.columns])
