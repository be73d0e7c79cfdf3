"""Which terms of a long list a text contains."""

import pickle
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnmill.checkpoints import store

# Most bytes of an automaton that are sent to the executors, and a rough size of one per byte of its terms.
MAX_AUTOMATON_BYTES = 64_000_000
BYTES_PER_TERM_BYTE = 40


def term_blocks(terms: Iterable[str], max_bytes: int = MAX_AUTOMATON_BYTES) -> Iterator[list[str]]:
    """Distinct terms in blocks whose automata stay within `max_bytes`; a longer single term is refused."""
    block, size = [], 0
    for term in sorted(set(terms)):
        own = BYTES_PER_TERM_BYTE * max(len(term.encode()), 1)
        if own > max_bytes:
            raise ValueError(f"a term of {len(term)} characters is above the bound of {max_bytes} bytes")
        if size + own > max_bytes:
            yield block
            block, size = [], 0
        block.append(term)
        size += own
    if block:
        yield block


def build_automaton(terms: Iterable[str]) -> bytes:
    """A pickled Aho-Corasick automaton: one walk along a text finds all terms in it."""
    import ahocorasick

    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)
    for term in terms:
        automaton.add_word(term, term)
    automaton.make_automaton()
    return pickle.dumps(automaton)


def term_hits(
    df: DataFrame,
    terms: Iterable[str],
    text: str = "text",
    output: str = "terms",
    max_bytes: int = MAX_AUTOMATON_BYTES,
) -> DataFrame:
    """Add the terms that the lower-cased text contains, also inside words: a sorted ARRAY<STRING>, each once.

    Terms are compared as given, so they should be lower case; an empty one is contained in every text. A NULL
    text has NULL hits. The terms come to the driver, where an automaton is built once; it is
    broadcast and run in Arrow batches, so the table is read once and a text is walked once, however many terms there are. Terms
    beyond `max_bytes` of automaton are run in blocks, each in a pass of its own with its hits written
    to the checkpoint folder, so that a worker holds one automaton at a time.
    """
    if output in df.columns:
        raise ValueError(f"df has a column named {output}")
    terms = set(terms)
    everywhere = [""] if "" in terms else []
    blocks = list(term_blocks(terms - {""}, max_bytes))
    found = df.withColumn(
        output, F.when(F.col(text).isNotNull(), F.array(*map(F.lit, everywhere)).cast("array<string>"))
    )
    for number, block in enumerate(blocks, 1):
        hits = F.array_sort(F.concat(output, _hits(df, block)(F.lower(F.col(text)))))
        found = found.withColumn(output, hits)
        if number < len(blocks):
            found = store(found)
    return found


def _hits(df: DataFrame, terms: list[str]):
    sent = df.sparkSession.sparkContext.broadcast(build_automaton(terms))

    # Nested, so that it reaches the workers by value and they need not have this package.
    @F.pandas_udf("array<string>")
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = pickle.loads(sent.value)
        for texts in batches:
            yield texts.map(
                lambda text: None if text is None else list({term for _, term in automaton.iter(text)})
            )

    return hits
