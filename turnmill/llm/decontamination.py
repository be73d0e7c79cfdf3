"""Benchmark decontamination: a broadcast hash set of normalised benchmark n-grams."""

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnmill.llm.words import ALPHANUMERIC, row_chunks, split_words, string_buffers, windows

WINDOW = 13
# A document is contaminated when at least one word in this many is hit.
HIT_SHARE = 20
# About so many benchmark words are broadcast at once: some 200 MB in a worker.
BLOCK_WORDS = 500_000
HINT = np.uint64((1 << 22) - 1)

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(SPAN)),
    ]
)
HITS_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("items", pa.list_(pa.string())),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ]
)


class Windows:
    """Distinct windows of a block of benchmark items, by their length in words."""

    def __init__(self, items: list[tuple[str, str]], size: int):
        names = pa.array([text for _, text in items], pa.string())
        data, offsets = string_buffers(names)
        self.items = [name for name, _ in items]
        self.words: list[list[bytes]] = []
        found: dict[int, list[tuple[int, int, int]]] = {}
        for rows in row_chunks(offsets):
            words = split_words(data, offsets, rows, ALPHANUMERIC)
            for row in rows:
                own = words.of(row)
                self.words.append(word_bytes(data, words, own))
                hashes = words.hashes[own]
                if len(hashes):
                    length = min(size, len(hashes))
                    for at, value in enumerate(windows(hashes, length).tolist()):
                        found.setdefault(length, []).append((value, row, at))
        self.by_length = {}
        for length, entries in found.items():
            places: dict[int, list[tuple[int, int]]] = {}
            for value, row, at in entries:
                places.setdefault(value, []).append((row, at))
            hint = np.zeros(int(HINT) + 1, bool)
            hint[(np.array(list(places), np.uint64) & HINT).astype(np.int64)] = True
            self.by_length[length] = (np.sort(np.array(list(places), np.uint64)), hint, places)


def word_bytes(data: np.ndarray, words, own: slice) -> list[bytes]:
    """Lower-cased words of a text."""
    return [
        data[words.base + start : words.base + end].tobytes().lower()
        for start, end in zip(words.starts[own], words.ends[own], strict=True)
    ]


def _find_windows(block, size: int, keep: list[str]) -> Callable:
    """Adds what a block's windows hit to what earlier blocks did."""

    def scan(batches):
        found = Windows(block.value, size)
        for batch in batches:
            earlier = batch.column("hits").to_pylist()
            data, offsets = string_buffers(batch.column("text"))
            hits = []
            for rows in row_chunks(offsets):
                words = split_words(data, offsets, rows, ALPHANUMERIC)
                covered, named = _verified_hits(found, data, words)
                for row in rows:
                    mask, names = covered[words.of(row)], named.get(row, set())
                    if earlier[row] is not None:
                        names = names.union(earlier[row]["items"])
                        for span in earlier[row]["spans"]:
                            mask[span["start"] : span["end"]] = True
                    hits.append(_row_hits(mask, names))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in keep], pa.array(hits, HITS_ARROW)], [*keep, "hits"]
            )

    return scan


def _row_hits(mask: np.ndarray, names: set[str]) -> dict:
    spans = []
    if mask.any():
        edges = np.diff(np.concatenate([[0], mask, [0]]).astype(np.int8))
        ends = zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True)
        spans = [{"start": start, "end": end} for start, end in ends]
    return {"n_words": len(mask), "n_hit": int(mask.sum()), "items": sorted(names), "spans": spans}


def _verified_hits(block: Windows, data: np.ndarray, words) -> tuple[np.ndarray, dict[int, set[str]]]:
    """Which words of a chunk are inside an occurring window; names of the items by row."""
    covered = np.zeros(len(words.hashes), bool)
    named: dict[int, set[str]] = {}
    for length, (values, hint, places) in block.by_length.items():
        hashes = windows(words.hashes, length)
        maybe = np.flatnonzero(hint[(hashes & HINT).astype(np.int64)])
        if not len(maybe):
            continue
        at = np.minimum(np.searchsorted(values, hashes[maybe]), len(values) - 1)
        for place in maybe[values[at] == hashes[maybe]].tolist():
            index = int(np.searchsorted(words.first, place, "right")) - 1
            if place + length > words.first[index + 1]:
                continue  # it would run into the next row
            text = word_bytes(data, words, slice(place, place + length))
            for item, start in places[int(hashes[place])]:
                if block.words[item][start : start + length] == text:
                    covered[place : place + length] = True
                    named.setdefault(words.rows.start + index, set()).add(block.items[item])
    return covered, named


def _item_blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[str, str]]]:
    """The benchmark's items in blocks of about `block_words` words; a job counts them first."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where(
        "item_id IS NOT NULL AND text IS NOT NULL"
    )
    characters = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-characters // (5 * block_words)))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for number in range(blocks):
        yield [tuple(row) for row in items.where(block == number).collect()]


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """`docs` with a column `hits`: STRUCT<n_words, n_hit, items, spans>.

    Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. A window
    is `size` consecutive words of a benchmark item; an item of fewer words is one window. A word
    is hit when it is inside any occurrence of a window; hash hits are compared word by word.
    items: ids of the items with occurring windows, as sorted strings. spans: runs of hit words,
    as word numbers, end exclusive. A null or empty text has no words; an item without words,
    text or id gives no window; of equal items all are named. `keep` lists the columns that
    stay (all by default); none of `docs` may be named `hits`.

    One pass without a shuffle: the benchmark is a fixed set of queries against all rows. While it
    has about `block_words` words it is broadcast as a whole. A larger one is run in blocks of
    whole items, one pass each, and what they hit adds up.
    """
    spark = docs.sparkSession
    if "hits" in docs.columns:
        raise ValueError("docs has a column named hits")
    keep = docs.columns if keep is None else list(keep)
    fields = {field.name: field for field in docs.schema.fields}
    hits = T.StructField("hits", HITS)
    found = docs.withColumn("hits", F.lit(None).cast(HITS))
    blocks = [spark.sparkContext.broadcast(block) for block in _item_blocks(benchmark, block_words)]
    for number, block in enumerate(blocks, 1):
        names = keep if number == len(blocks) else docs.columns
        schema = T.StructType([*[fields[name] for name in names], hits])
        found = found.mapInArrow(_find_windows(block, size, names), schema)
    return found


def is_contaminated(hits: str = "hits") -> Column:
    """At least one word in HIT_SHARE is hit."""
    n_hit = F.col(hits)["n_hit"]
    return (n_hit > 0) & (HIT_SHARE * n_hit >= F.col(hits)["n_words"])


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` without contaminated documents; the others, null texts too, stay as they are."""
    return find_contamination(docs, benchmark).where(~is_contaminated()).drop("hits")


def _cut_spans(texts: pd.Series, spans: pd.Series) -> pd.Series:
    cut = []
    for text, own in zip(texts, spans, strict=True):
        if text is not None and own is not None and len(own):
            places = [match.span() for match in WORD.finditer(text)]
            kept, at = [], 0
            for span in own:
                kept.append(text[at : places[span["start"]][0]])
                at = places[span["end"] - 1][1]
            text = "".join([*kept, text[at:]])
        cut.append(text)
    return pd.Series(cut, dtype=object)


def remove_hit_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` with the words that are hit, and what stands between them, cut out of `text`."""
    found = find_contamination(docs, benchmark)
    cut = F.pandas_udf(_cut_spans, "string")
    return found.withColumn("text", cut("text", "hits.spans")).drop("hits")
