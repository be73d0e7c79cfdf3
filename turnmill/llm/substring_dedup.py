"""Substring dedup by paragraph MinHash banding.

Paragraphs are lines, and spans wherever in the text. Each distinct line is given bands of its
MinHash signature; lines that share a band are joined and verified by exact Jaccard similarity (see
`linking`), and the components of verified links, copies included, are classes of repeated
lines. Spans are chosen by the least hash too, of each stretch of neighbouring spans, so that texts which
share a longer passage have the same spans in it, however their lines are broken; a span's
class are its verbatim copies. A repeated passage is a run of such paragraphs of one
document, so that it may start and end anywhere.
"""

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnmill.checkpoints import store
from turnmill.llm.linking import ENTRY, SETS, link_sets, may_contain, node_filter, sketch_columns, sketches
from turnmill.llm.words import (
    SPACED,
    Words,
    mix,
    pack_set,
    row_chunks,
    set_ids,
    split_words,
    string_buffers,
    windows,
)

SHINGLE = 5
# A signature of BANDS bands of BAND_ROWS minima: two paragraphs with a similarity of 0.8 share a band
# with a chance of 1 - (1 - 0.8^2)^8 = 0.9997, and of 0.9 with 0.999998.
BANDS, BAND_ROWS = 8, 2
# Words that a passage needs to count as repeated, over all its paragraphs.
LEAST_WORDS = 50
# Paragraphs with fewer words are not looked up; between repeated ones they do not end a passage.
LEAST_PARAGRAPH = 5
NEWLINE = 0x0A
# A line is sketched in so many 64-bit words.
SKETCH = 4
# Words of a span, and of how many spans in a row the one with the least hash is chosen. Texts with
# SPAN + SPAN_CHOICE - 1 = 51 words in common share a chosen span.
SPAN, SPAN_CHOICE = 35, 17
# Classes with at least one in MAX_HOT of all rows are joined to their rows by a broadcast: MAX_HOT of them at most,
# a row each.
MAX_HOT = 1 << 14


class Chunk(NamedTuple):
    """Some rows of a string column: bytes, where rows and lines start in them (and the last one ends), words by line."""

    rows: range
    text: np.ndarray
    row_starts: np.ndarray
    cuts: np.ndarray
    words: Words

    def characters(self) -> np.ndarray:
        """Code points before each byte, and in all."""
        return np.concatenate([[0], np.cumsum((self.text & 0xC0) != 0x80)])


class Lines(NamedTuple):
    """Lines of some rows that have words enough, with their shingle sets end to end. `row` counts rows of the
    column, `seq` these lines of a text; `first` and `last` number words of the chunk, `last` exclusive."""

    row: np.ndarray
    seq: np.ndarray
    first: np.ndarray
    last: np.ndarray
    node: np.ndarray
    shingles: np.ndarray
    bounds: np.ndarray

    def members(self, line: int) -> np.ndarray:
        return self.shingles[self.bounds[line] : self.bounds[line + 1]]


def text_chunks(column: pa.Array) -> Iterator[Chunk]:
    data, offsets = string_buffers(column)
    for rows in row_chunks(offsets):
        base = int(offsets[rows.start])
        text = data[base : int(offsets[rows.stop])]
        row_starts = offsets[rows.start : rows.stop + 1] - base
        cuts = np.union1d(np.flatnonzero(text == NEWLINE) + 1, row_starts)
        yield Chunk(rows, text, row_starts, cuts, split_words(data, offsets, rows, SPACED, cuts))


def _distinct(values: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each value of each line once, ordered by line. `line` is in order."""
    order = None
    if not len(line) or line[-1] < 1 << 20:
        # One sort by line and the first 44 bits; if these are equal for different values, by both in full.
        key = (line.astype(np.uint64) << np.uint64(44)) | (values >> np.uint64(20))
        order = np.argsort(key)
        key, ordered = key[order], values[order]
        if np.any((key[1:] == key[:-1]) & (ordered[1:] != ordered[:-1])):
            order = None
    if order is None:
        order = np.lexsort((values, line))
    values, line = values[order], line[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (line[1:] != line[:-1])
    return values[fresh], line[fresh]


def lines_of(chunk: Chunk, shingle: int, least: int) -> Lines | None:
    """Lines of at least `least` words; None if there are none."""
    words = chunk.words
    chosen = np.flatnonzero(np.diff(words.first) >= max(least, shingle))
    if not len(chosen):
        return None
    row = np.searchsorted(chunk.row_starts, chunk.cuts[chosen], "right") - 1
    first, last = words.first[chosen], words.first[chosen + 1]
    hashes = windows(words.hashes, shingle)
    sizes = last - first - shingle + 1
    line = np.repeat(np.arange(len(chosen)), sizes)
    at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[line]
    values, line = _distinct(hashes[at], line)
    bounds = np.searchsorted(line, np.arange(len(chosen) + 1))
    seq = np.arange(len(chosen)) - np.searchsorted(row, row)
    return Lines(row + chunk.rows.start, seq, first, last, set_ids(values, bounds), values, bounds)


def line_sets(column: pa.Array, shingle: int, least: int) -> Iterator[Lines]:
    for chunk in text_chunks(column):
        lines = lines_of(chunk, shingle, least)
        if lines is not None:
            yield lines


def line_bands(lines: Lines, chosen: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One number per line and band, from the least hash values of each line's set."""
    with np.errstate(over="ignore"):
        seeds = mix(np.arange(1, bands * rows + 1, dtype=np.uint64))
        found = np.empty((len(chosen), bands), np.uint64)
        for band in range(bands):
            total = np.full(len(chosen), band, np.uint64)
            for row in range(rows):
                seed = seeds[band * rows + row]
                least = np.minimum.reduceat(mix(lines.shingles ^ seed), lines.bounds[:-1])[chosen]
                total = mix(total ^ least)
            found[:, band] = total
        return found


# What a scan finds: lines (node is not null) and spans (span is not null). `row` tells rows of the input apart.
FOUND = "row long, seq int, start long, end long, first_word long, last_word long, node long, span long"


def _extreme(values: np.ndarray, size: int, of: np.ufunc) -> np.ndarray:
    """The least or greatest of each `size` values in a row."""
    done = 1
    while done < size:
        step = min(done, size - done)
        values = of(values[:-step], values[step:])
        done += step
    return values


def chosen_spans(words: Words, size: int, choice: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of spans of `size` words that have the least hash of `choice` spans in a row
    of one text."""
    hashes = windows(words.hashes, size)
    if len(hashes) < choice:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    least = _extreme(hashes, choice, np.minimum)
    # A stretch that runs into the next text chooses nothing: no hash is as low as zero.
    whole = text[: len(least)] == text[size + choice - 2 :][: len(least)]
    least = np.where(whole, least, np.uint64(0))
    edge = np.zeros(choice - 1, np.uint64)
    best = _extreme(np.concatenate([edge, least, edge]), choice, np.maximum)
    at = np.flatnonzero((best == hashes) & (hashes != 0))
    return at, hashes[at]


def _scan_found(shingle: int, least: int, size: int, choice: int) -> Callable:
    """(doc_id, FOUND, sketch) of lines and chosen spans, from one pass that numbers the rows."""

    def scan(batches):
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40

        def found(batch, chunk, rows, seq, first, last, node, span, bits):
            words, before = chunk.words, chunk.characters()
            own = rows - chunk.rows.start
            row_word = np.searchsorted(words.starts, chunk.row_starts)[own]
            row_character = before[chunk.row_starts[own]]
            numbers = {
                "row": rows + row,
                "start": before[words.starts[first]] - row_character,
                "end": before[words.ends[last - 1]] - row_character,
                "first_word": first - row_word,
                "last_word": last - row_word,
            }
            empty = pa.nulls(len(rows), pa.int64())
            columns = {
                "doc_id": batch.column("doc_id").take(pa.array(rows)),
                "seq": empty.cast(pa.int32()) if seq is None else pa.array(seq.astype(np.int32)),
                **{name: pa.array(values.astype(np.int64)) for name, values in numbers.items()},
                "node": empty if node is None else pa.array(node),
                "span": empty if span is None else pa.array(span),
                **{c: empty if bits is None else pa.array(bits[:, i]) for i, c in enumerate(sketch_columns(SKETCH))},
            }
            names = ["doc_id", *[f.split()[0] for f in FOUND.split(", ")], *sketch_columns(SKETCH)]
            return pa.RecordBatch.from_arrays([columns[name] for name in names], names)

        for batch in batches:
            for chunk in text_chunks(batch.column("text")):
                lines = lines_of(chunk, shingle, least)
                if lines is not None:
                    bits = sketches(lines.shingles, lines.bounds, SKETCH)
                    yield found(batch, chunk, lines.row, lines.seq, lines.first, lines.last, lines.node, None, bits)
                words = chunk.words._replace(first=np.searchsorted(chunk.words.starts, chunk.row_starts))
                at, hashes = chosen_spans(words, size, choice)
                if len(at):
                    rows = np.searchsorted(words.first, at, "right") - 1 + chunk.rows.start
                    yield found(batch, chunk, rows, None, at, at + size, None, hashes.view(np.int64), None)
            row += batch.num_rows

    return scan


def _new_lines(lines: Lines, seen: set[int]) -> np.ndarray:
    """Lines with a set that the batch has not had yet."""
    _, first = np.unique(lines.node, return_index=True)
    fresh = [i for i in np.sort(first).tolist() if int(lines.node[i]) not in seen]
    seen.update(lines.node[fresh].tolist())
    return np.array(fresh, np.int64)


def _scan_bands(shingle: int, least: int, bands: int, rows: int) -> Callable:
    """ENTRY rows: the bands of each distinct line of a batch."""

    def scan(batches):
        for batch in batches:
            seen: set[int] = set()
            for lines in line_sets(batch.column("text"), shingle, least):
                chosen = _new_lines(lines, seen)
                if not len(chosen):
                    continue
                tokens = line_bands(lines, chosen, bands, rows).ravel()
                sizes = np.diff(lines.bounds)[chosen]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(tokens.astype(np.int64)),
                        pa.array(np.repeat(lines.node[chosen], bands)),
                        pa.array(np.repeat(sizes, bands).astype(np.int32)),
                        pa.array(np.zeros(len(tokens), np.int32)),
                        pa.array(np.ones(len(tokens), np.int32)),
                    ],
                    ["token", "node", "n", "pos", "shards"],
                )

    return scan


def _scan_members(shingle: int, least: int, asked) -> Callable:
    """SETS rows for the nodes that may be in the filter."""

    def scan(batches):
        bitmap = np.frombuffer(asked.value, np.int64)
        for batch in batches:
            seen: set[int] = set()
            for lines in line_sets(batch.column("text"), shingle, least):
                chosen = [i for i in _new_lines(lines, seen).tolist() if may_contain(bitmap, int(lines.node[i]))]
                sizes = np.diff(lines.bounds)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(lines.node[chosen], pa.int64()),
                        pa.array(sizes[chosen].astype(np.int32), pa.int32()),
                        pa.array([pack_set(lines.members(i)) for i in chosen], pa.binary()),
                    ],
                    ["node", "n", "members"],
                )

    return scan


def find_paragraphs(
    docs: DataFrame, shingle: int = SHINGLE, least: int = LEAST_PARAGRAPH, size: int = SPAN, choice: int = SPAN_CHOICE
) -> DataFrame:
    """The lines and chosen spans of `docs` (doc_id, text), stored: (doc_id, FOUND, sketch). Rows get their numbers in
    this one pass, so that lines and spans of a row stay together even if the input would come in another order again."""
    texts = docs.select("doc_id", "text")
    kind = texts.schema["doc_id"].dataType.simpleString()
    bits = ", ".join(f"{c} long" for c in sketch_columns(SKETCH))
    return store(texts.mapInArrow(_scan_found(shingle, least, size, choice), f"doc_id {kind}, {FOUND}, {bits}"))


def repeated_paragraphs(
    docs: DataFrame,
    found: DataFrame,
    shingle: int = SHINGLE,
    least: int = LEAST_PARAGRAPH,
    bands: int = BANDS,
    rows: int = BAND_ROWS,
) -> DataFrame:
    """Paragraphs that are in several rows of `docs` (doc_id, text), exactly or nearly: (doc_id, row,
    seq, start, end, first_word, last_word, class_id, first_doc_id, first). `found`: `find_paragraphs` of them.

    A paragraph is a line of at least `least` words (A-Z lower-cased, between ASCII white space);
    two are alike when their sets of `shingle`-word shingles have 100 * intersection >= 80 *
    union. class_id names the component of such links, first_doc_id the least doc_id in it; `first` is true
    for one occurrence of each class, in the least document: all others can be removed. Offsets are code
    points, without white space around the line. Lines repeated only within one row are not
    given. Null and empty texts have none; rows that repeat a doc_id are texts of their own.
    """
    spark = docs.sparkSession
    texts = docs.select("text")
    bits = sketch_columns(SKETCH)
    lines = found.where("node IS NOT NULL").drop("span")
    entries = texts.mapInArrow(_scan_bands(shingle, least, bands, rows), ENTRY)

    def members(nodes: DataFrame) -> DataFrame:
        sent = spark.sparkContext.broadcast(node_filter(nodes))
        return texts.mapInArrow(_scan_members(shingle, least, sent), SETS)

    labels = link_sets(entries, members, lines.select("node", *bits), bound_blocks=True)
    # Copies of a line meet in partial aggregates; classes are made of one row for each different line.
    place = F.struct("doc_id", "row", "seq")
    nodes = lines.groupBy("node").agg(
        F.min("row").alias("lo"), F.max("row").alias("hi"), F.min(place).alias("one"), F.count("*").alias("n")
    )
    nodes = store(
        nodes.join(labels, "node", "left").withColumn("class_id", F.coalesce("label", "node")).drop("label")
    )
    classes = (
        nodes.groupBy("class_id")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("one").alias("one"), F.count("*").alias("n"))
        .where("lo <> hi")
        .select("class_id", "one", "n")
    )
    named = with_classes(nodes.select("node", "class_id", F.col("n").alias("lines")), classes, "class_id")
    named = named.withColumnRenamed("lines", "n")
    return with_classes(lines.drop(*bits), named, "node").select(
        "doc_id", "row", "seq", "start", "end", "first_word", "last_word", "class_id",
        F.col("one.doc_id").alias("first_doc_id"),
        ((F.col("row") == F.col("one.row")) & (F.col("seq") == F.col("one.seq"))).alias("first"),
    )


def with_classes(rows: DataFrame, classes: DataFrame, key: str, most: int = MAX_HOT) -> DataFrame:
    """Stored `rows` joined to `classes` (key, n, ...), where n counts the rows of a key.

    Classes that hold many of the rows, `most` at most, are broadcast, so that their rows stay where they are; the
    others are met in a shuffle. What counts as many is a share of the rows, alike at every size. Null keys meet nothing.
    """
    classes = store(classes)
    total = classes.agg(F.sum("n")).first()[0] or 0
    least = -(-total // most)
    hot = F.broadcast(classes.where(F.col("n") >= least).drop("n"))
    cold = classes.where(F.col("n") < least).drop("n")
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(cold, key))


def repeated_spans(found: DataFrame) -> DataFrame:
    """Spans of `find_paragraphs` that are in several rows verbatim, but for the case of
    A-Z and white space: (doc_id, row, start, end, first_word, last_word, first_doc_id, first).

    Rows that have `size + choice - 1` words in a row in common share a span within them. first_doc_id is the least
    document with the span; `first` is true in its first row. Null and empty texts have none.
    """
    spans = found.where("span IS NOT NULL")
    shared = (
        spans.groupBy("span")
        .agg(
            F.min("row").alias("lo"), F.max("row").alias("hi"), F.min(F.struct("doc_id", "row")).alias("one"),
            F.count("*").alias("n"),
        )
        .where("lo <> hi")
        .select("span", "one", "n")
    )
    return with_classes(spans, shared, "span").select(
        "doc_id", "row", "start", "end", "first_word", "last_word",
        F.col("one.doc_id").alias("first_doc_id"),
        (F.col("row") == F.col("one.row")).alias("first"),
    )


def repeated_passages(
    docs: DataFrame,
    least_words: int = LEAST_WORDS,
    shingle: int = SHINGLE,
    least: int = LEAST_PARAGRAPH,
    bands: int = BANDS,
    rows: int = BAND_ROWS,
) -> DataFrame:
    """Repeated passages: (doc_id, start, end, n_words, n_paragraphs, n_removed, n_spans, n_spans_removed,
    first_doc_id).

    A passage is a run of repeated lines with at least `least_words` words, or of
    repeated spans, or of both where they overlap. Shorter lines between do not end a run of
    lines. So a passage that two rows have verbatim is found if it has SPAN + SPAN_CHOICE - 1 words, to within
    SPAN_CHOICE - 1 words at either end. n_paragraphs and n_spans count lines and spans, n_removed and
    n_spans_removed those that are not the first of their class; first_doc_id is the least document with one of them; a row
    without a doc_id counts as least of all, and gives a null if it is the first of all of the passage's paragraphs. Null and empty texts have no passages, an empty table gives no rows.
    """
    found = find_paragraphs(docs, shingle, least)
    lines = repeated_paragraphs(docs, found, shingle, least, bands, rows)
    order = Window.partitionBy("row").orderBy("seq")
    new = F.coalesce(F.col("seq") != F.lag("seq").over(order) + 1, F.lit(True))
    runs = lines.withColumn("new", new.cast("int")).withColumn("run", F.sum("new").over(order))
    runs = _passages(runs).where(F.col("last_word") - F.col("first_word") >= least_words)
    spans = repeated_spans(found).withColumns(
        {"n_paragraphs": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long"), "n_spans": F.lit(1).cast("long")}
    )
    runs = runs.drop("run").withColumn("n_spans", F.lit(0).cast("long"))
    pieces = runs.unionByName(spans.withColumn("n_spans_removed", (~F.col("first")).cast("long")).drop("first"), True)
    # A piece that starts behind all pieces before it starts a passage.
    order = Window.partitionBy("row").orderBy("first_word", "last_word")
    before = F.max("last_word").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce(F.col("first_word") > before, F.lit(True))
    pieces = pieces.withColumn("new", new.cast("int")).withColumn(
        "run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    passages = pieces.groupBy("row", "run").agg(
        F.first("doc_id").alias("doc_id"),
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        (F.max("last_word") - F.min("first_word")).alias("n_words"),
        F.sum("n_paragraphs").alias("n_paragraphs"),
        F.sum("n_removed").alias("n_removed"),
        F.sum("n_spans").alias("n_spans"),
        F.coalesce(F.sum("n_spans_removed"), F.lit(0)).alias("n_spans_removed"),
        F.min("first_doc_id").alias("first_doc_id"),
    )
    return passages.drop("row", "run")


def _passages(runs: DataFrame) -> DataFrame:
    """One piece for each (row, run) of paragraphs."""
    return runs.groupBy("row", "run").agg(
        F.first("doc_id").alias("doc_id"),
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        F.min("first_word").alias("first_word"),
        F.max("last_word").alias("last_word"),
        F.count("*").alias("n_paragraphs"),
        F.sum((~F.col("first")).cast("long")).alias("n_removed"),
        F.min("first_doc_id").alias("first_doc_id"),
    )
