"""N-gram Jaccard join of documents with set-relation skipping (see `linking`)."""

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnmill.checkpoints import store
from turnmill.llm.linking import ENTRY, SETS, link_sets, may_contain_each, node_filter, sketch_columns, sketches
from turnmill.llm.words import (
    SPACED,
    pack_set,
    row_chunks,
    set_ids,
    shingle_sets,
    split_words,
    string_buffers,
)

SHINGLE = 5
# About so much text is made sets at a time, and so many shingles are held to count those that sets share (32 MB): a worker
# holds no more than these beside the batch it was sent, however long the texts of a batch are, one text apart.
CHUNK_BYTES = 250_000
COUNTED = 1 << 22
# So many of them are looked through at a time, so that what they share is handed on in small batches.
PART = 1 << 14
# Most shingles in the table of frequent ones that is sent to every executor: 32 MB.
MAX_FREQUENT = 2_000_000
# A list with 2^(SHARD_CLASS + i) counted copies is dealt over 2^i shards.
SHARD_CLASS = 8
MAX_SHARDS = 1 << 16
# A set is sketched in so many 64-bit words. With fewer, sets of 600 shingles or more are never far enough apart.
SKETCH = 16
# An entry has 40 bits of its shingle's hash; the zeros need no room in a shuffle. Lists of shingles that are alike in
# them are one, which gives more candidates, not other links.
TOKEN_BITS = np.uint64(0xFFFFFFFFFF000000)
# First places of a quick test for frequent shingles.
HINT_BITS = np.uint64((1 << 22) - 1)


class Sets(NamedTuple):
    """Sorted shingle sets of a run of rows, end to end."""

    rows: range
    shingles: np.ndarray
    bounds: np.ndarray

    def nodes(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the run with a set that is not empty, and these sets' ids."""
        filled = np.flatnonzero(np.diff(self.bounds))
        if not len(filled):
            return filled, np.zeros(0, np.int64)
        return filled, set_ids(self.shingles, np.append(self.bounds[filled], self.bounds[-1]))


def text_sets(column: pa.Array, size: int) -> Iterator[Sets]:
    """The shingle sets of a column of texts, a few rows at a time."""
    data, offsets = string_buffers(column)
    for rows in row_chunks(offsets, CHUNK_BYTES):
        yield Sets(rows, *shingle_sets(split_words(data, offsets, rows, SPACED), size))


def _new_sets(sets: Sets, seen: set[int]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a run with a set that has not come up yet, and these sets' ids."""
    rows, nodes = sets.nodes()
    _, first = np.unique(nodes, return_index=True)
    fresh = np.array([i for i in np.sort(first).tolist() if int(nodes[i]) not in seen], np.int64)
    seen.update(nodes[fresh].tolist())
    return rows[fresh], nodes[fresh]


def prefix_size(n):
    """So many first members that two sets with a similarity of 4/5 share one of them."""
    return n - -(-4 * n // 5) + 1


class Order:
    """The order of shingles in every set: rare ones first, by hash; frequent ones last."""

    def __init__(self, shingles: np.ndarray, classes: np.ndarray):
        """`shingles`: the frequent ones, sorted."""
        self.shingles, self.classes = shingles, classes
        self.hint = np.zeros(int(HINT_BITS) + 1, bool)
        self.hint[(self.shingles & HINT_BITS).astype(np.int64)] = True

    def classes_of(self, members: np.ndarray) -> np.ndarray:
        """The class of each member (0: rare)."""
        classes = np.zeros(len(members), np.int8)
        maybe = np.flatnonzero(self.hint[(members & HINT_BITS).astype(np.int64)])
        if len(maybe):
            at = np.searchsorted(self.shingles, members[maybe])
            at[at == len(self.shingles)] = 0
            hit = self.shingles[at] == members[maybe]
            classes[maybe[hit]] = self.classes[at[hit]]
        return classes

    def prefixes(self, sets: Sets, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The first members of the sets of these rows in this order, their classes, and how many they are in each set."""
        classes = self.classes_of(sets.shingles)
        frequent = np.concatenate([[0], np.cumsum(classes > 0)])[sets.bounds]
        sizes = prefix_size(np.diff(sets.bounds)[rows])
        first = sets.bounds[rows]
        at = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        ends = np.cumsum(sizes)
        for i in np.flatnonzero(frequent[rows + 1] > frequent[rows]).tolist():
            own = classes[first[i] : sets.bounds[rows[i] + 1]]
            at[ends[i] - sizes[i] : ends[i]] = first[i] + np.argsort(own, kind="stable")[: sizes[i]]
        return sets.shingles[at], classes[at], sizes


def _shared_tokens(together: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Shingles that are in several of the sets that lie end to end, which are sorted in place, and in how many: those of
    about PART members at a time."""
    together.sort()
    start = 0
    while start < len(together):
        end = min(start + PART, len(together))
        end = int(np.searchsorted(together, together[end - 1], "right"))
        own = together[start:end]
        start = end
        again = np.flatnonzero(own[1:] == own[:-1])
        if len(again):
            first = np.flatnonzero(np.diff(again, prepend=-2) > 1)
            yield own[again[first]], np.diff(first, append=len(again)) + 1


def _scan_documents(size: int) -> Callable:
    """(doc_id, n, node, key, sketch) of each row, and (token, count) of shingles that several of the rows read
    together share: few rows, but each frequent shingle is among them."""
    names = ["doc_id", "n", "node", "key", *sketch_columns(SKETCH), "token", "count"]

    def scan(batches):
        # With room for one run of rows more.
        held, size_held, id_type = np.empty(COUNTED + CHUNK_BYTES, np.uint64), 0, None

        def shared():
            for tokens, counts in _shared_tokens(held[:size_held]):
                none = len(tokens)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.nulls(none, id_type),
                        pa.nulls(none, pa.int32()),
                        *[pa.nulls(none, pa.int64()) for _ in range(2 + SKETCH)],
                        pa.array(tokens.astype(np.int64)),
                        pa.array(counts.astype(np.int64)),
                    ],
                    names,
                )

        for batch in batches:
            id_type = batch.column("doc_id").type
            for sets in text_sets(batch.column("text"), size):
                rows = len(sets.rows)
                filled, ids = sets.nodes()
                node = np.zeros(rows, np.int64)
                node[filled] = ids
                sizes = np.diff(sets.bounds)
                bits = sketches(sets.shingles, sets.bounds, SKETCH)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(sets.rows.start, rows),
                        pa.array(sizes.astype(np.int32)),
                        pa.array(node, mask=sizes == 0),
                        batch.column("key").slice(sets.rows.start, rows),
                        *[pa.array(bits[:, i]) for i in range(SKETCH)],
                        pa.nulls(rows, pa.int64()),
                        pa.nulls(rows, pa.int64()),
                    ],
                    names,
                )
                end = size_held + len(sets.shingles)
                if end > len(held):
                    held = np.concatenate([held[:size_held], np.empty(end - size_held, np.uint64)])
                held[size_held:end] = sets.shingles
                size_held = end
                if size_held >= COUNTED:
                    yield from shared()
                    size_held = 0
        yield from shared()

    return scan


def frequent_shingles(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles with the largest sums of (token, count), sorted, and the logarithm of the sum as class.

    At most MAX_FREQUENT: each stands for at least that share of the total.
    """
    sums = store(counted.groupBy("token").agg(F.sum("count").alias("count")))
    total = sums.agg(F.sum("count")).first()[0] or 0
    least = max(8, -(-total // MAX_FREQUENT))
    frequent = sums.where(F.col("count") >= least).select(
        "token", F.floor(F.log2("count")).cast("tinyint").alias("class")
    ).toPandas()
    tokens = frequent["token"].to_numpy(np.int64).astype(np.uint64)
    by_value = np.argsort(tokens)
    return tokens[by_value], frequent["class"].to_numpy(np.int8)[by_value]


def _scan_entries(size: int, order) -> Callable:
    """ENTRY rows: the prefix of each distinct set of a batch."""

    def scan(batches):
        ranks = Order(*order.value)
        for batch in batches:
            seen: set[int] = set()
            for sets in text_sets(batch.column("text"), size):
                rows, nodes = _new_sets(sets, seen)
                if not len(rows):
                    continue
                tokens, classes, sizes = ranks.prefixes(sets, rows)
                shards = np.minimum(1 << np.maximum(classes.astype(np.int64) - SHARD_CLASS, 0), MAX_SHARDS)
                places = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((tokens & TOKEN_BITS).astype(np.int64)),
                        pa.array(np.repeat(nodes, sizes)),
                        pa.array(np.repeat(np.diff(sets.bounds)[rows].astype(np.int32), sizes)),
                        pa.array(places.astype(np.int32)),
                        pa.array(shards.astype(np.int32)),
                    ],
                    ["token", "node", "n", "pos", "shards"],
                )

    return scan


def _scan_members(size: int, asked) -> Callable:
    """SETS rows for the texts whose keys may be in the filter; of other texts no set is made."""

    def scan(batches):
        bitmap = np.frombuffer(asked.value, np.int64)
        for batch in batches:
            seen: set[int] = set()
            wanted = may_contain_each(bitmap, batch.column("key").to_numpy())
            texts = batch.column("text").filter(pa.array(wanted))
            for sets in text_sets(texts, size):
                rows, nodes = _new_sets(sets, seen)
                first, end = sets.bounds[rows], sets.bounds[rows + 1]
                packed = [pack_set(sets.shingles[a:b]) for a, b in zip(first.tolist(), end.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes), pa.array((end - first).astype(np.int32)), pa.array(packed, pa.binary())],
                    ["node", "n", "members"],
                )

    return scan


def jaccard_components(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of `docs` (doc_id, text).

    A text's set: its distinct shingles of `shingle` words (A-Z lower-cased, separated by
    ASCII white space); a text with fewer words is one shingle, an empty or null text has an
    empty set and is linked with nothing. Two rows are linked when 100 * intersection >=
    80 * union; component_id is the least doc_id reachable by links, its own included.
    Equal sets are one node throughout, so copies cost one row each. Rows that repeat a doc_id
    are kept and judged each by its own text; a null doc_id takes part, but is no component's id
    unless all of the component's are null. Other columns are ignored. An empty table gives no rows.

    Sets are compared by 64-bit ids and shingles by 40 bits of their hash, so two
    different ones are taken for the same once in about 10^12 shingle pairs.
    """
    spark = docs.sparkSession
    # A text's key tells a later scan, before it makes the text's set, whether the set may be asked for.
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))
    id_type = texts.schema["doc_id"].dataType.simpleString()
    scanned = store(
        texts.mapInArrow(
            _scan_documents(shingle),
            f"doc_id {id_type}, n int, node long, key long, "
            f"{', '.join(f'{c} long' for c in sketch_columns(SKETCH))}, token long, count long",
        )
    )
    order = spark.sparkContext.broadcast(frequent_shingles(scanned.where("token IS NOT NULL").select("token", "count")))
    entries = texts.select("text").mapInArrow(_scan_entries(shingle, order), ENTRY)

    def members(nodes: DataFrame) -> DataFrame:
        # One text of each set is enough.
        own = scanned.where("node IS NOT NULL").join(nodes, "node", "left_semi")
        keys = own.groupBy("node").agg(F.min("key").alias("key"))
        sent = spark.sparkContext.broadcast(node_filter(keys.select(F.col("key").alias("node"))))
        return texts.select("text", "key").mapInArrow(_scan_members(shingle, sent), SETS)

    sketched = scanned.where("node IS NOT NULL").select("node", *sketch_columns(SKETCH))
    labels = link_sets(entries, members, sketched)
    rows = scanned.where("token IS NULL").select("doc_id", "n", "node")
    labelled = rows.join(labels, "node", "left").select(
        "doc_id", "n", F.coalesce("label", "node").alias("label")
    )
    least = labelled.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("least"))
    return labelled.join(least, "label", "left").select(
        "doc_id",
        F.col("n").cast("bigint").alias("n_shingles"),
        F.coalesce("least", "doc_id").alias("component_id"),
    )
