"""Document fingerprints from spot signatures.

A spot is a common word, the anchor, and the chain of content words that follows it: the next ones that are
not common themselves. Headings, menus and boilerplate have few common words, so most spots lie in
running text; in a long stretch without a common word, further words are anchors too. A text's
fingerprint is its set of spots, 32 bits each, written as sorted hex.
"""

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnmill.llm.words import ALPHANUMERIC, mix, powers, row_chunks, split_words, string_buffers, windows

# The common words, by language.
COMMON_WORDS = (
    # English
    "a an and are as at be but by for from had has have he his in is it not of on or she that the their "
    "they this to was we were which with you "
    # German
    "auf das dem den der des die ein eine er es für im ist mit nicht sich sie und von zu "
    # French
    "au avec ce dans du elle en est et il la le les par pas pour que qui sur un une "
    # Spanish
    "al con de del el las lo los no para por se su una y"
).split()
# Content words in a chain, and how many content words on the next one of a chain is.
CHAIN = 2
DISTANCE = 1
# Words without a common one after which further words are anchors.
STRETCH = 8
DIGITS = 8

FINGERPRINTS = T.StructType(
    [
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
        T.StructField("n_spots", T.LongType()),
    ]
)


class SpotSets(NamedTuple):
    """The spots of some texts, sorted and distinct: those of text i from bounds[i] to bounds[i + 1]."""

    spots: np.ndarray
    bounds: np.ndarray

    def of(self, row: int) -> np.ndarray:
        return self.spots[self.bounds[row] : self.bounds[row + 1]]


def _common_hashes() -> np.ndarray:
    data, offsets = string_buffers(pa.array(COMMON_WORDS))
    return np.unique(split_words(data, offsets, range(len(COMMON_WORDS)), ALPHANUMERIC).hashes)


def _chains(words, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, spot) of every anchor whose chain ends within its row."""
    hashes = words.hashes
    at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
    is_common = common[at] == hashes
    # The place before each word's stretch: that of the last common word, or the one before its row.
    before = np.where(is_common, np.arange(len(hashes)), -1)
    starts = words.first[:-1][np.diff(words.first) > 0]
    before[starts] = np.maximum(before[starts], starts - 1)
    before = np.maximum.accumulate(before) if len(before) else before
    is_anchor = is_common | (np.arange(len(hashes)) - before > STRETCH)
    anchors, content = np.flatnonzero(is_anchor), np.flatnonzero(~is_common)
    rows = np.searchsorted(words.first, anchors, "right") - 1
    places = np.searchsorted(content, anchors, "right")
    last = places + (CHAIN - 1) * DISTANCE
    whole = last < len(content)
    whole[whole] = content[last[whole]] < words.first[rows[whole] + 1]
    anchors, rows, places = anchors[whole], rows[whole], places[whole]
    with np.errstate(over="ignore"):
        total = hashes[anchors] * powers(CHAIN + 1)[CHAIN]
        for step in range(CHAIN):
            total = total + hashes[content[places + step * DISTANCE]] * powers(CHAIN + 1)[step]
    return rows, mix(total)


def _plain_spots(hashes: np.ndarray, text: bytes) -> np.ndarray:
    """Spots of a text without a chain: every word is an anchor; one of too few words, or none, is one spot."""
    if len(hashes):
        return windows(hashes, min(CHAIN + 1, len(hashes)))
    if not text:
        return np.zeros(0, np.uint64)
    return np.frombuffer(hashlib.blake2b(text, digest_size=8).digest(), np.uint64)


def spot_sets(texts: pa.Array, common: np.ndarray | None = None) -> SpotSets:
    """Spots of a column of texts; a null is an empty text, which has none."""
    common = _common_hashes() if common is None else common
    data, offsets = string_buffers(texts)
    rows, spots = [], []
    for chunk in row_chunks(offsets):
        words = split_words(data, offsets, chunk, ALPHANUMERIC)
        own, found = _chains(words, common)
        rows.append(own + chunk.start)
        spots.append(found)
        for row in np.flatnonzero(np.bincount(own, minlength=len(chunk)) == 0) + chunk.start:
            found = _plain_spots(words.hashes[words.of(row)], data[offsets[row] : offsets[row + 1]].tobytes())
            rows.append(np.full(len(found), row))
            spots.append(found)
    rows = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    spots = (np.concatenate(spots) if spots else np.zeros(0, np.uint64)) >> np.uint64(64 - 4 * DIGITS)
    # Row number and spot in one number: distinct and sorted by both at once.
    keys = np.unique((rows.astype(np.uint64) << np.uint64(4 * DIGITS)) | spots)
    rows = (keys >> np.uint64(4 * DIGITS)).astype(np.int64)
    return SpotSets(keys.astype(np.uint32), np.searchsorted(rows, np.arange(len(offsets))))


def fingerprint(spots: np.ndarray) -> str:
    return spots.astype(">u4").tobytes().hex()


def read_fingerprint(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u4").astype(np.uint32)


def length_partition(size: int, least: float) -> int:
    """The partition of sets by size: two sets with a likeness of `least` are in one or in neighbouring ones.

    A likeness of `least` needs the smaller set to have that share of the larger one's size.
    """
    return int(np.floor(np.log(max(size, 1)) / -np.log(least) + 1e-9)) if size else -1


def likeness(left: np.ndarray, right: np.ndarray, least: float = 0.0) -> float:
    """Jaccard likeness of two sorted sets; two empty ones are alike.

    0.0 for a likeness below `least`, most often found without a full comparison: first by the
    partitions of their sizes, then by counting what the sets lack of each other in growing slices.
    """
    if len(left) > len(right):
        left, right = right, left
    if not len(left):
        return float(not len(right))
    if 0 < least < 1 and length_partition(len(right), least) - length_partition(len(left), least) > 1:
        return 0.0
    # `common` of at least this many are needed; the smaller set may lack the rest.
    needed = least / (1 + least) * (len(left) + len(right))
    common = seen = 0
    step = max(64, len(left) // 16) if least else len(left)
    while seen < len(left):
        part = left[seen : seen + step]
        at = np.minimum(np.searchsorted(right, part), len(right) - 1)
        common += int(np.count_nonzero(right[at] == part))
        seen += len(part)
        step *= 2
        if common + len(left) - seen < needed - 1e-9:
            return 0.0
    alike = common / (len(left) + len(right) - common)
    return alike if alike >= least else 0.0


def edited(text: str, other: str) -> str:
    """The text with its last half, rounded down, replaced by as much of the other's start, or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def _result_rows(ids: pa.Array, own: list[str], following: list[str], sets: SpotSets, nexts: SpotSets, common) -> pa.RecordBatch:
    """Result rows: `own` texts with spots `sets`, each followed by a text of `following` with spots `nexts`."""
    changed = [edited(a, b) for a, b in zip(own, following, strict=True)]
    changed_sets = spot_sets(pa.array(changed, pa.large_string()), common)
    rows = range(len(own))
    return pa.RecordBatch.from_arrays(
        [
            ids,
            pa.array([len(text) for text in own], pa.int64()),
            pa.array([hashlib.sha256(text.encode()).hexdigest() for text in changed], pa.string()),
            pa.array([fingerprint(sets.of(i)) for i in rows], pa.string()),
            pa.array([fingerprint(changed_sets.of(i)) for i in rows], pa.string()),
            pa.array([likeness(sets.of(i), changed_sets.of(i)) for i in rows], pa.float64()),
            pa.array([likeness(sets.of(i), nexts.of(i)) for i in rows], pa.float64()),
            pa.array(np.diff(sets.bounds)[: len(own)].astype(np.int64)),
        ],
        ["doc_id", *FINGERPRINTS.names],
    )


def _chunks(batches) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Ids and texts of batches, in slices of a bounded number of bytes or of one text."""
    for batch in batches:
        _, offsets = string_buffers(batch.column(1))
        for rows in row_chunks(offsets):
            part = batch.slice(rows.start, len(rows))
            yield part.column(0), part.column(1).cast(pa.large_string()).fill_null("")


def _scan_followed(batches):
    """Result rows of all but a partition's last row, of sorted (doc_id, text)."""
    common = _common_hashes()
    held = None
    for ids, texts in _chunks(batches):
        if held is not None:
            ids = pa.concat_arrays([held[0], ids])
            texts = pa.concat_arrays([held[1], texts])
        last = len(ids) - 1
        if last:
            shown = texts.to_pylist()
            sets = spot_sets(texts, common)
            nexts = SpotSets(sets.spots, sets.bounds[1:])
            yield _result_rows(ids.slice(0, last), shown[:-1], shown[1:], sets, nexts, common)
        held = ids.slice(last), texts.slice(last)


def _scan_edges(batches):
    """One row per partition that has rows: its number, its first text, its last id and text."""
    first = last = None
    for batch in batches:
        if batch.num_rows:
            if first is None:
                first = batch.slice(0, 1)
            last = batch.slice(batch.num_rows - 1)
    if last is not None:
        yield pa.RecordBatch.from_arrays(
            [first.column(2), first.column(1), last.column(0), last.column(1)],
            ["part", "first_text", "doc_id", "text"],
        )


def _scan_pairs(batches):
    """Result rows of (doc_id, text, next_text)."""
    common = _common_hashes()
    for batch in batches:
        own, following = (batch.column(i).cast(pa.large_string()).fill_null("") for i in (1, 2))
        sets, nexts = spot_sets(own, common), spot_sets(following, common)
        yield _result_rows(batch.column(0), own.to_pylist(), following.to_pylist(), sets, nexts, common)


def fingerprint_documents(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_spots) per row.

    Every whole text of `docs` (doc_id, text) gets a fingerprint; a null text counts as empty. Words are runs
    of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. In a text in which no anchor has a
    whole chain after it every word is one; a text with too few words for that, or without words but not
    empty, is one spot; an empty text has no spot and an empty fingerprint. The edited text is the text with the last half
    of its code points, rounded down, replaced by the first as many of the next row's text. Rows are in
    the order of doc_id, nulls first, equal ids by a hash of the text; the last row's next is the first, so a
    single row's next is itself. Likeness is Jaccard's of the spot sets; two empty ones are alike. Rows that
    repeat an id, a text or both all stay. Other columns are ignored. An empty table gives no rows.

    Rows are range partitioned once, which spreads any id, text or run of copies over tasks, and each
    meets the next as its partition streams by. A partition's last row meets the first of the next one that has rows in a join
    of one row per partition; both read the same exchange.
    """
    spark = docs.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["doc_id", "_hash", "_row"]
    ranged = (
        docs.select("doc_id", "text")
        .withColumns({"_hash": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
        .repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text", F.spark_partition_id().alias("part"))
    )
    identity = ranged.schema["doc_id"]
    schema = T.StructType([identity, *FINGERPRINTS.fields])
    followed = ranged.select("doc_id", "text").mapInArrow(_scan_followed, schema)

    id_type = identity.dataType.simpleString()
    edges = ranged.mapInArrow(_scan_edges, f"part int, first_text string, doc_id {id_type}, text string")
    parts = edges.select("part")
    following = F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy()))
    pairs = (
        edges.select("part", "doc_id", "text")
        .join(parts.select("part", following.alias("next_part")), "part")
        .join(edges.select(F.col("part").alias("next_part"), F.col("first_text").alias("next_text")), "next_part")
        .select("doc_id", "text", "next_text")
    )
    return followed.unionByName(pairs.mapInArrow(_scan_pairs, schema))
