"""Token counts by a map-side lookup of pre-token lengths in two tiers.

Byte-level BPE never merges across pre-tokens, so a text has as many tokens as its
pre-tokens have. A space between two characters that are no white space starts a pre-token, whatever
script they are of, so texts are cut there into pieces: a piece is one pre-token or several
("it's", "end.\\nNext"). Pieces are found and hashed by numpy, many texts at once. The
lengths of frequent pieces are broadcast as a compact table of hashes and lengths; the others are encoded
where they occur and their lengths kept in a cache of the worker. No pre-token of a text is shuffled.
"""

import os
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnmill.llm.words import mix, row_chunks, string_buffers

# Most entries of the broadcast table, and of what one task proposes for it. Only pieces of at most
# LONGEST bytes are proposed, so the table is made from at most FREQUENT * LONGEST bytes of text.
FREQUENT = 1 << 16
PROPOSED = 1 << 13
LONGEST = 64
# A task's counts are cut back to PROPOSED * 8 entries when it has this many.
COUNTED = 1 << 19
# Most lengths a worker's cache holds before it starts anew.
CACHED = 1 << 20
# Characters encoded at a time, unless one text is longer.
ENCODED = 1 << 16
# Bytes hashed at a time, unless one text is longer.
CHUNK = 1 << 18

SPACE = 0x20
# White space outside ASCII, as Unicode has it, and U+180E, which it had once.
WIDE_WHITE = (
    "\u0085\u00a0\u1680\u180e\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Hash values of bytes, and a multiplier per place with its inverse.
_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTOR = 0xD6E8FEB86659FD93
_INVERSE = pow(_FACTOR, -1, 1 << 64)


def _powers(base: int, count: int) -> np.ndarray:
    values = np.full(count, base, np.uint64)
    values[:1] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(values)


def _kept() -> dict:
    """What this process keeps over its tasks.

    Functions of this package reach a worker by value, with a copy of each variable of the module that they use, anew
    for each task. Only what hangs on a loaded module stays, and is not sent along.
    """
    name = f"{__name__}.kept"
    return vars(sys.modules.setdefault(name, types.ModuleType(name)))


def _places(count: int) -> tuple[np.ndarray, np.ndarray]:
    kept = _kept()
    if "places" not in kept:
        kept["places"] = _powers(_FACTOR, 1 << 19), _powers(_INVERSE, 1 << 19)
    up, down = kept["places"]
    if count <= len(up):
        return up[:count], down
    return _powers(_FACTOR, count), _powers(_INVERSE, count)


def _white(data: np.ndarray) -> np.ndarray:
    """Bytes of white space and, to be safe, of all ASCII controls."""
    white = data <= SPACE
    if not len(data) or data.max() < 0x80:
        return white
    by_lead: dict[int, list[bytes]] = {}
    for character in WIDE_WHITE:
        by_lead.setdefault(character.encode()[0], []).append(character.encode())
    for lead, spelled in by_lead.items():
        at = np.flatnonzero(data == lead)
        for code in spelled if len(at) else ():
            found = at[at <= len(data) - len(code)]
            for place, byte in enumerate(code):
                found = found[data[found + place] == byte]
            for place in range(len(code)):
                white[found + place] = True
    return white


def cut_pieces(data: np.ndarray, row_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces start in texts that lie end to end, and the number of the first one of each text.

    `row_starts` has the end of the last text too. An empty text has no piece.
    """
    starts = np.zeros(len(data), bool)
    if len(data) > 2:
        white = _white(data)
        starts[1:-1] = (data[1:-1] == SPACE) & ~white[:-2] & ~white[2:]
    starts[row_starts[row_starts < len(data)]] = True
    starts = np.flatnonzero(starts)
    return starts, np.searchsorted(starts, row_starts)


def hash_pieces(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit hashes of the pieces."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _places(len(data))
    with np.errstate(over="ignore"):
        sums = np.add.reduceat(_VALUES[data] * up, starts) * down[starts]
        return mix(sums + np.diff(starts, append=len(data)).astype(np.uint64))


def hash_spelled(pieces: list[str]) -> np.ndarray:
    """Hashes of pieces that are not empty."""
    sizes = [len(piece.encode()) for piece in pieces]
    starts = np.cumsum([0, *sizes])[:-1].astype(np.int64)
    return hash_pieces(np.frombuffer("".join(pieces).encode(), np.uint8), starts)


def _looked_up(hashes: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Lengths from the table, and which pieces it lacks."""
    known, lengths = table
    if not len(known):
        return np.zeros(len(hashes), np.int64), np.arange(len(hashes))
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return lengths[at].astype(np.int64), np.flatnonzero(known[at] != hashes)


class Encoder:
    """The library's counts for one tokenizer, and lengths a worker has seen: sorted hashes with their lengths."""

    def __init__(self, path: str):
        # A task has one core; threads of the library's own would each keep memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.names = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.seen = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def encoded(self, texts: list[str]) -> list[int]:
        """Tokens of each text; the library's results are held for about ENCODED characters at a time."""
        found, start, size = [], 0, 0
        for end, text in enumerate(texts, 1):
            size += len(text)
            if size >= ENCODED or end == len(texts):
                own = self.tokenizer.encode_batch(texts[start:end], add_special_tokens=False)
                found += map(len, own)
                start, size = end, 0
        return found

    def named(self, column: pa.Array) -> np.ndarray:
        """Rows with an added token: such texts are encoded by the library as a whole."""
        found = np.zeros(len(column), bool)
        for name in self.names:
            found |= pc.match_substring(column, name).fill_null(False).to_numpy(zero_copy_only=False)
        return found

    def lengths(self, hashes: np.ndarray, spelled: Callable[[int], str]) -> np.ndarray:
        """Lengths of different pieces, by hash; `spelled` gives the text of one by its number here."""
        found, new = _looked_up(hashes, self.seen)
        if len(new):
            found[new] = self.encoded([spelled(i) for i in new.tolist()])
            if len(self.seen[0]) > CACHED:
                self.seen = np.zeros(0, np.uint64), np.zeros(0, np.int32)
            known, lengths = self.seen
            at = np.searchsorted(known, hashes[new])
            self.seen = np.insert(known, at, hashes[new]), np.insert(lengths, at, found[new])
        return found


def encoder_of(path: str) -> Encoder:
    """One for each tokenizer, kept while the Python worker lives, over its tasks."""
    encoders = _kept().setdefault("encoders", {})
    if path not in encoders:
        encoders[path] = Encoder(path)
    return encoders[path]


def _chunks(column: pa.Array) -> Iterator[tuple[range, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, bytes, starts, first, hashes) of the pieces of some texts at a time."""
    data, offsets = string_buffers(column)
    for rows in row_chunks(offsets, CHUNK):
        base = offsets[rows.start]
        text = data[base : offsets[rows.stop]]
        starts, first = cut_pieces(text, offsets[rows.start : rows.stop + 1] - base)
        yield rows, text, starts, first, hash_pieces(text, starts)


class Frequent:
    """Counts of pieces by hash, cut back to the most frequent ones when there are very many. Kept in arrays, as each
    worker of an executor has one: about 30 bytes a piece of usual length."""

    def __init__(self):
        self.waiting: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []
        self.waits = 0
        self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.spelled = pa.array([], pa.large_binary())

    def add(self, text: np.ndarray, starts: np.ndarray, hashes: np.ndarray) -> None:
        bounds = np.append(starts, len(text)).astype(np.int64)
        short = np.flatnonzero(np.diff(bounds) <= LONGEST)
        found, at, counts = np.unique(hashes[short], return_index=True, return_counts=True)
        buffers = [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(text))]
        spelled = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).take(pa.array(short[at]))
        self.waiting.append((found, counts, spelled))
        self.waits += len(found)
        if self.waits > COUNTED:
            self._settle()

    def _settle(self) -> None:
        hashes = np.concatenate([self.hashes, *[h for h, _, _ in self.waiting]])
        counts = np.concatenate([self.counts, *[c for _, c, _ in self.waiting]])
        spelled = pa.chunked_array([self.spelled, *[s for _, _, s in self.waiting]])
        self.waiting, self.waits = [], 0
        self.hashes, at, place = np.unique(hashes, return_index=True, return_inverse=True)
        self.counts = np.bincount(place, counts, len(self.hashes)).astype(np.int64)
        if len(self.hashes) > COUNTED:
            kept = np.sort(np.argsort(-self.counts, kind="stable")[: PROPOSED * 8])
            self.hashes, self.counts, at = self.hashes[kept], self.counts[kept], at[kept]
        self.spelled = spelled.take(pa.array(at)).combine_chunks()

    def top(self, limit: int) -> tuple[list[str], list[int]]:
        self._settle()
        best = np.argsort(-self.counts, kind="stable")[:limit]
        return [piece.decode() for piece in self.spelled.take(pa.array(best)).to_pylist()], self.counts[best].tolist()


def _propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = Frequent()
    for batch in batches:
        for _, text, starts, _, hashes in _chunks(batch.column("text")):
            counts.add(text, starts, hashes)
    pieces, times = counts.top(PROPOSED)
    yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.string()), pa.array(times, pa.int64())], ["piece", "n"])


def frequent_lengths(texts: DataFrame, path: str, limit: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, token counts) of the most frequent pieces, by hash: a bounded table for speed only.

    Every task counts the pieces of all its texts and proposes its most frequent ones.
    """
    proposed = texts.select("text").mapInArrow(_propose, "piece string, n long")
    sums = proposed.groupBy("piece").agg(F.sum("n").alias("n"))
    pieces = [row[0] for row in sums.orderBy(F.desc("n"), "piece").limit(limit).select("piece").collect()]
    hashes, lengths = hash_spelled(pieces), np.array(encoder_of(path).encoded(pieces), np.int32)
    order = np.argsort(hashes)
    return hashes[order], lengths[order]


def count_column(column: pa.Array, encoder: Encoder, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Tokens of each text of a string column."""
    counts = np.zeros(len(column), np.int64)
    for rows, text, starts, first, hashes in _chunks(column):
        lengths, missing = _looked_up(hashes, table)
        if len(missing):
            ends, whole = np.append(starts[1:], len(text)), memoryview(text)
            new, at, place = np.unique(hashes[missing], return_index=True, return_inverse=True)
            at = missing[at].tolist()
            found = encoder.lengths(new, lambda i: str(whole[starts[at[i]] : ends[at[i]]], "utf-8"))
            lengths[missing] = found[place]
        sums = np.concatenate([[0], np.cumsum(lengths)])[first]
        counts[rows.start : rows.stop] = np.diff(sums)
    named = np.flatnonzero(encoder.named(column))
    if len(named):
        counts[named] = encoder.encoded(column.take(pa.array(named)).to_pylist())
    return counts


def _count(path: str, table) -> Callable:
    def scan(batches):
        encoder = encoder_of(path)
        for batch in batches:
            texts = batch.column("text")
            n_bytes = pc.binary_length(texts).fill_null(0).cast(pa.int64())
            n_tokens = pa.array(count_column(texts, encoder, table.value), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), n_bytes, n_tokens], ["doc_id", "n_bytes", "n_tokens"])

    return scan


def count_text_tokens(docs: DataFrame, path: str, frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) per row of `docs` (doc_id, text), exactly as the library counts, but for
    pieces whose 64-bit hashes collide.

    `path` is a byte-level BPE file of the `tokenizers` library without normaliser, which must be
    readable on every executor. No begin or end token is added; strings of the
    vocabulary's special tokens inside a text count as these tokens. A null text is empty: no bytes, no tokens. Repeated
    rows are counted each; other columns are ignored; an empty table gives no rows. Reads the texts twice,
    when called and when used.
    """
    texts = docs.select("doc_id", "text")
    kind = texts.schema["doc_id"].dataType.simpleString()
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(texts, path, frequent))
    return texts.mapInArrow(_count(path, table), f"doc_id {kind}, n_bytes long, n_tokens long")
