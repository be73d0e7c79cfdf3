"""Words and word shingles of whole texts as 64-bit hashes, many texts at once.

Works on the bytes of Arrow string columns with numpy: no Python object is made
per word. Rows are taken in chunks of about `CHUNK_BYTES`; a longer text makes a
chunk of its own, so memory is bounded by the longest text.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2_000_000

_MIX = np.uint64(0xBF58476D1CE4E5B9)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_S29, _S32 = np.uint64(29), np.uint64(32)


class Classes(NamedTuple):
    """Which bytes make words, and each byte's hash value after lower-casing A-Z."""

    is_word: np.ndarray
    values: np.ndarray


def byte_classes(separators: bytes) -> Classes:
    is_word = np.ones(256, bool)
    is_word[list(separators)] = False
    lowered = np.arange(256)
    lowered[65:91] += 32
    return Classes(is_word, mix((lowered + 1).astype(np.uint64) * _STEP))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    values = (values ^ (values >> _S32)) * _MIX
    values = (values ^ (values >> _S29)) * _STEP
    return values ^ (values >> _S32)


# Words separated by space and the controls 9 to 13.
SPACED = byte_classes(bytes([0x20, *range(0x09, 0x0E)]))
# Words of ASCII letters and digits and of non-ASCII characters.
ALPHANUMERIC = byte_classes(
    bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
)


def _powers(count: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(count, 0xD6E8FEB86659FD93, np.uint64))


_FIRST_POWERS = _powers(256)


def powers(count: int) -> np.ndarray:
    """At least `count` odd multipliers, one per place: powers of an odd number."""
    return _FIRST_POWERS if count <= len(_FIRST_POWERS) else _powers(count)


class Words(NamedTuple):
    """Words of a run of rows: word i of row r is at first[r] + i."""

    rows: range
    base: int
    hashes: np.ndarray
    first: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def of(self, row: int) -> slice:
        return slice(self.first[row - self.rows.start], self.first[row - self.rows.start + 1])


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), offsets
    return np.frombuffer(data, np.uint8), offsets


def row_chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[range]:
    """Runs of rows of about `size` bytes."""
    row, last = 0, len(offsets) - 1
    while row < last:
        end = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
        end = min(max(end, row + 1), last)
        yield range(row, end)
        row = end


def split_words(
    data: np.ndarray, offsets: np.ndarray, rows: range, classes: Classes, cuts: np.ndarray | None = None
) -> Words:
    """Words of some rows. `cuts`: sorted places, as offsets are, to use in their stead."""
    base = int(offsets[rows.start])
    text = data[base : int(offsets[rows.stop])]
    if cuts is None:
        cuts = offsets[rows.start : rows.stop + 1] - base
    keep = classes.is_word[text]
    before = np.empty_like(keep)
    before[:1] = False
    before[1:] = keep[:-1]
    before[cuts[cuts < len(text)]] = False
    starts = np.flatnonzero(keep & ~before)
    after = np.empty_like(keep)
    after[-1:] = False
    after[:-1] = keep[1:]
    after[cuts[cuts > 0] - 1] = False
    ends = np.flatnonzero(keep & ~after) + 1
    with np.errstate(over="ignore"):
        if len(starts):
            lengths = ends - starts
            at = np.cumsum(lengths) - lengths
            places = np.arange(int(lengths.sum())) - np.repeat(at, lengths)
            values = classes.values[text[keep]] * powers(int(lengths.max()))[places]
            hashes = mix(np.add.reduceat(values, at) + lengths.astype(np.uint64))
        else:
            hashes = np.zeros(0, np.uint64)
    return Words(rows, base, hashes, np.searchsorted(starts, cuts), starts, ends)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` words from each word on; the last ones that are too short are left out."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total = hashes[:count] * powers(size)[0]
        for place in range(1, size):
            total = total + hashes[place : place + count] * powers(size)[place]
        return mix(total + np.uint64(size))


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, bounds): the distinct shingles of each row of a run, sorted, end to end; a row of fewer words is one
    shingle, an empty one has none."""
    counts = np.diff(words.first)
    whole = counts >= size
    sizes = np.where(whole, counts - size + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    shingles = np.empty(bounds[-1], np.uint64)
    every = windows(words.hashes, size)
    inside = np.arange(size, len(every) + size) <= np.repeat(words.first[1:], counts)[: len(every)]
    of_whole = np.repeat(whole, sizes)
    shingles[of_whole] = every[inside]
    for row in np.flatnonzero(~whole & (counts > 0)).tolist():
        shingles[bounds[row]] = windows(words.hashes[words.first[row] : words.first[row + 1]], int(counts[row]))[0]
    for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        shingles[start:end].sort()
    fresh = np.ones(len(shingles), bool)
    fresh[1:] = shingles[1:] != shingles[:-1]
    fresh[bounds[:-1][sizes > 0]] = True
    return shingles[fresh], np.concatenate([[0], np.cumsum(fresh)])[bounds]


def set_ids(shingles: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """64-bit ids, signed, of sets that lie end to end and are not empty; equal sets have equal ids."""
    with np.errstate(over="ignore"):
        spread = mix(shingles ^ _STEP)
        total = np.add.reduceat(spread, bounds[:-1]) * _MIX + np.diff(bounds).astype(np.uint64)
        return mix(total ^ np.bitwise_xor.reduceat(mix(spread), bounds[:-1])).view(np.int64)


def pack_set(shingles: np.ndarray) -> bytes:
    """The set in 40 bits a shingle, sorted, to be compared with other sets."""
    short = np.sort(shingles >> np.uint64(24))
    return short.astype(np.uint32).tobytes() + (short >> _S32).astype(np.uint8).tobytes()


def unpack_set(packed: bytes) -> np.ndarray:
    size = len(packed) // 5
    low = np.frombuffer(packed, np.uint32, size).astype(np.uint64)
    return low | (np.frombuffer(packed, np.uint8, size, 4 * size).astype(np.uint64) << _S32)


def overlap(left: np.ndarray, right: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    both = np.concatenate([left, right])
    both.sort(kind="stable")
    return int(np.count_nonzero(both[1:] == both[:-1]))
