"""LM scoring by context-tree weighting over binary-decomposed bytes.

A byte is eight binary decisions. Each decision has a context tree of its own over the DEPTH bytes
before it, newest first: a node for every context of 0 to DEPTH bytes that training has, each with an
estimate of its own, mixed by their weights after training. Below the deepest node that training has, there is nothing to mix:
that node's estimate takes the rest. A text is its bytes and one end mark, 0xFF, which UTF-8 does not
have; DEPTH end marks stand before it. The model is then a distribution over whole texts.

Training counts (DEPTH + 1)-byte sequences of all training texts, as numbers ("codes"): context bytes, newest first, then
the byte. Sequences with the same two newest bytes are a subtree; subtrees are fitted apart, in groups of
BUCKETS, and meet in the trees' two top levels, of at most 2^16 nodes. Scores of frequent codes are
looked up in a broadcast table of bounded size; the others, and codes that training lacks, are scored in their subtrees and
joined. Both have the same scores.
"""

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnmill.checkpoints import store
from turnmill.llm.words import row_chunks, string_buffers

END = 0xFF
# Bytes of context; a code has one byte more and fits 56 bits.
DEPTH = 5
# Full contexts of two bytes, by bits.
CONTEXTS = 1 << 16
# Levels above the subtrees.
TOP = 2
# Groups of subtrees; one subtree is always in one of them.
BUCKETS = 512
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# Most tokens of the table that is broadcast: some 60 MB in a worker.
MAX_FREQUENT = 500_000
# Most codes of the table that is broadcast: 24 MB, and 50 MB in a worker.
MAX_CODES = 1 << 21
# A task hands on its token counts when it has this many.
COUNTED = 400_000
# The same for its counts of codes.
COUNTED_CODES = 1 << 21
# So many codes wait to be counted together: 16 MB.
WAITING = 1 << 21
# About so much text is made codes at a time, and so many codes get their place in a table or are handed on at a time: a
# worker holds little more than its tables and the batch it was sent.
CHUNK_BYTES = 250_000
PART = 1 << 16


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 7, is 2; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def _stream(data: np.ndarray, offsets: np.ndarray, rows: range) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of some texts with DEPTH end marks before each and as many at the end, and the
    place of each text's first byte; the last entry is one past the last marks."""
    base = int(offsets[rows.start])
    own = offsets[rows.start : rows.stop + 1] - base
    starts = own + DEPTH * np.arange(1, len(own) + 1)
    stream = np.full(int(own[-1]) + DEPTH * len(own), END, np.uint8)
    text = data[base : base + int(own[-1])]
    row_of = np.repeat(np.arange(len(own) - 1), np.diff(own))
    stream[np.arange(len(text)) + DEPTH * (row_of + 1)] = text
    return stream, starts


def _codes(stream: np.ndarray) -> np.ndarray:
    """For each byte from place DEPTH on: the bytes before it, newest first, and the byte."""
    wide = stream.astype(np.int64)
    count = len(stream) - DEPTH
    codes = wide[DEPTH:].copy()
    for back in range(1, DEPTH + 1):
        codes |= wide[DEPTH - back : DEPTH - back + count] << (8 * (DEPTH + 1 - back))
    return codes


def _unscored(starts: np.ndarray) -> np.ndarray:
    """Codes of end marks that are not part of any text: all but the first after it."""
    return (starts[1:, None] - np.arange(DEPTH + 1, 2 * DEPTH)).ravel()


class CodeCounts:
    """Counts of codes. Codes wait in a buffer and are counted when it is full."""

    def __init__(self):
        self.waiting = np.empty(WAITING, np.int64)
        self.filled = 0
        # Different codes, sorted, and their counts.
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, codes: np.ndarray) -> None:
        while len(codes):
            room = len(self.waiting) - self.filled
            own, codes = codes[:room], codes[room:]
            self.waiting[self.filled : self.filled + len(own)] = own
            self.filled += len(own)
            if self.filled == len(self.waiting):
                self._count()

    def _count(self) -> None:
        codes = self.waiting[: self.filled]
        codes.sort()
        first = np.flatnonzero(codes[1:] != codes[:-1]) + 1
        first = np.concatenate([np.zeros(min(1, self.filled), np.int64), first])
        self.parts.append((codes[first], np.diff(first, append=self.filled)))
        self.size += len(first)
        self.filled = 0

    def taken(self) -> Iterator[pa.RecordBatch]:
        """All counts as COUNTS rows; none are left. Parts are merged a range of codes at a time."""
        self._count()
        parts, self.parts, self.size = self.parts, [], 0
        longest = max((codes for codes, _ in parts), key=len)
        step = max(1, PART // len(parts))
        starts = [0] * len(parts)
        for end in [*longest[step::step].tolist(), None]:
            stops = [len(codes) if end is None else int(np.searchsorted(codes, end)) for codes, _ in parts]
            spans = list(zip(parts, starts, stops, strict=True))
            starts = stops
            codes = np.concatenate([codes[a:b] for (codes, _), a, b in spans])
            counts = np.concatenate([counts[a:b] for (_, counts), a, b in spans])
            if not len(codes):
                continue
            order = np.argsort(codes)
            codes, counts = codes[order], counts[order]
            first = np.flatnonzero(np.diff(codes, prepend=-1))
            codes, counts = codes[first], np.add.reduceat(counts, first)
            for at in range(0, len(codes), PART):
                own = slice(at, at + PART)
                names = pa.nulls(len(codes[own]), pa.string())
                yield pa.RecordBatch.from_arrays([names, pa.array(codes[own]), pa.array(counts[own])], ["token", "code", "n"])


COUNTS = "token string, code long, n long"


def _count_training() -> Callable:
    def counted(tokens: Counter):
        items = iter(tokens.items())
        while part := list(islice(items, PART)):
            names, counts = zip(*part, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.nulls(len(part), pa.int64()), pa.array(counts, pa.int64())],
                ["token", "code", "n"],
            )

    def scan(batches):
        tokens, counts = Counter(), CodeCounts()
        for batch in batches:
            column = batch.column("text")
            data, offsets = string_buffers(column)
            for rows in row_chunks(offsets, CHUNK_BYTES):
                for text in column.slice(rows.start, len(rows)).to_pylist():
                    if text:
                        tokens.update(WORD.findall(text.translate(LOWER) if not text.isascii() else text.lower()))
                    if len(tokens) > COUNTED:
                        yield from counted(tokens)
                        tokens = Counter()
                stream, starts = _stream(data, offsets, rows)
                counts.add(np.delete(_codes(stream), _unscored(starts)))
                if counts.size > COUNTED_CODES:
                    yield from counts.taken()
        yield from counted(tokens)
        yield from counts.taken()

    return scan


def _log_gamma(x: np.ndarray) -> np.ndarray:
    shift = np.zeros_like(x)
    for step in range(8):
        shift += np.log(x + step)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) - shift


def _log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability that a KT estimator gives to so many zeros and ones, in any order."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - math.log(math.pi)


class Level(NamedTuple):
    """Nodes of one depth by ascending key: context bytes, newest first, then the decision in one byte.

    Decision 1 is a byte's first bit; decision d is followed by 2d or 2d + 1.
    """

    keys: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    # Log probability of the training data, weighted over the depths from here on.
    weighted: np.ndarray
    # The share of a node's own estimate in that.
    own: np.ndarray

    def chance(self) -> np.ndarray:
        """P(1) by the nodes' own estimates."""
        return (self.ones + 0.5) / (self.zeros + self.ones + 1)


def leaves(codes: np.ndarray, counts: np.ndarray) -> Level:
    """The deepest level, from different codes and their counts."""
    keys, ones = [], []
    for bit in range(8):
        keys.append((codes >> 8 << 8) | (1 << bit) | ((codes & 255) >> (8 - bit)))
        ones.append((codes >> (7 - bit)) & 1)
    keys, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(place, np.tile(counts, 8), len(keys))
    one = np.bincount(place, np.tile(counts, 8) * np.concatenate(ones), len(keys))
    return Level(keys, total - one, one, _log_kt(total - one, one), np.ones(len(keys)))


def parents(keys: np.ndarray) -> np.ndarray:
    """Keys of the nodes one byte less deep."""
    return (keys >> 16 << 8) | (keys & 255)


def level_above(keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, weighted: np.ndarray) -> Level:
    """The level above these nodes. A node's weight for its own estimate, against its children's, is its
    share of the weighted probability of the training data."""
    keys, place = np.unique(parents(keys), return_inverse=True)
    zeros, ones = np.bincount(place, zeros, len(keys)), np.bincount(place, ones, len(keys))
    own = _log_kt(zeros, ones) - math.log(2)
    both = np.logaddexp(own, np.bincount(place, weighted, len(keys)) - math.log(2))
    return Level(keys, zeros, ones, both, np.exp(own - both))


def subtree_levels(codes: np.ndarray, counts: np.ndarray) -> list[Level]:
    """Levels of depth TOP to DEPTH."""
    levels = [leaves(codes, counts)]
    for _ in range(DEPTH - TOP):
        below = levels[0]
        levels.insert(0, level_above(below.keys, below.zeros, below.ones, below.weighted))
    return levels


class Mixed(NamedTuple):
    """Nodes of one depth: P(1) where they are the deepest of a path, and what goes on to those below:
    what is already mixed, and the weight that is left."""

    keys: np.ndarray
    chance: np.ndarray
    mixed: np.ndarray
    left: np.ndarray


def mix_down(levels: list[Level], above: Mixed | None = None) -> list[Mixed]:
    """From the topmost level on; `above` has the parents of its nodes."""
    found = []
    for level in levels:
        mixed, left = np.zeros(len(level.keys)), np.ones(len(level.keys))
        if above is not None:
            at = np.searchsorted(above.keys, parents(level.keys))
            mixed, left = above.mixed[at], above.left[at]
        chance = level.chance()
        own = left * level.own
        above = Mixed(level.keys, mixed + left * chance, mixed + own * chance, left - own)
        found.append(above)
    return found


def code_scores(codes: np.ndarray, levels: list[Mixed]) -> np.ndarray:
    """log10 P(byte | DEPTH bytes before) of codes, from levels of depth 0 to DEPTH."""
    total = np.zeros(len(codes))
    for bit in range(8):
        decision = (1 << bit) | ((codes & 255) >> (8 - bit))
        # A decision that never came up is even.
        chance, open_ = np.full(len(codes), 0.5), np.arange(len(codes))
        for depth in range(DEPTH, -1, -1):
            level = levels[depth]
            if not len(level.keys) or not len(open_):
                continue
            keys = (codes[open_] >> (8 * (DEPTH + 1 - depth)) << 8) | decision[open_]
            at = np.minimum(np.searchsorted(level.keys, keys), len(level.keys) - 1)
            hit = level.keys[at] == keys
            chance[open_[hit]] = level.chance[at[hit]]
            open_ = open_[~hit]
        total += np.log10(np.where((codes >> (7 - bit)) & 1, chance, 1 - chance))
    return total


def bucket_of(code: str = "code") -> Column:
    """The group of subtrees that has a code."""
    return F.pmod(F.xxhash64(F.shiftright(code, 8 * (DEPTH + 1 - TOP))), F.lit(BUCKETS)).alias("bucket")


def _subtree_tops(pdf: pd.DataFrame) -> pd.DataFrame:
    top = subtree_levels(pdf["code"].to_numpy(), pdf["n"].to_numpy())[0]
    # What the level above needs of them, added up by its nodes.
    frame = pd.DataFrame({"key": parents(top.keys), "zeros": top.zeros, "ones": top.ones, "weighted": top.weighted})
    return frame.groupby("key", as_index=False).sum()


def fit_top(codes: DataFrame) -> list[Mixed]:
    """Levels 0 and 1 of all trees, from counts (code, n): at most 2^16 nodes."""
    tops = codes.groupBy(bucket_of()).applyInPandas(_subtree_tops, "key long, zeros double, ones double, weighted double")
    sums = tops.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "weighted")]).toPandas()
    sums = sums.sort_values("key")
    # The sums are of children already, so each is a single child of its node here.
    one = level_above(sums["key"].to_numpy(np.int64) >> 8 << 16 | sums["key"].to_numpy(np.int64) & 255,
                      *[sums[c].to_numpy(float) for c in ("zeros", "ones", "weighted")])
    return mix_down([level_above(one.keys, one.zeros, one.ones, one.weighted), one])


def _all_levels(codes: np.ndarray, counts: np.ndarray, top: list[Mixed]) -> list[Mixed]:
    return [*top, *mix_down(subtree_levels(codes, counts), top[-1])]


def trained_scores(codes: DataFrame, top, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes with a count of at least `least` and their scores to 24 bits, from counts (code, n). They come to the
    driver as one row of bytes a group."""

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        own, counts = pdf["code"].to_numpy(), pdf["n"].to_numpy()
        asked = own[counts >= least]
        scores = code_scores(asked, _all_levels(own, counts, top.value)).astype(np.float32)
        return pd.DataFrame({"codes": [asked.tobytes()], "scores": [scores.tobytes()]})

    rows = codes.groupBy(bucket_of()).applyInPandas(score, "codes binary, scores binary").collect()
    return tuple(
        np.frombuffer(b"".join(row[name] for row in rows), kind)
        for name, kind in (("codes", np.int64), ("scores", np.float32))
    )


SCORES = "code long, score double"


def asked_scores(codes: DataFrame, asked: DataFrame, top) -> DataFrame:
    """SCORES rows of different codes (code), which training may lack, from counts (code, n)."""

    def score(counted: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        own = wanted["code"].to_numpy(np.int64)
        if not len(own):
            return pd.DataFrame({"code": own, "score": np.zeros(0)})
        levels = _all_levels(counted["code"].to_numpy(np.int64), counted["n"].to_numpy(np.int64), top.value)
        return pd.DataFrame({"code": own, "score": code_scores(own, levels)})

    return codes.groupBy(bucket_of()).cogroup(asked.groupBy(bucket_of())).applyInPandas(score, SCORES)


class CodeTable:
    """Scores by code: open addressing, for very many look-ups at a time. A slot has a place in the arrays given, which
    are not copied, or -1."""

    def __init__(self, codes: np.ndarray, scores: np.ndarray):
        self.bits = max(4, int(2 * len(codes)).bit_length())
        self.codes, self.scores = codes, scores
        self.places = np.full(1 << self.bits, -1, np.int32)
        for start in range(0, len(codes), PART):
            waiting = np.arange(start, min(start + PART, len(codes)))
            slots = self._slots(codes[waiting])
            while len(waiting):
                free = self.places[slots] < 0
                self.places[slots[free]] = waiting[free]
                left = self.places[slots] != waiting
                waiting, slots = waiting[left], (slots[left] + 1) & ((1 << self.bits) - 1)

    def _slots(self, codes: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The scores of codes, 0 where the table has none, and which these are."""
        if not len(self.codes):
            return np.zeros(len(codes)), np.arange(len(codes))
        slots = self._slots(codes)
        places = self.places[slots]
        scores = self.scores[places].astype(float)
        # A place of -1 reads the last entry; a code that meets it there is another, or it would have been met before.
        missed, waiting = [], np.flatnonzero(self.codes[places] != codes)
        places = places[waiting]
        scores[waiting] = 0.0
        while len(waiting):
            missed.append(waiting[places < 0])
            waiting = waiting[places >= 0]
            slots[waiting] = (slots[waiting] + 1) & ((1 << self.bits) - 1)
            places = self.places[slots[waiting]]
            hit = self.codes[places] == codes[waiting]
            scores[waiting[hit]] = self.scores[places[hit]]
            waiting, places = waiting[~hit], places[~hit]
        return scores, np.concatenate([np.zeros(0, np.int64), *missed])


def weighted_ones(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """P(1) in each full context, mixed over the depths, from counts by full context.

    `zeros` and `ones` have a power of two entries; the context's bits are those of the index,
    first the highest. A node's weight for its own estimate, against its children's, is its
    share of the weighted probability of the training data.
    """
    levels = [(zeros.astype(float), ones.astype(float))]
    while len(levels[-1][0]) > 1:
        a, b = levels[-1]
        levels.append((a[0::2] + a[1::2], b[0::2] + b[1::2]))
    a, b = levels[0]
    weighted = _log_kt(a, b)
    mixing = []
    for a, b in levels[1:]:
        own, below = _log_kt(a, b), weighted[0::2] + weighted[1::2]
        weighted = np.logaddexp(own, below) - math.log(2)
        mixing.append(np.exp(own - math.log(2) - weighted))
    a, b = levels[0]
    chance = (b + 0.5) / (a + b + 1)
    total = np.zeros(len(chance))
    left = np.ones(len(chance))
    for depth in range(len(levels) - 1, 0, -1):
        a, b = levels[depth]
        repeat = 1 << depth
        weight = np.repeat(mixing[depth - 1], repeat)
        total += left * weight * np.repeat((b + 0.5) / (a + b + 1), repeat)
        left *= 1 - weight
    return total + left * chance


def byte_scores(model: dict[int, bytes]) -> np.ndarray:
    """log10 P(byte | two bytes before) as an array [context * 256 + byte], from P(1) in each context by
    decision, compressed: 64 MB. For models of `weighted_ones` of two bytes; texts are scored with DEPTH bytes."""
    scores = np.zeros((CONTEXTS, 256), np.float32)
    for decision in range(1, 256):
        level = decision.bit_length() - 1
        width = 256 >> (level + 1)
        first = (decision << (8 - level)) & 0xFF
        # A decision that never came up is even.
        chance = np.full(CONTEXTS, 0.5)
        if decision in model:
            chance = np.frombuffer(zlib.decompress(model[decision]), np.float32).astype(float)
        scores[:, first : first + width] += np.log10(1 - chance).astype(np.float32)[:, None]
        scores[:, first + width : first + 2 * width] += np.log10(chance).astype(np.float32)[:, None]
    return scores.ravel()


def _score(frequent, known_codes) -> Callable:
    names = ["doc_id", "row", "held_out", "n_tokens", "n_known", "base", "score", "n_bytes", "token", "code", "n"]

    def scan(batches):
        from pyspark import TaskContext

        words, values = frequent.value
        # Tokens with the same count share their value.
        values, place = np.unique(values, return_inverse=True)
        known = dict(zip(words.split("\n") if words else [], map(values.tolist().__getitem__, place), strict=True))
        get, table = known.get, CodeTable(*known_codes.value)
        del words, place
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            kind = batch.column("doc_id").type

            def missing(rows, tokens, codes, counts, kind=kind):
                size = len(rows)
                none = [pa.nulls(size, t) for t in (pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64())]
                return pa.RecordBatch.from_arrays([pa.nulls(size, kind), rows, *none, tokens, codes, counts], names)

            column = batch.column("text")
            data, offsets = string_buffers(column)
            for rows in row_chunks(offsets, CHUNK_BYTES):
                size, first_row = len(rows), row + rows.start
                n_tokens, n_known, base = np.ones(size, np.int64), np.zeros(size, np.int64), np.zeros(size)
                missed_rows, missed_tokens, missed_counts = [], [], []
                for i, text in enumerate(column.slice(rows.start, size).to_pylist()):
                    if not text:
                        continue
                    own = WORD.findall(text.translate(LOWER) if not text.isascii() else text.lower())
                    found = list(map(get, own))
                    n_tokens[i] += len(own)
                    missed = Counter(word for word, value in zip(own, found, strict=True) if value is None)
                    base[i] = math.fsum(value for value in found if value is not None)
                    n_known[i] = len(own) - sum(missed.values())
                    missed_rows += [first_row + i] * len(missed)
                    missed_tokens += missed.keys()
                    missed_counts += missed.values()
                stream, starts = _stream(data, offsets, rows)
                codes = _codes(stream)
                gained, lacking = table.find(codes)
                unscored = _unscored(starts)
                gained[unscored] = 0.0
                first = starts[:-1] - DEPTH
                scores = np.add.reduceat(gained, first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(rows.start, size), pa.array(np.arange(first_row, first_row + size)),
                     batch.column("held_out").slice(rows.start, size),
                     pa.array(n_tokens), pa.array(n_known), pa.array(base), pa.array(scores),
                     pa.array(np.diff(offsets[rows.start : rows.stop + 1])),
                     *[pa.nulls(size, t) for t in (pa.string(), pa.int64(), pa.int64())]],
                    names,
                )
                lacking = np.setdiff1d(lacking, unscored)
                owners = first_row + np.searchsorted(first, lacking, "right") - 1
                for at in range(0, len(lacking), PART):
                    part = slice(at, at + PART)
                    asked = codes[lacking[part]]
                    yield missing(
                        pa.array(owners[part]), pa.nulls(len(asked), pa.string()), pa.array(asked),
                        pa.array(np.ones(len(asked), np.int64)),
                    )
                for at in range(0, len(missed_rows), PART):
                    part = slice(at, at + PART)
                    tokens = pa.array(missed_tokens[part], pa.string())
                    yield missing(
                        pa.array(missed_rows[part], pa.int64()), tokens,
                        pa.nulls(len(tokens), pa.int64()), pa.array(missed_counts[part], pa.int64()),
                    )
            row += len(column)

    return scan


def _frequent(tokens: DataFrame, limit: int) -> tuple[DataFrame, int]:
    """The rows (.., n) with the largest n, at most `limit` of them, and the least n of those."""
    steps = F.expr("CASE WHEN n < 1000 THEN n ELSE cast(exp(floor(ln(n) * 100) / 100) AS bigint) END")
    sizes = tokens.groupBy(steps.alias("least")).agg(F.count("*").alias("tokens")).orderBy(F.desc("least")).collect()
    taken, least = 0, None
    for row in sizes:
        taken += row["tokens"]
        if taken > limit:
            break
        least = row["least"]
    return tokens.where(steps >= least) if least is not None else tokens.where("false"), least


def packed_tokens(tokens: DataFrame) -> tuple[str, np.ndarray]:
    """The tokens, joined by line ends, and their counts. On the driver they are never objects of their own."""
    rows = tokens.select("token", "n").toArrow().combine_chunks()
    names = pa.concat_arrays([pa.array([], rows["token"].type), *rows["token"].chunks])
    words = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names), "\n")
    return words[0].as_py(), rows["n"].to_numpy()


def score_texts(
    docs: DataFrame, held_out: Column | None = None, max_frequent: int = MAX_FREQUENT, max_codes: int = MAX_CODES
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) per row
    of `docs` (doc_id, text), with what is learned from the rows that are not held out.

    score: log10 probability of the text's bytes under the weighted context trees, its end included.
    Base: A-Z lower-cased, tokens are words between ASCII white space and one end, and
    base_score sums log10((c + 1) / (N + V + 1)) over them, with c the token's training count, N all
    counts and V how many different ones there are; n_known counts tokens with c > 0. A null text
    is empty: one token, its end. Without training rows N and V are 0 and every decision is even. Repeated rows count
    each, and a null doc_id is an empty one. Other columns are ignored.

    Counts cover all training texts: each task hands on its own sums. Frequent tokens, and frequent codes of bytes in their
    contexts, are looked up in broadcast tables of at most `max_frequent` and `max_codes` rows; the others are joined.
    Scores of codes are the same either way, but for rounding to 24 bits in the table.
    """
    spark = docs.sparkSession
    held = is_held_out(F.col("doc_id")) if held_out is None else held_out
    texts = docs.select("doc_id", "text", F.coalesce(held, F.lit(False)).alias("held_out"))
    training = texts.where("NOT held_out")
    counted = training.select("text").mapInArrow(_count_training(), COUNTS)
    counts = store(counted.groupBy("token", "code").agg(F.sum("n").alias("n")))
    tokens = counts.where("token IS NOT NULL").select("token", "n")
    sums = tokens.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    # Every training text has one end.
    ends = counts.where(f"code & 255 = {END}").agg(F.sum("n")).first()[0] or 0
    total, different = (sums["n"] or 0) + ends, sums["v"] + (ends > 0)
    unit = math.log10(total + different + 1)

    table, least = _frequent(tokens, max_frequent)
    words, times = packed_tokens(table)
    sent = spark.sparkContext.broadcast((words, np.log10(times + 1.0) - unit))
    del words, times

    codes = counts.where("code IS NOT NULL").select("code", "n")
    top = spark.sparkContext.broadcast(fit_top(codes))
    _, least_code = _frequent(codes, max_codes)
    found = np.zeros(0, np.int64), np.zeros(0, np.float32)
    if least_code is not None:
        found = trained_scores(codes, top, least_code)
    table_codes = spark.sparkContext.broadcast(found)
    del found

    kind = texts.schema["doc_id"].dataType.simpleString()
    scored = store(
        texts.mapInArrow(
            _score(sent, table_codes),
            f"doc_id {kind}, row long, held_out boolean, n_tokens long, n_known long, base double, "
            "score double, n_bytes long, token string, code long, n long",
        )
    )
    missed = scored.where("token IS NOT NULL").select("row", "token", F.col("n").alias("times"))
    # A token that training never had may be missed very often; the join may split its rows.
    rare = tokens.join(table.select("token"), "token", "left_anti") if least is not None else tokens
    met = missed.join(rare, "token", "left")
    gained = F.col("times") * (F.log10(F.coalesce("n", F.lit(0)) + 1) - unit)
    more = met.groupBy("row").agg(
        F.sum(gained).alias("more_base"), F.sum(F.when(F.col("n") > 0, F.col("times"))).alias("more_known")
    )
    lacking = scored.where("code IS NOT NULL").select("row", "code")
    asked = store(asked_scores(codes, lacking.select("code").distinct(), top))
    more_score = lacking.join(asked, "code").groupBy("row").agg(F.sum("score").alias("more_score"))
    end_score = math.log10(ends + 1) - unit
    lines = scored.where("n_tokens IS NOT NULL").drop("token", "code", "n")
    lines = lines.join(more_score, "row", "left").withColumn("score", F.col("score") + F.coalesce("more_score", F.lit(0.0)))
    return lines.join(more, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0)) + int(ends > 0)).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0)) + end_score).alias("base_score"),
        "score",
        # Code length: the end counts as one more byte.
        (-F.col("score") * math.log2(10) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
