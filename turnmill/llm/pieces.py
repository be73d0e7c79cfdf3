"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

The trie is built over UTF-8 bytes, with the piece marker U+2581 as a space, and walked for
all starting places of many words at once with numpy; so is the search for the best path.
"""

import re
from collections.abc import Callable, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MARKER = "▁"
# An unknown character scores this much less than the worst piece.
UNKNOWN_PENALTY = 10.0
# Words encoded at once, and most words a worker's cache holds.
WORDS_AT_ONCE = 20_000
CACHED = 400_000


class Piece(NamedTuple):
    text: str
    score: float
    kind: str  # normal, byte, unknown or control


def read_pieces(path: str) -> list[Piece]:
    """Pieces of a model file, in id order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def kind(i: int) -> str:
        if model.is_byte(i):
            return "byte"
        return "unknown" if model.is_unknown(i) else "control" if model.is_control(i) or model.is_unused(i) else "normal"

    return [Piece(model.id_to_piece(i), model.get_score(i), kind(i)) for i in range(model.get_piece_size())]


class Trie(NamedTuple):
    """Double array: the child of state s by byte c is base[s] + c if check of that is s."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray
    depth: int


def build_trie(keys: Sequence[bytes], values: Sequence[int]) -> Trie:
    children: list[dict[int, int]] = [{}]
    ends: dict[int, int] = {}
    for key, value in zip(keys, values, strict=True):
        node = 0
        for byte in key:
            if byte not in children[node]:
                children[node][byte] = len(children)
                children.append({})
            node = children[node][byte]
        ends[node] = value
    size = 2 * len(children) + 512
    base, check, value = [0] * size, [-1] * size, [-1] * size
    check[0] = 0
    state_of, free = {0: 0}, 1
    queue = [0]
    for node in queue:
        own = sorted(children[node])
        if not own:
            continue
        slot, tries = max(free, own[0] + 1), 0
        while True:
            if slot + 256 >= len(check):
                base += [0] * size
                check += [-1] * size
                value += [-1] * size
            start = slot - own[0]
            if all(check[start + byte] < 0 for byte in own):
                break
            slot += 1
            tries += 1
        # What was tried often in vain is left as it is.
        if tries > 16:
            free = slot - 8
        state = state_of[node]
        base[state] = start
        for byte in own:
            child = children[node][byte]
            check[start + byte] = state
            state_of[child] = start + byte
            value[start + byte] = ends.get(child, -1)
            queue.append(child)
    return Trie(
        np.array(base, np.int32), np.array(check, np.int32), np.array(value, np.int32), max(map(len, keys), default=0)
    )


class Model(NamedTuple):
    trie: Trie
    scores: np.ndarray
    # Id of each byte's piece, and what each id stands for in a text.
    byte_ids: np.ndarray
    shown: list[bytes]
    unknown_score: float
    words: str
    # No piece has a space after something else.
    at_spaces: bool


def build_model(pieces: Sequence[Piece]) -> Model:
    """Needs a piece for each of the 256 bytes. Among equal pieces the first one counts."""
    normal: dict[bytes, int] = {}
    byte_ids = np.full(256, -1, np.int32)
    shown = []
    for i, piece in enumerate(pieces):
        text = piece.text.replace(MARKER, " ").encode()
        if piece.kind == "normal" and text:
            normal.setdefault(text, i)
        elif piece.kind == "byte":
            value = int(piece.text[3:5], 16)
            byte_ids[value] = i
            text = bytes([value])
        else:
            text = b""
        shown.append(text)
    if (byte_ids < 0).any():
        raise ValueError("the model has no piece for some byte")
    scores = np.array([piece.score for piece in pieces], np.float64)
    worst = min((pieces[i].score for i in normal.values()), default=0.0)
    trie = build_trie(list(normal), list(normal.values()))
    at_spaces = not any(re.search(rb"[^ ] ", key) for key in normal)
    return Model(trie, scores, byte_ids, shown, worst - UNKNOWN_PENALTY, _word_pattern(normal, at_spaces), at_spaces)


def _word_pattern(normal: dict[bytes, int], at_spaces: bool) -> str:
    """Words that no piece reaches across: cut before a space that follows something else, and around
    ASCII characters that are in no longer piece. A cut that some piece crosses is not made."""
    inside = {byte for key in normal if len(key) > 1 for byte in key}
    alone = re.escape("".join(chr(b) for b in range(128) if b not in inside and b != 0x20))
    single = f"[{alone}]|" if alone else ""
    if not at_spaces:
        return rf"{single}[^{alone}]+" if alone else r"(?s).+"
    return rf"{single} +[^ {alone}]*|[^ {alone}]+"


def encode_words(model: Model, words: Sequence[bytes]) -> list[bytes]:
    """Ids of each word's best pieces, as little-endian 32-bit numbers.

    The best path has the largest sum of scores; of equal ones, the one whose last piece starts
    first, and so on backwards. A character without a piece of its own may also be
    taken as unknown, and then comes as its bytes.
    """
    trie = model.trie
    sizes = np.array([len(word) for word in words], np.int64)
    data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
    word_of = np.repeat(np.arange(len(words)), sizes)
    first = np.cumsum(sizes) - sizes
    # A word of n bytes has n + 1 places; place p of the data is place p + its word's number.
    place = np.arange(len(data)) + word_of
    relative = np.arange(len(data)) - first[word_of]
    left = sizes[word_of] - relative
    begins = np.flatnonzero((data & 0xC0) != 0x80)

    at, state, found = begins, np.zeros(len(begins), np.int64), []
    for depth in range(trie.depth):
        inside = left[at] > depth
        at, state = at[inside], state[inside]
        following = trie.base[state] + data[at + depth]
        valid = trie.check[following] == state
        at, state = at[valid], following[valid].astype(np.int64)
        ids = trie.value[state]
        hit = ids >= 0
        found.append((at[hit], np.full(int(hit.sum()), depth + 1), ids[hit].astype(np.int64)))
        if not len(at):
            break
    starts = np.concatenate([f[0] for f in found] or [np.zeros(0, np.int64)])
    lengths = np.concatenate([f[1] for f in found] or [np.zeros(0, np.int64)])
    ids = np.concatenate([f[2] for f in found] or [np.zeros(0, np.int64)])

    width = np.diff(np.append(begins, len(data)))
    known = np.zeros(len(data), bool)
    char_width = np.zeros(len(data), np.int64)
    char_width[begins] = width
    known[starts[lengths == char_width[starts]]] = True
    unknown = begins[~known[begins]]
    starts = np.concatenate([starts, unknown])
    lengths = np.concatenate([lengths, char_width[unknown]])
    ids = np.concatenate([ids, np.full(len(unknown), -1)])
    gains = np.where(ids >= 0, model.scores[ids], model.unknown_score)

    # Pieces from the same distance into their words end at different places, so they can be
    # weighed at once.
    order = np.argsort(relative[starts], kind="stable")
    starts, lengths, ids, gains = starts[order], lengths[order], ids[order], gains[order]
    bounds = np.searchsorted(relative[starts], np.arange(int(sizes.max(initial=0)) + 1))
    source = place[starts]
    target = source + lengths
    best = np.full(len(data) + len(words), -np.inf)
    best[first + np.arange(len(words))] = 0.0
    back = np.full(len(best), -1, np.int64)
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        reached = best[source[low:high]] + gains[low:high]
        better = reached > best[target[low:high]]
        best[target[low:high][better]] = reached[better]
        back[target[low:high][better]] = np.arange(low, high)[better]

    ends = first + sizes + np.arange(len(words))
    current, who, taken = ends, np.arange(len(words)), []
    while True:
        edge = back[current]
        going = edge >= 0
        if not going.any():
            break
        edge, who = edge[going], who[going]
        taken.append((who, edge))
        current = source[edge]
    who = np.concatenate([t[0] for t in reversed(taken)] or [np.zeros(0, np.int64)])
    edge = np.concatenate([t[1] for t in reversed(taken)] or [np.zeros(0, np.int64)])
    # Steps back were taken together, so a stable sort by word restores each word's order.
    order = np.argsort(who, kind="stable")
    who, edge = who[order], edge[order]
    repeats = np.where(ids[edge] >= 0, 1, lengths[edge])
    within = np.arange(int(repeats.sum())) - np.repeat(np.cumsum(repeats) - repeats, repeats)
    every = np.repeat(edge, repeats)
    as_bytes = model.byte_ids[data[np.minimum(starts[every] + within, max(len(data) - 1, 0))]] if len(every) else []
    flat = np.where(ids[every] >= 0, ids[every], as_bytes).astype("<i4")
    counts = np.bincount(np.repeat(who, repeats), minlength=len(words))
    bytes_of = flat.tobytes()
    stops = np.cumsum(counts) * 4
    return [bytes_of[stop - 4 * count : stop] for stop, count in zip(stops.tolist(), counts.tolist(), strict=True)]


class Encoder:
    """Encodes texts in batches, keeping the words it has met."""

    def __init__(self, model: Model):
        self.model = model
        self.find = re.compile(model.words, re.S).findall
        # Words by what stands after the space in front of them, and words as they are.
        self.spaced: dict[str, bytes] = {}
        self.plain: dict[str, bytes] = {}

    def _ids(self, texts: list[list[str]], known: dict[str, bytes], front: str) -> list[bytes]:
        if len(known) > CACHED:
            known.clear()
        new = list({word for words in texts for word in words if word not in known})
        for low in range(0, len(new), WORDS_AT_ONCE):
            some = new[low : low + WORDS_AT_ONCE]
            ids = encode_words(self.model, [(front + word).encode() for word in some])
            known.update(zip(some, ids, strict=True))
        return [b"".join(map(known.__getitem__, words)) for words in texts]

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text, as little-endian 32-bit numbers. A text that is not empty gets a
        space in front. Where single spaces are all that has to be cut at, no pattern is needed."""
        encoded = []
        for start in range(0, len(texts), 512):
            some = texts[start : start + 512]
            simple = [
                bool(text) and self.model.at_spaces and text[0] != " " and "  " not in text for text in some
            ]
            cut = [text.split(" ") for text, own in zip(some, simple, strict=True) if own]
            found = [self.find(" " + text) if text else [] for text, own in zip(some, simple, strict=True) if not own]
            ids = {True: iter(self._ids(cut, self.spaced, " ")), False: iter(self._ids(found, self.plain, ""))}
            encoded += [next(ids[own]) for own in simple]
        return encoded


def decode(model: Model, ids: bytes) -> str:
    """The text of ids: pieces with spaces for markers, bytes put together, without the first space."""
    data = b"".join(map(model.shown.__getitem__, np.frombuffer(ids, "<i4").tolist()))
    return data.decode("utf-8", "replace").removeprefix(" ")


def _sent(df: DataFrame, pieces: Sequence[Piece]):
    """The model as a broadcast of plain tuples, which workers can read without this package."""
    model = build_model(pieces)
    return df.sparkSession.sparkContext.broadcast((tuple(model.trie), *model[1:]))


def _received(sent) -> Model:
    trie, *rest = sent.value
    return Model(Trie(*trie), *rest)


def _encode(model, keep: list[str]) -> Callable:
    def scan(batches):
        encoder = Encoder(_received(model))
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            ids = encoder.encode(texts)
            lists = pa.ListArray.from_arrays(
                np.concatenate([[0], np.cumsum([len(own) // 4 for own in ids])]).astype(np.int32),
                pa.array(np.frombuffer(b"".join(ids), "<i4")),
            )
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], lists], [*keep, "piece_ids"])

    return scan


def _decode(model, keep: list[str]) -> Callable:
    def scan(batches):
        own_model = _received(model)
        for batch in batches:
            texts = [
                decode(own_model, np.array(ids, "<i4").tobytes()) if ids is not None else None
                for ids in batch.column("piece_ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(texts, pa.string())], [*keep, "text"]
            )

    return scan


def encode_pieces(docs: DataFrame, pieces: Sequence[Piece], keep: Sequence[str] | None = None) -> DataFrame:
    """`docs` (text, ...) with `piece_ids`, the ids of the best segmentation of the whole text.

    Spaces become markers and one marker is put in front, as SentencePiece does; nothing else is
    normalised, so decoding gives every text back. A marker that stands in a text itself comes as
    bytes. A null or empty text has no ids. `keep` lists the columns that stay (all by default).
    """
    if "piece_ids" in docs.columns:
        raise ValueError("docs has a column named piece_ids")
    keep = docs.columns if keep is None else list(keep)
    model = _sent(docs, pieces)
    fields = {field.name: field for field in docs.schema.fields}
    ids = T.StructField("piece_ids", T.ArrayType(T.IntegerType(), False))
    return docs.mapInArrow(_encode(model, keep), T.StructType([*[fields[c] for c in keep], ids]))


def decode_pieces(encoded: DataFrame, pieces: Sequence[Piece], keep: Sequence[str] | None = None) -> DataFrame:
    """`encoded` with `text` decoded from `piece_ids`; null ids give a null text. A `text` that is
    there is replaced; control and unknown ids stand for nothing."""
    keep = [c for c in encoded.columns if c != "text"] if keep is None else list(keep)
    model = _sent(encoded, pieces)
    fields = {field.name: field for field in encoded.schema.fields}
    schema = T.StructType([*[fields[c] for c in keep], T.StructField("text", T.StringType())])
    return encoded.mapInArrow(_decode(model, keep), schema)


DIGEST = "doc_id {id}, n_pieces long, n_byte_pieces long, ids_sha256 string, round_trip boolean"


def _digest(model) -> Callable:
    import hashlib

    def scan(batches):
        own_model = _received(model)
        encoder = Encoder(own_model)
        is_byte = np.zeros(len(own_model.shown), bool)
        is_byte[own_model.byte_ids] = True
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            ids = encoder.encode(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(own) // 4 for own in ids], pa.int64()),
                    pa.array([int(is_byte[np.frombuffer(own, "<i4")].sum()) for own in ids], pa.int64()),
                    pa.array([hashlib.sha256(own).hexdigest() for own in ids]),
                    pa.array([decode(own_model, own) == text for own, text in zip(ids, texts, strict=True)]),
                ],
                ["doc_id", "n_pieces", "n_byte_pieces", "ids_sha256", "round_trip"],
            )

    return scan


def piece_digests(docs: DataFrame, pieces: Sequence[Piece]) -> DataFrame:
    """Per row of `docs` (doc_id, text): piece counts, SHA-256 of the ids as little-endian 32-bit numbers, and
    whether decoding gives the text back. The ids themselves do not leave the worker."""
    model = _sent(docs, pieces)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_digest(model), DIGEST.format(id=kind))
