"""What the scans of the context trees hold in memory."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from turnmill.llm import context_tree


class Sent:
    """As a broadcast variable."""

    def __init__(self, value):
        self.value = value


def batch(texts: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string()), pa.array([False] * len(texts))],
        ["doc_id", "text", "held_out"],
    )


def long_texts() -> pa.RecordBatch:
    rng = random.Random(1)
    return batch([" ".join(f"w{rng.randrange(10**3)}" for _ in range(300)) for _ in range(4000)])


@pytest.fixture
def in_a_task(monkeypatch):
    import pyspark

    class Context:
        @staticmethod
        def get():
            return Context

        @staticmethod
        def partitionId():
            return 1

    monkeypatch.setattr(pyspark, "TaskContext", Context)


def model(texts: pa.RecordBatch) -> tuple[Sent, Sent]:
    """Half of the words of the texts and a tenth of their codes."""
    data, offsets = context_tree.string_buffers(texts.column("text"))
    codes = np.unique(context_tree._codes(context_tree._stream(data, offsets, range(200))[0]))[::10]
    words = [f"w{i}" for i in range(500)]
    return Sent(("\n".join(words), np.arange(500.0) % 7)), Sent((codes, np.full(len(codes), -0.5, np.float32)))


def peak(scan, texts: pa.RecordBatch) -> tuple[int, int]:
    """The most memory of Python and numpy, and the largest batch handed on."""
    tracemalloc.start()
    try:
        largest = max(found.nbytes for found in scan(iter([texts])))
        return tracemalloc.get_traced_memory()[1], largest
    finally:
        tracemalloc.stop()


def test_scoring_holds_few_codes_at_a_time(in_a_task):
    texts = long_texts()
    assert texts.nbytes > 5_000_000
    most, largest = peak(context_tree._score(*model(texts)), texts)
    assert most < 30_000_000
    assert largest < 8_000_000


def test_counting_holds_few_codes_at_a_time():
    most, largest = peak(context_tree._count_training(), long_texts())
    assert most < 90_000_000
    assert largest < 4_000_000


def test_table_of_codes_is_not_copied():
    codes = np.random.default_rng(2).permutation(np.arange(1 << 19) * 37)
    scores = np.arange(len(codes), dtype=np.float32)
    tracemalloc.start()
    try:
        table = context_tree.CodeTable(codes, scores)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 2 * codes.nbytes + 4_000_000
    found, missed = table.find(np.append(codes, codes[:100] + 1))
    assert (found[:-100] == scores).all() and (found[-100:] == 0).all()
    assert sorted(missed.tolist()) == list(range(len(codes), len(codes) + 100))


ODD = ["a b", None, "", "then other " * 9, "é😀 x", "B\nb", " ", "日本"] * 5


def test_counts_are_whole_however_often_they_are_handed_on(monkeypatch):
    def counts():
        tokens, codes = Counter(), Counter()
        for found in context_tree._count_training()(iter([batch(ODD), batch(ODD[:3])])):
            for token, code, n in zip(*(found[c].to_pylist() for c in ("token", "code", "n")), strict=True):
                (codes if token is None else tokens)[code if token is None else token] += n
        return tokens, codes

    tokens, codes = counts()
    texts = [t or "" for t in ODD + ODD[:3]]
    assert tokens == Counter(word for t in texts for word in t.lower().split())
    pad = bytes([context_tree.END]) * context_tree.DEPTH
    expected = Counter()
    for text in texts:
        stream = pad + text.encode() + pad[:1]
        for at in range(context_tree.DEPTH, len(stream)):
            expected[int.from_bytes(stream[at - context_tree.DEPTH : at][::-1] + stream[at : at + 1], "big")] += 1
    assert codes == expected
    for name, value in (("WAITING", 50), ("CHUNK_BYTES", 40), ("COUNTED_CODES", 100), ("COUNTED", 3), ("PART", 8)):
        monkeypatch.setattr(context_tree, name, value)
        assert counts() == (tokens, codes), name


def test_scores_are_the_same_however_few_rows_are_scored_at_a_time(in_a_task, monkeypatch):
    texts = batch(ODD)
    words, codes = model(long_texts())
    words = Sent(("a\nthen\nx", np.array([0.5, 0.25, 0.5])))

    def rows():
        found = pa.Table.from_batches(context_tree._score(words, codes)(iter([texts, texts])))
        return sorted(map(repr, zip(*(found[c].to_pylist() for c in found.column_names), strict=True)))

    whole = rows()
    assert sum(row.startswith("(None") for row in whole) > 100
    monkeypatch.setattr(context_tree, "CHUNK_BYTES", 40)
    monkeypatch.setattr(context_tree, "PART", 3)
    assert rows() == whole


def test_tokens_come_to_the_driver_without_a_row_each(spark):
    tokens = spark.range(200_000).selectExpr("concat('word', id) AS token", "id + 1 AS n")
    tokens.toArrow()
    tracemalloc.start()
    try:
        words, counts = context_tree.packed_tokens(tokens)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 8_000_000
    assert dict(zip(words.split("\n"), counts.tolist(), strict=True)) == {f"word{i}": i + 1 for i in range(200_000)}
    assert context_tree.packed_tokens(tokens.where("false"))[0] == ""
