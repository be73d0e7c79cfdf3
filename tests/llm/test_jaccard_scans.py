"""What the scans of the Jaccard join hold in memory, and which texts they make sets of."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from turnmill.llm import jaccard_join, linking
from turnmill.llm.words import SPACED, shingle_sets, split_words, string_buffers

SIZE = 5


class Sent:
    """As a broadcast variable."""

    def __init__(self, value):
        self.value = value


def batch(texts: list) -> pa.RecordBatch:
    rows = pa.array(range(len(texts)), pa.int64())
    keys = pa.array([(i + 1) << 20 for i in range(len(texts))], pa.int64())
    return pa.RecordBatch.from_arrays([rows, pa.array(texts, pa.string()), keys], ["doc_id", "text", "key"])


def long_texts(rows: int = 4000, words: int = 300) -> pa.RecordBatch:
    rng = random.Random(1)
    return batch([" ".join(f"w{rng.randrange(10**6)}" for _ in range(words)) for _ in range(rows)])


def order() -> Sent:
    return Sent((np.array([3, 1 << 40], np.uint64), np.array([1, 2], np.int8)))


def everything() -> Sent:
    return Sent(b"\xff" * (linking.FILTER_BITS // 8))


@pytest.mark.parametrize(
    "scan",
    [
        lambda: jaccard_join._scan_documents(SIZE),
        lambda: jaccard_join._scan_entries(SIZE, order()),
        lambda: jaccard_join._scan_members(SIZE, everything()),
    ],
    ids=["documents", "entries", "members"],
)
def test_a_scan_holds_few_sets_at_a_time(scan):
    texts = long_texts()
    tracemalloc.start()
    try:
        largest = max(found.nbytes for found in scan()(iter([texts])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert texts.nbytes > 8_000_000
    assert peak < 45_000_000
    assert largest < 2_000_000


def test_shared_shingles_are_counted_over_all_runs_of_rows(monkeypatch):
    monkeypatch.setattr(jaccard_join, "CHUNK_BYTES", 40)
    texts = ["a b c d e f", "x", "A  B c d e", None, "", "x", "p q r s t u v", "a b c d e"]

    def shared():
        found = pa.Table.from_batches(jaccard_join._scan_documents(SIZE)(iter([batch(texts)])))
        tokens = [(t, n) for t, n in zip(found["token"].to_pylist(), found["count"].to_pylist(), strict=True) if t]
        rows = [r for r in zip(*(found[c].to_pylist() for c in ("doc_id", "n", "node", "key")), strict=True) if r[3]]
        return tokens, rows

    tokens, rows = shared()
    assert sorted(n for _, n in tokens) == [2, 3]
    assert [r[0] for r in rows] == list(range(8)) and [r[1] for r in rows] == [2, 1, 1, 0, 0, 1, 3, 1]
    assert [r[2] is None for r in rows] == [not t for t in texts] and rows[2][2] == rows[7][2] != rows[0][2]
    # Counted a few at a time, the same shingle comes up with parts of its sum.
    monkeypatch.setattr(jaccard_join, "COUNTED", 4)
    assert shared()[1] == rows


def test_sets_of_a_run_of_rows_are_those_of_each_row():
    rng = random.Random(2)
    texts = [None, "", " \t", "a", "A a", "a b c d e", "a a a a a a a a", "é É \x1c x", "z " * 3000]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 15))) for _ in range(300)]

    def sets(rows):
        data, offsets = string_buffers(pa.array(rows, pa.string()))
        shingles, bounds = shingle_sets(split_words(data, offsets, range(len(rows)), SPACED), SIZE)
        return [shingles[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    together = sets(texts)
    assert together == [sets([text])[0] for text in texts]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, found in zip(texts, together, strict=True):
        words = [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in (text or "").translate(lower)).split(" ") if w]
        assert found == sorted(set(found))
        assert len(found) == len({tuple(words[i : i + SIZE]) for i in range(max(1, len(words) - 4))} if words else ())


def test_sets_are_made_only_of_texts_that_may_be_asked_for(monkeypatch):
    texts = [" ".join(f"{name}{i}" for i in range(9)) for name in "abcdefgh"] + [None]
    made = batch(texts)
    bitmap = np.zeros(linking.FILTER_BITS // 64, np.int64)
    for row in (2, 5, 8):
        bitmap[(row + 1) >> 6] |= 1 << ((row + 1) & 63)
    split = []

    def counted(data, offsets, rows, classes):
        split.append(len(rows))
        return split_words(data, offsets, rows, classes)

    monkeypatch.setattr(jaccard_join, "split_words", counted)
    asked = pa.Table.from_batches(jaccard_join._scan_members(SIZE, Sent(bitmap.tobytes()))(iter([made])))
    assert sum(split) == 3
    every = pa.Table.from_batches(jaccard_join._scan_members(SIZE, everything())(iter([made])))
    assert asked.to_pylist() == [every.to_pylist()[row] for row in (2, 5)]


def test_many_hashes_meet_the_filter_as_single_ones_do():
    rng = np.random.default_rng(4)
    bitmap = rng.integers(-(2**63), 2**63 - 1, linking.FILTER_BITS // 64)
    nodes = rng.integers(-(2**63), 2**63 - 1, 500)
    assert linking.may_contain_each(bitmap, nodes).tolist() == [linking.may_contain(bitmap, int(n)) for n in nodes]


def test_links_between_sets_that_several_texts_have(spark):
    rng = random.Random(5)
    rows = []
    for group in range(6):
        own = [f"g{group}w{rng.randrange(10**6)}" for _ in range(60)]
        near = [*own[:-2], f"n{group}", f"m{group}"]
        for words in (own, near):
            rows += [" ".join(words), "\t".join(words).upper(), " ".join(words), f" {'  '.join(words)}\n"]
    rows += [None, "", None, "g0w1"]
    rng.shuffle(rows)
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    found = {row.doc_id: row.component_id for row in jaccard_join.jaccard_components(df).collect()}
    least: dict[str, int] = {}
    for i, text in enumerate(rows):
        least.setdefault((text or "").split()[0].lower() if text and len(text) > 9 else f"alone {i}", i)
    assert found == {
        i: least[text.split()[0].lower()] if text and len(text) > 9 else i for i, text in enumerate(rows)
    }


def test_shared_shingles_are_handed_on_a_few_at_a_time():
    """What two copies of very long texts share comes in small batches: each row has room for all columns."""
    texts = [" ".join(f"w{i}" for i in range(150_000))] * 2
    scanned = jaccard_join._scan_documents(SIZE)(iter([batch(texts)]))
    found = [(b.nbytes, b["token"].to_pylist(), b["count"].to_pylist()) for b in scanned]
    assert max(size for size, _, _ in found) < 2_000_000
    tokens = [t for _, own, _ in found for t in own if t is not None]
    assert len(set(tokens)) == len(tokens) == 150_000 - SIZE + 1
    assert {n for _, _, own in found for n in own if n is not None} == {2}
