"""op6: pieces of any script go through the table, and counts are the library's."""

import os
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark import cloudpickle

from turnmill.llm import token_counts
from turnmill.llm.queries import QUERIES
from turnmill.llm.token_counts import Encoder, Frequent, count_column, cut_pieces, hash_spelled

EMPTY = (np.zeros(0, np.uint64), np.zeros(0, np.int32))


@pytest.fixture(scope="module")
def path():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def _table(encoder, pieces):
    hashes, lengths = hash_spelled(pieces), np.array(encoder.encoded(pieces), np.int32)
    order = np.argsort(hashes)
    return hashes[order], lengths[order]


def _pieces(text):
    data = np.frombuffer(text.encode(), np.uint8)
    starts, _ = cut_pieces(data, np.array([0, len(data)]))
    return [data[a:b].tobytes().decode() for a, b in zip(starts, [*starts[1:], len(data)], strict=True)]


def test_pieces_start_at_single_spaces_of_any_script():
    assert _pieces("ab it's  two\n x") == ["ab", " it's  two\n x"]
    assert _pieces("السلام عليكم नमस्ते दुनिया 😀 éa b") == [
        "السلام", " عليكم", " नमस्ते", " दुनिया", " 😀", " éa", " b"
    ]
    assert _pieces("a\u3000 b \u00a0c") == ["a\u3000 b \u00a0c"]
    assert _pieces(" a ") == [" a "]
    assert cut_pieces(np.zeros(0, np.uint8), np.array([0, 0]))[0].tolist() == []


def test_all_scripts_are_answered_by_the_table(path, monkeypatch):
    texts = ["السلام عليكم", "नमस्ते दुनिया", "😀 👍🏽 ok", "été ete", "한국어 日本 語", "ab ba"]
    encoder = Encoder(path)
    table = _table(encoder, sorted({piece for text in texts for piece in _pieces(text)}))
    expected = encoder.encoded(texts)
    monkeypatch.setattr(encoder, "encoded", lambda asked: pytest.fail(f"encoded {asked}"))
    assert count_column(pa.array(texts), encoder, table).tolist() == expected


def test_a_piece_is_encoded_once_for_each_worker(path):
    encoder = Encoder(path)
    asked = []
    library = encoder.encoded
    encoder.encoded = lambda texts: asked.extend(texts) or library(texts)
    texts = pa.array(["x yy yy", None, "", "x yy zz"])
    for _ in range(2):
        count_column(texts, encoder, EMPTY)
    assert sorted(asked) == [" yy", " zz", "x"]


def test_the_table_and_the_size_of_chunks_change_no_count(path, monkeypatch):
    rng = random.Random(3)
    letters = "ab 1.'s\n\t \u00e9\U0001f600\x85\u3000\u00a0\u2003\u2028\u092c\u0928\u093f\u0301\u1680\u180e\u200b \x00\x1c\u65e5\ufeff"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["a<|endoftext|>b", "a <|endoftext|> b", " lead", "trail ", "", None, "x" * 70_000, "ab  " * 20_000]
    encoder = Encoder(path)
    expected = encoder.encoded([text or "" for text in texts])
    table = _table(encoder, sorted({piece for text in texts[:500] if text for piece in _pieces(text)}))
    for size in (1, 1000, token_counts.CHUNK):
        monkeypatch.setattr(token_counts, "CHUNK", size)
        for lengths in (EMPTY, table):
            assert count_column(pa.array(texts), Encoder(path), lengths).tolist() == expected


def test_proposed_pieces_are_the_most_frequent_ones(monkeypatch):
    monkeypatch.setattr(token_counts, "COUNTED", 20)
    monkeypatch.setattr(token_counts, "PROPOSED", 2)
    counts = Frequent()
    texts = [f"often seen rare{i} seen often " + "long" * 40 + " often" for i in range(200)]
    for _, text, starts, _, hashes in token_counts._chunks(pa.array(texts)):
        counts.add(text, starts, hashes)
    pieces, times = counts.top(2)
    assert dict(zip(pieces, times, strict=True)) == {" often": 400, " seen": 400}


def test_op6_counts_whole_documents_as_the_library_does(spark, sf_dir, path):
    found = QUERIES["op6_token_counts"](spark, sf_dir).collect()
    rows = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    counts = Encoder(path).encoded([row["text"] or "" for row in rows])
    expected = sorted(
        (row["doc_id"], len((row["text"] or "").encode()), n, n > 512) for row, n in zip(rows, counts, strict=True)
    )
    assert sorted((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in found) == expected


def test_an_empty_table_and_extra_columns(spark, path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.count_text_tokens(empty, path).collect() == []
    clash = spark.createDataFrame([(1, "ab ba", 9), (1, "ab ba", 9)], "doc_id long, text string, n_tokens int")
    found = token_counts.count_text_tokens(clash, path, frequent=1).collect()
    assert [tuple(row) for row in found] == [(1, 5, Encoder(path).encoded(["ab ba"])[0])] * 2


def test_a_worker_keeps_few_bytes_a_piece_and_no_threads(path, monkeypatch):
    """The cache gives the same lengths before and after it starts anew, and what the library returns is dropped in parts."""
    encoder, calls = Encoder(path), []
    library = encoder.tokenizer

    class Counting:
        def encode_batch(self, texts, **how):
            calls.append(sum(map(len, texts)))
            return library.encode_batch(texts, **how)

    encoder.tokenizer = Counting()
    monkeypatch.setattr(token_counts, "CACHED", 50)
    texts = [" ".join(f"word{(i * 7 + k) % 90}x" for k in range(12)) for i in range(60)] + ["<|endoftext|> " + "ab " * 30_000] * 4
    found = count_column(pa.array(texts), encoder, EMPTY)
    assert found.tolist() == [len(own) for own in library.encode_batch(texts, add_special_tokens=False)]
    assert max(calls) < 2 * token_counts.ENCODED + 90_000 and len(calls) > 4
    assert sum(part.nbytes for part in encoder.seen) == 12 * len(encoder.seen[0])
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"


def test_counts_of_a_task_take_few_bytes_a_piece(monkeypatch):
    """300,000 different pieces are counted in bounded arrays, and a piece seen throughout keeps its count."""
    monkeypatch.setattr(token_counts, "PROPOSED", 1 << 10)
    texts = pa.array([" ".join(f"p{i}x{k} often" for k in range(100)) for i in range(3000)])
    held, before = Frequent(), pa.total_allocated_bytes()
    tracemalloc.start()
    for _, text, starts, _, hashes in token_counts._chunks(texts):
        held.add(text, starts, hashes)
    peak = tracemalloc.get_traced_memory()[1] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert peak < 30e6
    pieces, times = held.top(1)
    assert (pieces, times) == ([" often"], [300_000])


class Sent:
    """What a broadcast of an empty table is to a task."""

    value = EMPTY


def test_tasks_of_a_worker_share_one_encoder_that_is_not_sent(path):
    """Functions reach each task by value; the tokenizer and the lengths seen must neither go along nor be made anew."""
    token_counts.encoder_of(path)
    sent = cloudpickle.dumps(token_counts._count(path, Sent()))
    assert len(sent) < 100_000
    batch = pa.record_batch({"doc_id": [1, 2], "text": ["kept over tasks", "kept qqxzy"]})
    for _ in range(2):
        task = cloudpickle.loads(sent)
        assert [b.column("n_bytes").to_pylist() for b in task(iter([batch]))] == [[15, 10]]
        seen = token_counts.encoder_of(path).seen[0]
        assert hash_spelled([" qqxzy"])[0] in seen
