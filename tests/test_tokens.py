import random
import re

import pytest
from helpers import cut

from turnmill.functions import count_tokens, truncate_tokens
from turnmill.functions.text import WHITESPACE


def word_spans(text):
    return [match.span() for match in re.finditer(r"\S+", text)]


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(5)
    alphabet = "ab.é😀" + WHITESPACE + "   "
    made = ["".join(draw.choices(alphabet, k=draw.randrange(60))) for _ in range(300)]
    return [None, "", "  ", "a b c", "a b c\n", "a b c d", " a\n\nb  c \t d\n", *made]


def test_truncation_keeps_a_prefix(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for n in (1, 3, 7):
        results = [r[0] for r in df.select(truncate_tokens("text", n)).collect()]
        assert results == [None if t is None else cut(t, n) for t in texts]


def test_truncation_of_long_texts_needs_no_deep_stack(spark):
    text = "word \n" * 300_000 + " " * 300_000
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(truncate_tokens("text", 200_000)).first()[0] == cut(text, 200_000)
    assert df.select(truncate_tokens("text", 300_000)).first()[0] == text


def test_documents_are_cut_to_prefixes(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = df.select("text", truncate_tokens("text", 2048).alias("cut")).collect()
    assert all(r["cut"] == cut(r["text"], 2048) for r in rows)
    assert any(r["cut"] != r["text"] for r in rows)


def test_limit_must_be_positive():
    with pytest.raises(ValueError):
        truncate_tokens("text", 0)


def test_count(spark):
    texts = {"Hello, world!": 4, "": 0, "a_b 12": 2, " \xa0\n": 0, "été…": 2, "😀😀": 2}
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "text string")
    assert [r[0] for r in df.select(count_tokens("text")).collect()] == [*texts.values(), None]


def test_callers_tokenizer(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    row = df.select(
        truncate_tokens("text", 3, word_spans), count_tokens("text", word_spans)
    ).collect()
    for text, (prefix, count) in zip(texts, row):
        if text is None:
            assert prefix is None and count is None
        else:
            spans = word_spans(text)
            assert count == len(spans)
            assert prefix == (text if len(spans) <= 3 else text[: spans[2][1]])
