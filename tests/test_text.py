import sys

from pyspark.sql import functions as F

from turnmill.functions import (
    completion_text,
    parse_completion,
    preview,
    py_strip,
    reply_or_error,
    strip_prompt,
)
from turnmill.functions.text import WHITESPACE, WHITESPACE_CLASS

SPACED = ["", "  ", "a  b\n", "\xa0a b ", "\x1ca\x1f", "😀 b　", "\r\n\tx y\x85", None]


def test_whitespace_is_pythons():
    assert set(WHITESPACE) == {c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace()}


def test_whitespace_class_is_pythons(spark):
    points = [i for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000]
    df = spark.createDataFrame([("".join(map(chr, points)),)], "text string")
    kept = df.select(F.regexp_replace("text", f"[^{WHITESPACE_CLASS}]", "")).first()[0]
    assert kept == WHITESPACE


def test_strip_is_pythons(spark):
    df = spark.createDataFrame([(s,) for s in SPACED], "text string")
    stripped = [r[0] for r in df.select(py_strip("text")).collect()]
    assert stripped == [s if s is None else s.strip() for s in SPACED]


def test_preview_always_has_the_ellipsis(spark):
    texts = ["", "abc", "😀😀😀😀", "abcdef", None]
    df = spark.createDataFrame([(s,) for s in texts], "text string")
    previews = [r[0] for r in df.select(preview("text", 3)).collect()]
    assert previews == ["...", "abc...", "😀😀😀...", "abc...", None]


def test_strip_prompt(spark):
    rows = [
        ("pq rest", "pq", " rest", True),
        ("other", "pq", "other", False),
        ("😀x", "😀", "x", True),
        ("p", "p", "", True),
        ("p", "pq", "p", False),
        (None, "p", None, False),
        ("p", None, "p", False),
    ]
    df = spark.createDataFrame([r[:2] for r in rows], "output string, prompt string")
    cuts = [tuple(r[0]) for r in df.select(strip_prompt("output", "prompt")).collect()]
    assert cuts == [r[2:] for r in rows]


def test_completion_text(spark):
    both = '{"choices": [{"text": " a "}, {"text": "b"}]}'
    stored = [both, '{"choices": []}', "{}", "junk", None]
    df = spark.createDataFrame([(s,) for s in stored], "stored string")
    choices = parse_completion(F.col("stored"))
    assert [r[0] for r in df.select(completion_text(choices)).collect()] == [
        " a ",
        None,
        None,
        None,
        None,
    ]


def test_reply_or_error(spark):
    rows = [("a", None), (None, "boom"), ("a", "boom")]
    df = spark.createDataFrame(rows, "text string, error string")
    assert [r[0] for r in df.select(reply_or_error("text", "error")).collect()] == [
        "a",
        "Error generating response: boom",
        "Error generating response: boom",
    ]
