"""A caller's formatter that fails on some rows."""

import pytest
from helpers import plain
from pyspark.sql import functions as F

from turnmill.operators import render_or_fall_back
from turnmill.schema import MESSAGES


@pytest.fixture(scope="module")
def chats(spark):
    rows = [(i, [("user", f"q{i}"), ("assistant", f"a{i}")]) for i in range(100)]
    rows += [(100, []), (101, None), (102, [("tool", "t"), (None, None)])]
    schema = f"id long, messages {MESSAGES.simpleString()}, note string"
    return spark.createDataFrame([(*row, "x") for row in rows], schema).coalesce(1)


@pytest.mark.parametrize("failing", [set(), {0}, {102}, {3, 4, 50, 101}, set(range(103))])
def test_only_failing_rows_fall_back(spark, chats, failing):
    calls = spark.sparkContext.accumulator(0)

    def formatter(batch):
        calls.add(1)
        if failing.intersection(batch["id"]):
            raise KeyError("no such template")
        return [None if m is None else "/".join(t["content"] or "-" for t in m) for m in batch["messages"]]

    found = render_or_fall_back(chats, formatter, ("id", "messages")).collect()
    for row in found:
        messages = None if row.messages is None else [tuple(m) for m in row.messages]
        assert row.used_fallback == (row.id in failing)
        if messages is None:
            assert row.text is None
        elif row.id in failing:
            assert row.text == plain(messages)
        else:
            assert row.text == "/".join(content or "-" for _, content in messages)
    assert len(found) == 103
    assert calls.value <= 1 + 2 * len(failing) * 7


def test_a_wrong_number_of_texts_is_an_error(chats):
    with pytest.raises(Exception, match="gave 1 texts for 103 rows"):
        render_or_fall_back(chats, lambda batch: ["only one"]).collect()


def test_names_and_no_rows(chats):
    df = render_or_fall_back(chats.where("false"), lambda b: [], output="shown", flag="failed")
    assert df.columns == ["id", "messages", "note", "shown", "failed"]
    assert df.count() == 0
    assert render_or_fall_back(chats, lambda b: ["t"] * len(b["messages"])).where(F.col("text") == "t").count() == 103
