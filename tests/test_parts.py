"""Parts of conversations put together against whole ones."""

import random

import pytest
from helpers import chatml, complete, conversations, plain
from pyspark.sql import functions as F

from turnmill.functions import message_at_part, render_chatml_part, render_part, render_plain_part
from turnmill.operators import conversation_parts
from turnmill.schema import TURN_SCHEMA


@pytest.fixture(scope="module")
def rows():
    """Long and short conversations; a third of the rows are one's, some are copies of one turn."""
    draw = random.Random(5)
    roles = ["system", "user", "assistant", "tool", None]

    def made(conv, n, roles, texts):
        return [(conv, draw.choice([None, *range(40)]), draw.choice(roles), draw.choice(texts)) for _ in range(n)]

    rows = made(1, 90, roles, ["a", "bb", "", None]) + made(2, 60, roles[:3], ["x", "y" * 50])
    rows += made(None, 30, ["user"], ["n"]) + made(3, 20, ["tool"], ["t"]) + made(4, 9, ["tool", "user"], ["u"])
    rows += [(5, 0, "user", "same")] * 40 + [(6, 0, "system", "s"), (6, 1, "user", "é" * 300), (6, 2, "user", "z")]
    rows += [(7, i, "tool" if i < 8 else "user", "late") for i in range(12)]
    rows += [row for conv in range(20, 40) for row in made(conv, draw.randrange(1, 6), roles, ["q", "r"])]
    draw.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def turns(spark, rows):
    return spark.createDataFrame(rows, TURN_SCHEMA).repartition(6)


@pytest.mark.parametrize(
    ("part_turns", "part_bytes", "max_long_ids"),
    [(1, None, 1000), (3, None, 1000), (7, None, 2), (10_000, None, 1000), (1000, 20, 1000), (4, 100, 1000), (1000, 1, 3)],
)
def test_parts_put_together_are_the_whole(turns, rows, part_turns, part_bytes, max_long_ids):
    whole = conversations(rows)
    parts = conversation_parts(turns, part_turns, part_bytes, max_long_ids)
    shown = parts.select(
        "*",
        render_part("messages", "facts").alias("shown"),
        render_chatml_part("messages", "facts", "be kind").alias("chatml"),
        render_plain_part("messages", "facts").alias("plain"),
        *[message_at_part("messages", "facts", i).alias(f"at{i}") for i in (0, 4, 11, 500)],
    ).collect()
    found = {}
    for row in sorted(shown, key=lambda r: r.part):
        found.setdefault(row.conv_id, []).append(row)
    assert found.keys() == whole.keys()
    for conv, own in found.items():
        messages = whole[conv]
        assert [r.part for r in own] == list(range(len(own)))
        assert [tuple(m) for r in own for m in r.messages] == messages
        assert all(len(r.messages) <= part_turns for r in own)
        if part_bytes is not None:
            sizes = [[len((role or "").encode() + (text or "").encode()) for role, text in r.messages] for r in own]
            assert all(sum(size) <= part_bytes or len(size) == 1 for size in sizes)
        assert "".join(r.plain for r in own) == plain(messages)
        assert "".join(r.shown.text for r in own) == (chatml if complete(messages) else plain)(messages)
        assert {r.shown.used_fallback for r in own} == {not complete(messages)}
        opening = "" if messages[0][0] == "system" else "<|im_start|>system\nbe kind<|im_end|>\n"
        assert "".join(r.chatml for r in own) == opening + chatml(messages)
        for position in (0, 4, 11, 500):
            expected = messages[position][1] if position < len(messages) else None
            values = [getattr(r, f"at{position}") for r in own]
            assert [v for v in values if v is not None] == ([] if expected is None else [expected])


def test_no_turns_and_wrong_sizes(turns):
    assert conversation_parts(turns.where("false"), 3, 10).count() == 0
    for sizes in ((0, None), (3, 0)):
        with pytest.raises(ValueError, match="at least 1"):
            conversation_parts(turns, *sizes)


def test_facts_have_the_stated_type(turns):
    for parts in (conversation_parts(turns), conversation_parts(turns, 2)):
        fields = {f.name: f.dataType.simpleString() for f in parts.schema["facts"].dataType}
        assert fields == {
            "first": "bigint",
            "n_messages": "bigint",
            "shown_before": "bigint",
            "renderable": "boolean",
            "opens_with_system": "boolean",
        }
        assert parts.where(F.col("facts.n_messages") < F.size("messages")).count() == 0
