import random

import pytest
from helpers import conversations

from turnmill.operators import assemble_messages
from turnmill.operators.conversations import leading_turns, split_by_length
from turnmill.schema import MESSAGES, TURN_SCHEMA


@pytest.fixture(scope="module")
def rows():
    """Short conversations next to long ones: one id with a third of all rows, one of copies
    of a single turn, and the turns without an id; with gaps, ties and NULLs."""
    draw = random.Random(11)
    roles = ["system", "user", "assistant", "tool", None]
    made = [
        (conv, draw.randrange(-5, 50), draw.choice(roles), f"text {draw.randrange(9)}")
        for conv in range(40)
        for _ in range(draw.randrange(1, 8))
    ]
    made += [
        (100, draw.randrange(30), draw.choice(roles), f"t{draw.randrange(40)}")
        for _ in range(200)
    ]
    made += [(101, 0, "user", "same")] * 90
    made += [
        (None, draw.randrange(3), draw.choice(roles), draw.choice(["x", "y", None]))
        for _ in range(70)
    ]
    draw.shuffle(made)
    return made


@pytest.fixture(scope="module")
def turns(spark, rows):
    return spark.createDataFrame(rows, TURN_SCHEMA).repartition(6)


def expected_parts(rows, n):
    return {
        (conv, start // n): messages[start : start + n]
        for conv, messages in conversations(rows).items()
        for start in range(0, len(messages), n)
    }


def found_parts(df):
    found = {}
    for row in df.collect():
        assert (row["conv_id"], row["part"]) not in found
        found[row["conv_id"], row["part"]] = [tuple(m) for m in row["messages"]]
    return found


def test_whole_conversations(turns, rows):
    assert found_parts(assemble_messages(turns)) == expected_parts(rows, 10_000)


@pytest.mark.parametrize("part_turns", [1, 9, 64])
def test_long_conversations_come_in_parts(turns, rows, part_turns):
    assert found_parts(assemble_messages(turns, part_turns)) == expected_parts(rows, part_turns)


def test_more_long_ids_than_may_be_broadcast(turns, rows):
    parts = assemble_messages(turns, part_turns=3, max_long_ids=2)
    assert found_parts(parts) == expected_parts(rows, 3)


def test_same_type_as_from_json_lines(turns):
    found = assemble_messages(turns).schema["messages"].dataType
    assert [f.name for f in found.elementType] == [f.name for f in MESSAGES.elementType]
    assert found.simpleString() == MESSAGES.simpleString()


def test_split_sets_apart_only_long_ids(turns, rows):
    lengths = {conv: len(m) for conv, m in conversations(rows).items()}
    usual, long = split_by_length(turns, 64)
    assert {r["conv_id"] for r in long.collect()} == {c for c, n in lengths.items() if n > 64}
    assert usual.count() + long.count() == len(rows)
    assert split_by_length(turns, 10_000)[1] is None
    assert split_by_length(turns, 1, max_long_ids=3)[0] is None


def test_leading_turns(turns, rows):
    found = [tuple(r) for r in leading_turns(turns, 5).collect()]
    kept = conversations(found)
    assert kept == {conv: m[:5] for conv, m in conversations(rows).items()}
    assert len(found) == sum(map(len, kept.values()))
