import hashlib
import json
import random

import pytest
from helpers import batch_plan, chatml, complete, conversations, cut, plain, training_texts

from turnmill.operators import batches
from turnmill.plans import training_rows, training_rows_from_messages, training_text
from turnmill.schema import TURN_SCHEMA
from turnmill.sources import read_conversations


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(23)
    texts = ["a b c", "", " \n", "x", "one two three four.\nfive", "y "]

    def conversation(conv, n, roles, contents=texts):
        return [
            (conv, draw.randrange(60), draw.choice(roles), draw.choice(contents))
            for _ in range(n)
        ]

    known = ["system", "user", "assistant"]
    made = []
    for conv in range(30):
        made += conversation(conv, draw.randrange(1, 9), known)
    made += conversation(200, 120, known)
    made += conversation(201, 120, [*known, "tool", None], [*texts, None])
    made += conversation(202, 60, ["tool"])
    made += conversation(203, 60, ["tool"]) + conversation(203, 3, known)
    made += [(204, 1, "user", "same")] * 80
    made += conversation(205, 70, ["user"], [""])
    made += conversation(206, 70, [None], ["", None])
    made += conversation(None, 50, known)
    draw.shuffle(made)
    return made


@pytest.fixture(scope="module")
def turns(spark, rows):
    return spark.createDataFrame(rows, TURN_SCHEMA).repartition(5)


@pytest.mark.parametrize("max_tokens", [1, 6, 40, 2048])
@pytest.mark.parametrize("limits", [(10_000, 10), (10, 100), (10, 1)])
def test_long_conversations_give_the_same_text(turns, rows, max_tokens, limits):
    long_turns, max_long_ids = limits
    found = training_text(turns, max_tokens, long_turns, max_long_ids).collect()
    texts = {r["conv_id"]: (r["text"], r["used_fallback"]) for r in found}
    assert len(found) == len(texts)
    assert texts == training_texts(rows, max_tokens)


def test_training_rows(turns, rows):
    found = training_rows(turns, max_tokens=20, epochs=2).collect()
    texts = training_texts(rows, 20)
    expected = [
        (*place, *texts[place[2]])
        for place in batch_plan(list(conversations(rows)), 3407, 2, 2, 4)
    ]
    columns = "epoch pos conv_id micro_batch step epoch_rows text used_fallback".split()
    assert sorted((tuple(r[c] for c in columns) for r in found), key=lambda r: r[:2]) == expected


@pytest.mark.parametrize("shard", [100_000, 7])
def test_from_json_lines_to_training_rows(spark, tmp_path, monkeypatch, shard):
    # A third of the conversations are copies of one; small shards treat it as a hot one.
    monkeypatch.setattr(batches, "COPIES_PER_SHARD", shard)
    made = [[("user", f"question {i}"), ("assistant", "word " * (i % 9))] for i in range(40)]
    made += [[("user", "the same"), ("assistant", "again")]] * 20
    made += [[("tool", "x"), (None, "y")], [], [], None, None]
    lines = [
        json.dumps({"messages": m and [dict(zip(("role", "content"), t)) for t in m]})
        for m in made
    ]
    (tmp_path / "chats.jsonl").write_text("\n".join([*lines, "not json"]))

    texts = {}
    ids = []
    # Lines without messages are no conversations.
    for messages in [m for m in made if m is not None]:
        shown = complete(messages)
        text = cut(chatml(messages) if shown else plain(messages), 6)
        ids.append(hashlib.sha256(text.encode()).hexdigest())
        texts[ids[-1]] = (text, not shown)

    chats = read_conversations(spark, str(tmp_path / "chats.jsonl"))
    found = training_rows_from_messages(chats, max_tokens=6)
    columns = "epoch pos text_id micro_batch step epoch_rows text used_fallback".split()
    assert sorted(found.columns) == sorted(columns)
    rows = sorted((tuple(r[c] for c in columns) for r in found.collect()), key=lambda r: r[:2])
    assert rows == [(*place, *texts[place[2]]) for place in batch_plan(ids, 3407, 3, 2, 4)]
