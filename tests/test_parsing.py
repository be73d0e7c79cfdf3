"""Lines of chat JSON: what is a conversation, what is not, and why."""

import pytest
from helpers import executed_plan
from pyspark.sql import functions as F

from turnmill.sources.conversations import (
    NO_MESSAGES,
    NOT_JSON,
    NOT_MESSAGES,
    parse_conversations,
    parse_line,
)

GOOD = {
    '{"messages": [{"role": "user", "content": "a"}]}': [("user", "a")],
    ' \t{"id": 3, "messages": [{"content": "é", "role": "tool", "x": [1]}], "more": {}} \r': [("tool", "é")],
    '{"messages": []}': [],
    '{"messages": [{}]}': [(None, None)],
    '{"messages": [{"role": null, "content": 7}]}': [(None, "7")],
    '{"messages": [{"role": "user", "content": "]} trailing ["}]}': [("user", "]} trailing [")],
}
BAD = {
    "not json": NOT_JSON,
    "{": NOT_JSON,
    '{"messages": [{"role": "us': NOT_JSON,
    '{"messages": []} trailing': NOT_JSON,
    '{"messages": []} {"messages": []}': NOT_JSON,
    '{"messages": []},{"messages": []}': NOT_JSON,
    '{"messages": []}]': NOT_JSON,
    "[]": NOT_MESSAGES,
    '[{"messages": []}]': NOT_MESSAGES,
    "null": NOT_MESSAGES,
    "7": NOT_MESSAGES,
    '{"messages": "text"}': NOT_MESSAGES,
    '{"messages": {"role": "user"}}': NOT_MESSAGES,
    '{"messages": [1]}': NOT_MESSAGES,
    '{"messages": [null]}': NOT_MESSAGES,
    '{"messages": null}': NO_MESSAGES,
    '{"other": 1}': NO_MESSAGES,
    "{}": NO_MESSAGES,
}
BLANK = ["", "  ", "\t\r\n", None]


@pytest.fixture
def lines(spark):
    rows = [(i, line) for i, line in enumerate([*GOOD, *BAD, *BLANK] * 2)]
    return spark.createDataFrame(rows, "node long, value string").repartition(5)


def test_each_line_is_a_conversation_or_has_a_reason(lines):
    for row in lines.select("value", parse_line("value").alias("p")).collect():
        if row.value in GOOD:
            assert row.p.reject_reason is None, row.value
            assert [tuple(m) for m in row.p.messages] == GOOD[row.value]
        else:
            assert row.p.messages is None
            assert row.p.reject_reason == BAD.get(row.value), row.value


def test_rows_rejects_and_counts(lines):
    rows, rejects, counts = parse_conversations(lines)
    assert rows.columns == ["node", "messages"]
    assert rejects.columns == ["node", "value", "reject_reason"]
    assert rows.count() == 2 * len(GOOD)
    assert sorted((r.value, r.reject_reason) for r in rejects.collect()) == sorted([*BAD.items()] * 2)
    reasons = list(BAD.values())
    assert counts == {
        "lines": 2 * (len(GOOD) + len(BAD) + len(BLANK)),
        "rows": 2 * len(GOOD),
        "rejects": 2 * len(BAD),
        "blank": 2 * len(BLANK),
        **{reason: 2 * reasons.count(reason) for reason in set(reasons)},
    }


def test_rejects_are_not_read_for_rows(lines):
    plan = executed_plan(parse_conversations(lines).rows)
    assert "PartitionFilters: [isnotnull(_rejected" in plan
    assert "value" not in plan.split("ReadSchema")[1]


def test_no_lines(lines):
    rows, rejects, counts = parse_conversations(lines.where("false"))
    assert (rows.count(), rejects.count(), counts["lines"]) == (0, 0, 0)


def test_clashing_columns_are_refused(lines):
    with pytest.raises(ValueError, match="messages"):
        parse_conversations(lines.withColumn("messages", F.lit(1)))
