import pytest
from helpers import plain
from pyspark.sql import functions as F

from turnmill.functions import make_messages
from turnmill.operators import render_with


def upper(batch):
    return [
        m and "/".join(f"{turn['role']}:{turn['content']}".upper() for turn in m)
        for m in batch["messages"]
    ]


def test_formatter_gets_lists_of_messages(spark):
    rows = [("s", "u", 1), ("t", None, 2)]
    df = spark.createDataFrame(rows, "system string, user string, n long")
    df = df.withColumn("messages", make_messages("system", "user"))
    missing = df.withColumn("messages", F.when(F.col("n") == 1, F.col("messages")))
    assert [r["text"] for r in render_with(df, upper).collect()] == [
        "SYSTEM:S/USER:U",
        "SYSTEM:T/USER:NONE",
    ]
    assert [r["text"] for r in render_with(missing, upper).collect()] == ["SYSTEM:S/USER:U", None]


def test_formatter_may_use_other_columns(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "name string, n long")

    def repeat(batch):
        return [name * n for name, n in zip(batch["name"], batch["n"])]

    found = render_with(df, repeat, ["name", "n"], "out").collect()
    assert [r["out"] for r in found] == ["a", "bb"]


def test_one_text_per_row_is_required(spark):
    df = spark.range(3).coalesce(1).withColumn("messages", F.lit("x"))
    with pytest.raises(Exception):
        render_with(df, lambda batch: ["only one"]).collect()
