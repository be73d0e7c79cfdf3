import pytest
from pyspark.sql import functions as F

from turnmill.functions import render, render_prompt
from turnmill.operators import plan_batches
from turnmill.schema import CONVERSATION_SCHEMA
from turnmill.sources import (
    concat_datasets,
    read_conversations,
    sample_prompts,
    write_training_text,
)

LINES = [
    '{"messages": [{"role": "user", "content": "u"}], "extra": 1}',
    "not json",
    '{"messages": []}',
    '{"messages": null}',
    "",
    '{"messages": [{"content": "c", "name": "n"}, {"role": null, "content": null}]}',
]


def test_read_conversations(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text("\n".join(LINES))
    rows = read_conversations(spark, str(tmp_path)).collect()
    found = [
        (None if r["messages"] is None else [tuple(m) for m in r["messages"]], r["_corrupt_record"])
        for r in rows
    ]
    assert found == [
        ([("user", "u")], None),
        (None, "not json"),
        ([], None),
        (None, None),
        ([(None, "c"), (None, None)], None),
    ]


def test_functions_also_work_on_a_stream_of_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text("\n".join(LINES))
    stream = spark.readStream.schema(CONVERSATION_SCHEMA).json(str(tmp_path / "in"))
    shown = stream.select(render("messages").alias("shown")).select("shown.*")
    query = (
        shown.writeStream.format("memory")
        .queryName("rendered")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(60)
    found = sorted((tuple(r) for r in spark.table("rendered").collect()), key=repr)
    batch = read_conversations(spark, str(tmp_path / "in"))
    batch = batch.select(render("messages").alias("shown")).select("shown.*")
    assert found == sorted((tuple(r) for r in batch.collect()), key=repr)


def test_sample_prompts(spark):
    prompts = sample_prompts(spark)
    assert prompts.columns == ["system", "user"]
    assert prompts.count() == 6
    assert prompts.where(render_prompt("system", "user").isNull()).count() == 0


def test_concatenation_wants_equal_columns(spark):
    with pytest.raises(ValueError):
        concat_datasets({})
    with pytest.raises(Exception):
        concat_datasets({"a": spark.range(1), "b": spark.range(1).toDF("other")}).collect()


def test_training_files_lie_in_order(spark, tmp_path):
    plan = plan_batches(spark.range(103).toDF("id"), "id")
    rows = plan.withColumn("text", F.concat(F.lit("text "), "id"))
    out = tmp_path / "out"
    write_training_text(rows, str(out), 4)
    expected = {(r["epoch"], r["pos"]): r["text"] for r in rows.collect()}
    seen = 0
    for epoch in range(3):
        files = sorted((out / f"epoch={epoch}").glob("*.parquet"))
        assert len(files) == 4
        position = 0
        for file in files:
            part = spark.read.parquet(str(file)).collect()
            assert len(part) in (25, 26)
            for row in part:
                assert row["pos"] == position
                assert row["text"] == expected[epoch, position]
                position += 1
        assert position == 103
        seen += position
    assert seen == len(expected)
