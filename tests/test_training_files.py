"""Files with a manifest, counts taken while writing, and the plans that use row numbers."""

import random

import pytest
from helpers import conversations, cut, executed_plan, training_texts
from pyspark.sql import functions as F

from turnmill.operators import batches_by_place, count_by_dataset, run_summary
from turnmill.plans import training_rows_by_place, training_text
from turnmill.schema import MESSAGES, TURN_SCHEMA
from turnmill.sources import (
    concat_datasets,
    dataset_counts_of,
    file_ranges,
    read_manifest,
    read_training_range,
    run_summary_of,
    write_datasets,
    write_training_files,
)


def numbered(spark, n, epochs=2):
    df = spark.range(n).select(F.col("id").alias("row"), F.concat(F.lit("t"), "id").alias("text"))
    return batches_by_place(df.repartition(5), n, epochs=epochs)


@pytest.mark.parametrize(("n", "n_files"), [(100, 7), (5, 9), (64, 64), (1, 1)])
def test_files_hold_what_the_manifest_says(spark, tmp_path, n, n_files):
    path = str(tmp_path / "out")
    rows = numbered(spark, n)
    manifest = [tuple(r) for r in write_training_files(rows, path, n_files).orderBy("epoch", "file").collect()]
    expected = sorted((r.epoch, r.pos, r.text) for r in rows.collect())
    listed = [(epoch, pos) for epoch, _, first, last, _ in manifest for pos in range(first, last + 1)]
    assert listed == [row[:2] for row in expected]
    sizes = [size for *_, size in manifest]
    assert max(sizes) - min(sizes) <= 1
    for epoch, file, first, last, size in manifest:
        read = spark.read.parquet(f"{path}/rows/epoch={epoch}/file={file}").collect()
        assert [r.pos for r in read] == list(range(first, last + 1))
        assert size == last - first + 1
    for first, end in ((0, n), (n // 3, n // 2), (n - 1, n + 50), (n, n + 1), (2, 2), (-5, 1)):
        found = [(r.epoch, r.pos, r.text) for r in read_training_range(spark, path, 1, first, end).collect()]
        assert found == [row for row in expected if row[0] == 1 and first <= row[1] < end]


def test_a_range_reads_its_files_only(spark, tmp_path):
    path = str(tmp_path / "out")
    write_training_files(numbered(spark, 200), path, 20)
    plan = executed_plan(read_training_range(spark, path, 0, 50, 61))
    assert "PartitionFilters: [isnotnull(epoch" in plan and "file" in plan.split("PartitionFilters")[1]
    assert len(read_training_range(spark, path, 0, 50, 61).inputFiles()) > 0
    assert read_manifest(spark, path).count() == 40


def test_order_holds_for_any_number_of_files(spark):
    n_files, rows = 100_001, 3 * 100_001 + 77
    ranges = [tuple(r) for r in file_ranges(spark, [0], rows, n_files).orderBy("file").collect()]
    assert len(ranges) == n_files
    assert ranges[0][2] == 0 and ranges[-1][3] == rows - 1
    assert all(a[3] + 1 == b[2] and a[1] + 1 == b[1] for a, b in zip(ranges, ranges[1:]))
    for _, file, first, last, _ in random.Random(0).sample(ranges, 500):
        assert {pos * n_files // rows for pos in range(first, last + 1)} == {file}
        assert (last + 1) * n_files // rows > file > (first - 1) * n_files // rows


@pytest.mark.parametrize("where", ["pos <> 3", "pos <> 0", "pos <> 9", "epoch = 0 OR pos < 4"])
def test_positions_with_gaps_leave_no_manifest(spark, tmp_path, where):
    path = str(tmp_path / "out")
    with pytest.raises(ValueError, match="not dense"):
        write_training_files(numbered(spark, 10).where(where), path, 3)
    assert not (tmp_path / "out" / "manifest").exists()


def test_no_rows(spark, tmp_path):
    path = str(tmp_path / "out")
    assert write_training_files(numbered(spark, 3).where("false"), path, 3).count() == 0
    with pytest.raises(ValueError, match="n_files"):
        write_training_files(numbered(spark, 3), path, 0)


def test_counts_while_writing_are_those_of_a_count(spark, tmp_path):
    datasets = {"a b": spark.range(70), "none": spark.range(0), "c": spark.range(5)}
    counts = write_datasets(datasets, str(tmp_path / "t"))
    assert counts == {"a b": 70, "none": 0, "c": 5}
    named = concat_datasets(datasets)
    assert sorted(dataset_counts_of(spark, counts).collect()) == sorted(count_by_dataset(named).collect())
    assert run_summary_of(spark, counts).collect() == run_summary(named).collect()
    assert "Scan parquet" not in executed_plan(run_summary_of(spark, counts))
    assert spark.read.parquet(str(tmp_path / "t")).groupBy("dataset").count().count() == 2


def test_rows_by_place_keep_equal_texts_apart(spark):
    chats = [[("user", "same")]] * 30 + [[("user", f"q{i}")] for i in range(20)] + [None, None, []]
    df = spark.createDataFrame([(c, "x") for c in chats], f"messages {MESSAGES.simpleString()}, text string")
    rows = training_rows_by_place(df.repartition(4), epochs=2, micro=3, accum=2)
    found = rows.collect()
    assert sorted((r.epoch, r.pos) for r in found) == [(e, p) for e in range(2) for p in range(51)]
    assert all(r.step == r.pos // 6 and r.epoch_rows == 51 for r in found)
    same = {r.row for r in found if r.text == "<|im_start|>user\nsame<|im_end|>\n"}
    assert len(same) == 30
    plan = executed_plan(rows)
    assert "Exchange hash" not in plan and "Sort" not in plan
    assert training_rows_by_place(df.where("false")).count() == 0
    told = training_rows_by_place(df, formatter=lambda b: [str(len(m)) for m in b["messages"]], epochs=1)
    assert sorted(r.text for r in told.collect()) == ["0"] + ["1"] * 50


def characters(text):
    return [(i, i + 3) for i in range(0, len(text), 3)]


@pytest.mark.parametrize("max_tokens", [1, 30, 400, 5000])
def test_a_tokenizers_limit_on_long_conversations(spark, max_tokens):
    draw = random.Random(3)
    rows = [(1, i, draw.choice(["user", "assistant"]), "word " * draw.randrange(60)) for i in range(300)]
    rows += [(2, i, draw.choice(["user", "tool", None]), draw.choice(["x" * 50, None])) for i in range(90)]
    rows += [(3, i, "user", "") for i in range(40)] + [(4, 0, "user", "short"), (None, 0, "tool", "t")]
    turns = spark.createDataFrame(rows, TURN_SCHEMA).repartition(5)
    whole = training_texts(rows, 10**9)
    found = training_text(turns, max_tokens, long_turns=10, spans=characters).collect()
    assert {r.conv_id: r.text for r in found} == {c: text[: 3 * max_tokens] for c, (text, _) in whole.items()}
    assert len(found) == len(conversations(rows))
    assert cut("a b c", 2) == "a b"
