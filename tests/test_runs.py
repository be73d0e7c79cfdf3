import datetime as dt

from pyspark.sql import functions as F

from turnmill.functions import elapsed_seconds
from turnmill.operators import benchmark_rollup, count_by_dataset, run_summary, with_memory_percent
from turnmill.sources import concat_datasets


def test_elapsed(spark):
    start = dt.datetime(2024, 1, 1, 10, 0, 0)
    later = start + dt.timedelta(seconds=2, microseconds=500_001)
    rows = [(start, later), (start, start), (start, None)]
    df = spark.createDataFrame(rows, "a timestamp, b timestamp")
    assert [r[0] for r in df.select(elapsed_seconds("a", "b")).collect()] == [2.500001, 0.0, None]


def test_memory_percent(spark):
    df = spark.createDataFrame(
        [(10.0, 40.0), (1.0, 0.0), (None, 1.0)],
        "gpu_memory_used_mb double, gpu_memory_total_mb double",
    )
    found = [r[0] for r in with_memory_percent(df).select("gpu_memory_percent").collect()]
    assert found == [25.0, None, None]


def test_benchmark_rollup(spark):
    runs = spark.createDataFrame(
        [("a", 10, 1.0), ("a", 20, 2.0), ("b", 5, 0.0)],
        "model string, tokens long, elapsed_s double",
    )
    assert tuple(benchmark_rollup(runs).first()) == (3, 1.0, 35 / 3, 35 / 3)
    by_model = {r["model"]: tuple(r)[1:] for r in benchmark_rollup(runs, ["model"]).collect()}
    assert by_model == {"a": (2, 1.5, 15.0, 10.0), "b": (1, 0.0, 5.0, None)}
    assert tuple(benchmark_rollup(runs.where(F.lit(False))).first()) == (0, None, None, None)


def test_counts_keep_copies(spark):
    one = spark.createDataFrame([(1, "x"), (1, "x")], "id long, text string")
    two = spark.createDataFrame([("x", 1)], "text string, id long")
    both = concat_datasets({"primary": one, "secondary": two})
    assert both.columns == ["dataset", "id", "text"]
    counts = {tuple(r) for r in count_by_dataset(both).collect()}
    assert counts == {("primary", 2), ("secondary", 1)}


def test_run_summary(spark):
    assert run_summary(spark.range(7)).first().asDict() == {
        "dataset_size": 7,
        "batch_size": 2,
        "gradient_accumulation": 4,
        "learning_rate": 2e-4,
        "num_train_epochs": 3,
        "effective_batch_size": 8,
    }
    assert run_summary(spark.range(0), {"model": "m"}).first().asDict() == {
        "dataset_size": 0,
        "model": "m",
    }
