"""Rollups over datasets, stored runs and telemetry.

Each is one partial-plus-final hash aggregate: a hot key leaves every task as
a single partial row.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The recorded training configuration.
RUN_CONFIG = {
    "batch_size": 2,
    "gradient_accumulation": 4,
    "learning_rate": 2e-4,
    "num_train_epochs": 3,
    "effective_batch_size": 8,
}


def count_by_dataset(df: DataFrame) -> DataFrame:
    """Rows per dataset."""
    return df.groupBy("dataset").agg(F.count("*").alias("n_rows"))


def run_summary(df: DataFrame, config: Mapping[str, object] = RUN_CONFIG) -> DataFrame:
    """One row: the size of the dataset next to the run's configuration."""
    return df.agg(F.count("*").alias("dataset_size")).select(
        "dataset_size", *[F.lit(value).alias(name) for name, value in config.items()]
    )


def benchmark_rollup(runs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean seconds, mean tokens and tokens per second of stored runs.

    Needs `tokens` and `elapsed_s`. The rate is the mean of tokens over the mean
    of seconds, which is the ratio of their sums; it is NULL when no time passed.
    """
    return runs.groupBy(*by).agg(
        F.count("*").alias("n_runs"),
        F.avg("elapsed_s").alias("mean_s"),
        F.avg("tokens").alias("mean_tokens"),
        F.try_divide(F.sum("tokens"), F.sum("elapsed_s")).alias("tokens_per_s"),
    )


def with_memory_percent(df: DataFrame) -> DataFrame:
    """Add the share of memory in use, in percent; NULL when the total is 0."""
    used, total = F.col("gpu_memory_used_mb"), F.col("gpu_memory_total_mb")
    return df.withColumn("gpu_memory_percent", F.try_divide(used, total) * 100)
