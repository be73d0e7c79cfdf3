"""Counts taken while rows are written."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from turnmill.operators.runs import RUN_CONFIG
from turnmill.sources.datasets import concat_datasets
from turnmill.sources.observed import observed_counts


def write_datasets(datasets: Mapping[str, DataFrame], path: str) -> dict[str, int]:
    """Write datasets of equal columns as one table, partitioned by `dataset`; gives each one's number of rows.

    The counts come from the write itself: the sources are read once, and the written rows not again. A name without
    rows counts 0. Rows that a task wrote twice because it was run again count once.
    """
    observed = Observation()
    named = concat_datasets(datasets)
    counts = [F.count_if(F.col("dataset") == name).alias(f"n_{i}") for i, name in enumerate(datasets)]
    named.observe(observed, *counts).write.partitionBy("dataset").parquet(path)
    seen = observed_counts(observed, [f"n_{i}" for i in range(len(datasets))])
    return dict(zip(datasets, seen.values(), strict=True))


def dataset_counts_of(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    """As `count_by_dataset`, from counts taken while writing; datasets without rows are left out as there."""
    rows = [(name, rows) for name, rows in counts.items() if rows]
    return spark.createDataFrame(rows, "dataset string, n_rows long")


def run_summary_of(
    spark: SparkSession, counts: Mapping[str, int], config: Mapping[str, object] = RUN_CONFIG
) -> DataFrame:
    """As `run_summary`, from counts taken while writing: one row, and no table is read."""
    return spark.range(1).select(
        F.lit(sum(counts.values())).cast("bigint").alias("dataset_size"),
        *[F.lit(value).alias(name) for name, value in config.items()],
    )
