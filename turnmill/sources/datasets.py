"""Putting several datasets into one."""

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def concat_datasets(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """Concatenate datasets of equal columns, naming each row's in `dataset`.

    All rows are kept, copies too. It is a union of scans: nothing is shuffled.
    """
    if not datasets:
        raise ValueError("no datasets given")
    named = [
        df.select(F.lit(name).alias("dataset"), *df.columns) for name, df in datasets.items()
    ]
    return reduce(DataFrame.unionByName, named)
