"""Durations from clock readings."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnmill.functions.columns import ColumnOrName, as_column


def elapsed_seconds(started_at: ColumnOrName, ended_at: ColumnOrName) -> Column:
    """Seconds between two timestamps, to the microsecond."""
    return (F.unix_micros(as_column(ended_at)) - F.unix_micros(as_column(started_at))) / 1e6
