"""Writing numbered training rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_training_text(df: DataFrame, path: str, n_files: int) -> None:
    """Write numbered rows as Parquet, one folder per epoch, n_files files in each.

    Needs `epoch`, `pos` and `epoch_rows` as `plan_batches` gives them. The
    files of an epoch, taken in name order, hold its rows in `pos` order, and
    their row counts differ by one at most. As positions are dense, each row's
    file is known from its position: one shuffle, and no sampling pass over the
    rendered text as a range partitioning would need.
    """
    file = F.expr(f"cast(pos * {int(n_files)} div epoch_rows as int)")
    (
        df.repartitionById(n_files, file)
        .sortWithinPartitions("epoch", "pos")
        .write.partitionBy("epoch")
        .parquet(path)
    )
