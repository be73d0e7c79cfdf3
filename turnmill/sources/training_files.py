"""Training rows in files that say which places they hold."""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from turnmill.sources.observed import observed_counts

MANIFEST = "manifest"
ROWS = "rows"


def file_ranges(spark: SparkSession, epochs: list[int], epoch_rows: int, n_files: int) -> DataFrame:
    """(epoch, file, first_pos, last_pos, n_rows) of every file that has rows.

    Positions are dense, so a file's are known from its number: they differ by one row at most between
    files, and files follow one another by number.
    """
    rows, files = F.lit(epoch_rows).cast("bigint"), F.lit(n_files).cast("bigint")

    def start(number):
        # The first position of which floor(pos * n_files / epoch_rows) is the file's number.
        return F.call_function("div", number * rows + files - 1, files)

    ranges = spark.range(n_files if epoch_rows else 0).select(
        F.col("id").cast("int").alias("file"),
        start(F.col("id")).alias("first_pos"),
        (start(F.col("id") + 1) - 1).alias("last_pos"),
    )
    ranges = ranges.withColumn("n_rows", F.col("last_pos") - F.col("first_pos") + 1)
    named = F.explode(F.array(*[F.lit(epoch) for epoch in epochs]).cast("array<int>")).alias("epoch")
    return ranges.where("n_rows > 0").select(named, "file", "first_pos", "last_pos", "n_rows")


def write_training_files(df: DataFrame, path: str, n_files: int) -> DataFrame:
    """Write numbered rows in `n_files` files per epoch, with a manifest; gives the manifest.

    Needs `epoch`, `pos` and `epoch_rows` as `plan_batches` and `batches_by_place` give them. Each file lies in a folder
    of its own, named by epoch and a whole number, and holds its rows in `pos` order. Order goes by that
    number, not by names, so there may be any number of files. The manifest is a table under the
    same path and comes from arithmetic; rows, positions and epochs (which must be consecutive) are
    observed during the write. If they are not what the positions promise, it fails and leaves no manifest. One shuffle.
    """
    if n_files < 1:
        raise ValueError("n_files must be at least 1")
    spark, observed = df.sparkSession, Observation()
    file = F.expr(f"cast(pos * {int(n_files)}L div epoch_rows as int)")
    counted = df.observe(
        observed,
        F.count("*").alias("rows"),
        F.min("epoch_rows").alias("least_rows"),
        F.max("epoch_rows").alias("epoch_rows"),
        F.min("pos").alias("first"),
        F.max("pos").alias("last"),
        F.min("epoch").alias("first_epoch"),
        F.max("epoch").alias("last_epoch"),
    )
    (
        counted.withColumn("file", file)
        .repartitionById(n_files, F.col("file"))
        .sortWithinPartitions("epoch", "file", "pos")
        .write.partitionBy("epoch", "file")
        .parquet(f"{path}/{ROWS}")
    )
    names = ["rows", "least_rows", "epoch_rows", "first", "last", "first_epoch", "last_epoch"]
    seen = observed_counts(observed, names)
    size, epochs = seen["epoch_rows"], range(seen["first_epoch"], seen["last_epoch"] + 1)
    dense = seen["least_rows"] == size and seen["first"] == 0 and seen["last"] == max(size - 1, 0)
    if not dense or seen["rows"] != size * len(epochs):
        raise ValueError(f"positions are not dense: {seen}")
    ranges = file_ranges(spark, list(epochs), size, n_files)
    ranges.repartition(1).sortWithinPartitions("epoch", "file").write.parquet(f"{path}/{MANIFEST}")
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(epoch, file, first_pos, last_pos, n_rows) of the files that `write_training_files` wrote."""
    schema = "epoch int, file int, first_pos long, last_pos long, n_rows long"
    return spark.read.schema(schema).parquet(f"{path}/{MANIFEST}")


def read_training_range(
    spark: SparkSession, path: str, epoch: int, first: int, end: int
) -> DataFrame:
    """The rows of an epoch with places from `first` up to `end`, not included, in order; `pos` tells it.

    The manifest names the files, and no others are listed or read. What part of a file is out of the range is
    left out by the files' own statistics. An empty range, or one outside the epoch, has no rows.
    """
    files = (
        read_manifest(spark, path)
        .where((F.col("epoch") == epoch) & (F.col("first_pos") < end) & (F.col("last_pos") >= first))
        .agg(F.min("file"), F.max("file"))
        .first()
    )
    rows = spark.read.parquet(f"{path}/{ROWS}")
    if files[0] is None:
        return rows.where("false").drop("file")
    inside = (F.col("epoch") == epoch) & F.col("file").between(*files)
    return rows.where(inside & (F.col("pos") >= first) & (F.col("pos") < end)).drop("file").orderBy("pos")
