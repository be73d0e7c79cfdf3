"""Rows numbered by where they lie."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Most files whose first numbers are sent to every executor: some 20 MB.
MAX_SENT_FILES = 100_000


def read_numbered(spark: SparkSession, path: str | list[str], name: str = "row") -> tuple[DataFrame, int]:
    """Parquet files with a dense number 0..n-1 per row, and n.

    A row's number is that of its file's first row plus its place in the file; files count in the order
    of their paths. The number is the row's identity: equal rows have numbers of their own, without any digest,
    counting of copies or shuffle of rows. It stays while the files do. Counting the files' rows reads no column. A column of that
    name must not be there.
    """
    paths = [path] if isinstance(path, str) else list(path)
    table = spark.read.parquet(*paths)
    if name in table.columns:
        raise ValueError(f"the files have a column named {name}")
    file = F.col("_metadata.file_path")
    counts = table.select(file.alias("_file")).groupBy("_file").agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(
        F.col("_file").alias("_first_of"), "_rows", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_first")
    )
    files, n = firsts.agg(F.count("*"), F.sum("_rows")).first()
    if files <= MAX_SENT_FILES:
        # The same few rows for every use, and no second look at the files.
        firsts = spark.createDataFrame(firsts.collect(), firsts.schema)
        firsts = F.broadcast(firsts)
    numbered = table.select("*", file.alias("_file"), F.col("_metadata.row_index").alias("_index")).join(
        firsts.drop("_rows"), F.col("_file") == F.col("_first_of")
    )
    return numbered.select(*table.columns, (F.col("_first") + F.col("_index")).alias(name)), n or 0
