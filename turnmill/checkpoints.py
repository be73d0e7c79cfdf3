"""Where lineage is cut."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Make sure checkpoint() has a folder.

    The shared folder named by `spark.checkpoint.dir` is used. Only a local
    session without that setting gets a temporary folder; on a cluster a folder
    of one machine would not survive it, so there it is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="turnmill-checkpoint-")
    context.setCheckpointDir(configured)


def new_table_path(spark: SparkSession) -> str:
    """A path of its own in the checkpoint folder."""
    use_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4()}"


def store(df: DataFrame) -> DataFrame:
    """Write a table to the checkpoint folder and read it back.

    Unlike checkpoint() this keeps columns apart, so that a later step can read
    ids without the texts next to them.
    """
    spark = df.sparkSession
    path = new_table_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
