"""Seeded order and batch numbers for training."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The training run's seed, epochs, batch size and accumulation.
SEED = 3407
EPOCHS = 3
MICRO_BATCH = 2
ACCUMULATION = 4

# Hex digits of the order key that name a bucket: 65,536 even buckets per epoch.
BUCKET_DIGITS = 4
# Names of the result's and of working columns: a key may not have one of them.
RESERVED = frozenset(
    "epoch pos micro_batch step epoch_rows "
    "copies copy shard bucket size offset order_key place".split()
)
# Most copies of one key that a single task numbers.
COPIES_PER_SHARD = 100_000


def plan_batches(
    df: DataFrame,
    key: str | Sequence[str],
    seed: int = SEED,
    epochs: int = EPOCHS,
    micro: int = MICRO_BATCH,
    accum: int = ACCUMULATION,
    distinct_keys: bool = False,
) -> DataFrame:
    """Place every row once per epoch: (epoch, pos, *key, micro_batch, step, epoch_rows).

    `pos` runs from 0 without gaps in an order that depends on the seed, the
    epoch and the key alone; micro-batches of `micro` rows and steps of
    `micro * accum` rows count on from it, and the last ones may be short. Rows
    with equal keys are copies of one another, and each gets a place of its own.
    `distinct_keys` says that there are none, which saves counting them.

    Only keys are shuffled. The order key is a digest, so its leading digits
    split an epoch into even buckets that already lie in order: a row's position
    is the size of the buckets before its own plus its place within. No step
    sorts an epoch in one partition.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if not keys or RESERVED.intersection(keys):
        raise ValueError(f"a key is needed, and it may not be named {sorted(RESERVED)}")
    if distinct_keys:
        copies = df.select(*keys, F.expr("0L AS copy"), F.expr("1L AS copies"))
    else:
        copies = _number_copies(_count_copies(df, keys), keys)
    placed = _place(copies, keys, seed, epochs, micro, accum)
    return placed.select("epoch", "pos", *keys, "micro_batch", "step", "epoch_rows")


def place_rows(
    df: DataFrame,
    key: str,
    seed: int = SEED,
    epochs: int = EPOCHS,
    micro: int = MICRO_BATCH,
    accum: int = ACCUMULATION,
) -> DataFrame:
    """The rows of `df` next to their places, each once per epoch.

    Rows with equal keys must be equal, and keys must not be NULL. One row per
    key is shuffled and meets the key's places. Whether any key has very many
    copies is looked up when this is called, in a job over the keys; if so, such a
    key's row is repeated for every shard of its copies, and they meet shard by shard.
    """
    counted = _count_copies(df, [key])
    placed = _place(_number_copies(counted, [key]), [key], seed, epochs, micro, accum)
    others = [name for name in df.columns if name != key]
    row = df.groupBy(key).agg(*[F.first(name).alias(name) for name in others])
    columns = ["epoch", "pos", key, "micro_batch", "step", "epoch_rows", *others]

    many = F.col("copies") > COPIES_PER_SHARD
    if counted.where(many).isEmpty():
        return placed.join(row, key).select(*columns)
    usual = placed.where(~many).join(row, key)
    shards = F.explode(F.expr(f"sequence(0L, (copies - 1) div {COPIES_PER_SHARD})"))
    repeated = row.join(counted.where(many), key).withColumn("shard", shards).drop("copies")
    in_shard = F.expr(f"copy div {COPIES_PER_SHARD}")
    hot = placed.where(many).withColumn("shard", in_shard).join(repeated, [key, "shard"])
    return usual.select(*columns).unionByName(hot.select(*columns))


def _place(
    copies: DataFrame, keys: list[str], seed: int, epochs: int, micro: int, accum: int
) -> DataFrame:
    """Add epoch, bucket, place, offset, pos and batch numbers to numbered copies."""
    if min(epochs, micro, accum) < 1:
        raise ValueError("epochs, micro and accum must be at least 1")
    drawn = copies.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    drawn = drawn.withColumn("bucket", F.substring(_order_key(keys, seed), 1, BUCKET_DIGITS))

    sizes = drawn.groupBy("epoch", "bucket").agg(F.count("*").alias("size"))
    epoch = Window.partitionBy("epoch")
    earlier = epoch.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "epoch",
        "bucket",
        F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"),
        F.sum("size").over(epoch).alias("epoch_rows"),
    )

    within = Window.partitionBy("epoch", "bucket").orderBy("order_key", *keys, "copy")
    return (
        # The order key is computed after the exchange so that it is not shuffled.
        drawn.repartition("epoch", "bucket")
        .withColumn("order_key", _order_key(keys, seed))
        .withColumn("place", F.row_number().over(within))
        .join(offsets, ["epoch", "bucket"])
        .withColumn("pos", F.col("offset") + F.col("place") - 1)
        .withColumn("micro_batch", F.expr(f"pos div {int(micro)}"))
        .withColumn("step", F.expr(f"pos div {int(micro) * int(accum)}"))
    )


def _order_key(keys: list[str], seed: int) -> Column:
    """md5 of seed, epoch, key and, for further copies of the key, the copy's number."""
    named = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("epoch", *keys)]
    further = F.when(F.col("copy") > 0, F.concat(F.lit("#"), "copy"))
    first = F.concat_ws(":", F.lit(str(seed)), *named)
    return F.md5(F.concat(first, F.coalesce(further, F.lit(""))))


def _count_copies(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key; copies are counted before they are shuffled."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies"))


def _number_copies(counted: DataFrame, keys: list[str]) -> DataFrame:
    """One row per copy: the key and a number that tells its copies apart.

    A key with very many copies is spread over tasks in shards first.
    """
    usual = counted.where(F.col("copies") <= COPIES_PER_SHARD)
    many = counted.where(F.col("copies") > COPIES_PER_SHARD)

    def numbered(rows: DataFrame, first: str, last: str) -> DataFrame:
        numbers = F.explode(F.expr(f"sequence({first}, {last})"))
        return rows.select(*keys, numbers.alias("copy"), "copies")

    shards = many.withColumn(
        "shard", F.explode(F.expr(f"sequence(0L, (copies - 1) div {COPIES_PER_SHARD})"))
    ).repartition(*keys, "shard")
    return numbered(usual, "0L", "copies - 1").unionByName(
        numbered(
            shards,
            f"shard * {COPIES_PER_SHARD}",
            f"least(copies, (shard + 1) * {COPIES_PER_SHARD}) - 1",
        )
    )
