"""Running values over groups of any size.

A window over a group runs in one task, whatever the group's size. Here the rows are range
partitioned by group and order, so that a large group is spread over many slices. Each slice is
summed up, the sums run from slice to slice, and a row's value is what its group's
earlier slices come to plus what comes before the row in its own slice.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnmill.checkpoints import store

# What can be carried from slice to slice, with the value before the first row.
CARRIED = {
    "sum": (F.sum, 0),
    "bit_xor": (F.bit_xor, 0),
    "min": (F.min, None),
    "max": (F.max, None),
    "bool_and": (F.bool_and, True),
    "bool_or": (F.bool_or, False),
}
SLICE = "_slice"


def segmented_scan(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    measures: Mapping[str, tuple[str, Column]],
    partitions: int | None = None,
) -> DataFrame:
    """`df` with a column per measure: the running value over the rows before, in the row's group.

    `measures` names a kind of CARRIED and the column it runs over; the row's own value is not part
    of it. The first row of a group has 0 for sums, True or False for verdicts, NULL for min
    and max. NULL is a group of its own and sorts first; values of rows that are equal in `order` are taken in
    some order, so `order` should tell rows apart or such rows should be alike. No column of `df` may have
    a measure's name.

    The rows are shuffled and written to the checkpoint folder when this is called, since both sides of
    the sum must see the same slices. Only groups that go on from slice to slice have sums to carry; there
    is one such row per slice at most, so these are broadcast.
    """
    taken = {SLICE, *measures}.intersection(df.columns)
    if taken:
        raise ValueError(f"df has columns named {sorted(taken)}")
    group, order = list(group), list(order)
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = store(
        df.repartitionByRange(partitions, *group, *order).withColumn(SLICE, F.spark_partition_id())
    )
    carried = _carried(slices, group, measures)
    within = Window.partitionBy(*group, SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    running = slices.withColumns(
        {name: CARRIED[kind][0](value).over(within) for name, (kind, value) in measures.items()}
    )
    same = [F.col(name).eqNullSafe(F.col(f"_carried_{name}")) for name in [*group, SLICE]]
    joined = running.join(F.broadcast(carried), same, "left")
    return joined.select(
        *df.columns, *[_combined(name, kind).alias(name) for name, (kind, _) in measures.items()]
    )


def _carried(slices: DataFrame, group: list[str], measures: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """What each group brings into each slice after its first."""
    sums = slices.groupBy(*group, SLICE).agg(
        *[CARRIED[kind][0](value).alias(name) for name, (kind, value) in measures.items()]
    )
    by_slice = Window.partitionBy(*group).orderBy(SLICE)
    earlier = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(
        *[F.col(name).alias(f"_carried_{name}") for name in [*group, SLICE]],
        F.row_number().over(by_slice).alias("_nth"),
        *[CARRIED[kind][0](name).over(earlier).alias(f"_carried_{name}") for name, (kind, _) in measures.items()],
    ).where("_nth > 1").drop("_nth")


def _combined(name: str, kind: str) -> Column:
    own, carried = F.col(name), F.col(f"_carried_{name}")
    start = CARRIED[kind][1]
    if start is not None:
        own, carried = F.coalesce(own, F.lit(start)), F.coalesce(carried, F.lit(start))
    if kind == "sum":
        return own + carried
    if kind == "bit_xor":
        return own.bitwiseXOR(carried)
    if kind in ("min", "max"):
        return F.least(own, carried) if kind == "min" else F.greatest(own, carried)
    return (own & carried) if kind == "bool_and" else (own | carried)
