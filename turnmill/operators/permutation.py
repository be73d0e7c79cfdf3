"""Training order as arithmetic: a keyed bijection between row numbers and places.

`plan_batches` sorts keys. Where rows are numbered 0..n-1, an epoch's order can be computed instead: the
place of a row from its number, and the row at a place from the place, without a shuffle and without looking at any
other row. That makes any step of any epoch a lookup, so a run is resumed where it stopped.

Row numbers are cells of a grid of a x b >= n cells. Each round adds to one coordinate a keyed function of
the other one, which can be undone. A result outside 0..n-1 goes through the rounds again until it is
inside, which keeps the whole a bijection; fewer than a cells are outside, so that seldom happens.
"""

import math
import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.functions.columns import ColumnOrName, as_column
from turnmill.operators.batches import ACCUMULATION, EPOCHS, MICRO_BATCH, SEED
from turnmill.operators.scans import segmented_scan

# All arithmetic is modulo this prime, so that no product leaves 64 bits.
PRIME = 2**31 - 1
ROUNDS = 6
MULTIPLIER = 48271
SEED_STEP, EPOCH_STEP, ROUND_STEP = 7919, 104729, 1299709
# Most rows of an epoch: coordinates stay below the prime.
MAX_ROWS = 2**60

# Functions of this module reach the workers by value, so they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def round_keys(seed: int, epoch: int) -> list[int]:
    """The keys of an epoch's rounds."""
    keys = []
    for number in range(1, ROUNDS + 1):
        key = (seed % PRIME * SEED_STEP + epoch % PRIME * EPOCH_STEP + number * ROUND_STEP) % PRIME
        key = (key * key % PRIME * MULTIPLIER + number) % PRIME
        keys.append(key * key % PRIME)
    return keys


def grid(n: int) -> tuple[int, int]:
    """Sides a, b of the smallest grid of n cells or more with a - 1 < sqrt(n) <= a."""
    a = math.isqrt(max(n, 1) - 1) + 1
    return a, -(-max(n, 1) // a)


def _spread(value, key):
    """A keyed function of a coordinate, for numbers and arrays alike."""
    mixed = (value + key) % PRIME
    return (mixed * mixed % PRIME * MULTIPLIER + key) % PRIME


def _forth(numbers: np.ndarray, sides: tuple[int, int], keys: list[int]) -> np.ndarray:
    left, right = np.divmod(numbers, sides[1])
    for key in keys:
        left, right, sides = right, (left + _spread(right, key)) % sides[0], sides[::-1]
    return left * sides[1] + right


def _back(numbers: np.ndarray, sides: tuple[int, int], keys: list[int]) -> np.ndarray:
    left, right = np.divmod(numbers, sides[1])
    for key in reversed(keys):
        left, right, sides = (right - _spread(left, key)) % sides[1], left, sides[::-1]
    return left * sides[1] + right


def _inside(numbers: np.ndarray, n: int, seed: int, epoch: int, through) -> np.ndarray:
    """Numbers below n taken through the rounds until they are below n again."""
    sides, keys = grid(n), round_keys(seed, epoch)
    found = through(numbers, sides, keys)
    outside = np.flatnonzero(found >= n)
    while len(outside):
        found[outside] = through(found[outside], sides, keys)
        outside = outside[found[outside] >= n]
    return found


def places_of(rows: np.ndarray, n: int, epoch: int, seed: int = SEED) -> np.ndarray:
    """Places in an epoch of the rows with these numbers."""
    return _inside(rows, n, seed, epoch, _forth)


def rows_at(places: np.ndarray, n: int, epoch: int, seed: int = SEED) -> np.ndarray:
    """Numbers of the rows at these places of an epoch."""
    return _inside(places, n, seed, epoch, _back)


def _column(function, number: ColumnOrName, n: int, epoch: int, seed: int) -> Column:
    @F.pandas_udf("bigint")
    def computed(numbers: pd.Series) -> pd.Series:
        given = numbers.notna()
        known = numbers[given].to_numpy(np.int64)
        if len(known) and not 0 <= known.min() <= known.max() < n:
            raise ValueError(f"row number out of range: not within 0..{n - 1}")
        if len(known) == len(numbers):
            return pd.Series(function(known, n, epoch, seed))
        found = pd.Series(pd.NA, numbers.index, "Int64")
        found[given] = function(known, n, epoch, seed)
        return found

    return computed(as_column(number).cast("bigint"))


def place_of(row: ColumnOrName, n: int, epoch: int, seed: int = SEED) -> Column:
    """Place in an epoch of the row with a number; NULL for NULL, an error for numbers outside 0..n-1.

    Numpy over Arrow batches of the numbers alone. As an expression of Spark's, each round would hold
    the ones before it several times over as soon as a filter on the place is pushed down.
    """
    return _column(places_of, row, n, epoch, seed)


def row_at(place: ColumnOrName, n: int, epoch: int, seed: int = SEED) -> Column:
    """Number of the row at a place of an epoch: the inverse of `place_of`."""
    return _column(rows_at, place, n, epoch, seed)


def number_rows(df: DataFrame, order: Sequence[str], name: str = "row") -> DataFrame:
    """`df` with dense numbers 0..n-1 in a given order; NULL sorts first.

    The rows are range partitioned and written to the checkpoint folder when this is called, and the slices'
    sizes are added up. Rows equal in `order` are numbered in some order. For rows that need not be
    shuffled, see `read_numbered`.
    """
    return segmented_scan(df, [], order, {name: ("sum", F.lit(1).cast("bigint"))})


def batches_by_place(
    numbered: DataFrame,
    n: int,
    row: str = "row",
    seed: int = SEED,
    epochs: int = EPOCHS,
    micro: int = MICRO_BATCH,
    accum: int = ACCUMULATION,
    steps: tuple[int, int] | None = None,
) -> DataFrame:
    """Rows numbered 0..n-1 with their places: (*columns, epoch, pos, micro_batch, step, epoch_rows), once per epoch.

    A projection: nothing is shuffled or sorted. `steps` (first, end) leaves the rows of these steps of
    each epoch, such as those still to come. A column named as one of the result's is an error, and so is
    a number outside 0..n-1; a row without a number has no place.
    """
    _check(n, epochs, micro, accum)
    taken = {"epoch", "pos", "micro_batch", "step", "epoch_rows"}.intersection(numbered.columns)
    if taken:
        raise ValueError(f"columns named {sorted(taken)}")
    places = [place_of(row, n, epoch, seed).alias(f"_{epoch}") for epoch in range(epochs)]
    drawn = F.array(
        *[F.struct(F.lit(epoch).alias("epoch"), F.col(f"_{epoch}").alias("pos")) for epoch in range(epochs)]
    )
    placed = (
        numbered.where(F.col(row).isNotNull())
        .select(*numbered.columns, *places)
        .select(*numbered.columns, F.inline(drawn))
    )
    return _with_batches(placed, n, micro, accum, steps)


def rows_at_steps(
    spark: SparkSession,
    n: int,
    epoch: int,
    steps: tuple[int, int],
    seed: int = SEED,
    micro: int = MICRO_BATCH,
    accum: int = ACCUMULATION,
) -> DataFrame:
    """(epoch, pos, row, micro_batch, step, epoch_rows): which rows the steps first..end-1 take, without any table."""
    _check(n, 1, micro, accum)
    size = micro * accum
    places = spark.range(min(max(steps[0], 0) * size, n), min(max(steps[1], 0) * size, n))
    placed = places.select(
        F.lit(epoch).alias("epoch"), F.col("id").alias("pos"), row_at("id", n, epoch, seed).alias("row")
    )
    return _with_batches(placed, n, micro, accum, None)


def _check(n: int, epochs: int, micro: int, accum: int) -> None:
    if min(epochs, micro, accum) < 1:
        raise ValueError("epochs, micro and accum must be at least 1")
    if not 0 <= n <= MAX_ROWS:
        raise ValueError(f"n must be within 0..{MAX_ROWS}")


def _with_batches(
    placed: DataFrame, n: int, micro: int, accum: int, steps: tuple[int, int] | None
) -> DataFrame:
    batched = placed.withColumns(
        {
            "micro_batch": F.call_function("div", F.col("pos"), F.lit(micro)),
            "step": F.call_function("div", F.col("pos"), F.lit(micro * accum)),
            "epoch_rows": F.lit(n).cast("bigint"),
        }
    )
    return batched if steps is None else batched.where(F.col("step").between(steps[0], steps[1] - 1))
