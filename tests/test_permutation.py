"""Places as a bijection, its inverse, and what it costs."""

import random

import numpy as np
import pytest
from helpers import executed_plan
from pyspark.sql import functions as F

from turnmill.operators.permutation import (
    MULTIPLIER,
    PRIME,
    batches_by_place,
    grid,
    number_rows,
    place_of,
    places_of,
    round_keys,
    row_at,
    rows_at,
    rows_at_steps,
)
from turnmill.sources.numbered import read_numbered


def place(row, n, seed, epoch):
    """One row's place, step by step."""
    a, b = grid(n)
    while True:
        left, right, sides = row // b, row % b, (a, b)
        for key in round_keys(seed, epoch):
            mixed = (right + key) % PRIME
            moved = (left + (mixed * mixed % PRIME * MULTIPLIER + key) % PRIME) % sides[0]
            left, right, sides = right, moved, sides[::-1]
        row = left * b + right
        if row < n:
            return row


@pytest.mark.parametrize("n", [*range(1, 40), 97, 100, 101, 1000, 10_007])
def test_every_place_once(n):
    rows = np.arange(n)
    for epoch in range(3):
        found = places_of(rows, n, epoch)
        assert found.tolist() == [place(row, n, 3407, epoch) for row in range(n)]
        assert sorted(found.tolist()) == list(range(n))
        assert (rows_at(found, n, epoch) == rows).all()


@pytest.mark.parametrize(("n", "seed"), [(1, 0), (2, 5), (3, 1), (7, 3407), (50, 2**40), (1009, -3)])
def test_columns_compute_the_same_and_its_inverse(spark, n, seed):
    for epoch in (0, 1, 12345):
        rows = spark.range(n).select("id", place_of("id", n, epoch, seed).alias("p"))
        rows = rows.select("id", "p", row_at("p", n, epoch, seed).alias("back")).collect()
        assert [r.p for r in rows] == [place(r.id, n, seed, epoch) for r in rows]
        assert all(r.back == r.id for r in rows)


@pytest.mark.parametrize("n", [2**31, 2**60, 10**17 + 3])
def test_large_numbers_stay_exact(n):
    rows = np.unique(np.random.default_rng(3).integers(0, n, 2000))
    found = places_of(rows, n, 2)
    assert found.tolist() == [place(row, n, 3407, 2) for row in rows.tolist()]
    assert (rows_at(found, n, 2) == rows).all()


def test_orders_look_shuffled():
    n = 4096
    orders = [places_of(np.arange(n), n, epoch).tolist() for epoch in range(4)]
    for own in orders:
        # Neighbours do not stay neighbours, and no half of the rows stays in its half.
        assert sum(abs(x - y) == 1 for x, y in zip(own, own[1:])) < 20
        assert 900 < sum(p < n // 2 for p in own[: n // 2]) < 1150
    for first, second in zip(orders, orders[1:]):
        assert sum(x == y for x, y in zip(first, second)) < 20


def test_sides_are_exact_for_large_numbers():
    for n in (1, 2, 2**40, 2**40 - 1, 10**12 + 1, (2**20 - 1) ** 2):
        a, b = grid(n)
        assert a * b >= n > a * b - max(a, b)
        assert (a - 1) ** 2 < n <= a * a


def test_batches_and_steps(spark):
    n = 103
    df = spark.range(n).select(F.col("id").alias("row"), F.concat(F.lit("r"), "id").alias("name"))
    found = batches_by_place(df, n, seed=9, epochs=2, micro=3, accum=2).collect()
    assert sorted((r.epoch, r.pos) for r in found) == [(e, p) for e in range(2) for p in range(n)]
    assert all((r.micro_batch, r.step, r.epoch_rows) == (r.pos // 3, r.pos // 6, n) for r in found)
    later = batches_by_place(df, n, seed=9, epochs=2, micro=3, accum=2, steps=(5, 99)).collect()
    assert sorted(later) == sorted(r for r in found if r.step >= 5)
    for epoch, first, end in ((0, 0, 2), (1, 3, 40), (1, 17, 18), (0, 18, 30), (0, -4, 1)):
        asked = rows_at_steps(spark, n, epoch, (first, end), 9, 3, 2).collect()
        expected = [(r.pos, r.row, r.step) for r in found if r.epoch == epoch and first <= r.step < end]
        assert sorted((r.pos, r.row, r.step) for r in asked) == sorted(expected)


def test_nothing_is_shuffled(spark):
    plan = executed_plan(batches_by_place(spark.range(1000).withColumnRenamed("id", "row"), 1000))
    assert "Exchange" not in plan
    assert "Sort" not in plan


def test_wrong_numbers(spark):
    df = spark.createDataFrame([(0,), (None,), (1,)], "row long")
    assert batches_by_place(df, 2, epochs=1).count() == 2
    assert batches_by_place(df.where("false"), 0).count() == 0
    with pytest.raises(Exception, match="out of range"):
        batches_by_place(df, 1).collect()
    with pytest.raises(ValueError, match="pos"):
        batches_by_place(df.withColumnRenamed("row", "pos"), 2, "pos")
    for sizes in ({"epochs": 0}, {"micro": 0}, {"accum": 0}, {"n": -1}):
        with pytest.raises(ValueError):
            batches_by_place(df, **{"n": 2, **sizes})


def test_numbers_by_order(spark):
    ids = [None, *range(500)]
    random.Random(1).shuffle(ids)
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(7)
    found = {r.row: r.id for r in number_rows(df, ["id"]).collect()}
    assert found == dict(enumerate([None, *range(500)]))


@pytest.mark.parametrize("files", [1, 6])
def test_numbers_by_place_in_files(spark, tmp_path, files):
    path = str(tmp_path / "table")
    # Copies of one row, and no column that tells rows apart.
    spark.range(1000).select(F.lit("same").alias("text")).repartition(files).write.parquet(path)
    numbered, n = read_numbered(spark, path)
    assert n == 1000
    assert sorted(r.row for r in numbered.collect()) == list(range(1000))
    plan = executed_plan(numbered)
    assert "Exchange hash" not in plan and "Aggregate" not in plan
    again = read_numbered(spark, [path])[0]
    assert again.join(numbered, "row").count() == 1000
    with pytest.raises(ValueError, match="text"):
        read_numbered(spark, path, "text")


def test_numbers_with_more_files_than_are_sent(spark, tmp_path, monkeypatch):
    from turnmill.sources import numbered as module

    path = str(tmp_path / "table")
    spark.range(300).repartition(5).write.parquet(path)
    expected = sorted(map(tuple, read_numbered(spark, path)[0].collect()))
    monkeypatch.setattr(module, "MAX_SENT_FILES", 2)
    assert sorted(map(tuple, read_numbered(spark, path)[0].collect())) == expected


def test_no_files_rows(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(0).write.parquet(path)
    numbered, n = read_numbered(spark, path)
    assert (n, numbered.count()) == (0, 0)
