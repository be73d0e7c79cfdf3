import random

import pytest
from helpers import batch_plan

from turnmill.operators import batches, plan_batches


def plan_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[:2])


@pytest.mark.parametrize("n,steps", [(1, 1), (7, 1), (8, 1), (9, 2)])
def test_steps_per_epoch(spark, n, steps):
    rows = plan_rows(plan_batches(spark.range(n), "id"))
    assert rows == batch_plan(range(n), 3407, 3, 2, 4)
    for epoch in range(3):
        assert len({r[4] for r in rows if r[0] == epoch}) == steps


def test_every_row_once_per_epoch_in_an_order_of_its_own(spark):
    ids = [f"doc-{i}" for i in range(500)]
    df = spark.createDataFrame([(i,) for i in ids], "name string")
    rows = plan_rows(plan_batches(df, "name", seed=7, epochs=2, micro=3, accum=5))
    assert rows == batch_plan(ids, 7, 2, 3, 5)
    orders = [[r[2] for r in rows if r[0] == epoch] for epoch in range(2)]
    assert sorted(orders[0]) == sorted(orders[1]) == sorted(ids)
    assert orders[0] != orders[1]
    again = plan_rows(plan_batches(df.repartition(7), "name", seed=7, epochs=2, micro=3, accum=5))
    assert again == rows
    assert plan_rows(plan_batches(df, "name", seed=8, epochs=2, micro=3, accum=5)) != rows
    assert plan_rows(plan_batches(df, "name", 7, 2, 3, 5, distinct_keys=True)) == rows


def test_copies_get_places_of_their_own(spark, monkeypatch):
    # Shards this small spread the copies of one key as a real run would a hot one.
    monkeypatch.setattr(batches, "COPIES_PER_SHARD", 10)
    ids = [1] * 200 + [2] * 10 + [None] * 25 + list(range(3, 300))
    random.Random(3).shuffle(ids)
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    assert plan_rows(plan_batches(df, "id")) == batch_plan(ids, 3407, 3, 2, 4)


def test_key_of_several_columns(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 1)], "dataset string, id long")
    plan = plan_batches(df, ["dataset", "id"], epochs=1)
    assert plan.columns == ["epoch", "pos", "dataset", "id", "micro_batch", "step", "epoch_rows"]
    rows = plan.collect()
    assert sorted(r["pos"] for r in rows) == [0, 1, 2, 3]
    assert sorted((r["dataset"], r["id"]) for r in rows) == [("a", 1), ("a", 2), ("b", 1), ("b", 1)]


def test_empty(spark):
    assert plan_batches(spark.range(0), "id").count() == 0


def test_sizes_must_be_positive(spark):
    for sizes in ({"epochs": 0}, {"micro": 0}, {"accum": 0}):
        with pytest.raises(ValueError):
            plan_batches(spark.range(1), "id", **sizes)


def test_key_names_must_not_clash(spark):
    for key in ([], "pos", ["id", "copy"]):
        with pytest.raises(ValueError):
            plan_batches(spark.range(1).withColumnRenamed("id", "pos"), key)
