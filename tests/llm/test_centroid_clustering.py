"""The tournament against every distance, and the registered query against its SQL."""

import hashlib
import random

import duckdb
import numpy as np
import pytest

from turnmill.llm.centroid_clustering import Bisectors, cluster_vectors, largest_component
from turnmill.llm.queries import ORACLE_SQL, QUERIES

SCHEMA = "vec_id long, embedding array<double>, cluster string, vector int"


def test_tournament_gives_the_nearest_centroid_and_ties_to_the_smaller_number():
    rng = np.random.default_rng(5)
    for k in (1, 2, 3, 8, 40):
        centroids = rng.integers(-6, 6, (k, 3))
        centroids[-1] = centroids[0]
        vectors = rng.integers(-7, 7, (3000, 3))
        apart = ((vectors[:, None, :] - centroids[None]) ** 2).sum(axis=2)
        nearest = Bisectors(centroids).nearest(vectors)
        assert (nearest == apart.argmin(axis=1)).all()
        assert (Bisectors(centroids).distances(vectors, nearest) == apart.min(axis=1)).all()


def test_tournament_is_exact_for_the_largest_components():
    most = largest_component(4)
    centroids = np.array([[most] * 4, [-most] * 4, [most - 1] * 4])
    vectors = np.array([[most] * 4, [-most] * 4, [most - 1] * 4, [0] * 4])
    assert Bisectors(centroids).nearest(vectors).tolist() == [0, 1, 2, 2]
    assert Bisectors(centroids).distances(vectors, np.array([1, 0, 0, 0])).tolist() == [
        16 * most * most,
        16 * most * most,
        4,
        4 * most * most,
    ]


def naive(rows, clusters, rounds, components, scale):
    kept = []
    for vec_id, values in rows:
        if values is not None and len(values) == components and None not in values:
            if all(abs(x) < 1e6 for x in values):
                kept.append((vec_id, [int(np.floor(scale * x)) for x in values]))

    def seed(row):
        return (row[0] is None, hashlib.sha256(f"3:{row[0]}".encode()).hexdigest(), row[1])

    centroids = [list(v) for _, v in sorted(kept, key=seed)[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for k, own in groups.items():
            centroids[k] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    found = [(vec_id, *nearest(v)) for vec_id, v in kept]
    total = sum(d for _, d, _ in found)
    inertia = {k: sum(d for _, d, own in found if own == k) for _, _, k in found}
    return [
        (i, k, d, inertia[k], total, hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest())
        for i, d, k in found
    ]


@pytest.mark.parametrize(("clusters", "partitions"), [(1, 1), (5, 3), (8, 7)])
def test_clusters_are_those_of_the_plain_algorithm(spark, clusters, partitions):
    rng = random.Random(clusters)
    rows = [(i, [rng.choice((-1, 1)) * rng.random() for _ in range(4)]) for i in range(200)]
    rows += [(200 + i, rows[3][1]) for i in range(100)] + [(3, rows[3][1]), (3, rows[4][1]), (None, rows[5][1])]
    rows += [(900, None), (901, []), (902, [1.0]), (903, [0.0] * 5), (904, [0.0, None, 0.0, 0.0])]
    rows += [(905, [float("nan"), 0.0, 0.0, 0.0]), (906, [float("inf")] * 4), (907, [1e300, 0.0, 0.0, 0.0])]
    rows += [(908, [-0.0, 1e-9, -1e-9, 0.5])]
    df = spark.createDataFrame([(*row, "x", 1) for row in rows], SCHEMA).repartition(partitions)
    found = cluster_vectors(df, clusters, rounds=4, components=4)
    expected = naive(rows, clusters, 4, 4, 1024)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


def test_fewer_vectors_than_centroids_and_none(spark):
    df = spark.createDataFrame([(1, [0.5], "", 0), (2, [0.25], "", 0), (2, None, "", 0)], SCHEMA)
    assert [row.distance for row in cluster_vectors(df, components=1).collect()] == [0, 0]
    none = cluster_vectors(df.where("false"), components=1)
    assert none.count() == 0
    assert none.columns == cluster_vectors(df, components=1).columns


def test_an_inertia_beyond_a_long_is_null(spark):
    most = largest_component(1) / 1024
    rows = [(i, [x], "", 0) for i, x in enumerate([most, -most] * 5)]
    found = cluster_vectors(spark.createDataFrame(rows, SCHEMA), 1, rounds=1, components=1).collect()
    assert {row.inertia for row in found} == {None}
    assert all(row.distance > 10**17 for row in found)


def test_too_many_clusters_are_refused(spark):
    df = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError, match="clusters"):
        cluster_vectors(df, 1000)


def test_query_matches_sql(spark, sf_dir):
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    result = QUERIES["op11_centroid_clustering"](spark, sf_dir)
    expected = duck.sql(ORACLE_SQL["op11_centroid_clustering"])
    columns = sorted(result.columns)
    assert columns == sorted(expected.columns)
    rows = [tuple(row) for row in result.select(*columns).collect()]
    assert sorted(rows) == sorted(expected.select(*columns).fetchall())
    assert len(rows) == spark.read.parquet(f"{sf_dir}/embeddings.parquet").count()
