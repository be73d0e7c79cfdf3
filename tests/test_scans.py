"""Running values against a plain walk, with groups over many slices."""

import random

import pytest
from pyspark.sql import functions as F

from turnmill.operators.scans import segmented_scan

SCHEMA = "g long, h string, n long, v long, ok boolean"
KINDS = ("sum", "bit_xor", "min", "max", "bool_and", "bool_or")


def walked(rows):
    def before(earlier, kind):
        values = [r[4] if kind.startswith("bool") else r[3] for r in earlier]
        values = [v for v in values if v is not None]
        if kind == "sum":
            return sum(values)
        if kind == "bit_xor":
            total = 0
            for value in values:
                total ^= value
            return total
        if kind in ("min", "max"):
            return {"min": min, "max": max}[kind](values, default=None)
        return all(values) if kind == "bool_and" else any(values)

    groups = {}
    for row in sorted(rows, key=lambda r: (r[2] is not None, r[2])):
        groups.setdefault(row[:2], []).append(row)
    return [
        (*row, *[before(own[:i], kind) for kind in KINDS]) for own in groups.values() for i, row in enumerate(own)
    ]


@pytest.mark.parametrize(("rows", "partitions"), [(0, 3), (1, 4), (60, 1), (700, 9), (700, 40)])
def test_running_values_are_those_of_a_walk(spark, rows, partitions):
    rng = random.Random(rows)
    # A third of the rows are one group's; some groups have no name.
    made = [
        (
            rng.choice([None, 1, 1, 2, rng.randrange(40)]),
            rng.choice([None, "a", "a"]),
            i if i else None,
            rng.choice([None, rng.randrange(-50, 50)]),
            rng.choice([None, True, True, rng.random() < 0.9]),
        )
        for i in range(rows)
    ]
    rng.shuffle(made)
    df = spark.createDataFrame(made, SCHEMA)
    measures = {
        f"{kind}_before": (kind, F.col("ok" if kind.startswith("bool") else "v")) for kind in KINDS
    }
    found = segmented_scan(df, ["g", "h"], ["n"], measures, partitions)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(walked(made), key=repr)


def test_a_measure_named_like_a_column_is_refused(spark):
    df = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError, match="v"):
        segmented_scan(df, ["g"], ["n"], {"v": ("sum", F.col("n"))})
