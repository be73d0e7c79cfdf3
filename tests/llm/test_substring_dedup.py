"""op10: lines and spans come from one pass, and the result does not hang on the order of rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from turnmill.llm import linking, substring_dedup
from turnmill.llm.queries import QUERIES
from turnmill.checkpoints import store
from turnmill.llm.substring_dedup import _distinct, repeated_passages, with_classes


@pytest.mark.parametrize("clash", [False, True])
def test_distinct_values_of_each_line(clash):
    rng = np.random.default_rng(4)
    line = np.sort(rng.integers(0, 50, 3000))
    # With clashes, values differ in their last bits only.
    values = rng.integers(0, 8 if clash else 1 << 62, 3000).astype(np.uint64)
    values = np.concatenate([values, values[:100]])
    line = np.concatenate([line, line[:100]])
    order = np.argsort(line, kind="stable")
    values, line = values[order], line[order]
    found = _distinct(values, line)
    assert sorted(zip(found[1].tolist(), found[0].tolist(), strict=True)) == sorted(
        set(zip(line.tolist(), values.tolist(), strict=True))
    )
    assert np.all(np.diff(found[1]) >= 0)


def test_no_values():
    none = np.zeros(0, np.int64)
    assert [len(part) for part in _distinct(none.astype(np.uint64), none)] == [0, 0]


def _texts(seed, copies):
    rng = random.Random(seed)

    def words(n):
        return " ".join(rng.choice("abcdefghij") + str(rng.randint(0, 9999)) for _ in range(n))

    shared = [words(70) for _ in range(3)]
    rows = [(i, f"{words(20)}\n{words(9)} {shared[i % 3]} {words(8)}\n{words(30)}") for i in range(copies)]
    rows += [(100 + i, "\n".join(words(12) for _ in range(4))) for i in range(20)]
    rows += [(200, None), (201, ""), (None, f"{words(6)} {shared[0]}"), (202, rows[0][1]), (202, rows[0][1])]
    return rows


def test_passages_are_the_same_for_a_shuffled_input(spark):
    df = spark.createDataFrame(_texts(1, 12), "doc_id long, text string").withColumn("n_words", F.lit(1))
    expected = sorted(map(str, repeated_passages(df).drop("n_removed", "n_spans_removed").collect()))
    for seed in (1, 2):
        dealt = df.repartition(7, F.rand(seed))
        found = repeated_passages(dealt).drop("n_removed", "n_spans_removed").collect()
        assert sorted(map(str, found)) == expected
    whose = {row.doc_id for row in repeated_passages(df).collect()}
    assert whose == {*range(12), 202, None}


def test_very_many_copies_of_a_passage_stay_whole(spark):
    copies = 600
    df = spark.createDataFrame(_texts(5, copies), "doc_id long, text string").repartition(9)
    found = repeated_passages(df).collect()
    assert {row.doc_id for row in found} >= set(range(copies))
    assert all(row.n_words >= substring_dedup.LEAST_WORDS for row in found)


@pytest.mark.parametrize("most", [1, 2, 10, 1000])
def test_classes_meet_their_rows_hot_or_not(spark, most):
    keys = [1] * 40 + [2] * 6 + [3] * 5 + [4] + [None] * 3 + [9] * 2
    rows = store(spark.createDataFrame(list(enumerate(keys)), "row long, span long"))
    classes = rows.where("span < 9").groupBy("span").agg(F.count("*").alias("n"), F.min("row").alias("one"))
    found = sorted(tuple(row) for row in with_classes(rows, classes, "span", most).collect())
    assert found == sorted((key, row, keys.index(key)) for row, key in enumerate(keys) if key in (1, 2, 3, 4))
    none = with_classes(rows, classes.where("false"), "span", most)
    assert none.count() == 0 and none.columns == ["span", "row", "one"]


def test_near_copies_with_other_near_copies_close_by(spark):
    """Two groups of 150 lines each: alike inside, and too far apart for a link although they share most words."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    other = list(base)
    for i in range(0, 120, 12):
        other[i] = f"x{i}"
    rows = []
    for number, words in enumerate((base, other)):
        for copy in range(150):
            own = list(words)
            own[rng.randrange(120)] = f"own{number}-{copy}"
            rows.append((number * 1000 + copy, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = substring_dedup.find_paragraphs(df)
    classes = substring_dedup.repeated_paragraphs(df, found).collect()
    named = {row.doc_id: row.class_id for row in classes}

    def shingles(text):
        words = text.split()
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    sets = {doc: shingles(text) for doc, text in rows}
    label = {doc: doc for doc, _ in rows}

    def root(doc):
        while label[doc] != doc:
            doc = label[doc]
        return doc

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                label[root(b)] = root(a)
    assert set(named) == set(sets)
    for a in sets:
        for b in sets:
            assert (named[a] == named[b]) == (root(a) == root(b))


def test_op10_covers_repeated_windows(spark, sf_dir):
    """Held against all 51-word windows that are in two rows or more: every such document is found."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    size = substring_dedup.SPAN + substring_dedup.SPAN_CHOICE - 1
    lower = {c: c + 32 for c in range(65, 91)}
    seen: dict[tuple, set] = {}
    for row in rows:
        words = "".join(" " if c in "\t\n\v\f\r" else c for c in (row.text or "")).translate(lower).split(" ")
        words = [word for word in words if word]
        for i in range(len(words) - size + 1):
            seen.setdefault(tuple(words[i : i + size]), set()).add(row.doc_id)
    repeated = set().union(*[ids for ids in seen.values() if len(ids) > 1])
    found = {row.doc_id for row in QUERIES["op10_substring_dedup"](spark, sf_dir).collect()}
    assert repeated and repeated <= found


def test_entries_that_several_batches_give_are_one(spark):
    """A set in many batches gives its entries each time; pairs of sets are not multiplied by that."""
    entries = spark.createDataFrame(
        [(token, node, 40 + node, 0, shards) for token, shards in ((1, 1), (2, 4)) for node in (1, 2, 3, 5, 6)] * 30,
        "token long, node long, n int, pos int, shards int",
    ).repartition(7)
    shared = linking._shared_lists(entries)
    found = sorted((row.token, row.node) for row in shared.collect())
    assert found == [(token, node) for token in (1, 2) for node in (1, 2, 3, 5, 6)]
