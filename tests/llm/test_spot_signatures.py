"""Fingerprints against a plain version that goes word by word; the order of rows over partitions."""

import hashlib
import random
import re
from itertools import islice

import numpy as np
import pyarrow as pa
import pytest
from helpers import executed_plan

from turnmill.llm.queries import QUERIES
from turnmill.llm.spot_signatures import (
    COMMON_WORDS,
    edited,
    fingerprint,
    fingerprint_documents,
    length_partition,
    likeness,
    read_fingerprint,
    spot_sets,
)

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, part int, fingerprint string"


def spots(text):
    """The chains themselves, as tuples of words."""
    words = WORD.findall(text.translate(LOWER))
    common, found, since = set(COMMON_WORDS), set(), 0
    for place, word in enumerate(words):
        since = 0 if word in common else since + 1
        if word in common or since > 8:
            chain = list(islice((words[i] for i in range(place + 1, len(words)) if words[i] not in common), 2))
            if len(chain) == 2:
                found.add((word, *chain))
    if not found:
        size = min(3, len(words))
        found = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else {text} - {""}
    return found


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def texts(seed=1):
    rng = random.Random(seed)
    vocabulary = [*COMMON_WORDS, *[f"w{i}" for i in range(60)], "É", "the.", "THE", "x-ray", "日本"]
    made = [None, "", " \n", "!!!", "???", "one", "the", "the of", "the cat", "the cat sat", "w1 w2 w3 w4", "😀" * 30]
    made += [" ".join(f"z{i}" for i in range(40)), "the " * 500, "w1 " * 500, "a\x00b the\nw1\tw2"]
    for _ in range(25):
        own = [rng.choice(vocabulary) for _ in range(rng.randint(1, 150))]
        made.append(" ".join(own))
        own[rng.randrange(len(own))] = "changed"
        made.append(" ".join(own))
    return [*made, made[-1], "long " * 60_000 + "the end of it"]


def test_spots_are_those_of_a_walk_over_the_words():
    column = texts()
    found = spot_sets(pa.array(column, pa.string()))
    expected = [spots(text or "") for text in column]
    for i, own in enumerate(expected):
        assert len(found.of(i)) == len(own), column[i]
        assert (read_fingerprint(fingerprint(found.of(i))) == found.of(i)).all()
    for i, left in enumerate(expected):
        for j, right in enumerate(expected):
            assert likeness(found.of(i), found.of(j)) == jaccard(left, right)


def test_a_pruned_comparison_loses_nothing_at_its_limit():
    rng = np.random.default_rng(2)
    for _ in range(3000):
        pool = rng.permutation(400).astype(np.uint32)
        size, common, extra = rng.integers(0, 150, 3)
        left = np.sort(pool[: size + common])
        right = np.sort(pool[size : size + common + min(extra, size)])
        alike = jaccard(set(left.tolist()), set(right.tolist()))
        assert likeness(left, right) == alike
        for least in (0.3, 0.8, 1.0, alike):
            assert likeness(left, right, least) == (alike if alike >= least else 0.0)
        if alike >= 0.8:
            assert abs(length_partition(len(left), 0.8) - length_partition(len(right), 0.8)) <= 1


def expected_rows(rows):
    """Rows in order; equal ids are ordered by a hash of Spark's, given as third value."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0], r[2]))
    found = []
    for (doc_id, text, _), (_, following, _) in zip(rows, [*rows[1:], *rows[:1]], strict=True):
        text, following = text or "", following or ""
        changed = edited(text, following)
        half = len(text) // 2
        assert changed == text[: len(text) - half] + following[: min(half, len(following))]
        own = spots(text)
        found.append(
            (
                doc_id,
                len(text),
                hashlib.sha256(changed.encode()).hexdigest(),
                len(own),
                jaccard(own, spots(changed)),
                jaccard(own, spots(following)),
            )
        )
    return found


def compared(df):
    columns = ["doc_id", "n_chars", "edited_sha256", "n_spots", "near_edited", "near_next"]
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize(("partitions", "written"), [(1, 1), (5, 3), (40, 6)])
def test_rows_meet_the_next_across_partitions(spark, partitions, written):
    rows = [(i * 3, text) for i, text in enumerate(texts(partitions))]
    random.Random(0).shuffle(rows)
    rows += [(None, "w1 the w2 w3"), (None, None), (6, "of two words"), (6, "of three more words"), (6, "of two words")]
    df = spark.createDataFrame([(*row, 7, "mine") for row in rows], SCHEMA).repartition(written)
    hashed = [tuple(r) for r in df.selectExpr("doc_id", "text", "xxhash64(text)").collect()]
    found = fingerprint_documents(df, partitions)
    assert compared(found) == sorted(expected_rows(hashed), key=repr)
    by_text = {}
    for row in found.join(df.select("doc_id", "text").distinct().dropDuplicates(["doc_id"]), "doc_id").collect():
        if row.doc_id != 6:
            by_text.setdefault(row.text or "", set()).add(row.fingerprint)
    assert all(len(own) == 1 for own in by_text.values())


def test_one_row_is_its_own_next_and_no_rows_give_none(spark):
    df = spark.createDataFrame([(4, "the cat sat on the mat here", 0, "")], SCHEMA)
    (row,) = fingerprint_documents(df).collect()
    assert row.near_next == 1.0
    assert row.doc_id == 4
    assert fingerprint_documents(df.where("false")).count() == 0


def test_the_texts_are_shuffled_once(spark, sf_dir):
    plan = executed_plan(QUERIES["op12_spot_signatures"](spark, sf_dir)).split("Initial Plan")[0]
    assert plan.count("ReusedExchange") >= 3
    assert "CartesianProduct" not in plan


def test_query_over_all_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    hashed = [tuple(r) for r in docs.selectExpr("doc_id", "text", "xxhash64(text)").collect()]
    assert compared(QUERIES["op12_spot_signatures"](spark, sf_dir)) == sorted(expected_rows(hashed), key=repr)
