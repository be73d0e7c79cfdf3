"""Terms found by the automaton against a search for each."""

import random

import pytest
from helpers import executed_plan

from turnmill.operators import term_hits
from turnmill.operators.terms import BYTES_PER_TERM_BYTE, build_automaton, term_blocks


def data(n_terms):
    draw = random.Random(n_terms)

    def word(most):
        return "".join(draw.choice("abé ") for _ in range(draw.randint(1, most)))

    texts = [word(40).upper() for _ in range(60)] + ["", None, "x" * 100_000 + "needle", "İ ß"]
    return texts, ["needle", "ab", "a", "ß", *[word(6) for _ in range(n_terms)]]


@pytest.mark.parametrize(("n_terms", "max_bytes"), [(0, 10**6), (40, 10**6), (400, 10**7), (400, 4000)])
def test_hits_are_those_of_a_search_for_each_term(spark, n_terms, max_bytes):
    texts, terms = data(n_terms)
    df = spark.createDataFrame([(i, t, "mine") for i, t in enumerate(texts)], "id long, text string, _hits string")
    lowered = {r.id: r.low for r in df.selectExpr("id", "lower(text) AS low").collect()}
    found = term_hits(df, terms, max_bytes=max_bytes)
    assert found.columns == ["id", "text", "_hits", "terms"]
    for row in found.collect():
        text = lowered[row.id]
        assert row.terms == (None if text is None else sorted({t for t in terms if t in text}))


def test_terms_may_be_none_or_empty(spark):
    df = spark.createDataFrame([("a",), (None,)], "text string")
    assert [r.terms for r in term_hits(df, []).collect()] == [[], None]
    assert [r.terms for r in term_hits(df, ["", "a", "b"]).collect()] == [["", "a"], None]
    assert term_hits(df.where("false"), ["a"]).count() == 0
    with pytest.raises(ValueError, match="text"):
        term_hits(df, ["a"], output="text")


def test_blocks_hold_all_terms_within_the_bound():
    terms = {f"term{i}" * (i % 5 + 1) for i in range(500)}
    blocks = list(term_blocks(terms, 20_000))
    assert sorted(t for block in blocks for t in block) == sorted(terms)
    assert len(blocks) > 5
    assert all(sum(map(len, block)) * BYTES_PER_TERM_BYTE <= 20_000 for block in blocks)
    with pytest.raises(ValueError, match="bound"):
        list(term_blocks(["x" * 1000], 20_000))


def test_the_stated_size_of_an_automaton_is_an_upper_one():
    draw = random.Random(1)
    terms = ["".join(draw.choice("abcdefghijklmnop") for _ in range(9)) for _ in range(20_000)]
    assert len(build_automaton(terms)) <= BYTES_PER_TERM_BYTE * sum(map(len, terms))


def test_one_scan_and_no_shuffle(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    plan = executed_plan(term_hits(df, [f"term{i}" for i in range(5000)]))
    assert plan.count("FileScan") == 1
    assert "Exchange" not in plan
