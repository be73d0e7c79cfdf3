"""Prompts cut off outputs that were decoded without control strings."""

import random
import re

import pytest
from pyspark.sql import functions as F

from turnmill.functions import strip_prompt

MARKS = ("<s>", "<e>")


def aligned(output, prompt):
    """All ways to leave out marks, tried one after the other."""
    pieces = re.split("(<s>|<e>)", prompt)

    def ends(at, i):
        if i == len(pieces):
            yield at
        elif i % 2:
            if output.startswith(pieces[i], at):
                yield from ends(at + len(pieces[i]), i + 1)
            yield from ends(at, i + 1)
        elif output.startswith(pieces[i], at):
            yield from ends(at + len(pieces[i]), i + 1)

    return max(ends(0, 0), default=None)


def cases():
    draw = random.Random(8)
    pieces = ["<s>", "<e>", "a", "é\n", "b<", ">", "😀"]
    for _ in range(3000):
        prompt = [draw.choice(pieces) for _ in range(draw.randrange(7))]
        shown = [p for p in prompt if p not in MARKS or draw.random() < 0.5]
        if draw.random() < 0.2 and shown:
            shown[draw.randrange(len(shown))] = draw.choice(pieces)
        yield "".join(shown) + draw.choice(["", "reply", "a", "é"]), "".join(prompt)


def test_alignment_is_that_of_all_ways(spark):
    rows = [*cases(), ("x", ""), ("", ""), ("", "<s>"), (None, "a"), ("a", None), (None, None)]
    df = spark.createDataFrame(rows, "output string, prompt string")
    for row in df.select("*", strip_prompt("output", "prompt", MARKS).alias("cut")).collect():
        end = None if None in (row.output, row.prompt) else aligned(row.output, row.prompt)
        expected = (row.output, False) if end is None else (row.output[end:], True)
        # "b<" and marks may together read as other marks; there the first reading counts.
        if "b<" not in (row.prompt or "") + (row.output or ""):
            assert tuple(row.cut) == expected, row


@pytest.mark.parametrize("marks", [(), MARKS])
def test_a_whole_prompt_is_cut_with_and_without_marks(spark, marks):
    df = spark.createDataFrame([("<s>u<e>reply", "<s>u<e>"), ("u<e>reply", "v")], "o string, p string")
    found = [tuple(r.c) for r in df.select(strip_prompt("o", "p", marks).alias("c")).collect()]
    assert found == [("reply", True), ("u<e>reply", False)]


def test_marks_that_begin_others_are_refused():
    for marks in (("<e>", "<e>>"), ("",)):
        with pytest.raises(ValueError, match="mark"):
            strip_prompt("o", "p", marks)


def test_long_prompts(spark):
    turn = "<s>user\n" + "word " * 2000 + "<e>\n"
    df = spark.range(3).select(F.lit(turn * 40).alias("p"))
    bare = F.concat(F.regexp_replace("p", "<[se]>", ""), F.lit("reply"))
    cut = df.select(strip_prompt(bare, "p", MARKS).alias("c")).collect()
    assert [tuple(r.c) for r in cut] == [("reply", True)] * 3
