"""Text helpers for stored model replies."""

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnmill.functions.columns import ColumnOrName, as_column
from turnmill.schema import COMPLETION_SCHEMA

# The characters Python's str.strip() and str.split() take as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# What a shortened text ends with, and how a failed generation is shown.
ELLIPSIS = "..."
ERROR_PREFIX = "Error generating response: "

# The same characters for use inside a regular expression's [...]. Spelled with the two
# named classes a match is ten times as fast as with the characters one by one.
WHITESPACE_CLASS = r"\s\x0b\x1c-\x1f\x85\p{Z}"


def py_strip(text: ColumnOrName) -> Column:
    """Strip whitespace at both ends as Python's str.strip() does."""
    return F.btrim(as_column(text), F.lit(WHITESPACE))


def preview(text: ColumnOrName, n: int) -> Column:
    """The first n characters, then always an ellipsis."""
    return F.concat(F.substring(as_column(text), 1, n), F.lit(ELLIPSIS))


def strip_prompt(
    output: ColumnOrName, prompt: ColumnOrName, marks: Sequence[str] = ()
) -> Column:
    """STRUCT<text, stripped>: the output without the prompt it starts with.

    An output that does not start with the prompt is left as it is. `marks` are control strings, such as
    the framing of ChatML, that decoding may have left out: each place of one in the prompt may hold the mark or
    nothing in the output. All else must be alike, character by character.
    """
    output, prompt = as_column(output), as_column(prompt)
    if marks:
        end = _aligned_end(output, prompt, marks)
        stripped = F.coalesce(end >= 0, F.lit(False))
        rest = F.substring(output, (end + 1).cast("int"), F.length(output))
    else:
        stripped = F.coalesce(F.startswith(output, prompt), F.lit(False))
        rest = F.substring(output, F.length(prompt) + 1, F.length(output))
    return F.struct(
        F.when(stripped, rest).otherwise(output).alias("text"),
        stripped.alias("stripped"),
    )


def _aligned_end(output: Column, prompt: Column, marks: Sequence[str]) -> Column:
    """How many characters of the output the prompt takes; -1 if the output does not start with it.

    The prompt is a text, then a mark and a text as often as it has marks. No text holds a mark and no mark
    begins another one, so to take each mark as soon as the output has it is right, and one walk decides.
    """
    if any(a != b and b.startswith(a) for a in marks for b in marks) or "" in marks:
        raise ValueError("a mark may not be empty or begin another one")
    any_mark = "|".join(map(re.escape, marks))
    texts = F.split(prompt, any_mark, -1)
    found = F.concat(F.array(F.lit("")), F.regexp_extract_all(prompt, F.lit(f"({any_mark})"), 1))
    pieces = F.arrays_zip(found.alias("mark"), texts.alias("text"))

    def step(at: Column, piece: Column) -> Column:
        def taken(from_: Column, text: Column) -> Column:
            return F.substring(output, (from_ + 1).cast("int"), F.length(text)) == text

        after_mark = at + F.when(taken(at, piece["mark"]), F.length(piece["mark"])).otherwise(0)
        return F.when((at >= 0) & taken(after_mark, piece["text"]), after_mark + F.length(piece["text"])).otherwise(-1)

    return F.when(output.isNotNull(), F.aggregate(pieces, F.lit(0), step))


def completion_text(choices: ColumnOrName) -> Column:
    """Text of the first choice; NULL when there is none."""
    return F.get(as_column(choices), F.lit(0))["text"]


def parse_completion(stored: ColumnOrName) -> Column:
    """The `choices` of a completion stored as JSON text."""
    return F.from_json(as_column(stored), COMPLETION_SCHEMA)["choices"]


def reply_or_error(text: ColumnOrName, error: ColumnOrName) -> Column:
    """The reply, or a line with the error of a generation that failed."""
    error = as_column(error)
    return F.when(error.isNotNull(), F.concat(F.lit(ERROR_PREFIX), error)).otherwise(
        as_column(text)
    )
