"""Rendering of message lists: plain Column expressions, no Python at run time.

`messages` is always ARRAY<STRUCT<role STRING, content STRING>>.
"""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnmill.functions.columns import ColumnOrName, as_column

# The ChatML framing and the labels of the plain form.
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"
PLAIN_LABELS = {"system": "System", "user": "Human", "assistant": "Assistant"}
PLAIN_SEPARATOR = "\n\n"
DEFAULT_ROLE = "user"

GENERATION_TAIL = f"{TURN_START}assistant\n"

# What a part of a conversation carries of the whole: the place of its first message, all messages, those
# shown in the plain form before the part, and what holds for the whole conversation.
FACTS = (
    "STRUCT<first: BIGINT, n_messages: BIGINT, shown_before: BIGINT, "
    "renderable: BOOLEAN, opens_with_system: BOOLEAN>"
)


def _role(message: Column) -> Column:
    return F.coalesce(message["role"], F.lit(DEFAULT_ROLE))


def _content(message: Column) -> Column:
    return F.coalesce(message["content"], F.lit(""))


def _chatml_turn(role: Column, content: Column) -> Column:
    return F.concat(F.lit(TURN_START), role, F.lit("\n"), content, F.lit(f"{TURN_END}\n"))


def render_chatml(messages: ColumnOrName, default_system: str | None = None) -> Column:
    """Render a conversation as ChatML training text.

    Content goes in as it is: nothing is trimmed and control markers inside it
    are not escaped. `default_system`, when given, is put in front of
    conversations that do not open with a system message. NULL stays NULL.
    """
    messages = as_column(messages)
    body = F.array_join(F.transform(messages, lambda m: _chatml_turn(_role(m), _content(m))), "")
    if default_system is None:
        return body
    return F.when(_opens_with_system(messages), body).otherwise(F.concat(_preamble(default_system), body))


def _opens_with_system(messages: Column) -> Column:
    return F.coalesce(F.get(messages, F.lit(0))["role"] == "system", F.lit(False))


def _preamble(default_system: str) -> Column:
    return _chatml_turn(F.lit("system"), F.lit(default_system))


def render_generation_prompt(messages: ColumnOrName, default_system: str | None = None) -> Column:
    """Render a conversation as ChatML and open the assistant's turn."""
    return F.concat(render_chatml(messages, default_system), F.lit(GENERATION_TAIL))


def render_prompt(system: ColumnOrName, user: ColumnOrName) -> Column:
    """Render a system and a user text as a prompt that opens the assistant's turn."""
    return F.concat(
        _chatml_turn(F.lit("system"), as_column(system)),
        _chatml_turn(F.lit("user"), as_column(user)),
        F.lit(GENERATION_TAIL),
    )


def is_rendered_role(role: ColumnOrName) -> Column:
    """True for roles the plain form shows; a missing role counts as the user's."""
    return F.coalesce(as_column(role), F.lit(DEFAULT_ROLE)).isin(*PLAIN_LABELS)


def render_plain(messages: ColumnOrName) -> Column:
    """Render a conversation as labelled paragraphs.

    Messages with a role other than system, user or assistant are left out. A
    missing role counts as the user's, missing content as empty text. An empty
    list gives the empty string, NULL stays NULL.
    """

    def paragraph(message: Column) -> Column:
        label = reduce(
            lambda branches, role: branches.when(_role(message) == role, PLAIN_LABELS[role]),
            list(PLAIN_LABELS)[1:],
            F.when(_role(message) == "system", PLAIN_LABELS["system"]),
        )
        return F.concat(label, F.lit(": "), _content(message))

    shown = F.filter(as_column(messages), lambda m: is_rendered_role(m["role"]))
    return F.array_join(F.transform(shown, paragraph), PLAIN_SEPARATOR)


def is_complete_message(role: ColumnOrName, content: ColumnOrName) -> Column:
    """True for a message ChatML can show: a known role and non-null content."""
    return F.coalesce(
        as_column(role).isin(*PLAIN_LABELS) & as_column(content).isNotNull(), F.lit(False)
    )


def is_renderable(messages: ColumnOrName) -> Column:
    """True for a non-empty conversation in which every message is complete."""
    messages = as_column(messages)
    complete = F.forall(messages, lambda m: is_complete_message(m["role"], m["content"]))
    return F.coalesce((F.size(messages) > 0) & complete, F.lit(False))


def render(messages: ColumnOrName, default_system: str | None = None) -> Column:
    """STRUCT<text, used_fallback>: ChatML where possible, else the plain form."""
    messages = as_column(messages)
    renderable = is_renderable(messages)
    return F.struct(
        F.when(renderable, render_chatml(messages, default_system))
        .otherwise(render_plain(messages))
        .alias("text"),
        (~renderable).alias("used_fallback"),
    )


def make_messages(system: ColumnOrName, user: ColumnOrName) -> Column:
    """Build a message list from a system and a user text."""

    def message(role: str, content: ColumnOrName) -> Column:
        return F.struct(F.lit(role).alias("role"), as_column(content).alias("content"))

    return F.array(message("system", system), message("user", user))


def message_at(messages: ColumnOrName, position: int) -> Column:
    """Content of the message at a position, counted from 0; NULL past the end."""
    return F.get(as_column(messages), F.lit(position))["content"]


def facts_of_whole(messages: ColumnOrName) -> Column:
    """FACTS of a conversation that is one part."""
    messages = as_column(messages)
    zero = F.lit(0).cast("bigint")
    return F.struct(
        zero.alias("first"),
        F.size(messages).cast("bigint").alias("n_messages"),
        zero.alias("shown_before"),
        is_renderable(messages).alias("renderable"),
        _opens_with_system(messages).alias("opens_with_system"),
    )


def render_chatml_part(
    messages: ColumnOrName, facts: ColumnOrName, default_system: str | None = None
) -> Column:
    """A part of what `render_chatml` gives for the whole conversation."""
    body, facts = render_chatml(messages), as_column(facts)
    if default_system is None:
        return body
    opens = (facts["first"] == 0) & ~facts["opens_with_system"]
    return F.when(opens, F.concat(_preamble(default_system), body)).otherwise(body)


def render_plain_part(messages: ColumnOrName, facts: ColumnOrName) -> Column:
    """A part of what `render_plain` gives for the whole conversation: with the separator in front if a
    message was shown before the part and one is shown in it."""
    messages = as_column(messages)
    shows = F.exists(messages, lambda m: is_rendered_role(m["role"]))
    goes_on = (as_column(facts)["shown_before"] > 0) & shows
    text = render_plain(messages)
    return F.when(goes_on, F.concat(F.lit(PLAIN_SEPARATOR), text)).otherwise(text)


def render_part(
    messages: ColumnOrName, facts: ColumnOrName, default_system: str | None = None
) -> Column:
    """STRUCT<text, used_fallback>: a part of what `render` gives for the whole conversation.

    Parts' texts, put together in order, are the whole's; the flag is the whole's in each.
    """
    renderable = as_column(facts)["renderable"]
    return F.struct(
        F.when(renderable, render_chatml_part(messages, facts, default_system))
        .otherwise(render_plain_part(messages, facts))
        .alias("text"),
        (~renderable).alias("used_fallback"),
    )


def message_at_part(messages: ColumnOrName, facts: ColumnOrName, position: int) -> Column:
    """Content of the message at a position of the whole conversation, in the part that holds it; else NULL."""
    at = (F.lit(position).cast("bigint") - as_column(facts)["first"]).cast("int")
    return F.when(at >= 0, F.get(as_column(messages), at)["content"])
