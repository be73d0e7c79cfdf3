"""Column functions: they take columns and give columns, and start no job."""

from turnmill.functions.clocks import elapsed_seconds
from turnmill.functions.render import (
    is_renderable,
    make_messages,
    message_at,
    message_at_part,
    render,
    render_chatml,
    render_chatml_part,
    render_generation_prompt,
    render_part,
    render_plain,
    render_plain_part,
    render_prompt,
)
from turnmill.functions.rules import (
    has_any_term,
    has_sentences,
    in_length_band,
    within_latency,
    word_count,
)
from turnmill.functions.text import (
    completion_text,
    parse_completion,
    preview,
    py_strip,
    reply_or_error,
    strip_prompt,
)
from turnmill.functions.tokens import count_tokens, truncate_tokens

__all__ = [
    "completion_text",
    "count_tokens",
    "elapsed_seconds",
    "has_any_term",
    "has_sentences",
    "in_length_band",
    "is_renderable",
    "make_messages",
    "message_at",
    "message_at_part",
    "parse_completion",
    "preview",
    "py_strip",
    "render",
    "render_chatml",
    "render_chatml_part",
    "render_generation_prompt",
    "render_part",
    "render_plain",
    "render_plain_part",
    "render_prompt",
    "reply_or_error",
    "strip_prompt",
    "truncate_tokens",
    "within_latency",
    "word_count",
]
