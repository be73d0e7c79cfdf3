"""From turns to numbered training rows."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnmill.checkpoints import new_table_path, store
from turnmill.functions.render import (
    is_complete_message,
    is_rendered_role,
    render,
    render_chatml,
    render_plain,
)
from turnmill.functions.tokens import MAX_TOKENS, Spans, count_tokens, truncate_tokens
from turnmill.operators.batches import ACCUMULATION, EPOCHS, MICRO_BATCH, SEED, place_rows, plan_batches
from turnmill.operators.conversations import (
    MAX_LONG_IDS,
    PART_TURNS,
    TURN_ORDER,
    fold_turns,
    leading_turns,
    split_by_length,
)
from turnmill.operators.custom import Formatter, render_or_fall_back
from turnmill.operators.permutation import batches_by_place
from turnmill.schema import MESSAGES
from turnmill.sources.numbered import read_numbered


def training_text(
    turns: DataFrame,
    max_tokens: int = MAX_TOKENS,
    long_turns: int = PART_TURNS,
    max_long_ids: int = MAX_LONG_IDS,
    spans: Spans | None = None,
    default_system: str | None = None,
) -> DataFrame:
    """Render each conversation and cut it: (conv_id, text, used_fallback).

    The same as folding, rendering and truncating whole conversations. One with
    more than `long_turns` turns is narrowed to its first `max_tokens + 1`
    rendered messages before it is folded. That leaves its text as it is: every
    rendered message has a token at least, so the cut falls before the last one. With `spans`, a
    caller's tokenizer (see `truncate_tokens`), it is narrowed further to the messages that begin within the
    token limit, by a running sum of their contents' tokens; a content must not have fewer tokens
    within the rendered text than alone. `default_system` is put before ChatML texts that open without a system message.
    """
    usual, long = split_by_length(turns, long_turns, max_long_ids)
    rendered = []
    if usual is not None:
        shown = fold_turns(usual).withColumn("shown", render("messages", default_system))
        rendered.append(shown.select("conv_id", "shown.text", "shown.used_fallback"))
    if long is not None:
        rendered.append(_render_long(long, max_tokens, spans, default_system))
    texts = reduce(DataFrame.unionByName, rendered)
    return texts.withColumn("text", truncate_tokens("text", max_tokens, spans))


def _render_long(
    turns: DataFrame, max_tokens: int, spans: Spans | None, default_system: str | None
) -> DataFrame:
    # Whether ChatML can show a conversation depends on all its turns, shown or not.
    verdicts = turns.groupBy(F.col("conv_id").alias("id")).agg(
        F.bool_and(is_complete_message("role", "text")).alias("renderable")
    )
    leading = leading_turns(turns.where(is_rendered_role("role")), max_tokens + 1)
    if spans is not None:
        leading = _within_budget(leading, max_tokens, spans)
    folded = fold_turns(leading)
    nothing_shown = F.array().cast(MESSAGES)
    messages = F.coalesce("messages", nothing_shown)
    chatml = render_chatml(messages, default_system)
    text = F.when(F.col("renderable"), chatml).otherwise(render_plain(messages))
    return verdicts.join(folded, F.col("id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("id").alias("conv_id"),
        text.alias("text"),
        (~F.col("renderable")).alias("used_fallback"),
    )


def _within_budget(leading: DataFrame, max_tokens: int, spans: Spans) -> DataFrame:
    """Of each conversation's leading turns, those before which at most `max_tokens` tokens lie.

    There are `max_tokens + 1` turns of a conversation at most, whatever its length. What is left of one that was
    cut has more than `max_tokens` tokens, so the cut of its text falls within.
    """
    earlier = Window.partitionBy("conv_id").orderBy(*TURN_ORDER).rowsBetween(
        Window.unboundedPreceding, -1
    )
    counted = leading.withColumn("tokens", F.coalesce(count_tokens("text", spans), F.lit(0)))
    before = counted.withColumn("before", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)))
    return before.where(F.col("before") <= max_tokens).drop("tokens", "before")


def training_rows(
    turns: DataFrame,
    max_tokens: int = MAX_TOKENS,
    seed: int = SEED,
    epochs: int = EPOCHS,
    micro: int = MICRO_BATCH,
    accum: int = ACCUMULATION,
    spans: Spans | None = None,
    default_system: str | None = None,
) -> DataFrame:
    """Training texts with their places: what `write_training_text` takes.

    The text is shuffled once, to fold it by conversation; the order is worked
    out on ids alone and then joined to the folded rows where they are.
    """

    def texts_of(rows: DataFrame) -> DataFrame:
        return training_text(rows, max_tokens, spans=spans, default_system=default_system)

    ids = turns.select("conv_id").distinct()
    order = plan_batches(ids, "conv_id", seed, epochs, micro, accum, distinct_keys=True)
    rows = order.join(texts_of(turns.where("conv_id IS NOT NULL")), "conv_id")
    # A plain join finds no partner for a missing id; a null-safe one would shuffle every
    # text again. Turns without an id form one conversation, joined apart if there are any.
    missing = turns.where("conv_id IS NULL")
    if missing.isEmpty():
        return rows
    text = texts_of(missing).withColumnRenamed("conv_id", "text_id")
    same_id = F.col("conv_id").eqNullSafe(F.col("text_id"))
    return rows.unionByName(
        order.where("conv_id IS NULL").join(text, same_id).drop("text_id")
    )


def _message_texts(
    conversations: DataFrame,
    max_tokens: int,
    spans: Spans | None,
    default_system: str | None,
    formatter: Formatter | None,
) -> DataFrame:
    """(text, used_fallback) of conversations that are one row each; rows without messages are left out."""
    readable = conversations.where("messages IS NOT NULL").select("messages")
    if formatter is None:
        shown = readable.select(render("messages", default_system).alias("shown")).select("shown.*")
    else:
        shown = render_or_fall_back(readable, formatter).select("text", "used_fallback")
    return shown.withColumn("text", truncate_tokens("text", max_tokens, spans))


def training_rows_from_messages(
    conversations: DataFrame,
    max_tokens: int = MAX_TOKENS,
    seed: int = SEED,
    epochs: int = EPOCHS,
    micro: int = MICRO_BATCH,
    accum: int = ACCUMULATION,
    spans: Spans | None = None,
    default_system: str | None = None,
    formatter: Formatter | None = None,
) -> DataFrame:
    """As `training_rows`, for conversations that already are one row each, as read
    from JSON Lines: (epoch, pos, text_id, micro_batch, step, epoch_rows, text, used_fallback).

    Such rows have no id, so a digest of the text stands in, which makes the
    order independent of how the files are split. Conversations with equal texts
    all stay, each with places of its own. A row without messages, such as a line that is not JSON, is no conversation
    and gets no place; `parse_conversations` keeps and counts them. A caller's `formatter` takes the
    place of ChatML (see `render_or_fall_back`).

    The rendered texts are written to the checkpoint folder when this is called,
    so that the source is parsed once and the order is worked out on ids alone.
    """
    texts = _message_texts(conversations, max_tokens, spans, default_system, formatter)
    texts = texts.withColumn("text_id", F.coalesce(F.sha2("text", 256), F.lit("")))
    return place_rows(store(texts), "text_id", seed, epochs, micro, accum)


def training_rows_by_place(
    conversations: DataFrame,
    max_tokens: int = MAX_TOKENS,
    seed: int = SEED,
    epochs: int = EPOCHS,
    micro: int = MICRO_BATCH,
    accum: int = ACCUMULATION,
    spans: Spans | None = None,
    default_system: str | None = None,
    formatter: Formatter | None = None,
    steps: tuple[int, int] | None = None,
) -> DataFrame:
    """As `training_rows_from_messages`, with rows known by where they lie:
    (text, used_fallback, row, epoch, pos, micro_batch, step, epoch_rows).

    The rendered texts are written to the checkpoint folder when this is called, and a row's number there is its
    identity; its places follow from that by arithmetic (`batches_by_place`). Texts are neither
    shuffled, sorted nor compared, and equal ones are rows like any other. The order depends on how
    the input is split, and is the same as long as that is. `steps` (first, end) gives these steps only.
    """
    path = new_table_path(conversations.sparkSession)
    texts = _message_texts(conversations, max_tokens, spans, default_system, formatter)
    texts.write.parquet(path)
    numbered, n = read_numbered(conversations.sparkSession, path)
    return batches_by_place(numbered, n, "row", seed, epochs, micro, accum, steps)
