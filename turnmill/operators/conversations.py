"""Folding a flat table of turns into one message list per conversation.

A conversation's messages end up in one row, so its rows have to meet in one
task. For the usual conversation that is a handful of rows. One that holds a
large share of the table (a default or missing id, say) would be more than a
task or a row can take, so such conversations are found first, by counting
ids, and are handled apart: `assemble_messages` gives them in numbered parts,
`leading_turns` narrows them down before they are folded.

Turns are ordered by turn number; equal numbers by role, then by text.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnmill.checkpoints import store, use_checkpoint_dir
from turnmill.functions.columns import ColumnOrName, as_column
from turnmill.functions.render import facts_of_whole, is_complete_message, is_rendered_role
from turnmill.operators.scans import segmented_scan

TURN_ORDER = ("turn", "role", "text")

# Most messages one row may hold.
PART_TURNS = 10_000
# Most long conversations whose ids are sent to every executor.
MAX_LONG_IDS = 10_000
# How many groups a long conversation's leading turns are gathered in before the last step.
GATHER_GROUPS = 1024


def split_by_length(
    turns: DataFrame, max_turns: int, max_long_ids: int = MAX_LONG_IDS, max_bytes: int | None = None
) -> tuple[DataFrame | None, DataFrame | None]:
    """Turns of conversations with up to `max_turns` turns, and of longer ones.

    With `max_bytes`, those with more bytes of roles and texts are long as well; that reads the texts.

    Either is None when there are no such turns to set apart. Runs one job over the id
    column: a partial count per task, then a shuffle of counts. The ids of long
    conversations are broadcast while there are at most `max_long_ids` of them;
    with more, all turns are given as long, which is slower but always right.
    """
    measured = {"turns": F.count("*")}
    is_long = F.col("turns") > max_turns
    if max_bytes is not None:
        measured["bytes"] = F.sum(message_bytes())
        is_long |= F.col("bytes") > max_bytes
    lengths = turns.groupBy("conv_id").agg(*[value.alias(name) for name, value in measured.items()])
    long_ids = lengths.where(is_long).select("conv_id")
    found = long_ids.limit(max_long_ids + 1).collect()
    if not found:
        return turns, None
    if len(found) > max_long_ids:
        return None, turns
    ids = turns.sparkSession.createDataFrame(found, long_ids.schema)
    ids = F.broadcast(ids.withColumnRenamed("conv_id", "long_id"))
    is_long = F.col("conv_id").eqNullSafe(F.col("long_id"))
    return turns.join(ids, is_long, "left_anti"), turns.join(ids, is_long, "left_semi")


def fold_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, messages), all turns of a conversation in one row. One shuffle.

    Collecting before the shuffle would not make it smaller, only sort each task's
    turns once more, so they are shuffled as they are.
    """
    folded = turns.repartition("conv_id").groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct(*TURN_ORDER))).alias("turns")
    )
    return folded.select("conv_id", F.transform("turns", _message).alias("messages"))


def _message(turn: Column) -> Column:
    return F.struct(turn["role"].alias("role"), turn["text"].alias("content"))


def assemble_messages(
    turns: DataFrame, part_turns: int = PART_TURNS, max_long_ids: int = MAX_LONG_IDS
) -> DataFrame:
    """Fold turns into messages: (conv_id, part, messages).

    A conversation of up to `part_turns` turns is one row, with part 0. A longer
    one comes as consecutive parts of `part_turns` messages, the last one
    shorter, so every row stays bounded and no message is lost.
    """
    usual, long = split_by_length(turns, part_turns, max_long_ids)
    folded = []
    if usual is not None:
        whole = fold_turns(usual).withColumn("part", F.lit(0).cast("bigint"))
        folded.append(whole.select("conv_id", "part", "messages"))
    if long is not None:
        folded.append(_fold_in_parts(long, part_turns))
    return reduce(DataFrame.unionByName, folded)


def _fold_in_parts(turns: DataFrame, part_turns: int) -> DataFrame:
    """Number the turns of long conversations and fold each run of `part_turns`.

    Copies of a turn are counted before they are shuffled. The distinct turns
    are range partitioned in conversation order, which splits a long
    conversation over many slices; a turn's number is the size of the slices
    before its own plus its place within. The slices are checkpointed because
    both sides of that sum must see the same ones.
    """
    use_checkpoint_dir(turns.sparkSession)
    slices = (
        turns.groupBy("conv_id", *TURN_ORDER)
        .agg(F.count("*").alias("copies"))
        .repartitionByRange("conv_id", *TURN_ORDER)
        .withColumn("slice", F.spark_partition_id())
        .checkpoint()
    )
    sizes = slices.groupBy("conv_id", "slice").agg(F.sum("copies").alias("size"))
    earlier = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sizes.select(
        F.col("conv_id").alias("offset_id"),
        F.col("slice").alias("offset_slice"),
        F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset"),
    )
    within = Window.partitionBy("conv_id", "slice").orderBy(*TURN_ORDER).rowsBetween(
        Window.unboundedPreceding, -1
    )
    numbered = (
        slices.withColumn("place", F.coalesce(F.sum("copies").over(within), F.lit(0)))
        .join(
            offsets,
            F.col("conv_id").eqNullSafe(F.col("offset_id"))
            & (F.col("slice") == F.col("offset_slice")),
        )
        .withColumn("first", F.col("offset") + F.col("place"))
        .withColumn("last", F.col("first") + F.col("copies") - 1)
    )
    in_parts = (
        numbered.withColumn(
            "part", F.explode(F.expr(f"sequence(first div {part_turns}, last div {part_turns})"))
        )
        .withColumn("part_first", F.greatest("first", F.col("part") * part_turns))
        .withColumn("part_last", F.least("last", (F.col("part") + 1) * part_turns - 1))
        .withColumn("times", (F.col("part_last") - F.col("part_first") + 1).cast("int"))
    )
    folded = in_parts.repartition("conv_id", "part").groupBy("conv_id", "part").agg(
        F.sort_array(F.collect_list(F.struct(*TURN_ORDER, "times"))).alias("turns")
    )
    repeated = F.transform("turns", lambda turn: F.array_repeat(_message(turn), turn["times"]))
    return folded.select("conv_id", "part", F.flatten(repeated).alias("messages"))


def conversation_parts(
    turns: DataFrame,
    part_turns: int = PART_TURNS,
    part_bytes: int | None = None,
    max_long_ids: int = MAX_LONG_IDS,
) -> DataFrame:
    """As `assemble_messages`, with what a part needs to know of the whole: (conv_id, part, messages, facts).

    A part has at most `part_turns` messages and, where `part_bytes` is given, at most so many bytes of
    roles and texts; a single message above that is a part of its own. `facts` (see FACTS) holds the place of
    the part's first message in its conversation, the number of all its messages, how many of those before the
    part are shown in the plain form, whether ChatML can show the whole conversation, and whether it opens with a system message. With it `render_part`,
    `render_plain_part` and `message_at_part` give what the whole conversation gives, part by part.

    What comes before a message is carried from slice to slice (`segmented_scan`), so that a conversation
    of any length is spread over tasks.
    """
    if part_turns < 1 or (part_bytes is not None and part_bytes < 1):
        raise ValueError("part_turns and part_bytes must be at least 1")
    usual, long = split_by_length(turns, part_turns, max_long_ids, part_bytes)
    parts = []
    if usual is not None:
        whole = fold_turns(usual).withColumn("part", F.lit(0).cast("bigint"))
        parts.append(whole.select("conv_id", "part", "messages", facts_of_whole("messages").alias("facts")))
    if long is not None:
        parts.append(_parts_with_facts(long, part_turns, part_bytes))
    return reduce(DataFrame.unionByName, parts)


def message_bytes(role: ColumnOrName = "role", text: ColumnOrName = "text") -> Column:
    """Bytes of a message's role and text; NULL counts as empty."""
    sizes = [F.coalesce(F.octet_length(as_column(c)), F.lit(0)).cast("bigint") for c in (role, text)]
    return sizes[0] + sizes[1]


def _parts_with_facts(turns: DataFrame, part_turns: int, part_bytes: int | None) -> DataFrame:
    """Parts of long conversations: number the turns, deal them out, fold each part.

    By bytes, a part is a run of messages that begin within the same half of the bound, and one with more than
    half of it stands alone: two halves at most meet in a part. All counts only grow along a
    conversation, so their sum names a part, and parts are numbered in its order.
    """
    one, shown = F.lit(1).cast("bigint"), is_rendered_role("role").cast("bigint")
    measures = {"place": ("sum", one), "shown_before": ("sum", shown)}
    label = F.call_function("div", F.col("place"), F.lit(part_turns))
    if part_bytes is not None:
        half = max(part_bytes // 2, 1)
        alone = (message_bytes() > half).cast("bigint")
        measures |= {"bytes_before": ("sum", message_bytes()), "alone_before": ("sum", alone)}
        label += F.call_function("div", F.col("bytes_before"), F.lit(half)) + 2 * F.col("alone_before") + alone
    named = turns.select("conv_id", *TURN_ORDER, F.monotonically_increasing_id().alias("row"))
    placed = segmented_scan(named, ["conv_id"], [*TURN_ORDER, "row"], measures).withColumn("label", label)
    folded = (
        placed.repartition("conv_id", "label")
        .groupBy("conv_id", "label")
        .agg(
            F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("turns"),
            F.min("place").alias("first"),
            F.min("shown_before").alias("shown_before"),
            F.bool_and(is_complete_message("role", "text")).alias("complete"),
        )
    )
    parts = store(folded.withColumn("messages", F.transform("turns", _message)).drop("turns"))
    # Whole conversations' facts come from one short row per part; the messages stay where they are.
    by_part = Window.partitionBy("conv_id").orderBy("label")
    everything = Window.partitionBy("conv_id")
    opening = F.get("messages", F.lit(0))["role"] == "system"
    facts = parts.select(
        F.col("conv_id").alias("id"),
        F.col("label").alias("at"),
        (F.row_number().over(by_part) - 1).cast("bigint").alias("part"),
        F.sum(F.size("messages")).over(everything).cast("bigint").alias("n_messages"),
        F.bool_and("complete").over(everything).alias("renderable"),
        F.coalesce(F.first(F.when(F.col("first") == 0, opening), ignorenulls=True).over(everything), F.lit(False)).alias("opens_with_system"),
    )
    same = F.col("conv_id").eqNullSafe(F.col("id")) & (F.col("label") == F.col("at"))
    return parts.join(facts, same).select(
        "conv_id",
        "part",
        "messages",
        F.struct("first", "n_messages", "shown_before", "renderable", "opens_with_system").alias("facts"),
    )


def leading_turns(turns: DataFrame, count: int) -> DataFrame:
    """The first `count` turns of each conversation, however long it is.

    Narrows down in three steps, so that no task sees more than a small share of
    one conversation: within each input partition, within groups of partitions,
    then within the conversation.
    """
    leading = turns.withColumn("salt", F.spark_partition_id())
    for salt in (F.col("salt"), F.col("salt") % GATHER_GROUPS, F.lit(0)):
        leading = leading.withColumn("salt", salt)
        order = Window.partitionBy("conv_id", "salt").orderBy(*TURN_ORDER)
        leading = leading.withColumn("place", F.row_number().over(order))
        leading = leading.where(F.col("place") <= count).drop("place")
    return leading.drop("salt")
