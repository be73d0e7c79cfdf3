"""Chat formatting with typed content parts, reversible escapes and a loss mask.

Built-in expressions only. A turn is shown as `<|im_start|>role<|im_sep|>content<|im_end|>` and
a line feed. Content parts are flattened in order: text as it is, attachments as placeholders.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"

PART = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("ref", T.StringType()),
        T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("pages", T.IntegerType()),
    ]
)
PARTS = T.ArrayType(PART)
# Tokens an attachment stands for: an image by patches of 28 x 28 and one for its end, sound by
# 25 a second, a document by 512 a page. Where a measure is missing, one token.
TOKENS = {
    "image": lambda part: F.ceil(part["width"] / 28.0) * F.ceil(part["height"] / 28.0) + 1,
    "audio": lambda part: F.ceil(part["seconds"] * 25),
    "document": lambda part: part["pages"].cast("bigint") * 512,
}

# What could be read as a control string: its first character gets a backslash after it.
CONTROL = r"(<|\[)(?=\||/?s>|/?INST\])"
# What an attachment of a type that is not listed is shown as.
OTHER = "attachment"


def escape(text: Column) -> Column:
    """The text without control strings: backslashes are doubled, and one breaks up each of them."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    """Takes back `escape`: a backslash stands before the character that is meant."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_part(text: Column) -> Column:
    """ARRAY of one text part."""
    fields = {field.name: F.lit(None).cast(field.dataType) for field in PART}
    fields |= {"type": F.lit("text"), "text": text}
    return F.array(F.struct(*[value.alias(name) for name, value in fields.items()])).cast(PARTS)


def flatten_parts(parts: Column) -> Column:
    """STRUCT<content, attachments> of an ARRAY of PARTS.

    content: texts, escaped, and `<|type|>` for attachments, in order; texts that follow one another make no
    control string together. attachments: ARRAY of STRUCT<type, ref, tokens>, one for each placeholder, in
    order. A null list is empty, a null part nothing, a part without a type or with type text its
    text, a null text empty; a part of a type that is not in TOKENS is shown as `<|attachment|>`, keeps its
    type in the list and takes one token.
    """
    parts = F.filter(F.coalesce(parts, F.array().cast(PARTS)), lambda p: p.isNotNull())

    def is_text(p: Column) -> Column:
        return F.coalesce(p["type"] == "text", F.lit(True))

    # Texts that follow one another are one run, escaped as a whole.
    run = "array<struct<kind: string, text: string>>"

    def as_run(p: Column) -> Column:
        # Listed types only: a type of the caller's could spell a control string.
        kind = F.when(is_text(p), F.lit("text")).when(p["type"].isin(*TOKENS), p["type"]).otherwise(OTHER)
        return F.struct(kind.alias("kind"), F.coalesce(p["text"], F.lit("")).alias("text"))

    def joined(runs: Column, p: Column) -> Column:
        last = F.element_at(runs, -1)
        goes_on = is_text(p) & F.coalesce(F.get(runs, F.size(runs) - 1)["kind"] == "text", F.lit(False))
        longer = F.struct(
            F.lit("text").alias("kind"), F.concat(last["text"], F.coalesce(p["text"], F.lit(""))).alias("text")
        )
        return F.when(
            goes_on, F.concat(F.slice(runs, F.lit(1), F.size(runs) - 1), F.array(longer)).cast(run)
        ).otherwise(F.concat(runs, F.array(as_run(p))).cast(run))

    def shown(r: Column) -> Column:
        placeholder = F.concat(F.lit("<|"), r["kind"], F.lit("|>"))
        return F.when(r["kind"] == "text", escape(r["text"])).otherwise(placeholder)

    runs = F.aggregate(parts, F.array().cast(run), joined)
    attached = F.filter(parts, lambda p: ~is_text(p))
    return F.struct(
        F.array_join(F.transform(runs, shown), "").alias("content"),
        F.transform(
            attached,
            lambda p: F.struct(p["type"].alias("type"), p["ref"].alias("ref"), _expansion(p).alias("tokens")),
        ).alias("attachments"),
    )


def _expansion(part: Column) -> Column:
    one = F.lit(1).cast("bigint")
    tokens = one
    for kind, measured in TOKENS.items():
        own = F.coalesce(measured(part).cast("bigint"), one)
        tokens = F.when(part["type"] == kind, own).otherwise(tokens)
    return tokens


def format_chats(turns: DataFrame, trained: Sequence[str] = ("assistant",)) -> DataFrame:
    """One row per conversation: (conv_id, formatted, turns, attachments, attachment_tokens).

    `turns` has conv_id, turn, role and `parts` (see PART), or `text` for turns of one text part.
    Turns are ordered by number, equal ones by role and then by content; copies stay. A null role is empty. `turns`
    in the result lists STRUCT<start, end, loss> for each turn's content, in code points of
    `formatted`; loss is true where the role is one of `trained`: that is the loss mask. Turns
    without conv_id form one conversation. Other columns are ignored.

    One shuffle, by conversation, and one row each: its digest and mask need it whole.
    """
    parts = F.col("parts") if "parts" in turns.columns else text_part(F.col("text"))
    flat = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), flatten_parts(parts).alias("flat")
    )
    shown = flat.select(
        "conv_id",
        "turn",
        "role",
        F.col("flat.content").alias("content"),
        F.col("flat.attachments").alias("attachments"),
        F.concat(F.lit(START), escape(F.col("role")), F.lit(SEP)).alias("head"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "content")
    length = F.length("head") + F.length("content") + len(END)
    placed = shown.withColumns(
        {
            "place": F.row_number().over(order),
            "end": F.sum(length).over(order.rowsBetween(Window.unboundedPreceding, 0)) - len(END),
        }
    )
    loss = F.col("role").isin(*trained)
    span = F.struct((F.col("end") - F.length("content")).alias("start"), "end", loss.alias("loss"))
    folded = placed.groupBy("conv_id").agg(
        F.sort_array(
            F.collect_list(
                F.struct("place", F.concat("head", "content", F.lit(END)).alias("shown"), span.alias("span"), "attachments")
            )
        ).alias("rows")
    )
    attachments = F.flatten(F.transform("rows", lambda row: row["attachments"]))
    total = F.aggregate(
        F.transform(attachments, lambda a: a["tokens"]), F.lit(0).cast("bigint"), lambda total, n: total + n
    )
    return folded.select(
        "conv_id",
        F.array_join(F.transform("rows", lambda row: row["shown"]), "").alias("formatted"),
        F.transform("rows", lambda row: row["span"]).alias("turns"),
        attachments.alias("attachments"),
        total.alias("attachment_tokens"),
    )


def read_chat(formatted: Column) -> Column:
    """ARRAY of STRUCT<role, content> of a formatted conversation; content is unescaped, with its
    placeholders. Marks are found by plain search: inside content they cannot stand."""
    pieces = F.split(formatted, r"<\|im_end\|>\n")
    turns = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, SEP, 1)
        content = F.substring(piece, F.length(role) + len(SEP) + 1, F.length(piece))
        role = F.substring(role, len(START) + 1, F.length(role))
        return F.struct(unescape(role).alias("role"), unescape(content).alias("content"))

    return F.transform(turns, turn)


def read_parts(content: Column) -> Column:
    """ARRAY of STRUCT<type, text> of a turn's content as it is formatted: runs of text, unescaped, and between them the
    placeholders by type, without text. What stands for a placeholder in a text is text again. Empty runs are left out."""
    placeholder = rf"<\|({'|'.join([*TOKENS, OTHER])})\|>"
    kinds = F.regexp_extract_all(content, F.lit(placeholder), F.lit(1))
    texts = F.transform(F.split(content, placeholder, -1), unescape)

    def part(kind: Column, text: Column) -> Column:
        return F.struct(kind.alias("type"), text.alias("text"))

    none = F.lit(None).cast("string")
    pairs = F.zip_with(
        texts, kinds, lambda text, kind: F.array(part(F.lit("text"), text), part(kind, none))
    )
    return F.filter(
        F.flatten(pairs), lambda p: p["type"].isNotNull() & ((p["type"] != "text") | (p["text"] != ""))
    )


def read_chat_parts(formatted: Column) -> Column:
    """ARRAY of STRUCT<role, parts> of a formatted conversation, see `read_parts`."""

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, SEP, 1)
        content = F.substring(piece, F.length(head) + len(SEP) + 1, F.length(piece))
        role = F.substring(head, len(START) + 1, F.length(head))
        return F.struct(unescape(role).alias("role"), read_parts(content).alias("parts"))

    pieces = F.split(formatted, r"<\|im_end\|>\n")
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def masked_text(formatted: Column, turns: Column) -> Column:
    """All text under the loss mask, unescaped, put together."""
    pieces = F.split(formatted, r"<\|im_end\|>\n")

    def under(piece: Column, span: Column) -> Column:
        size = span["end"] - span["start"]
        text = F.substring(piece, (F.length(piece) - size + 1).cast("int"), size.cast("int"))
        return F.when(F.coalesce(span["loss"], F.lit(False)), unescape(text)).otherwise("")

    return F.array_join(F.zip_with(pieces, turns, under), "")
