"""Reading conversations."""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnmill.checkpoints import new_table_path
from turnmill.functions.columns import ColumnOrName, as_column
from turnmill.schema import CONVERSATION_SCHEMA, CORRUPT_RECORD
from turnmill.sources.observed import observed_counts

# Why a line is no conversation.
NOT_JSON = "not json"
NOT_MESSAGES = "messages are not a list of objects"
NO_MESSAGES = "no messages"
REASONS = (NOT_JSON, NOT_MESSAGES, NO_MESSAGES)
REASON = "reject_reason"


def read_conversations(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Read chat JSON Lines: one object with a `messages` list per line.

    A line that is not JSON becomes a row with NULL `messages` and its text in
    `_corrupt_record`, so the caller can count such rows or drop them. Other
    keys are ignored; an empty list and a null one stay distinct.
    """
    schema = T.StructType([*CONVERSATION_SCHEMA, T.StructField(CORRUPT_RECORD, T.StringType())])
    return (
        spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT_RECORD).json(path)
    )


class ParsedLines(NamedTuple):
    """What lines hold: conversations, the lines that are none, and how many of each there were."""

    rows: DataFrame
    rejects: DataFrame
    counts: dict[str, int]


def parse_line(line: ColumnOrName) -> Column:
    """STRUCT<messages, reject_reason> of a line; just one of them is NULL, and both for a blank or NULL line.

    A line must be one JSON value and nothing more, an object, and its `messages` a list of objects;
    an empty list is a conversation. Other keys are ignored, and a message's missing role or content is NULL.
    """
    line = as_column(line)
    schema = T.StructType([*CONVERSATION_SCHEMA, T.StructField(CORRUPT_RECORD, T.StringType())])
    parsed = F.from_json(line, schema, {"columnNameOfCorruptRecord": CORRUPT_RECORD})
    # Parsing stops after the first value, whatever follows. In a list that ends in the line's digest, nothing
    # but one whole value leaves the digest in the second place.
    end = F.md5(line)
    listed = F.try_parse_json(F.concat(F.lit("["), line, F.lit(', "'), end, F.lit('"]')))
    is_json = F.coalesce(F.try_variant_get(listed, "$[1]", "string") == end, F.lit(False))
    messages = parsed["messages"]
    complete = F.forall(messages, lambda message: message.isNotNull())
    reason = (
        F.when(F.coalesce(F.btrim(line, F.lit(" \t\r\n")), F.lit("")) == "", F.lit(None))
        .when(~is_json, NOT_JSON)
        .when(parsed[CORRUPT_RECORD].isNotNull() | ~complete, NOT_MESSAGES)
        .when(messages.isNull(), NO_MESSAGES)
    )
    return F.struct(F.when(reason.isNull(), messages).alias("messages"), reason.alias(REASON))


def parse_conversations(lines: DataFrame, line: str = "value") -> ParsedLines:
    """Split lines of chat JSON into conversations and rejects in one pass over them.

    rows: the columns of `lines` without the line, and `messages`. rejects: all columns of `lines`, the line as it
    is, and `reject_reason`. Blank and NULL lines are neither. counts: `lines`, `rows`, `rejects`, `blank` and one entry
    per reason, taken while the parsed lines are written to the checkpoint folder, which happens when this is called.
    """
    taken = {"messages", REASON, "_parsed"}.intersection(lines.columns)
    if taken:
        raise ValueError(f"lines have columns named {sorted(taken)}")
    spark, observed = lines.sparkSession, Observation()
    parsed = lines.withColumn("_parsed", parse_line(line)).select("*", "_parsed.*").drop("_parsed")
    blank = F.col("messages").isNull() & F.col(REASON).isNull()
    counted = parsed.observe(
        observed,
        F.count("*").alias("lines"),
        F.count_if(F.col("messages").isNotNull()).alias("rows"),
        F.count_if(F.col(REASON).isNotNull()).alias("rejects"),
        F.count_if(blank).alias("blank"),
        *[F.count_if(F.col(REASON) == reason).alias(reason) for reason in REASONS],
    )
    # A conversation's own line is not written a second time next to its messages.
    kept = counted.withColumn(line, F.when(F.col(REASON).isNotNull(), F.col(line)))
    rejected = F.col(REASON).isNotNull().alias("_rejected")
    path = new_table_path(spark)
    kept.where(~blank).select("*", rejected).write.partitionBy("_rejected").parquet(path)
    schema = T.StructType([*kept.schema.fields, T.StructField("_rejected", T.BooleanType())])
    table = spark.read.schema(schema).parquet(path)
    return ParsedLines(
        table.where("NOT _rejected").drop("_rejected", line, REASON),
        table.where("_rejected").drop("_rejected", "messages"),
        observed_counts(observed, ["lines", "rows", "rejects", "blank", *REASONS]),
    )
