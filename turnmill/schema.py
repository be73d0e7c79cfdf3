"""Schemas of the tables the library reads and writes.

Schemas are declared and never inferred: inference costs a pass over the data
and lets column types depend on which rows happen to be there.
"""

from pyspark.sql import types as T

MESSAGE = T.StructType(
    [
        T.StructField("role", T.StringType()),
        T.StructField("content", T.StringType()),
    ]
)
MESSAGES = T.ArrayType(MESSAGE)

# One conversation per row: what a chat JSON Lines file holds.
CONVERSATION_SCHEMA = T.StructType([T.StructField("messages", MESSAGES)])

# Unparsable lines are kept in this column, next to NULL `messages`.
CORRUPT_RECORD = "_corrupt_record"

# The same data as a flat table: one turn per row.
TURN_SCHEMA = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)

# A stored completion: the reply is the text of the first choice.
CHOICES = T.ArrayType(T.StructType([T.StructField("text", T.StringType())]))
COMPLETION_SCHEMA = T.StructType([T.StructField("choices", CHOICES)])
