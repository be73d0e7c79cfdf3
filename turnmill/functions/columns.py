"""Small helper shared by the column functions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_column(column: ColumnOrName) -> Column:
    """A name stands for the column of that name, as in `pyspark.sql.functions`."""
    return F.col(column) if isinstance(column, str) else column
