"""What an Observation has seen."""

from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation


def observed_counts(observed: Observation, names: list[str]) -> dict[str, int]:
    """The counts of an observed action; zeros where Spark knew that there were no rows and observed none."""
    try:
        seen = observed.get
    except Py4JJavaError as error:
        if "AssertionError" not in str(error.java_exception):
            raise
        seen = {}
    return {name: seen.get(name) or 0 for name in names}
