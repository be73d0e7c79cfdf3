"""Plans put together from the operators, and the registered queries with their SQL."""

from turnmill.plans.evaluation import evaluate_completions
from turnmill.plans.training import (
    training_rows,
    training_rows_by_place,
    training_rows_from_messages,
    training_text,
)

__all__ = [
    "evaluate_completions",
    "training_rows",
    "training_rows_by_place",
    "training_rows_from_messages",
    "training_text",
]
