"""Operators over whole tables: they take DataFrames and give DataFrames."""

from turnmill.operators.batches import plan_batches
from turnmill.operators.conversations import assemble_messages, conversation_parts
from turnmill.operators.custom import render_or_fall_back, render_with
from turnmill.operators.permutation import batches_by_place, number_rows, rows_at_steps
from turnmill.operators.replies import validate_replies, verdict_summary
from turnmill.operators.runs import (
    benchmark_rollup,
    count_by_dataset,
    run_summary,
    with_memory_percent,
)
from turnmill.operators.scans import segmented_scan
from turnmill.operators.terms import term_hits

__all__ = [
    "assemble_messages",
    "batches_by_place",
    "benchmark_rollup",
    "conversation_parts",
    "count_by_dataset",
    "number_rows",
    "plan_batches",
    "render_or_fall_back",
    "render_with",
    "rows_at_steps",
    "run_summary",
    "segmented_scan",
    "term_hits",
    "validate_replies",
    "verdict_summary",
    "with_memory_percent",
]
