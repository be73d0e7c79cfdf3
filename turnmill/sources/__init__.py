"""Where rows come from and where they go."""

from turnmill.sources.conversations import parse_conversations, parse_line, read_conversations
from turnmill.sources.counted import dataset_counts_of, run_summary_of, write_datasets
from turnmill.sources.datasets import concat_datasets
from turnmill.sources.numbered import read_numbered
from turnmill.sources.prompts import sample_prompts
from turnmill.sources.training_files import (
    file_ranges,
    read_manifest,
    read_training_range,
    write_training_files,
)
from turnmill.sources.training_text import write_training_text

__all__ = [
    "concat_datasets",
    "dataset_counts_of",
    "file_ranges",
    "parse_conversations",
    "parse_line",
    "read_conversations",
    "read_manifest",
    "read_numbered",
    "read_training_range",
    "run_summary_of",
    "sample_prompts",
    "write_datasets",
    "write_training_files",
    "write_training_text",
]
