"""Composed jobs and their stand-in inputs."""

from . import daily, inputs
from .jobs import (content_refresh, content_vectors, labelled_logs, repair_snapshot,
                   training_rows, training_rows_by_day, word_norm)

__all__ = ["daily", "inputs", "content_refresh", "content_vectors", "labelled_logs", "repair_snapshot",
           "training_rows", "training_rows_by_day", "word_norm"]
