"""Readers and writers."""

from .content import read_shards_jdbc, read_shards_parquet
from .days import folder_days, publish_days, published_days, read_published
from .logs import day_paths, parse_logs, read_day_logs, read_day_range, read_log_text
from .sinks import balanced, limit_files, snapshot_path, write_partitioned, write_content_store, write_snapshot, write_text
from .text_rows import read_csv, read_positional, split_positional
from .vectors import parse_vector_text, read_vectors

__all__ = [
    "read_shards_jdbc", "read_shards_parquet",
    "folder_days", "publish_days", "published_days", "read_published",
    "day_paths", "parse_logs", "read_day_logs", "read_day_range", "read_log_text",
    "balanced", "limit_files", "snapshot_path", "write_content_store", "write_partitioned", "write_snapshot", "write_text",
    "read_csv", "read_positional", "split_positional",
    "parse_vector_text", "read_vectors",
]
