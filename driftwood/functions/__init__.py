"""Scalar ``Column`` builders.  Every function returns a built-in Spark
expression, so none of them leaves the JVM."""

from .dates import date_label, day_part, day_range, days_in_range, snapshot_stamp
from .ids import is_numeric, shard_has_score, shard_label, shard_month, valid_shards
from .json_fields import first_key, location_fields, split_field, unwrap_parens
from .tags import (format_content_tags, format_tags, format_title_tags,
                   is_keyword_format, parse_keywords, parse_tags)
from .vectors import (cosine, dot, element_sum, fit_dim, l1_norm, l2_norm, parse_vector_line,
                      scale, zeros)

__all__ = [
    "date_label", "day_part", "day_range", "days_in_range", "snapshot_stamp",
    "is_numeric", "shard_has_score", "shard_label", "shard_month", "valid_shards",
    "first_key", "location_fields", "split_field", "unwrap_parens",
    "format_content_tags", "format_tags", "format_title_tags",
    "is_keyword_format", "parse_keywords", "parse_tags",
    "cosine", "dot", "element_sum", "fit_dim", "l1_norm", "l2_norm", "parse_vector_line",
    "scale", "zeros",
]
