"""JSON-text and delimited-text field functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = " "


def location_fields(local_json: Column) -> Column:
    """``STRUCT<country, city, state>`` from ``{"v1":[{...}, ...]}``: the first
    array element's fields, each missing value (or a missing/empty array)
    becoming a single space."""
    def one(name: str) -> Column:
        return F.coalesce(F.get_json_object(local_json, f"$.v1[0].{name}"), F.lit(BLANK)).alias(name)
    return F.struct(one("country"), one("city"), one("state"))


def first_key(js: Column, path: str = "$.v2", default: str = BLANK) -> Column:
    """First key, in document order, of the JSON object found at ``path``;
    ``default`` when the object is missing, empty or not an object."""
    keys = F.json_object_keys(F.get_json_object(js, path))
    return F.coalesce(F.try_element_at(keys, F.lit(1)), F.lit(default))


def unwrap_parens(line: Column) -> Column:
    """Text after the first ``(`` up to the next ``(`` or ``)``; empty when
    the line has no ``(``."""
    return F.regexp_extract(line, r"\(([^()]*)", 1)


def split_field(line: Column, index: int, sep: str = ",") -> Column:
    """Zero-based positional field of a delimited text line; null when the
    line is too short.  Trailing empty fields are kept."""
    return F.try_element_at(F.split(line, re.escape(sep), -1), F.lit(index + 1))
