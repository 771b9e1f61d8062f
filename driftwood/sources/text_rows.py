"""Headerless positional rows (the saved training and content rows)."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def split_positional(lines: DataFrame, names: Sequence[str], sep: str = ",",
                     value_col: str = "value", null_text: str | None = None) -> DataFrame:
    """Split each text line on ``sep`` into the named string columns.
    Missing trailing fields are null; extra fields are ignored; a field that
    is the word ``null_text`` is read as null."""
    parts = F.split(F.col(value_col), re.escape(sep), -1)
    fields = [F.try_element_at(parts, F.lit(i + 1)) for i in range(len(names))]
    if null_text is not None:
        fields = [F.nullif(f, F.lit(null_text)) for f in fields]
    return lines.select(*[f.alias(n) for f, n in zip(fields, names, strict=True)])


def read_positional(spark: SparkSession, paths: str | Iterable[str], names: Sequence[str],
                    sep: str = ",", null_text: str | None = None) -> DataFrame:
    """Positional text rows read straight into named string columns."""
    if isinstance(paths, str):
        paths = [paths]
    return split_positional(spark.read.text(list(paths)), names, sep, null_text=null_text)


def read_csv(spark: SparkSession, paths: str | Iterable[str], schema: T.StructType) -> DataFrame:
    """Headerless CSV with a declared schema (no inference)."""
    if isinstance(paths, str):
        paths = [paths]
    return (spark.read.schema(schema)
            .option("header", "false").option("mode", "PERMISSIVE")
            .csv(list(paths)))
