"""Word-vector tables: text ``word v1 ... vd`` lines -> ``(word, vec)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import parse_vector_line


def parse_vector_text(lines: DataFrame, value_col: str = "value", place: Sequence[str] = ()) -> DataFrame:
    """``word STRING, vec ARRAY<FLOAT>, pos`` per non-blank line.  ``pos``
    orders the rows (for first-match semantics): by the ``place`` columns,
    then within the read."""
    p = parse_vector_line(F.col(value_col))
    return (lines.where(F.trim(F.col(value_col)) != "")
            .select(p["word"].alias("word"), p["vec"].alias("vec"),
                    F.struct(*place, F.monotonically_increasing_id().alias("row")).alias("pos")))


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Word-vector text file(s) -> ``(word, vec, pos)``; rows are ordered by
    file, place in the file and line, however the files are packed into
    tasks."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"),
                                         F.col("_metadata.file_block_start").alias("block"))
    return parse_vector_text(lines, place=("file", "block"))
