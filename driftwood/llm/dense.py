"""Dense vectors of the corpus operators: which take part, and how a task
reads them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship


def finite_vectors(vectors: DataFrame, id_col: str, vec_col: str, dim: int | None = None) -> DataFrame:
    """``id`` (long) and ``vec`` (array of float or double) of the rows whose
    vector has ``dim`` components (any number, if None), none null, NaN or
    infinite, whatever else the table holds."""
    ship(vectors.sparkSession)
    single = vectors.schema[vec_col].dataType == T.ArrayType(T.FloatType())
    vec = F.col(f"`{vec_col}`").cast("array<float>" if single else "array<double>")
    out = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), vec.alias("vec"))
    good = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return out.where((F.size("vec") == dim if dim else F.size("vec") > 0) & good)


def matrix(batch: pa.RecordBatch, dim: int, col: str = "vec") -> np.ndarray:
    """The batch's vectors as rows of doubles."""
    return np.asarray(batch.column(col).flatten(), np.float64).reshape(-1, dim)
