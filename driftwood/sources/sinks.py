"""Writers.  Output folders are decided by the data (partition columns) or
by an explicit stamp passed in by the caller, never by the wall clock inside
a task."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def limit_files(df: DataFrame, n_files: int | None) -> DataFrame:
    """Narrow merge to at most ``n_files`` output files (no shuffle).  Note
    that after a shuffle this also runs the whole preceding stage with
    ``n_files`` tasks; ``balanced`` avoids that."""
    return df.coalesce(n_files) if n_files else df


def balanced(df: DataFrame, n_files: int | None = None, rebalance: bool = True) -> DataFrame:
    """Output layout for a write: a fixed ``n_files`` (narrow merge), or an
    adaptive rebalance that sizes files to the advisory partition size while
    the upstream stage keeps its full parallelism, or the input layout."""
    if n_files:
        return df.coalesce(n_files)
    return df.hint("rebalance") if rebalance else df


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str],
                      fmt: str = "parquet", n_files: int | None = None,
                      mode: str = "overwrite", rebalance: bool = False) -> None:
    """Write with one folder per partition value (e.g. ``month``/``day``),
    so a later day-range read prunes folders.  With ``overwrite`` only the
    partitions present in ``df`` are replaced (dynamic overwrite).

    ``rebalance`` clusters rows by the partition columns with an adaptive
    rebalance (a big day is split, small ones are merged to the advisory
    partition size), so each folder gets a few large files instead of one
    small file per upstream task; ``n_files`` instead merges to a fixed
    number of tasks without a shuffle."""
    if rebalance:
        df = df.hint("rebalance", *partition_cols)
    (limit_files(df, n_files).write.mode(mode)
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).format(fmt).save(path))


def write_text(df: DataFrame, path: str, n_files: int | None = None, mode: str = "overwrite",
               value_col: str = "value", rebalance: bool = False) -> None:
    """Write one text column as text files."""
    out = balanced(df.select(F.col(value_col).alias("value")), n_files, rebalance)
    out.write.mode(mode).text(path)


def snapshot_path(root: str, month: str, stamp: str, kind: str = "contentInfo") -> str:
    """``root/yyyyMM/<kind>/yyyyMMddHHmm``."""
    return os.path.join(root, month, kind, stamp)


def write_snapshot(df: DataFrame, root: str, month: str, stamp: str, n_files: int | None = None,
                   fmt: str = "parquet", kind: str = "contentInfo", rebalance: bool = True) -> str:
    """Write a snapshot to a fresh stamped folder and return its path.  A new
    folder per run means the previous snapshot can be read while the new one
    is written.  Without ``n_files`` the files are sized adaptively; rows
    that come out of a shuffle by hash need no ``rebalance`` for that."""
    path = snapshot_path(root, month, stamp, kind)
    if fmt == "text":
        write_text(df, path, n_files, mode="errorifexists", rebalance=rebalance)
    else:
        balanced(df, n_files, rebalance).write.mode("errorifexists").format(fmt).save(path)
    return path


def write_content_store(df: DataFrame, table: str, path: str, buckets: int, id_col: str = "content_id",
                        by: Sequence[str] = ("shard",)) -> DataFrame:
    """Store a content table by month and, within a month, in ``buckets``
    files by id hash, sorted by id, as the catalog's external ``table``.
    Tables stored with the same number of buckets join on the id, and group
    by it, without a shuffle.  Rows go to their bucket's task first, so a
    month has one file a bucket.  The whole table is replaced.

    ``buckets`` is the layout's one fixed number: choose it so that a bucket
    of a month is some 256 MiB."""
    w = df.repartition(buckets, id_col).write.format("parquet").option("path", path).bucketBy(buckets, id_col).sortBy(id_col)
    if by:
        w = w.partitionBy(*by)
    w.mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)
