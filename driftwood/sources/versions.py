"""A content snapshot in versions that share what has not changed.

Rows lie in parts: the ``yyyyMM`` an id begins with (``other`` if it begins
with no six digits) and a hash of the id.  A version writes only the parts
that its new rows fall into, to a folder of its own; its manifest names the
folder of every part, old or new, and is published last.  A reader takes the
newest manifest whose write has finished, so a writer that stops half way
leaves nothing that anyone reads, and a version never changes once published.

New content has recent months, so a daily refresh reads and rewrites a few
months' parts, whatever the size of the snapshot.  The manifest has one row a
part (months times hash buckets), which is what the driver sees.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.content import ID, snapshot_merge
from ..schemas import CONTENT_COLUMNS

BUCKETS = 16
PART = "part"
MANIFEST = "part string, folder string"


def part_of(id_col: str = ID, buckets: int = BUCKETS) -> Column:
    month = F.when(F.col(id_col).rlike(r"^[0-9]{6}"), F.substring(id_col, 1, 6)).otherwise(F.lit("other"))
    return F.concat_ws("-", month, F.pmod(F.xxhash64(id_col), F.lit(buckets)).cast("string"))


def versions(spark: SparkSession, root: str) -> list[str]:
    """The published versions, oldest first."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(root, "manifests", "*", "_SUCCESS"))
    found = pattern.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(pattern)
    return sorted(s.getPath().getParent().getName() for s in found or [])


def manifest(spark: SparkSession, root: str, stamp: str | None = None) -> dict[str, str]:
    """Folder of every part of a version (of the newest, without ``stamp``)."""
    stamp = stamp or next(reversed(versions(spark, root)), None)
    if stamp is None:
        return {}
    rows = spark.read.schema(MANIFEST).json(os.path.join(root, "manifests", stamp)).collect()
    return {r.part: r.folder for r in rows}


def read_parts(spark: SparkSession, folders: list[str]) -> DataFrame:
    schema = ", ".join(f"{c} string" for c in CONTENT_COLUMNS)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*sorted(folders))


def read_version(spark: SparkSession, root: str, stamp: str | None = None) -> DataFrame:
    """The content rows of a published version (empty before the first)."""
    return read_parts(spark, list(manifest(spark, root, stamp).values()))


def write_version(spark: SparkSession, root: str, stamp: str, new_rows: DataFrame, buckets: int = BUCKETS) -> list[str]:
    """Publish the newest version with ``new_rows`` added (whole-row
    distinct) as version ``stamp``; returns the parts that were written."""
    if stamp in versions(spark, root):
        raise ValueError(f"version {stamp} is published")
    old = manifest(spark, root)
    staged = os.path.join(root, "staged", stamp)
    # the new rows are kept once: they say which parts change, and are then merged
    new_rows.select(*CONTENT_COLUMNS, part_of(buckets=buckets).alias(PART)).write.mode("overwrite").parquet(staged)
    new = spark.read.parquet(staged)
    changed = [r.part for r in new.select(PART).distinct().collect()]  # at most one row a part
    merged = snapshot_merge(new, read_parts(spark, [old[p] for p in changed if p in old]))
    home = os.path.join(root, "data", stamp)
    (merged.withColumn(PART, part_of(buckets=buckets)).hint("rebalance", PART)
     .write.mode("overwrite").partitionBy(PART).parquet(home))  # a stopped run's folder is nobody's
    now = {**old, **{p: os.path.join(home, f"{PART}={p}") for p in changed}}
    spark.createDataFrame(sorted(now.items()), MANIFEST).coalesce(1).write.mode("overwrite").json(
        os.path.join(root, "manifests", stamp))
    return sorted(changed)
