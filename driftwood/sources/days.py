"""Saved rows by whole days: a run writes its days to a folder of its own and
publishes them last, in one manifest that names each day's folder.

A reader takes, for every day of its range, the folder that the newest
published run (by stamp, as text) names for it.  So it never sees a day half
written, a run that stops leaves nothing that anyone reads, a day that is run
again is replaced as a whole (also by no rows at all), and a reader keeps its
files while a later run publishes.  A run's manifest has a row a day; the
driver sees one row for each day of the range.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "day string, folder string"
#: Saved rows lie in ``month=yyyyMM/day=yyyyMMdd`` folders.
FOLDERS = ("month", "day")


def folder_days(paths: Iterable[str]) -> list[str]:
    """The days that paths of day folders name, in order."""
    found = [re.match(r".*[/=](\d{8})/", f"{p}/") for p in paths]
    if None in found:
        raise ValueError("a path names no day folder, so its day cannot be published")
    return sorted({m[1] for m in found})


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def published_runs(spark: SparkSession, root: str) -> list[str]:
    """Stamps of the published runs, oldest first."""
    pattern, fs = _files(spark, os.path.join(root, "manifests", "*", "_SUCCESS"))
    return sorted(s.getPath().getParent().getName() for s in fs.globStatus(pattern) or [])


def stage_days(rows: DataFrame, root: str, stamp: str, fmt: str = "parquet") -> str:
    """Write ``rows(..., month, day)`` to the run's own folder, which nobody
    reads before it is published; remains of a stopped run are replaced."""
    home = os.path.join(root, "data", f"run={stamp}")
    (rows.hint("rebalance", *FOLDERS).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(*FOLDERS).format(fmt).save(home))
    return home


def publish_days(rows: DataFrame, root: str, stamp: str, days: Iterable[str], fmt: str = "parquet") -> list[str]:
    """Write the rows of ``days`` and publish these days; returns those that
    have rows.  A row of another day fails the run, and a published stamp is
    never written again."""
    spark = rows.sparkSession
    if stamp in published_runs(spark, root):
        raise ValueError(f"run {stamp} is published")
    days = sorted(set(days))
    day = F.when(F.col("day").isin(days), F.col("day")).otherwise(F.raise_error(F.concat_ws(
        " ", F.lit("a row of a day that is not published:"), F.col("day"))))
    home = stage_days(rows.withColumn("day", day), root, stamp, fmt)

    def folder(day: str) -> str | None:
        path = os.path.join(home, f"month={day[:6]}", f"day={day}")
        at, fs = _files(spark, path)
        return path if fs.exists(at) else None
    named = [(d, folder(d)) for d in days]
    spark.createDataFrame(named, MANIFEST).coalesce(1).write.mode("overwrite").json(os.path.join(root, "manifests", stamp))
    return [d for d, f in named if f]


def published_days(spark: SparkSession, root: str, start: str, end: str) -> dict[str, str | None]:
    """Folder of every published day in ``[start, end]`` (None: no rows)."""
    runs = [os.path.join(root, "manifests", s) for s in published_runs(spark, root)]
    if not runs:
        return {}
    run = F.regexp_extract("_metadata.file_path", r"([^/]+)/[^/]+$", 1)
    newest = (spark.read.schema(MANIFEST).json(runs).select("day", F.struct(run.alias("run"), "folder").alias("at"))
              .where(F.col("day").between(start, end)).groupBy("day").agg(F.max("at.run").alias("run"), F.max_by("at.folder", "at.run").alias("folder")))
    return {r.day: r.folder for r in newest.orderBy("day").collect()}


def read_published(spark: SparkSession, root: str, start: str, end: str, schema: str | T.StructType,
                   fmt: str = "parquet") -> DataFrame:
    """The rows of the published days in ``[start, end]``, with the columns
    of ``schema`` (which names ``month`` and ``day`` as text)."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    folders = [f for f in published_days(spark, root, start, end).values() if f]
    if not folders:
        return spark.createDataFrame([], schema)
    read = spark.read.schema(schema).format(fmt).option("basePath", os.path.join(root, "data"))
    return read.load(folders).select(*schema.names)
