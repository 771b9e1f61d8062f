"""Month-sharded content source tables.

The lookup tables live one per month (``<name>_YYYY_MM``).  They are exposed
as one DataFrame per kind with a ``shard`` column (``yyyy_MM``), either by a
union of JDBC reads or by a parquet table partitioned by ``shard``; the
lookup then joins on ``(shard, content_id)`` so that only the needed months
are read (static or dynamic partition pruning).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_shards_jdbc(spark: SparkSession, url: str, table: str, shards: Iterable[str],
                     columns: Sequence[str], properties: dict | None = None,
                     num_partitions: int | None = None,
                     partition_column: str | None = None,
                     bounds: tuple[int, int] | None = None) -> DataFrame:
    """Union of ``<table>_<shard>`` JDBC tables, each tagged with its shard.

    Columns a month lacks (older months have no ``publisher_score``) come
    back as null via ``allowMissingColumns``.  For large shards pass a
    numeric ``partition_column`` with ``bounds`` so each shard is read by
    several tasks instead of one.
    """
    props = dict(properties or {})
    out = None
    for shard in shards:
        name = f"{table}_{shard}"
        reader = spark.read.format("jdbc").option("url", url).option("dbtable", name)
        for k, v in props.items():
            reader = reader.option(k, v)
        if partition_column and bounds and num_partitions:
            reader = (reader.option("partitionColumn", partition_column)
                      .option("lowerBound", bounds[0]).option("upperBound", bounds[1])
                      .option("numPartitions", num_partitions))
        df = reader.load()
        df = df.select(*[c for c in columns if c in df.columns]).withColumn("shard", F.lit(shard))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("no shards given")
    return out


def read_shards_parquet(spark: SparkSession, root: str) -> DataFrame:
    """A content table stored as parquet partitioned by ``shard``; months
    with fewer columns merge by name."""
    return spark.read.option("mergeSchema", "true").parquet(root)
