"""Lookups on stored content tables, the filtered anti join, versions."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from driftwood import operators as op
from driftwood.operators import content as C
from driftwood.plans import inputs as inp
from driftwood.plans import queries as Q
from driftwood.schemas import CONTENT_COLUMNS
from driftwood.session import scratch_path
from driftwood.sources import versions as V
from driftwood.sources.content import read_shards_parquet

from .conftest import plan_text, rows

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k in keys:
        spark.conf.unset(k)


def ancestors(plan: str, leaf: str) -> list[list[str]]:
    """The lines above each line that holds ``leaf``, up to the root."""
    lines = plan.split("\n")
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    out = []
    for k, line in enumerate(lines):
        if leaf in line:
            at, above = depth[k], []
            for j in range(k - 1, -1, -1):
                if depth[j] < at:
                    at, above = depth[j], [*above, lines[j]]
            out.append(above)
    return out


def test_only_the_requested_months_are_read(spark, no_broadcast, tmp_path):
    tables = []
    for name, t in zip("csn", inp.content_tables(spark, SF)):
        path = str(tmp_path / name)
        t.write.partitionBy("shard").parquet(path)
        tables.append(read_shards_parquet(spark, path))
        for month in glob.glob(f"{path}/shard=*"):  # months that nobody asks for cannot even be opened
            if not month.endswith(("1999_03", "1999_04")):
                for f in glob.glob(f"{month}/part-*"):
                    with open(f, "r+b") as broken:
                        broken.truncate(3)
                for f in glob.glob(f"{month}/.part-*.crc"):
                    os.remove(f)
    ids = inp.t_content(spark, SF).where("shard IN ('1999_03', '1999_04')").select("content_id")
    extra = spark.createDataFrame([("199903000",), ("nothing",), (None,)], "content_id string")
    found = op.content_lookup(ids.unionByName(extra), *tables, by_month=True, **inp.SHARD_RULE)
    want = op.content_lookup(ids.unionByName(extra), *inp.content_tables(spark, SF), **inp.SHARD_RULE)
    assert rows(found) == rows(want)
    assert plan_text(found).count("dynamicpruningexpression(shard") >= 3


def test_stored_tables_meet_without_a_shuffle(spark, no_broadcast):
    j = Q.q_stored_join3(spark, SF)
    assert rows(j) == rows(Q.q_content_join3(spark, SF))
    assert "Exchange" not in plan_text(j)
    found = Q.q_stored_lookup(spark, SF)
    assert rows(found) == rows(Q.q_content_lookup(spark, SF))
    above = ancestors(plan_text(found), "FileScan parquet spark_catalog")
    assert len(above) >= 3
    for lines in above:
        assert not [x for x in lines if "Exchange hashpartitioning" in x]
        assert any("SortMergeJoin" in x for x in lines)


def test_rows_in_a_wrong_month_are_not_found(spark):
    tables = [t.withColumn("shard", F.when(F.col("content_id").endswith("7"), F.lit("1998_09")).otherwise(F.col("shard")))
              for t in inp.content_tables(spark, SF)]
    ids = inp.t_content(spark, SF).select("content_id")
    for by_bucket in (False, True):
        got = op.content_lookup(ids, *tables, with_found=True, by_bucket=by_bucket, **inp.SHARD_RULE)
        found = {r.content_id for r in got.where("_found").collect()}
        assert found and not [i for i in found if i.endswith("7") and not i.startswith("199809")]


def test_filtered_anti_join(spark, monkeypatch):
    rng = random.Random(1)
    ids = spark.createDataFrame([(str(rng.randrange(10**9)),) for _ in range(3000)] + [("",), ("é",)], "content_id string")
    known = ids.limit(1000).unionByName(spark.createDataFrame(
        [(str(-k),) for k in range(20000)] + [(None,)], "content_id string"))
    want = rows(op.new_ids(ids, known))
    assert rows(op.new_ids_filtered(ids, known, 3002)) == want
    assert rows(op.new_ids_filtered(ids, known, 10)) == want  # a wrong guess of their number costs time only
    bloom, blocks = op.bloom_of(ids, 3002)
    left = op.maybe_in(known, bloom, blocks)
    assert left.join(ids, "content_id", "left_semi").count() == known.join(ids, "content_id", "left_semi").count()
    assert left.count() < 1000 + 600  # of 20,000 rows that are not asked for
    none = ids.limit(0)
    assert op.new_ids_filtered(none, known, 0).count() == 0
    assert rows(op.new_ids_filtered(ids, none, 3002)) == rows(ids)
    monkeypatch.setattr(C, "BLOOM_BLOCKS", 1)
    plan = op.new_ids_filtered(ids, known, 3002)
    assert rows(plan) == want and "bit_or" not in plan_text(plan)


def content(spark, ids):
    return spark.createDataFrame([(i, *["x" if i is None else f"{i}-{c}" for c in CONTENT_COLUMNS[1:]]) for i in ids],
                                 ", ".join(f"{c} string" for c in CONTENT_COLUMNS))


def test_versions_share_unchanged_parts(spark):
    root = scratch_path(spark, "v")
    assert V.versions(spark, root) == [] and V.read_version(spark, root).count() == 0
    old = [f"{m}{k}" for m in ("201811", "201812", "201901") for k in range(40)] + ["odd", "", None]
    first = V.write_version(spark, root, "1", content(spark, old + old[:5]), buckets=4)
    assert len(first) == len(V.manifest(spark, root)) and rows(V.read_version(spark, root)) == rows(content(spark, old))
    before = V.manifest(spark, root)
    new = ["2019017777", "2019028888", "2019019"]  # the last one is known
    changed = V.write_version(spark, root, "2", content(spark, new).unionByName(content(spark, ["201811"])), buckets=4)
    assert {p.split("-")[0] for p in changed} == {"201901", "201902", "201811"} and len(changed) <= 4
    after = V.manifest(spark, root)
    assert {p for p in after if after[p] != before.get(p)} == set(changed)
    assert rows(V.read_version(spark, root)) == rows(op.snapshot_merge(
        content(spark, new + ["201811"]), content(spark, old)))
    assert rows(V.read_version(spark, root, "1")) == rows(content(spark, old))  # still readable
    with pytest.raises(ValueError):
        V.write_version(spark, root, "2", content(spark, new))


def test_a_writer_that_stops_half_way_leaves_nothing(spark, monkeypatch):
    root = scratch_path(spark, "v")
    V.write_version(spark, root, "1", content(spark, ["2018110", "2018121"]), buckets=2)
    frame = spark.createDataFrame
    new = content(spark, ["2018122", "2019013"])

    def stop(*args, **kwargs):
        raise KeyboardInterrupt("the job is killed before its manifest")
    monkeypatch.setattr(type(spark), "createDataFrame", stop)
    with pytest.raises(KeyboardInterrupt):
        V.write_version(spark, root, "2", new, buckets=2)
    monkeypatch.undo()
    assert V.versions(spark, root) == ["1"]
    assert rows(V.read_version(spark, root)) == rows(content(spark, ["2018110", "2018121"]))
    assert frame is not stop
    V.write_version(spark, root, "2", new, buckets=2)  # the same stamp again, over the remains
    assert rows(V.read_version(spark, root)) == rows(content(spark, ["2018110", "2018121", "2018122", "2019013"]))


def test_stores_and_lists_grow_with_the_tables(spark, monkeypatch):
    """Parts and buckets follow the number of rows; the requested ids of the
    stored lookup are made once, not by every scan."""
    want = rows(inp.t_signal(spark, SF))
    monkeypatch.setattr(inp, "PART_LINES", 500)
    monkeypatch.setattr(inp, "BUCKET_ROWS", 100)
    monkeypatch.setattr(inp, "_STORES", {})
    assert inp._lines_by_order(spark, SF).rdd.getNumPartitions() >= 12
    assert rows(inp.t_signal(spark, SF)) == want
    found = Q.q_stored_lookup(spark, SF)
    assert rows(found) == rows(Q.q_content_lookup(spark, SF))
    plan = plan_text(found)
    assert "lineitem" not in plan and "SelectedBucketsCount: 15 out of 15" in plan
