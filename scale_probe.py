"""Scaling probe: time the log job and the weighted vector sum on inputs
amplified k-fold from the sf0.1 tables (k copies with shifted keys, built in
Spark).  The amplified logs are written once as text below the checkpoint
folder, so the log job is timed on files, as it runs in production.  Prints
one JSON line per k.  Not a registered query.

usage: python scale_probe.py [sf_dir] [k ...]
"""

from __future__ import annotations

import json
import sys
import time

from pyspark.sql import functions as F

from driftwood import operators as op
from driftwood.plans import inputs as inp
from driftwood.plans import jobs
from driftwood.session import build_session, scratch_path


def amplified(df, k: int, key: str, step: int):
    copies = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_copy")
    return (df.select("*", copies)
            .withColumn(key, F.col(key) + F.col("_copy").cast("bigint") * F.lit(step)).drop("_copy"))


def timed(df) -> float:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    ks = [int(x) for x in sys.argv[2:]] or [1, 4, 16]
    spark = build_session(extra={"spark.driver.memory": "16g"})
    events = inp.table(spark, sf, "events")
    lineitem = inp.table(spark, sf, "lineitem")
    vec = inp.vectors(spark, sf)
    for k in ks:
        # copies get distinct users, so keys scale with the data
        ev = amplified(events, k, "user_id", 1_000_000)
        imp, clk = inp.log_text_from(ev)
        path = scratch_path(spark, f"probe-logs-{k}")
        imp.select("value").write.text(f"{path}/imp")
        clk.select("value").write.text(f"{path}/clk")
        rows = jobs.training_rows(spark.read.text(f"{path}/imp"), spark.read.text(f"{path}/clk"),
                                  inp.STRATEGY)
        t_log = min(timed(rows) for _ in range(2))
        li = amplified(lineitem, k, "l_orderkey", 100_000_000)
        toks = li.select("l_orderkey", F.col("l_partkey").cast("string").alias("word"),
                         F.col("l_quantity").alias("weight"))
        t_vec = min(timed(op.tag_vector(toks, vec, "l_orderkey", inp.VECTOR_DIM)) for _ in range(2))
        print(json.dumps({"k": k, "log_lines": events.count() * k, "training_rows_sec": round(t_log, 2),
                          "tokens": lineitem.count() * k, "tag_vector_sec": round(t_vec, 2)}), flush=True)


if __name__ == "__main__":
    main()
