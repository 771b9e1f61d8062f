"""The registered queries against DuckDB, and the pipeline against its
stages said in plain Python."""

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from compare_oracle import TABLES, digest
from driftwood.llm import quality
from driftwood.llm.queries import QUERIES, SQL

from . import test_decontaminate, test_exact_dedup, test_ngram_join

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = set(E.queries())
    assert set(QUERIES) <= names and "pipeline" in names
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    res = con.execute(SQL[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    got = [tuple(r) for r in df.collect()]
    assert sorted(cols) == sorted(df.columns) and len(got) == len(want)
    assert digest(got, df.columns) == digest(want, cols)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    model = quality.fit(docs, labels)
    good = {r.id for r in quality.score(docs, model).where(f"score >= {quality.THRESHOLD}").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in good]
    keep = {r[0] for r in test_exact_dedup.brute(rows) if r[3]}
    rows = [r for r in rows if r[0] in keep]
    keep = {r[0] for r in test_ngram_join.brute(rows) if r[0] == r[2]}
    rows = [r for r in rows if r[0] in keep]
    keep = {r[0] for r in test_decontaminate.brute(rows, bench) if not r[5]}
    out = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in out.collect()} == keep and out.count() == len(keep)
    one = corpus_pipeline.STAGES[0][1](spark, docs, SF)
    assert one.schema == docs.schema
