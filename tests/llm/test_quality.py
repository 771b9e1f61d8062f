import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from driftwood.llm import quality as Q

from .helpers import DOCS, edge_docs, empty_docs

SF = "/root/testdata/sf0.1"


def made(n=400):
    rng = random.Random(0)
    good = lambda: " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) for _ in range(60))
    bad = lambda: " ".join(rng.choice("$$$ %%% &&& BUY!! NOW!! | ***".split()) for _ in range(60))
    return [(i, good() if i % 3 else bad()) for i in range(n)], [(i, int(i % 3 > 0)) for i in range(n)]


def test_separates_and_never_reads_held_out_labels(spark):
    rows, marks = made()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    got = {r.doc_id: r for r in Q.query(docs, labels).collect()}
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    assert all(got[i].held_out == held(i) and 0 <= got[i].score <= 1 for i, _ in rows)
    assert all(got[i].predicted == int(got[i].score >= 0.3) for i, _ in rows)
    assert np.mean([got[i].predicted == y for i, y in marks if held(i)]) > 0.97
    lies = spark.createDataFrame([(i, 1 - y if held(i) else y) for i, y in marks], "doc_id long, quality int")
    again = {r.doc_id: r.score for r in Q.query(docs, lies).collect()}
    assert all(abs(again[i] - got[i].score) < 1e-12 for i in again)


def test_held_out_accuracy_on_the_tables(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = Q.query(docs, labels).join(labels, "doc_id").where("held_out").select("quality", "score", "predicted").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97
    good, bad = ([r.score for r in rows if r.quality == y] for y in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.98


def test_edge_cases(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = Q.query(edge_docs(spark), none).collect()
    assert len(got) == len(DOCS) and {r.score for r in got} == {0.5}
    odd = spark.createDataFrame([(1, 1), (1, 1), (2, None), (None, 0), (4, 7)], "doc_id long, quality int")
    assert len(Q.query(edge_docs(spark), odd).collect()) == len(DOCS)
    assert Q.query(empty_docs(spark), odd).count() == 0
    rows, marks = made()
    model = Q.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int"))
    df = edge_docs(spark)
    kept = Q.drop_rejected(df, model)
    assert kept.schema == df.schema
    scores = Q.score(df, model).where(F.col("score") >= Q.THRESHOLD).count()
    assert kept.count() == scores


def test_whole_texts_count():
    model = Q.Evidence(b"bad " * 300, b"good " * 300)
    a, b = "x" * 10000 + "good " * 9000, "x" * 10000 + "bad " * 9000
    assert model.of(a)[1] > model.of(b)[1]
