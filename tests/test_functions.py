import math

import pytest
from pyspark.sql import functions as F

from driftwood import functions as fn


def one(spark, col, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).collect()[0]["r"]


def many(spark, colfn, values, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, s {dtype}")
    return [r["r"] for r in df.orderBy("i").select(colfn(F.col("s")).alias("r")).collect()]


def test_day_part(spark):
    assert many(spark, fn.day_part, ["2024-01-05 10:00:00", "  2024-01-06  x", "", None]) == \
        ["2024-01-05", "2024-01-06", "", None]


def test_date_label_and_stamp(spark):
    df = spark.createDataFrame([("2024-03-01 13:45:10",)], "t string").select(
        F.to_timestamp("t").alias("ts"))
    r = df.select(fn.date_label(F.to_date("ts"), 1).alias("d"),
                  fn.date_label(F.to_date("ts"), 1, month=True).alias("m"),
                  fn.snapshot_stamp(F.col("ts")).alias("s")).collect()[0]
    assert (r.d, r.m, r.s) == ("20240229", "202402", "202403011345")


def test_day_range():
    import datetime as dt
    s, e = fn.day_range(dt.date(2024, 1, 10), 8, 0)
    assert (s, e) == (dt.date(2024, 1, 3), dt.date(2024, 1, 10))
    assert len(fn.days_in_range(s, e)) == 8


def test_is_numeric(spark):
    vals = ["", "123", "12a", " 1", "١٢", None]
    assert many(spark, fn.is_numeric, vals) == [True, True, False, False, True, False]


@pytest.mark.parametrize("cid,shard", [
    ("201808123", "2018_08"),     # valid
    ("201807123", None),          # 2018 before August
    ("201907123", "2019_07"),     # valid, month without publisher_score
    ("201713123", None),          # year not allowed
    ("201913123", None),          # month 13
    ("2019ab123", None),          # month not a number
    ("20190", None),              # too short
    ("201900999", "2019_00"),     # month 00 passes the rule
    (None, None),
])
def test_shard_label(spark, cid, shard):
    assert one(spark, fn.shard_label(F.col("s")), cid) == shard


def test_shard_has_score(spark):
    assert many(spark, fn.shard_has_score, ["2019_07", "2019_08", "2018_12"]) == [False, True, True]


def test_location_fields(spark):
    vals = ['{"v1":[{"country":"US","city":"Austin","state":null}]}',
            '{"v1":[]}', '{"x":1}', None, 'not json',
            '{"v1":[{"country":"FR"},{"country":"DE"}]}']
    out = many(spark, fn.location_fields, vals)
    assert [tuple(r) for r in out] == [
        ("US", "Austin", " "), (" ", " ", " "), (" ", " ", " "), (" ", " ", " "),
        (" ", " ", " "), ("FR", " ", " ")]


def test_first_key_document_order(spark):
    vals = ['{"v2":{"g17":{},"g03":{}}}', '{"v2":{}}', '{"x":{}}', None]
    assert many(spark, fn.first_key, vals) == ["g17", " ", " ", " "]


def test_format_tags(spark):
    tags = '{"v8":{"词甲":{"weight":0.418},"词乙":{"weight":0.403}}}'
    alt = '{"v99":{"a":{"weight":1.5}}}'
    title = '{"v4":{"词丙":{"weight":1.01}}}'
    assert many(spark, fn.format_content_tags, [tags, alt, None]) == \
        ["词甲=0.418 词乙=0.403", "a=1.5", ""]
    assert many(spark, fn.format_title_tags, [title]) == ["词丙=1.01"]


def test_parse_tags_edges(spark):
    vals = ["词甲=0.418 词乙=0.403", "", " ", "a", "a=", "=", "a=1 a=2", "a=1  b=2", "a=x", None]
    out = [[(t.word, t.weight) for t in r] for r in many(spark, fn.parse_tags, vals)]
    assert out == [
        [("词甲", 0.418), ("词乙", 0.403)], [], [], [("a", 1.0)], [("a", 1.0)], [],
        [("a", 1.0), ("a", 2.0)], [("a", 1.0), ("b", 2.0)], [("a", 1.0)], []]


def test_parse_keywords_and_format(spark):
    s = "817:-1;193:-1;141:词己=2.607 词庚=1.953;bad"
    out = [(c.category, c.tags) for c in one(spark, fn.parse_keywords(F.col("s")), s)]
    assert out == [("817", "-1"), ("193", "-1"), ("141", "词己=2.607 词庚=1.953")]
    df = spark.createDataFrame([(s, ""), (s, "t=1"), ("民国=1.0", ""), ("", "")], "s string, t string")
    assert [r[0] for r in df.select(fn.is_keyword_format(F.col("s"), F.col("t"))).collect()] == \
        [True, False, False, True]


def test_unwrap_parens(spark):
    vals = ["(201901001, , , )", "x(ab(cd)", "no parens", "a()", "(", None]
    assert many(spark, fn.unwrap_parens, vals) == ["201901001, , , ", "ab", "", "", "", None]


def test_split_field(spark):
    line = ",".join(str(i) for i in range(30))
    assert many(spark, lambda c: fn.split_field(c, 24), [line, "a,b", "a,,,"]) == ["24", None, None]
    assert many(spark, lambda c: fn.split_field(c, 3), ["a,,,"]) == [""]


def test_vector_math(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [1.0, 2.0, 3.0]),
                                ([-5.0], [2.0]),
                                ([0.0, 0.0], [1.0, 1.0]),
                                ([1.0, 0.0], [0.0, 1.0])], "a array<double>, b array<double>")
    r = df.select(fn.l1_norm(F.col("a")).alias("l1"), fn.l2_norm(F.col("a")).alias("l2"),
                  fn.cosine(F.col("a"), F.col("b")).alias("c"),
                  fn.cosine(F.col("b"), F.col("a")).alias("c2")).collect()
    assert r[0].l1 == 6.0 and math.isclose(r[0].l2, math.sqrt(14))
    assert math.isclose(r[0].c, 1.0)
    assert r[1].l1 == 5.0          # true L1 (the sign is not kept)
    assert r[2].c == 0.0           # zero norm -> 0
    assert r[3].c == 0.0 and all(x.c == x.c2 for x in r)


def test_fit_dim_and_parse_line(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0, 2.0, 3.0, 4.0],), (None,)], "v array<double>")
    assert [r[0] for r in df.select(fn.fit_dim(F.col("v"), 3)).collect()] == \
        [[1.0, 2.0, 0.0], [0.0, 0.0, 0.0], [0.0, 0.0, 0.0]]
    r = one(spark, fn.parse_vector_line(F.col("s")), "word 0.5 -1 2")
    assert r.word == "word" and r.vec == [0.5, -1.0, 2.0]
    for messy in ("word 0.5 -1 2 ", " word  0.5 -1   2"):
        r = one(spark, fn.parse_vector_line(F.col("s")), messy)
        assert r.word == "word" and r.vec == [0.5, -1.0, 2.0]


def test_valid_shards():
    got = fn.valid_shards()
    assert got[0] == "2018_08" and got[-1] == "2019_12" and len(got) == 17
