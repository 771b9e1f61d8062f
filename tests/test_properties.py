"""Property tests: scalar operators against Python models of the source
semantics, many generated strings per Spark job."""

import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from driftwood import functions as fn

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def run(spark, colfn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(colfn(F.col("s"))).collect()]


def model_parse_tags(s):
    if s is None:
        return []
    out = []
    for tok in s.strip(" ").split(" "):
        parts = tok.split("=")
        word = parts[0]
        w = 1.0
        if len(parts) > 1 and parts[1].strip(" "):
            try:
                w = float(parts[1].strip(" "))
            except ValueError:
                w = 1.0
        if word.strip(" "):
            out.append((word, w))
    return out


tag_text = st.text(alphabet="abc019.-= ", max_size=30)


@SETTINGS
@given(st.lists(st.one_of(st.none(), tag_text), min_size=1, max_size=40))
def test_parse_tags_model(spark, values):
    got = [[(t.word, t.weight) for t in r] for r in run(spark, fn.parse_tags, values)]
    assert got == [model_parse_tags(v) for v in values]


def model_is_numeric(s):
    return s is not None and all(unicodedata.category(c) == "Nd" for c in s)


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789a ٣²", max_size=8)),
                min_size=1, max_size=40))
def test_is_numeric_model(spark, values):
    assert run(spark, fn.is_numeric, values) == [model_is_numeric(v) for v in values]


def model_unwrap(s):
    if s is None:
        return None
    i = s.find("(")
    if i < 0:
        return ""
    rest = s[i + 1:]
    cut = [j for j in (rest.find("("), rest.find(")")) if j >= 0]
    return rest[:min(cut)] if cut else rest


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab,() ", max_size=20)),
                min_size=1, max_size=40))
def test_unwrap_parens_model(spark, values):
    assert run(spark, fn.unwrap_parens, values) == [model_unwrap(v) for v in values]


def model_shard(cid, years=("2018", "2019"), start_year="2018", start_month=8):
    if cid is None or len(cid) < 6:
        return None
    y, m = cid[:4], cid[4:6]
    try:
        mi = int(m.strip())
    except ValueError:
        return None
    if (y == start_year and mi < start_month) or y not in years or mi > 12:
        return None
    return f"{y}_{m}"


ids = st.one_of(
    st.none(),
    st.builds(lambda y, m, r: f"{y}{m:02d}{r}", st.sampled_from(["2017", "2018", "2019", "2020"]),
              st.integers(0, 14), st.text(alphabet="0123456789", max_size=4)),
    st.text(alphabet="0123456789ab", max_size=7))


@SETTINGS
@given(st.lists(ids, min_size=1, max_size=40))
def test_shard_label_model(spark, values):
    assert run(spark, fn.shard_label, values) == [model_shard(v) for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab,", max_size=12)), min_size=1, max_size=40),
       st.integers(0, 4))
def test_split_field_model(spark, values, idx):
    def model(s):
        if s is None:
            return None
        parts = s.split(",")
        return parts[idx] if idx < len(parts) else None
    assert run(spark, lambda c: fn.split_field(c, idx), values) == [model(v) for v in values]


def model_format(js):
    s = "" if js is None else js
    s = s.replace('{"v8":{"', "").replace('":{"weight":', "=").replace('},"', " ")
    s = s.replace("}}}", "").replace(" =", "=")
    return s.replace('{"v99":{"', "")


words = st.text(alphabet="abc词甲", min_size=1, max_size=4)
tag_json = st.builds(
    lambda prefix, pairs: prefix + ",".join(f'"{w}":{{"weight":{x}}}' for w, x in pairs) + "}}",
    st.sampled_from(['{"v8":{', '{"v99":{']),
    st.lists(st.tuples(words, st.floats(0, 5, allow_nan=False).map(lambda f: round(f, 3))),
             min_size=1, max_size=4))


@SETTINGS
@given(st.lists(st.one_of(st.none(), tag_json), min_size=1, max_size=20))
def test_format_tags_model(spark, values):
    assert run(spark, fn.format_content_tags, values) == [model_format(v) for v in values]


vec = st.lists(st.floats(-100, 100, allow_nan=False, allow_infinity=False), min_size=3, max_size=3)


@SETTINGS
@given(st.lists(st.tuples(vec, vec), min_size=1, max_size=30))
def test_cosine_properties(spark, pairs):
    import math

    import numpy as np
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)],
                               "i int, a array<double>, b array<double>")
    r = df.orderBy("i").select(fn.cosine(F.col("a"), F.col("b")).alias("ab"),
                               fn.cosine(F.col("b"), F.col("a")).alias("ba"),
                               fn.cosine(F.col("a"), F.col("a")).alias("aa"),
                               fn.l2_norm(F.col("a")).alias("n"),
                               fn.l1_norm(F.col("a")).alias("l1")).collect()
    for (a, b), x in zip(pairs, r):
        na, nb = np.linalg.norm(a), np.linalg.norm(b)
        exp = float(np.dot(a, b) / (na * nb)) if na * nb > 0 else 0.0
        assert x.ab == x.ba and -1 - 1e-9 <= x.ab <= 1 + 1e-9
        assert math.isclose(x.ab, exp, rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(x.n, na, rel_tol=1e-12, abs_tol=1e-12)
        assert math.isclose(x.l1, float(np.abs(a).sum()), rel_tol=1e-12, abs_tol=1e-12)
        if na > 0:
            assert math.isclose(x.aa, 1.0, rel_tol=1e-9)


@SETTINGS
@given(st.lists(st.one_of(st.none(), tag_text), min_size=1, max_size=40))
def test_tag_tokens_agree_with_parse_tags(spark, values):
    from driftwood.operators import tag_tokens
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    exploded = {}
    for r in tag_tokens(df, "s", ["i"]).collect():
        exploded.setdefault(r.i, []).append((r.pos, r.word, r.weight))
    arrays = {r.i: [(t.word, t.weight) for t in r.a]
              for r in df.select("i", fn.parse_tags(F.col("s")).alias("a")).collect()}
    for i in range(len(values)):
        assert [(w, x) for _, w, x in sorted(exploded.get(i, []))] == arrays[i]


event = st.tuples(st.sampled_from(["imp", "click"]), st.sampled_from(["c1", "c2", "c3"]),
                  st.sampled_from(["d1", "d2", None]), st.sampled_from(["2024-01-01", "2024-01-02"]),
                  st.integers(0, 23))


@SETTINGS
@given(st.lists(event, min_size=1, max_size=60))
def test_click_label_model(spark, events):
    import json

    from driftwood.operators import click_label, with_pair_key
    from driftwood.sources import parse_logs

    def line(i, side, cid, dev, day, hour):
        item = {"e15": cid, "o2": {"e30": 7}}
        d = {"p1": str(i), "p3": f"{day} {hour:02d}:00:00", "p17": dev,
             "e23" if side == "imp" else "e24": item}
        return json.dumps(d)

    rows = [(e[0], line(i, *e)) for i, e in enumerate(events)]
    imp = spark.createDataFrame([(v,) for s, v in rows if s == "imp"], "value string")
    clk = spark.createDataFrame([(v,) for s, v in rows if s == "click"], "value string")
    got = {(r.content_id, r.device_id, r.day): (r.is_click, r.side, r.p1) for r in
           click_label(with_pair_key(parse_logs(imp)), with_pair_key(parse_logs(clk)))
           .select("content_id", "device_id", "day", "is_click", "side", "log.p1").collect()}

    # model: first record per (key, side) by (time text, id); both sides -> 1 with the impression
    first = {}
    for i, (side, cid, dev, day, hour) in enumerate(events):
        k, t = (cid, dev, day), (f"{day} {hour:02d}:00:00", i)
        if (k, side) not in first or t < first[(k, side)]:
            first[(k, side)] = t
    exp = {}
    for (k, side), (_, i) in first.items():
        has_imp, has_clk = (k, "imp") in first, (k, "click") in first
        if side == "imp" or not has_imp:
            exp[k] = (int(has_imp and has_clk), side, str(i))
    assert got == exp


@SETTINGS
@given(st.lists(st.sampled_from(["201808001", "201907001", "201809002", "201807001", "201713999",
                                 "2019", "201912777", "201808001"]), min_size=1, max_size=30),
       st.booleans())
def test_content_lookup_model(spark, ids, distinct_input):
    from driftwood.operators import content_lookup

    from .test_content import tables
    if distinct_input:
        ids = sorted(set(ids))
    found = {"201808001": "3", "201907001": "1"}       # in all three tables and in a valid shard
    df = spark.createDataFrame([(i,) for i in ids], "content_id string")
    out = content_lookup(df, *tables(spark), ids_distinct=distinct_input)
    got = sorted((r.content_id, r.body_images_count) for r in out.collect())
    assert got == sorted((i, found.get(i, " ")) for i in ids)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["x", "y", "z"]), st.sampled_from(["a", "b", "c", "zz"]),
                          st.floats(-5, 5, allow_nan=False).map(lambda f: round(f, 2))),
                min_size=1, max_size=40))
def test_tag_vector_model(spark, toks):
    import math

    import numpy as np

    from driftwood.operators import tag_vector
    vocab = {"a": [1.0, 2.0, 0.5], "b": [0.0, -1.0, 3.0], "c": [2.0, 2.0, 2.0]}
    v = spark.createDataFrame(list(vocab.items()), "word string, vec array<float>")
    t = spark.createDataFrame(toks, "id string, word string, weight double")
    got = {r.id: r.vec for r in tag_vector(t, v, "id", 3).collect()}
    exp = {}
    for i, w, x in toks:
        exp[i] = exp.get(i, np.zeros(3)) + (np.array(vocab[w]) * x if w in vocab else 0)
    assert set(got) == set(exp)
    for i in exp:
        assert all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip(got[i], exp[i]))
