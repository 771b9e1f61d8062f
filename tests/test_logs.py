import json

from pyspark.sql import functions as F

from driftwood import operators as op
from driftwood.plans import jobs
from driftwood.schemas import CLICK_KEY, IMPRESSION_KEY, TRAINING_COLUMNS
from driftwood.sources import parse_logs

from .conftest import plan_text, rows

S = 7  # strategy code


def log(p1, cid, dev, t, side, e30=S, **extra):
    item = {"e12": "pos", "e14": "list", "e15": cid,
            "o2": {"e30": e30, "e31": "r", "e35": "s", "e36": "t",
                   "e37": {"l1": "a", "l2": "b"}, "e38": "x"}}
    d = {"p1": p1, "p3": t, "p6": "ch", "p17": dev,
         "p30": {"p31": "1", "p32": "2", "p33": "3"},
         "e2": {"e3": "m", "e39": "z"}, side: item}
    d.update(extra)
    return json.dumps(d, ensure_ascii=False)


IMP = [
    log("1", "c1", "d1", "2024-01-01 08:00:00", "e23"),                 # matched by click 101
    log("2", "c1", "d1", "2024-01-01 09:00:00", "e23"),                 # duplicate same day
    log("3", "c2", "d1", "2024-01-01 08:00:00", "e23"),                 # impression only
    log("4", "c1", "d1", "2024-01-02 08:00:00", "e23"),                 # same pair, next day
    log("5", "c3", "d2", "2024-01-01 08:00:00", "e23", e30=8),          # other strategy
    log("6", "c4", "d2", "2024-01-01 08:00:00", "e23", e30="7"),        # code as text
    '{"p1":"7","e23":{"e15":"c9"',                                        # malformed
    json.dumps({"p1": "8", "p5": "e23", "p3": "2024-01-01 1:00:00"}),    # "e23" only as a value
    log("9", "c5", None, "2024-01-01 08:00:00", "e23"),                 # null device
    log("10", "ab", "c", "2024-01-03 08:00:00", "e23"),                 # collides with a+bc
    log("11", "a", "bc", "2024-01-03 08:00:00", "e23"),
]
CLK = [
    log("101", "c1", "d1", "2024-01-01 10:00:00", "e24"),
    log("102", "c6", "d3", "2024-01-01 10:00:00", "e24"),               # click only
    log("103", "c5", None, "2024-01-01 11:00:00", "e24"),               # null device, matches 9
    log("104", "c7", "d3", "2024-01-01 10:00:00", "e24", e30=1),        # other strategy
]


def texts(spark):
    imp = spark.createDataFrame([(x,) for x in IMP], "value string")
    clk = spark.createDataFrame([(x,) for x in CLK], "value string")
    return imp, clk


def test_strategy_filter(spark):
    imp, clk = texts(spark)
    f = op.strategy_filter(parse_logs(imp, IMPRESSION_KEY), IMPRESSION_KEY, S)
    assert sorted(r[0] for r in f.select("log.p1").collect()) == \
        sorted(["1", "2", "3", "4", "6", "9", "10", "11"])
    g = op.strategy_filter(parse_logs(clk, CLICK_KEY), CLICK_KEY, S)
    assert sorted(r[0] for r in g.select("log.p1").collect()) == ["101", "102", "103"]


def test_click_label(spark):
    imp, clk = texts(spark)
    lab = jobs.labelled_logs(imp, clk, S)
    got = rows(lab.select("content_id", "device_id", "day", "is_click", "side",
                          F.col("log.p1").alias("p1")))
    assert got == sorted([
        ("a", "bc", "2024-01-03", 0, "imp", "11"),
        ("ab", "c", "2024-01-03", 0, "imp", "10"),
        ("c1", "d1", "2024-01-01", 1, "imp", "1"),   # earliest duplicate survives
        ("c1", "d1", "2024-01-02", 0, "imp", "4"),
        ("c2", "d1", "2024-01-01", 0, "imp", "3"),
        ("c4", "d2", "2024-01-01", 0, "imp", "6"),
        ("c5", None, "2024-01-01", 1, "imp", "9"),   # null device groups with null device
        ("c6", "d3", "2024-01-01", 0, "click", "102"),  # click without impression kept
    ], key=lambda t: tuple((x is not None, x) for x in t))


def test_label_partition_property(spark):
    imp, clk = texts(spark)
    lab = jobs.labelled_logs(imp, clk, S)
    both = lab.where("is_click = 1").count()
    imp_only = lab.where("is_click = 0 AND side = 'imp'").count()
    clk_only = lab.where("side = 'click'").count()
    assert both + imp_only + clk_only == lab.count() == lab.select("content_id", "device_id", "day").distinct().count()


def test_click_label_single_shuffle(spark):
    imp, clk = texts(spark)
    lab = jobs.labelled_logs(imp, clk, S)
    lab.collect()
    final = plan_text(lab)
    assert "PythonUDF" not in final and "BatchEvalPython" not in final
    # one shuffle of both sides, the pairing aggregate (dedup of impressions folded into it); before it
    # one of the clicks, which are deduplicated by a key of their own
    assert final.count("Exchange hashpartitioning") == 2
    assert final.count("partial_min(") == 3 and "min_by" not in final   # one record buffer each, and a flag


def test_ties_are_settled_by_the_record(spark):
    a = log("1", "c1", "d1", "2024-01-01 08:00:00", "e23", p6="a")
    b = log("1", "c1", "d1", "2024-01-01 08:00:00", "e23", p6="b")
    none = spark.createDataFrame([], "value string")
    for lines in ([a, b], [b, a]):
        lab = jobs.labelled_logs(spark.createDataFrame([(x,) for x in lines], "value string").repartition(2), none, S)
        assert [r[0] for r in lab.select("log.p6").collect()] == ["a"]


def test_flatten_columns(spark):
    e37_bad = json.loads(log("20", "c8", "d9", "2024-01-05 00:00:00", "e23"))
    e37_bad["e23"]["o2"]["e37"] = "not an object"
    no_p30 = json.loads(log("21", "c8", "d8", "2024-01-05 00:00:00", "e23"))
    del no_p30["p30"], no_p30["e2"]
    gated = json.loads(log("22", "c8", "d7", "2024-01-05 00:00:00", "e23"))
    gated["p30"]["e11"] = "inner"
    gated["e11"] = "top"
    comma = json.loads(log("23", "c8", "d6", "2024-01-05 00:00:00", "e23"))
    comma["p6"] = "a,b"
    no_e37 = json.loads(log("24", "c8", "d5", "2024-01-05 00:00:00", "e23"))
    del no_e37["e23"]["o2"]["e37"]
    gated_only = json.loads(log("25", "c8", "d4", "2024-01-05 00:00:00", "e23"))
    gated_only["p30"]["e11"] = "inner"            # no top-level e11
    lines = [json.dumps(x) for x in (e37_bad, no_p30, gated, comma, no_e37, gated_only)]
    lab = jobs.labelled_logs(spark.createDataFrame([(x,) for x in lines], "value string"),
                             spark.createDataFrame([], "value string"), S)
    flat = op.flatten_log(lab)
    assert flat.columns == TRAINING_COLUMNS and len(flat.columns) == 39
    by = {r.p1: r for r in flat.collect()}
    assert by["20"].l1 is None and by["20"].e31 == "r"          # bad e37 keeps the rest
    assert by["21"].p31 is None and by["21"].e3 is None         # missing p30 / e2 are null-safe
    assert by["22"].e11 == "top"                                # gated on p30.e11, read at top
    assert by["20"].e11 is None
    assert by["23"].content_id == "c8"
    assert (by["24"].l1, by["24"].l2, by["24"].e38) == (None, None, "x")
    assert by["25"].e11 is None
    txt = {r.value.split(",")[1]: r.value for r in op.flatten_text(lab).collect()}
    assert txt["23"].split(",")[24] != "c8"                     # comma shifts positions (unquoted)
    assert txt["21"].split(",")[18] == ""                       # absent 18+ -> empty
    assert txt["21"].split(",")[6] == "null"                    # absent 1-17 -> null
    assert txt["25"].split(",")[21] == "null"                   # p30.e11 there, top-level e11 absent
    assert txt["22"].split(",")[21] == "top" and txt["20"].split(",")[21] == ""


def test_present_nulls_render_as_null(spark):
    d = json.loads(log("40", "c1", "d1", "2024-01-05 00:00:00", "e23"))
    d["p30"]["p31"], d["e2"]["e3"], d["e23"]["e12"] = None, None, None
    d["e23"]["o2"]["e31"], d["e23"]["o2"]["e37"]["l2"] = None, None
    del d["p30"]["p32"], d["e23"]["o2"]["e35"]
    lab = jobs.labelled_logs(spark.createDataFrame([(json.dumps(d),)], "value string"),
                             spark.createDataFrame([], "value string"), S)
    v = dict(zip(TRAINING_COLUMNS, op.flatten_text(lab).first().value.split(","), strict=True))
    assert [v[c] for c in ("p31", "e3", "e12", "e31", "l2")] == ["null"] * 5
    assert [v[c] for c in ("p32", "e35", "e4")] == [""] * 3
    assert (v["p33"], v["l1"], v["content_id"]) == ("3", "a", "c1")
    assert op.flatten_log(lab).first().p31 is None


def test_flatten_click_fallback_and_missing_item(spark):
    clk_only = log("30", "c1", "d1", "2024-01-01 00:00:00", "e24")
    lab = jobs.labelled_logs(spark.createDataFrame([], "value string"),
                             spark.createDataFrame([(clk_only,)], "value string"), S)
    r = op.flatten_log(lab).collect()[0]
    assert r.content_id == "c1" and r.e12 == "pos" and r.is_click == 0
    # a record with neither item object renders nine empty fields in 22-30
    line = log("31", "x", "y", "2024-01-01 00:00:00", "e9")
    none = parse_logs(spark.createDataFrame([(line,)], "value string"), keep_value=True).withColumn("is_click", F.lit(0))
    v = op.flatten_text(none).collect()[0].value
    assert v.split(",")[22:31] == [""] * 9 and len(v.split(",")) == 39


def test_label_json(spark):
    imp, clk = texts(spark)
    lab = jobs.labelled_logs(imp, clk, S)
    js = op.label_json(lab).collect()
    docs = [json.loads(r.value) for r in js]
    assert all(d["isClick"] in ("0", "1") and "log" in d for d in docs)
    assert sum(d["isClick"] == "1" for d in docs) == 2


def test_dedup_daily(spark):
    imp, _ = texts(spark)
    f = op.with_pair_key(op.strategy_filter(parse_logs(imp, IMPRESSION_KEY), IMPRESSION_KEY, S))
    d = op.dedup_daily(f)
    assert d.count() == 7
    assert rows(d.where("content_id = 'c1' AND day = '2024-01-01'").select("log.p1")) == [("1",)]


def test_prefilter_only_narrows(spark):
    imp, _ = texts(spark)
    trunc = '{"p1":"50","p3":"2024-01-01 00:00:00","e23":{"e15":"c1","o2":{"e30":7}'
    t = imp.union(spark.createDataFrame([(trunc,)], "value string"))
    pre = op.strategy_prefilter(t, IMPRESSION_KEY, S)
    exact = op.strategy_filter(parse_logs(pre), IMPRESSION_KEY, S)
    full = op.strategy_filter(parse_logs(t, IMPRESSION_KEY), IMPRESSION_KEY, S)
    assert rows(exact.select("log.p1")) == rows(full.select("log.p1"))
    assert "50" not in {r[0] for r in exact.select("log.p1").collect()}


def test_a_click_line_that_holds_both_objects(spark):
    """Clicks are deduplicated by their own object's id and paired by the
    impression object's, if the line holds one."""
    def line(p1, imp=None, clk=None):
        item = lambda cid: {"e15": cid, "o2": {"e30": 0}}
        log = {"p1": p1, "p3": "2024-01-05 10:00:00", "p17": "d"}
        log |= ({"e23": item(imp)} if imp else {}) | ({"e24": item(clk)} if clk else {})
        return (json.dumps(log),)

    def run(imps, clks):
        frames = [spark.createDataFrame(x or [("{}",)], "value string") for x in (imps, clks)]
        got = jobs.labelled_logs(*frames, 0).select("content_id", "is_click", "side", F.col("log.p1").alias("p1")).collect()
        return sorted(map(tuple, got))
    # same click id: one of the two clicks goes, whatever impression they name
    assert run([], [line(1, "A", "X"), line(2, "B", "X")]) == [("A", 0, "click", "1")]
    # other click ids under one impression id: both stay, and meet as a pair
    assert run([], [line(1, "A", "X"), line(2, "A", "Y")]) == [("A", 1, "click", "1")]
    # the pairing key is the impression object's
    assert run([line(5, "A")], [line(1, "A", "X")]) == [("A", 1, "imp", "5")]
    assert run([line(5, "X")], [line(1, "A", "X")]) == [("A", 0, "click", "1"), ("X", 0, "imp", "5")]
    assert run([line(5, "X")], [line(1, None, "X"), line(2, None, "X")]) == [("X", 1, "imp", "5")]


def test_dropped_lines_are_counted(spark, tmp_path):
    from driftwood.plans import daily
    ok = '{"p1":"1","p3":"2024-01-05 10:00:00","p17":"d","%s":{"e15":"c","o2":{"e30":%s}}}'
    lines = {"imp": [ok % ("e23", 7), ok % ("e23", '"7"'), ok % ("e23", 8), ok % ("e24", 7), '{"p1":"1","e23":{"o2"', "", "[]", "plain",
                     ok % ("e23", "null"), '{"e23":null}'], "clk": [ok % ("e24", 7), ok % ("e24", 1)]}
    for side, text in lines.items():
        (tmp_path / side / "20240105").mkdir(parents=True)
        (tmp_path / side / "20240105" / "part").write_text("\n".join(text) + "\n")
    out = str(tmp_path / "rejects")
    got = daily.run_rejects(spark, str(tmp_path / "imp" / "20240105"), str(tmp_path / "clk" / "20240105"), 7, out)
    assert got["imp_read"] == sum(got[f"imp_{f}"] for f in ("kept", "malformed", "no_side", "other_strategy"))
    assert got["imp_kept"] == 2 and got["click_read"] == 2 and got["click_kept"] == 1 and got["click_other_strategy"] == 1
    assert got["imp_other_strategy"] == 2 and got["imp_no_side"] == 3 and got["imp_malformed"] == got["imp_read"] - 7
    saved = spark.read.parquet(out)
    assert saved.count() == got["imp_read"] + got["click_read"] - 3
    assert {r.side for r in saved.select("side").collect()} == {"imp", "click"} and "day" in saved.columns


def test_clicks_travel_as_lines_and_are_parsed_again(spark):
    """Deduplicated clicks: the parsed log is not shuffled beside its line."""
    def parse(t):
        return parse_logs(t, keep_value=True)
    clicks = parse(spark.createDataFrame([(x,) for x in [*CLK, *CLK]], "value string"))
    clicks = op.strategy_filter(clicks, CLICK_KEY, S)
    one, again = op.dedup_clicks(clicks), op.dedup_clicks(clicks, parse=parse)
    assert set(one.columns) == set(again.columns)
    cols = ("content_id", "device_id", "day", "value")
    assert rows(again, *cols) == rows(one, *cols) and rows(again.select("log.p1")) == rows(one.select("log.p1"))
    assert "._keep.log" in plan_text(one) and "._keep.log" not in plan_text(again)
