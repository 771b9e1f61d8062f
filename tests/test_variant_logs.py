"""The one-parse log job against the job on declared schemas, and literals."""

import json

import pytest
from pyspark.sql import functions as F

from driftwood import operators as op
from driftwood.plans import jobs
from driftwood.schemas import TRAINING_COLUMNS
from driftwood.sources import parse_logs
from .test_logs import CLK, IMP, S, log, texts


def lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def edited(line, **fields):
    return json.dumps({**json.loads(line), **fields})


ODD = [
    edited(log("40", "o1", "d1", "2024-01-01 08:00:00", "e23"), p30=None, e2="text in place of an object"),
    edited(log("41", "o2", "d1", "2024-01-01 08:00:00", "e23"), p5=7, p6=True, p7=None, e11=3, p30={"p31": None, "e11": 1}),
    edited(log("42", "o3", "d1", "2024-01-01 08:00:00", "e23"), e2={"e3": None, "e4": "ü,\"x\"", "e5": 12345678901234567890}),
    edited(log("43", "o4", "d1", "2024-01-01 08:00:00", "e24"), e23=None),  # the click object of an impression line
    edited(log("44", "o5", None, "no time", "e23")),
    "", "null", "[]", "7", '"e23"', '{"e23": "no object"}', '{"e23": {"o2": {"e30": null}}}', '{"e23": {"o2": []}}',
]


def both_jobs(spark, imp, clk, text):
    if text:
        old = op.flatten_text(jobs.labelled_logs(imp, clk, S))
    else:
        old = jobs.training_rows(imp, clk, S)
    return tuple(sorted(map(repr, df.collect())) for df in (old, jobs.training_rows_variant(imp, clk, S, text)))


@pytest.mark.parametrize("text", [False, True])
def test_same_rows_as_the_declared_schema(spark, text):
    imp, clk = texts(spark)
    old, new = both_jobs(spark, imp, clk, text)
    assert old == new and len(new) > 5
    odd = lines(spark, IMP + ODD)
    old, new = both_jobs(spark, odd, lines(spark, CLK + ODD), text)
    assert old == new and any("o2" in r for r in new)


@pytest.mark.parametrize("text", [False, True])
def test_no_lines(spark, text):
    none = lines(spark, [])
    assert both_jobs(spark, none, none, text) == ([], [])


def test_absent_and_null_keys(spark):
    line = json.dumps({"p1": "50", "p3": "2024-01-01 08:00:00", "p30": {"p31": None, "p33": "x"},
                       "e23": {"e15": "c", "e12": None, "o2": {"e30": S, "e37": {"l1": None}}}, "e2": None})
    value = jobs.training_rows_variant(lines(spark, [line]), lines(spark, []), S, text=True).first().value
    row = dict(zip(TRAINING_COLUMNS, value.split(","), strict=True))
    assert (row["p31"], row["p32"], row["p33"]) == ("null", "", "x")
    assert (row["e12"], row["e14"], row["content_id"]) == ("null", "", "c")
    assert (row["l1"], row["l2"], row["e3"], row["p5"]) == ("null", "", "", "null")


def test_click_with_both_objects_is_deduplicated_by_its_own(spark):
    def click(p1, own, other):
        return edited(log(p1, own, "d1", "2024-01-01 10:00:00", "e24"),
                      e23=json.loads(log(p1, other, "d1", "2024-01-01 10:00:00", "e23"))["e23"])
    clk = lines(spark, [click("61", "k1", "a"), click("62", "k2", "a"), click("63", "k1", "b")])
    for text in (False, True):
        old, new = both_jobs(spark, lines(spark, IMP), clk, text)
        assert old == new


def test_ties_of_time_and_record_id_do_not_depend_on_the_order_of_lines(spark):
    same = [edited(log("70", "t", "d1", "2024-01-01 08:00:00", "e23"), p5=str(k)) for k in range(20)]
    none = lines(spark, [])
    kept = {jobs.training_rows_variant(lines(spark, rows).repartition(n), none, S).first().p5
            for rows in (same, same[::-1]) for n in (1, 3)}
    assert len(kept) == 1


def test_one_parse_a_line(spark, tmp_path):
    for name, rows in (("imp", IMP), ("clk", CLK)):
        lines(spark, rows).write.text(str(tmp_path / name))
    imp, clk = (spark.read.text(str(tmp_path / n)) for n in ("imp", "clk"))

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString().lower()
    for text in (False, True):
        new = plan(jobs.training_rows_variant(imp, clk, S, text))
        # one a side; nothing reads JSON text but these
        assert new.count("parse_json") + new.count("parsejson") == 2
        assert "from_json" not in new and "jsontostructs" not in new and "get_json_object" not in new


def test_numbers_are_held_by_value(spark):
    line = log("80", "n", "d1", "2024-01-01 08:00:00", "e23").replace('"p1": "80"', '"p1": 1.50')
    assert '"p1": 1.50' in line
    doc = op.with_log(op.parse_variant(lines(spark, [line])))
    assert doc.first().log.p1 == "1.5"
    assert parse_logs(lines(spark, [line])).select(F.col("log.p1")).first().p1 in ("1.5", "1.50")


def test_a_key_named_twice_is_no_json(spark):
    assert op.parse_variant(lines(spark, ['{"p1": "1", "p1": "2"}'])).first().doc is None
