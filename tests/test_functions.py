"""Column functions: micro cases (short/empty phones, midnight, malformed JSON, numbers in string fields)."""

import datetime as dt

from pyspark.sql import functions as F, types as T

from martpulse.functions.jsonrec import parse_json
from martpulse.functions.masking import mask_phone
from martpulse.functions.text import query_tokens, tokens
from martpulse.functions.timeparts import (age_years, create_date, create_hour, previous_day,
                                           with_time_parts)
from martpulse.operators.route import route_logs


def test_mask_styles_short_and_empty(spark):
    df = spark.createDataFrame([("13812345678",), ("12",), ("",), (None,)], "tel string")
    rows = df.select(mask_phone("tel", "prefix").alias("p"), mask_phone("tel", "middle").alias("m")).collect()
    assert [(r.p, r.m) for r in rows] == [
        ("1381******", "138****5678"), ("12******", "12****"), ("******", "****"), (None, None)]


def test_time_parts_from_ms_around_midnight(spark):
    # 2024-01-14 23:59:59.999 UTC and 2024-01-15 00:00:00.000 UTC
    ms = [1705276799999, 1705276800000]
    df = spark.createDataFrame([(m,) for m in ms], "ts long")
    rows = with_time_parts(df, "ts", from_ms=True).orderBy("ts").collect()
    assert [(r.log_date, r.log_hour) for r in rows] == [("2024-01-14", "23"), ("2024-01-15", "00")]


def test_create_parts_and_bad_input(spark):
    df = spark.createDataFrame([("2024-01-15 07:08:09",), ("garbage",), (None,)], "t string")
    rows = df.select(create_date("t").alias("d"), create_hour("t").alias("h")).collect()
    assert [(r.d, r.h) for r in rows] == [("2024-01-15", "07"), ("garbage", None), (None, None)]


def test_age_years_truncates(spark):
    df = spark.createDataFrame([("2000-01-02",), ("2000-01-01",), ("not a date",)], "b string")
    as_of = F.lit("2021-01-01").cast("date")
    ages = [r.a for r in df.select(age_years("b", as_of).alias("a")).collect()]
    want = [(dt.date(2021, 1, 1) - dt.date(2000, 1, 2)).days // 365,
            (dt.date(2021, 1, 1) - dt.date(2000, 1, 1)).days // 365, None]
    assert ages == want


def test_previous_day():
    assert previous_day("2024-03-01") == "2024-02-29"
    assert previous_day("2024-13-01") is None


def test_parse_json_good_bad_and_number_in_string_field(spark):
    df = spark.createDataFrame([('{"id": 12, "name": "x"}',), ("not json",), ('{"name": true}',)], "value string")
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType())])
    good, bad = parse_json(df, schema)
    assert {(r.id, r.name) for r in good.collect()} == {("12", "x"), (None, "true")}
    assert [r.value for r in bad.collect()] == ["not json"]


def test_stamp_keeps_fields_and_overwrites_ts(spark):
    df = spark.createDataFrame([('{"type":"startup","mid":"m1","ts":1}',), ('{"evid":"coupon"}',), ("{bad",)],
                               "value string")
    out = route_logs(df, stamp=F.lit(99)).collect()
    by_topic = {r.topic: r.value for r in out}
    assert set(by_topic) == {"startup", "event", None}
    import json
    s = json.loads(by_topic["startup"])
    assert s == {"type": "startup", "mid": "m1", "ts": "99"}
    assert json.loads(by_topic["event"]) == {"evid": "coupon", "ts": "99"}
    assert by_topic[None] is None


def test_tokens(spark):
    df = spark.createDataFrame([("Red-ish, RED; blue  42",)], "t string")
    assert df.select(tokens("t").alias("x")).first().x == ["red", "ish", "red", "blue", "42"]
    assert query_tokens(spark, "Red  blue! red") == ["red", "blue"]
    assert query_tokens(spark, "  ") == []
