"""Edge rows for the scalar functions (FIXTURES.md §4) and the hash input."""

import datetime as dt
import hashlib
import json

from pyspark.sql import functions as F

from bookflow.functions.identity import json_string, record_hash, record_key
from bookflow.functions.naming import label_value, landing_object_path, manual_object_path, run_id_for
from bookflow.functions.parse import map_with_fallback, parse_date, parse_int, parse_time
from bookflow.schema import CHANNEL_MAP_EXECUTED, DATE_FORMATS_EXECUTED, DATE_FORMATS_EXTENDED


def _one_col(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r[0] for r in df.select(expr(F.col("s"))).collect()]


def test_parse_int(spark):
    got = _one_col(spark, ["4名", "0", " 12", "12.7", "x", "４", "", None, "-3", "+5", "99999999999999999999"], parse_int)
    assert got == [4, 0, 12, 12, None, None, None, None, -3, 5, None]


def test_parse_time(spark):
    got = _one_col(spark, ["9:05", "18:30以降", "18:30:4", "9:5", "25:00", "18:30:45", "", None], parse_time)
    assert got == ["09:05:00", "18:30:00", "18:30:00", None, "25:00:00", "18:30:45", None, None]


def test_parse_date_order_and_strictness(spark):
    vals = ["2024-01-15", "2024/01/15", "01/15/2024", "15/01/2024", "03/04/2024", "2024-02-31", "", "not-a-date",
            "2024年01月15日"]
    got = _one_col(spark, vals, lambda c: parse_date(c, DATE_FORMATS_EXECUTED))
    d = dt.date(2024, 1, 15)
    assert got == [d, d, d, d, dt.date(2024, 3, 4), None, None, None, None]
    ext = _one_col(spark, ["2024年01月15日"], lambda c: parse_date(c, DATE_FORMATS_EXTENDED))
    assert ext == [d]


def test_guarded_dates_equal_plain_chain(spark):
    vals = ["0998-01-05", "998-01-05", "5/3/0998", "13/12/2024", "2024-001-05", "001/05/2024", "12/13/2024",
            "02/30/2024", "30/02/2024", "+2024-01-05", "1/1/2024", "2024/1/1"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    plain = F.coalesce(*[F.try_to_date("s", f) for f in DATE_FORMATS_EXTENDED])
    rows = df.select(plain.alias("a"), parse_date(F.col("s"), DATE_FORMATS_EXTENDED).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in rows)


def test_channel_standardise(spark):
    got = _one_col(spark, ["食べログ", "Walk  In", "Walk　In", "", None, "ぐるなび"],
                   lambda c: map_with_fallback(c, CHANNEL_MAP_EXECUTED))
    assert got == ["tabelog", "walk_in", "walk_in", None, None, "ぐるなび"]


def test_json_string_matches_json_dumps(spark):
    vals = ['plain', 'a"b', "back\\slash", "ctl\x01\x0b\x1f\n\t\r\b\f", "日本語 コース", "/slash "]
    got = _one_col(spark, vals, json_string)
    assert got == [json.dumps(v, ensure_ascii=False) for v in vals]


def _expected_hash(obj):
    return hashlib.md5(json.dumps(obj, ensure_ascii=False, separators=(",", ":"), sort_keys=True).encode()).hexdigest()


def test_record_hash_absent_vs_null(spark):
    schema = ("store_id string, reserve_date date, booking_date date, start_time string, end_time string, "
              "course_name string, headcount bigint, channel string, status string, reserve_date_raw string, "
              "booking_date_raw string, start_time_raw string, end_time_raw string, headcount_raw string")
    d = dt.date(2024, 1, 15)
    rows = [
        # headcount raw blank -> key absent
        ("s1", d, None, "09:05:00", None, None, None, "tabelog", "confirmed", "2024-01-15", "", "9:05", "", ""),
        # headcount raw unparsable -> null
        ("s1", d, None, "09:05:00", None, None, None, "tabelog", "confirmed", "2024-01-15", "", "9:05", "", "多数"),
        ("s1", d, d, "09:05:00", "10:00:00", 'コ"ス', 4, None, None, "2024/01/15", "2024-01-15", "9:05", "10:00",
         "4名"),
    ]
    df = spark.createDataFrame(rows, schema)
    got = [r[0] for r in df.select(record_hash()).collect()]
    exp = [
        _expected_hash({"channel": "tabelog", "course_name": None, "reserve_date": "2024-01-15",
                        "start_time": "09:05:00", "status": "confirmed", "store_id": "s1"}),
        _expected_hash({"channel": "tabelog", "course_name": None, "headcount": None, "reserve_date": "2024-01-15",
                        "start_time": "09:05:00", "status": "confirmed", "store_id": "s1"}),
        _expected_hash({"booking_date": "2024-01-15", "channel": None, "course_name": 'コ"ス', "end_time": "10:00:00",
                        "headcount": 4, "reserve_date": "2024-01-15", "start_time": "09:05:00", "status": None,
                        "store_id": "s1"}),
    ]
    assert got == exp
    assert got[0] != got[1]


def test_record_key_defaults(spark):
    schema = ("store_id string, reservation_id string, reserve_date date, start_time string, course_name string, "
              "headcount bigint, channel_raw string")
    rows = [("s1", "", None, None, "", None, ""), ("s1", "R9", None, None, "", None, ""),
            ("s1", None, dt.date(2024, 1, 2), "09:00:00", "C", 0, "電話")]
    df = spark.createDataFrame(rows, schema)
    got = [r[0] for r in df.select(record_key(course_name_raw="course_name")).collect()]
    assert got == ["s1|no_date|no_time|no_course|0|no_channel", "s1_R9", "s1|2024-01-02|09:00:00|C|0|電話"]


def test_run_id_label_and_path(spark):
    df = spark.createDataFrame([("s1", "rb_19980801_011500")], "store_id string, run_id string").withColumn(
        "ts", F.lit("1998-08-01T01:15:00+09:00").cast("timestamp"))
    r = df.select(run_id_for("ts").alias("a"), label_value(F.lit("RB.x 1")).alias("b"),
                  landing_object_path("store_id", "run_id", "ts").alias("c"),
                  manual_object_path(F.lit("x.csv"), "ts").alias("d")).first()
    assert r["a"] == "rb_19980801_011500"
    assert r["b"] == "rb_x_1"
    assert r["c"] == "landing/restaurant_board/1998/08/01/run_rb_19980801_011500/rb_s1_19980801.csv"
    assert r["d"] == "manual/restaurant_board/1998/08/01/x.csv"
