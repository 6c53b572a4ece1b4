"""Property tests: parsers against plain-Python models, pipeline invariants."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bookflow.functions.parse import map_with_fallback, parse_int, parse_time
from bookflow.operators.normalize import rejected_rows, valid_rows
from bookflow.plans import scenario as S
from bookflow.schema import CHANNEL_MAP_EXECUTED, REQUIRED_COLUMNS

from conftest import SF_SMALL

JS_WS = ("\t\n\x0b\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
         "\u2028\u2029\u202f\u205f\u3000\ufeff")
ALPHABET = "0123456789:+-. x\u540d\u591a\u3000\u00a0\t" + "\u98df\u3079\u30ed\u30b0"


def model_parse_int(s):
    if not s:
        return None
    m = re.match("[" + re.escape(JS_WS) + "]*([+-]?[0-9]+)", s)
    if not m:
        return None
    v = int(m.group(1))
    return v if -(2 ** 63) <= v < 2 ** 63 else None


def model_parse_time(s):
    if not s:
        return None
    m = re.match(r"([0-9]{1,2}):([0-9]{2})(?::([0-9]{2}))?", s)
    if not m:
        return None
    return f"{m.group(1).zfill(2)}:{m.group(2)}:{m.group(3) or '00'}"


def model_channel(s):
    if not s:
        return None
    return CHANNEL_MAP_EXECUTED.get(s) or re.sub("[" + re.escape(JS_WS) + "]+", "_", s.lower())


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=8), min_size=1, max_size=40))
def test_parsers_match_models(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    rows = df.select(parse_int("s").alias("i"), parse_time("s").alias("t"),
                     map_with_fallback("s", CHANNEL_MAP_EXECUTED).alias("c")).collect()
    for v, r in zip(values, rows):
        assert r["i"] == model_parse_int(v), v
        assert r["t"] == model_parse_time(v), v
        assert r["c"] == model_channel(v), v


def test_every_row_valid_or_rejected_once_and_required_not_null(spark):
    norm = S.normalized_run_a(spark, SF_SMALL)
    n, v, r = norm.count(), valid_rows(norm).count(), rejected_rows(norm).count()
    assert n == v + r and v > 0 and r > 0
    nulls = valid_rows(norm).select([F.count_if(F.col(c).isNull()).alias(c) for c in REQUIRED_COLUMNS]).first()
    assert all(nulls[c] == 0 for c in REQUIRED_COLUMNS)


def test_input_order_does_not_change_outputs(spark):
    a = S.normalized_run_a(spark, SF_SMALL)
    shuffled = a.repartition(7, F.rand(seed=3))
    assert a.exceptAll(shuffled).count() == 0 and shuffled.exceptAll(a).count() == 0
    sc = S.build(spark, SF_SMALL)
    merged = sc.merged()
    assert merged.groupBy("record_key", "vendor", "store_id").count().filter("count > 1").count() == 0
