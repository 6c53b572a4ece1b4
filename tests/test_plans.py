"""Plan shapes that the scale design depends on (checked with explain)."""

import contextlib
import datetime
import io
import re

import pytest

from bookflow.operators import merge as M
from bookflow.operators import reports as R
from bookflow.operators.normalize import normalize, rejected_rows, valid_rows
from bookflow.operators.stage import stage_dedup
from bookflow.plans import scenario as S
from bookflow.plans import tables as TB
from bookflow.schema import RAW_COLUMNS

from conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def tree(p: str) -> list[str]:
    """The operator tree part of a formatted plan (before the node details)."""
    return p.split("\n\n")[0].splitlines()


@pytest.fixture(scope="module")
def prod(spark):
    import tempfile

    sc = S.build(spark, SF_SMALL)
    TB.create_tables(spark, "bf_test_plans", tempfile.mkdtemp(prefix="run-"))
    TB.apply_merge(spark, "bf_test_plans", sc.target)
    return sc, TB.read_production(spark, "bf_test_plans")


def test_report_prunes_partitions_and_plans_top_k(prod):
    p = plan(R.report(prod[1], "1996-01-01", "1996-12-31", channel="phone"))
    assert "TakeOrderedAndProject" in p
    assert re.search(r"PartitionFilters: \[.*reserve_date.*1996-01-01", p)
    assert "EqualTo(channel,phone)" in p
    assert "Sort [" not in p  # no global sort


def test_kpi_aggregates_map_side_and_prunes_columns(prod):
    p = plan(R.daily_kpi(prod[1]))
    t = "\n".join(tree(p))
    assert t.count("HashAggregate") == 2 and t.count("Exchange") == 1
    scan_schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert "record_hash" not in scan_schema and "course_name" not in scan_schema


def test_dedup_limits_hot_keys_before_the_shuffle(prod):
    p = plan(stage_dedup(prod[0].stage, "rb_19980802_011500"))
    t = tree(p)
    first_exchange = next(i for i, line in enumerate(t) if "Exchange" in line)
    assert any("WindowGroupLimit" in line for line in t[first_exchange + 1:])  # map side
    assert "EqualTo(run_id,rb_19980802_011500)" in p


def test_merge_probes_production_without_shuffling_it(prod):
    sc, target = prod
    p = plan(M.merged_table(target, sc.source))
    # every production scan feeds a broadcast join directly
    lines = tree(p)
    scans = [i for i, line in enumerate(lines) if "Scan parquet spark_catalog.bf_test_plans.reservations" in line]
    assert scans
    for i in scans:
        j = i - 1
        while re.search(r"\b(Filter|Project|ColumnarToRow)\b", lines[j]):
            j -= 1
        assert "BroadcastHashJoin" in lines[j], lines[j]


def small_tables(spark, root) -> str:
    """Orders, customers and nations of their own: repeated and missing keys, customers without a nation, stores off."""
    day = datetime.datetime(1997, 3, 1)
    orders = [(None if i % 40 == 39 else i % 150, None if i % 31 == 30 else i % 24, "FOP"[i % 3],
               day + datetime.timedelta(days=i % 300), ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT", "5-LOW")[i % 5]) for i in range(400)]
    customers = [(None if i == 21 else i % 20, None if i == 3 else i % 12) for i in range(22)]
    tables = {
        "orders": (orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string"),
        "customer": (customers, "c_custkey bigint, c_nationkey int"),
        "nation": ([(i, f"N{i}") for i in range(12)], "n_nationkey int, n_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.mark.parametrize("kind", [valid_rows, rejected_rows])
def test_lines_are_parsed_after_the_shuffle_that_spreads_them(spark, tmp_root, kind):
    """A single-split table is read by one task: a filter on reject_reason must not take the parsing there."""
    df = kind(S.normalized_run_a(spark, small_tables(spark, tmp_root)))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("simple")
    above, below = buf.getvalue().split("REPARTITION_BY_COL", 1)
    assert "missing_reserve_date" in above and "gettimestamp" in above
    assert not re.search("missing_reserve_date|gettimestamp|regexp_extract|RLIKE", below)


def test_scenario_reads_the_export_once(spark, tmp_root, monkeypatch):
    d = small_tables(spark, tmp_root)
    plain = S.build(spark, d, persist_stage=False)
    calls = []
    mapped = S.mapped_lines
    monkeypatch.setattr(S, "mapped_lines", lambda *a, **k: calls.append(a) or mapped(*a, **k))
    stored = S.build(spark, d)
    assert len(calls) == 1
    assert "orders.parquet" not in plan(stored.stage)
    assert stored.stage.count() > 100
    for name in ("stage", "load_a", "load_b"):
        x, y = getattr(stored, name), getattr(plain, name)
        assert x.columns == y.columns
        assert not x.exceptAll(y).take(1) and not y.exceptAll(x).take(1), name


def test_missing_store_ids_join_no_store(spark):
    line = dict.fromkeys(RAW_COLUMNS, "") | {"reserve_date_raw": "2024-01-05"}
    mapped = spark.createDataFrame([{**line, "store_id": s, "src_key": i} for i, s in enumerate(["s1", None, "s1", "", "s2"])],
                                   ", ".join(f"{c} string" for c in [*RAW_COLUMNS, "store_id"]) + ", src_key int")
    stores = spark.createDataFrame([("s1", "One"), (None, "None"), ("s3", "Three")], "store_id string, store_name string")
    got = normalize(mapped, stores, "rb_x", "2024-01-06T00:00:00Z", keep=("src_key",)).select("src_key", "store_id", "store_name", "reject_reason").collect()
    assert sorted(map(tuple, got)) == [(0, "s1", "One", ""), (2, "s1", "One", "")]
