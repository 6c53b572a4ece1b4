
import datetime as dt

from pyspark.sql import functions as F

from bookflow.operators.merge import merge_actions, merge_stats, merged_table
from bookflow.operators.stage import stage_dedup
from bookflow.plans import scenario as S
from bookflow.plans import tables as TB
from bookflow.schema import RESERVATION_SCHEMA

from conftest import SF_SMALL

TS1 = dt.datetime(1998, 7, 31, 16, 15)
TS2 = dt.datetime(1998, 8, 1, 16, 15)


def _row(key, store="s1", name="Store", date=dt.date(1998, 8, 1), head=2, h="h1", ts=TS1, run="r1"):
    return (store, name, date, None, "18:00:00", None, None, head, "phone", "confirmed", "restaurant_board", ts, run,
            key, h)


def _df(spark, rows):
    return spark.createDataFrame(rows, RESERVATION_SCHEMA)


def test_merge_cases(spark):
    target = _df(spark, [_row("k1"), _row("k2"), _row("k3", name="Old name"), _row("k4")])
    source = _df(spark, [
        _row("k1", h="h1", ts=TS2, run="r2"),                                 # unchanged
        _row("k2", h="h2", head=3, ts=TS2, run="r2"),                         # update
        _row("k3", name="New name", h="h1", ts=TS2, run="r2"),                # name only: unchanged
        _row("k5", h="h5", ts=TS2, run="r2"),                                 # insert
        _row("k4", h="h4", date=dt.date(1998, 9, 1), ts=TS2, run="r2"),        # partition-moving update
    ])
    acts = {r["record_key"]: r["action"] for r in merge_actions(source, target).collect()}
    assert acts == {"k1": "unchanged", "k2": "update", "k3": "unchanged", "k5": "insert", "k4": "update"}
    st = merge_stats(merge_actions(source, target)).first().asDict()
    assert st == {"inserted_rows": 1, "updated_rows": 2, "unchanged_rows": 2}
    out = {r["record_key"]: r for r in merged_table(target, source).collect()}
    assert set(out) == {"k1", "k2", "k3", "k4", "k5"}
    assert out["k3"]["store_name"] == "Old name" and out["k3"]["run_id"] == "r1"
    assert out["k2"]["headcount"] == 3 and out["k2"]["run_id"] == "r2"
    assert out["k4"]["reserve_date"] == dt.date(1998, 9, 1)


def test_dedup_latest_and_deterministic(spark):
    rows = [_row("k1", h="a", ts=TS1), _row("k1", h="b", ts=TS2), _row("k2", h="z", ts=TS1),
            _row("k2", h="y", ts=TS1)]
    stage = _df(spark, rows)
    got = {r["record_key"]: r["record_hash"] for r in stage_dedup(stage.withColumn("x", F.lit(1)), "r1").collect()}
    assert got == {"k1": "b", "k2": "y"}
    # input order does not matter
    again = {r["record_key"]: r["record_hash"]
             for r in stage_dedup(_df(spark, list(reversed(rows))), "r1").collect()}
    assert again == got


def test_merge_write_path_matches_lazy_plan(spark, tmp_root):
    sc = S.build(spark, SF_SMALL)
    db = "bf_test_merge"
    TB.create_tables(spark, db, tmp_root)
    TB.append_stage(spark, db, sc.load_a)
    TB.append_stage(spark, db, sc.load_b)
    st = TB.read_stage(spark, db)
    TB.apply_merge(spark, db, stage_dedup(st, "rb_19980801_011500"))
    stats = TB.apply_merge(spark, db, stage_dedup(st, "rb_19980802_011500"))
    expected_stats = merge_stats(merge_actions(sc.source, sc.target)).first().asDict()
    assert stats == expected_stats
    prod = TB.read_production(spark, db)
    exp = sc.merged()
    assert prod.count() == exp.count()
    assert prod.exceptAll(exp).count() == 0 and exp.exceptAll(prod).count() == 0
    # at most one row per merge key
    assert prod.groupBy("record_key", "vendor", "store_id").count().filter("count > 1").count() == 0
    # MERGE twice with the same run changes nothing
    again = TB.apply_merge(spark, db, stage_dedup(st, "rb_19980802_011500"))
    assert again["inserted_rows"] == 0 and again["updated_rows"] == 0
    assert again["unchanged_rows"] == sum(expected_stats.values())
    # retention: run A's ingestion date (1998-07-31) is older than 1998-08-15 - 14
    assert TB.expire_stage(spark, db, "1998-08-15") == [dt.date(1998, 7, 31)]
    assert TB.read_stage(spark, db).filter(F.col("run_id") == "rb_19980801_011500").count() == 0


def test_vacated_partition_is_removed(spark, tmp_root):
    db = "bf_test_vacate"
    TB.create_tables(spark, db, tmp_root)
    TB.apply_merge(spark, db, _df(spark, [_row("k1", date=dt.date(1998, 8, 1))]))
    TB.apply_merge(spark, db, _df(spark, [_row("k1", date=dt.date(1998, 8, 5), h="moved", ts=TS2, run="r2")]))
    prod = TB.read_production(spark, db).collect()
    assert [(r["record_key"], r["reserve_date"]) for r in prod] == [("k1", dt.date(1998, 8, 5))]
    parts = [r[0] for r in spark.sql(f"SHOW PARTITIONS {db}.reservations").collect()]
    assert parts == ["reserve_date=1998-08-05"]


def test_incremental_kpi_equals_full_view(spark, tmp_root):
    from bookflow.operators.reports import daily_kpi

    sc = S.build(spark, SF_SMALL)
    db = "bf_test_kpi"
    TB.create_tables(spark, db, tmp_root)
    TB.create_kpi_table(spark, db, tmp_root)
    TB.apply_merge(spark, db, sc.target)
    assert TB.refresh_kpi(spark, db) > 0
    TB.apply_merge(spark, db, sc.source)
    # the dates are in a table, so a process that dies here loses none of them
    assert TB.refresh_kpi(spark, db) > 0
    assert TB.refresh_kpi(spark, db) == 0  # and each merge is dealt with once
    # a partition-moving update can empty a date: its KPI partition must go too
    TB.apply_merge(spark, db, _df(spark, [_row("solo", date=dt.date(2030, 1, 1))]))
    TB.refresh_kpi(spark, db)
    TB.apply_merge(spark, db, _df(spark, [_row("solo", date=dt.date(2030, 2, 1), h="moved", ts=TS2)]))
    TB.refresh_kpi(spark, db)
    cols = ["store_id", "store_name", "reserve_date", "channel", "status", "reservation_count", "total_headcount",
            "avg_party_size", "confirmed_count", "cancelled_count", "completed_count"]
    stored = spark.table(f"{db}.daily_kpi").select(cols)
    full = daily_kpi(TB.read_production(spark, db)).select(cols)
    assert stored.count() == full.count()
    assert stored.exceptAll(full).count() == 0 and full.exceptAll(stored).count() == 0
    assert stored.filter(F.col("reserve_date") == dt.date(2030, 1, 1)).count() == 0
    assert TB.refresh_kpi(spark, db, everything=True) == full.select(F.trunc("reserve_date", "month")).distinct().count()
    assert spark.table(f"{db}.daily_kpi").count() == full.count()
