"""File sources (Shift_JIS, ragged files, string ids), stores, the daily run."""

import datetime as dt
import os

from pyspark.sql import functions as F

from bookflow.operators.stores import active_stores, store_windows
from bookflow.plans import landing as L
from bookflow.plans.daily_run import daily_run
from bookflow.sources import fixtures
from bookflow.sources.csv_files import scan_exports, write_exports
from bookflow.sources.stores import normalize_store_master

from conftest import SF_SMALL

HEADER = "予約番号,予約日,開始時間,人数,経路,ステータス"


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.encode("shift_jis"))


def test_shift_jis_scan_rejects_ragged_file(spark, tmp_root):
    _write(f"{tmp_root}/store_id=001/a.csv", f"{HEADER}\n1,2024-01-15,18:00,4名,食べログ,確定\n\n2,2024/01/16,19:30,2,電話,仮予約\n")
    _write(f"{tmp_root}/store_id=002/b.csv", f"{HEADER}\n3,2024-01-15,18:00,4,食べログ,確定\n4,2024-01-15,18:00\n")
    lines, bad = scan_exports(spark, tmp_root)
    got = sorted((r["store_id"], r["予約番号"], r["経路"]) for r in lines.collect())
    assert got == [("001", "1", "食べログ"), ("001", "2", "電話")]  # store ids stay strings
    bad_rows = bad.collect()
    assert len(bad_rows) == 1 and bad_rows[0]["store_id"] == "002" and bad_rows[0]["bad_lines"] == 1


def test_each_file_is_bound_by_its_own_header(spark, tmp_root):
    _write(f"{tmp_root}/store_id=001/a.csv", f"{HEADER}\n1,2024-01-15,18:00,4名,食べログ,確定\n")
    _write(f"{tmp_root}/store_id=002/b.csv", "開始時間,予約日,予約番号,備考,経路\r\n19:00,2024-02-20,2,\"a, \"\"b\"\"\",表\r\n")
    _write(f"{tmp_root}/store_id=003/c.csv", f"{HEADER}\n3,2024-01-15,18:00,4,\"表\",\"\"\n,,,,,\n")
    _write(f"{tmp_root}/store_id=004/d.csv", f"{HEADER}\n4,2024-01-15\n")
    _write(f"{tmp_root}/store_id=005/e.csv", "")
    lines, bad = scan_exports(spark, tmp_root)
    got = {(r["store_id"], r["予約番号"]): r for r in lines.collect()}
    assert sorted(got) == [("001", "1"), ("002", "2"), ("003", ""), ("003", "3")]
    two = got["002", "2"]
    assert (two["予約日"], two["開始時間"], two["備考"], two["経路"]) == ("2024-02-20", "19:00", 'a, "b"', "表")
    assert two["人数"] is None and got["001", "1"]["備考"] is None  # absent, not empty
    assert got["003", "3"]["経路"] == "表" and got["003", "3"]["ステータス"] == "" == got["003", ""]["予約日"]
    assert [r["store_id"] for r in bad.collect()] == ["004"]
    some, _ = scan_exports(spark, tmp_root, columns=["予約日", "店舗名"])
    assert some.columns == ["予約日", "店舗名", "store_id", "_file_path"] and some.count() == 4


def test_unreadable_and_slashed_windows(spark):
    from bookflow.operators.runs import run_summary

    active = spark.createDataFrame(
        [("s1", "A", 7, "2024/01/01", "2024-01-31"), ("s2", "B", 7, "soon", "2024-01-31"), ("s3", "C", 2147483647, "", "")],
        "store_id string, store_name string, days_back int, from_date string, to_date string")
    w = store_windows(active, "2024-03-10")
    got = {r["store_id"]: (str(r["window_from"]), str(r["window_to"])) for r in w.select(
        "store_id", *(F.col(c).cast("string").alias(c) for c in ("window_from", "window_to"))).collect()}
    assert got["s1"] == ("2024-01-01", "2024-01-31") and got["s2"][0] == "None" and got["s3"][1] == "2024-03-09"
    norm = spark.createDataFrame([("s1", "", True), ("s1", "", False), ("s2", "", False)],
                                 "store_id string, reject_reason string, in_window boolean")
    s = {r["store_id"]: (r["status"], r["records"], r["error"]) for r in run_summary(active, norm, windows=w).collect()}
    assert s == {"s1": ("success", 1, None), "s2": ("failed", 0, "unreadable from_date or to_date"), "s3": ("skipped", 0, None)}


def test_store_master_and_windows(spark):
    raw = spark.createDataFrame(
        [(" TRUE", "s1", "A", "u", "p", "3", "", ""), ("true", "s2", "B", "u", "p", "", "2024-01-01", "2024-01-31"),
         ("true", "s3", "C", "", "p", "0", "", ""), ("", "", "", "", "", "", "", "")],
        ["Active ", "STORE_ID", "store_name", "rb_username", "rb_password", "days_back", "from_date", "to_date"])
    master = normalize_store_master(raw)
    assert master.count() == 3 and "note" in master.columns
    act = active_stores(master)
    assert sorted(r["store_id"] for r in act.collect()) == ["s2"]  # ' TRUE' is not 'true'
    w = store_windows(act, "2024-03-10").first()
    assert (w["window_from"], w["window_to"]) == (dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    defaults = active_stores(master.withColumn("active", F.lit("true")))
    days = {r["store_id"]: r["days_back"] for r in defaults.collect()}
    assert days == {"s1": 3, "s2": 7}
    w1 = store_windows(defaults, "2024-03-10").filter("store_id = 's1'").first()
    assert (w1["window_from"], w1["window_to"]) == (dt.date(2024, 3, 6), dt.date(2024, 3, 9))


def test_daily_run_end_to_end(spark, tmp_root):
    exports = f"{tmp_root}/exports"
    write_exports(fixtures.reservations_export(spark, SF_SMALL), exports)
    stores = normalize_store_master(fixtures.stores_raw(spark, SF_SMALL))
    res = daily_run(spark, stores, exports, "bf_test_daily", f"{tmp_root}/tables", f"{tmp_root}/landing",
                    run_ts="1998-08-02T01:15:00+09:00")
    assert res.run_id == "rb_19980802_011500"
    summary = {r["store_id"]: r for r in res.summary.collect()}
    assert len(summary) == 18 and all(r["status"] in ("success", "skipped") for r in summary.values())
    loaded = sum(r["records"] for r in summary.values())
    assert res.merge["inserted_rows"] + res.merge["updated_rows"] + res.merge["unchanged_rows"] <= loaded
    assert spark.table("bf_test_daily.stage_reservations").count() == loaded == res.load["output_rows"]
    quarantine = spark.read.parquet(f"{tmp_root}/tables/quarantine")
    assert quarantine.count() == res.rejected.count() > 0
    assert quarantine.filter(F.col("reject_reason") == "").count() == 0
    inv = L.inventory(spark, f"{tmp_root}/landing", max_results=None)
    assert inv.select("store_id").distinct().count() == sum(1 for r in summary.values() if r["status"] == "success")
    assert inv.agg(F.sum("record_count")).first()[0] == loaded
    assert res.summary.filter("status = 'success'").count() == inv.count()
    paths = {r[0] for r in spark.read.parquet(f"{tmp_root}/landing/{L.MANIFEST}").select("object_path").collect()}
    assert len(paths) == inv.count() and all(os.path.isdir(p) for p in paths)
    prof = L.table_profile(spark, "bf_test_daily.reservations").first()
    assert prof["num_rows"] == spark.table("bf_test_daily.reservations").count() and prof["num_files"] > 0
    # the same files again: nothing new, nothing changed
    res2 = daily_run(spark, stores, exports, "bf_test_daily", f"{tmp_root}/tables", f"{tmp_root}/landing2",
                     run_ts="1998-08-02T01:15:00+09:00")
    assert res2.merge["inserted_rows"] == 0 and res2.merge["updated_rows"] == 0
    exp = L.expired_files(inv, "2100-01-01 00:00:00")
    assert exp.count() == inv.count()


def test_manual_backfill_from_landing(spark, tmp_root):
    from bookflow.operators.normalize import valid_rows
    from bookflow.plans import scenario as S
    from bookflow.plans.daily_run import manual_backfill

    rows = valid_rows(S.normalized_run_a(spark, SF_SMALL))
    L.write_landing(rows, f"{tmp_root}/landing", upload_type="manual")
    out = manual_backfill(spark, f"{tmp_root}/landing/{L.DATA}", "bf_test_manual", f"{tmp_root}/tables",
                          "manual_19980801_120000")
    n = rows.count()
    assert out["load"]["output_rows"] == n and out["load"]["input_files"] > 0 and out["load"]["input_file_bytes"] > 0
    dedup_n = rows.select("record_key").distinct().count()
    assert out["merge"] == {"inserted_rows": dedup_n, "updated_rows": 0, "unchanged_rows": 0}
    kpi = spark.table("bf_test_manual.daily_kpi")
    assert kpi.agg(F.sum("reservation_count")).first()[0] == dedup_n
    man = spark.read.parquet(f"{tmp_root}/landing/{L.MANIFEST}")
    assert man.filter("upload_type = 'manual'").count() == man.count() > 0


def test_manual_backfill_quarantines_bad_rows(spark, tmp_root):
    from bookflow.operators.normalize import valid_rows
    from bookflow.plans import scenario as S
    from bookflow.plans.daily_run import manual_backfill

    rows = valid_rows(S.normalized_run_a(spark, SF_SMALL)).limit(5).collect()
    columns = rows[0].asDict().keys()
    cells = [[None if v is None else v.isoformat() if hasattr(v, "isoformat") else str(v) for v in r] for r in rows]
    at = {c: i for i, c in enumerate(columns)}
    cells[0][at["reserve_date"]], cells[1][at["reserve_date"]] = "2024-02-31", None
    cells[2][at["record_key"]], cells[3][at["ingestion_ts"]] = None, "yesterday"
    text = spark.createDataFrame(cells, ", ".join(f"{c} string" for c in columns))
    text.write.option("header", True).option("quoteAll", True).csv(f"{tmp_root}/in")
    out = manual_backfill(spark, f"{tmp_root}/in", "bf_test_bad", f"{tmp_root}/tables", "manual_1")
    assert out["load"]["output_rows"] == 1 == out["merge"]["inserted_rows"]
    reasons = sorted(r["reject_reason"] for r in spark.read.parquet(f"{tmp_root}/tables/quarantine").collect())
    assert reasons == ["missing_ingestion_ts", "missing_record_key", "missing_reserve_date", "missing_reserve_date"]


def test_run_summary_failed_and_strict(spark):
    from bookflow.operators.runs import run_summary, run_totals

    active = spark.createDataFrame([("s1", "A"), ("s2", "B"), ("s3", "C"), ("s4", "D")], "store_id string, store_name string")
    norm = spark.createDataFrame(
        [("s1", ""), ("s1", ""), ("s2", "missing_reserve_date"), ("s3", ""), ("s3", "bad_start_time")],
        "store_id string, reject_reason string")
    bad_files = spark.createDataFrame([("s4", "f.csv", "ragged CSV line(s): 1")],
                                      "store_id string, _file_path string, error string")
    lenient = {r["store_id"]: (r["status"], r["records"]) for r in run_summary(active, norm, bad_files).collect()}
    assert lenient == {"s1": ("success", 2), "s2": ("skipped", 0), "s3": ("success", 1), "s4": ("failed", 0)}
    strict = {r["store_id"]: r for r in run_summary(active, norm, bad_files, strict=True).collect()}
    assert strict["s3"]["status"] == "failed" and strict["s3"]["error"] == "1 rows failed validation"
    assert strict["s2"]["status"] == "failed" and strict["s1"]["status"] == "success"
    totals = {r["status"]: (r["stores"], r["total_records"]) for r in run_totals(run_summary(active, norm, bad_files)).collect()}
    assert totals == {"success": (2, 3), "skipped": (1, 0), "failed": (1, 0)}


def test_daily_run_dry_run_writes_nothing(spark, tmp_root):
    exports = f"{tmp_root}/exports"
    write_exports(fixtures.reservations_export(spark, SF_SMALL), exports)
    stores = normalize_store_master(fixtures.stores_raw(spark, SF_SMALL))
    res = daily_run(spark, stores, exports, "bf_test_dry", f"{tmp_root}/tables", f"{tmp_root}/landing",
                    run_ts="1998-08-01T01:15:00+09:00", as_of="1998-08-02", dry_run=True)
    assert res.merge is None and res.load is None
    assert not os.path.exists(f"{tmp_root}/tables") and not os.path.exists(f"{tmp_root}/landing")
    assert not spark.catalog.databaseExists("bf_test_dry")
    # with as_of, only rows inside each store's window remain
    assert res.valid.count() == res.summary.agg(F.sum("records")).first()[0] > 0
    y = res.yields.agg(*(F.sum(c).alias(c) for c in ("parsed_rows", "valid_rows", "rejected_rows", "outside_rows"))).first()
    assert y["parsed_rows"] == y["valid_rows"] + y["rejected_rows"] + y["outside_rows"] and y["rejected_rows"] > 0
    assert res.summary.count() == 18


def test_line_breaks_inside_quotes(spark, tmp_root):
    _write(f"{tmp_root}/store_id=001/a.csv", f'{HEADER}\n1,2024-01-15,18:00,4名,"食べ\nログ, 表",確定\n2,2024-01-16,"19:00",2,電話,"a ""b"" c"\n')
    _write(f"{tmp_root}/store_id=002/b.csv", '経路,予約番号\r\n"x\r\n\r\ny",3\r\n"z",4\r\n')
    _write(f"{tmp_root}/store_id=003/c.csv", f'{HEADER}\n5,2024-01-15,18:00,4,"open\nline",確定\n6,2024-01-15\n')
    _write(f"{tmp_root}/store_id=004/d.csv", f"{HEADER}\n7,2024-01-15,18:00,6'2\" tall,電話,確定\n")
    _write(f"{tmp_root}/store_id=005/e.csv", f'{HEADER}\n8,2024-01-15,18:00,4,"never closed,確定\n9,2024-01-16,18:00,4,電話,確定\n')
    lines, bad = scan_exports(spark, tmp_root)
    got = {r["予約番号"]: r for r in lines.collect()}
    assert sorted(got) == ["1", "2", "3", "4", "7"]
    assert got["1"]["経路"] == "食べ\nログ, 表" and got["2"]["ステータス"] == 'a "b" c' and got["2"]["開始時間"] == "19:00"
    assert got["3"]["経路"].replace("\r", "") == "x\n\ny" and got["3"]["人数"] is None and got["4"]["経路"] == "z"
    assert got["7"]["人数"] == "6'2\" tall" and {r["store_id"] for r in got.values()} == {"001", "002", "004"}
    assert sorted((r["store_id"], r["bad_lines"]) for r in bad.collect()) == [("003", 1), ("005", 1)]
