"""

Every query reads the given tables (or data Spark derives from them) in
full, but for the two-run scenario (stage, merge and report queries), whose
runs each hold two thirds of the lines; the only LIMITs are those of the
report and of the landing listing, which are the feature.
"""

from __future__ import annotations

import datetime
import logging
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from bookflow.operators import merge as M  # noqa: E402
from bookflow.operators import reports as R  # noqa: E402
from bookflow.operators import runs as RU  # noqa: E402
from bookflow.operators.normalize import rejected_rows, typed_reservations, valid_rows  # noqa: E402
from bookflow.operators.stage import stage_retention  # noqa: E402
from bookflow.operators.stores import store_missing_fields, store_windows, windowed_reservations  # noqa: E402
from bookflow.plans import scenario as S  # noqa: E402
from bookflow.schema import RESERVATION_COLUMNS  # noqa: E402
from bookflow.functions.parse import map_with_fallback  # noqa: E402
from bookflow.schema import CHANNEL_MAP_EXECUTED, CHANNEL_MAP_EXTENDED, STATUS_MAP_EXECUTED, STATUS_MAP_EXTENDED  # noqa: E402
from bookflow.session import configure  # noqa: E402
from bookflow.sources import fixtures  # noqa: E402

log = logging.getLogger(__name__)

SMOKE_DIR = "/root/testdata/sf0.001"
AS_OF = fixtures.AS_OF


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the daily KPI view over production after two daily runs."""
    return q_daily_kpi(spark, SMOKE_DIR)


# --- stores -----------------------------------------------------------------

def q_store_master(spark, d):
    configure(spark)
    return S.store_master(spark, d)


def q_active_stores(spark, d):
    configure(spark)
    return S.active(spark, d)


def q_store_missing_fields(spark, d):
    configure(spark)
    return store_missing_fields(S.store_master(spark, d))


def q_store_windows(spark, d):
    configure(spark)
    return store_windows(S.active(spark, d), AS_OF)


# --- parsing ----------------------------------------------------------------

def q_map_columns(spark, d):
    configure(spark)
    return S.mapped_lines(spark, d)


def _typed(spark, d, profile="executed"):
    configure(spark)
    return typed_reservations(S.mapped_lines(spark, d, profile), profile)


def q_typed_reservations(spark, d):
    return _typed(spark, d).select("store_id", "src_key", "reserve_date", "booking_date", "start_time",
                                   "end_time", "headcount")


def q_parse_dates(spark, d):
    return _typed(spark, d, "extended").select("src_key", "reserve_date_raw", "reserve_date", "booking_date_raw",
                                               "booking_date")


def q_parse_times(spark, d):
    return _typed(spark, d).select("src_key", "start_time_raw", "start_time", "end_time_raw", "end_time")


def q_parse_ints(spark, d):
    return _typed(spark, d).select("src_key", "headcount_raw", "headcount")


def q_channels(spark, d):
    configure(spark)
    c = S.mapped_lines(spark, d).select("channel_raw").distinct()
    return c.select("channel_raw", map_with_fallback("channel_raw", CHANNEL_MAP_EXECUTED).alias("channel"),
                    map_with_fallback("channel_raw", CHANNEL_MAP_EXTENDED).alias("channel_extended"))


def q_statuses(spark, d):
    configure(spark)
    c = S.mapped_lines(spark, d).select("status_raw").distinct()
    return c.select("status_raw", map_with_fallback("status_raw", STATUS_MAP_EXECUTED).alias("status"),
                    map_with_fallback("status_raw", STATUS_MAP_EXTENDED).alias("status_extended"))


# --- normalise / validate ---------------------------------------------------

def _normalized(spark, d, profile="executed"):
    configure(spark)
    return S.normalized_all(spark, d, profile)


def q_record_keys(spark, d):
    return _normalized(spark, d).select("src_key", "store_id", "record_key")


def q_record_hashes(spark, d):
    return _normalized(spark, d).select("src_key", "record_hash")


def q_normalize(spark, d):
    return _normalized(spark, d).select(*RESERVATION_COLUMNS, "reject_reason")


def q_normalize_extended(spark, d):
    return _normalized(spark, d, "extended").select(*RESERVATION_COLUMNS, "reject_reason")


def q_valid_rows(spark, d):
    return valid_rows(_normalized(spark, d))


def q_rejected_rows(spark, d):
    return rejected_rows(_normalized(spark, d))


def q_windowed_reservations(spark, d):
    return windowed_reservations(valid_rows(_normalized(spark, d)), store_windows(S.active(spark, d), AS_OF))


def q_transform_yield(spark, d):
    return RU.transform_yield(_normalized(spark, d))


def q_run_summary(spark, d):
    return RU.run_summary(S.active(spark, d), _normalized(spark, d))


# --- stage / merge ----------------------------------------------------------

def q_stage_load(spark, d):
    return S.build(spark, d).load_b


def q_stage_union(spark, d):
    return S.build(spark, d).stage


def q_stage_dedup(spark, d):
    return S.build(spark, d).source


def q_stage_retention(spark, d):
    return stage_retention(S.build(spark, d).stage, "1998-08-15")


def q_merge_actions(spark, d):
    """M1 on the stored keys: run A merged, run B classified against its keys; production isn't read."""
    from bookflow.plans import tables as TB

    s = S.build(spark, d)

    def work(db, root):
        TB.create_tables(spark, db, root)
        TB.apply_merge(spark, db, s.target)

    def actions(db):
        return TB.classify_run(spark, db, s.source).select("store_id", "record_key", "action", "reserve_date",
                                                           F.col("_old.reserve_date").alias("old_reserve_date"))

    return _in_tables(spark, "actions", work, actions)


def q_merge_stats(spark, d):
    s = S.build(spark, d)
    return M.merge_stats(M.merge_actions(s.source, s.target))


def q_merge_result(spark, d):
    return S.build(spark, d).merged()


# --- reports ----------------------------------------------------------------

def q_daily_kpi(spark, d):
    return R.daily_kpi(S.build(spark, d).merged())


def q_report(spark, d):
    return R.report(S.build(spark, d).merged(), "1996-01-01", "1998-12-31", channel="phone")


def q_report_basic(spark, d):
    return R.report(S.build(spark, d).merged(), "1995-01-01", "2001-12-31", columns=R.REPORT_BASIC_COLUMNS)


def q_report_limited(spark, d):
    """O1 with a limit below the row count; the order's last key decides at the cut."""
    return R.report(S.build(spark, d).merged(), "1992-01-01", "2001-12-31", limit=500)


def q_param_query(spark, d):
    view = "bookflow_reservations"
    S.build(spark, d).merged().createOrReplaceTempView(view)
    sql = f"""
        SELECT reserve_date, channel, count(*) AS parties, sum(headcount) AS guests FROM {view}
        WHERE store_id = :store AND reserve_date >= :first_day AND headcount >= :at_least
        GROUP BY reserve_date, channel"""
    args = {"store": "store001", "first_day": datetime.date(1997, 1, 1), "at_least": 4}
    return R.param_query(spark, sql, args)


# --- run bookkeeping --------------------------------------------------------

def q_landing_manifest(spark, d):
    return RU.landing_manifest(S.build(spark, d).stage)


def q_run_labels(spark, d):
    return RU.run_labels(S.build(spark, d).stage)


def q_run_ids(spark, d):
    return RU.run_ids(S.build(spark, d).stage)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "store_master": q_store_master,
    "active_stores": q_active_stores,
    "store_missing_fields": q_store_missing_fields,
    "store_windows": q_store_windows,
    "map_columns": q_map_columns,
    "typed_reservations": q_typed_reservations,
    "parse_dates": q_parse_dates,
    "parse_times": q_parse_times,
    "parse_ints": q_parse_ints,
    "channels": q_channels,
    "statuses": q_statuses,
    "record_keys": q_record_keys,
    "record_hashes": q_record_hashes,
    "normalize": q_normalize,
    "normalize_extended": q_normalize_extended,
    "valid_rows": q_valid_rows,
    "rejected_rows": q_rejected_rows,
    "windowed_reservations": q_windowed_reservations,
    "transform_yield": q_transform_yield,
    "run_summary": q_run_summary,
    "stage_load": q_stage_load,
    "stage_union": q_stage_union,
    "stage_dedup": q_stage_dedup,
    "stage_retention": q_stage_retention,
    "merge_actions": q_merge_actions,
    "merge_stats": q_merge_stats,
    "merge_result": q_merge_result,
    "daily_kpi": q_daily_kpi,
    "report": q_report,
    "report_basic": q_report_basic,
    "report_limited": q_report_limited,
    "param_query": q_param_query,
    "landing_manifest": q_landing_manifest,
    "run_labels": q_run_labels,
    "run_ids": q_run_ids,
}


def _llm() -> tuple[dict, dict]:
    """Queries and oracles of the optional subpackage and the pipeline; none if either can't be imported."""
    try:
        import corpus_pipeline
        from bookflow.llm.queries import ORACLES, QUERIES
    except ImportError as e:
        log.warning("training-data queries are left out: %s", e)
        return {}, {}
    oracles = dict(ORACLES)
    if corpus_pipeline.ORACLE_SQL:
        oracles["pipeline"] = corpus_pipeline.ORACLE_SQL
    return QUERIES | {"pipeline": corpus_pipeline.run}, oracles


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _QUERIES | _llm()[0]


def oracle_sql() -> dict[str, str]:
    from oracle.duckdb_sql import queries as oracle_queries

    q = oracle_queries()
    return {k: q[k] for k in _QUERIES if k in q} | _llm()[1]


# --- file-based operators (written under spark.checkpoint.dir) ---------------

def q_csv_scan(spark, d):
    """The export lines written as Shift_JIS CSV per store in three
    layouts (the export's own order; reversed; without the end time but with
    an unknown column), with quotes, commas and a last byte that is a
    backslash in the course names, scanned back and bound by each file's
    header. One store's files are ragged: they go, and nothing else does."""
    from bookflow.operators.mapping import map_columns
    from bookflow.session import scratch_path
    from bookflow.sources.csv_files import scan_exports, write_exports

    configure(spark)
    path = scratch_path(spark, "exports")
    lines = fixtures.reservations_export(spark, d)
    kind = F.col("src_key") % 4
    course = F.col("コース名")
    lines = lines.withColumn("コース名", F.when(kind == 1, F.concat(course, F.lit('"特別", A'))).when(kind == 2, F.concat(course, F.lit("表"))).otherwise(course))
    store = F.substring("store_id", 6, 3).cast("int") % 3
    write_exports(lines.filter(store == 0), path)
    write_exports(lines.filter(store == 1).select(*reversed(lines.columns)), path)
    write_exports(lines.filter(store == 2).drop("終了時間").withColumn("備考", F.lit("x,y")), path)
    ragged = spark.createDataFrame([("予約番号,予約日",), ("1,2024-01-01,3",)], "value string").coalesce(1)
    ragged.withColumn("store_id", F.lit("store999")).write.mode("append").partitionBy("store_id").text(path)
    found, _bad = scan_exports(spark, path)
    m = map_columns(found, keep=("store_id", "src_key"))
    return m.withColumn("src_key", F.col("src_key").cast("bigint"))


def _odd_names(df):
    """Course names with quotes and commas, and with line breaks."""
    k, course = F.col("headcount") % 5, F.col("course_name")
    return df.withColumn("course_name", F.when(k == 1, F.concat(course, F.lit('"特別", A'))).when(k == 2, F.concat(course, F.lit("\nB, "))).otherwise(course))


def q_csv_scan_multiline(spark, d):
    """Course names that hold line breaks, in some stores' files; one store's files are ragged beside that and go."""
    from bookflow.operators.mapping import map_columns
    from bookflow.session import scratch_path
    from bookflow.sources.csv_files import scan_exports, write_exports

    configure(spark)
    path = scratch_path(spark, "exports")
    lines = fixtures.reservations_export(spark, d)
    broken = (F.substring("store_id", 6, 3).cast("int") % 2 == 1) & (F.col("src_key") % 3 == 1)
    name = F.concat(F.col("コース名"), F.lit("\n2行目, \"表\""))
    write_exports(lines.withColumn("コース名", F.when(broken, name).otherwise(F.col("コース名"))), path)
    ragged = spark.createDataFrame([('予約番号,予約日\n1,"2024-\n01-01"\n2,3,4',)], "value string").coalesce(1)
    ragged.withColumn("store_id", F.lit("store999")).write.mode("append").partitionBy("store_id").text(path)
    found, _bad = scan_exports(spark, path)
    return map_columns(found, keep=("store_id", "src_key")).withColumn("src_key", F.col("src_key").cast("bigint"))


def q_store_master_file(spark, d):
    """The store sheet as a CSV export with its headers as people write them, read back."""
    from bookflow.session import scratch_path
    from bookflow.sources.stores import read_store_master

    configure(spark)
    path = scratch_path(spark, "store-sheet")
    sheet = fixtures.stores_raw(spark, d)
    sheet = sheet.toDF(*(f" {c.upper()} " if i % 2 else c.title() for i, c in enumerate(sheet.columns)))
    sheet.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return read_store_master(spark, path)


def q_landing_roundtrip(spark, d):
    """L2 + C3: all valid rows written as landing CSV and read back by name."""
    from bookflow.plans import landing as L
    from bookflow.session import scratch_path

    configure(spark)
    root = scratch_path(spark, "landing")
    L.write_landing(valid_rows(_normalized(spark, d)), root)
    return L.read_landing(spark, f"{root}/{L.DATA}")


def q_stream_stage(spark, d):
    """Both runs' loads landed as files, names with quotes, commas and line breaks among them, ingested by the availableNow stream."""
    from bookflow.plans import landing as L
    from bookflow.session import scratch_path
    from bookflow.streaming.landing_ingest import read_stage_sink, start_stage_ingest

    s = S.build(spark, d)
    root = scratch_path(spark, "landing")
    L.write_landing(_odd_names(s.load_a), root)
    L.write_landing(_odd_names(s.load_b), root)
    stage_path = scratch_path(spark, "stage")
    q = start_stage_ingest(spark, root, stage_path, scratch_path(spark, "stream-ckpt"))
    q.awaitTermination()
    return read_stage_sink(spark, stage_path)


def _landed(spark, d):
    from bookflow.plans import landing as L
    from bookflow.session import scratch_path

    s = S.build(spark, d)
    root = scratch_path(spark, "landing")
    L.write_landing(s.load_a, root)
    L.write_landing(s.load_b, root)
    return L, root


def q_landing_inventory(spark, d):
    """C4: every landing object with its manifest's counts."""
    L, root = _landed(spark, d)
    return L.inventory(spark, root).drop("modificationTime", "length", "path", "files")


def q_landing_top_n(spark, d):
    """O3: the first seven objects of the listing."""
    L, root = _landed(spark, d)
    return L.inventory(spark, root, 7).drop("modificationTime", "length", "path", "files")


def q_landing_expired(spark, d):
    """Objects uploaded over 30 days before run B's upload is 30 days old: those of run A."""
    L, root = _landed(spark, d)
    expired = L.expired_files(L.inventory(spark, root), "1998-08-31 16:15:00", by="upload_ts")
    return expired.drop("modificationTime", "length", "path", "files")


def q_landing_removed(spark, d):
    """What expiry deleted."""
    L, root = _landed(spark, d)
    return L.expire_landing(spark, root, "1998-08-31 16:15:00", by="upload_ts").drop("modificationTime", "length", "path", "files")


def q_landing_after_expiry(spark, d):
    """A listing after expiry lacks what it deleted."""
    L, root = _landed(spark, d)
    L.expire_landing(spark, root, "1998-08-31 16:15:00", by="upload_ts")
    return L.inventory(spark, root).drop("modificationTime", "length", "path", "files")


def q_manual_landing(spark, d):
    """L4: run B's rows handed in as files beside run A's scheduled ones; the listing of the manual folder."""
    from bookflow.plans import landing as L
    from bookflow.session import scratch_path

    s = S.build(spark, d)
    root = scratch_path(spark, "landing")
    L.write_landing(s.load_a, root)
    L.write_manual(s.load_b, root)
    return L.inventory(spark, root, folder=L.MANUAL).drop("modificationTime", "length", "path", "files")


def q_kpi_view(spark, d):
    """The KPI view registered in the session and queried through SQL."""
    R.register_kpi_view(S.build(spark, d).merged(), "vw_daily_kpi")
    return spark.sql("SELECT * FROM vw_daily_kpi")


def q_run_totals(spark, d):
    """A4 totals: stores and records per status."""
    return RU.run_totals(RU.run_summary(S.active(spark, d), _normalized(spark, d)))


def _in_tables(spark, purpose, work, table):
    """Fresh catalog tables under the checkpoint folder for ``work(db, root)``;
    then ``table`` (or what ``table(db)`` returns) written aside, and the
    catalog left as it was."""
    import uuid

    from bookflow.session import materialize, scratch_path

    configure(spark)
    root = scratch_path(spark, purpose)
    db = "bookflow_" + uuid.uuid4().hex[:12]
    work(db, f"{root}/tables")
    out = materialize(spark.table(f"{db}.{table}") if isinstance(table, str) else table(db), purpose)
    spark.sql(f"DROP DATABASE {db} CASCADE")
    return out


def _daily_run(spark, d, db, root, as_of=None):
    """E1 end to end: every store's Shift_JIS export -> one daily run."""
    from bookflow.plans.daily_run import daily_run
    from bookflow.session import scratch_path
    from bookflow.sources.csv_files import write_exports

    exports = scratch_path(spark, "exports")
    write_exports(fixtures.reservations_export(spark, d), exports)
    return daily_run(spark, S.store_master(spark, d), exports, db, root, f"{root}/landing",
                     run_ts=fixtures.RUN_A["ingestion_ts"], as_of=as_of, dry_run=as_of is not None)


def q_daily_run_production(spark, d):
    return _in_tables(spark, "daily", lambda db, root: _daily_run(spark, d, db, root), "reservations").select(RESERVATION_COLUMNS)


def q_daily_run_summary(spark, d):
    got = []
    _in_tables(spark, "daily", lambda db, root: got.append(_daily_run(spark, d, db, root)), "reservations")
    return got[0].summary


def q_daily_run_windowed(spark, d):
    """E1 with store windows: each store's lines as loaded, outside its window or rejected."""
    configure(spark)
    return _daily_run(spark, d, "", "", AS_OF).yields


def _two_merges(spark, d, db, root, kpi):
    from bookflow.plans import tables as TB

    s = S.build(spark, d)
    TB.create_tables(spark, db, root)
    TB.create_kpi_table(spark, db, root)
    for run in (s.target, s.source):
        TB.apply_merge(spark, db, run)
        if kpi:
            TB.refresh_kpi(spark, db)


def q_merge_apply(spark, d):
    """M2 as written: run B's inserts, updates and moved rows in the table that holds run A."""
    return _in_tables(spark, "merge", lambda db, root: _two_merges(spark, d, db, root, False), "reservations").select(RESERVATION_COLUMNS)


def q_merge_apply_kpi(spark, d):
    """The stored KPI rows after both merges' refreshes."""
    return _in_tables(spark, "merge", lambda db, root: _two_merges(spark, d, db, root, True), "daily_kpi").drop("headcounts", "month")


def q_table_profile(spark, d):
    """Both tables' profiles after two loads and a merge; creating them again changes nothing."""
    from bookflow.plans import tables as TB
    from bookflow.plans.landing import table_profile
    from bookflow.session import materialize

    got = []

    def work(db, root):
        s = S.build(spark, d)
        TB.create_tables(spark, db, root)
        TB.append_stage(spark, db, s.load_a)
        TB.append_stage(spark, db, s.load_b)
        TB.apply_merge(spark, db, s.target)
        TB.create_tables(spark, db, root)
        for t in (TB.STAGE, TB.PRODUCTION):
            columns = len(spark.table(f"{db}.{t}").columns)
            prof = table_profile(spark, f"{db}.{t}").select(F.lit(t).alias("table_name"), "num_rows", F.lit(columns).alias("num_columns"),
                                                            (F.col("num_bytes") > 0).alias("has_files"))
            got.append(materialize(prof, "profile"))

    _in_tables(spark, "profile", work, "reservations")
    return got[0].union(got[1])


def q_load_stats(spark, d):
    """The daily run's loads by store: rows, files and bytes."""
    got = _in_tables(spark, "daily", lambda db, root: _daily_run(spark, d, db, root), "load_stats")
    return got.select("run_id", "store_id", "source", "output_rows", (F.col("input_files") > 0).alias("has_files"),
                      (F.col("input_bytes") > F.col("output_rows")).alias("has_bytes"))


def q_compacted_files(spark, d):
    """Both loads appended in pieces to the stage, then its small files rewritten together: files and rows of each date."""
    from bookflow.plans import tables as TB

    got = []

    def work(db, root):
        s = S.build(spark, d)
        TB.create_tables(spark, db, root)
        for load in (s.load_a, s.load_b):
            for part in range(3):
                TB.append_stage(spark, db, load.filter(F.pmod(F.hash("record_key"), F.lit(3)) == part))
        got.append(TB.compact(spark, db))

    stage = _in_tables(spark, "compact", work, "stage_reservations")
    left = stage.groupBy(F.col("ingestion_date").alias("day")).agg(F.count(F.lit(1)).alias("rows_left"))
    return got[0].join(left, "day").select("day", (F.col("files_before") >= 3).alias("had_many"), "files_after", "num_rows", "rows_left")


MANUAL_RUN = "manual_19980801_120000"


def q_manual_load(spark, d):
    """C3 + E4: files in landing format with their columns in two orders, names with quotes, commas and line breaks, NULL
    and impossible dates, loaded into stage by a backfill."""
    from bookflow.plans.daily_run import manual_backfill
    from bookflow.plans.landing import CSV_OPTIONS
    from bookflow.session import scratch_path

    def work(db, root):
        path = scratch_path(spark, "manual")
        rows = _odd_names(_normalized(spark, d))
        day = F.coalesce(F.col("reserve_date").cast("string"), F.when(F.col("src_key") % 50 == 1, "2024-02-31"))
        rows = rows.withColumn("reserve_date", day)
        for part, columns in ((0, RESERVATION_COLUMNS), (1, [*reversed(RESERVATION_COLUMNS), "src_key"])):
            own = rows.filter(F.col("src_key") % 2 == part).select(columns)
            own.write.mode("append").options(**CSV_OPTIONS).csv(path)
        manual_backfill(spark, path, db, root, MANUAL_RUN)

    return _in_tables(spark, "manual", work, "stage_reservations").select(RESERVATION_COLUMNS)


_QUERIES.update({
    "daily_run_production": q_daily_run_production,
    "daily_run_summary": q_daily_run_summary,
    "kpi_view": q_kpi_view,
    "run_totals": q_run_totals,
    "csv_scan": q_csv_scan,
    "csv_scan_multiline": q_csv_scan_multiline,
    "store_master_file": q_store_master_file,
    "landing_removed": q_landing_removed,
    "landing_after_expiry": q_landing_after_expiry,
    "load_stats": q_load_stats,
    "compacted_files": q_compacted_files,
    "landing_roundtrip": q_landing_roundtrip,
    "stream_stage": q_stream_stage,
    "landing_inventory": q_landing_inventory,
    "landing_top_n": q_landing_top_n,
    "landing_expired": q_landing_expired,
    "manual_landing": q_manual_landing,
    "table_profile": q_table_profile,
    "daily_run_windowed": q_daily_run_windowed,
    "merge_apply": q_merge_apply,
    "merge_apply_kpi": q_merge_apply_kpi,
    "manual_load": q_manual_load,
})
