"""The daily run and the manual backfill as one Spark job each.

E1: store master -> active stores -> scan all stores' exports in one pass
-> map -> normalise -> validate -> window (written once) -> run summary
-> landing files + manifest -> stage append -> quarantine -> MERGE of the
run -> KPI partitions that merges touched -> stage retention.
Per-store isolation is data: rejected files, rejected rows and the status
of every store (success / failed / skipped) in ``summary``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookflow.functions.naming import local_ts, run_id_for, utc_date
from bookflow.operators.mapping import map_columns
from bookflow.operators.normalize import normalize, reject_reason, rejected_rows, valid_rows
from bookflow.operators.runs import SUCCESS, run_summary, transform_yield
from bookflow.operators.stores import active_stores, mark_window, store_windows
from bookflow.plans import landing as L
from bookflow.plans import tables as TB
from bookflow.schema import REQUIRED_COLUMNS
from bookflow.schema import profile as get_profile
from bookflow.session import configure, materialize
from bookflow.sources.csv_files import FILE, scan_exports


@dataclass
class RunResult:
    run_id: str
    summary: DataFrame
    valid: DataFrame
    rejected: DataFrame
    rejected_files: DataFrame
    merge: dict | None
    load: dict | None = None
    yields: DataFrame | None = None


def run_id_of(spark: SparkSession, run_ts: str) -> str:
    return spark.range(1).select(run_id_for(F.lit(run_ts).cast("timestamp")).alias("r")).first()["r"]


def daily_run(
    spark: SparkSession,
    stores: DataFrame,
    exports_path: str,
    database: str,
    tables_root: str,
    landing_root: str,
    run_ts: str,
    as_of=None,
    profile="executed",
    strict: bool = False,
    dry_run: bool = False,
) -> RunResult:
    """Run one daily load. ``run_ts`` is the run start (an instant; the run id
    and landing folders use the source time zone). With ``as_of`` valid rows
    outside each store's window aren't loaded (J2); ``yields`` counts them, so
    parsed = valid + outside + rejected for every store. ``dry_run`` returns
    the frames and writes nothing but scratch files."""
    configure(spark)
    run_id = run_id_of(spark, run_ts)
    active = active_stores(stores)
    lines, bad_files = scan_exports(spark, exports_path, columns=list(get_profile(profile).column_map))
    mapped = map_columns(lines, profile, keep=("store_id", FILE))
    norm = normalize(mapped, active, run_id, run_ts, profile)
    windows = store_windows(active, as_of) if as_of is not None else None
    if windows is not None:
        norm = mark_window(norm, windows)
    norm = materialize(norm, f"normalized-{run_id}")
    summary = materialize(run_summary(active, norm, bad_files, strict, windows), f"summary-{run_id}")
    ok_stores = summary.filter(F.col("status") == SUCCESS).select("store_id")
    inside = norm.filter("in_window") if windows is not None else norm
    valid = valid_rows(inside.join(ok_stores, "store_id", "left_semi"))
    rejected = rejected_rows(norm)
    result = RunResult(run_id, summary, valid, rejected, bad_files, None, yields=transform_yield(norm))
    if dry_run:
        return result

    TB.create_tables(spark, database, tables_root)
    loaded = not ok_stores.isEmpty()
    files = None
    if loaded:
        L.write_landing(valid, landing_root)
        day = spark.range(1).select(F.date_format(local_ts(F.lit(run_ts).cast("timestamp")), "yyyy-MM-dd")).first()[0]
        files = L.run_files(spark, landing_root, run_id, day)
    result.load = TB.append_stage(spark, database, valid, "daily", files)
    _quarantine(rejected, tables_root, run_id)
    if loaded:
        result.merge = TB.apply_merge(spark, database, TB.run_source(spark, database, run_id))
    # KPI table: only the reserve_date partitions that this merge, or one that
    # was never followed by a refresh, changed.
    TB.create_kpi_table(spark, database, tables_root)
    TB.refresh_kpi(spark, database)
    TB.expire_stage(spark, database, utc_date(F.lit(run_ts).cast("timestamp")))
    return result


def _quarantine(rejected: DataFrame, tables_root: str, run_id: str) -> None:
    rejected.withColumn("run", F.lit(run_id)).write.mode("append").partitionBy("run").parquet(
        f"{tables_root.rstrip('/')}/quarantine"
    )


def manual_backfill(spark: SparkSession, path: str, database: str, tables_root: str, run_id: str) -> dict:
    """Load landing-format files from ``path`` into stage under
    ``run_id``, merge that run and refresh the KPI dates it changed; returns
    load (A6) and merge (A3) counts and the number of files rejected as
    ragged. Each file is bound by its own header. Rows are validated as in the daily run
    (a cell that can't be read is NULL; every required column must be there)
    and the others quarantined with their reasons."""
    configure(spark)
    TB.create_tables(spark, database, tables_root)
    rows, rejected_files = L.scan_landing(spark, path)
    rows = rows.withColumn("run_id", F.lit(run_id))
    checked = ("store_id", "reserve_date")  # reject_reason names these itself
    absent = [F.when(F.col(c).isNull(), F.lit(f"missing_{c}")) for c in REQUIRED_COLUMNS if c not in checked]
    reasons = F.concat_ws(",", F.nullif(reject_reason(rows), F.lit("")), *absent)
    rows = materialize(rows.withColumn("reject_reason", reasons), f"backfill-{run_id}")
    load = TB.load_files_to_stage(spark, database, path, lambda s, p: valid_rows(rows), run_id)
    _quarantine(rejected_rows(rows), tables_root, run_id)
    merge = TB.apply_merge(spark, database, TB.run_source(spark, database, run_id))
    TB.create_kpi_table(spark, database, tables_root)
    TB.refresh_kpi(spark, database)
    return {"load": load, "merge": merge, "rejected_files": rejected_files.count()}
