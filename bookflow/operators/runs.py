"""Per-run bookkeeping as data instead of log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookflow.functions.naming import label_value, landing_object_path, run_id_for
from bookflow.schema import VENDOR

SUCCESS, FAILED, SKIPPED = "success", "failed", "skipped"


def transform_yield(normalized: DataFrame) -> DataFrame:
    """A5: per store, parsed lines vs. rows that pass validation.

    With an ``in_window`` column ``valid_rows`` are those inside the store's
    window and ``outside_rows`` the valid ones outside it, so parsed = valid
    + outside + rejected.
    """
    ok = F.col("reject_reason") == ""
    inside = F.col("in_window") if "in_window" in normalized.columns else F.lit(True)
    counts = [
        F.count(F.lit(1)).alias("parsed_rows"),
        F.count_if(ok & inside).alias("valid_rows"),
        F.count_if(~ok).alias("rejected_rows"),
    ]
    if "in_window" in normalized.columns:
        counts.append(F.count_if(ok & ~inside).alias("outside_rows"))
    return normalized.groupBy("store_id").agg(*counts)


def run_summary(active: DataFrame, normalized: DataFrame, rejected_files: DataFrame | None = None,
                strict: bool = False, windows: DataFrame | None = None) -> DataFrame:
    """A4 + V2: one row per active store: success / failed / skipped.

    * failed  - its export file was rejected by the scan, its window's dates
                (``windows``) can't be read, or (``strict``) any row failed
                validation, which would fail the store's load;
    * skipped - no lines, or no loadable lines;
    * success - ``records`` rows loaded.
    The per-store counts are an aggregate (one row per store), so the join
    with the store list is small on both sides.
    """
    counts = transform_yield(normalized)
    base = active.select("store_id", "store_name").join(counts, "store_id", "left")
    if rejected_files is not None:
        bad = rejected_files.groupBy("store_id").agg(F.first("error", ignorenulls=True).alias("_file_error"))
        base = base.join(bad, "store_id", "left")
    else:
        base = base.withColumn("_file_error", F.lit(None).cast("string"))
    parsed = F.coalesce(F.col("parsed_rows"), F.lit(0))
    valid = F.coalesce(F.col("valid_rows"), F.lit(0))
    rejected = F.coalesce(F.col("rejected_rows"), F.lit(0))
    if windows is not None:
        unread = F.when(F.col("window_from").isNull() | F.col("window_to").isNull(), F.lit("unreadable from_date or to_date"))
        base = base.join(windows.select("store_id", unread.alias("_window_error")), "store_id", "left")
    else:
        base = base.withColumn("_window_error", F.lit(None).cast("string"))
    error = F.when(F.col("_file_error").isNotNull(), F.col("_file_error"))
    error = error.when(F.col("_window_error").isNotNull(), F.col("_window_error"))
    if strict:
        error = error.when(rejected > 0, F.concat(rejected.cast("string"), F.lit(" rows failed validation")))
    status = (
        F.when(error.isNotNull(), F.lit(FAILED))
        .when((parsed == 0) | (valid == 0), F.lit(SKIPPED))
        .otherwise(F.lit(SUCCESS))
    )
    return base.select(
        "store_id",
        "store_name",
        status.alias("status"),
        F.when(status == SUCCESS, valid).otherwise(F.lit(0)).cast("bigint").alias("records"),
        error.alias("error"),
    )


def run_totals(summary: DataFrame) -> DataFrame:
    """Totals by status (number of stores and records)."""
    return summary.groupBy("status").agg(
        F.count(F.lit(1)).alias("stores"), F.sum("records").alias("total_records")
    )


def landing_manifest(loaded: DataFrame) -> DataFrame:
    """L3: one row per (store, run) landing file: record count, upload time,
    vendor and object path."""
    g = loaded.groupBy("store_id", "run_id").agg(
        F.count(F.lit(1)).alias("record_count"), F.min("ingestion_ts").alias("upload_ts")
    )
    return g.select(
        "store_id",
        "run_id",
        "record_count",
        "upload_ts",
        F.lit(VENDOR).alias("vendor"),
        landing_object_path("store_id", "run_id", "upload_ts").alias("object_path"),
    )


def run_labels(stage: DataFrame) -> DataFrame:
    """job-label form of each run id."""
    return stage.select("run_id").distinct().select("run_id", label_value("run_id").alias("run_label"))


def run_ids(stage: DataFrame) -> DataFrame:
    """the run id implied by each run's first ingestion time."""
    g = stage.groupBy("run_id").agg(F.min("ingestion_ts").alias("run_started"))
    return g.select("run_id", "run_started", run_id_for("run_started").alias("derived_run_id"))
