"""Run ids, job labels, landing object paths and date truncation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bookflow.functions.parse import _c
from bookflow.schema import LABEL_INVALID_PATTERN, LANDING_PREFIX, MANUAL_PREFIX, RUN_ID_PREFIX, SOURCE_TIMEZONE


def local_ts(ts) -> Column:
    """UTC instant -> wall-clock time in the source time zone."""
    return F.from_utc_timestamp(_c(ts), SOURCE_TIMEZONE)


def run_id_for(ts) -> Column:
    """``rb_YYYYMMDD_HHmmss`` of the run start, in the source time zone."""
    return F.concat(F.lit(RUN_ID_PREFIX), F.date_format(local_ts(ts), "yyyyMMdd_HHmmss"))


def label_value(c) -> Column:
    """Job-label form: non ``[a-z0-9_-]`` characters -> '_', lower case."""
    return F.lower(F.regexp_replace(_c(c), LABEL_INVALID_PATTERN, "_"))


def landing_object_path(store_id, run_id, upload_ts, prefix: str = LANDING_PREFIX) -> Column:
    """``<prefix>/YYYY/MM/DD/run_<run_id>/rb_<store>_<YYYYMMDD>.csv`` (source time zone)."""
    t = local_ts(upload_ts)
    return F.concat(
        F.lit(prefix + "/"),
        F.date_format(t, "yyyy/MM/dd"),
        F.lit("/run_"),
        _c(run_id),
        F.lit("/rb_"),
        _c(store_id),
        F.lit("_"),
        F.date_format(t, "yyyyMMdd"),
        F.lit(".csv"),
    )


def manual_object_path(filename, upload_ts, prefix: str = MANUAL_PREFIX) -> Column:
    """``<manual prefix>/YYYY/MM/DD/<filename>`` (source time zone)."""
    t = local_ts(upload_ts)
    return F.concat(F.lit(prefix + "/"), F.date_format(t, "yyyy/MM/dd"), F.lit("/"), _c(filename))


def utc_date(ts) -> Column:
    """``DATE(ts)``: calendar date of the instant in UTC (session zone is UTC)."""
    return F.to_date(_c(ts))
