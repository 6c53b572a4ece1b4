"""Store filters, defaults, validation and per-store date windows."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookflow.functions.parse import int_or_default, parse_date, parse_int
from bookflow.schema import DATE_FORMATS_EXECUTED, DEFAULT_DAYS_BACK

# Further back (or ahead) than this is before (after) every reservation.
MAX_DAYS = 700_000


def _nonblank(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) != ""


def active_stores(stores: DataFrame, default_days_back: int = DEFAULT_DAYS_BACK) -> DataFrame:
    """Active (``lower(active) = 'true'``) stores with store id and both
    credentials present; ``days_back`` = integer prefix, 0/blank -> default.
    Credentials are tested, never projected."""
    ok = (
        (F.lower(F.col("active")) == "true")
        & _nonblank("store_id")
        & _nonblank("rb_username")
        & _nonblank("rb_password")
    )
    return stores.filter(ok).select(
        "store_id",
        "store_name",
        int_or_default("days_back", default_days_back).alias("days_back"),
        "from_date",
        "to_date",
        "note",
    )


STORE_REQUIRED = ["store_id", "store_name", "rb_username", "rb_password"]


def store_missing_fields(stores: DataFrame) -> DataFrame:
    """Per store: comma list of missing required fields ('' when complete)."""
    missing = F.concat_ws(", ", *[F.when(~_nonblank(c), F.lit(c)) for c in STORE_REQUIRED])
    return stores.select(
        F.coalesce(F.nullif(F.col("store_id"), F.lit("")), F.lit("unknown")).alias("store_id"),
        missing.alias("missing_fields"),
        (missing == "").alias("is_valid"),
    )


def _as_date(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, _dt.date):
        v = v.isoformat()
    return F.lit(v).cast("date")


def store_windows(active: DataFrame, as_of) -> DataFrame:
    """Per-store extraction window.

    Both explicit dates set -> [from_date, to_date]; otherwise
    [as_of - (days_back + 1), as_of - 1] (yesterday back days_back+1 days).
    Explicit dates take the same ordered formats as reservation dates; an
    unreadable one leaves a NULL bound, which ``run_summary`` reports as the
    store's error. ``as_of`` is "today" in the source time zone, a parameter.
    """
    today = _as_date(as_of)
    explicit = _nonblank("from_date") & _nonblank("to_date")
    days = F.coalesce(F.nullif(parse_int(F.col("days_back").cast("string")), F.lit(0)), F.lit(DEFAULT_DAYS_BACK))
    days = F.greatest(F.least(days, F.lit(MAX_DAYS)), F.lit(-MAX_DAYS))
    return active.select(
        "store_id",
        F.when(explicit, parse_date("from_date", DATE_FORMATS_EXECUTED))
        .otherwise(F.date_sub(today, (days + 1).cast("int")))
        .alias("window_from"),
        F.when(explicit, parse_date("to_date", DATE_FORMATS_EXECUTED))
        .otherwise(F.date_sub(today, 1))
        .alias("window_to"),
    )


def mark_window(reservations: DataFrame, windows: DataFrame) -> DataFrame:
    """Every row with ``in_window``: whether its reserve_date lies inside its
    own store's window (false for a NULL date or a NULL bound; no row goes).

    An equi join on store_id with one row per store on the other side, which
    Spark broadcasts when its files are small; otherwise AQE splits a store
    that holds a large share of the rows.
    """
    w = windows.withColumnRenamed("store_id", "_w_store_id")
    j = reservations.join(w, F.col("store_id") == F.col("_w_store_id"), "left")
    inside = F.col("reserve_date").between(F.col("window_from"), F.col("window_to"))
    return j.withColumn("in_window", F.coalesce(inside, F.lit(False))).drop("_w_store_id", "window_from", "window_to")


def windowed_reservations(reservations: DataFrame, windows: DataFrame) -> DataFrame:
    """Rows whose reserve_date lies inside their own store's window."""
    return mark_window(reservations, windows).filter("in_window").drop("in_window")
