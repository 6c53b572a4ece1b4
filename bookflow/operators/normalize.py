"""Raw lines -> typed, identified, validated records.

One lazy plan for all stores at once: scan -> rename -> typed columns ->
broadcast join with the store master -> key and hash -> reject reason.
No per-store driver loop, no Python UDF.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookflow.functions.identity import record_hash, record_key
from bookflow.functions.parse import map_with_fallback, parse_date, parse_int, parse_time, valid_time_of_day
from bookflow.schema import RESERVATION_COLUMNS, VENDOR
from bookflow.schema import profile as get_profile

def typed_reservations(mapped: DataFrame, profile="executed") -> DataFrame:
    """add typed columns next to the raw ones (raw kept for the hash)."""
    p = get_profile(profile)
    return mapped.withColumns(
        {
            "reserve_date": parse_date("reserve_date_raw", p.date_formats),
            "booking_date": parse_date("booking_date_raw", p.date_formats),
            "start_time": parse_time("start_time_raw"),
            "end_time": parse_time("end_time_raw"),
            "headcount": parse_int("headcount_raw"),
        }
    )


def _ts(v) -> Column:
    return v if isinstance(v, Column) else F.lit(str(v)).cast("timestamp")


def identify(typed: DataFrame, store_names: DataFrame, run_id, ingestion_ts, profile="executed",
             keep: Iterable[str] = ()) -> DataFrame:
    """J1 + P2/P3: join each line to its store, standardise, key, hash."""
    p = get_profile(profile)
    # store_id and store_name both come from the store master (the joined
    # side), as each record takes its store's identity.
    stores = store_names.select(F.col("store_id").alias("_m_store_id"), F.col("store_name").alias("_m_store_name"))
    # No NULL id is left among the stores, so <=> joins as = does. From = Spark
    # would derive, for any filter on reject_reason, a second one on the lines'
    # own store_id and move it, with all parsing, below the shuffle that
    # spreads a single-split input.
    stores = stores.filter(F.col("_m_store_id").isNotNull())
    j = typed.join(stores, typed["store_id"].eqNullSafe(stores["_m_store_id"]), "inner")
    # Two projections: standardised channel/status are used twice (output and
    # hash), so they are computed once and referenced, not inlined twice.
    std = j.select(
        *[F.col(c) for c in keep],
        F.col("_m_store_id").alias("store_id"), F.col("_m_store_name").alias("store_name"), "reserve_date", "booking_date", "start_time", "end_time", "headcount",
        "reservation_id", "channel_raw", "reserve_date_raw", "booking_date_raw", "start_time_raw",
        "end_time_raw", "headcount_raw",
        F.col("course_name").alias("_course_raw"),
        F.nullif(F.col("course_name"), F.lit("")).alias("course_name"),
        map_with_fallback("channel_raw", p.channel_map).alias("channel"),
        map_with_fallback("status_raw", p.status_map).alias("status"),
    )
    return std.select(
        *[F.col(c) for c in keep],
        *[c for c in RESERVATION_COLUMNS[:10]],
        F.lit(VENDOR).alias("vendor"),
        _ts(ingestion_ts).alias("ingestion_ts"),
        (run_id if isinstance(run_id, Column) else F.lit(run_id)).alias("run_id"),
        record_key(course_name_raw=F.col("_course_raw")).alias("record_key"),
        record_hash().alias("record_hash"),
    )


def reject_reason(df: DataFrame) -> Column:
    """'' for a loadable row, else a comma list of reasons (V1)."""
    sid = F.coalesce(F.col("store_id"), F.lit(""))
    return F.concat_ws(
        ",",
        F.when(sid == "", F.lit("missing_store_id")),
        F.when(F.col("reserve_date").isNull(), F.lit("missing_reserve_date")),
        F.when(~valid_time_of_day("start_time"), F.lit("bad_start_time")),
        F.when(~valid_time_of_day("end_time"), F.lit("bad_end_time")),
    )


def normalize(
    mapped: DataFrame,
    stores: DataFrame,
    run_id,
    ingestion_ts,
    profile="executed",
    adjust: Callable[[DataFrame], DataFrame] | None = None,
    keep: Iterable[str] = (),
) -> DataFrame:
    """Normalised 15-column records plus ``reject_reason`` (and ``keep`` columns).

    ``stores`` is the active store master; lines of other stores drop out,
    as only active stores are processed. ``adjust`` may rewrite typed
    columns before key and hash are computed.
    """
    typed = typed_reservations(mapped, profile)
    if adjust is not None:
        typed = adjust(typed)
    out = identify(typed, stores, run_id, ingestion_ts, profile, keep=keep)
    return out.withColumn("reject_reason", reject_reason(out))


def valid_rows(normalized: DataFrame) -> DataFrame:
    """Rows that satisfy every REQUIRED column and TIME range, 15 columns."""
    return normalized.filter(F.col("reject_reason") == "").select(RESERVATION_COLUMNS)


def rejected_rows(normalized: DataFrame) -> DataFrame:
    """Quarantined rows with their reasons."""
    return normalized.filter(F.col("reject_reason") != "").select(*RESERVATION_COLUMNS, "reject_reason")
