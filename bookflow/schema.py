"""Table schemas, mapping profiles and fixed operating values.

Everything here is plain data. The mapping tables are tiny (tens of
entries) and are turned into literal map expressions, so they travel with
the plan instead of being joined at run time.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the source system's settings and mapping
# tables for results to agree. Do not edit.
# ---------------------------------------------------------------------------

# ---------------------------------------------------------------------------
# Reservation record: 15 columns, same order in stage and production.
# TIME columns are held as zero-padded "HH:mm:ss" strings (Spark's TIME type
# is not usable in CSV and is off by default), which sort identically.
# ---------------------------------------------------------------------------
RESERVATION_SCHEMA = T.StructType(
    [
        T.StructField("store_id", T.StringType(), False),
        T.StructField("store_name", T.StringType(), True),
        T.StructField("reserve_date", T.DateType(), False),
        T.StructField("booking_date", T.DateType(), True),
        T.StructField("start_time", T.StringType(), True),
        T.StructField("end_time", T.StringType(), True),
        T.StructField("course_name", T.StringType(), True),
        T.StructField("headcount", T.LongType(), True),
        T.StructField("channel", T.StringType(), True),
        T.StructField("status", T.StringType(), True),
        T.StructField("vendor", T.StringType(), False),
        T.StructField("ingestion_ts", T.TimestampType(), False),
        T.StructField("run_id", T.StringType(), False),
        T.StructField("record_key", T.StringType(), False),
        T.StructField("record_hash", T.StringType(), False),
    ]
)
RESERVATION_COLUMNS = [f.name for f in RESERVATION_SCHEMA.fields]
REQUIRED_COLUMNS = [f.name for f in RESERVATION_SCHEMA.fields if not f.nullable]

# MERGE matches on these and never rewrites them.
MERGE_KEYS = ["record_key", "vendor", "store_id"]

# Store master: every column is a string, '' for a missing cell.
STORE_COLUMNS = [
    "active",
    "store_id",
    "store_name",
    "rb_username",
    "rb_password",
    "days_back",
    "from_date",
    "to_date",
    "note",
]
# Credential columns are only ever tested for presence, never projected out.
STORE_SECRET_COLUMNS = ["rb_username", "rb_password"]

# Output columns of the report.
REPORT_COLUMNS = ["store_id", "store_name", "reserve_date", "booking_date", "start_time", "end_time", "course_name",
                  "headcount", "channel", "status", "vendor", "ingestion_ts"]

# Internal names of the mapped raw reservation columns (all strings).
RAW_COLUMNS = [
    "reservation_id",
    "store_name_rb",
    "reserve_date_raw",
    "booking_date_raw",
    "start_time_raw",
    "end_time_raw",
    "course_name",
    "headcount_raw",
    "channel_raw",
    "status_raw",
]

VENDOR = "restaurant_board"
SOURCE_TIMEZONE = "Asia/Tokyo"
DEFAULT_DAYS_BACK = 7
STAGE_RETENTION_DAYS = 14
LANDING_RETENTION_DAYS = 30
REPORT_ROW_LIMIT = 10000
LISTING_MAX_RESULTS = 100
RUN_ID_PREFIX = "rb_"
LANDING_PREFIX = "landing/restaurant_board"
MANUAL_PREFIX = "manual/restaurant_board"
CSV_ENCODING = "Shift_JIS"

# CSV header -> internal column name, as executed.
COLUMN_MAP_EXECUTED = {
    "予約番号": "reservation_id",
    "店舗名": "store_name_rb",
    "予約日": "reserve_date_raw",
    "受付日": "booking_date_raw",
    "開始時間": "start_time_raw",
    "終了時間": "end_time_raw",
    "コース名": "course_name",
    "人数": "headcount_raw",
    "経路": "channel_raw",
    "ステータス": "status_raw",
}
# The configuration file's version adds one column.
COLUMN_MAP_EXTENDED = {**COLUMN_MAP_EXECUTED, "備考": "note"}

CHANNEL_MAP_EXECUTED = {
    "ホットペッパー": "hotpepper",
    "食べログ": "tabelog",
    "電話": "phone",
    "店頭": "walk_in",
    "ネット": "web",
}
CHANNEL_MAP_EXTENDED = {
    "ホットペッパー": "hotpepper",
    "食べログ": "tabelog",
    "ぐるなび": "gurunavi",
    "一休": "ikyu",
    "電話": "phone",
    "店頭": "walk_in",
    "ネット": "web",
    "その他": "other",
}

STATUS_MAP_EXECUTED = {
    "確定": "confirmed",
    "キャンセル": "cancelled",
    "仮予約": "tentative",
    "来店済み": "completed",
}
STATUS_MAP_EXTENDED = {**STATUS_MAP_EXECUTED, "ノーショー": "no_show"}

# Date formats tried in order, first match wins (Spark datetime patterns for
# YYYY-MM-DD, YYYY/MM/DD, MM/DD/YYYY, DD/MM/YYYY and YYYY年MM月DD日).
DATE_FORMATS_EXECUTED = ["yyyy-M-d", "yyyy/M/d", "M/d/yyyy", "d/M/yyyy"]
DATE_FORMATS_EXTENDED = DATE_FORMATS_EXECUTED + ["yyyy年M月d日"]

# Time: leading H:mm or HH:mm with optional :ss, no end anchor.
TIME_PATTERN = r"^([0-9]{1,2}):([0-9]{2})(?::([0-9]{2}))?"

# Whitespace as the source language's \s understands it (Java's \s is
# ASCII only), written as a Java regex character class.
JS_WHITESPACE_CLASS = (
    r"[\t\n\x0B\f\r \u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]"
)

# Label values: anything outside [a-z0-9_-] (case-insensitive) becomes '_'.
LABEL_INVALID_PATTERN = r"(?i)[^a-z0-9_-]"


@dataclass(frozen=True)
class Profile:
    """One consistent set of mapping tables."""

    name: str
    column_map: dict = field(hash=False)
    channel_map: dict = field(hash=False)
    status_map: dict = field(hash=False)
    date_formats: tuple = ()


PROFILES = {
    "executed": Profile(
        "executed",
        COLUMN_MAP_EXECUTED,
        CHANNEL_MAP_EXECUTED,
        STATUS_MAP_EXECUTED,
        tuple(DATE_FORMATS_EXECUTED),
    ),
    "extended": Profile(
        "extended",
        COLUMN_MAP_EXTENDED,
        CHANNEL_MAP_EXTENDED,
        STATUS_MAP_EXTENDED,
        tuple(DATE_FORMATS_EXTENDED),
    ),
}


def profile(name_or_profile="executed") -> Profile:
    if isinstance(name_or_profile, Profile):
        return name_or_profile
    return PROFILES[name_or_profile]
