"""Record identity: the stable business key and the content hash.

The content hash is the md5 of a compact JSON object with keys in sorted
order. A field whose raw cell was blank is *absent* from that object, while
a field that was present but failed to parse is ``null``: the two give
different hashes, so the raw columns are consulted here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bookflow.functions.parse import _c, is_blank

# Jackson writes \u00XX escapes with upper-case hex; the hash input uses
# lower-case. Only these control characters have a hex letter.
_UPPER_HEX_ESCAPES = ["000B", "000E", "000F", "001A", "001B", "001C", "001D", "001E", "001F"]
_NEEDS_ESCAPE = r"[\x00-\x1f\"\\]"


def _lower_hex_escapes(j: Column) -> Column:
    for h in _UPPER_HEX_ESCAPES:
        j = F.replace(j, F.lit("\\u" + h), F.lit("\\u" + h.lower()))
    return j


def json_string(c) -> Column:
    """JSON string literal of a string column (NULL stays NULL).

    Backslash, quote and control characters are escaped (short forms where
    they exist, else lower-case ``\\u00xx``); everything else is written as
    is. The common case is a plain concat; only values that need escaping
    take the ``to_json`` path.
    """
    c = _c(c)
    slow = F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'(?s)^\{"v":"(.*)"\}$', 1)
    body = F.when(c.rlike(_NEEDS_ESCAPE), _lower_hex_escapes(slow)).otherwise(c)
    return F.concat(F.lit('"'), body, F.lit('"'))


def json_members(*members: tuple[str, Column]) -> Column:
    """``"k1":v1,"k2":v2`` for string members that are always present
    (NULL -> ``null``). One guard and one ``to_json`` serve the group."""
    fast = F.concat_ws(
        ",", *[F.concat(F.lit(f'"{k}":'), F.coalesce(_quoted(v), F.lit("null"))) for k, v in members]
    )
    as_json = F.to_json(F.struct(*[v.alias(k) for k, v in members]), {"ignoreNullFields": "false"})
    slow = _lower_hex_escapes(F.regexp_extract(as_json, r"(?s)^\{(.*)\}$", 1))
    needs = F.concat_ws("", *[v for _, v in members]).rlike(_NEEDS_ESCAPE)
    return F.when(needs, slow).otherwise(fast)


def _quoted(c) -> Column:
    """JSON literal of a value that never needs escaping (dates, HH:mm:ss)."""
    return F.concat(F.lit('"'), _c(c), F.lit('"'))


def _field(name: str, json_value: Column, raw: Column | None = None) -> Column:
    """``"name":value`` with ``null`` for NULL; NULL (omitted) when ``raw`` is blank."""
    frag = F.concat(F.lit(f'"{name}":'), F.coalesce(json_value, F.lit("null")))
    if raw is None:
        return frag
    return F.when(~is_blank(raw), frag)


def record_hash(
    store_id="store_id",
    reserve_date="reserve_date",
    booking_date="booking_date",
    start_time="start_time",
    end_time="end_time",
    course_name="course_name",
    headcount="headcount",
    channel="channel",
    status="status",
    reserve_date_raw="reserve_date_raw",
    booking_date_raw="booking_date_raw",
    start_time_raw="start_time_raw",
    end_time_raw="end_time_raw",
    headcount_raw="headcount_raw",
) -> Column:
    """md5 over the 9 content fields (store_name and vendor are not hashed)."""
    date_str = lambda c: _quoted(F.date_format(_c(c), "yyyy-MM-dd"))
    parts = [  # sorted key order
        _field("booking_date", date_str(booking_date), _c(booking_date_raw)),
        json_members(("channel", _c(channel)), ("course_name", _c(course_name))),
        _field("end_time", _quoted(end_time), _c(end_time_raw)),
        _field("headcount", _c(headcount).cast("string"), _c(headcount_raw)),
        _field("reserve_date", date_str(reserve_date), _c(reserve_date_raw)),
        _field("start_time", _quoted(start_time), _c(start_time_raw)),
        json_members(("status", _c(status)), ("store_id", _c(store_id))),
    ]
    return F.md5(F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")))


def record_key(
    store_id="store_id",
    reservation_id="reservation_id",
    reserve_date="reserve_date",
    start_time="start_time",
    course_name_raw="course_name",
    headcount="headcount",
    channel_raw="channel_raw",
) -> Column:
    """``<store>_<reservation id>``, else a pipe-joined composite of typed date,
    time, headcount and the *raw* course and channel, with fixed defaults."""
    rid = _c(reservation_id)
    composite = F.concat_ws(
        "|",
        _c(store_id),
        F.coalesce(F.date_format(_c(reserve_date), "yyyy-MM-dd"), F.lit("no_date")),
        F.coalesce(F.nullif(_c(start_time), F.lit("")), F.lit("no_time")),
        F.coalesce(F.nullif(_c(course_name_raw), F.lit("")), F.lit("no_course")),
        F.coalesce(_c(headcount).cast("string"), F.lit("0")),
        F.coalesce(F.nullif(_c(channel_raw), F.lit("")), F.lit("no_channel")),
    )
    return F.when(~is_blank(rid), F.concat(_c(store_id), F.lit("_"), rid)).otherwise(composite)
