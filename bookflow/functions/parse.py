"""Typed parsing of raw reservation strings (dates, times, integers, labels).

All of these are built-in Column expressions, so they stay inside
whole-stage codegen; no Python runs per row. Blank input always gives NULL;
the caller keeps the raw column to tell "blank" from "failed" (see
``identity.record_hash``).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from bookflow.schema import JS_WHITESPACE_CLASS, TIME_PATTERN


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c) -> Column:
    """True for NULL (column absent) and '' (empty cell): the 'falsy' raw values."""
    c = _c(c)
    return c.isNull() | (c == F.lit(""))


def _format_guard(c: Column, fmt: str) -> Column:
    """A cheap *necessary* condition for ``try_to_date(c, fmt)`` to succeed.

    A failed parse costs an exception inside the JVM, so attempts that cannot
    succeed are skipped. Every guard only tests things the format requires
    (its separator, a year field of at least 4 characters, a month field not
    above 12), so the guarded chain returns exactly what the plain ordered
    chain returns.
    """
    seps = [ch for ch in fmt if not ch.isalpha()]
    if not seps:
        return F.lit(True)
    sep = seps[0]
    cond = F.instr(c, sep) > 0
    if fmt.startswith("yyyy"):
        cond = cond & (F.instr(c, sep) >= 5)
    if fmt.endswith("yyyy"):
        cond = cond & (F.length(F.substring_index(c, sep, -1)) >= 4)
    if fmt.startswith("M" + sep):
        first = F.substring_index(c, sep, 1).try_cast("int")
        cond = cond & F.coalesce(first <= 12, F.lit(True))
    return cond


def parse_date(c, formats: Iterable[str]) -> Column:
    """First format that parses the whole string strictly wins; otherwise NULL.

    Impossible dates (2024-02-31) are NULL, never rolled over.
    """
    c = _c(c)
    attempts = [F.when(_format_guard(c, fmt), F.try_to_date(c, fmt)) for fmt in formats]
    return F.when(~is_blank(c), F.coalesce(*attempts))


def parse_time(c) -> Column:
    """Leading ``H:mm`` / ``HH:mm`` with optional ``:ss`` -> ``HH:mm:ss``.

    The pattern has no end anchor (``18:30以降`` -> ``18:30:00``) and no
    range check (``25:00`` -> ``25:00:00``); range is checked by validation.
    One regex extracts the matched prefix; the parts are split off it.
    """
    c = _c(c)
    m = F.regexp_extract(c, TIME_PATTERN, 0)
    parts = F.split(m, ":")
    hh = F.lpad(F.get(parts, 0), 2, "0")
    ss = F.coalesce(F.get(parts, 2), F.lit("00"))
    return F.when(~is_blank(c) & (m != ""), F.concat_ws(":", hh, F.get(parts, 1), ss))


def valid_time_of_day(c) -> Column:
    """NULL or a real time of day 00:00:00-23:59:59."""
    c = _c(c)
    return c.isNull() | c.rlike(r"^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$")


_INT_PREFIX = "^" + JS_WHITESPACE_CLASS + r"*([+-]?[0-9]+)"


def parse_int(c) -> Column:
    """Base-10 integer prefix: leading whitespace, optional sign, ASCII digits.

    ``4名`` -> 4, ``12.7`` -> 12, ``多数`` / ``４`` -> NULL. Values outside
    BIGINT are NULL.
    """
    c = _c(c)
    digits = F.nullif(F.regexp_extract(c, _INT_PREFIX, 1), F.lit(""))
    return F.when(~is_blank(c), digits.try_cast("bigint"))


def map_with_fallback(c, mapping: dict) -> Column:
    """Mapped value when known, else lower-case with whitespace runs -> '_'; blank -> NULL."""
    c = _c(c)
    if mapping:
        lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[c]
    else:
        lookup = F.lit(None).cast("string")
    fallback = F.regexp_replace(F.lower(c), JS_WHITESPACE_CLASS + "+", "_")
    return F.when(~is_blank(c), F.coalesce(lookup, fallback))


def int_or_default(c, default: int) -> Column:
    """``parseInt(x) || default``: NULL, unparsable and 0 all take the default."""
    v = parse_int(c)
    return F.coalesce(F.nullif(v, F.lit(0)).try_cast("int"), F.lit(default))  # beyond an int: the default, too
