"""Parts of URLs as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: str | Column) -> Column:
    """What follows the first ``://``; empty for null or without one."""
    url = F.col(url) if isinstance(url, str) else url
    return F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")


def host(url: str | Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), r"^([^/?#]*)", 1), _UPPER, _LOWER)


def path(url: str | Column) -> Column:
    return F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def tokens(url: str | Column) -> Column:
    """The distinct runs of ASCII letters and digits after the scheme, in lower case."""
    runs = F.split(F.translate(after_scheme(url), _UPPER, _LOWER), "[^a-z0-9]+")
    return F.array_distinct(F.filter(runs, lambda t: t != ""))
