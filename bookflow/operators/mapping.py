"""Bind export columns by header name to internal names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookflow.schema import profile as get_profile


def map_columns(raw: DataFrame, profile="executed", keep: Iterable[str] = ()) -> DataFrame:
    """Rename known export columns, drop unknown ones, NULL for absent ones.

    NULL (absent) and '' (empty cell) are both "blank" downstream, exactly as
    a missing key and an empty string are both falsy in the source system.
    ``keep`` passes lineage columns (store_id, file path, ...) through.
    """
    present = set(raw.columns)
    cols = [F.col(c) for c in keep if c in present]
    for src, dst in get_profile(profile).column_map.items():
        if src in present:
            cols.append(F.col(src).cast("string").alias(dst))
        elif dst in present:  # already in internal names
            cols.append(F.col(dst).cast("string").alias(dst))
        else:
            cols.append(F.lit(None).cast("string").alias(dst))
    return raw.select(cols)
