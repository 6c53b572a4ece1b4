"""Stage rows, per-run dedup and retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bookflow.functions.naming import utc_date
from bookflow.schema import RESERVATION_COLUMNS, RESERVATION_SCHEMA, STAGE_RETENTION_DAYS

STAGE_PARTITION = "ingestion_date"


def conform(df: DataFrame) -> DataFrame:
    """Bind by *name* to the fixed 15-column schema (absent -> NULL), cast types; a cell that can't be cast is NULL."""
    present = set(df.columns)
    return df.select(
        [
            (F.col(f.name) if f.name in present else F.lit(None)).try_cast(f.dataType).alias(f.name)
            for f in RESERVATION_SCHEMA.fields
        ]
    )


def stage_rows(valid: DataFrame) -> DataFrame:
    """L1: rows as they are appended to stage, with the UTC ingestion date
    partition column (``DATE(ingestion_ts)``)."""
    c = conform(valid)
    return c.withColumn(STAGE_PARTITION, utc_date("ingestion_ts"))


def stage_union(*loads: DataFrame) -> DataFrame:
    """Appends are a bag union (duplicates kept)."""
    out = loads[0]
    for d in loads[1:]:
        out = out.unionByName(d)
    return out


def stage_dedup(stage: DataFrame, run_id: str) -> DataFrame:
    """W1 + P9 + P10: the run's rows, one per record_key, latest ingestion first.

    Ties (all rows of one store in one run share ingestion_ts) are broken by
    record_hash then store_id so the pick is deterministic. Catalyst turns
    ``row_number() = 1`` into a map-side WindowGroupLimit, so a record_key
    holding a huge share of the rows is cut to one row per map task before
    the shuffle.
    """
    w = Window.partitionBy("record_key").orderBy(
        F.col("ingestion_ts").desc(), F.col("record_hash").asc(), F.col("store_id").asc()
    )
    runs = stage.filter(F.col("run_id") == F.lit(run_id)).select(RESERVATION_COLUMNS)
    return runs.withColumn("_row_num", F.row_number().over(w)).filter("_row_num = 1").drop("_row_num")


def retention_cutoff(as_of, days: int = STAGE_RETENTION_DAYS):
    d = as_of if not isinstance(as_of, str) else F.lit(as_of).cast("date")
    return F.date_sub(d, days)


def stage_retention(stage: DataFrame, as_of, days: int = STAGE_RETENTION_DAYS) -> DataFrame:
    """L7 as a query: rows that survive ``DATE(ingestion_ts) < as_of - days`` deletion.

    The predicate is on the partition column, so on a partitioned table it
    prunes whole partitions.
    """
    return stage.filter(F.col(STAGE_PARTITION) >= retention_cutoff(as_of, days))
