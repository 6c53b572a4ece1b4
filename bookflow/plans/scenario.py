"""The two-run scenario of FIXTURES.md §3, as lazy plans over the test tables.

run A loads lines with ``src_key % 3 <> 0``; run B loads ``src_key % 3 <> 2``
with updates, a partition-moving date change and a duplicate second load.
Everything is derived from the given tables, so the work scales with them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookflow.operators.mapping import map_columns
from bookflow.operators.merge import merged_table
from bookflow.operators.normalize import normalize, valid_rows
from bookflow.operators.stage import stage_dedup, stage_rows, stage_union
from bookflow.operators.stores import active_stores
from bookflow.session import configure, materialize
from bookflow.sources import fixtures
from bookflow.sources.stores import normalize_store_master


def store_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_store_master(fixtures.stores_raw(spark, sf_dir))


def active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return active_stores(store_master(spark, sf_dir))


def mapped_lines(spark: SparkSession, sf_dir: str, profile="executed") -> DataFrame:
    """P1 over the export-form lines (Japanese headers)."""
    export = fixtures.reservations_export(spark, sf_dir, profile)
    return map_columns(export, profile, keep=("store_id", "src_key"))


def adjust_run_b(typed: DataFrame) -> DataFrame:
    """Run B's edits on typed columns: headcount + 1 on every 10th line and
    reserve_date one month later on lines 10 mod 70."""
    k = F.col("src_key")
    return typed.withColumns(
        {
            "headcount": F.when(k % 10 == 0, F.col("headcount") + 1).otherwise(F.col("headcount")),
            "reserve_date": F.when(k % 70 == 10, F.add_months("reserve_date", 1)).otherwise(F.col("reserve_date")),
        }
    )


def normalized_all(spark: SparkSession, sf_dir: str, profile="executed") -> DataFrame:
    """Every export line, normalised as one run."""
    return normalize(mapped_lines(spark, sf_dir, profile), active(spark, sf_dir), fixtures.RUN_A["run_id"],
                     fixtures.RUN_A["ingestion_ts"], profile, keep=("src_key",))


def normalized_run_a(spark: SparkSession, sf_dir: str, profile="executed", lines: DataFrame | None = None) -> DataFrame:
    lines = (mapped_lines(spark, sf_dir, profile) if lines is None else lines).filter(F.col("src_key") % 3 != 0)
    return normalize(lines, active(spark, sf_dir), fixtures.RUN_A["run_id"], fixtures.RUN_A["ingestion_ts"],
                     profile, keep=("src_key",))


def normalized_run_b(spark: SparkSession, sf_dir: str, profile="executed", lines: DataFrame | None = None) -> DataFrame:
    lines = (mapped_lines(spark, sf_dir, profile) if lines is None else lines).filter(F.col("src_key") % 3 != 2)
    return normalize(lines, active(spark, sf_dir), fixtures.RUN_B["run_id"], fixtures.RUN_B["ingestion_ts"],
                     profile, adjust=adjust_run_b, keep=("src_key",))


@dataclass
class Scenario:
    stage: DataFrame
    load_a: DataFrame
    load_b: DataFrame
    target: DataFrame
    source: DataFrame

    def merged(self) -> DataFrame:
        return merged_table(self.target, self.source)


def build(spark: SparkSession, sf_dir: str, profile="executed", persist_stage: bool = True) -> Scenario:
    """Both runs' loads, the stage table, production after run A and run B's
    deduplicated source. With ``persist_stage`` the export's lines and the
    stage are written once each (as the pipeline's exports and stage table
    are) and everything downstream reads them."""
    configure(spark)
    lines = mapped_lines(spark, sf_dir, profile)
    if persist_stage:
        # Both runs read the lines; scan, join and spread the export once.
        lines = materialize(lines, "lines")
    a = normalized_run_a(spark, sf_dir, profile, lines)
    b = normalized_run_b(spark, sf_dir, profile, lines)
    if persist_stage:
        # Run B feeds two loads; normalise it once.
        b = materialize(b, "normalized-b")
    load_a = stage_rows(valid_rows(a))
    b_valid = b.filter(F.col("reject_reason") == "")
    second = b_valid.filter(F.col("src_key") % 20 == 0).withColumn(
        "ingestion_ts", F.col("ingestion_ts") + F.expr("INTERVAL 1 HOUR")
    )
    load_b = stage_union(stage_rows(valid_rows(b_valid)), stage_rows(valid_rows(second)))
    stage = stage_union(load_a, load_b)
    if persist_stage:
        stage = materialize(stage, "stage", partition_by="ingestion_date")
        load_a = stage.filter(F.col("run_id") == fixtures.RUN_A["run_id"])
        load_b = stage.filter(F.col("run_id") == fixtures.RUN_B["run_id"])
    # Production after run A: run A's dedup merged into an empty table = all inserts.
    target = stage_dedup(stage, fixtures.RUN_A["run_id"])
    source = stage_dedup(stage, fixtures.RUN_B["run_id"])
    return Scenario(stage, load_a, load_b, target, source)
