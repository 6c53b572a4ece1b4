"""MERGE of a deduplicated run into the production table.

Match on (record_key, vendor, store_id). A match with a different content
hash is an update (all non-key columns from source), no match is an insert,
everything else stays. ``merged_table`` is the full result as one lazy plan;
the partition-wise writer in ``bookflow.plans.tables`` rewrites only the
partitions it touches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookflow.schema import MERGE_KEYS, RESERVATION_COLUMNS
from bookflow.session import materialize

INSERT, UPDATE, UNCHANGED = "insert", "update", "unchanged"


def target_keys(target: DataFrame) -> DataFrame:
    """Only what matching needs: keys, hash and the (old) partition value."""
    return target.select(
        *MERGE_KEYS,
        F.col("record_hash").alias("_t_hash"),
        F.col("reserve_date").alias("_t_reserve_date"),
        F.lit(True).alias("_t_matched"),
    )


def classify(source: DataFrame, target: DataFrame) -> DataFrame:
    """M1: every source row with its action and the matched row's old date.

    The production side is the big one: its keys are first cut to the run's
    (left semi), which Spark probes map-side when the run's files are small
    enough to broadcast; then only matches, at most one per source row, meet
    the source. A larger run shuffles production's keys once, and the second
    join reuses that partitioning.
    """
    tk = target_keys(target).join(source.select(*MERGE_KEYS), MERGE_KEYS, "left_semi")
    j = source.join(tk, MERGE_KEYS, "left")
    action = (
        F.when(F.col("_t_matched").isNull(), F.lit(INSERT))
        .when(F.col("_t_hash") != F.col("record_hash"), F.lit(UPDATE))
        .otherwise(F.lit(UNCHANGED))
    )
    return j.withColumn("action", action).drop("_t_hash", "_t_matched")


def merge_actions(source: DataFrame, target: DataFrame) -> DataFrame:
    return classify(source, target).select(
        "store_id", "record_key", "action", "reserve_date", F.col("_t_reserve_date").alias("old_reserve_date")
    )


def merge_stats(actions: DataFrame) -> DataFrame:
    """Inserted, updated and unchanged = source rows - inserted - updated."""
    return actions.agg(
        F.count_if(F.col("action") == INSERT).alias("inserted_rows"),
        F.count_if(F.col("action") == UPDATE).alias("updated_rows"),
        (F.count(F.lit(1)) - F.count_if(F.col("action") == INSERT) - F.count_if(F.col("action") == UPDATE)).alias(
            "unchanged_rows"
        ),
    )


def merged_table(target: DataFrame, source: DataFrame) -> DataFrame:
    """M2: production after the MERGE = production rows whose key was not
    updated + inserted and updated source rows.

    The classified run is written once (it is read twice, and its real size
    lets Spark pick the anti join: a small run is broadcast and production
    is not shuffled).
    """
    acts = materialize(classify(source, target), "classified")
    changed = acts.filter(F.col("action") != UNCHANGED).select(RESERVATION_COLUMNS)
    updated = acts.filter(F.col("action") == UPDATE).select(MERGE_KEYS)
    kept = target.join(updated, MERGE_KEYS, "left_anti").select(RESERVATION_COLUMNS)
    return kept.unionByName(changed)
