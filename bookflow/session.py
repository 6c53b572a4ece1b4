"""Session settings and the shared scratch location.

``configure`` only sets runtime SQL confs, so it can be applied to a
session somebody else built (the driver's, a notebook's, a cluster job's).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Confs the pipeline's semantics depend on.
SEMANTIC_CONFS = {
    # DATE(ingestion_ts) and the stage partition are UTC dates.
    "spark.sql.session.timeZone": "UTC",
    # store ids such as "001" must stay strings when read from partition paths.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Shift_JIS is not in Spark 4's default charset list.
    "spark.sql.legacy.javaCharsets": "true",
    # A malformed byte in an export becomes a replacement character.
    "spark.sql.legacy.codingErrorAction": "true",
    # MERGE rewrites only the partitions it touches.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Confs for scale: runtime re-planning, skew splitting, partition coalescing.
SCALE_CONFS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # HotSpot does not JIT-compile methods over 8000 bytes of bytecode; a
    # fused stage beyond that runs interpreted. Above it, Spark keeps
    # per-operator code for that subtree only (normalisation is one wide
    # projection chain; aggregations and joins stay fused).
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A small run written into many date partitions costs per file, not per
    # byte: keep such tiny shuffles (rebalance before a partitioned write)
    # spread over several tasks instead of coalescing them into one. With
    # large shuffles AQE's computed target size is far above this floor.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(32 * 1024),
}


def configure(spark: SparkSession) -> SparkSession:
    for k, v in {**SEMANTIC_CONFS, **SCALE_CONFS}.items():
        spark.conf.set(k, v)
    return spark


def build_session(master: str | None = None, app: str = "bookflow", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests; on a cluster use the provided one and ``configure`` it."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.execution.arrow.pyspark.enabled", "true")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**SEMANTIC_CONFS, **SCALE_CONFS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without one (tests, laptops) gets a temp
    folder; a cluster session without it is an error, because a machine-local
    folder is not visible to other executors.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return sc.getCheckpointDir() or d
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    d = tempfile.mkdtemp(prefix="bookflow-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder under the checkpoint root for written intermediates."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/bookflow/{purpose}/{uuid.uuid4().hex}"


def materialize(df, purpose: str, partition_by: str | None = None):
    """Write ``df`` once as parquet under the checkpoint root and read it back.

    Cuts lineage (a lost executor re-reads files instead of recomputing the
    whole upstream plan) and splits a long plan into stages that Spark can
    compile and schedule separately. The schema is re-applied on read so
    partition columns keep their types.
    """
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(df.columns)
