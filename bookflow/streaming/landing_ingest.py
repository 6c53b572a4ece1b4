"""Incremental stage load from landing files with Structured Streaming.

The batch load job of the daily run, expressed as a file stream: every new
landing CSV is read once with the options it was written with, its header
checked against the record schema, and
appended to the stage location through the parquet file sink, whose commit
log makes the append exactly-once across restarts and lost executors. Run
it with ``availableNow`` from the scheduler (drain what landed, then stop)
or continuously. The merge of a run reads the stage afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from bookflow.operators.stage import STAGE_PARTITION, conform
from bookflow.plans.landing import CSV_OPTIONS, DATA, PARTS
from bookflow.schema import RESERVATION_COLUMNS, RESERVATION_SCHEMA
from bookflow.session import configure

LANDING_FILE_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in RESERVATION_COLUMNS]
    + [T.StructField(p, T.StringType(), True) for p in PARTS]
)


def landing_stream(spark: SparkSession, landing_root: str, max_files_per_trigger: int = 1000) -> DataFrame:
    configure(spark)
    raw = (
        spark.readStream.schema(LANDING_FILE_SCHEMA)
        .options(**CSV_OPTIONS)
        .option("enforceSchema", False)  # the schema is positional: a file with another header stops the stream
        .option("multiLine", True)  # names may hold line breaks; a file is a store's part of a run
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .csv(f"{landing_root.rstrip('/')}/{DATA}")
    )
    return conform(raw.drop(*PARTS)).withColumn(STAGE_PARTITION, F.to_date("ingestion_ts"))


def start_stage_ingest(
    spark: SparkSession, landing_root: str, stage_path: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Start the landing -> stage stream (parquet file sink, partitioned by
    ingestion date). ``checkpoint`` must be on shared storage."""
    w = (
        landing_stream(spark, landing_root)
        .writeStream.format("parquet")
        .option("path", stage_path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(STAGE_PARTITION)
        .outputMode("append")
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_stage_sink(spark: SparkSession, stage_path: str) -> DataFrame:
    """Stage rows committed by the sink (its log hides partial output)."""
    schema = T.StructType(RESERVATION_SCHEMA.fields + [T.StructField(STAGE_PARTITION, T.DateType(), True)])
    return spark.read.schema(schema).parquet(stage_path)
