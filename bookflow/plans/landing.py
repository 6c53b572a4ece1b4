"""Landing files, their manifest and listings.

Landing files are the normalised records as fully quoted CSV with a header,
one folder per (upload date in the source time zone, run, store). The
manifest that object metadata carried (store, run, record count, upload
time, vendor) is written next to them as a small parquet table.

Files are read back as exports are: each bound by its own header, whatever
the order of its columns, with line breaks inside quotes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookflow.functions.naming import local_ts
from bookflow.operators.runs import landing_manifest
from bookflow.operators.stage import conform
from bookflow.schema import LANDING_RETENTION_DAYS, RESERVATION_COLUMNS
from bookflow.session import configure, materialize
from bookflow.sources.csv_files import scan_exports
from bookflow.storage import delete_folders

DATA = "data"
# Files handed in by a user stand apart from those of the scheduled runs.
MANUAL = "manual"
MANIFEST = "manifest"
# Folder levels; the files themselves keep all 15 record columns.
PARTS = ["ingest_date", "run", "store"]
# How landing files are written, and read by a stream.
CSV_OPTIONS = {"header": "true", "quoteAll": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
CSV_ENCODING = "UTF-8"


def write_landing(valid: DataFrame, root: str, upload_type: str = "scheduled", folder: str = DATA) -> None:
    """L2 + L3: append landing CSVs under ``folder`` and their manifest."""
    root = root.rstrip("/")
    rows = valid.select(
        *RESERVATION_COLUMNS,
        F.date_format(local_ts("ingestion_ts"), "yyyy-MM-dd").alias("ingest_date"),
        F.col("run_id").alias("run"),
        F.col("store_id").alias("store"),
    )
    # rebalance: about one file per (run, store) folder; AQE splits a store
    # that holds a large share of the rows instead of giving it to one task.
    (
        rows.hint("rebalance", "run", "store")
        .write.mode("append")
        .partitionBy(*PARTS)
        .options(**CSV_OPTIONS)
        .csv(f"{root}/{folder}")
    )
    path = F.concat(
        F.lit(f"{root}/{folder}/ingest_date="), F.date_format(local_ts("upload_ts"), "yyyy-MM-dd"),
        F.lit("/run="), F.col("run_id"), F.lit("/store="), F.col("store_id"),
    )
    manifest = landing_manifest(valid).withColumns({"object_path": path, "upload_type": F.lit(upload_type)})
    manifest.write.mode("append").partitionBy("run_id").parquet(f"{root}/{MANIFEST}")


def write_manual(valid: DataFrame, root: str) -> None:
    """L4: files handed in by a user, under their own folder and marked so in the manifest."""
    write_landing(valid, root, "manual", MANUAL)


def scan_landing(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Landing (or manual) CSVs as (rows of the fixed record schema, rejected files); every file is bound by its own
    header (columns in any order, absent ones NULL), an empty cell is NULL. Folder levels that repeat run and store
    don't count; the files' own columns carry the values."""
    lines, rejected = scan_exports(spark, path, CSV_ENCODING, RESERVATION_COLUMNS)
    return conform(lines.select([F.nullif(F.col(c), F.lit("")).alias(c) for c in lines.columns if c in RESERVATION_COLUMNS])), rejected


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """The rows of ``scan_landing``, ready for a stage append."""
    return scan_landing(spark, path)[0]


def inventory(spark: SparkSession, root: str, max_results: int | None = None, folder: str = DATA, ingest_date: str | None = None) -> DataFrame:
    """C4 + O3: one row per landing object under ``folder`` (a store's folder of one run and
    date): part files, bytes and last modification from a listing, record
    count and upload time from the manifest; all of them, or the first
    ``max_results`` by path. With ``ingest_date`` only that date's folders
    are listed. File contents are never read."""
    configure(spark)
    root = root.rstrip("/")
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .option("basePath", f"{root}/{folder}")
        .load(f"{root}/{folder}" + (f"/ingest_date={ingest_date}" if ingest_date else ""))
    )
    # an emptied folder has no levels to infer
    listed = listed.withColumns({p: F.lit(None).cast("string") for p in PARTS if p not in listed.columns})
    files = (
        listed
        .select("path", "length", "modificationTime", *PARTS)
        .withColumnsRenamed({"run": "run_id", "store": "store_id"})
        .groupBy("ingest_date", "run_id", "store_id")
        .agg(
            F.regexp_replace(F.min("path"), "/[^/]*$", "").alias("path"),
            F.count(F.lit(1)).alias("files"),
            F.sum("length").alias("length"),
            F.max("modificationTime").alias("modificationTime"),
        )
    )
    # A run that was landed in several writes has several manifest rows.
    man = (
        spark.read.parquet(f"{root}/{MANIFEST}")
        .filter(F.col("object_path").startswith(f"{root}/{folder}/"))
        .withColumn("ingest_date", F.date_format(local_ts("upload_ts"), "yyyy-MM-dd"))
        .groupBy("ingest_date", "run_id", "store_id")
        .agg(
            F.sum("record_count").alias("record_count"),
            F.min("upload_ts").alias("upload_ts"),
            F.min("vendor").alias("vendor"),
            F.min("upload_type").alias("upload_type"),
        )
    )
    out = files.join(man, ["ingest_date", "run_id", "store_id"], "left").orderBy("ingest_date", "run_id", "store_id")
    return out.limit(max_results) if max_results else out


def expired_files(inv: DataFrame, as_of_ts, days: int = LANDING_RETENTION_DAYS, by: str = "modificationTime") -> DataFrame:
    """Landing objects last modified (or, by ``upload_ts``, first uploaded) before ``as_of_ts - days``."""
    cutoff = F.lit(str(as_of_ts)).cast("timestamp") - F.make_interval(days=F.lit(days))
    return inv.filter(F.col(by) < cutoff)


def run_files(spark: SparkSession, root: str, run_id: str, ingest_date: str, folder: str = DATA) -> DataFrame:
    """Files and bytes that a run landed for each store, from the listing of its date."""
    own = inventory(spark, root, folder=folder, ingest_date=ingest_date).filter(F.col("run_id") == run_id)
    return own.select("run_id", "store_id", F.col("files").alias("input_files"), F.col("length").alias("input_bytes"))


def expire_landing(spark: SparkSession, root: str, as_of_ts, days: int = LANDING_RETENTION_DAYS, by: str = "modificationTime", folder: str = DATA) -> DataFrame:
    """Delete the expired landing objects under ``folder``; returns what was removed (their rows of the inventory).
    The list is written before anything goes, so a run that dies is made good by the next one. The manifest keeps its
    rows: it says what was landed once."""
    gone = materialize(expired_files(inventory(spark, root, folder=folder), as_of_ts, days, by), "landing-expired")
    delete_folders(spark, [r["path"] for r in gone.select("path").toLocalIterator()])
    return gone


def table_profile(spark: SparkSession, table: str) -> DataFrame:
    """Rows, bytes, files, creation and last modification, and schema of a table.

    The creation time is the catalog's; the rest comes from one scan of the
    files' metadata (row counts from the footers, no column is read), so it
    covers the files the table has now, wherever its partitions lie.
    """
    configure(spark)
    df = spark.table(table)
    spark.sql(f"REFRESH TABLE {table}")
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    files = df.groupBy("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").agg(F.count(F.lit(1)).alias("n"))
    stats = files.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("num_rows"),
        F.count(F.lit(1)).alias("num_files"),
        F.coalesce(F.sum("file_size"), F.lit(0)).alias("num_bytes"),
        F.max("file_modification_time").alias("last_modified_time"),
    )
    # e.g. "Thu Jan 02 03:04:05 UTC 2025"; the day of the week can't be parsed
    created = F.to_timestamp(F.lit(about["Created Time"].split(" ", 1)[1]), "MMM dd HH:mm:ss zzz yyyy")
    return stats.select(
        F.lit(table).alias("table_id"),
        "num_rows",
        "num_bytes",
        "num_files",
        created.alias("creation_time"),
        "last_modified_time",
        F.lit(df.schema.simpleString()).alias("schema"),
    )
