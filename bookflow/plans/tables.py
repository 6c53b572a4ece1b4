"""Catalog tables and their write paths.

* stage: append-only parquet table partitioned by ``ingestion_date``
  (``DATE(ingestion_ts)``), rows clustered by store_id, vendor, run_id; with
  a registry of the dates that hold a run's rows and the statistics of loads.
* production: parquet table partitioned by ``reserve_date``, rows clustered
  by store_id, channel; its partitions lie in versioned folders
  (``bookflow.plans.versions``).
* keys: what a merge must know of production's rows (merge keys, content
  hash, date, and the values of the KPI), bucketed by the merge keys. Every
  merge appends its inserts and updates as one segment (``seq``); the last
  segment that has a key counts. Every ``KEY_SEGMENTS``-th merge writes all
  keys anew as one segment.

MERGE on plain parquet (no row-level operations):

1. classify the deduplicated run against the keys, bucket to bucket (production
   itself isn't read), and write the classified run to scratch (cuts
   lineage; survives executor loss; read several times);
2. touched dates = new and old dates of the inserts and updates (an update
   can move a row to another date);
3. new content of the touched dates = their rows minus updated keys, plus the
   updated and inserted rows; written once, to a fresh folder;
4. the merge's keys and the changes of KPI sums are written under its number;
5. one small file commits all of it; then the catalog's partitions are
   switched, dates without rows go with the same statement.

A run that dies before step 5 has changed nothing; one that dies after it is
carried on by the next one. Re-running a merge is idempotent: updates become
"unchanged", nothing is inserted.

The KPI table holds sums and counts. A merge stores the signed changes of them
(old values of updated rows subtracted, new ones added); ``refresh_kpi`` adds
the changes since its last run to the stored rows of their dates, without
reading production.
"""

from __future__ import annotations

import datetime as _dt
import logging
import time

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from bookflow.operators.merge import INSERT, UNCHANGED, UPDATE
from bookflow.operators.reports import KPI_KEYS
from bookflow.operators.stage import STAGE_PARTITION, conform, retention_cutoff, stage_dedup
from bookflow.plans import versions as V
from bookflow.schema import MERGE_KEYS, RESERVATION_COLUMNS, RESERVATION_SCHEMA, STAGE_RETENTION_DAYS
from bookflow.session import configure, materialize
from bookflow.storage import delete_folders

log = logging.getLogger(__name__)

STAGE = "stage_reservations"
STAGE_RUNS = "stage_runs"
LOAD_STATS = "load_stats"
PRODUCTION = "reservations"
KEYS = "reservation_keys"
KPI = "daily_kpi"
KPI_CHANGES = "kpi_changes"

DAY = "reserve_date"
MONTH = "month"
#: Buckets of the keys, and segments of them at most.
KEY_BUCKETS = 16
KEY_SEGMENTS = 8
#: A compacted date has no more files than its bytes need at this size.
FILE_BYTES = 128 << 20

# What the KPI needs of a row.
_KPI_VALUES = ["store_name", "channel", "status", "headcount"]
_KPI_SUMS = ["reservation_count", "total_headcount", "headcounts", "confirmed_count", "cancelled_count", "completed_count"]


def _ddl_columns(exclude: str) -> str:
    out = []
    for f in RESERVATION_SCHEMA.fields:
        if f.name == exclude:
            continue
        out.append(f"{f.name} {f.dataType.simpleString().upper()}")
    return ", ".join(out)


def create_tables(spark: SparkSession, database: str, root: str, key_buckets: int = KEY_BUCKETS) -> None:
    """L6 + L5: database and tables if absent, re-attaching existing data.

    NOT NULL is not enforced by parquet writes; the REQUIRED columns are
    enforced by validation before any append (V1).
    """
    configure(spark)
    root = root.rstrip("/")
    # An explicit location keeps the database folder next to its tables,
    # never in the process's working directory.
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}/_database'")
    keys = ", ".join(f"{k} STRING" for k in MERGE_KEYS)

    def table(name, columns, rest=""):
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet {rest} LOCATION '{root}/{name}'")

    table(STAGE, f"{_ddl_columns('')}, {STAGE_PARTITION} DATE", f"PARTITIONED BY ({STAGE_PARTITION})")
    table(STAGE_RUNS, f"run_id STRING, {STAGE_PARTITION} DATE")
    table(LOAD_STATS, "run_id STRING, store_id STRING, source STRING, output_rows BIGINT, input_files BIGINT, input_bytes BIGINT")
    table(PRODUCTION, f"{_ddl_columns(DAY)}, {DAY} DATE", f"PARTITIONED BY ({DAY})")
    table(KEYS, f"{keys}, record_hash STRING, {DAY} DATE, store_name STRING, channel STRING, status STRING, headcount BIGINT, seq BIGINT",
          f"PARTITIONED BY (seq) CLUSTERED BY ({', '.join(MERGE_KEYS)}) SORTED BY (record_key) INTO {key_buckets} BUCKETS")
    sums = ", ".join(f"{c} BIGINT" for c in _KPI_SUMS)
    table(KPI_CHANGES, f"store_id STRING, store_name STRING, channel STRING, status STRING, {sums}, {DAY} DATE, seq BIGINT", "PARTITIONED BY (seq)")
    for t, column in ((STAGE, STAGE_PARTITION), (PRODUCTION, DAY)):
        V.create_log(spark, f"{database}.{t}", root)
        V.recover(spark, f"{database}.{t}", column)
    for t in (STAGE, KEYS, KPI_CHANGES):
        _attach(spark, f"{database}.{t}")


def _attach(spark: SparkSession, table: str) -> None:
    """Attach partitions already written under a table's location."""
    try:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    except Exception as e:  # a new, still empty location has nothing to recover
        if "does not exist" not in str(e):
            raise


def _insert(df: DataFrame, table: str, overwrite: bool = False) -> None:
    """Insert by name: reorder to the table's column order (insertInto is positional)."""
    cols = df.sparkSession.table(table).columns
    df.select(cols).write.insertInto(table, overwrite=overwrite)


def append_stage(spark: SparkSession, database: str, valid: DataFrame, source: str = "rows", files: DataFrame | None = None) -> dict:
    """L1 + U1 + A6: append a load (by name, fixed types), clustered within
    files; rows are observed during the write itself, by run and store.

    The run's dates are entered in the registry, so that reading it back
    reads no others, and a row for each run and store in ``load_stats``:
    rows, and files and bytes of its input from ``files`` (run_id, store_id,
    input_files, input_bytes; a listing)."""
    rows = conform(valid).withColumn(STAGE_PARTITION, F.to_date("ingestion_ts"))
    loads = materialize(rows.groupBy("run_id", "store_id", STAGE_PARTITION).agg(F.count(F.lit(1)).alias("output_rows")), "stage-loads")
    if loads.isEmpty():
        return {"output_rows": 0}
    # before the rows: a date that is entered in vain does no harm, a missing one would hide rows
    _insert(loads.select("run_id", STAGE_PARTITION).distinct().coalesce(1), f"{database}.{STAGE_RUNS}")
    obs = Observation("stage_load")
    rows = rows.observe(obs, F.count(F.lit(1)).alias("output_rows"))
    # Near rows go to one file (AQE splits a store with a large share of them).
    rows = rows.hint("rebalance", STAGE_PARTITION, "store_id")
    rows = rows.sortWithinPartitions(STAGE_PARTITION, "store_id", "vendor", "run_id")
    _insert(rows, f"{database}.{STAGE}")
    none = F.lit(None).cast("bigint")
    counts = loads.groupBy("run_id", "store_id").agg(F.sum("output_rows").alias("output_rows"))
    counts = counts.join(files, ["run_id", "store_id"], "left") if files is not None else counts.withColumns({"input_files": none, "input_bytes": none})
    _insert(counts.withColumn("source", F.lit(source)).coalesce(1), f"{database}.{LOAD_STATS}")
    return {"output_rows": obs.get["output_rows"]}


def load_files_to_stage(spark: SparkSession, database: str, path: str, read, run_id: str | None = None) -> dict:
    """L1 + A6 for a file load: rows appended plus input files and bytes
    (from a listing; file contents are read once, by the load itself). With
    ``run_id`` they are entered for each of the run's stores: all of the
    load's files, as a store's rows may come from any of them."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    files = listing.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("b")).first()
    rows = read(spark, path)
    own = None
    if run_id is not None:
        own = rows.select(F.lit(run_id).alias("run_id"), "store_id").distinct().withColumns({"input_files": F.lit(files["n"]), "input_bytes": F.lit(files["b"])})
    stats = append_stage(spark, database, rows, "manual", own)
    return {"output_rows": stats["output_rows"], "input_files": files["n"], "input_file_bytes": files["b"]}


def read_stage(spark: SparkSession, database: str) -> DataFrame:
    return spark.table(f"{database}.{STAGE}").select(*RESERVATION_COLUMNS, STAGE_PARTITION)


def read_run(spark: SparkSession, database: str, run_id: str) -> DataFrame:
    """Stage rows of the dates that hold the run, by the registry; other partitions aren't read."""
    days = spark.table(f"{database}.{STAGE_RUNS}").filter(F.col("run_id") == run_id).select(STAGE_PARTITION).distinct().collect()
    known = [r[0] for r in days if r[0] is not None]
    here = F.col(STAGE_PARTITION).isin(known) if known else F.lit(False)
    if len(known) < len(days):  # rows without a timestamp
        here = here | F.col(STAGE_PARTITION).isNull()
    return read_stage(spark, database).filter(here & (F.col("run_id") == run_id))


def run_source(spark: SparkSession, database: str, run_id: str) -> DataFrame:
    """W1 over the run's partitions."""
    return stage_dedup(read_run(spark, database, run_id), run_id)


def read_production(spark: SparkSession, database: str) -> DataFrame:
    return spark.table(f"{database}.{PRODUCTION}").select(RESERVATION_COLUMNS)


def read_keys(spark: SparkSession, database: str) -> DataFrame:
    """The live key segments of committed merges (a key may stand in several: the last counts)."""
    last, first = V.last_commit(spark, f"{database}.{PRODUCTION}")
    return spark.table(f"{database}.{KEYS}").filter((F.col("seq") >= F.lit(first)) & (F.col("seq") <= F.lit(last)))


def classify_run(spark: SparkSession, database: str, source: DataFrame) -> DataFrame:
    """M1 on the stored keys: source rows with ``action`` and ``_old`` (the
    matched row's date and KPI values). The key side keeps its buckets: cut to
    the run's keys, its last segment picked and joined without an exchange."""
    values = ["seq", "record_hash", DAY, *_KPI_VALUES]
    own = read_keys(spark, database).join(source.select(*MERGE_KEYS), MERGE_KEYS, "left_semi")
    latest = own.groupBy(*MERGE_KEYS).agg(F.max_by(F.struct(*values), "seq").alias("_old"))
    j = source.join(latest, MERGE_KEYS, "left")
    action = (
        F.when(F.col("_old").isNull(), F.lit(INSERT))
        .when(F.col("_old.record_hash") != F.col("record_hash"), F.lit(UPDATE))
        .otherwise(F.lit(UNCHANGED))
    )
    return j.withColumn("action", action)


def apply_merge(spark: SparkSession, database: str, source: DataFrame) -> dict:
    """M2: merge a deduplicated run into production; returns the A3 counts."""
    configure(spark)
    table = f"{database}.{PRODUCTION}"
    t0 = time.perf_counter()

    def phase(name):
        log.info("merge %s: %s done at %.2fs", table, name, time.perf_counter() - t0)

    V.recover(spark, table, DAY)
    last, first_segment = V.last_commit(spark, table)
    for t in (KEYS, KPI_CHANGES):  # of a run that died before its commit
        _drop_segments(spark, f"{database}.{t}", lambda n: n > last)
    source = materialize(source, "merge-source")  # read twice
    classified = materialize(classify_run(spark, database, source), "merge-classified")
    phase("classify")
    stats = classified.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("action") == INSERT).alias("ins"),
        F.count_if(F.col("action") == UPDATE).alias("upd"),
    ).first()
    result = {
        "inserted_rows": stats["ins"],
        "updated_rows": stats["upd"],
        "unchanged_rows": stats["n"] - stats["ins"] - stats["upd"],
    }
    if result["inserted_rows"] + result["updated_rows"] == 0:
        return result

    changes = classified.filter(F.col("action") != UNCHANGED)
    updates = changes.filter(F.col("action") == UPDATE)
    days = changes.select(DAY).unionByName(updates.select(F.col(f"_old.{DAY}").alias(DAY))).distinct()
    touched = sorted(r[0] for r in days.collect())  # partitions, which the catalog holds in the driver anyway

    # The one write: the touched dates' new content, to a folder nobody reads yet.
    version, folder = V.fresh_folder(spark, table)
    kept = read_production(spark, database).filter(F.col(DAY).isin(touched))
    kept = kept.join(updates.select(MERGE_KEYS), MERGE_KEYS, "left_anti").select(RESERVATION_COLUMNS)
    written = V.write_days(kept.unionByName(changes.select(RESERVATION_COLUMNS)), folder, DAY, ["store_id", "channel"])
    phase("dates written")
    seq = last + 1
    live_from = _write_keys(spark, database, changes, seq, first_segment)
    _insert(_signed(changes).withColumn("seq", F.lit(seq).cast("bigint")).coalesce(8), f"{database}.{KPI_CHANGES}", overwrite=True)
    phase("keys and KPI changes written")
    V.commit(spark, table, DAY, version, folder, touched, written, live_from)
    V.switch(spark, table, DAY, seq)
    if live_from > first_segment:
        _drop_segments(spark, f"{database}.{KEYS}", lambda n: n < live_from)
    phase("switched")
    return result


def _write_keys(spark: SparkSession, database: str, changes: DataFrame, seq: int, first: int) -> int:
    """The merge's segment of the keys; the first live segment from now on."""
    columns = [*MERGE_KEYS, "record_hash", DAY, *_KPI_VALUES]
    new = changes.select(*columns)
    if seq - first >= KEY_SEGMENTS:  # all keys anew, in one segment
        values = [c for c in columns if c not in MERGE_KEYS]
        both = read_keys(spark, database).select(*columns, "seq").unionByName(new.withColumn("seq", F.lit(seq).cast("bigint")))
        new = both.groupBy(*MERGE_KEYS).agg(F.max_by(F.struct(*values), "seq").alias("v")).select(*MERGE_KEYS, "v.*")
        first = seq
    buckets = int(spark.sql(f"DESCRIBE TABLE EXTENDED {database}.{KEYS}").filter("col_name = 'Num Buckets'").first()["data_type"])
    # dealt by the buckets' own hash: one file a bucket. A number that a dead run left is overwritten.
    _insert(new.repartition(buckets, *MERGE_KEYS).withColumn("seq", F.lit(seq).cast("bigint")), f"{database}.{KEYS}", overwrite=True)
    return first


def _sums(sign: Column | int = 1) -> list[Column]:
    """The KPI's sums over rows, each counted ``sign`` times."""
    n = F.lit(sign) if isinstance(sign, int) else sign
    one = {
        "reservation_count": n,
        "total_headcount": F.coalesce("headcount", F.lit(0)) * n,
        "headcounts": F.when(F.col("headcount").isNotNull(), n).otherwise(0),
        **{f"{s}_count": F.when(F.col("status") == s, n).otherwise(0) for s in ("confirmed", "cancelled", "completed")},
    }
    return [F.coalesce(F.sum(one[c]), F.lit(0)).cast("bigint").alias(c) for c in _KPI_SUMS]


def _signed(changes: DataFrame) -> DataFrame:
    """What a merge changes in each KPI group: new rows count once, the old ones of updates minus once."""
    columns = ["store_id", DAY, *_KPI_VALUES]
    new = changes.select(*columns, F.lit(1).alias("_n"))
    old = changes.filter(F.col("action") == UPDATE).select("store_id", *(F.col(f"_old.{c}").alias(c) for c in columns[1:]), F.lit(-1).alias("_n"))
    return new.unionByName(old).groupBy(*KPI_KEYS).agg(*_sums(F.col("_n")))


def create_kpi_table(spark: SparkSession, database: str, root: str) -> None:
    """The KPI view (L9) kept as a table; ``headcounts`` is the number behind the mean. A date has few KPI rows, so a
    partition holds a month (its first day): a file for each date would cost more than its rows."""
    root = root.rstrip("/")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {database}.{KPI} (store_id STRING, store_name STRING, channel STRING, "
        "status STRING, reservation_count BIGINT, total_headcount BIGINT, avg_party_size DOUBLE, "
        "confirmed_count BIGINT, cancelled_count BIGINT, completed_count BIGINT, headcounts BIGINT, reserve_date DATE, month DATE) "
        f"USING parquet PARTITIONED BY (month) LOCATION '{root}/{KPI}'"
    )
    V.create_log(spark, f"{database}.{KPI}", root)
    V.recover(spark, f"{database}.{KPI}", MONTH)


def refresh_kpi(spark: SparkSession, database: str, everything: bool = False) -> int:
    """Add the changes of the merges since the last refresh to the stored sums
    of their months and switch those partitions; the daily cost follows the
    change and production isn't read. With ``everything`` all is worked out
    from production. Returns the number of partitions written."""
    table, production = f"{database}.{KPI}", f"{database}.{PRODUCTION}"
    V.recover(spark, production, DAY)
    V.recover(spark, table, MONTH)
    done, last = V.last_commit(spark, table)[1], V.last_commit(spark, production)[0]
    month = F.trunc(DAY, "month").alias(MONTH)
    changes = spark.table(f"{database}.{KPI_CHANGES}").filter((F.col("seq") > F.lit(done)) & (F.col("seq") <= F.lit(last)))
    stored = spark.table(table)
    if everything:
        prod = read_production(spark, database)
        sums = prod.groupBy(*KPI_KEYS).agg(*_sums())
        months = prod.select(month).unionByName(stored.select(MONTH)).distinct()
    else:
        months = changes.select(month).distinct()
    touched = sorted(r[0] for r in months.collect())
    if not touched:
        return 0
    if not everything:
        there = stored.filter(F.col(MONTH).isin(touched)).select(*KPI_KEYS, F.coalesce("total_headcount", F.lit(0)).alias("total_headcount"),
                                                                 *(c for c in _KPI_SUMS if c != "total_headcount"))
        both = there.unionByName(changes.select(*KPI_KEYS, *_KPI_SUMS))
        sums = both.groupBy(*KPI_KEYS).agg(*(F.sum(c).alias(c) for c in _KPI_SUMS))
    some = F.col("headcounts") > 0
    kpi = sums.filter("reservation_count > 0").withColumns({
        "avg_party_size": F.when(some, F.col("total_headcount").cast("double") / F.col("headcounts")),
        "total_headcount": F.when(some, F.col("total_headcount")),
    })
    version, folder = V.fresh_folder(spark, table)
    columns = [c for c in stored.columns if c != MONTH]
    written = V.write_days(kpi.select(*columns, month), folder, MONTH, [DAY, "store_id"])
    seq = V.commit(spark, table, MONTH, version, folder, touched, written, last)
    V.switch(spark, table, MONTH, seq)
    _drop_segments(spark, f"{database}.{KPI_CHANGES}", lambda n: n <= last)
    return len(touched)


def _drop_segments(spark: SparkSession, table: str, gone) -> None:
    """Drop the partitions whose ``seq`` is ``gone`` with one statement, and their files."""
    old = [n for n in (int(r[0].split("=", 1)[1]) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()) if gone(n)]
    if old:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(f'PARTITION (seq = {n})' for n in old)}")
        delete_folders(spark, [f"{V.table_location(spark, table)}/seq={n}" for n in old])
        spark.catalog.refreshTable(table)


def expire_stage(spark: SparkSession, database: str, as_of, days: int = STAGE_RETENTION_DAYS) -> list:
    """Delete stage partitions with ``DATE(ingestion_ts) < as_of - days``
    (strict). Works on the partition listing only; no data is scanned. One
    statement takes all of them out of the catalog, then their files go."""
    table = f"{database}.{STAGE}"
    V.recover(spark, table, STAGE_PARTITION)
    cutoff = spark.range(1).select(retention_cutoff(as_of, days).alias("c")).first()["c"]
    parts = [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    known = [_dt.date.fromisoformat(p) for p in parts if not p.startswith("__")]  # rows without a timestamp stay
    expired = sorted(d for d in known if d < cutoff)
    if not expired:
        return []
    moved = V.history(spark, table).filter("replaced_by is null and location is not null").filter(F.col("day").isin(expired)).collect()
    if moved:  # compacted dates: the log must forget them, too
        V.switch(spark, table, STAGE_PARTITION, V.commit(spark, table, STAGE_PARTITION, "expired", "", [r["day"] for r in moved], set()))
    V.drop_days(spark, table, STAGE_PARTITION, expired)
    base = V.table_location(spark, table)
    delete_folders(spark, [*(f"{base}/{STAGE_PARTITION}={d.isoformat()}" for d in expired), *(r["location"] for r in moved)])
    spark.catalog.refreshTable(table)
    return expired


def partition_files(spark: SparkSession, table: str, column: str) -> DataFrame:
    """Files, bytes and rows of each partition, from the files' metadata; no column is read."""
    files = spark.table(table).groupBy(column, "_metadata.file_path", "_metadata.file_size").agg(F.count(F.lit(1)).alias("n"))
    return files.groupBy(column).agg(F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes"), F.sum("n").alias("num_rows"))


def compact(spark: SparkSession, database: str, name: str = STAGE, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Rewrite together the small files of every partition that has more
    files than its bytes need; all those partitions in one write and one switch.

    Returns (day, files_before, files_after, num_rows) of the rewritten ones.
    Clustering inside the files stays that of the table."""
    configure(spark)
    column, sort = (STAGE_PARTITION, ["store_id", "vendor", "run_id"]) if name == STAGE else (DAY, ["store_id", "channel"])
    table = f"{database}.{name}"
    V.recover(spark, table, column)
    before = materialize(partition_files(spark, table, column).filter(F.col(column).isNotNull()), "compact")
    many = materialize(before.withColumn("needed", F.ceil(F.col("bytes") / F.lit(file_bytes))).filter("files > needed"), "compact")
    todo = {r[column]: r["needed"] for r in many.select(column, "needed").collect()}
    if todo:
        _, mark = V.last_commit(spark, table)
        if name == PRODUCTION:
            for t in (KEYS, KPI_CHANGES):  # a dead merge's number is taken now
                _drop_segments(spark, f"{database}.{t}", lambda n: n > V.last_commit(spark, table)[0])
        moved = {r["day"] for r in V.history(spark, table).filter("replaced_by is null and location is not null").select("day").collect()}
        version, folder = V.fresh_folder(spark, table)
        rows = spark.table(table).filter(F.col(column).isin(list(todo))).join(F.broadcast(many.select(column, "needed")), column)
        # a partition's rows go to as many tasks as it needs files; a row a partition is broadcast
        rows = rows.withColumn("_part", F.pmod(F.xxhash64("store_id", "record_key"), "needed")).drop("needed")
        (rows.repartition(int(sum(todo.values())), column, "_part").sortWithinPartitions(column, *sort).drop("_part")
         .write.mode("overwrite").partitionBy(column).parquet(folder))
        V.switch(spark, table, column, V.commit(spark, table, column, version, folder, sorted(todo), set(todo), mark))
        base = V.table_location(spark, table)
        delete_folders(spark, [f"{base}/{column}={d.isoformat()}" for d in todo if d not in moved])
    after = partition_files(spark, table, column).filter(F.col(column).isin(list(todo)) if todo else F.lit(False))
    out = before.select(column, F.col("files").alias("files_before")).join(after.select(column, F.col("files").alias("files_after"), "num_rows"), column)
    return materialize(out.withColumnRenamed(column, "day"), "compact")
