"""Partitions in versioned folders: written once, committed by one row a day, then switched in the catalog.

A change of a day-partitioned table writes the new content of the days it touches to a fresh folder,
``<root>/<table>_versions/version=<id>/<column>=<day>``. Nothing that readers see changes by that. The commit appends
one small file to ``<table>_commits`` (seq, version, day, location; a NULL location means the day has no rows any
more). After it one DROP and one ADD statement point the catalog's partitions to the new folders, and the commit's
number is entered in ``<table>_switched``.

A run that dies before its commit leaves a folder nobody points to; one that dies after it is carried on by
``recover``, which every change starts with. Folders that a change replaced stay until the next but one change, so
that queries that began before the switch can finish. A table has one writer at a time.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bookflow.storage import delete_folders, folders

_COMMIT = "seq BIGINT, version STRING, day DATE, location STRING, mark BIGINT"


def table_location(spark: SparkSession, table: str) -> str:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first()["data_type"]


def _versions_root(spark: SparkSession, table: str) -> str:
    return table_location(spark, table) + "_versions"


def create_log(spark: SparkSession, table: str, root: str) -> None:
    name = table.split(".")[-1]
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table}_commits ({_COMMIT}) USING parquet LOCATION '{root}/{name}_commits'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table}_switched (seq BIGINT) USING parquet LOCATION '{root}/{name}_switched'")


def last_commit(spark: SparkSession, table: str) -> tuple[int, int]:
    """The last commit's number and mark; (0, 0) before the first."""
    r = spark.table(f"{table}_commits").agg(F.max(F.struct("seq", "mark")).alias("m")).first()["m"]
    return (r["seq"], r["mark"] or 0) if r else (0, 0)


def history(spark: SparkSession, table: str) -> DataFrame:
    """All commits' days with ``replaced_by``, the next commit of the day (a row a touched day and change)."""
    after = F.lead("seq").over(W.partitionBy("day").orderBy("seq"))
    return spark.table(f"{table}_commits").withColumn("replaced_by", after)


def fresh_folder(spark: SparkSession, table: str) -> tuple[str, str]:
    version = uuid.uuid4().hex
    return version, f"{_versions_root(spark, table)}/version={version}"


def write_days(df: DataFrame, folder: str, column: str, sort: list[str]) -> set[dt.date]:
    """Write the new content of the touched days, once; the days that have rows."""
    (df.hint("rebalance", column).sortWithinPartitions(column, *sort)
     .write.mode("overwrite").partitionBy(column).parquet(folder))
    return {dt.date.fromisoformat(f.split("=", 1)[1]) for f in folders(df.sparkSession, folder) if f.startswith(f"{column}=")}


def commit(spark: SparkSession, table: str, column: str, version: str, folder: str, touched: list[dt.date], written: set[dt.date], mark: int = 0) -> int:
    """Make the change the table's state: one file, so all of it or none. Returns its number."""
    seq = last_commit(spark, table)[0] + 1
    rows = [(seq, version, d, f"{folder}/{column}={d.isoformat()}" if d in written else None, mark) for d in touched]
    rows = rows or [(seq, version, None, None, mark)]
    spark.createDataFrame(rows, _COMMIT).coalesce(1).write.insertInto(f"{table}_commits")
    return seq


def _spec(column: str, days) -> list[str]:
    return [f"PARTITION ({column} = DATE'{d.isoformat()}')" for d in sorted(days)]


def drop_days(spark: SparkSession, table: str, column: str, days) -> None:
    """Take days out of the catalog with one statement; their files stay."""
    if days:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(_spec(column, days))}")


def _add_days(spark: SparkSession, table: str, column: str, locations: dict[dt.date, str]) -> None:
    if locations:
        parts = " ".join(f"PARTITION ({column} = DATE'{d.isoformat()}') LOCATION '{p}'" for d, p in sorted(locations.items()))
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")


def switch(spark: SparkSession, table: str, column: str, seq: int) -> None:
    """Point the catalog to commit ``seq``; doing so again changes nothing."""
    rows = spark.table(f"{table}_commits").filter((F.col("seq") == seq) & F.col("day").isNotNull()).select("day", "location").collect()
    drop_days(spark, table, column, [r["day"] for r in rows])
    _add_days(spark, table, column, {r["day"]: r["location"] for r in rows if r["location"]})
    spark.createDataFrame([(seq,)], "seq BIGINT").coalesce(1).write.insertInto(f"{table}_switched")
    spark.catalog.refreshTable(table)
    _vacuum(spark, table, seq)


def _vacuum(spark: SparkSession, table: str, seq: int) -> None:
    """Delete what the change before ``seq`` and earlier ones replaced, and folders that were never committed."""
    root = _versions_root(spark, table)
    old = history(spark, table).filter(F.col("location").isNotNull())
    dead = old.filter(F.col("replaced_by") == seq - 1).select("location")
    delete_folders(spark, [r["location"] for r in dead.collect()])
    needed = {r["version"] for r in old.filter(F.col("replaced_by").isNull() | (F.col("replaced_by") >= seq)).select("version").distinct().collect()}
    delete_folders(spark, [f"{root}/{f}" for f in folders(spark, root) if f.split("=", 1)[-1] not in needed])


def recover(spark: SparkSession, table: str, column: str) -> int:
    """Carry on changes that were committed but not switched, and attach committed days that the catalog lacks (a new
    catalog over existing files). Returns the number of changes carried on."""
    done = spark.table(f"{table}_switched")
    todo = spark.table(f"{table}_commits").select("seq").distinct().join(done, "seq", "left_anti").orderBy("seq").collect()
    for r in todo:
        switch(spark, table, column, r["seq"])
    have = {r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    live = history(spark, table).filter("replaced_by is null and location is not null").select("day", "location").collect()
    missing = {r["day"]: r["location"] for r in live if r["day"].isoformat() not in have}
    _add_days(spark, table, column, missing)
    if missing:
        spark.catalog.refreshTable(table)
    return len(todo)
