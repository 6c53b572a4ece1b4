"""Test inputs derived from the driver's parquet tables (FIXTURES.md).

The reservation system ships no data, so the store master is derived from
``nation`` and the raw reservation export from ``orders`` joined to
``customer``. Both derivations are plain DataFrame plans over the full
tables: they grow with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookflow.schema import profile as get_profile


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stores_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store master, 9 string columns, '' for missing cells."""
    k = F.col("n_nationkey")
    return read_table(spark, sf_dir, "nation").select(
        F.when(k % 5 == 4, "false").when(k % 5 == 3, "TRUE").otherwise("true").alias("active"),
        F.concat(F.lit("store"), F.lpad(k.cast("string"), 3, "0")).alias("store_id"),
        F.col("n_name").alias("store_name"),
        F.when(k == 7, "").otherwise("user").alias("rb_username"),
        F.when(k == 8, "").otherwise("x").alias("rb_password"),
        F.when(k == 22, "99999999999").when(k % 3 == 0, "").when(k % 3 == 1, "300").otherwise("0").alias("days_back"),
        F.when(k == 16, "1996/01/01").when(k % 4 == 0, "1996-01-01").otherwise("").alias("from_date"),
        F.when(k % 8 == 0, "1998-12-31").otherwise("").alias("to_date"),
        F.lit("").alias("note"),
    )


def reservations_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw reservation lines in internal column names (all strings) plus
    ``store_id`` (one export per store) and ``src_key`` (fixture lineage)."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus"
    )
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    base = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("o_orderkey").alias("k"),
        F.col("o_orderpriority").alias("pr"),
        F.col("o_orderstatus").alias("st"),
        F.col("c_nationkey").alias("nation"),
        F.col("o_orderdate").cast("date").alias("day"),
    )
    # The test tables are single-split files: one task reads and joins them,
    # so everything that is built or parsed comes after the shuffle.
    k, day = F.col("k"), F.col("day")
    base = base.repartition("k").select(
        "k",
        "pr",
        "st",
        F.concat(F.lit("store"), F.lpad(F.col("nation").cast("string"), 3, "0")).alias("store_id"),
        day.cast("string").alias("d"),
        F.date_sub(day, (k % 30).cast("int")).cast("string").alias("b"),
        (F.lit(11) + k % 15).cast("string").alias("h"),
        F.lpad(((k % 4) * 15).cast("string"), 2, "0").alias("m"),
    )
    k, d, b, h, m = (F.col(c) for c in ("k", "d", "b", "h", "m"))
    yyyy, mm, dd = F.substring(d, 1, 4), F.substring(d, 6, 2), F.substring(d, 9, 2)
    return base.select(
        "store_id",
        k.alias("src_key"),
        F.when(k % 7 == 0, "").otherwise(k.cast("string")).alias("reservation_id"),
        F.when(k % 50 == 0, "")
        .when(k % 50 == 1, "not-a-date")
        .when(k % 8 == 1, F.replace(d, F.lit("-"), F.lit("/")))
        .when(k % 8 == 2, F.concat_ws("/", mm, dd, yyyy))
        .when(k % 8 == 3, F.concat_ws("/", dd, mm, yyyy))
        .when(k % 8 == 4, F.concat(yyyy, F.lit("年"), mm, F.lit("月"), dd, F.lit("日")))
        .otherwise(d)
        .alias("reserve_date_raw"),
        F.when(k % 9 == 0, "").otherwise(b).alias("booking_date_raw"),
        F.when(k % 23 == 0, "なし").otherwise(F.concat(h, F.lit(":"), m)).alias("start_time_raw"),
        F.when(k % 19 == 0, "").otherwise(F.concat(h, F.lit(":"), m, F.lit(":30"))).alias("end_time_raw"),
        F.when(k % 6 == 0, "").otherwise(F.concat(F.lit("コース"), (k % 6).cast("string"))).alias("course_name"),
        F.when(k % 11 == 0, "")
        .when(k % 11 == 1, "多数")
        .when(k % 11 == 2, F.concat((k % 10).cast("string"), F.lit("名")))
        .otherwise((k % 10).cast("string"))
        .alias("headcount_raw"),
        F.when(F.col("pr") == "1-URGENT", "ホットペッパー")
        .when(F.col("pr") == "2-HIGH", "食べログ")
        .when(F.col("pr") == "3-MEDIUM", "電話")
        .when(F.col("pr") == "5-LOW", "ぐるなび")
        .otherwise("Walk  In")
        .alias("channel_raw"),
        F.when(k % 13 == 0, "キャンセル")
        .when(k % 17 == 0, "ノーショー")
        .when(k % 29 == 0, "")
        .when(F.col("st") == "F", "来店済み")
        .when(F.col("st") == "O", "確定")
        .otherwise("仮予約")
        .alias("status_raw"),
    )


def reservations_export(spark: SparkSession, sf_dir: str, profile="executed") -> DataFrame:
    """The raw lines under the export's own (Japanese) header names, as a CSV
    scan would deliver them; ``store_id`` and ``src_key`` ride along."""
    inverse = {v: k for k, v in get_profile(profile).column_map.items()}
    raw = reservations_raw(spark, sf_dir)
    return raw.select([F.col(c).alias(inverse.get(c, c)) for c in raw.columns])


# Run parameters (FIXTURES.md §3). "Today" is a parameter; nothing reads a clock.
RUN_A = {"run_id": "rb_19980801_011500", "ingestion_ts": "1998-08-01T01:15:00+09:00"}
RUN_B = {"run_id": "rb_19980802_011500", "ingestion_ts": "1998-08-02T01:15:00+09:00"}
AS_OF = "1998-08-02"
