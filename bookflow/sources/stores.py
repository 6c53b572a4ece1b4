"""Store master scan (sheet export as CSV, parquet or a DataFrame)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookflow.schema import STORE_COLUMNS


def normalize_store_master(df: DataFrame) -> DataFrame:
    """Header names trimmed and lower-cased, every cell a string with '' for
    missing, fully blank rows skipped; the 9 known columns in fixed order."""
    renamed = df.toDF(*[c.strip().lower() for c in df.columns])
    cols = []
    for c in STORE_COLUMNS:
        if c in renamed.columns:
            cols.append(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c))
        else:
            cols.append(F.lit("").alias(c))
    out = renamed.select(cols)
    any_cell = F.greatest(*[F.length(F.col(c)) for c in STORE_COLUMNS]) > 0
    return out.filter(any_cell)


def read_store_master(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Read a store sheet export; CSV is read as strings, never inferred."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", False)
    return normalize_store_master(reader.load(path))
