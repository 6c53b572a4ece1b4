"""The corpus pipeline: documents in a known language, without near-duplicates, repeated passages and benchmark
passages, packed into sequences.

Every stage is one operator over all that the stage before it kept; all but the last return the columns of documents.
Shortened texts have their n_chars counted anew; a text that lost everything stays as an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookflow.llm import decontaminate as D
from bookflow.llm import language_id as L
from bookflow.llm import packing as K
from bookflow.llm import simhash_dedup as S
from bookflow.llm import suffix_dedup as X
from bookflow.session import materialize

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no letters at all) go."""
    rest = F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in docs.columns if c != "text"))
    kept = L.predict(docs.select(rest.alias("doc"), "text"), L.train(docs)).filter(F.col("lang_pred") != L.UNKNOWN)
    return kept.select(*((F.col("text") if c == "text" else F.col("doc")[c]).alias(c) for c in docs.columns))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return S.one_of_each(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes and more that stand anywhere else go."""
    return _counted(X.without_repeats(docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words inside a benchmark phrase go."""
    return _counted(D.remove_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document, with its sequence and place."""
    return K.pack_documents(docs, TOKENIZER, with_ids=False)


STAGES = [("language_id", language_id), ("simhash_dedup", simhash_dedup), ("suffix_dedup", suffix_dedup),
          ("decontaminate", decontaminate), ("pack", pack)]

#: No SQL can express the trained and the tokenizing stages; tests compare them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
