"""Built-once artifacts: vocabularies and group memberships as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException

VOCABULARY = "column string, term string, idx long"


def save_vocabulary(vocabulary: DataFrame, path: str) -> None:
    vocabulary.write.mode("overwrite").partitionBy("column").parquet(path)


def load_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(VOCABULARY).parquet(path)


def vocabulary_at(spark: SparkSession, path: str, build) -> DataFrame:
    """The stored vocabulary, built and stored first where there is none."""
    try:
        spark.read.parquet(path).schema
    except AnalysisException:
        save_vocabulary(build(), path)
    return load_vocabulary(spark, path)


def save_groups(members: DataFrame, path: str) -> None:
    """One folder per group, so a group is read without touching the others."""
    members.select("group", "bill_id").write.mode("overwrite").partitionBy("group").parquet(path)


def load_groups(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("bill_id long, group string").parquet(path)
