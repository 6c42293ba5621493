"""Catalog tables: projected reads, create-table-as, column writes."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foretell.functions.scalar import parse_iso_date
from foretell.operators.joins import update_column
from foretell.operators.ordinal import sequential_id

DATE_COLUMN = "introduced_date"  # text in this column is stored as a date


def qualified(schema: str, table: str) -> str:
    return f"`{schema}`.`{table}`"


def read_columns(spark: SparkSession, columns: Sequence[str], schema: str, table: str) -> DataFrame:
    """The named columns of a table; a columnar scan reads nothing else."""
    return spark.table(qualified(schema, table)).select(*columns)


def run_sql(spark: SparkSession, query: str) -> DataFrame:
    """The query's rows; no rows still have their columns."""
    return spark.sql(query.strip().removesuffix(";"))


def create_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`{place}")


def drop_table(spark: SparkSession, schema: str, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {qualified(schema, table)}")


def table_from_query(
    spark: SparkSession, query: DataFrame | str, schema: str, table: str,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Replace the table with the query's rows and return the new table."""
    df = run_sql(spark, query) if isinstance(query, str) else query
    create_schema(spark, schema)
    drop_table(spark, schema, table)
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(qualified(schema, table))
    return spark.table(qualified(schema, table))


def storage_types(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint, fractions as double, texts as string, the date column as date."""

    def stored(field: T.StructField):
        c = F.col(field.name)
        if field.name == DATE_COLUMN:
            return (parse_iso_date(c) if isinstance(field.dataType, T.StringType) else c.cast("date"))
        if isinstance(field.dataType, T.IntegralType):
            return c.cast("bigint")
        if isinstance(field.dataType, (T.FractionalType, T.DecimalType)):
            return c.cast("double")
        return c

    return df.select(*[stored(f).alias(f.name) for f in df.schema.fields])


def write_table(
    df: DataFrame, schema: str, table: str, id_order: Sequence[str] | None = None
) -> DataFrame:
    """Replace a table with ``df`` in storage types.

    With ``id_order`` (a unique sort key) rows get a leading sequential ``id`` from 0.
    """
    typed = storage_types(df)
    if id_order:
        typed = sequential_id(typed, id_order, "id")
    return table_from_query(df.sparkSession, typed, schema, table)


def write_column(
    spark: SparkSession, values: DataFrame, key: str, column: str, schema: str, table: str
) -> DataFrame:
    """Add ``column`` from ``values`` (key, column) to a table; unmatched ids stay null.

    A missing or empty table is created from the ids. An existing column is an error. The
    new table is written beside the old one and takes its name when complete.
    """
    name = qualified(schema, table)
    create_schema(spark, schema)
    base = spark.table(name) if spark.catalog.tableExists(name) else None
    if base is not None and column in base.columns:
        raise ValueError(f"column {column} exists in {schema}.{table}")
    if base is None or base.isEmpty():
        base = values.select(F.col(key).alias("id"))
    fresh = base.withColumn(column, F.lit(None).cast(values.schema[column].dataType))
    changes = values.select(F.col(key).alias("id"), F.col(column).alias("__value"))
    written = update_column(fresh, changes, "id", column, "__value")
    staged = f"{table}_{uuid.uuid4().hex[:8]}"
    table_from_query(spark, written, schema, staged)
    drop_table(spark, schema, table)
    spark.sql(f"ALTER TABLE {qualified(schema, staged)} RENAME TO {name}")
    return spark.table(name)
