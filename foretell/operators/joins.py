"""Joins with stated semantics that plain ``join`` leaves to the caller."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_wins_lookup(
    left: DataFrame, right: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]
) -> DataFrame:
    """Inner join to the last row per key of ``right`` in ``order``; misses are dropped."""
    latest = right.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(value))
    return left.join(latest, list(keys))


def members_only(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")


def non_members(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key), key, "left_anti")


def update_column(
    base: DataFrame, changes: DataFrame, key: str, column: str, new_value: str
) -> DataFrame:
    """``column`` takes ``new_value`` where the key matches and stays as it is elsewhere."""
    new = changes.select(key, F.col(new_value).alias("__new"), F.lit(True).alias("__hit"))
    changed = F.when(F.col("__hit"), F.col("__new")).otherwise(F.col(column))
    joined = base.join(new, key, "left")
    return joined.select(*[changed.alias(column) if c == column else F.col(c) for c in base.columns])


def lookup_or(
    df: DataFrame, table: DataFrame, key: str, value: str, fallback: Column, name: str
) -> DataFrame:
    """``value`` by key, or the fallback expression for unseen keys."""
    found = table.select(key, F.col(value).alias("__v"))
    return df.join(found, key, "left").select(
        *df.columns, F.coalesce("__v", fallback).alias(name)
    )


def in_range(
    df: DataFrame, calendar: DataFrame, date_column: str
) -> DataFrame:
    """Rows joined to the calendar days that ranges cover, an equi-join on the day.

    ``calendar`` has one row per covered day and range (column ``day``).
    """
    return df.join(calendar, F.col(date_column).cast("date") == F.col("day")).drop("day")
