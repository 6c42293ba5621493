"""Every operator as a runnable query on the shared tables, with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foretell.plans.standins import Relations

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_MODULES = ("catalog_relational", "catalog_functions", "catalog_features", "catalog_models")


def query(name: str, sql: str | None = None):
    """Register a function of the relations under ``name``, with its SQL text if any."""

    def add(build: Callable[[Relations], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def runner(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Relations(spark, sf_dir))

        runner.__name__, runner.__doc__ = name, getattr(build, "func", build).__doc__
        QUERIES[name] = runner
        if sql is not None:
            ORACLES[name] = sql
        return build

    return add


def load() -> tuple[dict[str, Query], dict[str, str]]:
    for module in _MODULES:
        import_module(f"foretell.plans.{module}")
    return QUERIES, ORACLES


def r6(value: Column | str) -> Column:
    """Doubles rounded for comparison across engines."""
    value = F.col(value) if isinstance(value, str) else value
    return F.round(value.cast("double"), 6)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[r6(c).alias(c) if c in names else F.col(c) for c in df.columns])
