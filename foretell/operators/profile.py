"""Data profiling: status distributions, missing values, box plots, correlations."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foretell.operators.ordinal import exact_quantiles

_NAN_TYPES = ("double", "float")


def _is_missing(df: DataFrame, name: str):
    missing = F.col(name).isNull()
    return missing | F.isnan(name) if dict(df.dtypes)[name] in _NAN_TYPES else missing


def status_distributions(details: DataFrame, state_id: int | None = None) -> DataFrame:
    """``(kind, status, n)``: all rows, newest rows, newest rows relabelled.

    ``details`` is the progress history with ``status``, ``count_year`` and ``seq``. The
    relabelling calls a bill AssignFail after two undecided years. Missing statuses are not
    counted.
    """
    rows = details if state_id is None else details.where(F.col("state_id") == state_id)
    stale = (F.col("count_year") >= 2) & ~F.col("status").isin("Passed", "Failed")
    relabelled = F.when(stale, "AssignFail").otherwise(F.col("status"))
    newest = F.col("seq") == 1
    values = {
        "all": F.col("status"),
        "final": F.when(newest, F.col("status")),
        "relabelled": F.when(newest, relabelled),
    }
    kinds = F.array(
        *[F.struct(F.lit(k).alias("kind"), v.alias("status")) for k, v in values.items()]
    )
    tall = rows.select(F.explode(kinds).alias("k")).select("k.*").where("status is not null")
    return tall.groupBy("kind", "status").agg(F.count("*").alias("n"))


def missing_values(df: DataFrame) -> DataFrame:
    """``(column, total, missing)`` from one pass over the rows."""
    counts = df.agg(
        F.count("*").alias("total"),
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.count_if(_is_missing(df, c)).alias("missing"))
                for c in df.columns
            ]
        ).alias("cols"),
    )
    return counts.select("total", F.explode("cols").alias("c")).select(
        "c.column", "total", "c.missing"
    )


def box_plots(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers (furthest value within 1.5 IQR) and outlier count per column."""
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75])

    def at(p: float):
        return F.max(F.when(F.col("p") == p, F.col("value")))

    quartiles = q.groupBy("column").agg(
        at(0.25).alias("q1"), at(0.5).alias("median"), at(0.75).alias("q3")
    )
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns]
    )
    tall = df.select(F.explode(pairs).alias("e")).select("e.*").where("x is not null")
    # one row per column on the small side
    rows = tall.join(F.broadcast(quartiles), "column")
    reach = (F.col("q3") - F.col("q1")) * 1.5
    near = F.col("x").between(F.col("q1") - reach, F.col("q3") + reach)
    return rows.groupBy("column", "q1", "median", "q3").agg(
        F.min(F.when(near, F.col("x"))).alias("low_whisker"),
        F.max(F.when(near, F.col("x"))).alias("high_whisker"),
        F.count_if(~near).alias("outliers"),
    )


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation ``(a, b, corr)`` of every column pair, both present, in one pass."""
    pairs = list(combinations_with_replacement(columns, 2))
    wide = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(a).alias("a"), F.lit(b).alias("b"),
                    F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("corr"),
                )
                for a, b in pairs
            ]
        ).alias("m")
    )
    half = wide.select(F.explode("m").alias("e")).select("e.*")
    mirrored = half.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "corr")
    return half.unionByName(mirrored)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that are repeated or incomplete."""
    incomplete = F.lit(False)
    for k in keys:
        incomplete = incomplete | F.col(k).isNull()
    return df.groupBy(*keys).count().where((F.col("count") > 1) | incomplete)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    bad = duplicate_keys(df, keys).limit(5).collect()
    if bad:
        raise ValueError(f"{tuple(keys)} is not a key, for example {[tuple(r) for r in bad]}")
    return df
