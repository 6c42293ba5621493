"""Column-level feature operations, independent of any fitted state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foretell.functions.scalar import col, days_between, ratio
from foretell.operators.ordinal import global_ordinal

NORMALIZE_THRESHOLD = 10
DEFAULT_BUCKETS = 2**20

# fixed values: class codes of the label types
LABEL_CODES = {
    "binary": {"Passed": 1, "other": 0},
    "binary_01": {"Passed": 1, "other": 0},
    "ternary": {"Passed": 1, "Failed": 0, "other": 2},
}


def impute(value: Column | str, fill) -> Column:
    return F.coalesce(col(value), F.lit(fill))


def mark_blanks(value: Column | str) -> tuple[Column, Column]:
    """The text with ``Unknown`` for missing, and the missing flag."""
    value = col(value)
    return F.coalesce(value.cast("string"), F.lit("Unknown")), value.isNull()


def normalize(value: Column | str, low, high, threshold: float = NORMALIZE_THRESHOLD) -> Column:
    """Min-max scaling, only where the fitted range leaves ``[-threshold, threshold]``."""
    value = col(value).cast("double")
    if low is None or not (low < -threshold or high > threshold):
        return value
    return ratio(value - F.lit(float(low)), F.lit(float(high) - float(low)))


def one_hot(value: Column | str, categories: Sequence) -> list[Column]:
    """One 0/1 column per category; an unknown or missing value is all zeros."""
    return [F.coalesce((col(value) == F.lit(c)).cast("double"), F.lit(0.0)) for c in categories]


def hash_bucket(value: Column | str, n_features: int = DEFAULT_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(col(value).cast("string")), F.lit(n_features)).cast("int")


def hash_sign(value: Column | str) -> Column:
    """+1 or -1 from a hash bit that buckets below 2^40 do not use."""
    bit = F.shiftrightunsigned(F.xxhash64(col(value).cast("string")), 62).bitwiseAND(F.lit(1))
    return F.when(bit == 0, 1.0).otherwise(-1.0)


def since_session_start(intro: Column | str, start: Column | str) -> Column:
    return days_between(intro, start)


def till_session_end(intro: Column | str, end: Column | str) -> Column:
    return days_between(end, intro)


def label(status: Column | str, label_type: str = "binary") -> Column:
    if label_type not in LABEL_CODES:
        raise ValueError(f"label type {label_type!r}, choose from {sorted(LABEL_CODES)}")
    codes = LABEL_CODES[label_type]
    known = F.when(col(status) == "Passed", codes["Passed"])
    if "Failed" in codes:
        known = known.when(col(status) == "Failed", codes["Failed"])
    return known.otherwise(codes["other"]).cast("double")


def label_one_hot(status: Column | str, label_type: str = "binary") -> Column:
    """Array of 0/1, one per class."""
    classes = sorted(set(LABEL_CODES[label_type].values()))
    code = label(status, label_type)
    return F.array(*[(code == c).cast("double") for c in classes])


def one_hot_long(df: DataFrame, id_column: str, column: str) -> DataFrame:
    """``(id, category, idx)`` with alphabetical category numbers, for any number of categories.

    The categories are numbered as a distributed table instead of one column each.
    """
    rows = df.select(id_column, F.col(column).alias("category")).where("category is not null")
    numbered = global_ordinal(rows.select("category").distinct(), ["category"], "idx")
    return rows.join(numbered.withColumn("idx", F.col("idx") - 1), "category").select(
        id_column, "category", "idx"
    )
