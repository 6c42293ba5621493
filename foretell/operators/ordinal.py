"""Row positions, running totals and exact quantiles without a single-task window.

A window with no partition key moves every row to one task, and a window keyed by a hot
group moves that group to one task. Here the rows are range-partitioned on the full sort
key (the key must be unique, so ties and hot groups spread out too), sorted in place and
written once; a row's position is then its offset inside its range plus the number of
rows in earlier ranges, a table with one row per range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foretell.session import cut_lineage

#: Rows below which ranges are not worth a task of their own, and above which a task should not have more.
LEAST_RANGE_ROWS, MOST_RANGE_ROWS = 1 << 12, 1 << 24
_ROW_BITS = 33  # monotonically_increasing_id: range number above, row offset below
_MID, _PID, _POS = "__mid", "__pid", "__pos"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def range_count(spark: SparkSession, rows: int) -> int:
    """Ranges for so many rows: as many as the session shuffles into, unless these would be tiny or huge."""
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-rows // MOST_RANGE_ROWS), min(usual, -(-rows // LEAST_RANGE_ROWS)))


def sorted_ranges(df: DataFrame, order: Sequence[Column | str], rows: int | None = None) -> DataFrame:
    """``df`` written in globally sorted ranges, with range number and offset columns.

    The number of ranges follows from the number of rows (counted here unless given), not from bytes: the
    work behind a range is per row, and adaptive execution leaves an explicit number alone, so small tables are spread too.
    """
    keys = [_column(c) for c in order]
    count = range_count(df.sparkSession, df.count() if rows is None else rows)
    ranged = df.repartitionByRange(count, *keys).sortWithinPartitions(*keys)
    placed = cut_lineage(ranged.withColumn(_MID, F.monotonically_increasing_id()))
    return placed.select(
        *df.columns,
        F.shiftright(_MID, _ROW_BITS).alias(_PID),
        F.col(_MID).bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias(_POS),
    )


def _rows_before(per_range: DataFrame, size: str, keys: Sequence[str] = ()) -> DataFrame:
    """Sum of ``size`` over earlier ranges; at most one row per range (and key) comes in."""
    w = W.partitionBy(*keys).orderBy(_PID).rowsBetween(W.unboundedPreceding, -1)
    return per_range.withColumn("__before", F.coalesce(F.sum(size).over(w), F.lit(0)))


def global_ordinal(
    df: DataFrame, order: Sequence[Column | str], name: str = "ordinal"
) -> DataFrame:
    """1-based position of each row in ``order``; the order must be unique."""
    placed = sorted_ranges(df, order)
    sizes = placed.groupBy(_PID).agg(F.count("*").alias("__n"))
    starts = _rows_before(sizes, "__n").select(_PID, "__before")
    # one row per range: the broadcast cannot outgrow the number of shuffle partitions
    return placed.join(F.broadcast(starts), _PID).select(
        *df.columns, (F.col(_POS) + F.col("__before") + 1).alias(name)
    )


def _same_key(keys: Sequence[str], prefix: str) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return same


def ordinal_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str = "ordinal",
) -> DataFrame:
    """1-based position of each row inside its group, for any number and size of groups.

    ``keys`` plus ``order`` must be unique. Rows are sorted into ranges by both, so a group of any size is
    spread over as many ranges as it fills; each piece is numbered in its range and shifted by the
    group's rows in earlier ranges.
    """
    placed = sorted_ranges(df, [*keys, *order])
    sizes = placed.groupBy(*keys, _PID).agg(F.count("*").alias("__n"))
    # a group leaves at most one leading piece per range, so fewer rows than ranges remain
    later = _rows_before(sizes, "__n", keys).where("__before > 0")
    later = later.select(
        *[F.col(k).alias(f"__k_{k}") for k in keys], F.col(_PID).alias("__p"), "__before"
    )
    local = placed.withColumn(
        "__seq", F.row_number().over(W.partitionBy(_PID, *keys).orderBy(_POS))
    )
    same = (F.col(_PID) == F.col("__p")) & _same_key(keys, "__k_")
    return local.join(later, same, "left").select(
        *df.columns,
        (F.col("__seq") + F.coalesce(F.col("__before"), F.lit(0))).cast("long").alias(name),
    )


def sequential_id(df: DataFrame, order: Sequence[Column | str], name: str = "id") -> DataFrame:
    """``df`` with a leading 0-based row number."""
    numbered = global_ordinal(df, order, name)
    return numbered.select((F.col(name) - 1).alias(name), *df.columns)


def mini_batches(
    df: DataFrame, order: Sequence[Column | str], batch_size: int, drop_tail: bool = True
) -> DataFrame:
    """``batch_id`` per row; with ``drop_tail`` only whole batches are kept."""
    numbered = global_ordinal(df, order, "__ord")
    batch = F.floor((F.col("__ord") - 1) / batch_size).cast("long")
    out = numbered.withColumn("batch_id", batch)
    if drop_tail:
        whole = numbered.agg(F.floor(F.count("*") / batch_size).cast("long")).scalar()
        out = out.where(F.col("batch_id") < whole)
    return out.drop("__ord")


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> DataFrame:
    """Interpolated quantiles per column as ``(column, p, value)``; nulls are skipped.

    Equal values are counted before any shuffle, the distinct values are put in sorted
    ranges, and only the ranges that hold a wanted rank are looked at row by row.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns]
    )
    tall = df.select(F.explode(pairs).alias("e")).select("e.*").where("x is not null")
    # written, as it is counted, sampled and sorted
    counted = cut_lineage(tall.groupBy("column", "x").agg(F.count("*").alias("n")))
    placed = sorted_ranges(counted, ["column", "x"])

    per_range = placed.groupBy("column", _PID).agg(F.sum("n").alias("m"))
    spans = _rows_before(per_range, "m", ["column"])
    everything = W.partitionBy("column")
    wanted = (
        spans.withColumn("total", F.sum("m").over(everything))
        .withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
        .withColumn("at", F.col("p") * (F.col("total") - 1))
        .withColumn("rank", F.explode(F.array(F.floor("at"), F.ceil("at"))))
        .where("rank >= __before and rank < __before + m")
        .select("column", _PID, "p", "at", "rank", "__before")
    )
    # bounded: columns x probabilities x 2 rows
    targets = F.broadcast(wanted)
    hit_ranges = F.broadcast(wanted.select("column", _PID).distinct())
    inside = placed.join(hit_ranges, ["column", _PID], "left_semi")
    upto = W.partitionBy("column", _PID).orderBy("x").rowsBetween(W.unboundedPreceding, 0)
    inside = inside.withColumn("seen", F.sum("n").over(upto))
    rank_here = F.col("rank") - F.col("__before")
    found = inside.join(targets, ["column", _PID]).where(
        (rank_here < F.col("seen")) & (rank_here >= F.col("seen") - F.col("n"))
    )
    low, high, at = F.min("x"), F.max("x"), F.first("at")
    return found.groupBy("column", "p").agg(
        (low + (high - low) * (at - F.floor(at))).alias("value")
    )
