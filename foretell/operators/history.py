"""Delayed history of an entity: what was decided more than a year before each bill."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foretell.functions.scalar import OUTCOME_WINDOW_DAYS, id_list, ratio


def _sponsor_days(bills: DataFrame, sponsors: DataFrame) -> DataFrame:
    dated = bills.where("introduced_date is not null").select(
        "bill_id",
        F.datediff("introduced_date", F.lit("1970-01-01")).alias("day"),
        (F.col("status_new") == "Passed").cast("long").alias("passed"),
    )
    return sponsors.select("bill_id", "sponsor_id").join(dated, "bill_id")


def delayed_history(
    bills: DataFrame,
    sponsors: DataFrame,
    population: DataFrame | None = None,
    delay_days: int = OUTCOME_WINDOW_DAYS,
) -> DataFrame:
    """Passed and total earlier bills of each bill's sponsors.

    ``bills`` (bill_id, introduced_date, status_new) are the rows to describe; history is
    drawn from ``population`` (same columns), by default the same rows. A bill counts for
    a sponsor once it was introduced more than ``delay_days`` days earlier; a sponsor named
    twice on a bill counts twice. ``pass_rate`` is null without history.

    Rows are first reduced to one per (sponsor, day), so the window over a very active
    sponsor is bounded by the number of days, and the join back is on (sponsor, day).
    """
    rows = _sponsor_days(bills, sponsors)
    sources = rows if population is None else _sponsor_days(population, sponsors)
    daily = sources.groupBy("sponsor_id", "day").agg(
        F.sum("passed").alias("passed"), F.count("*").alias("total")
    )
    if population is not None:
        none = F.lit(0).cast("long")
        asked = rows.select("sponsor_id", "day", none.alias("passed"), none.alias("total")).distinct()
        daily = daily.unionByName(asked).groupBy("sponsor_id", "day").agg(
            F.sum("passed").alias("passed"), F.sum("total").alias("total")
        )
    earlier = (
        W.partitionBy("sponsor_id")
        .orderBy("day")
        .rangeBetween(W.unboundedPreceding, -(delay_days + 1))
    )
    known = daily.select(
        "sponsor_id",
        "day",
        F.coalesce(F.sum("passed").over(earlier), F.lit(0)).alias("h_passed"),
        F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("h_total"),
    )
    per_bill = (
        rows.select("bill_id", "sponsor_id", "day")
        .join(known, ["sponsor_id", "day"])
        .groupBy("bill_id")
        .agg(F.sum("h_passed").alias("hist_passed"), F.sum("h_total").alias("hist_total"))
    )
    return bills.select("bill_id").join(per_bill, "bill_id", "left").select(
        "bill_id",
        F.coalesce("hist_passed", F.lit(0)).alias("hist_passed"),
        F.coalesce("hist_total", F.lit(0)).alias("sponsor_total_bills"),
        ratio("hist_passed", "hist_total").alias("sponsor_pass_rate"),
    )


def sponsors_from_list(facts: DataFrame, id_column: str, list_column: str) -> DataFrame:
    """Bridge rows ``(bill_id, sponsor_id)`` from a packed id list."""
    return facts.select(
        F.col(id_column).alias("bill_id"), F.explode(id_list(list_column)).alias("sponsor_id")
    )
