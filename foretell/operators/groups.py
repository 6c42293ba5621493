"""Audit groups from sponsor districts, group error rates and disparities."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foretell.functions.scalar import (
    district_chamber,
    district_number,
    is_bad_district,
    ratio,
)
from foretell.operators.facts import sponsor_sessions
from foretell.operators.joins import last_wins_lookup
from foretell.operators.metrics import metric_column
from foretell.session import small_table

# fixed values: districts that define the two audited groups
GROUP_DISTRICTS = {
    "black": {
        "upper": [17, 15, 13, 14, 5, 16, 4, 3],
        "lower": [29, 33, 34, 26, 27, 38, 5, 30, 9, 8, 31, 25, 10, 28, 32, 7],
    },
    "asian": {"upper": [8, 23, 28, 1, 9], "lower": [16, 2, 15, 44, 17]},
}
REFERENCE_GROUP = "white"


def sponsor_districts(
    sponsors: DataFrame, bills: DataFrame, people: DataFrame, state_id: int | None = None,
    match_session: bool = True, order: Sequence[str] = ("district",),
) -> DataFrame:
    """``(bill_id, sponsor_id, district)`` of sponsors found among a state's people.

    With ``match_session`` the person must sit in the bill's session and the last row per
    (session, person) in ``order`` counts; without it every row of the person does.
    """
    seated = people if state_id is None else people.where(F.col("state_id") == state_id)
    seated = seated.withColumnRenamed("person_id", "sponsor_id")
    if not match_session:
        # a person's repeated rows of a district are counted before the join, not joined
        places = seated.groupBy("sponsor_id", "district").agg(F.count("*").cast("int").alias("__n"))
        pairs = sponsors.groupBy("bill_id", "sponsor_id").agg(F.count("*").cast("int").alias("__m"))
        rows = pairs.join(places, "sponsor_id")
        copies = F.explode(F.sequence(F.lit(1), F.col("__n") * F.col("__m")))
        return rows.select("bill_id", "sponsor_id", "district", copies.alias("__copy")).drop("__copy")
    found = last_wins_lookup(
        sponsor_sessions(sponsors, bills), seated, ["session_id", "sponsor_id"], "district", order
    )
    return found.select("bill_id", "sponsor_id", "district")


def parsed_districts(bill_districts: DataFrame) -> DataFrame:
    """Distinct ``(bill_id, chamber, number)``; see :func:`bad_districts` for the rest."""
    return bill_districts.where(~is_bad_district("district")).select(
        "bill_id",
        district_chamber("district").alias("chamber"),
        district_number("district").alias("number"),
    ).distinct()


def bad_districts(bill_districts: DataFrame) -> DataFrame:
    return bill_districts.where(is_bad_district("district"))


def district_sets(parsed: DataFrame) -> DataFrame:
    """Sorted upper and lower district numbers per bill (bounded by the map of districts)."""

    def numbers(chamber: str):
        return F.sort_array(F.collect_set(F.when(F.col("chamber") == chamber, F.col("number"))))

    return parsed.groupBy("bill_id").agg(
        numbers("upper").alias("upper"), numbers("lower").alias("lower")
    )


def group_table(
    spark: SparkSession, districts: Mapping[str, Mapping[str, Sequence[int]]] = GROUP_DISTRICTS
) -> DataFrame:
    rows = [(g, c, n) for g, by in districts.items() for c, ns in by.items() for n in ns]
    return small_table(spark, rows, "`group` string, chamber string, number int")


def group_members(parsed: DataFrame, groups: DataFrame) -> DataFrame:
    """Distinct ``(group, bill_id)`` where a sponsor district is on the group's list."""
    return parsed.join(groups, ["chamber", "number"]).select("group", "bill_id").distinct()


def with_reference_group(
    parsed: DataFrame, members: DataFrame, name: str = REFERENCE_GROUP
) -> DataFrame:
    """Group members plus the bills that belong to no group."""
    rest = parsed.select("bill_id").distinct().join(members.select("bill_id"), "bill_id", "left_anti")
    return members.unionByName(rest.select(F.lit(name).alias("group"), "bill_id"))


def audit_groups(
    parsed: DataFrame, groups: DataFrame, reference: str = REFERENCE_GROUP
) -> DataFrame:
    """Members of every group and of the reference group from one pass over the districts.

    The set collected per bill is bounded by the number of groups.
    """
    named = parsed.join(groups, ["chamber", "number"], "left")
    per_bill = named.groupBy("bill_id").agg(F.collect_set("group").alias("names"))
    found = F.when(F.size("names") == 0, F.array(F.lit(reference))).otherwise(F.col("names"))
    return per_bill.select(F.explode(found).alias("group"), "bill_id")


def group_metrics(
    flagged: DataFrame, members: DataFrame, names: Sequence[str] = ("FDR", "TPR"),
    by: Sequence[str] = (), id_column: str = "bill_id", label: str = "y",
) -> DataFrame:
    """Error rates of the flagged predictions per group."""
    pieces = [id_column, label, "predicted", *by]
    inside = flagged.select(*pieces).join(members.withColumnRenamed("bill_id", id_column), id_column)
    hit = F.col("predicted") == 1
    return inside.groupBy(*by, "group").agg(
        F.count("*").alias("n"), *[metric_column(n, label, hit).alias(n) for n in names]
    )


def disparities(
    metrics: DataFrame, names: Sequence[str] = ("FDR", "TPR"), by: Sequence[str] = (),
    reference: str = REFERENCE_GROUP,
) -> DataFrame:
    """Each group's metric divided by the reference group's; null on a zero reference."""
    # one row per model and group comes in
    same_model = W.partitionBy(*by)
    is_reference = F.col("group") == reference
    paired = metrics.select(
        *by, "group",
        *[
            ratio(n, F.max(F.when(is_reference, F.col(n))).over(same_model)).alias(f"{n}_disparity")
            for n in names
        ],
    )
    return paired.where(~is_reference)


def top_districts_by_share(
    totals: DataFrame, keys: Sequence[str], races: Sequence[str], n: int
) -> DataFrame:
    """The ``n`` districts with the highest share of each race, as group source."""
    whole = sum((F.col(r) for r in races[1:]), F.col(races[0]))
    shares = totals.select(*keys, *[ratio(r, whole).alias(r) for r in races])
    tall = shares.unpivot(list(keys), list(races), "race", "share").where("share is not null")
    # a race has one row per district, and the rank filter runs before the shuffle
    best = W.partitionBy("race").orderBy(F.desc("share"), *keys)
    return tall.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)
