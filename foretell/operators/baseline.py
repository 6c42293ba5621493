"""Pass rates of sponsors and parties, and the score they give a bill."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foretell.functions.scalar import geometric_mean
from foretell.operators.joins import lookup_or, members_only
from foretell.session import scratch_path


def pass_counters(rows: DataFrame, key: str, allowed: DataFrame | None = None) -> DataFrame:
    """``(key, passed, failed)``; any status but Passed counts as failed."""
    used = rows if allowed is None else members_only(rows, allowed, "bill_id")
    passed = F.col("status_new") == "Passed"
    return used.groupBy(key).agg(
        F.count_if(passed).alias("passed"),
        (F.count("*") - F.count_if(passed)).alias("failed"),
    )


def pass_rates(rows: DataFrame, key: str, allowed: DataFrame | None = None) -> DataFrame:
    """``(key, rate)``."""
    return pass_counters(rows, key, allowed).select(
        key, (F.col("passed") / (F.col("passed") + F.col("failed"))).alias("rate")
    )


def mean_rate(rates: DataFrame) -> Column:
    """Unweighted mean over the keys, the rate of an unseen key."""
    return rates.agg(F.avg("rate")).scalar()


@dataclass(frozen=True)
class RateBaseline:
    """Score of a bill: sqrt(mean sponsor rate x mean party rate), unseen keys get the mean."""

    sponsor_rates: DataFrame
    party_rates: DataFrame

    @classmethod
    def fit(cls, rows: DataFrame, allowed: DataFrame | None = None) -> RateBaseline:
        """``rows`` are (sponsor_id, party_id, bill_id, status_new) of the training slice.

        One pass counts by sponsor and party; both rate tables come from the counts and are written, so
        the planner knows their sizes and nothing is computed again for the means.
        """
        used = rows if allowed is None else members_only(rows, allowed, "bill_id")
        spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "rates")
        passed = F.col("status_new") == "Passed"
        used.groupBy("sponsor_id", "party_id").agg(
            F.count_if(passed).alias("passed"), F.count("*").alias("n")
        ).write.parquet(f"{path}/counts")
        counts = spark.read.parquet(f"{path}/counts")
        rate = (F.sum("passed") / F.sum("n")).alias("rate")
        cls(counts.groupBy("sponsor_id").agg(rate), counts.groupBy("party_id").agg(rate)).save(path)
        return cls.load(spark, path)

    def bill_rates(self, rows: DataFrame) -> DataFrame:
        """``(bill_id, spr, ppr)``.

        Rows are first counted per (bill, sponsor, party); the counts weight the means.
        """
        counted = rows.groupBy("bill_id", "sponsor_id", "party_id").agg(F.count("*").alias("w"))
        rated = lookup_or(
            counted, self.sponsor_rates, "sponsor_id", "rate", mean_rate(self.sponsor_rates), "s"
        )
        rated = lookup_or(
            rated, self.party_rates, "party_id", "rate", mean_rate(self.party_rates), "p"
        )
        return rated.groupBy("bill_id").agg(
            (F.sum(F.col("s") * F.col("w")) / F.sum("w")).alias("spr"),
            (F.sum(F.col("p") * F.col("w")) / F.sum("w")).alias("ppr"),
        )

    def predict(self, rows: DataFrame) -> DataFrame:
        """``(bill_id, score)`` for any bills with sponsor rows."""
        return self.bill_rates(rows).select("bill_id", geometric_mean("spr", "ppr").alias("score"))

    def save(self, path: str) -> None:
        self.sponsor_rates.write.mode("overwrite").parquet(f"{path}/sponsor_rates")
        self.party_rates.write.mode("overwrite").parquet(f"{path}/party_rates")

    @classmethod
    def load(cls, spark, path: str) -> RateBaseline:
        return cls(
            spark.read.parquet(f"{path}/sponsor_rates"), spark.read.parquet(f"{path}/party_rates")
        )
