"""Labelled fact tables built from bill, progress, sponsor and text relations.

Every history (progress rows, text versions, sponsor rows) is reduced to one row per bill
before it is joined, so joins between large relations are one-to-one on ``bill_id`` and a
bill with very many rows is combined map-side. Dimension joins carry no hint: Spark's own
size check (``spark.sql.autoBroadcastJoinThreshold``, re-checked by AQE) picks broadcast
or shuffle.

Where a relation has no order of its own, "first" and "latest" need ``tiebreak`` columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foretell.functions.scalar import days_between, in_years, outcome_label, year_of
from foretell.operators.joins import members_only
from foretell.operators.ordinal import ordinal_within


def bills_by_state(
    bills: DataFrame, sessions: DataFrame, start_year: int, end_year: int
) -> DataFrame:
    """``(state_id, bill_id)`` of the bills introduced in the given years, by state."""
    chosen = bills.where(in_years("introduced_date", start_year, end_year))
    joined = chosen.join(sessions.select("session_id", "state_id"), "session_id")
    # bill_id in the sort key splits a hot state over several ranges
    return joined.select("state_id", "bill_id").orderBy("state_id", "bill_id")


def _newest(progress_columns: Sequence[str], tiebreak: Sequence[str]) -> Column:
    """The newest row's struct; a missing date counts as newest."""
    order = F.struct(F.col("progress_date").isNull(), "progress_date", *tiebreak)
    return F.max_by(F.struct(*progress_columns), order)


def _span_days() -> Column:
    """Last minus first progress date; unknown as soon as one date is missing."""
    return F.when(
        F.count("*") == F.count("progress_date"),
        days_between(F.max("progress_date"), F.min("progress_date")),
    )


def date_difference(progress: DataFrame) -> DataFrame:
    """``(bill_id, diff)``: days between first and last progress of each bill."""
    return progress.groupBy("bill_id").agg(_span_days().alias("diff"))


def bill_outcomes(progress: DataFrame, tiebreak: Sequence[str]) -> DataFrame:
    """One row per bill from one aggregation: span, newest progress row, label."""
    per_bill = progress.groupBy("bill_id").agg(
        _span_days().alias("diff"),
        _newest(["progress_date", "bill_status"], tiebreak).alias("newest"),
    )
    return per_bill.select(
        "bill_id",
        "diff",
        F.col("newest.progress_date").alias("final_date"),
        F.col("newest.bill_status").alias("bill_status"),
        outcome_label("diff", "newest.bill_status").alias("status_new"),
    )


def rank_states(
    bills: DataFrame, sessions: DataFrame, states: DataFrame, start_year: int, end_year: int
) -> DataFrame:
    """States by number of bills; ties go to the lower state id."""
    chosen = bills.where(in_years("introduced_date", start_year, end_year))
    per_session = chosen.groupBy("session_id").agg(F.count("bill_id").alias("n"))
    counts = (
        per_session.join(sessions.select("session_id", "state_id"), "session_id")
        .groupBy("state_id")
        .agg(F.sum("n").alias("count"))
        .join(states, "state_id")
    )
    # one row per state from here on
    by_count = W.orderBy(F.desc("count"), "state_id")
    return counts.select(
        "state_id", "state_abbreviation", "count", F.row_number().over(by_count).alias("rank")
    ).orderBy("rank")


def _in_state(bill_state: DataFrame, states: DataFrame, state_id: int | None) -> DataFrame:
    known = bill_state.join(states.select("state_id", "state_abbreviation"), "state_id")
    return known if state_id is None else known.where(F.col("state_id") == state_id)


def bill_detail(
    progress: DataFrame,
    bill_state: DataFrame,
    status_catalog: DataFrame,
    states: DataFrame,
    state_id: int | None,
    tiebreak: Sequence[str],
) -> DataFrame:
    """Progress history of a state's bills, ``seq`` 1 being the newest row of a bill.

    ``count_year`` is the number of whole years since the bill's first progress row.
    """
    # only the state's bills are aggregated and joined
    wanted = _in_state(bill_state, states, state_id)
    mine = members_only(progress, wanted, "bill_id")
    first = mine.groupBy("bill_id").agg(F.min("progress_date").alias("first_date"))
    per_bill = wanted.join(first, "bill_id")
    years = F.floor(F.months_between("progress_date", "first_date") / 12).cast("int")
    placed = (
        mine.join(per_bill, "bill_id")
        .join(status_catalog, F.col("status_id") == F.col("bill_status"), "left")
        .withColumn("count_year", years)
    )
    newest_first = [F.col("progress_date").desc_nulls_first(), *[F.desc(c) for c in tiebreak]]
    keep = ["bill_id", "state_id", "progress_date", "bill_status", "status", "count_year"]
    rows = placed.select(*keep, *[c for c in tiebreak if c not in keep])
    numbered = ordinal_within(rows, ["bill_id"], newest_first, "seq")
    return numbered.select(*keep, "seq")


def sponsor_list(sponsors: DataFrame) -> DataFrame:
    """``(bill_id, sponsors)``: ids as ``"9, 9, 10"``, numeric order, repeats kept.

    Repeats are counted first, so a bill's list is built from its distinct sponsors.
    """
    counted = sponsors.groupBy("bill_id", "sponsor_id").agg(F.count("*").cast("int").alias("n"))
    per_bill = counted.groupBy("bill_id").agg(
        F.array_sort(F.collect_list(F.struct("sponsor_id", "n"))).alias("pairs")
    )
    ids = F.flatten(
        F.transform("pairs", lambda p: F.array_repeat(p["sponsor_id"].cast("string"), p["n"]))
    )
    return per_bill.select("bill_id", F.array_join(ids, ", ").alias("sponsors"))


def final_status(
    progress: DataFrame,
    bill_state: DataFrame,
    status_catalog: DataFrame,
    states: DataFrame,
    sponsors: DataFrame,
    state_id: int | None,
    tiebreak: Sequence[str],
) -> DataFrame:
    """Newest progress row and span of each sponsored bill of a state.

    ``party_id`` is the party of the bill's lowest sponsor id. Bills without sponsors are
    left out.
    """
    wanted = _in_state(bill_state, states, state_id)
    if state_id is not None:  # Catalyst does not push a join below an aggregate
        progress, sponsors = (members_only(rows, wanted, "bill_id") for rows in (progress, sponsors))
    lead = sponsors.groupBy("bill_id").agg(F.min_by("party_id", "sponsor_id").alias("party_id"))
    return (
        bill_outcomes(progress, tiebreak)
        .join(wanted, "bill_id")
        .join(lead, "bill_id")
        .join(status_catalog, F.col("status_id") == F.col("bill_status"), "left")
        .select(
            "bill_id", "state_id", "state_abbreviation", "final_date", "bill_status", "status",
            "diff", "party_id", "status_new",
        )
    )


def final_text(texts: DataFrame, type_id: int = 1) -> DataFrame:
    """Newest document of each bill among one document type; ties go to the higher id.

    The document is picked on narrow columns: only the best row of a bill leaves a partition. Its text is then
    kept by a semi join; of rows that repeat it, one stays.
    """
    typed = texts.where(F.col("type_id") == type_id)
    newest_first = W.partitionBy("bill_id").orderBy(F.col("doc_date").desc_nulls_first(), F.col("doc_id").desc_nulls_last())
    newest = typed.select("bill_id", "doc_id", "doc_date").withColumn("__n", F.row_number().over(newest_first)).where("__n = 1")
    newest = newest.select(F.col("bill_id").alias("__bill"), F.col("doc_id").alias("__doc"), F.col("doc_date").alias("__date"))
    same = (
        F.col("bill_id").eqNullSafe(F.col("__bill")) & F.col("doc_id").eqNullSafe(F.col("__doc"))
        & F.col("doc_date").eqNullSafe(F.col("__date"))
    )
    return typed.join(newest, same, "left_semi").dropDuplicates(["bill_id"])


def final_fact(
    status: DataFrame,
    bills: DataFrame,
    texts: DataFrame,
    session_dates: DataFrame,
    sponsor_lists: DataFrame,
    acs: DataFrame,
    composition: DataFrame,
    bill_type: str = "B",
) -> DataFrame:
    """The labelled fact: every part must be present, otherwise the bill is left out.

    ``texts`` has one row per bill: the output of :func:`final_text` for raw documents or a
    table of cleaned texts. Sessions and years are joined to narrow rows; texts come last, by bill.
    """
    chosen = bills.where(F.col("bill_type") == bill_type)
    text_columns = [c for c in ("bill_description", "doc", "bill_text") if c in texts.columns]
    narrow = (
        chosen.select("bill_id", "session_id", "bill_type", "introduced_date", "introduced_body")
        .join(session_dates, "session_id")
        .withColumn("year", year_of("introduced_date"))
        .join(acs, "year")
    )
    return (
        status.join(narrow, "bill_id")
        .join(sponsor_lists, "bill_id")
        .join(composition, "bill_id")
        .join(texts.select("bill_id", *text_columns), "bill_id")
    )


def sponsor_outcomes(
    labelled: DataFrame,
    bills: DataFrame,
    texts: DataFrame,
    session_dates: DataFrame,
    sponsors: DataFrame,
    distinct_versions: bool = False,
) -> DataFrame:
    """``(sponsor_id, party_id, bill_id, status_new)`` per sponsor row and text version.

    A bill's rows repeat once per text version, which weights later pass rates; with
    ``distinct_versions`` they do not. Versions are counted, never joined row by row.
    """
    versions = texts.groupBy("bill_id").agg(F.count("*").cast("int").alias("versions"))
    if distinct_versions:
        versions = versions.withColumn("versions", F.lit(1))
    in_session = bills.join(session_dates.select("session_id"), "session_id").select("bill_id")
    per_bill = (
        labelled.select("bill_id", "status_new").join(versions, "bill_id").join(in_session, "bill_id")
    )
    rows = sponsors.join(per_bill, "bill_id")
    if not distinct_versions:
        rows = rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("versions"))))
    return rows.select("sponsor_id", "party_id", "bill_id", "status_new")


def with_condition(df: DataFrame, condition: Column | str) -> DataFrame:
    """Any query's output restricted by a condition."""
    return df.where(condition)


def sponsor_sessions(sponsors: DataFrame, bills: DataFrame) -> DataFrame:
    """``(sponsor_id, bill_id, session_id)``."""
    return sponsors.select("sponsor_id", "bill_id").join(
        bills.select("bill_id", "session_id"), "bill_id"
    ).select("sponsor_id", "bill_id", "session_id")

