from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foretell.features.fit import with_history
from foretell.features.spec import FeatureSpec
from foretell.operators.history import delayed_history
from foretell.operators.splits import (
    CalendarSplits,
    block_roles,
    block_starts,
    long_blocks,
    with_block_columns,
)

GOLDEN = [
    (1, "2010-01-01", [7, 8], "Passed", 0, 0, None),
    (2, "2010-06-01", [7], "Failed", 0, 0, None),
    (3, "2011-01-01", [7], "Failed", 0, 0, None),
    (4, "2011-01-02", [7, 8], "Passed", 2, 2, 1.0),
    (5, "2012-01-02", [7, 8], "Failed", 2, 4, 0.5),
    (6, "2012-01-02", [9], "Passed", 0, 0, None),
]


def frames(spark, rows):
    bills = spark.createDataFrame([r[:3] for r in rows], "bill_id long, introduced_date date, status_new string")
    pairs = [(r[0], s) for r in rows for s in r[3]]
    return bills, spark.createDataFrame(pairs, "bill_id long, sponsor_id long")


def naive(rows, population=None):
    out = {}
    for bill, day, _, sponsors in rows:
        passed = total = 0
        for s in sponsors:
            for _, other_day, status, others in population or rows:
                if day and other_day and (day - other_day).days > 365:
                    passed += others.count(s) * (status == "Passed")
                    total += others.count(s)
        out[bill] = (passed, total, passed / total if total else None)
    return out


def collected(df):
    return {r.bill_id: (r.hist_passed, r.sponsor_total_bills, r.sponsor_pass_rate) for r in df.collect()}


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_golden_history(spark, parts):
    rows = [(b, date.fromisoformat(day), status, s) for b, day, s, status, *_ in GOLDEN]
    bills, sponsors = frames(spark, rows)
    got = collected(delayed_history(bills.repartition(parts), sponsors.repartition(parts)))
    assert got == {g[0]: tuple(g[4:]) for g in GOLDEN}


bill_rows = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(0, 1500)), st.sampled_from(["Passed", "Failed"]),
        st.lists(st.integers(1, 3), min_size=1, max_size=3),
    ),
    min_size=1, max_size=25,
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(bill_rows)
def test_history_equals_brute_force(spark, drawn):
    rows = [
        (i, None if day is None else date(2010, 1, 1) + timedelta(days=day), status, sponsors)
        for i, (day, status, sponsors) in enumerate(drawn)
    ]
    bills, sponsors = frames(spark, rows)
    assert collected(delayed_history(bills, sponsors)) == naive(rows)


def test_history_from_a_wider_population(spark):
    rows = [(i, date(2010, 1, 1) + timedelta(days=97 * i), "Passed" if i % 3 else "Failed", [1 + i % 2, 3]) for i in range(30)]
    bills, sponsors = frames(spark, rows)
    late = bills.where("bill_id >= 20")
    want = {b: v for b, v in naive(rows).items() if b >= 20}
    assert collected(delayed_history(late, sponsors, population=bills)) == want


def test_history_window_sees_one_row_per_sponsor_and_day(spark):
    rows = [(i, date(2010, 1, 1 + i % 28), "Passed", [1]) for i in range(500)]
    bills, sponsors = frames(spark, rows)
    plan = delayed_history(bills, sponsors)._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window ["):]
    assert window.index("Aggregate [sponsor_id") < window.index("Join Inner")


def test_history_columns_follow_packed_lists(spark):
    rows = [(b, day, ", ".join(map(str, s)), status) for b, day, s, status, *_ in GOLDEN]
    facts = spark.createDataFrame(rows, "bill_id long, introduced_date string, sponsors string, status_new string")
    facts = facts.withColumn("introduced_date", F.to_date("introduced_date"))
    spec = FeatureSpec({"sponsors": {"sponsor_pass_rate": ["introduced_date", "status_new"]}})
    got = {r.bill_id: r["__hist_sponsors"] for r in with_history(facts, spec).collect()}
    assert got == {g[0]: g[6] for g in GOLDEN}


def test_block_roles_golden():
    starts = block_starts(2009, 2019)
    assert starts == [0, 2, 4, 6]
    assert [block_roles(s, 11, (2, 1, 1, 1), 1) for s in starts] == [
        [1, 1, 2, 3, 4, 0, 0, 0, 0, 0, 0],
        [1, 1, 1, 1, 2, 3, 4, 0, 0, 0, 0],
        [1, 1, 1, 1, 1, 1, 2, 3, 4, 0, 0],
        [1, 1, 1, 1, 1, 1, 1, 1, 2, 3, 4],
    ]
    assert block_roles(2, 11, (2, 1, 1, 1), 0) == [0, 0, 1, 1, 2, 3, 4, 0, 0, 0, 0]


def test_block_columns(spark):
    days = [date(y, 7, 1) for y in range(2008, 2022)] + [None]
    df = with_block_columns(spark.createDataFrame([(x,) for x in days], "introduced_date date"), "introduced_date", type_val=1)
    got = {r[0]: tuple(r)[1:] for r in df.collect()}
    assert got[date(2012, 7, 1)] == (3, 1, 1, 1)
    assert got[date(2020, 7, 1)] == got[date(2008, 7, 1)] == got[None] == (None,) * 4
    assert long_blocks(df).count() == 11 * 4


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 15), st.lists(st.integers(0, 3), min_size=4, max_size=4), st.integers(1, 3), st.sampled_from([0, 1]))
def test_each_year_has_one_role(n_years, split, freq, before):
    if sum(split) == 0:
        return
    for skipped in block_starts(2000, 2000 + n_years - 1, split, freq):
        roles = block_roles(skipped, n_years, split, before)
        assert len(roles) == n_years
        for role, length in enumerate(split, 1):
            used = roles[skipped:].count(role)
            assert used == length


def test_calendar_splits_golden(spark):
    days = [(date(2024, 1, 1) + timedelta(days=i),) for i in range(30)]
    df = spark.createDataFrame(days, "day0 date")
    splitter = CalendarSplits(14, 4, "days")
    table = splitter.split_table(df, "day0", gap=1)
    got = [(r.split, r.role, r.start_date.day, r.end_date.day) for r in table.orderBy("split", F.desc("role")).collect()]
    assert got == [
        (1, "train", 1, 15), (1, "test", 16, 20), (2, "train", 5, 19), (2, "test", 20, 24),
        (3, "train", 9, 23), (3, "test", 24, 28),
    ]
    assert splitter.get_n_splits() == 3
    out = splitter.split(df, "day0", gap=1)
    assert out.where("split = 1 and role = 'train'").count() == 14
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(KeyError):
        splitter.split(df, "nope")


def test_month_ends_carry_over():
    periods = CalendarSplits(1, 1, "months").periods(date(2024, 1, 31), date(2024, 7, 1))
    starts = [s for _, role, s, _ in periods if role == "train"]
    assert starts[:3] == [date(2024, 1, 29), date(2024, 2, 29), date(2024, 3, 29)]
