from datetime import date

import pytest
from pyspark.sql import functions as F

from foretell.operators import facts as Q
from foretell.operators import joins as J
from foretell.operators.profile import assert_unique


def d(text):
    return date.fromisoformat(text) if text else None


PROGRESS = [
    (1, d("2010-01-01"), 1, 1), (1, d("2011-01-01"), 4, 2),
    (2, d("2010-01-01"), 1, 1), (2, d("2011-01-02"), 4, 2),
    (3, d("2010-01-01"), 6, 1),
    (4, d("2010-01-01"), 1, 1), (4, None, 4, 2),
    (5, d("2010-01-01"), 1, 1),
]


@pytest.fixture(scope="module")
def progress(spark):
    return spark.createDataFrame(PROGRESS, "bill_id long, progress_date date, bill_status int, line int")


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_outcomes(progress, parts):
    got = {
        r.bill_id: (r.diff, r.bill_status, r.status_new)
        for r in Q.bill_outcomes(progress.repartition(parts), ["line"]).collect()
    }
    assert got == {
        1: (365, 4, "Passed"),
        2: (366, 4, "Failed_Final"),
        3: (0, 6, "Failed"),
        4: (None, 4, "Failed_Final"),
        5: (0, 1, "Failed_Final"),
    }
    assert {r.bill_id: r.diff for r in Q.date_difference(progress).collect()}[4] is None


def test_sponsor_list_keeps_repeats_in_numeric_order(spark):
    rows = spark.createDataFrame([(1, 10), (1, 9), (1, 9), (2, 100)], "bill_id long, sponsor_id long")
    assert {r.bill_id: r.sponsors for r in Q.sponsor_list(rows).collect()} == {1: "9, 9, 10", 2: "100"}


def test_final_status_takes_lowest_sponsor_and_drops_unsponsored(spark, progress):
    sponsors = spark.createDataFrame([(1, 8, 2), (1, 7, 1), (3, 9, 0)], "bill_id long, sponsor_id long, party_id int")
    bill_state = spark.createDataFrame([(13, b) for b in range(1, 6)], "state_id int, bill_id long")
    states = spark.createDataFrame([(13, "IL")], "state_id int, state_abbreviation string")
    status = spark.createDataFrame([(4, "Passed")], "status_id int, status string")
    got = {
        r.bill_id: (r.party_id, r.status)
        for r in Q.final_status(progress, bill_state, status, states, sponsors, 13, ["line"]).collect()
    }
    assert got == {1: (1, "Passed"), 3: (0, None)}


def test_detail_of_a_hot_bill(spark, monkeypatch):
    """One bill holds over a third of all rows; numbering is exact and newest first."""
    monkeypatch.setattr("foretell.operators.ordinal.LEAST_RANGE_ROWS", 500)
    rows = [(1, date(2010 + i % 9, 1 + i % 12, 1 + i % 28), 1, i) for i in range(2000)]
    rows += [(2 + i % 50, date(2011, 1, 1 + i % 28), 4, i) for i in range(1000)]
    progress = spark.createDataFrame(rows, "bill_id long, progress_date date, bill_status int, line int").repartition(9)
    bill_state = spark.createDataFrame([(13, b) for b in range(1, 52)], "state_id int, bill_id long")
    states = spark.createDataFrame([(13, "IL")], "state_id int, state_abbreviation string")
    status = spark.createDataFrame([(4, "Passed"), (1, "Introduced")], "status_id int, status string")
    out = Q.bill_detail(progress, bill_state, status, states, 13, ["line"])
    hot = [r.progress_date for r in out.where("bill_id = 1").orderBy("seq").collect()]
    assert hot == sorted((r[1] for r in rows if r[0] == 1), reverse=True)
    assert out.count() == 3000
    assert out.groupBy("bill_id").agg((F.max("seq") == F.count("*")).alias("ok")).where("not ok").count() == 0


def test_text_versions_repeat_sponsor_rows(spark):
    labelled = spark.createDataFrame([(1, "Passed")], "bill_id long, status_new string")
    bills = spark.createDataFrame([(1, 5)], "bill_id long, session_id long")
    texts = spark.createDataFrame([(1, 1), (1, 2), (1, 3)], "bill_id long, doc_id long")
    dates = spark.createDataFrame([(5,)], "session_id long")
    sponsors = spark.createDataFrame([(1, 7, 1), (1, 8, 2)], "bill_id long, sponsor_id long, party_id int")
    assert Q.sponsor_outcomes(labelled, bills, texts, dates, sponsors).count() == 6
    assert Q.sponsor_outcomes(labelled, bills, texts, dates, sponsors, True).count() == 2


def test_final_text_prefers_missing_date_then_higher_id(spark):
    rows = [(1, 1, 1, d("2010-01-01")), (1, 2, 1, d("2011-01-01")), (1, 3, 2, d("2012-01-01")), (2, 4, 1, None), (2, 5, 1, d("2011-01-01"))]
    texts = spark.createDataFrame(rows, "bill_id long, doc_id long, type_id int, doc_date date")
    newest = Q.final_text(texts)
    assert {r.bill_id: r.doc_id for r in newest.collect()} == {1: 2, 2: 4}
    again = texts.unionByName(texts)  # a document that is listed twice gives one row
    assert sorted((r.bill_id, r.doc_id) for r in Q.final_text(again).collect()) == [(1, 2), (2, 4)]
    assert "WindowGroupLimit" in newest._jdf.queryExecution().executedPlan().toString()


def test_year_filter_is_pushed_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "bills")
    spark.createDataFrame([(1, 1, date(2010, 5, 1)), (2, 1, date(2012, 5, 1))], "bill_id long, session_id long, introduced_date date").write.parquet(path)
    sessions = spark.createDataFrame([(1, 13)], "session_id long, state_id int")
    df = Q.bills_by_state(spark.read.parquet(path), sessions, 2009, 2011)
    assert [r.bill_id for r in df.collect()] == [1]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(introduced_date,2009-01-01)" in plan
    assert "year(" not in plan


def test_last_wins_and_update(spark):
    left = spark.createDataFrame([(1, 2), (1, 3)], "s long, p long")
    right = spark.createDataFrame([(1, 2, "a", 1), (1, 2, "b", 2)], "s long, p long, v string, o int")
    assert [r.v for r in J.last_wins_lookup(left, right, ["s", "p"], "v", ["o"]).collect()] == ["b"]
    base = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "id long, c string")
    new = spark.createDataFrame([(1, "n"), (2, None)], "id long, n string")
    assert {r.id: r.c for r in J.update_column(base, new, "id", "c", "n").collect()} == {1: "n", 2: None, 3: "z"}


def test_key_check(spark):
    df = spark.createDataFrame([(1, 1), (1, 2)], "a int, b int")
    assert assert_unique(df, ["a", "b"]) is df
    with pytest.raises(ValueError):
        assert_unique(df, ["a"])
    with pytest.raises(ValueError):
        assert_unique(spark.createDataFrame([(None,)], "a int"), ["a"])
