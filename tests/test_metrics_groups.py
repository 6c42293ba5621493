import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from foretell.operators import groups as G
from foretell.operators import metrics as M
from foretell.operators import profile as P
from foretell.operators.baseline import RateBaseline, pass_rates


@pytest.fixture(scope="module")
def four(spark):
    return spark.createDataFrame([(1, 0.3, 0), (2, 0.4, 0), (3, 0.8, 1), (4, 0.9, 1)], "id long, score double, y int")


def test_top_k_golden(four):
    flagged = M.top_fraction(four, 0.3)
    assert [r.predicted for r in flagged.orderBy("id").collect()] == [0, 0, 0, 1]
    row = M.metrics_at_k(flagged).first()
    assert (row.n_top, row.precision, row.recall) == (1, 1.0, 0.5)


def test_top_fraction_uses_double_arithmetic(spark):
    df = spark.range(100).select("id", F.col("id").cast("double").alias("score"), F.lit(1).alias("y"))
    assert M.top_fraction(df, 0.29).agg(F.sum("predicted")).first()[0] == int(0.29 * 100) == 28


def test_ranking_has_no_single_task_exchange(spark, four):
    plan = M.top_fraction(four, 0.3)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("Subquery")[0]


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_grouped_top_fraction_with_a_hot_group(spark, parts, monkeypatch):
    monkeypatch.setattr("foretell.operators.ordinal.LEAST_RANGE_ROWS", 200)
    rng = random.Random(5)
    rows = [(i, float(rng.randint(0, 30)), rng.randint(0, 1), "hot" if i % 3 else f"g{i % 5}") for i in range(900)]
    df = spark.createDataFrame(rows, "id long, score double, y int, grp string").repartition(parts)
    got = {r.id: (r["rank"], r.predicted) for r in M.top_fraction(df, 0.3, ["grp"]).collect()}
    want = {}
    for g in {r[3] for r in rows}:
        mine = sorted((r for r in rows if r[3] == g), key=lambda r: (-r[1], r[0]))
        want.update({r[0]: (i + 1, int(i < int(0.3 * len(mine)))) for i, r in enumerate(mine)})
    assert got == want


def test_undefined_ratios_count_as_zero(four):
    row = M.threshold_metrics(four, threshold=2.0).first()
    assert (row.precision, row.recall, row.f1, row.FDR, row.TPR) == (0.0, 0.0, 0.0, 1.0, 0.0)
    row = M.threshold_metrics(four, threshold=0.4).first()
    assert row.precision == pytest.approx(2 / 3) and row.recall == 1.0
    with pytest.raises(ValueError):
        M.metric_column("auc", "y", F.lit(True))


@pytest.mark.parametrize("n, step", [(7, 0.1), (100, 0.01), (1003, 0.0002)])
def test_curve_equals_direct_sums(spark, n, step):
    rng = random.Random(n)
    rows = [(i, rng.random(), rng.randint(0, 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, score double, y int")
    ordered = [r[2] for r in sorted(rows, key=lambda r: (-r[1], r[0]))]
    total = sum(ordered)
    curve = M.pr_curve(df, step).orderBy("point").collect()
    assert len(curve) == round(1 / step)
    for i, r in enumerate(curve):
        depth = int((step + i * step) * n)
        hits = sum(ordered[:depth])
        assert r.n == depth
        assert r.precision == (pytest.approx(hits / depth) if depth else None)
        assert r.recall == (pytest.approx(hits / total) if depth else None)


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in range(11)], "score double")
    assert [r.n for r in M.score_histogram(df, 5).orderBy("bin").collect()] == [2, 2, 2, 2, 3]
    flat = spark.createDataFrame([(2.0,)] * 4, "score double")
    got = M.score_histogram(flat, 4).orderBy("bin").collect()
    assert [r.n for r in got] == [0, 0, 4, 0] and got[0].left_edge == 1.5


def test_base_rates_reproduce_published_series(spark):
    total, passed = [3673, 3588, 3516, 3170], [372, 431, 321, 484]
    rows = [(b, int(i < p)) for b, (n, p) in enumerate(zip(total, passed), 1) for i in range(n)]
    got = M.base_rates(spark.createDataFrame(rows, "block_id int, y int"), ["block_id"]).orderBy("block_id").collect()
    assert [round(r.base_rate, 4) for r in got] == [0.1013, 0.1201, 0.0913, 0.1527]
    assert [round(r.best_precision, 4) for r in got] == [0.3379, 0.4006, 0.3046, 0.5089]


def test_importances_by_name(spark, four):
    got = M.feature_importances(four, ["a", "b", "c"], [0.1, 0.7, 0.2], 2).collect()
    assert [(r.feature, r.feature_index) for r in got] == [("b", 1), ("c", 2)]
    with pytest.raises(ValueError):
        M.feature_importances(four, ["a"], [0.1, 0.2])


def test_baseline_golden(spark):
    rows = spark.createDataFrame(
        [(1, 0, 10, "Passed"), (2, 1, 10, "Passed"), (1, 0, 11, "Failed")],
        "sponsor_id long, party_id int, bill_id long, status_new string",
    )
    model = RateBaseline.fit(rows)
    assert {r.sponsor_id: r.rate for r in model.sponsor_rates.collect()} == {1: 0.5, 2: 1.0}
    new = spark.createDataFrame([(1, 0, 12, ""), (3, 9, 12, "")], rows.schema)
    got = {r.bill_id: r.score for r in model.predict(rows.unionByName(new)).collect()}
    assert got[10] == pytest.approx(0.75) and got[12] == pytest.approx(0.625)


def test_baseline_counts_only_allowed_bills_and_weights_repeats(spark):
    schema = "sponsor_id long, party_id int, bill_id long, status_new string"
    rows = spark.createDataFrame([(1, 0, 10, "Passed"), (1, 0, 11, "Failed"), (1, 0, 11, "Failed")], schema)
    allowed = spark.createDataFrame([(10,)], "bill_id long")
    assert pass_rates(rows, "sponsor_id", allowed).first().rate == 1.0
    assert pass_rates(rows, "sponsor_id").first().rate == pytest.approx(1 / 3)
    mixed = spark.createDataFrame([(1, 0, 20, ""), (2, 0, 20, ""), (2, 0, 20, "")], schema)
    rates = spark.createDataFrame([(1, 1.0), (2, 0.25)], "sponsor_id long, rate double")
    party = spark.createDataFrame([(0, 1.0)], "party_id int, rate double")
    assert RateBaseline(rates, party).bill_rates(mixed).first().spr == pytest.approx(0.5)


def test_baseline_save_and_load(spark, tmp_path):
    rows = spark.createDataFrame([(1, 0, 10, "Passed")], "sponsor_id long, party_id int, bill_id long, status_new string")
    RateBaseline.fit(rows).save(str(tmp_path))
    assert RateBaseline.load(spark, str(tmp_path)).predict(rows).first().score == 1.0


DISTRICTS = [(1, "SD-017"), (1, "HD-029"), (2, "HD-016"), (3, "SD-050"), (4, "SD-013"), (4, "SD-008"), (5, "013")]


def test_groups_cover_all_bills_and_exclude_the_reference(spark):
    rows = spark.createDataFrame(DISTRICTS, "bill_id long, district string")
    parsed = G.parsed_districts(rows)
    assert {(r.chamber, r.number) for r in parsed.where("bill_id = 1").collect()} == {("upper", 17), ("lower", 29)}
    assert [r.district for r in G.bad_districts(rows).collect()] == ["013"]
    members = G.group_members(parsed, G.group_table(spark))
    assert members.where("bill_id = 1").count() == 1  # both chambers match, one row
    for everyone in (G.with_reference_group(parsed, members), G.audit_groups(parsed, G.group_table(spark))):
        rows = sorted((r.group, r.bill_id) for r in everyone.collect())
        assert rows == [("asian", 2), ("asian", 4), ("black", 1), ("black", 4), ("white", 3)]


def test_last_district_of_a_session_counts(spark):
    sponsors = spark.createDataFrame([(1, 7)], "bill_id long, sponsor_id long")
    bills = spark.createDataFrame([(1, 5)], "bill_id long, session_id long")
    people = spark.createDataFrame(
        [(5, 7, 13, "SD-001", 1), (5, 7, 13, "SD-002", 2), (6, 7, 13, "SD-003", 3), (5, 8, 14, "SD-004", 1)],
        "session_id long, person_id long, state_id int, district string, version int",
    )
    got = G.sponsor_districts(sponsors, bills, people, 13, order=["version"]).collect()
    assert [r.district for r in got] == ["SD-002"]
    assert G.sponsor_districts(sponsors, bills, people, 13, match_session=False).count() == 3


def test_disparities(spark):
    rows = [(m, g, f, t) for m, (g, f, t) in product((1, 2), (("white", 0.5, 0.4), ("black", 0.25, 0.6)))] + [(3, "white", 0.0, 0.1), (3, "black", 0.2, 0.1)]
    df = spark.createDataFrame(rows, "model int, `group` string, FDR double, TPR double")
    got = {(r.model, r.group): (r.FDR_disparity, r.TPR_disparity) for r in G.disparities(df, by=["model"]).collect()}
    assert got[(1, "black")] == (0.5, pytest.approx(1.5)) and got[(3, "black")][0] is None
    assert len(got) == 3


def test_profile(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b")], "x double, s string")
    assert {r.column: (r.total, r.missing) for r in P.missing_values(df).collect()} == {"x": (3, 2), "s": (3, 1)}
    box = P.box_plots(spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 100)], "x double"), ["x"]).first()
    assert (box.q1, box.median, box.q3, box.low_whisker, box.high_whisker, box.outliers) == (2.0, 3.0, 4.0, 1.0, 4.0, 1)
    pairs = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None)], "a double, b double")
    corr = {(r.a, r.b): r["corr"] for r in P.correlations(pairs, ["a", "b"]).collect()}
    assert len(corr) == 4 and corr[("b", "a")] == pytest.approx(1.0)


def test_relabelled_statuses(spark):
    rows = [(13, "Engrossed", 3, 1), (13, "Introduced", 0, 2), (13, "Passed", 5, 1), (13, None, 0, 1)]
    df = spark.createDataFrame(rows, "state_id int, status string, count_year int, seq int")
    got = {(r.kind, r.status): r.n for r in P.status_distributions(df, 13).collect()}
    assert got == {
        ("all", "Engrossed"): 1, ("all", "Introduced"): 1, ("all", "Passed"): 1,
        ("final", "Engrossed"): 1, ("final", "Passed"): 1,
        ("relabelled", "AssignFail"): 1, ("relabelled", "Passed"): 1,
    }


@pytest.mark.parametrize("k", [0.0, 0.01, 0.299, 0.999, 1.0])
def test_flag_top_is_the_ranked_top(spark, k):
    rng = random.Random(4)
    rows = [(i, rng.choice([None, 1.0, 2.0, round(rng.random(), 2)]), rng.choice(["a", "a", "a", "b", None]), i % 2) for i in range(3000)]
    rows += [(6000 + i, float(i), "hundred", 0) for i in range(100)]
    rows += [(5000 + i, 7.0, "ties", 1) for i in range(50)] + [(9000, 1.0, "one", 0)]
    df = spark.createDataFrame(rows, "id long, score double, g string, y int")
    for by in ([], ["g"]):
        want = {r.id: r.predicted for r in M.top_fraction(df.na.fill("none", ["g"]), k, by).collect()}
        got = {r.id: r.predicted for r in M.flag_top(df, k, by).collect()}
        assert got == want
