import random
from datetime import date, timedelta

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from foretell.features.spec import FeatureSpec
from foretell.models import classifiers as C
from foretell.plans import grid as GR
from foretell.plans.run import RunSettings, evaluation_series, model_report, model_scores, report_path, run
from foretell.features.fit import fit_features
from foretell.operators.metrics import base_rates, flag_top

SPEC = FeatureSpec(
    {
        "party_id": {"impute_fixed": 0, "one_hot": 3},
        "x": {"impute_mean": [], "normalize": []},
        "sponsors": {"sponsor_pass_rate": ["introduced_date", "status_new"], "impute_mean": []},
        "title": {"tfidf": []},
    }
)


@pytest.fixture(scope="module")
def facts(spark, tmp_path_factory):
    rng = random.Random(11)
    rows = []
    for i in range(700):
        x = rng.uniform(0, 100)
        status = "Passed" if x + rng.gauss(0, 15) > 60 else "Failed"
        day = date(2009, 1, 1) + timedelta(days=rng.randint(0, 365 * 7))
        rows.append((i, rng.randint(0, 2), x if i % 10 else None, f"{1 + i % 5}, {6 + i % 7}", day, rng.choice(["tax bill", "road", "tax road act"]), status))
    df = spark.createDataFrame(rows, "bill_id long, party_id int, x double, sponsors string, introduced_date date, title string, status_new string")
    path = str(tmp_path_factory.mktemp("facts") / "t")
    df.write.parquet(path)
    return spark.read.parquet(path)


def settings(**changes):
    return RunSettings(
        **{
            "model_type": "DTClassifier", "model_params": {"max_depth": 3}, "feature_type": "s",
            "start_year": 2009, "end_year": 2015, "feature_sets": {"s": SPEC}, "history": "all",
        } | changes
    )


def members_of(facts):
    name = F.element_at(F.array(*[F.lit(g) for g in ("white", "black", "asian")]), F.col("party_id") + 1)
    return facts.select(name.alias("group"), "bill_id")


def test_run_evaluates_every_block(spark, facts, tmp_path):
    results = run(facts, settings(reports=True, report_features=2), str(tmp_path), members_of(facts))
    rows = results.collect()
    assert {r.block_id for r in rows} == {1, 2}
    assert {(r.role, r.metric) for r in rows if r.group is None} == {(r, m) for r in ("train", "validation") for m in ("precision", "recall")}
    assert {r.metric for r in rows if r.group == "black"} == {"FDR", "TPR"}
    # the signal is strong, so the best-scored rows pass far more often than the base rate
    precision = [r.value for r in rows if r.metric == "precision" and r.role == "validation"]
    assert min(precision) > 0.6
    assert len(spark.read.parquet(f"{tmp_path}/text_vocab/title").collect()) == 4
    reports = {n: spark.read.parquet(report_path(str(tmp_path), 2, n)) for n in ("curve", "histogram", "importances", "cross_tabs")}
    assert reports["curve"].count() == 5000 and reports["importances"].orderBy("importance").collect()[-1].feature == "x"
    assert reports["cross_tabs"].count() == 2 and reports["histogram"].agg(F.sum("n")).first()[0] > 50
    stored = run(facts, settings(), str(tmp_path), members_of(facts), train_models=False)
    again = {tuple(r) for r in stored.collect()}
    assert again == {tuple(r) for r in rows if r.role == "validation"}


def test_run_is_repeatable_and_takes_blocks_from_settings(facts, tmp_path):
    light = FeatureSpec({k: SPEC.ops[k] for k in ("x", "sponsors")})
    short = settings(num_temporal_blocks=1, history="slice", feature_sets={"s": light})
    runs = [sorted(map(tuple, run(facts, short, str(tmp_path / n)).collect()), key=str) for n in ("a", "b")]
    assert runs[0] == runs[1] and {r[-1] for r in runs[0]} == {1}


def test_baseline_run(spark, facts, tmp_path):
    from foretell.operators.history import sponsors_from_list
    from foretell.operators.splits import with_block_columns

    bridge = sponsors_from_list(facts, "bill_id", "sponsors").join(facts.select("bill_id", "party_id", "status_new", "introduced_date"), "bill_id")
    rows = with_block_columns(bridge, "introduced_date", 2009, 2015, type_val=1)
    baseline = settings(model_type="Baseline")
    out = run(facts, baseline, str(tmp_path / "run"), sponsor_rows=rows)
    assert out.where("role = 'validation' and metric = 'recall'").count() == 2
    again = run(facts, baseline, str(tmp_path / "run"), sponsor_rows=rows, train_models=False)
    assert {r.role for r in again.select("role").distinct().collect()} == {"validation"}
    grid = GR.run_grid(facts, baseline, "Baseline", GR.parameter_grid({}), str(tmp_path / "grid"), sponsor_rows=rows)
    assert grid.where("metric = 'precision'").count() == 4
    labelled = facts.select(F.explode(F.array(F.lit(1), F.lit(2))).alias("block_id"), F.lit(1).alias("y"))
    series = GR.reference_series(labelled, results=grid)
    assert series.where("series = 'rate_baseline'").count() == 2 and series.count() == 6
    with pytest.raises(ValueError):
        GR.run_grid(facts, baseline, "Baseline", [{}], str(tmp_path / "none"))


@pytest.fixture(scope="module")
def numeric(facts):
    spec = FeatureSpec({k: SPEC.ops[k] for k in ("party_id", "x")})
    fitted = fit_features(facts, spec)
    return fitted, fitted.transform(facts).cache()


@pytest.mark.parametrize(
    "model_type, params",
    [
        ("LogRegClassifier", {"penalty": "l1", "C": 1, "class_weight": "balanced"}),
        ("SVMClassifier", {"C": 1, "kernel": "linear", "class_weight": "balanced", "max_iter": 10}),
        ("DTClassifier", {"criterion": "entropy", "max_depth": None}),
        ("RFClassifier", {"n_estimators": 5, "max_depth": 4, "max_features": "log2"}),
        ("MultiLabelNNClassifier", {"num_hidden_nodes_in_layers": [4], "epochs": 60, "activation": "sigmoid"}),
    ],
)
def test_models_rank_the_signal_and_reload(numeric, tmp_path, model_type, params):
    fitted, rows = numeric
    scores, notes = model_scores(fitted, rows, rows, model_type, params, str(tmp_path / "m"))
    pos = scores.where("role = 'train'").groupBy("y").agg(F.avg("score").alias("s")).collect()
    means = {r.y: r.s for r in pos}
    assert means[1] > means[0]
    assert ("max_depth None set to 30" in notes) == (model_type == "DTClassifier")


def test_regularisation_follows_the_row_count():
    estimator, _ = C.build_classifier("LogRegClassifier", {"penalty": "l2", "C": 10}, 200, 3)
    assert estimator.getRegParam() == pytest.approx(1 / 2000) and estimator.getElasticNetParam() == 0.0
    assert not estimator.getStandardization()


def test_unavailable_choices_are_errors():
    with pytest.raises(ValueError):
        C.build_classifier("SVMClassifier", {"kernel": "rbf"}, 10, 3)
    with pytest.raises(ValueError):
        C.build_classifier("Boosting", {}, 10, 3)
    with pytest.raises(ValueError):
        C.build_classifier("SVMClassifier", {}, 10, 3)  # unset means rbf
    deep = {"max_depth": 1000, "class_weight": "balanced"}
    with pytest.raises(ValueError, match="max_depth 1000"):
        C.build_classifier("RFClassifier", deep, 10, 3)
    _, notes = C.build_classifier("RFClassifier", deep, 10, 3, accept_limits=True)
    assert notes == ["max_depth 1000 set to 30"]
    for params in ({}, {"activation": "relu"}, {"activation": "sigmoid", "class_weight": "balanced"}):
        with pytest.raises(ValueError):
            C.effective_parameters("MultiLabelNNClassifier", params)
    used, notes = C.effective_parameters("MultiLabelNNClassifier", {"class_weight": "balanced"}, True)
    assert used["activation"] == "sigmoid" and "class_weight" not in used and len(notes) == 2


def test_published_grids_name_their_models():
    distinct = {m: GR.split_grid(m, GR.parameter_grid(r), True) for m, r in GR.MODEL_GRID.items()}
    assert {m: len(u) for m, (u, _) in distinct.items()} == {"DTClassifier": 12, "RFClassifier": 24, "SVMClassifier": 10, "LogRegClassifier": 20, "Baseline": 1}
    assert {m: len(o) for m, (_, o) in distinct.items() if o} == {"SVMClassifier": 30}
    assert sum(len(p) for p in distinct["RFClassifier"][0].values()) == 96


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0.0,)] * 3 + [(1.0,)], "label double")
    got = {r.label: r.w for r in df.select("label", C.balanced_weights(df).alias("w")).collect()}
    assert got == pytest.approx({0.0: 4 / 6, 1.0: 2.0})


def test_report_and_series(facts, numeric):
    fitted, rows = numeric
    model, _ = C.fit_classifier("DTClassifier", {"max_depth": 3}, rows, 4)
    scores = C.predict_scores(model, rows)
    heavy, tabs = model_report(model, fitted, rows, scores, settings(), top_n=2)
    assert heavy.first().feature == "x"
    assert {r.is_top for r in tabs.collect()} == {True, False} and "x" in tabs.columns
    curve, histogram = evaluation_series(scores, "bill_id")
    assert curve.count() == 5000 and histogram.agg(F.sum("n")).first()[0] == 700


def test_grid_sizes():
    sizes = {m: len(GR.parameter_grid(r)) for m, r in GR.MODEL_GRID.items()}
    assert sizes == {"DTClassifier": 32, "RFClassifier": 96, "SVMClassifier": 80 // 2, "LogRegClassifier": 40, "Baseline": 1}


def test_grid_appends_and_ranks(spark, facts, tmp_path):
    work = str(tmp_path)
    light = settings(feature_sets={"s": FeatureSpec({"x": {"impute_mean": []}})})
    members = members_of(facts)
    GR.run_grid(facts, light, "DTClassifier", [{"max_depth": 1}, {"max_depth": 3}], work, members)
    assert GR.next_model_index(spark, f"{work}/results", "s", "DTClassifier") == 3
    results = GR.run_grid(facts, light, "DTClassifier", [{"max_depth": 2}], work, members)
    assert {r.model_idx for r in results.select("model_idx").distinct().collect()} == {1, 2, 3}
    assert GR.next_model_index(spark, f"{work}/results", "s", "RFClassifier") == 1
    best = GR.leader_board(results, top=2).collect()
    assert len(best) == 2 and best[0].value >= best[1].value
    assert {r.place for r in GR.family_leaders(results, top=2).collect()} == {1, 2}
    board = GR.score_versus_disparity(results).collect()
    assert {r.group for r in board} == {"black", "asian"} and len(board) == 6
    series = GR.reference_series(facts.select(F.lit(1).alias("block_id"), (F.col("status_new") == "Passed").cast("int").alias("y")))
    assert {r.series for r in series.collect()} == {"base_rate", "best_precision"}
    with pytest.raises(ValueError):
        GR.run_grid(facts, light, "SVMClassifier", [{"kernel": "poly"}], work)
    limits = settings(feature_sets={"s": FeatureSpec({"x": {"impute_mean": []}})}, accept_limits=True, num_temporal_blocks=1)
    same = GR.run_grid(facts, limits, "LogRegClassifier", [{"C": 1}, {"C": 1, "solver": "saga"}, {"penalty": "elastic"}], work)
    same = same.where("model_type = 'LogRegClassifier'").collect()
    assert {r.metric for r in same if r.model_idx == 3} == {"not_run"} and {r.notes for r in same if r.model_idx == 2} == {"solver saga is not a choice here"}
    one, two = ([(r.role, r.metric, r.value) for r in same if r.model_idx == k] for k in (1, 2))
    assert sorted(one) == sorted(two) and len({r.effective for r in same if r.model_idx < 3}) == 1
    assert base_rates(facts.withColumn("y", F.lit(1)), ["party_id"]).count() == 3


def test_settings_from_configuration():
    config = {
        "model_type": "RFClassifier", "model_info": {"RFClassifier": {"n_estimators": 7}},
        "query": {"train": {"start_year": 2009, "end_year": 2019}},
        "transform": {"ops": {"bill_id": []}, "year_col": "introduced_date"},
        "split": {"update_freq": 2, "num_temporal_blocks": 4, "split_list": [2, 1, 1, 1], "split_type": 1},
        "feature_type": "mine", "label_type": "binary",
        "feature_info": {"mine": {"feature_ops": {"a": {"impute_mean": []}}, "index_col_name": "id", "label_col_name": "s"}},
        "evaluate_params": {"top_k_fraction": 0.3, "bias_analysis": {"metrics": ["FDR"]}},
    }
    got = RunSettings.from_config(config)
    assert got.spec.id_column == "id" and got.model_params == {"n_estimators": 7} and got.bias_metrics == ("FDR",) and got.reports
    config["evaluate_params"] |= {"metrics": ["recall"], "bias_analysis": {"use": True, "groups": ["black"], "metrics": ["TPR"]}, "feature_importances": {"top_n": 3}}
    again = RunSettings.from_config(config)
    assert (again.metrics, again.bias_groups, again.report_features) == (("recall",), ("black",), 3)


def test_queries_of_a_configuration(spark):
    from foretell.plans.run import QueryStep, run_queries
    from foretell.sources.tables import run_sql

    config = {
        "model_type": "DTClassifier", "model_info": {}, "feature_type": "m", "label_type": "binary", "transform": {"ops": {}},
        "query": {
            "name": ["map_bill_to_state_query", "rank_by_bill_count_query"], "schema_name": ["q_stage", "q_stage"], "table_name": ["placed", "ranked"],
            "train": {"start_year": "2009", "end_year": 2010}, "test": {"start_year": 2011, "end_year": 2011},
        },
        "split": {"update_freq": 2, "split_list": [2, 1, 1, 1], "split_type": 1}, "feature_info": {},
        "evaluate_params": {"top_k_fraction": 0.3, "bias_analysis": {"metrics": []}},
    }
    chosen = RunSettings.from_config(config)
    assert chosen.queries == (QueryStep("map_bill_to_state_query", "q_stage", "placed"), QueryStep("rank_by_bill_count_query", "q_stage", "ranked"))
    bills = spark.createDataFrame([(k, k % 2, date(2009 + k % 3, 1, 1)) for k in range(30)], "bill_id long, session_id long, introduced_date date")
    sessions = spark.createDataFrame([(0, 13), (1, 14)], "session_id long, state_id int")
    states = spark.createDataFrame([(13, "IL"), (14, "IN")], "state_id int, state_abbreviation string")
    relations = {"bills": bills, "sessions": sessions, "states": states}
    for predict, n in ((False, 20), (True, 10)):
        last = run_queries(spark, relations, chosen, predict=predict)
        assert sum(r["count"] for r in last.collect()) == n and last.columns[0] == "state_id"
        assert run_sql(spark, "SELECT * FROM q_stage.placed").count() == n
    with pytest.raises(ValueError, match="unheard"):
        run_queries(spark, relations, settings(queries=[QueryStep("unheard", "a", "b")]))
    with pytest.raises(ValueError):
        run_queries(spark, relations, settings())
    config["query"]["table_name"] = ["placed"]
    with pytest.raises(ValueError, match="do not match"):
        RunSettings.from_config(config)


def test_network_loss_does_not_depend_on_blocks(spark):
    rows = spark.createDataFrame([(i, Vectors.dense([float(i % 2)]), float(i % 7 == 0)) for i in range(131)], ["bill_id", "features", "label"])
    params = {"num_hidden_nodes_in_layers": [3], "activation": "sigmoid", "epochs": 200}
    scores = {}
    for parts in (1, 3):
        model, _ = C.fit_classifier("MultiLabelNNClassifier", params, rows.repartition(parts), 1)
        scores[parts] = {r.bill_id % 2: r.score for r in C.predict_scores(model, rows).collect()}
    rates = {r.odd: r.rate for r in rows.groupBy((F.col("bill_id") % 2).alias("odd")).agg(F.avg("label").alias("rate")).collect()}
    assert all(abs(scores[p][k] - rates[k]) < 0.01 for p in scores for k in rates)


def test_families_of_a_grid_share_facts_and_features(spark, facts, tmp_path, monkeypatch):
    done = []
    for name in ("written_facts", "block_features"):
        def counted(*args, _name=name, _call=getattr(GR, name)):
            done.append(_name)
            return _call(*args)
        monkeypatch.setattr(GR, name, counted)
    light = settings(feature_sets={"s": FeatureSpec({"x": {"impute_mean": []}})}, num_temporal_blocks=1)
    grids = {"DTClassifier": [{"max_depth": 1}], "LogRegClassifier": [{"C": 1}]}
    both = GR.run_grids(facts, light, grids, str(tmp_path / "both"), members_of(facts))
    assert done == ["written_facts", "block_features"]
    shown = ("model_type", "model_idx", "role", "group", "metric", "value")
    apart = []
    for family, grid in grids.items():
        apart = GR.run_grid(facts, light, family, grid, str(tmp_path / "apart"), members_of(facts))
    rows = [sorted(map(str, df.select(*shown).collect())) for df in (both, apart)]
    assert rows[0] == rows[1] and len(rows[0]) == 2 * (4 + 6)


def test_few_groups_are_broadcast(spark):
    scores = spark.range(1000).select("id", (F.col("id") % 7 / 7).alias("score"), F.lit(1).alias("y"), F.when(F.col("id") > 500, "a").alias("role"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = flag_top(scores, 0.3, ["role"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
