"""Registered queries: the rate baseline, classifiers per block, model grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from foretell.features.fit import block_features
from foretell.features.spec import FeatureSpec
from foretell.models.classifiers import (
    balanced_weights,
    fit_classifier,
    load_model,
    predict_scores,
    save_model,
)
from foretell.operators.baseline import RateBaseline
from foretell.operators.metrics import feature_importances
from foretell.operators.splits import TRAIN, VALIDATION, block_slice, long_blocks, with_block_columns
from foretell.plans import grid as GR
from foretell.plans.catalog_features import MIXED_SPEC, YEARS, blocked_facts
from foretell.plans.catalog_relational import BLOCK_ROLES, role_sql
from foretell.plans.registry import query, rounded
from foretell.plans.run import RunSettings, baseline_scores, run
from foretell.plans.standins import sql_with
from foretell.session import scratch_path, small_table

RATE_OF = "avg(CASE WHEN status_new = 'Passed' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"
BASELINE_VIEWS = {
    "blocked": f"SELECT *, {role_sql(1, 1)} AS role FROM sponsor_status",
    "s_rate": f"SELECT sponsor_id, {RATE_OF} AS r FROM blocked WHERE role = 1 GROUP BY 1",
    "p_rate": f"SELECT party_id, {RATE_OF} AS r FROM blocked WHERE role = 1 GROUP BY 1",
}
BASELINE_SCORES = """
    SELECT bill_id, round(sqrt(avg(coalesce(s.r, (SELECT avg(r) FROM s_rate))) * avg(coalesce(p.r, (SELECT avg(r) FROM p_rate)))), 6) AS score
    FROM blocked LEFT JOIN s_rate s USING (sponsor_id) LEFT JOIN p_rate p USING (party_id)"""


def blocked_sponsors(t):
    return with_block_columns(t.sponsor_status, "introduced_date", *YEARS, update_freq=1, type_val=1)


@query(
    "K1_rate_baseline",
    sql_with("sponsor_status", f"{BASELINE_SCORES} GROUP BY bill_id", **BASELINE_VIEWS),
)
def k1(t):
    """Fitted on block 2's training rows, scores for every bill."""
    rows = blocked_sponsors(t)
    return rounded(RateBaseline.fit(block_slice(rows, 2, TRAIN)).predict(rows), "score")


@query(
    "K1_rate_baseline_validation",
    sql_with(
        "sponsor_status",
        f"SELECT bill_id, score, y FROM ({BASELINE_SCORES} WHERE role = 3 GROUP BY bill_id) "
        "JOIN (SELECT bill_id, max(CASE WHEN status_new = 'Passed' THEN 1 ELSE 0 END) AS y FROM sponsor_status GROUP BY 1) USING (bill_id)",
        **BASELINE_VIEWS,
    ),
)
def k1_validation(t):
    scores = baseline_scores(blocked_sponsors(t), 2, scratch_path(t.spark, "baseline"))
    return rounded(scores.where("role = 'validation'").drop("role"), "score")


SMALL_SPEC = FeatureSpec(
    {k: MIXED_SPEC.ops[k] for k in ("party_id", "introduced_body", "introduced_date", "introduced_date::2", "sponsors", "sponsor_count")}
)


_FEATURES: dict[tuple, tuple] = {}


def written_features(t):
    """Fitted features of block 2 and its two slices, written once per session and data folder."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _FEATURES:
        fitted, train, valid = block_features(blocked_facts(t), SMALL_SPEC, 2, history="all")
        path = scratch_path(t.spark, "features")
        train.write.parquet(f"{path}/train")
        valid.write.parquet(f"{path}/validation")
        _FEATURES[key] = fitted, path
    fitted, path = _FEATURES[key]
    return fitted, t.spark.read.parquet(f"{path}/train"), t.spark.read.parquet(f"{path}/validation")


def scored(t, model_type, params):
    fitted, train, valid = written_features(t)
    model, _ = fit_classifier(model_type, params, train, len(fitted.feature_names()))
    return predict_scores(model, valid)


@query("K2_logistic_regression")
def k2(t):
    return scored(t, "LogRegClassifier", {"penalty": "l2", "C": 1, "class_weight": "balanced"})


@query("K3_decision_tree")
def k3(t):
    return scored(t, "DTClassifier", {"criterion": "entropy", "max_depth": 5, "class_weight": "balanced"})


@query("K4_random_forest")
def k4(t):
    return scored(t, "RFClassifier", {"n_estimators": 10, "max_depth": 5, "max_features": "sqrt"})


@query("K5_linear_svm")
def k5(t):
    return scored(t, "SVMClassifier", {"C": 1, "kernel": "linear"})


@query("K6_feed_forward_net")
def k6(t):
    return scored(t, "MultiLabelNNClassifier", {"num_hidden_nodes_in_layers": [6, 4], "activation": "sigmoid", "epochs": 20})


@query(
    "K7_balanced_class_weights",
    sql_with(
        "outcomes",
        "SELECT bill_id, round((SELECT count(*) FROM outcomes)::DOUBLE / (2 * count(*) OVER (PARTITION BY status_new)), 6) AS weight FROM outcomes",
    ),
)
def k7(t):
    rows = t.outcomes.withColumn("label", (F.col("status_new") == "Passed").cast("int"))
    return rounded(rows.select("bill_id", balanced_weights(rows).alias("weight")), "weight")


@query("K8_train_save_load_predict")
def k8(t):
    """Every block: train, save, load, score and evaluate both roles."""
    settings = RunSettings(
        model_type="DTClassifier", model_params={"max_depth": 4}, feature_type="small",
        start_year=YEARS[0], end_year=YEARS[1], update_freq=2, history="all",
        feature_sets={"small": SMALL_SPEC},
    )
    return run(t.facts, settings, scratch_path(t.spark, "model"))


@query("M6_feature_importances")
def m6(t):
    fitted, train, _ = written_features(t)
    model, _ = fit_classifier("DTClassifier", {"max_depth": 5}, train, len(fitted.feature_names()))
    path = scratch_path(t.spark, "tree")
    save_model(model, path)
    weights = load_model(path).featureImportances.toArray()
    return feature_importances(train, fitted.feature_names(), weights, 5)


_GRIDS: dict[tuple, str] = {}


def grid_results(t):
    """Results of a small grid, run once per session and data folder."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _GRIDS:
        _GRIDS[key] = scratch_path(t.spark, "grid")
        settings = RunSettings(
            feature_type="small", start_year=YEARS[0], end_year=YEARS[1], update_freq=2, history="all",
            feature_sets={"small": SMALL_SPEC},
        )
        members = t.bills.join(t.sessions, "session_id").select(
            F.when(F.col("state_id") % 3 == 0, "white").when(F.col("state_id") % 3 == 1, "black").otherwise("asian").alias("group"),
            "bill_id",
        )
        ranges = {"DTClassifier": {"max_depth": [2, 4]}, "LogRegClassifier": {"C": [0.1, 1]}}
        GR.run_grids(t.facts, settings, {family: GR.parameter_grid(r) for family, r in ranges.items()}, _GRIDS[key], members)
    return GR.read_results(t.spark, f"{_GRIDS[key]}/results")


@query("G1_grid_results")
def g1(t):
    return grid_results(t)


@query("G2_next_model_index")
def g2(t):
    grid_results(t)
    path = f"{_GRIDS[t.spark.sparkContext.applicationId, t.sf_dir]}/results"
    families = ("DTClassifier", "LogRegClassifier", "RFClassifier", "Baseline")
    rows = [("small", m, GR.next_model_index(t.spark, path, "small", m)) for m in families]
    return small_table(t.spark, rows, "feature_type string, model_type string, next_idx int")


@query("G3_results_per_family")
def g3(t):
    return grid_results(t).where("model_type = 'DTClassifier'").groupBy("model_idx", "block_id", "role").agg(
        F.count("*").alias("n_metrics")
    )


@query("R6_best_models")
def r6_models(t):
    return GR.leader_board(grid_results(t), top=3)


@query("R8_top_importances")
def r8(t):
    return m6(t)


@query("G4_family_leaders")
def g4(t):
    return GR.family_leaders(grid_results(t), top=1)


@query(
    "G4_reference_series",
    sql_with(
        "outcomes",
        "UNPIVOT (SELECT block_id, round(avg(y), 6) AS base_rate, "
        "round(least(sum(y)::DOUBLE / floor(count(*) * 0.3::DOUBLE), 1), 6) AS best_precision "
        "FROM (SELECT *, CASE WHEN status_new = 'Passed' THEN 1 ELSE 0 END AS y FROM roles WHERE role = 3) GROUP BY 1) "
        "ON base_rate, best_precision INTO NAME series VALUE value",
        roles=BLOCK_ROLES,
    ),
)
def g4_series(t):
    rows = long_blocks(with_block_columns(t.outcomes, "introduced_date", *YEARS, update_freq=1, type_val=1))
    valid = rows.where(F.col("role") == VALIDATION).withColumn("y", (F.col("status_new") == "Passed").cast("int"))
    return rounded(GR.reference_series(valid), "value")


@query("G5_score_versus_disparity")
def g5(t):
    return GR.score_versus_disparity(grid_results(t))


# models on one two-valued column: what they learn can be said in SQL

STUMP_SPEC = FeatureSpec({"introduced_body": {"impute_fixed": "H", "one_hot": ["H"]}})
STUMP_TREE = {"max_depth": 1, "class_weight": "balanced"}
STUMP_BLOCKS = ((1, 0), (2, 2))  # block and the years that it skips


def stump_views(blocks=STUMP_BLOCKS) -> dict[str, str]:
    """Balanced share of passed bills per chamber, learnt in each block's training years."""
    rows = " UNION ALL ".join(
        f"SELECT bill_id, introduced_body, CASE WHEN status_new = 'Passed' THEN 1 ELSE 0 END AS y, {b} AS block_id, {role_sql(skip, 1)} AS role FROM facts"
        for b, skip in blocks
    )
    return {
        "stump_rows": rows,
        "stump_leaves": "SELECT block_id, introduced_body, p / tp / (p / tp + q / tq) AS share, p / (p + q) AS rate FROM ("
        "SELECT block_id, introduced_body, sum(y)::DOUBLE AS p, sum(1 - y)::DOUBLE AS q, sum(sum(y)::DOUBLE) OVER (PARTITION BY block_id) AS tp, "
        "sum(sum(1 - y)::DOUBLE) OVER (PARTITION BY block_id) AS tq FROM stump_rows WHERE role = 1 GROUP BY 1, 2)",
        "stump_scores": "SELECT bill_id, block_id, CASE role WHEN 1 THEN 'train' ELSE 'validation' END AS role, y, share, rate "
        "FROM stump_rows JOIN stump_leaves USING (block_id, introduced_body) WHERE role IN (1, 3)",
    }


def stump_sql(columns: str) -> str:
    """Validation rows of the block that skips one year, as ``blocked_facts`` numbers it."""
    return sql_with(
        "facts", f"SELECT bill_id, {columns} FROM stump_scores WHERE role = 'validation'", **stump_views(((2, 1),))
    )


_STUMPS: dict[tuple, tuple] = {}


def stump_features(t):
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _STUMPS:
        fitted, train, valid = block_features(blocked_facts(t), STUMP_SPEC, 2)
        path = scratch_path(t.spark, "stump")
        train.write.parquet(f"{path}/train")
        valid.write.parquet(f"{path}/validation")
        _STUMPS[key] = fitted, path
    fitted, path = _STUMPS[key]
    return fitted, t.spark.read.parquet(f"{path}/train"), t.spark.read.parquet(f"{path}/validation")


def stump_scores(t, model_type, params):
    fitted, train, valid = stump_features(t)
    model, _ = fit_classifier(model_type, params, train, len(fitted.feature_names()))
    return predict_scores(model, valid)


@query("K2_logistic_on_chamber", stump_sql("round(share, 2) AS score, y"))
def k2_stump(t):
    """Nearly unpenalised, so the two fitted probabilities are the two balanced shares."""
    rows = stump_scores(t, "LogRegClassifier", {"C": 1e6, "class_weight": "balanced", "max_iter": 500})
    return rows.withColumn("score", F.round("score", 2))


@query("K3_tree_on_chamber", stump_sql("round(share, 6) AS score, y"))
def k3_stump(t):
    return rounded(stump_scores(t, "DTClassifier", STUMP_TREE), "score")


@query("K4_forest_on_chamber", stump_sql("round(share, 6) AS share, true AS near, y"))
def k4_stump(t):
    """Trees on bootstrap samples come near the tree on all rows, which is the balanced share."""
    tree = stump_scores(t, "DTClassifier", STUMP_TREE).select("bill_id", F.col("score").alias("share"))
    rows = stump_scores(t, "RFClassifier", STUMP_TREE | {"n_estimators": 50}).join(tree, "bill_id")
    near = F.abs(F.col("score") - F.col("share")) < 0.05
    return rounded(rows.select("bill_id", "share", near.alias("near"), "y"), "share")


@query("K5_margin_on_chamber", stump_sql("share > 0.5 AS passes, y"))
def k5_stump(t):
    """The margin's sign is the balanced majority of the chamber."""
    rows = stump_scores(t, "SVMClassifier", {"C": 1, "kernel": "linear", "class_weight": "balanced", "max_iter": 500})
    return rows.select("bill_id", (F.col("score") > 0).alias("passes"), "y")


@query("K6_net_on_chamber", stump_sql("round(rate, 2) AS score, y"))
def k6_stump(t):
    """A small network learns the chambers' pass rates: every row weighs the same in its loss."""
    rows = stump_scores(t, "MultiLabelNNClassifier", {"num_hidden_nodes_in_layers": [3], "activation": "sigmoid", "epochs": 300})
    return rows.withColumn("score", F.round("score", 2))


@query("M6_importance_of_chamber", sql_with(
    "facts", "SELECT 0 AS feature_index, 'introduced_body_H' AS feature, CASE WHEN max(share) > min(share) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS importance FROM stump_leaves",
    **stump_views(((2, 1),))))
def m6_stump(t):
    """All of a one-split tree's importance is its feature's; the name comes from the specification."""
    fitted, train, _ = stump_features(t)
    model, _ = fit_classifier("DTClassifier", STUMP_TREE, train, len(fitted.feature_names()))
    return feature_importances(train, fitted.feature_names(), model.featureImportances.toArray(), 5)


TWO_LEVELS = FeatureSpec({"introduced_body": {"impute_fixed": "H", "one_hot": ["H"]}, "party_id": {"impute_fixed": 0, "one_hot": 3}})
_TWO_LEVEL_NAMES = ("introduced_body_H", "party_id_0", "party_id_1", "party_id_2")
_GINI = "(1 - ({p} / ({p} + {q})) ** 2 - ({q} / ({p} + {q})) ** 2)"


def _best_split(stats: str, keys: str = "") -> str:
    """Best feature of each node by weighted impurity decrease; ``stats`` has weights p, q by node, feature and value."""
    by = f"{keys}, feature" if keys else "feature"
    total = _GINI.format(p="(p0 + p1)", q="(q0 + q1)")
    parts = " - ".join(f"(p{v} + q{v}) / (p0 + q0 + p1 + q1) * {_GINI.format(p=f'p{v}', q=f'q{v}')}" for v in (0, 1))
    both = f"SELECT {by}, " + ", ".join(f"sum({c}) FILTER (v = {v}) AS {c}{v}" for c in "pq" for v in (0, 1)) + f" FROM {stats} GROUP BY {by} HAVING count(*) = 2"
    order = f"PARTITION BY {keys} " if keys else ""
    return (
        f"SELECT *, p0 + q0 + p1 + q1 AS n FROM (SELECT *, row_number() OVER ({order}ORDER BY gain DESC, feature) AS place FROM "
        f"(SELECT *, {total} - {parts} AS gain FROM ({both}))) WHERE place = 1"
    )


TWO_LEVEL_VIEWS = {
    "tree_rows": f"""SELECT bill_id, y, CASE y WHEN 1 THEN count(*) OVER () / (2 * sum(y) OVER ())::DOUBLE
        ELSE count(*) OVER () / (2 * (count(*) OVER () - sum(y) OVER ()))::DOUBLE END AS w, introduced_body, party_id
        FROM (SELECT *, CASE WHEN status_new = 'Passed' THEN 1 ELSE 0 END AS y, {role_sql(1, 1)} AS role FROM facts) WHERE role = 1""",
    "tree_long": " UNION ALL ".join(
        f"SELECT bill_id, y, w, {k} AS feature, CASE WHEN {test} THEN 1 ELSE 0 END AS v FROM tree_rows"
        for k, test in enumerate(("introduced_body = 'H'", "party_id = 0", "party_id = 1", "party_id = 2"))
    ),
    "root_stats": "SELECT feature, v, sum(w * y) AS p, sum(w * (1 - y)) AS q FROM tree_long GROUP BY 1, 2",
    "root": _best_split("root_stats"),
    "tree_nodes": "SELECT bill_id, v AS node FROM tree_long WHERE feature = (SELECT feature FROM root)",
    "child_stats": "SELECT node, feature, v, sum(w * y) AS p, sum(w * (1 - y)) AS q FROM tree_long JOIN tree_nodes USING (bill_id) GROUP BY 1, 2, 3",
    # leaves of one prediction are merged again
    "kept": f"SELECT * FROM ({_best_split('child_stats', 'node')}) WHERE gain > 0 AND (p0 > q0) <> (p1 > q1)",
    "parts": """SELECT feature, gain * n AS part FROM kept UNION ALL SELECT feature, gain * n FROM root
        WHERE gain > 0 AND ((p0 > q0) <> (p1 > q1) OR (SELECT count(*) FROM kept) > 0)""",
}


@query("R8_top_of_ranked_weights", sql_with(
    "facts", "SELECT feature AS feature_index, name AS feature, round(coalesce(s, 0) / nullif(sum(s) OVER (), 0), 6) AS importance FROM "
    "(VALUES " + ", ".join(f"({k}, '{n}')" for k, n in enumerate(_TWO_LEVEL_NAMES)) + ") AS names(feature, name) "
    "LEFT JOIN (SELECT feature, sum(part) AS s FROM parts GROUP BY 1) USING (feature) ORDER BY importance DESC, feature_index LIMIT 2",
    **TWO_LEVEL_VIEWS))
def r8_ranked(t):
    """The two heaviest of four two-valued features of a tree of two levels."""
    fitted, train, _ = block_features(blocked_facts(t), TWO_LEVELS, 2)
    model, _ = fit_classifier("DTClassifier", {"max_depth": 2, "class_weight": "balanced"}, train, len(fitted.feature_names()))
    return rounded(feature_importances(train, fitted.feature_names(), model.featureImportances.toArray(), 2), "importance")


def stump_settings():
    return RunSettings(
        model_type="DTClassifier", model_params=STUMP_TREE, feature_type="stump",
        start_year=YEARS[0], end_year=YEARS[1], update_freq=2, feature_sets={"stump": STUMP_SPEC},
    )


STUMP_RANKED = """SELECT *, row_number() OVER (PARTITION BY block_id, role ORDER BY share DESC, bill_id)
    <= CAST(floor(0.3::DOUBLE * count(*) OVER (PARTITION BY block_id, role)) AS BIGINT) AS top FROM stump_scores"""
STUMP_OVERALL = """UNPIVOT (SELECT block_id, role, round(sum(y) FILTER (top)::DOUBLE / count(*) FILTER (top), 6) AS "precision",
    round(sum(y) FILTER (top)::DOUBLE / sum(y), 6) AS recall FROM stump_ranked GROUP BY 1, 2) ON "precision", recall INTO NAME metric VALUE value"""
STUMP_MEMBERS = """SELECT bill_id, CASE state_id % 3 WHEN 0 THEN 'white' WHEN 1 THEN 'black' ELSE 'asian' END AS "group"
    FROM bills JOIN sessions USING (session_id)"""
STUMP_GROUPS = """UNPIVOT (SELECT block_id, role, "group", round(1 - coalesce(sum(y) FILTER (top)::DOUBLE / nullif(count(*) FILTER (top), 0), 0), 6) AS FDR,
    round(coalesce(sum(y) FILTER (top)::DOUBLE / nullif(sum(y), 0), 0), 6) AS TPR FROM stump_ranked JOIN stump_members USING (bill_id)
    WHERE role = 'validation' GROUP BY 1, 2, 3) ON FDR, TPR INTO NAME metric VALUE value"""
STUMP_EVALUATED = stump_views() | {
    "stump_ranked": STUMP_RANKED, "stump_members": STUMP_MEMBERS, "stump_overall": f"SELECT * FROM ({STUMP_OVERALL})", "stump_groups": f"SELECT * FROM ({STUMP_GROUPS})",
}


@query("K8_run_on_chamber", sql_with("facts", "SELECT block_id, role, metric, value FROM stump_overall", **{k: v for k, v in STUMP_EVALUATED.items() if k not in ("stump_members", "stump_groups")}))
def k8_stump(t):
    """Every block of a run: train, save, load, score, evaluate."""
    results = run(t.facts, stump_settings(), scratch_path(t.spark, "stump-run"))
    return rounded(results.select("block_id", "role", "metric", "value"), "value")


_STUMP_GRIDS: dict[tuple, str] = {}


def stump_grid(t):
    """A grid of two families: two parameter sets that are one tree, and a regression of the same order of scores."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _STUMP_GRIDS:
        _STUMP_GRIDS[key] = scratch_path(t.spark, "stump-grid")
        members = t.bills.join(t.sessions, "session_id").select(
            F.when(F.col("state_id") % 3 == 0, "white").when(F.col("state_id") % 3 == 1, "black").otherwise("asian").alias("group"),
            "bill_id",
        )
        grid = [STUMP_TREE, STUMP_TREE | {"criterion": "gini"}]
        grids = {"DTClassifier": grid, "LogRegClassifier": [{"C": 1e6, "class_weight": "balanced", "max_iter": 500}]}
        GR.run_grids(t.facts, stump_settings(), grids, _STUMP_GRIDS[key], members)
    return GR.read_results(t.spark, f"{_STUMP_GRIDS[key]}/results")


MODELS = "(VALUES ('DTClassifier', 1), ('DTClassifier', 2), ('LogRegClassifier', 1)) AS m(model_type, model_idx)"


def grid_sql(body: str) -> str:
    return sql_with("facts bills sessions", body, **STUMP_EVALUATED)


@query("G1_grid_on_chamber", grid_sql(
    'SELECT model_type, model_idx, block_id, role, NULL::VARCHAR AS "group", metric, value FROM stump_overall, ' + MODELS
    + ' UNION ALL SELECT model_type, model_idx, block_id, role, "group", metric, value FROM stump_groups, ' + MODELS))
def g1_stump(t):
    rows = stump_grid(t).select("model_type", "model_idx", "block_id", "role", "group", "metric", "value")
    return rounded(rows, "value")


@query("G2_next_index_per_family", grid_sql(
    "SELECT family AS model_type, CAST(1 + count(DISTINCT model_idx) AS INTEGER) AS next_idx FROM (VALUES ('DTClassifier'), ('LogRegClassifier'), ('Baseline')) AS f(family) "
    f"LEFT JOIN (SELECT DISTINCT model_type, model_idx FROM stump_overall, {MODELS} WHERE value IS NOT NULL) ON model_type = family GROUP BY 1"))
def g2_stump(t):
    stump_grid(t)
    path = f"{_STUMP_GRIDS[t.spark.sparkContext.applicationId, t.sf_dir]}/results"
    rows = [(m, GR.next_model_index(t.spark, path, "stump", m)) for m in ("DTClassifier", "LogRegClassifier", "Baseline")]
    return small_table(t.spark, rows, "model_type string, next_idx int")


@query("G3_rows_per_family", grid_sql(
    "SELECT model_type, count(DISTINCT model_idx) AS models, count(*) AS n_rows FROM (SELECT block_id, role, metric FROM stump_overall "
    "UNION ALL SELECT block_id, role, metric FROM stump_groups), " + MODELS + " GROUP BY 1"))
def g3_stump(t):
    return stump_grid(t).groupBy("model_type").agg(F.countDistinct("model_idx").alias("models"), F.count("*").alias("n_rows"))


LAST = "metric = 'precision' AND role = 'validation' AND block_id = 2"


@query("R6_best_of_chamber_grid", grid_sql(f"SELECT 'stump' AS feature_type, model_type, model_idx, value FROM stump_overall, {MODELS} WHERE {LAST} ORDER BY value DESC, 2, 3 LIMIT 2"))
def r6_stump(t):
    return rounded(GR.leader_board(stump_grid(t), top=2), "value")


@query("G4_leaders_of_chamber_grid", grid_sql(
    f"SELECT 'stump' AS feature_type, model_type, model_idx, 1 AS place, block_id, value FROM stump_overall, {MODELS} "
    "WHERE metric = 'precision' AND role = 'validation' AND model_idx = 1"))
def g4_stump(t):
    return rounded(GR.family_leaders(stump_grid(t), top=1), "value")


@query("G5_disparity_of_chamber_grid", grid_sql(
    "SELECT 'stump' AS feature_type, model_type, model_idx, \"group\", round(f / nullif(wf, 0), 4) AS FDR_disparity, round(r / nullif(wr, 0), 4) AS TPR_disparity, score FROM ("
    "SELECT \"group\", max(value) FILTER (metric = 'FDR') AS f, max(value) FILTER (metric = 'TPR') AS r FROM stump_groups WHERE block_id = 2 GROUP BY 1) g, ("
    "SELECT max(value) FILTER (metric = 'FDR') AS wf, max(value) FILTER (metric = 'TPR') AS wr FROM stump_groups WHERE block_id = 2 AND \"group\" = 'white') w, ("
    f"SELECT value AS score FROM stump_overall WHERE {LAST}) o, {MODELS} WHERE \"group\" <> 'white'"))
def g5_stump(t):
    rows = GR.score_versus_disparity(stump_grid(t).withColumn("value", F.round("value", 6)))
    return rows.select("feature_type", "model_type", "model_idx", "group", *[F.round(f"{m}_disparity", 4).alias(f"{m}_disparity") for m in ("FDR", "TPR")], "score")


def _rate_baseline_block(block: int, skipped: int) -> str:
    rows = f"(SELECT *, {role_sql(skipped, 1)} AS role FROM sponsor_status)"
    scores = BASELINE_SCORES.replace("blocked", f"{rows} b").replace("s_rate", f"s_rate_{block}").replace("p_rate", f"p_rate_{block}")
    return (
        f"SELECT {block} AS block_id, y, row_number() OVER (ORDER BY score DESC, bill_id) AS place, count(*) OVER () AS n FROM "
        f"({scores.replace('round(', '(').replace(', 6) AS score', ') AS score')} WHERE role = 3 GROUP BY bill_id) "
        "JOIN (SELECT bill_id, max(CASE WHEN status_new = 'Passed' THEN 1 ELSE 0 END) AS y FROM sponsor_status GROUP BY 1) USING (bill_id)"
    )


_SERIES_VIEWS = {
    f"{c}_rate_{b}": f"SELECT {key} , {RATE_OF} AS r FROM (SELECT *, {role_sql(skip, 1)} AS role FROM sponsor_status) WHERE role = 1 GROUP BY 1"
    for b, skip in STUMP_BLOCKS for c, key in (("s", "sponsor_id"), ("p", "party_id"))
} | {"ranked_bills": " UNION ALL ".join(_rate_baseline_block(*b) for b in STUMP_BLOCKS)}


@query("G4_rate_baseline_series", sql_with(
    "sponsor_status",
    "UNPIVOT (SELECT block_id, round(avg(y), 6) AS base_rate, round(least(sum(y)::DOUBLE / floor(count(*) * 0.3::DOUBLE), 1), 6) AS best_precision, "
    "round(sum(y) FILTER (place <= floor(n * 0.3::DOUBLE))::DOUBLE / floor(max(n) * 0.3::DOUBLE), 6) AS rate_baseline "
    "FROM ranked_bills GROUP BY 1) ON base_rate, best_precision, rate_baseline INTO NAME series VALUE value", **_SERIES_VIEWS))
def g4_baseline(t):
    """A grid with the rate baseline, whose precision is the third series beside base rate and best precision."""
    path, settings = scratch_path(t.spark, "baseline-grid"), stump_settings()
    split = dict(update_freq=settings.update_freq, type_val=settings.split_type)
    sponsor_rows = with_block_columns(t.sponsor_status, "introduced_date", *YEARS, **split)
    results = GR.run_grid(t.facts, settings, "Baseline", [{}], path, sponsor_rows=sponsor_rows)
    rows = long_blocks(with_block_columns(t.facts, "introduced_date", *YEARS, **split))
    valid = rows.where(F.col("role") == VALIDATION).withColumn("y", (F.col("status_new") == "Passed").cast("int"))
    return rounded(GR.reference_series(valid, results=results), "value")
