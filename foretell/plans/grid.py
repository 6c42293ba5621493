"""Model grids: products of hyper-parameters, a results table, leader-boards, disparities."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from itertools import product
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foretell.features.fit import block_features
from foretell.models.classifiers import effective_parameters
from foretell.operators.groups import REFERENCE_GROUP, disparities
from foretell.operators.joins import members_only
from foretell.operators.metrics import base_rates
from foretell.plans.run import (
    RunSettings,
    baseline_scores,
    blocks_to_run,
    evaluate_block,
    model_scores,
    text_vocabulary,
    written_facts,
)
from foretell.session import cut_lineage, small_table

# fixed values: the hyper-parameter ranges per model family
MODEL_GRID: dict[str, dict[str, list]] = {
    "Baseline": {},
    "DTClassifier": {
        "criterion": ["gini", "entropy"],
        "max_depth": [3, 10, 50, 100, 500, 1000, 10000, None],
        "class_weight": ["balanced", None],
    },
    "RFClassifier": {
        "n_estimators": [100, 1000, 10000],
        "criterion": ["gini", "entropy"],
        "max_depth": [100, 1000, 10000, None],
        "max_features": ["sqrt", "log2"],
        "class_weight": ["balanced", None],
    },
    "SVMClassifier": {
        "C": [0.01, 0.1, 1, 10, 100],
        "kernel": ["linear", "rbf", "poly", "sigmoid"],
        "class_weight": ["balanced", None],
    },
    "LogRegClassifier": {
        "penalty": ["l1", "l2"],
        "C": [0.01, 0.1, 1, 10, 100],
        "class_weight": ["balanced", None],
        "solver": ["saga", None],
    },
}
RESULTS = (
    "model_idx int, params string, effective string, notes string, block_id int, role string, `group` string, metric string, "
    "value double, feature_type string, model_type string"
)


def parameter_grid(ranges: Mapping[str, Sequence]) -> list[dict[str, Any]]:
    """Every combination, the last parameter varying fastest; one empty set without ranges."""
    return [dict(zip(ranges, values)) for values in product(*ranges.values())]


def split_grid(
    model_type: str, grid: Sequence[Mapping[str, Any]], accept_limits: bool
) -> tuple[dict[str, list[tuple[int, Mapping[str, Any], str]]], list[tuple[int, Mapping[str, Any], str]]]:
    """Places of the grid by effective parameters (JSON), and those without a counterpart, with notes."""
    usable: dict[str, list] = {}
    others = []
    for place, params in enumerate(grid):
        try:
            used, notes = effective_parameters(model_type, params, accept_limits)
        except ValueError as error:
            others.append((place, params, str(error)))
            continue
        usable.setdefault(json.dumps(used, sort_keys=True), []).append((place, params, "; ".join(notes)))
    return usable, others


def read_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RESULTS).parquet(path)


def next_model_index(spark: SparkSession, path: str, feature_type: str, model_type: str) -> int:
    """One past the highest stored index of the family, or 1."""
    try:
        stored = read_results(spark, path)
        family = (F.col("feature_type") == feature_type) & (F.col("model_type") == model_type)
        highest = stored.where(family).agg(F.max("model_idx")).first()[0]
    except AnalysisException:
        highest = None
    return (highest or 0) + 1


def append_results(results: DataFrame, path: str) -> None:
    results.write.mode("append").partitionBy("feature_type", "model_type").parquet(path)


def run_grid(
    facts: DataFrame, settings: RunSettings, model_type: str, grid: Sequence[Mapping[str, Any]],
    work_dir: str, members: DataFrame | None = None, parallel_fits: int = 4,
    sponsor_rows: DataFrame | None = None,
) -> DataFrame:
    """:func:`run_grids` of one family."""
    return run_grids(facts, settings, {model_type: grid}, work_dir, members, parallel_fits, sponsor_rows)


def run_grids(
    facts: DataFrame, settings: RunSettings, grids: Mapping[str, Sequence[Mapping[str, Any]]],
    work_dir: str, members: DataFrame | None = None, parallel_fits: int = 4,
    sponsor_rows: DataFrame | None = None,
) -> DataFrame:
    """Fit every parameter set of every family on every block and append the results of each model as it is done.

    Parameter sets that come to the same effective parameters are one model, fitted once, with rows for
    each set. A set without a counterpart here (see ``effective_parameters``) has one row ``not_run`` that says
    why; a grid of such sets alone is an error. Facts are prepared once, and features are computed and written once
    per block, for all models of all families. The rate baseline reads ``sponsor_rows`` instead.
    """
    if "Baseline" in grids and sponsor_rows is None:
        raise ValueError("the baseline needs sponsor rows")
    split = {}
    for model_type, grid in grids.items():
        usable, others = split[model_type] = split_grid(model_type, grid, settings.accept_limits)
        if not usable:
            raise ValueError(f"{model_type}: no counterpart for {[o[1] for o in others]}: {others[0][2]}" if others else "an empty grid")
    spark = facts.sparkSession
    results_path = f"{work_dir}/results"
    first = {m: next_model_index(spark, results_path, settings.feature_type, m) for m in grids}
    kind = lambda m: (F.lit(settings.feature_type).alias("feature_type"), F.lit(m).alias("model_type"))
    prepared = written_facts(facts, settings, f"{work_dir}/facts/{settings.feature_type}/{'-'.join(grids)}")
    audited = members is not None and settings.bias_metrics
    if audited:
        members = cut_lineage(members)  # every block reads them
    for model_type, (_, others) in split.items():
        if others:
            left_out = [(first[model_type] + place, json.dumps(params), note) for place, params, note in others]
            table = small_table(spark, left_out, "model_idx int, params string, notes string")
            nothing = {c: F.lit(None).cast(t) for c, t in (("effective", "string"), ("block_id", "int"), ("role", "string"), ("group", "string"), ("value", "double"))}
            append_results(table.withColumns(nothing | {"metric": F.lit("not_run")}).select("*", *kind(model_type)), results_path)
    featured = any(m != "Baseline" for m in grids)
    if featured:
        vocab = text_vocabulary(
            prepared, settings.spec, f"{work_dir}/text_vocab/{settings.feature_type}"
        )
    for block in blocks_to_run(prepared, settings):
        if featured:
            fitted, train, valid = block_features(
                prepared, settings.spec, block, settings.label_type, vocab, settings.history
            )
            base = f"{work_dir}/features/{settings.feature_type}/block_{block}"
            train.write.mode("overwrite").parquet(f"{base}/train")
            valid.write.mode("overwrite").parquet(f"{base}/validation")
            train = spark.read.parquet(f"{base}/train")
            valid = spark.read.parquet(f"{base}/validation")
            if audited:
                # members of the validation rows, dealt by bill once for all models
                ids = valid.select(F.col(settings.spec.id_column).alias("bill_id"))
                block_members = cut_lineage(members_only(members, ids, "bill_id").repartition("bill_id"))

        def fit_one(model) -> DataFrame:
            model_type, used, places = model
            baseline = model_type == "Baseline"
            index = first[model_type] + places[0][0]
            path = f"{work_dir}/{settings.feature_type}/{model_type}/model_{index}/temporal_block_{block}"
            if baseline:
                scores = baseline_scores(sponsor_rows, block, f"{path}/model")
            else:
                scores, _ = model_scores(
                    fitted, train, valid, model_type, json.loads(used), f"{path}/model", settings.label_type,
                    accept_limits=settings.accept_limits,
                )
            scores.write.mode("overwrite").parquet(f"{path}/scores")
            stored = spark.read.parquet(f"{path}/scores")
            id_column = "bill_id" if baseline else settings.spec.id_column
            of_block = block_members if audited and not baseline else members
            scored = evaluate_block(stored, settings, block, id_column, of_block)
            names = ("model_idx", "params", "effective", "notes")
            asked = [(first[model_type] + place, json.dumps(params), used, note) for place, params, note in places]
            each = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in asked])
            return scored.withColumn("asked", F.explode(each)).select(
                *[f"asked.{n}" for n in names], "block_id", "role", "group", "metric", "value", *kind(model_type)
            )

        models = [(m, used, places) for m, (usable, _) in split.items() for used, places in usable.items()]
        with ThreadPool(parallel_fits) as pool:
            # appended one by one here, so that a model that fails costs none that were done before
            for rows in pool.imap(fit_one, models):
                append_results(rows, results_path)
    return read_results(spark, results_path)


def _overall(results: DataFrame, metric: str, role: str) -> DataFrame:
    return results.where(
        (F.col("metric") == metric) & (F.col("role") == role) & F.col("group").isNull()
    )


def leader_board(
    results: DataFrame, metric: str = "precision", role: str = "validation", top: int = 5
) -> DataFrame:
    """The best models by their score on the last block."""
    rows = _overall(results, metric, role)
    last = rows.agg(F.max("block_id")).scalar()
    return rows.where(F.col("block_id") == last).orderBy(
        F.desc("value"), "feature_type", "model_type", "model_idx"
    ).select("feature_type", "model_type", "model_idx", "value").limit(top)


def family_leaders(
    results: DataFrame, metric: str = "precision", role: str = "validation", top: int = 3
) -> DataFrame:
    """All blocks of the ``top`` models of each (feature set, family)."""
    rows = _overall(results, metric, role)
    keys = ["feature_type", "model_type", "model_idx"]
    last = rows.agg(F.max("block_id")).scalar()
    # a family has at most as many rows as its grid
    best = W.partitionBy("feature_type", "model_type").orderBy(F.desc("value"), "model_idx")
    chosen = rows.where(F.col("block_id") == last).withColumn("place", F.row_number().over(best))
    chosen = chosen.where(F.col("place") <= top).select(*keys, "place")
    return rows.join(chosen, keys).select(*keys, "place", "block_id", "value")


def reference_series(
    labelled: DataFrame, k: float = 0.3, label: str = "y", results: DataFrame | None = None,
    metric: str = "precision", role: str = "validation",
) -> DataFrame:
    """Base rate and best possible precision per block, as long rows for the same chart.

    With ``results`` of a grid that has the rate baseline, its ``metric`` is the series ``rate_baseline``.
    """
    rates = base_rates(labelled, ["block_id"], label, k)
    series = rates.unpivot(["block_id"], ["base_rate", "best_precision"], "series", "value")
    if results is None:
        return series
    baseline = _overall(results, metric, role).where("model_type = 'Baseline'")
    return series.unionByName(baseline.select("block_id", F.lit("rate_baseline").alias("series"), "value"))


def score_versus_disparity(
    results: DataFrame, metric: str = "precision", block_id: int | None = None,
    bias_metrics: Sequence[str] = ("FDR", "TPR"), reference: str = REFERENCE_GROUP,
) -> DataFrame:
    """Per model and group: overall score and error rates relative to the reference group."""
    keys = ["feature_type", "model_type", "model_idx"]
    valid = results.where("role = 'validation'")
    block = F.lit(block_id) if block_id is not None else valid.agg(F.max("block_id")).scalar()
    rows = valid.where(F.col("block_id") == block)
    scores = _overall(rows, metric, "validation").select(*keys, F.col("value").alias("score"))
    wide = rows.where(F.col("group").isNotNull()).groupBy(*keys, "group").agg(
        *[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in bias_metrics]
    )
    return disparities(wide, bias_metrics, keys, reference).join(scores, keys)
