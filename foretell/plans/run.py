"""The run from labelled facts to evaluated models, block by block."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial, reduce
from typing import Any

from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foretell.features.columns import LABEL_CODES
from foretell.features.fit import FittedFeatures, block_features, with_history
from foretell.features.spec import FEATURE_SETS, FeatureSpec
from foretell.features.text import VectorVocabulary, vocabulary
from foretell.models.classifiers import effective_parameters, fit_classifier, load_model, predict_scores, save_model
from foretell.operators import facts as Q
from foretell.operators.baseline import RateBaseline
from foretell.operators.groups import group_metrics
from foretell.operators.metrics import (
    cross_tabs,
    feature_importances,
    flag_top,
    long_results,
    metrics_at_k,
    pr_curve,
    score_histogram,
)
from foretell.operators.preprocess import preprocess
from foretell.operators.splits import TRAIN, VALIDATION, block_count, block_slice, with_block_columns
from foretell.session import cut_lineage
from foretell.sources.artifacts import vocabulary_at
from foretell.sources.tables import table_from_query

# relational queries that a configuration can name
QUERIES = {
    "map_bill_to_state_query": Q.bills_by_state,
    "bill_date_difference": Q.date_difference,
    "rank_by_bill_count_query": Q.rank_states,
    "bill_detail_query": Q.bill_detail,
    "bill_final_query": Q.final_fact,
    "bill_final_query_processed_text": Q.final_fact,
    "bill_sponsor": Q.sponsor_outcomes,
}


def _labelled(relations: Mapping[str, DataFrame], params: Mapping[str, Any], tiebreak: Sequence[str]) -> DataFrame:
    r = relations
    return Q.final_status(r["progress"], r["bill_state"], r["status_catalog"], r["states"], r["sponsors"], params.get("state_id"), tiebreak)


def _fact(texts: str):
    def build(r, params, tiebreak):
        chosen = Q.final_text(r["texts"]) if texts == "texts" else r[texts]
        return Q.final_fact(
            _labelled(r, params, tiebreak), r["bills"], chosen, r["session_dates"], Q.sponsor_list(r["sponsors"]), r["acs"], r["composition"]
        )

    return build


# how a named query is built from relations by name, its parameters and the tie-break of progress rows
BUILDERS = {
    "map_bill_to_state_query": lambda r, p, _: Q.bills_by_state(r["bills"], r["sessions"], int(p["start_year"]), int(p["end_year"])),
    "bill_date_difference": lambda r, p, _: Q.date_difference(r["progress"]),
    "rank_by_bill_count_query": lambda r, p, _: Q.rank_states(r["bills"], r["sessions"], r["states"], int(p["start_year"]), int(p["end_year"])),
    "bill_detail_query": lambda r, p, tie: Q.bill_detail(r["progress"], r["bill_state"], r["status_catalog"], r["states"], p.get("state_id"), tie),
    "bill_final_query": _fact("texts"),
    "bill_final_query_processed_text": _fact("cleaned_texts"),
    "bill_sponsor": lambda r, p, tie: Q.sponsor_outcomes(_labelled(r, p, tie), r["bills"], r["texts"], r["session_dates"], r["sponsors"]),
}
# the relation that later queries find a query's table under
PRODUCED = {"map_bill_to_state_query": "bill_state", "bill_date_difference": "date_diff"}


@dataclass(frozen=True)
class QueryStep:
    """A query of the first stage and the table it is written to."""

    name: str
    schema: str
    table: str


@dataclass(frozen=True)
class RunSettings:
    model_type: str = "RFClassifier"
    model_params: Mapping[str, Any] = field(default_factory=dict)
    feature_type: str = "no_text"
    label_type: str = "binary"
    start_year: int = 2009
    end_year: int = 2019
    split_list: Sequence[int] = (2, 1, 1, 1)
    update_freq: int = 2
    split_type: int = 1
    num_temporal_blocks: int | None = None
    top_k_fraction: float = 0.3
    metrics: Sequence[str] = ("precision", "recall")
    bias_metrics: Sequence[str] = ("FDR", "TPR")
    bias_groups: Sequence[str] | None = None  # of the members' groups; None: all
    reports: bool = False  # write curve, histogram, importances and cross-tabs of each block
    report_features: int = 20
    history: str = "slice"
    accept_limits: bool = False  # see effective_parameters
    preparation: Mapping[str, Sequence[str]] | None = None
    date_column: str = "introduced_date"
    feature_sets: Mapping[str, FeatureSpec] = field(default_factory=lambda: dict(FEATURE_SETS))
    queries: Sequence[QueryStep] = ()
    query_params: Mapping[str, Any] = field(default_factory=dict)  # of training
    test_params: Mapping[str, Any] = field(default_factory=dict)  # of prediction

    @classmethod
    def from_config(cls, config: Mapping[str, Any]) -> RunSettings:
        """From a JSON run configuration."""
        split, train = config["split"], config["query"]["train"]
        evaluate = config["evaluate_params"]
        bias = evaluate["bias_analysis"]
        stage = [config["query"].get(k, []) for k in ("name", "schema_name", "table_name")]
        stage = [[v] if isinstance(v, str) else v for v in stage]
        if len({len(v) for v in stage}) > 1:
            raise ValueError(f"query: {len(stage[0])} names, {len(stage[1])} schemas and {len(stage[2])} tables do not match")
        return cls(
            model_type=config["model_type"],
            model_params=config["model_info"].get(config["model_type"], {}),
            feature_type=config["feature_type"],
            label_type=config["label_type"],
            start_year=int(train["start_year"]),
            end_year=int(train["end_year"]),
            split_list=tuple(int(n) for n in split["split_list"]),
            update_freq=split["update_freq"],
            split_type=split["split_type"],
            num_temporal_blocks=split.get("num_temporal_blocks"),
            top_k_fraction=evaluate["top_k_fraction"],
            metrics=tuple(evaluate.get("metrics", ("precision", "recall"))),
            bias_metrics=tuple(bias["metrics"]) if bias.get("use", True) else (),
            bias_groups=tuple(bias["groups"]) if "groups" in bias else None,
            reports=True,
            report_features=evaluate.get("feature_importances", {}).get("top_n", 20),
            accept_limits=config.get("accept_limits", False),
            preparation=config["transform"]["ops"],
            date_column=config["transform"].get("year_col", "introduced_date"),
            feature_sets={n: FeatureSpec.from_config(i) for n, i in config["feature_info"].items()},
            queries=tuple(QueryStep(*step) for step in zip(*stage)),
            query_params=train,
            test_params=config["query"].get("test", {}),
        )

    @property
    def spec(self) -> FeatureSpec:
        return self.feature_sets[self.feature_type]


def run_queries(
    spark: SparkSession, relations: Mapping[str, DataFrame], settings: RunSettings, tiebreak: Sequence[str] = (), predict: bool = False,
) -> DataFrame:
    """Run the configured queries in order, each written to its table; the last table holds the facts.

    A query finds the tables of earlier ones among its relations (``PRODUCED``). ``predict`` takes the parameters of
    the test years. Without queries, or with an unknown one, nothing is written.
    """
    unknown = [q.name for q in settings.queries if q.name not in BUILDERS]
    if unknown or not settings.queries:
        raise ValueError(f"queries {unknown}, choose from {sorted(BUILDERS)}")
    params = settings.test_params if predict else settings.query_params
    found, table = dict(relations), None
    for step in settings.queries:
        table = table_from_query(spark, BUILDERS[step.name](found, params, tiebreak), step.schema, step.table)
        found[PRODUCED.get(step.name, step.name)] = table
    return table


def run_configured(
    spark: SparkSession, relations: Mapping[str, DataFrame], settings: RunSettings, model_path: str, tiebreak: Sequence[str] = (),
    members: DataFrame | None = None, sponsor_rows: DataFrame | None = None, predict: bool = False,
) -> DataFrame:
    """``run`` on the facts that the configured queries make; with ``predict``, stored models score the test years."""
    facts = run_queries(spark, relations, settings, tiebreak, predict)
    return run(facts, settings, model_path, members, sponsor_rows, train_models=not predict)


def prepare_facts(facts: DataFrame, settings: RunSettings) -> DataFrame:
    """Preparation and block columns in one projection."""
    ready = preprocess(facts, settings.preparation) if settings.preparation else facts
    return with_block_columns(
        ready, settings.date_column, settings.start_year, settings.end_year, settings.split_list,
        settings.update_freq, settings.split_type,
    )


def written_facts(facts: DataFrame, settings: RunSettings, path: str) -> DataFrame:
    """Prepared facts as a table, with the sponsor history if it is drawn from all rows.

    Every block's fit and apply then start from a columnar scan.
    """
    prepared = prepare_facts(facts, settings)
    if settings.history == "all" and settings.spec.has_history():
        # lists and dates of the history and the facts themselves are read from one written copy
        prepared = with_history(cut_lineage(prepared), settings.spec)
    prepared.write.mode("overwrite").parquet(path)
    return facts.sparkSession.read.parquet(path)


def blocks_to_run(prepared: DataFrame, settings: RunSettings) -> range:
    n = block_count(prepared)
    return range(1, min(n, settings.num_temporal_blocks or n) + 1)


def text_vocabulary(
    prepared: DataFrame, spec: FeatureSpec, path: str
) -> VectorVocabulary | None:
    """Terms of the text columns over all rows, built once and then read from ``path``."""
    columns = spec.text_columns()
    if not columns:
        return None
    build = partial(vocabulary, prepared, columns)
    return VectorVocabulary(vocabulary_at(prepared.sparkSession, f"{path}/{'-'.join(sorted(columns))}", build))


ROLES = {"train": TRAIN, "validation": VALIDATION}


def baseline_scores(
    sponsor_rows: DataFrame, block_id: int, path: str, train_model: bool = True
) -> DataFrame:
    """``(bill_id, score, y, role)`` of the rate baseline, fitted on the block's training rows.

    ``sponsor_rows`` are (sponsor_id, party_id, bill_id, status_new, iter_*). The rates are
    stored first, so the joins that score know how small they are.
    """
    if train_model:
        RateBaseline.fit(block_slice(sponsor_rows, block_id, TRAIN)).save(path)
    model = RateBaseline.load(sponsor_rows.sparkSession, path)
    scored = []
    for name, role in ROLES.items():
        rows = block_slice(sponsor_rows, block_id, role)
        passed = F.max((F.col("status_new") == "Passed").cast("int"))
        truth = rows.groupBy("bill_id").agg(passed.alias("y"))
        scored.append(model.predict(rows).join(truth, "bill_id").withColumn("role", F.lit(name)))
    return scored[0].unionByName(scored[1])


def model_scores(
    fitted: FittedFeatures, train: DataFrame, valid: DataFrame, model_type: str,
    params: Mapping[str, Any], path: str, label_type: str = "binary", train_model: bool = True,
    accept_limits: bool = False,
) -> tuple[DataFrame, list[str]]:
    """Train and save, load and score both roles: ``(id, score, y, role)``.

    Without ``train_model`` the model stored at ``path`` is used.
    """
    notes: list[str] = []
    if train_model:
        classes = len(set(LABEL_CODES[label_type].values()))
        model, notes = fit_classifier(model_type, params, train, fitted.size(), classes, accept_limits=accept_limits)
        save_model(model, path)
    loaded = load_model(path)
    id_column = fitted.spec.id_column
    scored = [
        predict_scores(loaded, rows, id_column).withColumn("role", F.lit(role))
        for role, rows in (("train", train), ("validation", valid))
    ]
    return scored[0].unionByName(scored[1]), notes


def evaluate_block(
    scores: DataFrame, settings: RunSettings, block_id: int, id_column: str,
    members: DataFrame | None = None,
) -> DataFrame:
    """``(block_id, role, group, metric, value)``; group is null for all rows together."""
    unknown = set(settings.metrics) - {"precision", "recall"}
    if unknown:
        raise ValueError(f"metrics {sorted(unknown)} are not defined at the top fraction, choose precision or recall")
    flagged = flag_top(scores, settings.top_k_fraction, ["role"], tiebreak=id_column)
    overall = metrics_at_k(flagged, ["role"]).withColumn("group", F.lit(None).cast("string"))
    out = long_results(overall, ["role", "group"], list(settings.metrics))
    if members is not None and settings.bias_metrics:
        if settings.bias_groups is not None:
            members = members.where(F.col("group").isin(*settings.bias_groups))
        valid = flagged.where("role = 'validation'")
        audited = group_metrics(valid, members, settings.bias_metrics, ["role"], id_column)
        out = out.unionByName(long_results(audited, ["role", "group"], list(settings.bias_metrics)))
    return out.withColumn("block_id", F.lit(block_id))


def run(
    facts: DataFrame, settings: RunSettings, model_path: str, members: DataFrame | None = None,
    sponsor_rows: DataFrame | None = None, train_models: bool = True,
) -> DataFrame:
    """Evaluation results of one model over all blocks, with the parameters it was fitted with.

    Columns: ``params`` (JSON), ``notes`` (where they differ from the settings), ``role``, ``group``,
    ``metric``, ``value``, ``block_id``.

    With ``train_models=False`` the models stored below ``model_path`` are scored again, and
    only the validation rows are evaluated.

    The loop runs over blocks (a handful); each step inside is a Spark job. Scores are
    written before they are evaluated, so an evaluation never retrains.
    """
    spark = facts.sparkSession
    used, notes = effective_parameters(settings.model_type, settings.model_params, settings.accept_limits)
    prepared = written_facts(facts, settings, f"{model_path}/facts")
    vocab = text_vocabulary(prepared, settings.spec, f"{model_path}/text_vocab")
    results = []
    for block in blocks_to_run(prepared, settings):
        path = f"{model_path}/temporal_block_{block}"
        if settings.model_type == "Baseline":
            if sponsor_rows is None:
                raise ValueError("the baseline needs sponsor rows")
            id_column = "bill_id"
            scores = baseline_scores(sponsor_rows, block, f"{path}/model", train_models)
        else:
            id_column = settings.spec.id_column
            fitted, train, valid = block_features(
                prepared, settings.spec, block, settings.label_type, vocab, settings.history
            )
            train.write.mode("overwrite").parquet(f"{path}/features_train")
            valid.write.mode("overwrite").parquet(f"{path}/features_validation")
            scores, _ = model_scores(
                fitted,
                spark.read.parquet(f"{path}/features_train"),
                spark.read.parquet(f"{path}/features_validation"),
                settings.model_type, settings.model_params, f"{path}/model", settings.label_type,
                train_models, settings.accept_limits,
            )
        if not train_models:
            scores = scores.where("role = 'validation'")
        scores.write.mode("overwrite").parquet(f"{path}/scores")
        stored = spark.read.parquet(f"{path}/scores")
        if settings.reports:
            tables = block_series(stored, id_column)
            if settings.model_type in ("DTClassifier", "RFClassifier"):
                rows = spark.read.parquet(f"{path}/features_validation")
                chosen = stored.where("role = 'validation'")
                heavy, tabs = model_report(load_model(f"{path}/model"), fitted, rows, chosen, settings, settings.report_features)
                tables |= {"importances": heavy, "cross_tabs": tabs}
            for name, table in tables.items():
                table.write.mode("overwrite").parquet(report_path(model_path, block, name))
        results.append(evaluate_block(stored, settings, block, id_column, members))
    return with_parameters(reduce(DataFrame.unionByName, results), used, notes)


def with_parameters(results: DataFrame, used: Mapping[str, Any], notes: Sequence[str]) -> DataFrame:
    """Results with the effective parameters as JSON and the notes on them, in front."""
    params = F.lit(json.dumps(used, sort_keys=True)).alias("params")
    return results.select(params, F.lit("; ".join(notes)).alias("notes"), *results.columns)


def report_path(model_path: str, block: int, name: str) -> str:
    """Where a run with ``reports`` puts ``curve``, ``histogram``, ``importances`` or ``cross_tabs`` of a block."""
    return f"{model_path}/temporal_block_{block}/report/{name}"


def block_series(scores: DataFrame, id_column: str) -> dict[str, DataFrame]:
    """Curve and histogram of the validation rows."""
    curve, histogram = evaluation_series(scores.where("role = 'validation'"), id_column)
    return {"curve": curve, "histogram": histogram}


def evaluation_series(scores: DataFrame, id_column: str) -> tuple[DataFrame, DataFrame]:
    """The data behind the precision/recall curve and the score distribution."""
    return pr_curve(scores, tiebreak=id_column), score_histogram(scores)


def model_report(
    model, fitted: FittedFeatures, rows: DataFrame, scores: DataFrame, settings: RunSettings,
    top_n: int = 20,
) -> tuple[DataFrame, DataFrame]:
    """Named feature importances of a tree model and cross-tabs of the heaviest features."""
    names = fitted.feature_names()
    heavy = feature_importances(rows, names, model.featureImportances.toArray(), top_n)
    picked = [(r.feature_index, r.feature) for r in heavy.collect()]
    flagged = flag_top(scores, settings.top_k_fraction, tiebreak=fitted.spec.id_column)
    slicer = VectorSlicer(inputCol="features", outputCol="picked", indices=[i for i, _ in picked])
    values = vector_to_array("picked")
    sliced = slicer.transform(rows)
    wide = sliced.select(fitted.spec.id_column, *[values[k].alias(n) for k, (_, n) in enumerate(picked)])
    joined = flagged.join(wide, fitted.spec.id_column)
    return heavy, cross_tabs(joined, [n for _, n in picked])
