"""Named classifiers with familiar hyper-parameters, mapped to Spark ML estimators."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.base import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_TREE_DEPTH = 30  # Spark's limit
#: Rows of a network's block. The loss is averaged by block, so rows of a smaller, last block weigh more; with 1, all weigh the same.
BLOCK_ROWS = 1
WEIGHT = "class_weight"
MODEL_TYPES = (
    "Baseline", "DTClassifier", "RFClassifier", "SVMClassifier", "LogRegClassifier",
    "MultiLabelNNClassifier", "BinaryLabelNNClassifier",
)
POSITIVE_CLASS = 1


def balanced_weights(train: DataFrame, label: str = "label") -> Column:
    """``n / (classes x n_class)`` by label; there are two or three classes."""
    counts = {r[label]: r["count"] for r in train.groupBy(label).count().collect()}
    n, k = sum(counts.values()), len(counts)
    weight = F.lit(None).cast("double")
    for value, size in counts.items():
        weight = F.when(F.col(label) == value, n / (k * size)).otherwise(weight)
    return weight


def effective_parameters(
    model_type: str, params: Mapping[str, Any], accept_limits: bool = False
) -> tuple[dict[str, Any], list[str]]:
    """The parameters that a model is fitted with, and a note on each that differs from ``params``.

    What Spark ML cannot do is an error, unless ``accept_limits`` allows the nearest it can: trees of
    depth 30 at most, sigmoid layers, no class weights for networks. An unset depth means no limit and is
    always noted. Support vectors have no nearest: the kernel must be ``linear``, and unset means ``rbf``.
    """
    notes: list[str] = []

    def limit(name: str, wanted, given) -> Any:
        if not accept_limits:
            raise ValueError(f"{model_type}: {name} {wanted!r} is not available; accept_limits takes {given!r} instead")
        notes.append(f"{name} {wanted} set to {given}")
        return given

    weight = {"class_weight": params["class_weight"]} if params.get("class_weight") else {}
    if model_type == "LogRegClassifier":
        penalty = params.get("penalty", "l2")
        if penalty not in ("l1", "l2"):
            raise ValueError(f"penalty {penalty!r}, choose from l1, l2")
        if params.get("solver"):
            notes.append(f"solver {params['solver']} is not a choice here")
        out = {"penalty": penalty, "C": params.get("C", 1.0), "max_iter": params.get("max_iter", 100)}
    elif model_type == "SVMClassifier":
        kernel = params.get("kernel", "rbf")
        if kernel != "linear":
            raise ValueError(f"kernel {kernel!r} is not available, only linear")
        out = {"kernel": kernel, "C": params.get("C", 1.0), "max_iter": params.get("max_iter", 100)}
    elif model_type in ("DTClassifier", "RFClassifier"):
        depth = params.get("max_depth")
        if depth is None:
            depth = MAX_TREE_DEPTH
            notes.append(f"max_depth None set to {depth}")
        elif depth > MAX_TREE_DEPTH:
            depth = limit("max_depth", depth, MAX_TREE_DEPTH)
        out = {"criterion": params.get("criterion", "gini"), "max_depth": depth}
        if model_type == "RFClassifier":
            out |= {"n_estimators": params.get("n_estimators", 100), "max_features": params.get("max_features") or "sqrt"}
    elif model_type in ("MultiLabelNNClassifier", "BinaryLabelNNClassifier"):
        activation = params.get("activation", "relu")
        if activation != "sigmoid":
            activation = limit("activation", activation, "sigmoid")
        if weight:
            weight = {"class_weight": w} if (w := limit("class_weight", params["class_weight"], None)) else {}
        out = {
            "num_hidden_nodes_in_layers": list(params.get("num_hidden_nodes_in_layers") or [50, 20]),
            "activation": activation, "epochs": params.get("epochs", 100), "block_size": params.get("block_size", BLOCK_ROWS),
        }
    elif model_type == "Baseline":
        out = {}
    else:
        raise ValueError(f"model type {model_type!r}, choose from {MODEL_TYPES}")
    return out | weight, notes


def _inverse_strength(params: Mapping[str, Any], n_rows: int) -> float:
    # the penalty weighs against the mean loss in Spark, against the summed loss in C
    return 1.0 / (params.get("C", 1.0) * max(n_rows, 1))


def build_classifier(
    model_type: str, params: Mapping[str, Any], n_rows: int, n_features: int, n_classes: int = 2,
    seed: int = 17, accept_limits: bool = False,
) -> tuple[Estimator, list[str]]:
    """The estimator and notes on parameters that could not be taken as given."""
    used, notes = effective_parameters(model_type, params, accept_limits)
    if model_type == "LogRegClassifier":
        estimator = LogisticRegression(
            elasticNetParam=1.0 if used["penalty"] == "l1" else 0.0,
            regParam=_inverse_strength(used, n_rows),
            standardization=False,
            maxIter=used["max_iter"],
        )
    elif model_type == "SVMClassifier":
        estimator = LinearSVC(
            regParam=_inverse_strength(used, n_rows), standardization=False, maxIter=used["max_iter"]
        )
    elif model_type == "DTClassifier":
        estimator = DecisionTreeClassifier(impurity=used["criterion"], maxDepth=used["max_depth"], seed=seed)
    elif model_type == "RFClassifier":
        estimator = RandomForestClassifier(
            impurity=used["criterion"], maxDepth=used["max_depth"], numTrees=used["n_estimators"],
            featureSubsetStrategy=used["max_features"], seed=seed,
        )
    elif model_type != "Baseline":
        estimator = MultilayerPerceptronClassifier(
            layers=[n_features, *used["num_hidden_nodes_in_layers"], n_classes], maxIter=used["epochs"], seed=seed,
            blockSize=used["block_size"],
        )
    else:
        raise ValueError("the baseline is fitted from sponsor rows")
    if used.get("class_weight") == "balanced":
        estimator = estimator.copy({estimator.getParam("weightCol"): WEIGHT})
    return estimator, notes


def fit_classifier(
    model_type: str, params: Mapping[str, Any], train: DataFrame, n_features: int,
    n_classes: int = 2, seed: int = 17, n_rows: int | None = None, accept_limits: bool = False,
) -> tuple[Model, list[str]]:
    """Fit on ``(id, features, label)`` rows."""
    n = train.count() if n_rows is None else n_rows
    estimator, notes = build_classifier(model_type, params, n, n_features, n_classes, seed, accept_limits)
    balanced = params.get("class_weight") == "balanced" and estimator.hasParam("weightCol")
    rows = train.withColumn(WEIGHT, balanced_weights(train)) if balanced else train
    return estimator.fit(rows), notes


def predict_scores(model: Model, rows: DataFrame, id_column: str = "bill_id") -> DataFrame:
    """``(id, score, y)``: the positive class's probability, or its margin without one."""
    column = "probability" if model.hasParam("probabilityCol") else "rawPrediction"
    out = model.transform(rows)
    return out.select(
        id_column,
        vector_to_array(column)[POSITIVE_CLASS].alias("score"),
        (F.col("label") == POSITIVE_CLASS).cast("int").alias("y"),
    )


def save_model(model: Model, path: str) -> None:
    PipelineModel([model]).write().overwrite().save(path)


def load_model(path: str) -> Model:
    return PipelineModel.load(path).stages[0]
