"""Evaluation of scores: thresholds, top fraction, curves, histograms, cross-tabs.

Score tables have one row per scored item: an id, ``score``, ``y`` (0/1) and optional
grouping columns (model, block, role). Ranks come from sorted ranges, never from a
single-task window; ties in the score go to the lower id.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foretell.functions.scalar import clip01, int_part, ratio
from foretell.operators.ordinal import global_ordinal, ordinal_within
from foretell.session import cut_lineage, small_table


def _true_positives(y: Column, hit: Column) -> Column:
    return F.count_if((y == 1) & hit)


def _precision(y: Column, hit: Column) -> Column:
    return F.coalesce(ratio(_true_positives(y, hit), F.count_if(hit)), F.lit(0.0))


def _recall(y: Column, hit: Column) -> Column:
    return F.coalesce(ratio(_true_positives(y, hit), F.count_if(y == 1)), F.lit(0.0))


def _f1(y: Column, hit: Column) -> Column:
    both = F.count_if(hit) + F.count_if(y == 1)
    return F.coalesce(ratio(2 * _true_positives(y, hit), both), F.lit(0.0))


METRICS: dict[str, Callable[[Column, Column], Column]] = {
    "precision": _precision,
    "recall": _recall,
    "f1": _f1,
    "FDR": lambda y, hit: 1 - _precision(y, hit),
    "TPR": _recall,
}


def metric_column(name: str, label: str, predicted: Column) -> Column:
    """Aggregate expression of a registered metric; undefined ratios count as 0."""
    if name not in METRICS:
        raise ValueError(f"metric {name!r} does not exist, choose from {sorted(METRICS)}")
    return METRICS[name](F.col(label), predicted)


def threshold_metrics(
    scores: DataFrame, names: Sequence[str] = tuple(METRICS), threshold: float = 0.5,
    by: Sequence[str] = (), score: str = "score", label: str = "y",
) -> DataFrame:
    hit = F.col(score) >= threshold
    return scores.groupBy(*by).agg(*[metric_column(n, label, hit).alias(n) for n in names])


def ranked(
    scores: DataFrame, by: Sequence[str] = (), score: str = "score", tiebreak: str = "id"
) -> DataFrame:
    """Scores with ``rank`` 1 for the best score (of each group)."""
    order = [F.desc(score), tiebreak]
    return ordinal_within(scores, by, order, "rank") if by else global_ordinal(scores, order, "rank")


def _group_sizes(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias("__size"))


def _with_size(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    if not by:
        return rows.withColumn("__size", rows.agg(F.count("*")).scalar())
    # a group is one evaluated model and block, so this side has one row per evaluation
    return rows.join(_group_sizes(rows, by), list(by))


def top_fraction(
    scores: DataFrame, k: float = 0.3, by: Sequence[str] = (), score: str = "score",
    tiebreak: str = "id",
) -> DataFrame:
    """``predicted`` is 1 for the best ``int(k * N)`` scores and 0 for the rest."""
    rows = _with_size(ranked(scores, by, score, tiebreak), by)
    n = int_part(F.lit(float(k)) * F.col("__size"))
    flag = (F.col("rank") <= n).cast("int").alias("predicted")
    return rows.select(*scores.columns, "rank", flag)


#: Share of the rows on each side of the estimated cut that is sorted to find the exact one.
CUT_MARGIN = 0.001
#: Number of groups up to which their cuts are sent to every executor.
MAX_BROADCAST_GROUPS = 100_000


def flag_top(
    scores: DataFrame, k: float = 0.3, by: Sequence[str] = (), score: str = "score",
    tiebreak: str = "id",
) -> DataFrame:
    """``predicted`` as in :func:`top_fraction`, without ranks and without sorting all rows.

    Approximate quantiles enclose the cut (their error, 1e-4 of the rows, is below the margin). Rows
    above the enclosure are counted, the few rows inside are sorted, and the row that is last in the top
    gives the cut score and, among equal scores, the cut id. Many ties only widen the enclosure.
    """
    value = F.coalesce(F.col(score).cast("double"), F.lit(float("-inf")))  # missing scores rank last
    keyed = scores.withColumn("__v", value)
    places = [max(0.0, 1 - k - CUT_MARGIN), min(1.0, 1 - k + CUT_MARGIN)]
    bounds = F.percentile_approx("__v", places, 10_000)
    groups = cut_lineage(keyed.groupBy(*by).agg(F.count("*").alias("__size"), bounds.alias("__b")).select(
        *by, int_part(F.lit(float(k)) * F.col("__size")).alias("__n"), F.col("__b")[0].alias("__low"), F.col("__b")[1].alias("__high")
    ))
    # the planner does not know how few they are and would deal all scores by them
    few = bool(by) and groups.count() <= MAX_BROADCAST_GROUPS

    def with_groups(rows: DataFrame, table: DataFrame) -> DataFrame:
        if not by:  # one row
            cells = {c: table.select(c).scalar() for c in table.columns}
            return rows.withColumns(cells)
        other = table.select(*[F.col(c).alias(f"__g_{c}") if c in by else F.col(c) for c in table.columns])
        same = F.lit(True)
        for c in by:
            same = same & F.col(c).eqNullSafe(F.col(f"__g_{c}"))
        return rows.join(F.broadcast(other) if few else other, same, "left").drop(*[f"__g_{c}" for c in by])

    narrow = with_groups(keyed.select(*by, "__v", F.col(tiebreak).alias("__t")), groups)
    above = narrow.groupBy(*by).agg(F.count_if(F.col("__v") > F.col("__high")).alias("__above"))
    inside = narrow.where((F.col("__v") >= F.col("__low")) & (F.col("__v") <= F.col("__high"))).select(*by, "__v", "__t")
    order = [F.desc("__v"), "__t"]
    placed = ordinal_within(inside, by, order, "__rank") if by else global_ordinal(inside, order, "__rank")
    wanted = with_groups(with_groups(placed, groups.select(*by, "__n")), cut_lineage(above))
    cuts = wanted.where(F.col("__rank") == F.col("__n") - F.col("__above")).select(
        *by, F.col("__v").alias("__cut"), F.col("__t").alias("__last"))
    flagged = with_groups(with_groups(keyed, groups.select(*by, "__high")), cut_lineage(cuts))
    up_to_cut = (F.col("__v") > F.col("__cut")) | ((F.col("__v") == F.col("__cut")) & (F.col(tiebreak) <= F.col("__last")))
    # the rows above may be the whole top, and then there is no cut row
    top = (F.col("__v") > F.col("__high")) | F.coalesce(up_to_cut, F.lit(False))
    return flagged.select(*scores.columns, top.cast("int").alias("predicted"))


def metrics_at_k(flagged: DataFrame, by: Sequence[str] = (), label: str = "y") -> DataFrame:
    """Precision and recall of the flagged top rows; null where undefined."""
    top = F.col("predicted") == 1
    hits, n = F.count_if(top & (F.col(label) == 1)), F.count_if(top)
    return flagged.groupBy(*by).agg(
        n.alias("n_top"),
        hits.alias("hits"),
        ratio(hits, n).alias("precision"),
        ratio(hits, F.count_if(F.col(label) == 1)).alias("recall"),
    )


def pr_curve(
    scores: DataFrame, step: float = 0.0002, score: str = "score", label: str = "y",
    tiebreak: str = "id",
) -> DataFrame:
    """Precision and recall of the top ``int(p * N)`` rows for ``p = step, 2 step, .. 1``.

    Each row is counted once, at the first point whose depth reaches its rank; the running
    total then runs over the points, not over the rows.
    """
    points = math.ceil((1 + 1e-8 - step) / step)
    rows = _with_size(ranked(scores, (), score, tiebreak), ())

    def depth(i: Column) -> Column:
        return int_part((F.lit(step) + i * F.lit(step)) * F.col("__size"))

    guess = F.floor(F.col("rank") / (F.lit(step) * F.col("__size"))) - 1
    near = [F.greatest(guess + d, F.lit(0)) for d in (-1, 0, 1, 2)]
    first = F.coalesce(*[F.when(depth(i) >= F.col("rank"), i) for i in near]).cast("long")
    placed = rows.select(first.alias("point"), label).groupBy("point").agg(
        F.sum(label).cast("long").alias("hits")
    )
    size = rows.agg(F.count("*")).scalar()
    positives = rows.agg(F.sum(label).cast("long")).scalar()
    grid = scores.sparkSession.range(points).withColumnRenamed("id", "point")
    # the grid has a fixed number of points whatever the data size
    upto = W.orderBy("point").rowsBetween(W.unboundedPreceding, 0)
    curve = grid.join(placed, "point", "left").select(
        "point",
        (F.lit(step) + F.col("point") * F.lit(step)).alias("proportion"),
        F.coalesce(F.sum("hits").over(upto), F.lit(0)).alias("hits"),
    ).withColumn("n", int_part(F.col("proportion") * size))
    return curve.select(
        "point", "proportion", "n",
        ratio("hits", "n").alias("precision"),
        F.when(F.col("n") > 0, ratio("hits", positives)).alias("recall"),
    )


def score_histogram(scores: DataFrame, bins: int = 100, score: str = "score") -> DataFrame:
    """Equal-width bins over the score range, the last one closed; empty bins count 0."""
    low, high = scores.agg(F.min(score)).scalar(), scores.agg(F.max(score)).scalar()
    flat = low == high
    start = F.when(flat, low - 0.5).otherwise(low)
    width = F.when(flat, F.lit(1.0)).otherwise(high - low) / bins
    index = F.least(F.floor((F.col(score) - start) / width), F.lit(bins - 1)).cast("long")
    binned = scores.where(F.col(score).isNotNull()).select(index.alias("bin"))
    counts = binned.groupBy("bin").agg(F.count("*").alias("n"))
    grid = scores.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return grid.join(counts, "bin", "left").select(
        "bin", (start + F.col("bin") * width).alias("left_edge"), F.coalesce("n", F.lit(0)).alias("n")
    )


def cross_tabs(flagged: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean of each feature among the top rows and among the rest."""
    return flagged.groupBy(*by, (F.col("predicted") == 1).alias("is_top")).agg(
        *[F.avg(F.col(f"`{f}`").cast("double")).alias(f) for f in features]
    )


def feature_importances(
    df: DataFrame, names: Sequence[str], weights: Sequence[float], top_n: int = 20
) -> DataFrame:
    """The ``top_n`` heaviest features of a fitted model, by name."""
    if len(names) != len(weights):
        raise ValueError(f"{len(names)} names for {len(weights)} importances")
    table = small_table(
        df.sparkSession,
        [(i, n, float(w)) for i, (n, w) in enumerate(zip(names, weights))],
        "feature_index int, feature string, importance double",
    )
    return table.orderBy(F.desc("importance"), "feature_index").limit(top_n)


def long_results(metrics: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """One row per key and metric, columns ``metric`` and ``value``."""
    return metrics.unpivot(list(keys), list(names), "metric", "value")


def base_rates(labelled: DataFrame, by: Sequence[str], label: str = "y", k: float = 0.3) -> DataFrame:
    """Passed share per group and the best precision the top ``k`` could reach."""
    counts = labelled.groupBy(*by).agg(
        F.count("*").alias("total"), F.sum(label).cast("long").alias("passed")
    )
    n = int_part(F.col("total") * F.lit(float(k)))
    return counts.select(
        *by, "total", "passed",
        ratio("passed", "total").alias("base_rate"),
        clip01(ratio("passed", n)).alias("best_precision"),
    )
