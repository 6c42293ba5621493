"""URL filter: rules first, then the ratio of two variable-order character models."""

from __future__ import annotations


import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foretell.session import cut_lineage

START, END = "\u0002", "\u0003"
#: Of the URLs that rules judge, one in so many calibrates and is not counted.
HELD_OUT = 5
#: Characters that an unseen one is taken to be one of.
ALPHABET = 256


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased; else empty."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, or nulls. A rule is ``host/path`` and a verdict."""
    found = verdict = F.lit(None).cast("string")
    for rule, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        found, verdict = F.when(fits, rule).otherwise(found), F.when(fits, says).otherwise(verdict)
    return found, verdict


def _grams(url: Column, order: int) -> Column:
    """For each character and the end of a URL: it and the ``order`` characters before it."""
    plain = F.regexp_replace(url, "[^\\x00-\\x{FFFF}]", "�")
    return F.regexp_extract_all(F.concat(F.lit(START * order), plain, F.lit(END)), F.lit(f"(?s)(?=(.{{{order + 1}}}))"), F.lit(1))


def fit_logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(y) = 1 / (1 + exp(-(slope x + offset))) for weighted points, lightly ridged."""
    w, design = np.zeros(2), np.stack((x, np.ones(len(x))), axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (n * (p - y)) + 1e-2 * w
        hessian = design.T @ (design * (n * p * (1 - p))[:, None]) + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def filter_urls(
    pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", *, order: int = 5,
    least_probability: float = 0.5,
) -> DataFrame:
    """Verdict on every URL. One row per row: ``id_col``, ``host``, ``path``, ``rule`` (null if none fits),
    ``verdict`` (allow or block), ``ratio`` (null under a rule), ``probability`` (that it is accepted).

    Rules judge first. The URLs they accept and reject, each once however often it occurs, train
    two character models of order 0 to ``order``: of a context seen before,
    P(c) = (count(c) + kinds P'(c)) / (total + kinds), kinds being the distinct characters after it and P' the next
    shorter context; an unseen context passes on P' (Witten-Bell). Other URLs get the mean over their
    characters and end of ln P_accepted - ln P_rejected. A logistic curve fitted to a fifth of the
    ruled URLs, held out by hash, makes it a probability; allow at ``least_probability``.

    Null counts as an empty URL: of it, only the end is scored. A class without URLs has the uniform
    model; without held-out URLs of both classes the curve is 1 / (1 + exp(-ratio)). Characters
    beyond U+FFFF count as U+FFFD.

    Counts are rows, not a model in memory: distinct n-grams of the URLs to be judged meet the
    counts in joins, and their scores join back to the URLs. The driver gets four totals and a
    histogram of scores in steps of 0.01.
    """
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), F.coalesce(url_col, F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    rule, says = rule_for(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "says": says})
    urls = rows.groupBy("url").agg(F.first("says").alias("says"))
    held = F.pmod(F.xxhash64("url"), F.lit(HELD_OUT)) == 0
    urls = cut_lineage(urls.select(
        "url", F.md5("url").alias("key"), "says", (F.col("says").isNull() | held).alias("scored"),
        (F.col("says").isNotNull() & ~held).alias("counted"),
    ))

    accepted, rejected = (F.count_if(F.col("says") == v) for v in ("allow", "block"))
    counts = cut_lineage(
        urls.where("counted").select("says", F.explode(_grams(F.col("url"), order)).alias("gram"))
        .groupBy("gram").agg(accepted.alias("a"), rejected.alias("r"))
    )
    character = F.substring("gram", order + 1, 1)
    k = F.explode(F.sequence(F.lit(0), F.lit(order))).alias("k")
    context = F.expr(f"substring(gram, {order + 1} - k, k)")
    every = counts.select("a", "r", character.alias("c"), "gram", k).select("k", context.alias("context"), "c", "a", "r")
    every = cut_lineage(every.groupBy("k", "context", "c").agg(F.sum("a").alias("a"), F.sum("r").alias("r")))
    follow = F.map_from_entries(F.collect_list(F.struct("c", F.struct("a", "r"))))
    sums = [F.sum("a").alias("all_a"), F.sum("r").alias("all_r"), F.count_if(F.col("a") > 0).alias("kinds_a"), F.count_if(F.col("r") > 0).alias("kinds_r")]
    nodes = every.where("k > 0").groupBy("context").agg(*sums, follow.alias("follow"))
    single = every.where("k = 0").select("c", "a", "r")
    all_a, all_r, kinds_a, kinds_r = (v or 0 for v in single.agg(*sums).first())

    points = urls.where("scored").select("key", F.explode(_grams(F.col("url"), order)).alias("gram"))
    points = points.groupBy("key", "gram").agg(F.count("*").alias("times"))
    grams = points.select("gram").distinct().withColumn("c", character)
    parts = grams.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(order)))).withColumn("context", context)
    one = lambda side: F.coalesce(F.col("follow")[F.col("c")][side], F.lit(0))
    known = parts.join(nodes, "context").select(
        "gram", F.struct("k", one("a").alias("a"), one("r").alias("r"), "all_a", "all_r", "kinds_a", "kinds_r").alias("node")
    ).groupBy("gram").agg(F.sort_array(F.collect_list("node")).alias("nodes"))

    def base(n, total, kinds):
        return (F.coalesce(n, F.lit(0)) + kinds / ALPHABET) / (total + kinds) if total else F.lit(1 / ALPHABET)

    def mixed(side):
        def step(p, x):
            n, total, kinds = x[side], x[f"all_{side}"], x[f"kinds_{side}"]
            return F.when(total > 0, (n + kinds * p) / (total + kinds)).otherwise(p)

        return F.aggregate(F.coalesce("nodes", F.expr("array()").cast(known.schema["nodes"].dataType)), F.col(f"base_{side}"), step)

    scored = grams.join(single, "c", "left").withColumns({
        "base_a": base(F.col("a"), all_a, kinds_a).cast("double"), "base_r": base(F.col("r"), all_r, kinds_r).cast("double"),
    }).join(known, "gram", "left").select("gram", (F.ln(mixed("a")) - F.ln(mixed("r"))).alias("gain"))
    ratios = points.join(scored, "gram").groupBy("key").agg(
        (F.sum(F.col("gain") * F.col("times")) / F.sum("times")).alias("ratio")
    )
    judged = cut_lineage(urls.where("scored").join(ratios, "key").select("url", "says", "ratio"))

    histogram = judged.where("says is not null").groupBy(F.round("ratio", 2).alias("x"), "says").count().collect()
    slope, offset = 1.0, 0.0
    if {h["says"] for h in histogram} == {"allow", "block"}:
        histogram = sorted(histogram)
        slope, offset = fit_logistic(
            np.array([h["x"] for h in histogram]), np.array([h["says"] == "allow" for h in histogram], float),
            np.array([h["count"] for h in histogram], float),
        )
    probability = 1 / (1 + F.exp(-(F.lit(slope) * F.col("ratio") + F.lit(offset))))
    open_ = judged.where("says is null").select("url", "ratio", probability.alias("probability"))
    by_rule = rows.where("rule is not null").withColumns({
        "ratio": F.lit(None).cast("double"), "probability": F.when(F.col("says") == "allow", 1.0).otherwise(0.0)})
    by_model = rows.where("rule is null").join(open_, "url")
    out = by_rule.unionByName(by_model)
    return out.select(
        F.col("id").alias(id_col), "host", "path", "rule",
        F.coalesce("says", F.when(F.col("probability") >= least_probability, "allow").otherwise("block")).alias("verdict"),
        "ratio", "probability",
    )
