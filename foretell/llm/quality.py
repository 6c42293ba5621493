"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foretell.llm.common import WORDS_AND_MARKS, gram_hashes, mix, word_hashes
from foretell.llm.labels import labelled_sample
from foretell.session import cut_lineage, ship_package


def features(text: str, bits: int, most_words: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Hashed positions, ascending, and values of a text's word n-grams: log counts, as a unit vector.

    Words and runs of marks are tokens. An n-gram that ends with its first word also counts as the pattern
    "a word again after n - 1 tokens", so that repetition is learnt for words that no example has.
    """
    words = word_hashes(text.encode(), WORDS_AND_MARKS)
    parts = [gram_hashes(words, n) for n in range(1, most_words + 1) if len(words) >= n]
    parts += [np.full(np.count_nonzero(words[k:] == words[:-k]), mix(np.uint64([k]))[0]) for k in (1, 2)]
    if not len(words):
        return np.empty(0, np.int64), np.empty(0)
    where, times = np.unique((np.concatenate(parts) >> np.uint64(64 - bits)).astype(np.int64), return_counts=True)
    x = 1 + np.log(times)
    return where, x / np.sqrt((x * x).sum())


class Ftrl:
    """FTRL-proximal: per-coordinate steps, weights that L1 keeps at zero."""

    def __init__(self, size: int, alpha: float, beta: float, l1: float, l2: float):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def update(self, at: np.ndarray, x: np.ndarray, y: float) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -30, 30)))
        g = (p - y) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


@dataclass
class QualityModel:
    weights: np.ndarray
    bias: float
    bits: int

    def score(self, text: str) -> float:
        at, x = features(text, self.bits)
        return float(1 / (1 + np.exp(-np.clip(self.weights[at] @ x + self.bias, -30, 30))))


def train_shard(texts: list[str], labels: list[float], bits: int, passes: int, rates: tuple) -> np.ndarray:
    """Weights and bias of one shard, learned row by row in the given order."""
    model = Ftrl((1 << bits) + 1, *rates)
    rows = [features(t, bits) for t in texts]
    rows = [(np.append(at, 1 << bits), np.append(x, 1.0)) for at, x in rows]
    for _ in range(passes):
        for (at, x), y in zip(rows, labels):
            model.update(at, x, y)
    return model.weights()


def fit_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", *,
    use: Column | None = None, max_rows: int = 16_000, shards: int = 4, bits: int = 18, passes: int = 6,
    rates: tuple[float, float, float, float] = (2.0, 1.0, 0.01, 0.0),
) -> QualityModel:
    """Learn from at most ``max_rows`` labelled documents (``use``: condition on the labels).

    The sample is dealt into ``shards`` by a hash of the id; each learns in a task of its own, in hash order,
    and the weights are averaged. So the result does not depend on how the cluster partitions. The driver
    gets ``shards`` vectors of 2^``bits`` weights. Without labelled rows every score is 0.5.
    ``rates``: alpha, beta, L1, L2.
    """
    ship_package(docs.sparkSession)
    sample = labelled_sample(docs, labels, id_col, text_col, label_col, use, max_rows)
    order = F.xxhash64("id", F.lit(2))
    sample = sample.select("text", (F.col("label") > 0).cast("double").alias("y"), order.alias("o"), F.pmod(order, F.lit(shards)).alias("shard"))

    def train(table: pa.Table) -> pa.Table:
        table = table.sort_by([("o", "ascending"), ("text", "ascending")])
        w = train_shard(table.column("text").to_pylist(), table.column("y").to_pylist(), bits, passes, rates)
        return pa.table({"shard": table.column("shard")[:1], "rows": [table.num_rows], "w": [w.astype(np.float32).tobytes()]})

    total, seen = np.zeros((1 << bits) + 1), 0
    made = sample.groupBy("shard").applyInArrow(train, "shard long, rows long, w binary")
    for row in sorted(cut_lineage(made).collect()):
        total += row.rows * np.frombuffer(row.w, np.float32)
        seen += row.rows
    total /= max(1, seen)
    return QualityModel(total[:-1].astype(np.float32), float(total[-1]), bits)


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``score`` (0 to 1) of every whole text.

    Null counts as empty; an empty text has no n-grams, and the bias alone decides. Each row stands
    alone, whatever its id.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            scores = [model.score(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores, pa.float64())], names=["id", "score"])

    return rows.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)
