"""Benchmark decontamination: rare n-gram seeds propose passages, Smith-Waterman alignment scores them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foretell.llm.common import WORDS, gram_hashes, run_hashes, runs, word_hashes
from foretell.session import cut_lineage, ship_package

#: log2 of the bits of the seed filter: 2 MB, whatever the size of the benchmark.
FILTER_BITS = 24
MATCH, MISMATCH, GAP = 2, -1, -1


def _words(text: str | None) -> np.ndarray:
    return word_hashes((text or "").lower().encode(), WORDS)


def _slot(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _item_grams(n: int):
    def run(batches):
        for batch in batches:
            items, grams = [], []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                words = _words(text)
                if len(words) >= n:
                    for g in np.unique(gram_hashes(words, n)).view(np.int64).tolist():
                        items.append(item)
                        grams.append(g)
            yield pa.RecordBatch.from_arrays([pa.array(items, batch.schema.field("item").type), pa.array(grams, pa.int64())], names=["item", "gram"])

    return run


def _seen(n: int, bits: np.ndarray):
    """Per text: its n-grams that the filter knows, each once."""

    def run(batches):
        for batch in batches:
            where, found = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                words = _words(text)
                if len(words) < n:
                    continue
                grams = gram_hashes(words, n)
                grams = np.unique(grams[bits[_slot(grams)]])
                if len(grams):
                    where.append(i)
                    found.append(grams.view(np.int64))
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            flat = np.concatenate(found) if found else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").take(pa.array(where, pa.int64())), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                names=["doc", "grams"],
            )

    return run


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of two word sequences: score, start and end in the passage.

    A row of the table is computed at once: gaps along it are a running maximum.
    """
    m = len(passage)
    above, above_from = np.zeros(m + 1, np.int64), np.arange(m + 1)
    slope = -GAP * np.arange(m + 1)
    best = (0, 0, 0)
    for word in item:
        diagonal = above[:-1] + np.where(passage == word, MATCH, MISMATCH)
        up = above[1:] + GAP
        score = np.zeros(m + 1, np.int64)
        start = np.arange(m + 1)
        np.maximum(diagonal, up, out=score[1:])
        start[1:] = np.where(diagonal >= up, above_from[:-1], above_from[1:])
        fresh = score <= 0
        score[fresh], start[fresh] = 0, np.flatnonzero(fresh)
        raised = score + slope
        top = np.maximum.accumulate(raised)
        source = np.maximum.accumulate(np.where(raised == top, np.arange(m + 1), 0))
        score, start = top - slope, start[source]
        at = int(score.argmax())
        if score[at] > best[0]:
            best = (int(score[at]), int(start[at]), at)
        above, above_from = score, start
    return best


def passages(item: np.ndarray, words: np.ndarray, hits: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Ranges of words around seed hits in which a full alignment of the item fits, merged where they touch."""
    reach = 2 * len(item) + n  # matches at 2 pay for gaps at 1 up to twice the item's length
    out: list[tuple[int, int]] = []
    for p in hits.tolist():
        low, high = max(0, p - reach), min(len(words), p + n + reach)
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], high)
        else:
            out.append((low, high))
    return out


def _score(n: int, min_score: float):
    def run(batches):
        items: dict[str, np.ndarray] = {}
        for batch in batches:
            rows = []
            columns = [batch.column(c).to_pylist() for c in ("doc", "text", "items")]
            for doc, text, wanted in zip(*columns):
                data = (text or "").lower().encode()
                starts, ends = runs(data, WORDS)
                words = run_hashes(data, starts, ends)
                grams = gram_hashes(words, n)
                for entry in wanted:
                    key = entry["item_text"]
                    if key not in items:
                        if len(items) >= 4096:
                            items.clear()
                        items[key] = _words(key)
                    item = items[key]
                    hits = np.flatnonzero(np.isin(grams, np.array(entry["seeds"], np.int64).view(np.uint64)))
                    best = (0, 0, 0)
                    for low, high in passages(item, words, hits, n):
                        score, start, end = align(item, words[low:high])
                        if score > best[0]:
                            best = (score, low + start, low + end)
                    value = best[0] / (MATCH * len(item))
                    if value >= min_score:
                        passage = data[starts[best[1]] : ends[best[2] - 1]].decode()
                        rows.append((doc, entry["item"], value, best[1], best[2], passage))
            names = ("doc", "item", "score", "first_word", "last_word", "passage")
            types = (batch.schema.field("doc").type, batch.schema.field("items").type.value_type.field("item").type,
                     pa.float64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=list(names)
            )

    return run


def seed_filter(grams: DataFrame) -> np.ndarray:
    """Bits of the slots of n-grams (longs). The driver gets 2^FILTER_BITS / 32 words at most."""
    slot = F.shiftrightunsigned("gram", 64 - FILTER_BITS)
    words = grams.select(slot.alias("s")).groupBy(F.shiftright("s", 5).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(s & 31 as int))")).alias("b")
    )
    bits = np.zeros((1 << (FILTER_BITS - 5), 32), bool)
    for w, b in words.toLocalIterator():
        bits[w] = [(b >> k) & 1 for k in range(32)]
    return bits.ravel()


def contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", *, n: int = 3, min_score: float = 0.6, several: int = 3,
) -> DataFrame:
    """Documents that hold a copy, also an edited one, of a benchmark item.

    One row per pair found: ``id_col``, ``item_col``, ``score`` (best local alignment over a
    perfect one, 0 to 1), ``first_word``, ``last_word`` (range in the document's words, end exclusive),
    ``passage`` (lower case). ``score`` >= ``min_score``.

    Words are runs of letters, digits and ``_`` (non-ASCII counts as letters), lower-cased. Items or
    documents of fewer than ``n`` words, empty or null texts give no pair. Rows that share an id
    are parts of one document or item: the best of their scores is reported, ties by position.

    Of an item's n-grams that documents hold, those in no more documents than the median one are rare: by
    the item's own standard, so that an item copied into a third of all documents keeps rare seeds. A
    document is aligned with an item if it holds a rare seed of it, or ``several`` seeds of any kind, which
    finds copies of a part that is common. Document frequencies cover all documents. Documents are first scanned with a bit filter of fixed size, so
    only n-grams that probably are an item's get shuffled; each pair is then aligned once, around
    its seed hits. Neither the items nor the documents pass through the driver.
    """
    ship_package(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    tests = items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))
    doc_type, item_type = texts.schema["doc"].dataType.simpleString(), tests.schema["item"].dataType.simpleString()
    grams = cut_lineage(tests.mapInArrow(_item_grams(n), f"item {item_type}, gram long").distinct())
    bits = seed_filter(grams)
    seen = cut_lineage(texts.mapInArrow(_seen(n, bits), f"doc {doc_type}, grams array<long>"))
    hits = seen.select("doc", F.explode("grams").alias("gram"))
    # rows of false hits of the filter end here
    common = hits.join(grams.select("gram").distinct(), "gram").groupBy("gram").agg(F.count("*").alias("df"))
    known = grams.join(common, "gram")  # the others are in no document
    middle = known.groupBy("item").agg(F.median("df").alias("middle")).withColumnRenamed("item", "i")
    seeds = known.join(middle, F.col("item").eqNullSafe(F.col("i"))).select("item", "gram", (F.col("df") <= F.col("middle")).alias("rare"))
    pairs = hits.join(seeds, "gram").groupBy("doc", "item").agg(F.collect_set("gram").alias("seeds"), F.max("rare").alias("rare"))
    pairs = pairs.where(F.col("rare") | (F.size("seeds") >= several))
    wanted = pairs.join(tests.withColumnRenamed("item", "i"), F.col("item").eqNullSafe(F.col("i"))).groupBy("doc").agg(
        F.collect_list(F.struct("item", "seeds", F.coalesce("text", F.lit("")).alias("item_text"))).alias("items")
    )
    work = texts.join(wanted.withColumnRenamed("doc", "d"), F.col("doc").eqNullSafe(F.col("d"))).select("doc", "text", "items")
    found = work.mapInArrow(
        _score(n, min_score),
        f"doc {doc_type}, item {item_type}, score double, first_word long, last_word long, passage string",
    )
    best = found.groupBy("doc", "item").agg(
        F.min(F.struct((-F.col("score")).alias("s"), "first_word", "last_word", "passage")).alias("b")
    )
    return best.select(
        F.col("doc").alias(id_col), F.col("item").alias(item_col), (-F.col("b.s")).alias("score"),
        "b.first_word", "b.last_word", "b.passage",
    )
