"""N-gram Jaccard join: MinHash bands find candidates, full n-gram sets decide."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foretell.llm.common import (
    VISIBLE, gram_hashes, linked_rows, local_roots, normal_text, word_hashes,
)
from foretell.session import cut_lineage, ship_package

#: Size of a tile, which bounds the memory of a task: n-grams, or documents if they are short.
TILE_GRAMS, TILE_ROWS = 1 << 19, 1 << 11
#: Size up to which the classes with a candidate are sent to every executor, and bytes of one besides its bands.
BROADCAST_BYTES, CLASS_BYTES = 64 << 20, 128


def plan_bands(threshold: float, recall: float, hashes: int = 128) -> tuple[int, int]:
    """Bands and rows: the most rows per band with which at most ``hashes`` hashes reach the recall.

    A pair at the threshold t is missed with probability (1 - t^rows)^bands.
    """
    best = None
    for rows in range(1, hashes + 1):
        hit = threshold**rows
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - hit))
        if bands * rows <= hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError(f"{hashes} hashes do not reach recall {recall} at {threshold}")
    return best


def band_hashes(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """MinHash bands of non-empty sets, one row per set; equal values mean equal bands of one number."""
    rng = np.random.default_rng(7)
    a = rng.integers(0, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 2**63, bands * rows, dtype=np.uint64)
    flat = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.empty((len(sets), bands), np.uint64)
    with np.errstate(over="ignore"):
        for band in range(bands):
            h = np.full(len(sets), band + 1, np.uint64)
            for k in range(band * rows, (band + 1) * rows):
                low = np.minimum.reduceat(flat * a[k] + b[k], starts)
                h = (h ^ low) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            out[:, band] = h
    return out.view(np.int64)


def _grams(text: str, n: int) -> np.ndarray:
    return np.unique(gram_hashes(word_hashes(text.encode(), VISIBLE), n))


def _batches(texts: list[str], n: int, size: int = 1 << 18) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Positions and n-gram sets of non-empty texts, about ``size`` n-grams at a time."""
    where, sets, total = [], [], 0
    for i, text in enumerate(texts):
        grams = _grams(text, n)
        if len(grams):
            where.append(i)
            sets.append(grams)
            total += len(grams)
        if total >= size:
            yield where, sets
            where, sets, total = [], [], 0
    if where:
        yield where, sets


def _sign(n: int, bands: int, rows: int):
    def run(batches):
        for batch in batches:
            for where, sets in _batches(batch.column("words").to_pylist(), n):
                signs = band_hashes(sets, bands, rows)
                part = batch.take(pa.array(where)).select(["key", "id"])
                width = np.arange(0, signs.size + 1, bands, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(width), pa.array(signs.ravel()))],
                    names=["key", "id", "grams", "bands"],
                )

    return run


def _expand(n: int):
    """N-gram sets instead of words. Of rows that repeat a key, which repeat an id and its text, a task keeps one."""

    def run(batches):
        seen: set[bytes] = set()
        for batch in batches:
            keys = batch.column("key").to_pylist()
            fresh = [i for i, key in enumerate(keys) if not (key in seen or seen.add(key))]
            batch = batch.take(pa.array(fresh, pa.int64()))
            for where, sets in _batches(batch.column("words").to_pylist(), n):
                part = batch.take(pa.array(where)).drop_columns(["words"])
                sets = pa.array([s.tobytes() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, sets], names=[*part.schema.names, "grams"])

    return run


def linked_pairs(bands_a, sets_a, bands_b, sets_b, threshold) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of a: the rows of b that share a band with it and reach the threshold on their full sets."""
    vocabulary, ids = np.unique(np.concatenate([*sets_a, *sets_b]), return_inverse=True)
    size_a, size_b = np.array([len(s) for s in sets_a]), np.array([len(s) for s in sets_b])
    ends = np.cumsum(np.concatenate((size_a, size_b)))
    of_a = np.split(ids, ends[:-1])
    of_b, of_a = of_a[len(sets_a) :], of_a[: len(sets_a)]
    flags = np.zeros(len(vocabulary), bool)
    for i, own in enumerate(of_a):
        rows = np.flatnonzero((bands_b == bands_a[i]).any(axis=1))
        rows = rows[np.minimum(size_b[rows], size_a[i]) >= threshold * np.maximum(size_b[rows], size_a[i]) - 1e-9]
        if not len(rows):
            continue
        flags[own] = True
        flat = np.concatenate([of_b[j] for j in rows])
        starts = np.concatenate(([0], np.cumsum(size_b[rows])[:-1]))
        shared = np.add.reduceat(flags[flat], starts, dtype=np.int64)
        flags[own] = False
        # in integers, as floats would lose pairs that are exactly at the threshold
        union = size_a[i] + size_b[rows] - shared
        rows = rows[shared * 10**9 >= np.int64(round(threshold * 10**9)) * union]
        if len(rows):
            yield i, rows


def _verify(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        keys = np.array(table.column("key").to_pylist(), object)
        count = table.column("n").to_numpy()
        sets = [np.frombuffer(s, np.uint64) for s in table.column("grams").to_pylist()]
        bands = np.array(table.column("bands").to_pylist(), np.int64).reshape(len(sets), -1)
        order = np.array(sorted(range(len(keys)), key=lambda i: (side[i], keys[i])))
        fresh = np.ones(len(order), bool)  # rows that repeat an id and its text come once
        fresh[1:] = (keys[order][1:] != keys[order][:-1]) | (side[order][1:] != side[order][:-1])
        order = order[fresh]
        split = int((side[order] == 0).sum())
        first, second = order[:split], order[split:]
        same = not len(second)  # a tile against itself
        if same:
            second = first
        links, left, right = np.zeros(len(keys), np.int64), [], []
        pairs = linked_pairs(bands[first], [sets[i] for i in first], bands[second], [sets[i] for i in second], threshold)
        for i, rows in pairs:
            if same:
                rows = rows[rows != i]
                links[first[i]] += count[second[rows]].sum()
            else:
                links[first[i]] += count[second[rows]].sum()
                links[second[rows]] += count[first[i]]
            left.append(np.full(len(rows), first[i]))
            right.append(second[rows])
        left = np.concatenate(left) if left else np.empty(0, np.int64)
        right = np.concatenate(right) if right else np.empty(0, np.int64)
        root = local_roots(len(keys), left, right)
        hit = np.flatnonzero(links > 0)
        return pa.table({
            "key": pa.array(list(keys[hit]), pa.binary()), "links": pa.array(links[hit], pa.int64()),
            "root": pa.array(list(keys[root[hit]]), pa.binary()),
        })

    return run


def jaccard_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, n: int = 5, threshold: float = 0.8,
    recall: float = 0.999999, hashes: int = 128,
) -> DataFrame:
    """Near-duplicate classes of texts: Jaccard similarity of word n-gram sets of at least ``threshold``.

    Returns one row per row of ``docs``: ``id_col``, ``n_links`` (other rows linked with it
    directly), ``class_id`` (least id reachable over links) and ``kept`` (it is that id).

    Words are the lower-cased text split at ASCII white space. A text of fewer words than ``n`` has
    one n-gram, all its words. Texts of the same words are copies, linked with each other whatever
    their length; null counts as empty, so empty texts are copies too, but link with nothing
    else. Rows that repeat an id are separate rows. A null id has no order: it is the class id
    only of a class without another id.

    Bands and rows follow from ``recall``, the least share of pairs at the threshold that meet in
    a band. Steps: copies become one class; classes that share a band hash with another get a home,
    their largest bucket; a home is cut into tiles of bounded size by a hash; two tiles are compared
    where some bucket has members in both. Each pair of classes so meets in one task only, where the
    bands pick candidates and the full sets decide. Tasks return counts and one local root per
    class, no pairs, so a group of any size costs comparisons but no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    bands, rows = plan_bands(threshold, recall, hashes)
    normal = docs.select(F.col(id_col).alias("id"), normal_text(F.col(text_col)).alias("words"))
    normal = normal.withColumn("key", F.unhex(F.md5("words")))
    id_type = normal.schema["id"].dataType.simpleString()
    signed = normal.select("key", "id", "words").mapInArrow(
        _sign(n, bands, rows), f"key binary, id {id_type}, grams long, bands array<long>"
    )
    classes = cut_lineage(signed.groupBy("key").agg(
        F.count("*").alias("n"), F.min("id").alias("low"), F.first("grams").alias("grams"), F.first("bands").alias("bands"),
    ))
    members = normal.select("id", "key")

    # buckets with several classes, and each class's home among them
    entries = classes.select("key", "grams", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count("*").alias("size"), F.sum("grams").alias("total")).where("size > 1")
    entries = entries.select("key", "bucket").join(shared, "bucket")
    entries = cut_lineage(entries)
    chunks = F.ceil(F.greatest(F.col("total") / TILE_GRAMS, F.col("size") / TILE_ROWS)).cast("long")
    home = entries.groupBy("key").agg(F.max(F.struct("size", "bucket", "total")).alias("home")).select("key", "home.*")
    home = cut_lineage(home.select(
        "key", F.xxhash64("bucket", F.pmod(F.xxhash64("key"), chunks)).alias("tile"),
    ))
    touched = entries.select("key", "bucket").join(home, "key").select("bucket", "tile").distinct()
    other = touched.select("bucket", F.col("tile").alias("other"))
    several = touched.groupBy("bucket").count().where("count > 1").select("bucket")
    crossed = touched.join(several, "bucket").join(other, "bucket").where("tile < other").select("tile", "other").distinct()

    # texts of one member of each class that has a home
    chosen = classes.join(home, "key").select("key", "low", "n", "tile", "bands")
    if home.count() * (8 * bands + CLASS_BYTES) <= BROADCAST_BYTES:
        chosen = F.broadcast(chosen)  # spares the texts a shuffle
    own = normal.select("id", "words", F.col("key").alias("own"))
    texts = own.join(chosen, (own.own == chosen.key) & own.id.eqNullSafe(chosen.low))
    tiles = cut_lineage(texts.select("key", "n", "tile", "bands", "words").mapInArrow(
        _expand(n), "key binary, n long, tile long, bands array<long>, grams binary"
    ))
    alone = tiles.select(F.col("tile").alias("first"), F.col("tile").alias("second"), F.lit(0).alias("side"), *tiles.columns)
    sides = [
        tiles.join(crossed, tiles.tile == crossed[column]).select(
            crossed.tile.alias("first"), crossed.other.alias("second"), F.lit(side).alias("side"), *[tiles[c] for c in tiles.columns]
        )
        for side, column in enumerate(("tile", "other"))
    ]
    work = alone.unionByName(sides[0]).unionByName(sides[1])
    found = work.groupBy("first", "second").applyInArrow(
        _verify(threshold), "key binary, links long, root binary"
    )
    empty = members.where(F.col("key") == F.unhex(F.md5(F.lit("")))).groupBy("key").agg(
        F.count("*").alias("n"), F.min("id").alias("low"))
    whole = classes.select("key", "n", "low").unionByName(empty)
    joined = linked_rows(members, whole, found)
    return joined.select(
        F.col("id").alias(id_col), "n_links", F.col("component").alias("class_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )
