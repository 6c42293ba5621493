"""Near-duplicate embeddings: tiles in PCA order, suffix norms bound what is left of a dot product."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foretell.llm.common import linked_rows, local_roots
from foretell.session import cut_lineage, ship_package

#: Vectors of a tile, and rows of it that are multiplied at a time: both bound a task's memory.
TILE_ROWS, BLOCK_ROWS = 1 << 12, 1 << 9
#: Bins of the leading coordinate, which lies between -1 and 1.
BINS = 1 << 10
#: Room for rounding in bounds; decisions are exact.
SLACK = 1e-9


def _outer(batches):
    """Sums of x_i x_j over unit vectors of each length."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        by_size: dict[int, list] = {}
        for v in batch.column("vector").to_pylist():
            by_size.setdefault(len(v), []).append(v)
        for d, rows in by_size.items():
            x = np.array(rows)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            sums[d] = sums.get(d, 0) + x.T @ x
    for d, total in sums.items():
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_pydict({
            "d": np.full(d * d, d), "i": i.ravel(), "j": j.ravel(), "s": np.asarray(total).ravel(),
        })


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each vector length d, a d x d basis with the directions of most energy first.

    The driver gets d^2 sums per length, whatever the number of vectors.
    """
    sums = vectors.mapInArrow(_outer, "d long, i long, j long, s double").groupBy("d", "i", "j").agg(F.sum("s").alias("s"))
    tables: dict[int, np.ndarray] = {}
    for d, i, j, s in sums.collect():
        tables.setdefault(d, np.zeros((d, d)))[i, j] = s
    return {d: np.linalg.eigh(t)[1][:, ::-1] for d, t in tables.items()}


def _leading(axes):
    def run(batches):
        for batch in batches:
            lead = []
            for v in batch.column("vector").to_pylist():
                x = np.array(v)
                lead.append(float(x @ axes[len(v)][:, 0] / np.linalg.norm(x)))
            bins = np.clip(np.floor((np.array(lead) + 1) / 2 * BINS), 0, BINS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bins)], names=[*batch.schema.names, "bin"])

    return run


def linked_pairs(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of rows of a and b whose cosine reaches the threshold, in double precision.

    Both are rotated to unit vectors in PCA order. After each step of dimensions, the partial
    product plus the product of the norms of the remaining parts (Cauchy-Schwarz) bounds
    the cosine. Dense steps go on while many pairs are alive, then only the living are summed.
    """
    unit_a, unit_b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (a, b))
    pa_, pb = unit_a @ axes, unit_b @ axes
    d = a.shape[1]
    steps = sorted({min(d, s) for s in (4, 8, 16, 32, 64, *range(128, d + 128, 128))})

    def rest(x):
        squares = np.cumsum((x**2)[:, ::-1], axis=1)[:, ::-1]
        return np.sqrt(np.concatenate((squares, np.zeros((len(x), 1))), axis=1))

    rest_a, rest_b = rest(pa_), rest(pb)
    for start in range(0, len(a), BLOCK_ROWS):
        x, rx = pa_[start : start + BLOCK_ROWS], rest_a[start : start + BLOCK_ROWS]
        done, partial = 0, np.zeros((len(x), len(b)))
        for stop in steps:
            partial += x[:, done:stop] @ pb[:, done:stop].T
            done = stop
            alive = partial >= threshold - SLACK - rx[:, done, None] * rest_b[None, :, done]
            if done == d or np.count_nonzero(alive) < 0.05 * alive.size:
                break
        i, j = np.nonzero(alive)
        value = partial[i, j]
        for stop in steps[steps.index(done) + 1 :]:
            value = value + np.einsum("ij,ij->i", x[i, done:stop], pb[j, done:stop])
            done = stop
            keep = value >= threshold - SLACK - rx[i, done] * rest_b[j, done]
            i, j, value = i[keep], j[keep], value[keep]
        i = i + start
        for part in range(0, len(i), 1 << 16):
            p, q = i[part : part + (1 << 16)], j[part : part + (1 << 16)]
            exact = np.einsum("ij,ij->i", a[p], b[q]) / np.sqrt(
                np.einsum("ij,ij->i", a[p], a[p]) * np.einsum("ij,ij->i", b[q], b[q])
            )
            hit = exact >= threshold
            yield p[hit], q[hit]


def _compare(axes, threshold: float):
    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        keys = np.array(table.column("key").to_pylist(), object)
        count = table.column("n").to_numpy()
        flat = table.column("vector").combine_chunks()
        vectors = np.asarray(flat.flatten()).reshape(len(keys), -1)
        first, second = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        same = not len(second)  # a tile against itself
        if same:
            second = first
        links, root = np.zeros(len(keys), np.int64), np.arange(len(keys))
        for i, j in linked_pairs(vectors[first], vectors[second], axes[vectors.shape[1]], threshold):
            p, q = first[i], second[j]
            if same:
                p, q = p[i != j], q[i != j]
            np.add.at(links, p, count[q])
            if not same:
                np.add.at(links, q, count[p])
            # merge block by block, so that links themselves are never kept
            root = local_roots(len(keys), np.concatenate((np.arange(len(keys)), p)), np.concatenate((root, q)))
        hit = np.flatnonzero(links > 0)
        return pa.table({
            "key": pa.array(list(keys[hit]), pa.string()), "links": pa.array(links[hit], pa.int64()),
            "root": pa.array(list(keys[root[hit]]), pa.string()),
        })

    return run


def vector_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", *,
    threshold: float = 0.93,
) -> DataFrame:
    """Links of vectors with equal, non-null labels and a cosine of at least ``threshold``.

    One row per row of ``vectors``: ``id_col``, ``n_links`` (other rows linked directly),
    ``component_id`` (least id reachable over links), ``kept`` (it is that id).

    A vector that is null, empty, all zero, or holds null or non-finite values, and one with a
    null label, links with nothing. Vectors of different lengths do not link. Equal vectors of a
    label are one class with a count, so copies cost nothing. Rows that repeat an id are separate
    rows; a null id has no order.

    Labels are cut into tiles of bounded size along the leading principal coordinate u; tiles
    whose ranges are further apart than sqrt(2 - 2 threshold) cannot hold a link, as
    (u - v)^2 <= |x - y|^2 = 2 - 2 cos. Other tile pairs of a label go to one task each.
    """
    ship_package(vectors.sparkSession)
    rows = vectors.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"),
        F.transform(F.col(vector_col), lambda x: x.cast("double") + F.lit(0.0)).alias("vector"),  # -0.0 becomes 0.0
    )
    usable = F.col("label").isNotNull() & F.coalesce(
        F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))) & F.exists("vector", lambda x: x != 0),
        F.lit(False),
    )
    # two chained hashes of 64 bits
    name = F.concat(F.hex(F.xxhash64("label", "vector")), F.lit("-"), F.hex(F.xxhash64("vector", "label")))
    rows = rows.withColumn("key", F.when(usable, name))
    classes = rows.where("key is not null").groupBy("key").agg(
        F.count("*").alias("n"), F.min("id").alias("low"), F.first("label").alias("label"), F.first("vector").alias("vector"),
    )
    classes = cut_lineage(classes)
    axes = principal_axes(classes.select("vector"))
    id_type, label_type = (rows.schema[c].dataType.simpleString() for c in ("id", "label"))
    binned = cut_lineage(classes.mapInArrow(
        _leading(axes), f"key string, n long, low {id_type}, label {label_type}, vector array<double>, bin long"
    ))
    group = [F.col("label"), F.size("vector").alias("d")]
    bins = binned.groupBy(*group, "bin").count()
    before = Window.partitionBy("label", "d").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    placed = bins.select(
        "label", "d", "bin", F.floor(F.coalesce(F.sum("count").over(before), F.lit(0)) / TILE_ROWS).alias("run"),
        F.ceil(F.col("count") / TILE_ROWS).alias("parts"),
    )
    tiled = binned.withColumn("d", F.size("vector")).join(placed, ["label", "d", "bin"]).withColumn(
        "tile", F.xxhash64("label", "d", "run", F.when(F.col("parts") > 1, F.pmod(F.xxhash64("key"), F.col("parts"))), F.when(F.col("parts") > 1, F.col("bin")))
    )
    tiled = cut_lineage(tiled.select("key", "n", "tile", "label", "d", "bin", "vector"))
    tiles = tiled.groupBy("label", "d", "tile").agg(F.min("bin").alias("from"), F.max("bin").alias("to"))
    others = tiles.select("label", "d", *[F.col(c).alias(f"other_{c}") for c in ("tile", "from", "to")])
    reach = np.sqrt(2 - 2 * min(threshold, 1.0)) * BINS / 2 + 1 + 1e-6
    near = (F.col("other_from") - F.col("to") <= reach) & (F.col("from") - F.col("other_to") <= reach)
    crossed = tiles.join(others, ["label", "d"]).where((F.col("tile") < F.col("other_tile")) & near).select("tile", "other_tile")
    columns = ["key", "n", "vector"]
    work = tiled.select(F.col("tile").alias("first"), F.col("tile").alias("second"), F.lit(0).alias("side"), *columns)
    for side, column in enumerate(("tile", "other_tile")):
        work = work.unionByName(tiled.select("tile", *columns).join(
            crossed.select(F.col("tile").alias("first"), F.col("other_tile").alias("second"), F.col(column).alias("tile")), "tile"
        ).select("first", "second", F.lit(side).alias("side"), *columns))
    found = work.groupBy("first", "second").applyInArrow(_compare(axes, threshold), "key string, links long, root string")
    joined = linked_rows(rows.select("id", "key"), classes.select("key", "n", "low"), found)
    return joined.select(
        F.col("id").alias(id_col), "n_links", F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )
