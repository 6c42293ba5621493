"""Shared pieces: word runs and their hashes, copy classes, connected components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from foretell.session import cut_lineage

SPACE = " \t\n\r\f\v"
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_BYTE_KEYS = np.random.default_rng(20240229).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def byte_classes(*groups: str) -> np.ndarray:
    """Class of each byte: the number of its group from 1, else 0. ``word`` is letters, digits, ``_`` and non-ASCII."""
    table = np.zeros(256, np.uint8)
    for number, group in enumerate(groups, 1):
        for b in range(256):
            c = chr(b)
            word = b >= 128 or c.isalnum() or c == "_"
            blank = c in SPACE
            if {"word": word, "mark": not word and not blank and b >= 32, "visible": not blank}[group]:
                table[b] = number
    return table


WORDS = byte_classes("word")
WORDS_AND_MARKS = byte_classes("word", "mark")
VISIBLE = byte_classes("visible")


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


_INVERSE = pow(_MULTIPLIER, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0 to base^(n-1) modulo 2^64, at least."""
    if len(_powers.get(base, ())) < n:
        with np.errstate(over="ignore"):
            steps = np.full(max(n, 1 << 16), base, np.uint64)
            steps[0] = 1
            _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return _powers[base]


def runs(data: bytes, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of bytes of one class other than 0."""
    if not data:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    kind = classes[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    starts, ends = np.concatenate(([0], edges)), np.concatenate((edges, [len(kind)]))
    keep = kind[starts] != 0
    return starts[keep], ends[keep]


def run_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run; equal bytes give equal hashes, in every process."""
    if not len(starts):
        return np.empty(0, np.uint64)
    keys = _BYTE_KEYS[np.frombuffer(data, np.uint8)]
    total = np.zeros(len(keys) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(keys * _power(_MULTIPLIER, len(keys))[: len(keys)], out=total[1:])
        shifted = (total[ends] - total[starts]) * _power(_INVERSE, len(keys))[starts]
        return mix(shifted + (ends - starts).astype(np.uint64))


def word_hashes(data: bytes, classes: np.ndarray = WORDS) -> np.ndarray:
    starts, ends = runs(data, classes)
    return run_hashes(data, starts, ends)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words; a shorter, non-empty text has the one run of all its words."""
    if not len(words):
        return words
    n = min(n, len(words))
    count = len(words) - n + 1
    with np.errstate(over="ignore"):
        h = np.full(count, n, np.uint64)
        for k in range(n):
            h = mix(h + words[k : k + count] * np.uint64(2 * k + 3))
    return h


def normal_text(text: Column) -> Column:
    """Lower case, single blanks between words, none at the ends; null is empty."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[ \\t\\n\\r\\f\\x0b]+", " "))


def spare_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores in front as long as ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def with_fields(df: DataFrame, added: str) -> StructType:
    """The schema of ``df`` and more fields."""
    return StructType([*df.schema.fields, *StructType.fromDDL(added).fields])


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node of the undirected edges ``(a, b)``; the root is the component's least node.

    Large-star and small-star steps in turn; each halves the depth, and each is written to
    the shared folder, until only stars are left. Nothing but a count reaches the driver.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e = cut_lineage(e)
    while not _only_stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut_lineage(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _only_stars(e: DataFrame) -> bool:
    """Whether every ``u`` has one ``v`` that is no ``u`` itself."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("up")).unionByName(e.select(F.col("v").alias("node"), F.lit(0).alias("up")))
    ups = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return ups.where("ups > 1 or (ups = 1 and least = 0)").isEmpty()


def local_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Least index reachable from each of ``n`` nodes over the given links."""
    root = np.arange(n)
    while len(left):
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        while True:
            jumped = new[new]
            if (jumped == new).all():
                break
            new = jumped
        root = new
        apart = root[left] != root[right]
        left, right = left[apart], right[apart]
    return root


def linked_rows(members: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    """One row per member of copy classes: its links and its component.

    ``members``: ``id``, ``key`` (null: links with nothing). ``classes``: ``key``, ``n`` (its
    members), ``low`` (least id). ``found``: ``key``, ``links`` (members of other classes that
    are linked, each pair once), ``root`` (a class reached over these links), any number of rows
    per class.
    """
    found = cut_lineage(found)
    reached = components(found.select(F.col("key").alias("a"), F.col("root").alias("b")))
    rooted = classes.join(reached.withColumnRenamed("node", "key"), "key", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "key"))
    least = rooted.groupBy("root").agg(F.min("low").alias("component"))
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    per_class = rooted.join(least, "root").join(links, "key", "left").select(
        "key", "component", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    return members.join(per_class, "key", "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component")).alias("component"),
    )
