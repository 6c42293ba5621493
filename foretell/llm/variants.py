"""Spelling variants: words one edit apart, found by a trie over letter-group counts."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foretell.session import cut_lineage, ship_package

#: Letters of words: a to z and the letters' part of Latin-1, so that a code point is a byte.
LETTERS = "A-Za-z\\u00C0-\\u00FF"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Levels of the trie. The counts of frequent letters come first, as they tell most words apart.
GROUPS = (
    *"eainorstlducmp", "hx", "gk", "bq", "fj", "vw", "yz", *("".join(chr(c) for c in range(0xC0 + k, 0x100, 4)) for k in range(4)),
)
#: Words, and bytes of words, of a bucket from which it is cut; words of a leaf; cells that are compared at a time.
TILE_WORDS, TILE_BYTES, LEAF_WORDS, CELLS = 1 << 14, 1 << 22, 48, 1 << 21
#: Most large buckets whose keys are sent to every executor; there is at most one for each TILE_WORDS words.
BROADCAST_ROWS = 1 << 18


def letter_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, least_length: int = 7, spoil_every: int = 31,
) -> DataFrame:
    """``word`` of every run of letters in the texts that keeps ``least_length`` code points, a row each.

    Only A-Z are lower-cased. With h the crc32 of ``<id>:<run>``, a run with h divisible by ``spoil_every`` loses its code
    point h % length. A null id counts as empty text, a null text has no runs.
    """
    found = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))).alias("run"),
    ).withColumn("run", F.translate("run", UPPER, LOWER))
    found = found.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"), F.length("run").alias("size"))
    place = (F.col("h") % F.col("size")).cast("int")
    spoilt = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.col("size")))
    word = F.when(F.col("h") % spoil_every == 0, spoilt).otherwise(F.col("run"))
    return found.select(word.alias("word")).where(F.length("word") >= least_length)


def _count(group: str) -> Column:
    return F.length("word") - F.length(F.translate("word", group, ""))


def _moves(levels: int) -> list[tuple[int, list[int], int, int]]:
    """Where a word looks for others in the top of the trie: change of length and counts, surplus and deficit spent.

    Of two words in different buckets just one visits the other's: the shorter one, or that whose first
    differing count is smaller.
    """
    unit = lambda *at: [at.count(k) - at.count(~k) for k in range(levels)]
    same = [(0, unit(g), 1, 0) for g in range(levels)]
    same += [(0, unit(g, ~h), 1, 1) for g in range(levels) for h in range(g + 1, levels)]
    longer = [(1, unit(), 0, 1)] + [(1, unit(g), 1, 1) for g in range(levels)]
    return same + longer


def letter_counts(flat: np.ndarray, lengths: np.ndarray, first: int) -> np.ndarray:
    """Counts of the groups from ``first`` on, of words whose bytes follow each other in ``flat``."""
    group = np.full(256, len(GROUPS), np.int64)
    for g, letters in enumerate(GROUPS):
        group[list(letters.encode("latin-1"))] = g
    width = len(GROUPS) + 1
    row = np.repeat(np.arange(len(lengths)) * width, lengths)
    counts = np.bincount(row + group[flat], minlength=len(lengths) * width).reshape(-1, width)[:, first:]
    return counts.astype(np.int8 if len(lengths) and lengths.max() < 60 else np.int32)


class Trie:
    """Words of one length as a trie over letter-group counts, held as ranges of sorted count rows."""

    def __init__(self, counts: np.ndarray):
        self.order = np.lexsort(counts.T[::-1]) if len(counts) else np.empty(0, np.int64)
        self.counts = counts[self.order]

    def leaves(self, queries: np.ndarray, surplus: np.ndarray, deficit: np.ndarray):
        """Depth-first search for all queries at once: ``(words, queries)`` of each leaf that they reach.

        Below a child, a query has spent what the child's count is above (surplus) or below (deficit) its own;
        one of each may be spent. Queries without any budget left for a child do not go down.
        """
        depth = self.counts.shape[1]
        stack = [(0, 0, len(self.order), np.arange(len(queries)), surplus, deficit)]
        while stack:
            level, low, high, at, s, f = stack.pop()
            if high - low <= LEAF_WORDS or level == depth:
                yield np.arange(low, high), at, level, s, f
                continue
            column = self.counts[low:high, level]
            cuts = np.flatnonzero(column[1:] != column[:-1]) + 1 + low
            own = queries[at, level]
            for a, b in zip([low, *cuts.tolist()], [*cuts.tolist(), high]):
                d = self.counts[a, level] - own
                more, less = s + np.maximum(d, 0), f - np.minimum(d, 0)
                keep = np.flatnonzero((more < 2) & (less < 2))
                if len(keep):
                    stack.append((level + 1, a, b, at[keep], more[keep], less[keep]))


class _Words:
    """Words of a tile with their bytes in rows, from the front and from the back."""

    def __init__(self, column: pa.ChunkedArray):
        flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        offsets = np.frombuffer(flat.buffers()[1], np.int32)[flat.offset : flat.offset + len(flat) + 1]
        data = np.frombuffer(flat.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(flat) else np.empty(0, np.uint8)
        self.flat, self.lengths = data, np.diff(offsets).astype(np.int64)
        starts = np.cumsum(self.lengths) - self.lengths
        width = int(self.lengths.max()) if len(flat) else 0
        self.front = np.zeros((len(flat), width), np.uint8)
        row = np.repeat(np.arange(len(flat)), self.lengths)
        place = np.arange(len(data)) - np.repeat(starts, self.lengths)
        self.front[row, place] = data
        self.back = np.zeros_like(self.front)
        self.back[row, np.repeat(self.lengths, self.lengths) - 1 - place] = data

    def ends(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The first and the last ``size`` bytes as numbers."""
        scale = 256 ** np.arange(size, dtype=np.uint64)
        return tuple((x[:, :size] * scale[: x.shape[1]]).sum(axis=1, dtype=np.uint64) for x in (self.front, self.back))

    def ranks(self) -> np.ndarray:
        """Places in code-point order; equal words share none."""
        rank = np.empty(len(self.front), np.int64)
        whole = np.ascontiguousarray(self.front).view(f"S{self.front.shape[1]}").ravel()
        rank[np.argsort(whole, kind="stable")] = np.arange(len(whole))
        return rank

    def near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether words i and j, of equal length or the first one shorter by one, differ by exactly one edit."""
        out = np.empty(len(i), bool)
        step = max(1, CELLS // max(1, self.front.shape[1]))
        for k in range(0, len(i), step):
            p, q = i[k : k + step], j[k : k + step]
            common = np.zeros(len(p), np.int64)
            for rows in (self.front, self.back):
                differ = rows[p] != rows[q]
                first = differ.argmax(axis=1)
                common += np.where(differ[np.arange(len(p)), first], first, self.front.shape[1])
            same = self.lengths[p] == self.lengths[q]
            out[k : k + step] = np.where(same, common == self.lengths[p] - 1, common >= self.lengths[p])
        return out


def near_words(words: _Words, home: np.ndarray, surplus, deficit, first: int, ends: int, side: str):
    """Pairs ``(query, home word)`` at one edit: every row is a query of the trie of the rows in ``home``.

    A pair agrees in its first or last ``ends`` letters. Side ``p`` of a cut bucket gives pairs that agree in the first
    ones, ``s`` the other pairs that agree in the last ones.
    """
    counts = letter_counts(words.flat, words.lengths, first)
    trie = Trie(counts[home])
    at_home = home[trie.order]
    head, tail = words.ends(ends)
    for leaf, queries, level, s, f in trie.leaves(counts, surplus, deficit):
        rows = at_home[leaf]
        step = max(1, CELLS // len(rows))
        for k in range(0, len(queries), step):
            q = queries[k : k + step]
            begin, end = head[q, None] == head[rows], tail[q, None] == tail[rows]
            picked = {"a": begin | end, "p": begin, "s": end & ~begin}[side]
            i, j = np.nonzero(picked)
            if not len(i):
                continue
            d = trie.counts[leaf[j], level:] - counts[q[i], level:]
            up = s[k : k + step][i] + np.maximum(d, 0).sum(axis=1)
            down = f[k : k + step][i] - np.minimum(d, 0).sum(axis=1)
            fits = np.flatnonzero((up < 2) & (down < 2))
            i, j = q[i[fits]], rows[j[fits]]
            hit = words.near(i, j)
            if hit.any():
                yield i[hit], j[hit]


_FOUND = "word binary, links long, best_n long, best binary"


def _search(first: int, ends: int):
    """For each word of a tile: its near words there, and the one of largest n, of these the smallest."""

    def run(table: pa.Table) -> pa.Table:
        role = table.column("role").to_numpy()
        home = np.flatnonzero(role == 0)
        column = table.column("word").combine_chunks()
        links, best, best_n = np.zeros(len(role), np.int64), np.full(len(role), -1), np.full(len(role), -1)
        if len(home):
            words, n = _Words(column), table.column("n").to_numpy()
            rank = words.ranks()
            spent = [table.column(c).to_numpy() for c in ("surplus", "deficit")]

            def fold(x, y):
                np.add.at(links, x, 1)
                order = np.lexsort((rank[y], -n[y], x))
                x, y = x[order], y[order]
                top = np.ones(len(x), bool)
                top[1:] = x[1:] != x[:-1]
                x, y = x[top], y[top]
                better = (n[y] > best_n[x]) | ((n[y] == best_n[x]) & (rank[y] < rank[best[x]]))
                best[x[better]], best_n[x[better]] = y[better], n[y[better]]

            held: list[tuple[np.ndarray, np.ndarray]] = []
            total = 0
            side = table.column("side")[0].as_py()
            for i, j in near_words(words, home, *spent, first, ends, side):
                guest = role[i] > 0  # words at home meet in both orders
                held.append((np.concatenate((i, j[guest])), np.concatenate((j, i[guest]))))
                total += len(held[-1][0])
                if total >= CELLS:
                    fold(*map(np.concatenate, zip(*held)))
                    held, total = [], 0
            if held:
                fold(*map(np.concatenate, zip(*held)))
        hit = np.flatnonzero(links)
        return pa.table({
            "word": column.take(pa.array(hit)), "links": pa.array(links[hit], pa.int64()),
            "best_n": pa.array(best_n[hit], pa.int64()), "best": column.take(pa.array(best[hit])),
        })

    return run


def near_counts(words: DataFrame, *, least_length: int = 7, levels: int | None = None) -> DataFrame:
    """``word``, ``n_near`` and ``form`` candidate ``best``, ``best_n`` of all words that have a near one.

    ``words``: distinct ``word`` of letters, at least ``least_length`` (2 or more) long, with ``n``. The top of the
    trie, length and the counts of ``levels`` letters, is spread over tasks: each word is at home in its bucket and
    visits those it can reach within the budget. A bucket larger than a task should hold is cut twice, by the first
    and by the last letters, one of which a pair shares.
    """
    if least_length < 2:
        raise ValueError("words need two letters")
    ship_package(words.sparkSession)
    if levels is None:
        levels = int(np.clip(math.ceil(math.log(max(1, words.count()) / (8 * TILE_WORDS), 2.5)), 1, 8))
    ends = min(8, least_length // 2)
    top = words.select("word", "n", F.length("word").alias("len"), *[_count(GROUPS[k]).alias(f"c{k}") for k in range(levels)])
    places = [(0, [0] * levels, 0, 0), *_moves(levels)]
    spots = F.explode(F.array(*[
        F.struct(
            F.lit(i).alias("role"), F.lit(s).cast("byte").alias("surplus"), F.lit(f).cast("byte").alias("deficit"),
            F.array(F.col("len") + longer, *[F.col(f"c{k}") + d for k, d in enumerate(change)]).alias("place"),
        ) for i, (longer, change, s, f) in enumerate(places)
    ])).alias("spot")
    moved = top.select("word", "n", spots).select("word", "n", "spot.*").where(F.forall("place", lambda x: x >= 0))
    key = F.array_join("place", ",").alias("key")
    home = top.select(F.array_join(F.array("len", *[F.col(f"c{k}") for k in range(levels)]), ",").alias("key"), "len")
    large = home.groupBy("key").agg(F.count("*").alias("size"), F.first("len").alias("len")).select(
        F.col("key").alias("large"),
        F.ceil(F.greatest(F.col("size") / TILE_WORDS, F.col("size") * F.col("len") / TILE_BYTES)).cast("int").alias("parts"),
    ).where("parts > 1")
    large = cut_lineage(large)
    if large.count() <= BROADCAST_ROWS:
        large = F.broadcast(large)
    dealt = moved.select("word", "n", "role", "surplus", "deficit", key).join(large, F.col("key") == F.col("large"), "left")
    part = lambda side, of: F.struct(F.lit(side).alias("side"), F.pmod(F.xxhash64(of), F.col("parts")).cast("int").alias("part"))
    parts = F.when(F.col("parts").isNull(), F.array(F.struct(F.lit("a").alias("side"), F.lit(0).alias("part")))).otherwise(
        F.array(part("p", F.substring("word", 1, ends)), part("s", F.substring("word", -ends, ends))))
    dealt = dealt.select(F.encode("word", "ISO-8859-1").alias("word"), "n", "role", "surplus", "deficit", "key", F.explode(parts).alias("tile"))
    dealt = dealt.select("word", "n", "role", "surplus", "deficit", "key", "tile.side", "tile.part")
    # a bucket's bytes say little about its work, so partitions are counted, not left to their bytes
    spread = dealt.repartition(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key", "side", "part")
    found = spread.groupBy("key", "side", "part").applyInArrow(_search(levels, ends), _FOUND)
    summed = found.groupBy("word").agg(
        F.sum("links").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("low"), "best")).alias("top"),
    )
    text = lambda c: F.decode(c, "ISO-8859-1")
    return summed.select(
        text(F.col("word")).alias("word"), "n_near", text(F.col("top.best")).alias("best"), (-F.col("top.low")).alias("best_n"),
    )


def variant_forms(words: DataFrame, *, ratio: int = 10, least_length: int = 7, levels: int | None = None) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of distinct words with counts ``n``.

    Near words differ by exactly one inserted, deleted or replaced code point. The form is the near word of largest n
    (of equal ones the smallest in code-point order) if its n is ``ratio`` (2 or more) times the word's or more, else null.
    The root is where following forms ends. As n grows along them, their number is bounded by the largest n, and
    pointer doubling ends after a known number of joins.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent than their words")
    near = near_counts(words, least_length=least_length, levels=levels)
    known = words.join(near, "word", "left")
    fits = F.col("best_n") >= ratio * F.col("n")
    known = cut_lineage(known.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("best")).alias("form"), F.when(fits, F.col("best_n")).alias("form_n"),
    ))
    most = known.agg(F.max("n")).first()[0] or 1
    steps, reach = known.where("form IS NOT NULL").select("word", F.col("form").alias("root")), 1
    while ratio**reach < most:
        further = steps.select(F.col("word").alias("via"), F.col("root").alias("far"))
        steps = steps.join(further, F.col("root") == F.col("via"), "left").select("word", F.coalesce("far", "root").alias("root"))
        steps, reach = cut_lineage(steps), 2 * reach
    return known.join(steps, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n",
    )


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, least_length: int = 7, least_count: int = 2,
    ratio: int = 10, spoil_every: int = 31,
) -> DataFrame:
    """Groups of spelling variants among the words of all texts; see ``letter_runs`` and ``variant_forms``.

    Words occur ``least_count`` times or more in all. Rows that repeat an id, a text or both all count. Words of any
    length are whole. No words give no rows; other columns of ``docs`` are not read.
    """
    runs = letter_runs(docs, id_col, text_col, least_length=least_length, spoil_every=spoil_every)
    words = runs.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)
    return variant_forms(cut_lineage(words), ratio=ratio, least_length=least_length)
