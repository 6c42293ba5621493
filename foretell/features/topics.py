"""Topics by online variational Bayes, the matrix of terms by topics kept as a table.

The algorithm and its constants are those of Spark ML's online LDA, whose driver holds several such matrices. A topic's
weight of a term is ``left * (draw + added) + (1 - left) * eta``: what is left of the random start, which is drawn from the
term's place wherever it is needed, and what the batches added. So only terms that a batch had are stored, and a step rewrites
those alone that a later batch has too. The driver holds numbers by topic.

Documents are counted once, in chunks: a table has a row for each term of a chunk, under a number, and the documents
of a chunk are packed numbers and counts. Only the former meet the weights; what is moved grows with the terms of chunks, not
with those of documents.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foretell.functions.text import word_tokens
from foretell.session import scratch_path, ship_package

# fixed values: Spark ML's defaults
STEPS, BATCH_FRACTION = 20, 0.05
LEARNING_OFFSET, LEARNING_DECAY = 1024, 0.51
START_SHAPE = 100  # of the gamma distribution of the start, whose mean is 1
INFERENCE_CHANGE = 1e-3
#: Tokens of the documents that are counted together (a longer document is a chunk of its own).
CHUNK_TOKENS = 1 << 22
#: Terms of the documents whose shares are found at a time.
PART_TERMS = 1 << 15
#: Places in a table of sums that stand for the documents' log shares, their number, and the sums of all terms.
LOG_SHARES, DOCUMENTS, ADDED = -1, -2, -3
#: Key of the rows that name a chunk's terms, among those of its batches.
TERMS = -1


def digamma(x: np.ndarray) -> np.ndarray:
    low = 0.0
    for k in range(6):
        low = low + 1 / (x + k)
    x = x + 6
    f = 1 / (x * x)
    return np.log(x) - 0.5 / x - f * (1 / 12 - f * (1 / 120 - f * (1 / 252 - f * (1 / 240 - f / 132)))) - low


def log_gamma(x: np.ndarray) -> np.ndarray:
    y = x + 6
    f = 1 / (y * y)
    series = (1 / 12 - f * (1 / 360 - f * (1 / 1260 - f / 1680))) / y
    return (y - 0.5) * np.log(y) - y + math.log(2 * math.pi) / 2 + series - np.log(x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5))


def trigamma(x: np.ndarray) -> np.ndarray:
    low = 0.0
    for k in range(6):
        low = low + 1 / (x + k) ** 2
    x = x + 6
    f = 1 / (x * x)
    return 1 / x + f / 2 + f / x * (1 / 6 - f * (1 / 30 - f * (1 / 42 - f / 30))) + low


def _uniform(keys: np.ndarray) -> np.ndarray:
    """Numbers between 0 and 1 from 64-bit keys (the mixing step of splitmix64)."""
    z = keys * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return ((z >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def start_draw(at: np.ndarray, topics: int, seed: int) -> np.ndarray:
    """Gamma(100, 1/100) of each place and topic, by Wilson and Hilferty's cube of a normal number."""
    keys = (at.astype(np.uint64)[:, None] * np.uint64(topics) + np.arange(topics, dtype=np.uint64)) * np.uint64(2) + np.uint64(1)
    shift = np.uint64(seed) << np.uint64(40)
    normal = np.sqrt(-2 * np.log(_uniform(keys ^ shift))) * np.cos(2 * np.pi * _uniform((keys + np.uint64(1)) ^ shift))
    return (1 - 1 / (9 * START_SHAPE) + normal / (3 * math.sqrt(START_SHAPE))) ** 3


@dataclass(frozen=True)
class Weights:
    """What tells a topic's weights beside the table of what was added to its terms."""

    topics: int
    seed: int
    alpha: tuple[float, ...]
    totals: tuple[float, ...]  # of all terms, by topic
    left: float = 1.0

    @property
    def eta(self) -> float:
        return 1.0 / self.topics

    def beta(self, at: np.ndarray, added: np.ndarray) -> np.ndarray:
        """exp(E[log weight]) of terms by topics."""
        weights = self.left * (start_draw(at, self.topics, self.seed) + added) + (1 - self.left) * self.eta
        return np.exp(digamma(weights) - digamma(np.array(self.totals)))


def _log_expectation(gamma: np.ndarray) -> np.ndarray:
    return digamma(gamma) - digamma(gamma.sum(axis=1))[:, None]


def infer(beta: np.ndarray, term: np.ndarray, counts: np.ndarray, sizes: np.ndarray, alpha: np.ndarray) -> np.ndarray:
    """Topic parameters of documents, whose terms (rows of ``beta``) and counts follow each other.

    A document is done once an update changes its parameters by less than ``INFERENCE_CHANGE`` on average. Updates creep
    where topics are much alike, so after two of them the next starts further along their path (squared extrapolation of
    the logarithms); where that would lower the bound that updates raise, it starts where the two ended. Documents that are
    done make room for others.
    """
    topics, columns, ends = beta.shape[1], np.ascontiguousarray(beta.T), np.cumsum(sizes)
    gamma = np.ones((len(sizes), topics))
    live, c, b = np.empty(0, np.int64), np.empty(0), np.empty((topics, 0))
    upcoming, path = 0, []
    while len(live) or upcoming < len(sizes):
        if not path:
            if upcoming < len(sizes) and len(c) <= PART_TERMS // 2:
                start = ends[upcoming] - sizes[upcoming]
                last = max(upcoming + 1, int(np.searchsorted(ends, start + PART_TERMS - len(c), side="right")))
                live, taken = np.append(live, np.arange(upcoming, last)), slice(start, ends[last - 1])
                c, b = np.append(c, counts[taken]), np.concatenate((b, columns[:, term[taken]]), axis=1)
                upcoming = last
            path, least = [gamma[live]], np.full(len(live), -np.inf)
        n = sizes[live]
        first = np.cumsum(n) - n
        ahead = len(path) == 3
        at = _further(*path) if ahead else path[-1]
        expected = _log_expectation(at)
        theta = np.exp(expected)
        norm = np.full(len(c), 1e-100)
        for k in range(topics):
            norm += b[k] * np.repeat(theta[:, k], n)
        ratio = c / norm
        new = np.empty_like(at)
        for k in range(topics):
            new[:, k] = theta[:, k] * np.add.reduceat(b[k] * ratio, first) + alpha[k]
        moving = np.abs(new - at).mean(axis=1) > INFERENCE_CHANGE
        if len(path) > 1:
            bound = np.add.reduceat(c * np.log(norm), first) + ((alpha - at) * expected + log_gamma(at)).sum(axis=1) - log_gamma(at.sum(axis=1))
            if ahead:
                good = bound >= least
                moving |= ~good
                new = np.where(good[:, None], new, path[2])
            least = bound
        gamma[live] = new
        path = [] if ahead else [*path, new]
        if not moving.all():
            kept = np.repeat(moving, n)
            live, c, b, least = live[moving], c[kept], b[:, kept], least[moving]
            path = [g[moving] for g in path]
    return gamma


def _further(first: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
    """Where the steps between three points lead, by logarithms, at most a factor of 20 from the last."""
    a, b, c = np.log(first), np.log(second), np.log(third)
    step, bend = b - a, c - 2 * b + a
    length = np.maximum(np.sqrt((step**2).sum(axis=1) / ((bend**2).sum(axis=1) + 1e-300)), 1)[:, None]
    return np.exp(np.clip(a + 2 * length * step + length**2 * bend, c - 3, c + 3))


def _parts(sizes: np.ndarray):
    """Documents in a row with about ``PART_TERMS`` terms, and these terms, as slices."""
    ends = np.cumsum(sizes)
    first = 0
    while first < len(sizes):
        start = ends[first] - sizes[first]
        last = max(first + 1, int(np.searchsorted(ends, start + PART_TERMS, side="right")))
        yield slice(first, last), slice(start, ends[last - 1])
        first = last


def _chunks(batches):
    """Number, keys of the documents, tokens of each, all tokens, of documents in a row with about ``CHUNK_TOKENS``.

    The columns are ``part``, ``key`` and ``terms``.
    """
    number, waiting = 0, []

    def joined():
        keys, sizes, tokens = zip(*waiting)
        return number, np.concatenate(keys), np.concatenate(sizes), pa.concat_arrays(tokens)

    part = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch.column("part")[0].as_py() << 32
        keys, terms = batch.column("key").to_numpy(), batch.column("terms")
        sizes = np.asarray(pc.fill_null(pc.list_value_length(terms), 0)).astype(np.int64)
        ends = np.cumsum(sizes)
        first = 0
        while first < len(sizes):
            room = CHUNK_TOKENS - sum(len(tokens) for *_, tokens in waiting)
            last = int(np.searchsorted(ends, ends[first] - sizes[first] + room, side="right"))
            last = max(last, first if waiting else first + 1)
            if last > first:
                waiting.append((keys[first:last], sizes[first:last], terms.slice(first, last - first).flatten()))
            if last < len(sizes):
                yield part, *joined()
                number, waiting = number + 1, []
            first = last
    if waiting:
        yield part, *joined()


def _count(sizes: np.ndarray, tokens: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The terms; document, term and count of each term of each document, in this order."""
    coded = tokens.dictionary_encode()
    n = max(len(coded.dictionary), 1)
    pairs = np.repeat(np.arange(len(sizes)), sizes) * n + np.asarray(coded.indices)
    pairs, counts = np.unique(pairs, return_counts=True)
    return coded.dictionary, *np.divmod(pairs, n), counts


def _packed(marks: np.ndarray, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> bytes:
    """Documents as bytes: a 64-bit mark and the number of terms of each, then terms and counts of all."""
    head = np.array([len(marks), len(terms)])
    return b"".join(x.astype(t).tobytes() for x, t in ((head, "<i8"), (marks, "<i8"), (sizes, "<i4"), (terms, "<i4"), (counts, "<i4")))


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    documents, pairs = np.frombuffer(data, "<i8", 2)
    marks, rest = np.frombuffer(data, "<i8", documents, 16), 16 + 8 * documents
    sizes, terms, counts = np.split(np.frombuffer(data, "<i4", documents + 2 * pairs, rest), [documents, documents + pairs])
    return marks, sizes, terms, counts


_COUNTED = "chunk long, turn int, docs binary, code int, term string, turns long, documents long"
_COUNTED_ARROW = pa.schema([
    ("chunk", pa.int64()), ("turn", pa.int32()), ("docs", pa.binary()), ("code", pa.int32()), ("term", pa.string()), ("turns", pa.int64()),
    ("documents", pa.int64()),
])


def _counted_rows(chunk: int, turn, **columns) -> pa.RecordBatch:
    """Rows of a chunk; columns that are not given are null."""
    n = len(next(iter(columns.values())))
    given = {"chunk": np.full(n, chunk), "turn": np.full(n, turn) if np.isscalar(turn) else turn} | columns
    return pa.RecordBatch.from_arrays(
        [pa.array(given[f.name], f.type) if f.name in given else pa.nulls(n, f.type) for f in _COUNTED_ARROW], schema=_COUNTED_ARROW
    )


def times_drawn(keys: np.ndarray, steps: int, fraction: float, seed: int) -> np.ndarray:
    """How often each document is in each batch: Poisson numbers, drawn from its key."""
    at = keys.astype(np.uint64)[:, None] * np.uint64(steps) + np.arange(steps, dtype=np.uint64)
    chances = np.cumsum([math.exp(-fraction) * fraction**k / math.factorial(k) for k in range(20)])
    return np.searchsorted(chances, _uniform((at + np.uint64(1)) ^ (np.uint64(seed + 1) << np.uint64(40))), side="right")


def _batches_of(batches, steps: int, fraction: float, seed: int):
    """Each chunk's documents of each batch, marked by how often they were drawn; its terms, with the batches that have them as bits.

    All documents are counted, also those without terms and those that no batch has.
    """
    for part, number, keys, sizes, tokens in _chunks(batches):
        chunk = part + number
        times = times_drawn(keys, steps, fraction, seed)
        drawn = (times > 0).any(axis=1) & (sizes > 0)
        terms, document, code, counts = _count(sizes[drawn], tokens.filter(pa.array(np.repeat(drawn, sizes))))
        times = times[drawn]
        turns, docs, bits = [], [], np.zeros(len(terms), np.int64)
        for turn in range(steps):
            inside = times[:, turn] > 0
            if not inside.any():
                continue
            pairs = inside[document]
            lengths = np.bincount(document[pairs], minlength=len(inside))[inside]
            bits[np.unique(code[pairs])] |= 1 << turn
            turns.append(turn)
            docs.append(_packed(times[inside, turn], lengths, code[pairs], counts[pairs]))
        yield _counted_rows(chunk, TERMS, documents=np.array([len(keys)]))
        if len(terms):
            yield _counted_rows(chunk, TERMS, code=np.arange(len(terms)), term=terms, turns=bits)
        if docs:
            yield _counted_rows(chunk, np.array(turns), docs=docs)


def _counted(batches):
    """Each chunk's documents, marked by their keys, and its terms."""
    for part, number, keys, sizes, tokens in _chunks(batches):
        terms, document, code, counts = _count(sizes, tokens)
        lengths = np.bincount(document, minlength=len(sizes))
        some = lengths > 0
        if some.any():
            yield _counted_rows(part + number, TERMS, code=np.arange(len(terms)), term=terms)
            yield _counted_rows(part + number, 0, docs=[_packed(keys[some], lengths[some], code, counts)])


def _chunk(table: pa.Table, weights: Weights) -> tuple[np.ndarray, ...]:
    """Places and beta of a chunk's terms; of its documents marks and numbers of terms; their terms, by row of the former, and counts.

    Terms that are not in the table are left out, and documents without others.
    """
    named = table.filter(pc.is_valid(table.column("at")))
    at, code = (named.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("at", "code"))
    added = named.column("added").combine_chunks()
    known = np.asarray(added.is_valid())
    found = np.zeros((len(at), weights.topics))
    found[known] = np.asarray(added.flatten()).reshape(-1, weights.topics)
    docs = table.column("docs").drop_null()
    marks, sizes, term, counts = _unpacked(docs[0].as_buffer() if len(docs) else _packed(*[np.empty(0, np.int64)] * 4))
    row = np.full(max(term.max(initial=-1), code.max(initial=-1)) + 1, -1)
    row[code] = np.arange(len(code))
    term = row[term]
    kept = term >= 0
    sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[kept], minlength=len(sizes))
    some = sizes > 0
    return at, weights.beta(at, found), marks[some], sizes[some], term[kept], counts[kept].astype(float)


def _statistics(table: pa.Table, weights: Weights, factor: float) -> pa.Table:
    """Statistics of a chunk's terms, times ``factor``, and sums of log shares, documents and statistics."""
    at, beta, times, sizes, term, counts = _chunk(table, weights)
    expected = _log_expectation(infer(beta, term, counts, sizes, np.array(weights.alpha)))
    theta = np.exp(expected)
    sums = np.zeros((len(at), weights.topics))
    for documents, pairs in _parts(sizes):
        terms = term[pairs]
        shares = np.repeat(theta[documents], sizes[documents], axis=0)
        # a document drawn twice is two
        ratio = counts[pairs] * np.repeat(times[documents], sizes[documents]) / ((beta[terms] * shares).sum(axis=1) + 1e-100)
        for k in range(weights.topics):
            sums[:, k] += np.bincount(terms, weights=shares[:, k] * ratio, minlength=len(at))
    sums *= beta * factor
    sums = np.vstack((sums, (expected * times[:, None]).sum(axis=0), np.full(weights.topics, times.sum()), sums.sum(axis=0)))
    places = np.append(at, [LOG_SHARES, DOCUMENTS, ADDED]).astype(np.int32)
    later = table.column("later").filter(pc.is_valid(table.column("at"))).to_pylist() + [False] * 3
    return pa.table({"at": places, "added": _lists(sums), "later": later})


def _shares(table: pa.Table, weights: Weights, key: str) -> pa.Table:
    _, beta, keys, sizes, term, counts = _chunk(table, weights)
    gamma = infer(beta, term, counts, sizes, np.array(weights.alpha))
    return pa.table({key: keys, "shares": _lists(gamma / gamma.sum(axis=1)[:, None])})


def _by_chunk(terms: DataFrame, docs: DataFrame):
    """Terms (``chunk``, ``code``, ``at``, ``added`` and others) and packed documents, by chunk."""
    return terms.unionByName(docs.select("chunk", "docs"), allowMissingColumns=True).groupBy("chunk")


def _tokens(rows: DataFrame, key: Column, column: str) -> DataFrame:
    return rows.select(F.spark_partition_id().alias("part"), key.alias("key"), word_tokens(column).alias("terms"))


def _lists(rows: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1], rows.ravel())


def _draw_sums(batches, topics: int, seed: int):
    for batch in batches:
        sums = start_draw(batch.column("id").to_numpy(), topics, seed).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([sums.tolist()], pa.list_(pa.float64()))], names=["sums"])


def _by_topic(column: str, topics: int) -> Column:
    return F.array(*[F.sum(F.col(column)[j]) for j in range(topics)])


def _next_alpha(alpha: np.ndarray, log_shares: np.ndarray, documents: float, rate: float) -> np.ndarray:
    """A Newton step for the documents' prior, as Spark's; left alone where it would not stay positive."""
    slope = documents * (log_shares - (digamma(alpha) - digamma(alpha.sum())))
    c, q = documents * trigamma(alpha.sum()), -documents * trigamma(alpha)
    b = (slope / q).sum() / (1 / c + (1 / q).sum())
    new = alpha - rate * (slope - b) / q
    return new if (new > 0).all() else alpha


@dataclass(frozen=True)
class TopicShares:
    """Fitted topics of a text column. ``terms`` is ``(term, at, added)``, ``added`` null where no batch had the term."""

    column: str
    terms: DataFrame
    weights: Weights

    def entries(self, rows: DataFrame, key: str, offset: int = 0) -> DataFrame:
        """``(key, entries)``: shares of the topics, by place from ``offset``, of each row with terms of the vocabulary.

        ``key`` is a long that no two rows share.
        """
        spark = rows.sparkSession
        ship_package(spark)
        path = scratch_path(spark, "counted")
        _tokens(rows, F.col(key), self.column).mapInArrow(_counted, _COUNTED).write.parquet(path)
        counted = spark.read.schema(_COUNTED).parquet(path)
        found = counted.where("term is not null").select("chunk", "code", "term").join(self.terms, "term")
        weights = self.weights
        shares = _by_chunk(found, counted.where("docs is not null")).applyInArrow(
            lambda chunk: _shares(chunk, weights, key), f"`{key}` long, shares array<double>"
        )
        entry = lambda share, j: F.struct((j + offset).cast("int").alias("at"), share.alias("value"))
        return shares.select(key, F.transform("shares", entry).alias("entries"))


#: What was added to a term, and whether a later batch has it.
_STORED = "at int, added array<double>, later boolean"


def fit_topics(rows: DataFrame, places: DataFrame, column: str, topics: int, size: int, seed: int = 17) -> TopicShares:
    """Topics of a text column of ``rows``; ``places`` is ``(term, idx)`` of the ``size`` terms."""
    spark = rows.sparkSession
    ship_package(spark)
    folder = scratch_path(spark, "topics")
    # all batches are drawn and counted at once
    tokens = _tokens(rows, F.monotonically_increasing_id(), column)
    drawn = tokens.mapInArrow(partial(_batches_of, steps=STEPS, fraction=BATCH_FRACTION, seed=seed), _COUNTED)
    drawn.write.partitionBy("turn").parquet(f"{folder}/drawn")
    drawn = spark.read.schema(_COUNTED).parquet(f"{folder}/drawn")
    documents = drawn.where(F.col("turn") == TERMS).agg(F.sum("documents")).first()[0] or 0
    places = places.select("term", F.col("idx").cast("int").alias("at"))
    named = drawn.where((F.col("turn") == TERMS) & F.col("term").isNotNull()).join(places, "term")
    named = named.select("chunk", "code", "at", "turns", F.bit_or("turns").over(W.partitionBy("term")).alias("all_turns"))
    named.write.parquet(f"{folder}/named")
    named = spark.read.schema("chunk long, code int, at int, turns long, all_turns long").parquet(f"{folder}/named")
    draws = spark.range(size).mapInArrow(partial(_draw_sums, topics=topics, seed=seed), "sums array<double>")
    start = np.array(draws.agg(_by_topic("sums", topics)).first()[0])
    weights = Weights(topics, seed, (1.0 / topics,) * topics, tuple(start))
    added, all_added, paths = None, np.zeros(topics), []
    batch_size = math.ceil(BATCH_FRACTION * documents)
    step = 0
    for turn in range(STEPS):
        rate = (LEARNING_OFFSET + step + 1) ** -LEARNING_DECAY
        left = (1 - rate) * weights.left
        factor = rate * documents / max(batch_size, 1) / left
        later = F.shiftright("all_turns", turn + 1) != 0
        terms = named.where(F.col("turns").bitwiseAND(F.lit(1 << turn)) != 0).select("chunk", "code", "at", later.alias("later"))
        terms = terms.withColumn("added", F.lit(None).cast("array<double>")) if added is None else terms.join(added, "at", "left")
        found = _by_chunk(terms, drawn.where(F.col("turn") == turn)).applyInArrow(
            lambda chunk: _statistics(chunk, weights, factor), _STORED  # noqa: B023
        )
        if added is not None:
            found = added.withColumn("later", F.lit(True)).unionByName(found)
        path = f"{folder}/step_{turn}"
        found.groupBy("at").agg(_by_topic("added", topics).alias("added"), F.min("later").alias("later")).write.parquet(path)
        stored = spark.read.schema(_STORED).parquet(path)
        sums = {r.at: np.array(r.added) for r in stored.where("at < 0").collect()}
        if DOCUMENTS not in sums or not sums[DOCUMENTS][0]:
            continue  # an empty batch
        paths.append(path)
        added = stored.where("at >= 0 and later").drop("later")
        n = sums[DOCUMENTS][0]
        alpha = _next_alpha(np.array(weights.alpha), sums[LOG_SHARES] / n, n, rate)
        all_added += sums[ADDED]
        totals = left * (start + all_added) + (1 - left) * weights.eta * size
        weights = replace(weights, alpha=tuple(alpha), totals=tuple(totals), left=left)
        step += 1
    terms = places.withColumn("added", F.lit(None).cast("array<double>"))
    if paths:
        # a term's last row is that of the last batch that has it
        last = spark.read.schema(_STORED).parquet(*paths).where("at >= 0 and not later")
        terms = places.join(last, "at", "left")
    terms.select("term", "at", "added").write.parquet(f"{folder}/terms")
    return TopicShares(column, spark.read.parquet(f"{folder}/terms"), weights)
