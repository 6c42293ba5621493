"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index."""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foretell.llm.archive import open_store
from foretell.llm.common import WORDS, gram_hashes, mix, run_hashes, runs, spare_name, with_fields
from foretell.llm.labels import labelled_sample
from foretell.session import cut_lineage, shared_dir, ship_package, small_table

#: ASCII that is no letter, digit or ``_``: where ``common.WORDS`` parts words.
NO_WORD = "[\\x00-\\x2f\\x3a-\\x40\\x5b-\\x5e\\x60\\x7b-\\x7f]+"
#: Vectors of a block, most terms whose weights are kept as a matrix, and queries that are searched together.
BLOCK, DENSE_TERMS, QUERIES = 64, 256, 256
#: Blocks a query opens first, and postings that are added at a time.
SEED_BLOCKS, POSTINGS = 8, 1 << 21
#: Vectors that are put into an index at a time, and that the driver is sent at once.
FILLED, SENT = 512, 2048
#: Room for rounding of single-precision bounds; decisions are in double precision.
SLACK = 1e-4
TIE = 1e-9


def _expand(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, so many as its size."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


class BlockMaxIndex:
    """Unit vectors by term, for many queries at once, with the largest weights of blocks of vectors.

    Rare terms have postings, which are short and read whole. Frequent terms would bring nearly all vectors into every
    query: they never propose one. Their weights stand in matrices of a block each, with a row of the block's maxima.
    Products with the maxima, plus the best that rare terms give in a block, bound its cosines from above; the
    k-th best so far bounds the result from below. Only blocks between the two are opened. Bounds are in single
    precision with room for rounding; what may be among the k best is computed again in double precision.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], terms: int):
        size = [len(t) for t, _ in vectors]
        flat = [np.concatenate(x) if vectors else np.empty(0) for x in ([t for t, _ in vectors], [w for _, w in vectors])]
        self._fill(flat[0].astype(np.int32), flat[1].astype(np.float64), np.concatenate(([0], np.cumsum(size))).astype(np.int64), terms)

    @classmethod
    def of_rows(cls, term: np.ndarray, weight: np.ndarray, offsets: np.ndarray, terms: int) -> BlockMaxIndex:
        """From vectors that lie one after the other."""
        index = cls.__new__(cls)
        index._fill(term, weight, offsets, terms)
        return index

    def _fill(self, term, weight, offsets, terms):
        size = len(offsets) - 1
        blocks = -(-size // BLOCK)
        steps = [slice(k, min(k + FILLED, size)) for k in range(0, size, FILLED)]  # some vectors at a time: copies stay small
        often = np.zeros(terms, np.int64)
        for part in steps:
            often += np.bincount(term[offsets[part.start] : offsets[part.stop]], minlength=terms)
        frequent = np.sort(np.argsort(-often, kind="stable")[: min(DENSE_TERMS, terms)])
        column = np.full(terms, -1, np.int32)
        column[frequent] = np.arange(len(frequent))
        often[frequent] = 0
        cuts = np.concatenate(([0], np.cumsum(often))).astype(np.int64)
        free = cuts[:-1].copy()  # where a term's next posting goes
        row, light = np.empty(cuts[-1], np.int32), np.empty(cuts[-1], np.float32)
        dense = np.zeros((blocks * BLOCK, len(frequent)), np.float32)
        for part in steps:
            places = slice(offsets[part.start], offsets[part.stop])
            t, w = term[places], weight[places]
            of = np.repeat(np.arange(part.start, part.stop, dtype=np.int32), np.diff(offsets[part.start : part.stop + 1]))
            at = column[t]
            dense[of[at >= 0], at[at >= 0]] = w[at >= 0]
            rare = np.flatnonzero(at < 0)
            rare = rare[np.argsort(t[rare], kind="stable")]
            t = t[rare]
            first = np.flatnonzero(np.diff(t, prepend=-1))
            sizes = np.diff(np.append(first, len(t)))
            to = _expand(free[t[first]], sizes)
            row[to], light[to] = of[rare], w[rare]
            free[t[first]] += sizes
        top = dense.reshape(blocks, BLOCK, -1).max(axis=1) if size else np.zeros((0, len(frequent)), np.float32)
        self._set({
            "term": term, "weight": weight, "offsets": offsets, "column": column, "dense": dense, "top": top,
            "cuts": cuts, "row": row, "light": light,
        })

    def _set(self, arrays: dict[str, np.ndarray]):
        self.arrays = arrays
        self.__dict__.update(arrays)
        self.size, self.blocks = len(self.offsets) - 1, len(self.top)
        self._query = np.zeros(len(self.column))

    @classmethod
    def of_arrays(cls, arrays: dict[str, np.ndarray]) -> BlockMaxIndex:
        index = cls.__new__(cls)
        index._set(arrays)
        return index

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and cosines of the k nearest vectors with a positive cosine, and of all that tie with the last."""
        return self.search_many([(terms, weights)], k)[0]

    def search_many(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        out = []
        for start in range(0, len(queries), QUERIES):
            out += self._search(queries[start : start + QUERIES], k)
        return out

    def _search(self, queries, k):
        if not self.size:
            return [(np.empty(0, np.int64), np.empty(0))] * len(queries)
        n, width = len(queries), self.blocks * BLOCK
        of = np.repeat(np.arange(n), [len(t) for t, _ in queries])
        terms = np.concatenate([t for t, _ in queries])
        weights = np.concatenate([w for _, w in queries]).astype(np.float32)
        column = self.column[terms]
        frequent = column >= 0
        q = np.zeros((n, self.top.shape[1]), np.float32)
        q[of[frequent], column[frequent]] = weights[frequent]
        scores = np.zeros((n, width), np.float32)
        of, terms, weights = of[~frequent], terms[~frequent], weights[~frequent]
        starts = self.cuts[terms]
        sizes = self.cuts[terms + 1] - starts
        ends = np.cumsum(sizes)
        low = 0
        while low < len(terms):  # some terms at a time, so that postings fit in memory
            high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + POSTINGS, side="right")))
            part = slice(low, high)
            at = _expand(starts[part], sizes[part])
            place = np.repeat(of[part] * width, sizes[part]) + self.row[at]
            np.add.at(scores.reshape(-1), place, np.repeat(weights[part], sizes[part]) * self.light[at])
            low = high
        best = scores.reshape(n, self.blocks, BLOCK).max(axis=2)
        bound = q @ self.top.T + best

        def open_blocks(which):
            for b in np.flatnonzero(which.any(axis=0)).tolist():
                rows, block = np.flatnonzero(which[:, b]), slice(b * BLOCK, (b + 1) * BLOCK)
                now = scores[rows, block] + q[rows] @ self.dense[block].T
                scores[rows, block] = now
                best[rows, b] = now.max(axis=1)

        def least():
            """k blocks have a vector each that is no worse."""
            if k > self.blocks:
                return np.zeros(n, np.float32)
            return np.partition(best, self.blocks - k, axis=1)[:, self.blocks - k]

        first = np.zeros((n, self.blocks), bool)
        seeds = min(max(SEED_BLOCKS, k), self.blocks)
        first[np.arange(n)[:, None], np.argpartition(-bound, seeds - 1, axis=1)[:, :seeds]] = True
        first &= bound > 0
        open_blocks(first)
        open_blocks(~first & (bound > 0) & (bound >= least()[:, None] - SLACK))
        floor = np.maximum(least() - SLACK, np.float32(1e-30))
        of, block = np.nonzero(best >= floor[:, None])
        part = scores.reshape(n, self.blocks, BLOCK)[of, block]
        at, place = np.nonzero(part >= floor[of][:, None])
        hit, row, near = of[at], block[at] * BLOCK + place, part[at, place]
        cuts = np.searchsorted(hit, np.arange(n + 1)).tolist()
        out = []
        for i in range(n):
            found, rough = row[cuts[i] : cuts[i + 1]], near[cuts[i] : cuts[i + 1]]
            if len(found) > k:
                found = found[rough >= np.partition(rough, len(rough) - k)[len(rough) - k] - 2 * SLACK]
            out.append(self._exact(*queries[i], found, k))
        return out

    def _exact(self, terms, weights, found, k):
        if not len(found):
            return found, np.empty(0)
        self._query[terms] = weights
        starts = self.offsets[found]
        sizes = self.offsets[found + 1] - starts
        at = _expand(starts, sizes)
        scores = np.add.reduceat(self._query[self.term[at]] * self.weight[at], np.cumsum(sizes) - sizes)
        self._query[terms] = 0
        if len(scores) > k:
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            found, scores = found[scores >= least - TIE], scores[scores >= least - TIE]
        order = np.lexsort((found, -scores))
        return found[order], scores[order]


def write_arrays(arrays: dict[str, np.ndarray], path: str) -> None:
    """One file of arrays, each at a multiple of 64 bytes."""
    at, table = 0, {}
    for name, x in arrays.items():
        table[name] = (x.dtype.str, x.shape, at)
        at += -(-x.nbytes // 64) * 64
    head = json.dumps(table).encode()
    head = len(head).to_bytes(8, "little") + head
    head += bytes(-len(head) % 64)
    store, place = open_store(path)
    with store.open_output_stream(place) as out:
        out.write(head)
        for x in arrays.values():
            out.write(np.ascontiguousarray(x).data)
            out.write(bytes(-x.nbytes % 64))


def read_arrays(path: str) -> dict[str, np.ndarray]:
    """The arrays of a file, without a copy; on a disk that all share, the workers of a machine map the same pages."""
    store, place = open_store(path)
    if isinstance(store, pyarrow.fs.LocalFileSystem):
        data = pa.memory_map(place).read_buffer()
    else:
        with store.open_input_file(place) as source:
            data = source.read_buffer()
    size = int.from_bytes(data[:8].to_pybytes(), "little")
    table, start = json.loads(data[8 : 8 + size].to_pybytes()), -(-(8 + size) // 64) * 64
    return {
        name: np.frombuffer(data, dtype, math.prod(shape), start + at).reshape(shape) if math.prod(shape) else np.empty(shape, dtype)
        for name, (dtype, shape, at) in table.items()
    }


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising steps that fit 0/1 outcomes: least x and smoothed rate of each step (pool adjacent violators)."""
    steps: list[list[float]] = []
    values, at = np.unique(x, return_inverse=True)
    ones, all_ = np.bincount(at, y), np.bincount(at)
    for v, p, n in zip(values.tolist(), ones.tolist(), all_.tolist()):
        steps.append([v, p, n])
        while len(steps) > 1 and steps[-2][1] * steps[-1][2] >= steps[-1][1] * steps[-2][2]:
            _, p2, n2 = steps.pop()
            steps[-1][1] += p2
            steps[-1][2] += n2
    rate = np.array([(p + 0.5 * (p > 0)) / (n + 0.5) for _, p, n in steps])
    return np.array([s[0] for s in steps]), np.maximum.accumulate(rate)


@dataclass
class ToxicityModel:
    """Where the labelled examples are, distinct by vector, and how their votes become a score."""

    path: str  # file of the vectors and the votes of the texts that share one; beside it those of the vocabulary
    terms: list[str]  # words that go with the label
    example: list  # least id of each vector
    k: int
    steps: tuple[np.ndarray, np.ndarray] | None  # corners of the calibration
    base: float  # share of label 1
    unknown: float  # score of a text without a known word

    def calibrated(self, raw: float | None) -> float:
        if raw is None:
            return self.unknown
        if self.steps is None:
            return raw
        return float(np.interp(raw, *self.steps))


class Examples:
    """The files of a model, in a worker."""

    def __init__(self, path: str):
        arrays = read_arrays(f"{path}-keys") | read_arrays(f"{path}-words") | read_arrays(path)
        self.index = BlockMaxIndex.of_arrays({c.removeprefix("index_"): x for c, x in arrays.items() if c.startswith("index_")})
        self.keys, self.idf, self.votes = (arrays[c] for c in ("keys", "idf", "votes"))
        self.is_marked = np.zeros(len(self.keys), bool)
        self.is_marked[arrays["marked"]] = True

    def raw(self, counts: list, k: int, base: float) -> list[tuple[float | None, np.ndarray, np.ndarray]]:
        """Vote, neighbours and cosines of texts by their term counts; None without a neighbour."""
        some = [i for i, (terms, _) in enumerate(counts) if len(terms)]
        out: list = [(None, np.empty(0, np.int64), np.empty(0))] * len(counts)
        for i, (found, cosines) in zip(some, self.index.search_many([unit_vector(counts[i], self.idf) for i in some], k)):
            if len(found):
                # a vote falls with the distance, a near copy has many; one vote of the base rate stands for what is far away
                share = self.votes[found, 1] / self.votes[found].sum(axis=1)
                near = cosines**2 / (1.01 - np.minimum(cosines, 1) ** 2)
                out[i] = float((near @ share + base) / (near.sum() + 1)), found, cosines
        return out


@lru_cache(2)
def load(path: str) -> Examples:
    return Examples(path)


def unit_vector(counts, weight):
    terms, times = counts
    w = (1 + np.log(times)) * weight[terms]
    return terms, w / np.sqrt((w * w).sum()) if len(w) else w


def word_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a lower-case text's words, ascending, and how often they occur."""
    data = text.encode()
    return np.unique(run_hashes(data, *runs(data, WORDS)), return_counts=True)


class Words:
    """The distinct words of a lower-cased text: hashes in order, how often they occur, and where first."""

    def __init__(self, text: str):
        self.data = text.encode()
        self.starts, self.ends = runs(self.data, WORDS)
        found = run_hashes(self.data, self.starts, self.ends)
        self.hashes, self.first, self.times = np.unique(found, return_index=True, return_counts=True)


def known_words(hashes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``keys`` of the hashes (ascending) that are there, and which these are."""
    if not len(keys):
        return np.empty(0, np.int64), np.zeros(len(hashes), bool)
    at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
    known = keys[at] == hashes
    return at[known], known


def term_counts(counts: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``keys`` of the known words, ascending, and how often they occur."""
    at, known = known_words(counts[0], keys)
    return at, counts[1][known]


def _sketch(batches):
    """Two MinHashes of each text's word 3-grams; an empty text has zeros."""
    for batch in batches:
        made = []
        for text in batch.column("low").to_pylist():
            data = text.encode()
            grams = gram_hashes(run_hashes(data, *runs(data, WORDS)), 3)
            made.append([int(g.min().view(np.int64)) if len(g) else 0 for g in (grams, mix(grams))])
        sketches = [pa.array([m[k] for m in made], pa.int64()) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *sketches], names=[*batch.schema.names, "sketch_0", "sketch_1"])


def _document_counts(path: str):
    def run(batches):
        keys = read_arrays(f"{path}-keys")["keys"]
        total = np.zeros(len(keys) + 1, np.int64)  # at last: all documents
        for batch in batches:
            total[-1] += batch.num_rows
            for text in batch.column("low").to_pylist():
                total[term_counts(word_counts(text), keys)[0]] += 1
        seen = np.flatnonzero(total)
        for k in range(0, len(seen), 100_000):
            yield pa.RecordBatch.from_pydict({"t": seen[k : k + 100_000], "n": total[seen[k : k + 100_000]]})

    return run


def _packed(batches):
    """Word hashes of each text and their counts, as bytes."""
    for batch in batches:
        found = [word_counts(t) for t in batch.column("low").to_pylist()]
        hashes, times = (pa.array([f[k].astype(t).tobytes() for f in found], pa.binary()) for k, t in ((0, np.uint64), (1, np.int32)))
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), hashes, times], names=["id", "label", "hashes", "times"])


def _distinct(batches):
    """The distinct word hashes of a task's texts."""
    found = np.empty(0, np.uint64)
    for batch in batches:
        found = np.unique(np.concatenate([found, *[np.frombuffer(h.as_buffer(), np.uint64) for h in batch.column("hashes")]]))
    yield pa.RecordBatch.from_pydict({"h": found.view(np.int64)})


def _unpacked(batch, keys: np.ndarray):
    """Places in the vocabulary and counts of each text's words."""
    for h, t in zip(batch.column("hashes"), batch.column("times")):
        yield term_counts((np.frombuffer(h.as_buffer(), np.uint64), np.frombuffer(t.as_buffer(), np.int32)), keys)


def _places(path: str):
    """A digest of each vector, its terms, and by what it is sorted: its heaviest term and that term's share."""

    def run(batches):
        keys, idf = read_arrays(f"{path}-keys")["keys"], read_arrays(f"{path}-words")["idf"]
        for batch in batches:
            made = []
            for at, times in _unpacked(batch, keys):
                w = (1 + np.log(times)) * idf[at]
                heavy = (int(at[w.argmax()]), -float(w.max() / np.sqrt(w @ w))) if len(at) else (-1, 0.0)
                made.append((blake2b(at.tobytes() + times.tobytes(), digest_size=16).digest(), len(at), *heavy))
            kinds = pa.binary(), pa.int32(), pa.int32(), pa.float64()
            fields = [pa.array([m[k] for m in made], t) for k, t in enumerate(kinds)]
            kept = [batch.column(c) for c in ("row", "id", "label")]
            yield pa.RecordBatch.from_arrays([*kept, *fields], names=["row", "id", "label", "digest", "size", "heavy", "share"])

    return run


def _vectors(path: str):
    """Terms and weights of each unit vector, as bytes."""

    def run(batches):
        keys, idf = read_arrays(f"{path}-keys")["keys"], read_arrays(f"{path}-words")["idf"]
        for batch in batches:
            made = [unit_vector(counts, idf) for counts in _unpacked(batch, keys)]
            fields = [pa.array([m[k].astype(t).tobytes() for m in made], pa.binary()) for k, t in ((0, np.int32), (1, np.float64))]
            yield pa.RecordBatch.from_arrays([batch.column("place"), *fields], names=["place", "terms", "weights"])

    return run


def _raw_votes(path: str, k: int, base: float):
    def run(batches):
        for batch in batches:
            examples = load(path)
            counts = [term_counts(word_counts(t), examples.keys) for t in batch.column("low").to_pylist()]
            raw = pa.array([r for r, _, _ in examples.raw(counts, k, base)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("label"), raw], names=["label", "raw"])

    return run


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", *,
    use: Column | None = None, max_examples: int = 20_000, least_documents: int = 3, false_terms: float = 0.01, k: int = 15,
) -> ToxicityModel:
    """Examples and their index from at most ``max_examples`` labelled documents (``use``: condition on the labels).

    Four fifths are examples, the rest calibrates. All examples vote, copies too. Vectors cover all
    words of the examples; document frequencies come from all documents. Words in ``least_documents`` examples at least
    whose presence goes with the label weigh 1 + gain times as much: n KL(p || base rate) of a word
    in n examples must reach ln(words tested / ``false_terms``), which bounds by about that number the
    words taken by chance. For this count alone, copies and most near copies of one label (equal in one of two MinHashes of
    word 3-grams) are one example, or else the words of a much copied text would seem to go with its label.

    Vectors are made where the texts are. The driver decides on their places, then is sent them in order, some at a time,
    straight into the arrays of the index, whose size the sample bounds, and writes these to the shared folder.
    """
    spark = docs.sparkSession
    ship_package(spark)
    sample = labelled_sample(docs, labels, id_col, text_col, label_col, use, max_examples)
    kind = sample.schema["id"].dataType.simpleString()
    part = F.pmod(F.xxhash64("low", F.lit(1)), F.lit(5))
    sample = sample.select("id", "label", F.lower("text").alias("low")).withColumn("example", part > 0)
    sample = cut_lineage(sample)
    examples = sample.where("example")
    ones, size = (v or 0 for v in examples.agg(F.sum("label"), F.count("*")).first())
    base = ones / size if size else 0.0
    single = examples.select("id", "label", "low").mapInArrow(_sketch, f"id {kind}, label int, low string, sketch_0 long, sketch_1 long")
    for sketch in ("sketch_0", "sketch_1"):
        single = single.groupBy(sketch, "label").agg(F.min(F.struct("id", "label", "low", "sketch_0", "sketch_1")).alias("row")).select("row.*")
    single = cut_lineage(single.select("label", "low"))
    ones, size = (v or 0 for v in single.agg(F.sum("label"), F.count("*")).first())
    words = single.select("label", F.explode(F.array_distinct(F.split("low", NO_WORD))).alias("term")).where("term <> ''")
    seen = words.groupBy("term").agg(F.count("*").alias("n"), F.sum("label").alias("p")).where(F.col("n") >= least_documents)
    seen = cut_lineage(seen)
    n, p, rate = F.col("n").cast("double"), F.col("p").cast("double"), ones / size if size else 0.0
    part = lambda k, share: F.when(k > 0, k * F.ln(k / (n * F.lit(share)))).otherwise(0.0)
    gain = part(p, rate) + part(n - p, 1 - rate)
    tested = seen.count()
    picked = seen.withColumn("gain", gain).where(F.col("gain") >= float(np.log(max(1, tested) / false_terms)))
    gains = {r.term: r.gain for r in picked.collect()}  # words of the sample, which bounds them

    path = f"{shared_dir(spark)}/toxicity-{uuid.uuid4().hex}"
    got = examples.mapInArrow(_packed, f"id {kind}, label int, hashes binary, times binary")
    got = cut_lineage(got.withColumn("row", F.monotonically_increasing_id()))
    # the vocabulary is all words of the examples, which the sample bounds
    keys = got.select("hashes").mapInArrow(_distinct, "h long").distinct().toArrow()
    keys = np.sort(keys.column("h").to_numpy().view(np.uint64))
    write_arrays({"keys": keys}, f"{path}-keys")
    gain = {int(run_hashes(t.encode(), np.array([0]), np.array([len(t.encode())]))[0]): (t, g) for t, g in gains.items()}
    strong = np.array(sorted(gain), np.uint64)
    marked = np.searchsorted(keys, strong)
    terms = [gain[h][0] for h in strong.tolist()]

    low = docs.select(F.lower(F.coalesce(text_col, F.lit(""))).alias("low"))
    counted = low.mapInArrow(_document_counts(path), "t long, n long").groupBy("t").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(len(keys) + 1)
    counts[counted.column("t").to_numpy()] = counted.column("n").to_numpy()
    idf = np.log((1 + counts[-1]) / (1 + counts[:-1])) + 1
    idf[marked] *= 1 + np.array([gain[h][1] for h in strong.tolist()])

    write_arrays({"idf": idf, "marked": marked}, f"{path}-words")
    del counted, counts, idf

    shared: dict[bytes, list] = {}  # by a digest of the vector: votes, least id and its row, terms, sort key
    empty = []
    kinds = f"row long, id {kind}, label int, digest binary, size int, heavy int, share double"
    for r in got.mapInArrow(_places(path), kinds).toArrow().to_pylist():
        label = r["label"] > 0
        if not r["size"]:
            empty.append(label)
            continue
        entry = shared.setdefault(r["digest"], [0, 0, (r["id"], r["row"]), r["size"], (r["heavy"], r["share"])])
        entry[label] += 1
        entry[2] = min(entry[2], (r["id"], r["row"]))
    # like vectors in the same blocks, so that the maxima are tight
    made = sorted(shared.values(), key=lambda entry: (*entry[4], entry[2][0]))
    shared.clear()
    votes, names = np.array([m[:2] for m in made], float).reshape(-1, 2), [m[2][0] for m in made]
    offsets = np.concatenate(([0], np.cumsum([m[3] for m in made]))).astype(np.int64)
    places = small_table(spark, [(m[2][1], k) for k, m in enumerate(made)], "row long, place int")
    vectors = got.select("row", "hashes", "times").join(F.broadcast(places), "row").drop("row")
    vectors = vectors.repartitionByRange(len(made) // SENT + 1, "place").sortWithinPartitions("place")
    vectors = vectors.mapInArrow(_vectors(path), "place int, terms binary, weights binary")
    term, weight = np.empty(offsets[-1], np.int32), np.empty(offsets[-1])
    for r in vectors.toLocalIterator():  # a partition at a time
        part = slice(offsets[r.place], offsets[r.place + 1])
        term[part], weight[part] = np.frombuffer(r.terms, np.int32), np.frombuffer(r.weights, np.float64)
    del made, places
    index = BlockMaxIndex.of_rows(term, weight, offsets, len(keys))
    write_arrays({"votes": votes, **{f"index_{c}": x for c, x in index.arrays.items()}}, path)
    del index, term, weight, keys
    model = ToxicityModel(path, terms, names, k, None, base, 0.0)
    rest = sample.where("not example").select("label", "low")
    held = [(r.raw, r.label > 0) for r in rest.mapInArrow(_raw_votes(path, k, base), "label int, raw double").collect()]
    empty += [y for x, y in held if x is None]
    model.unknown = sum(empty) / len(empty) if empty else 0.0
    known = [(x, y) for x, y in held if x is not None]
    if known:
        x = np.array([x for x, _ in known])
        least, rate = isotonic(x, np.array([y for _, y in known], float))
        # flat over each step, linear over the gap between two
        x = np.unique(x)
        most = x[np.append(np.searchsorted(x, least[1:]), len(x)) - 1]
        model.steps = np.column_stack((least, most)).ravel(), np.repeat(rate, 2)
    return model


def _scored(docs: DataFrame, model: ToxicityModel, text_col: str, keep_below: float | None):
    """``docs`` with ``score``, ``terms`` and ``evidence``; or its rows below a score, without them."""
    ship_package(docs.sparkSession)
    names = ("score", "terms", "evidence")
    kept = docs if keep_below is not None else docs.drop(*names)
    low = spare_name(docs, "_low")
    fed = kept.withColumn(low, F.lower(F.coalesce(text_col, F.lit(""))))
    fields = pa.struct([("example", pa.string()), ("cosine", pa.float64()), ("votes_0", pa.int64()), ("votes_1", pa.int64())])

    def shown(words: Words, known, counts, examples) -> list[str]:
        """The words that go with the label, and the ten of most weight, in the text's spelling."""
        pick = examples.is_marked[counts[0]]
        heavy = -(1 + np.log(counts[1])) * examples.idf[counts[0]]
        pick[np.argsort(heavy, kind="stable")[:10]] = True
        first = words.first[known][pick]
        return [words.data[a:b].decode() for a, b in zip(words.starts[first].tolist(), words.ends[first].tolist())]

    def judge(texts: list[str], memo: dict) -> list[tuple]:
        examples, keys, new = load(model.path), [], {}
        for text in texts:
            words = Words(text)
            at, known = known_words(words.hashes, examples.keys)
            counts = at, words.times[known]
            key = blake2b(counts[0].tobytes() + counts[1].tobytes(), digest_size=16).digest()
            keys.append(key)
            if key not in memo:
                new.setdefault(key, (words, known, counts))
        for (key, (words, known, counts)), (raw, found, cosines) in zip(new.items(), examples.raw([c for *_, c in new.values()], model.k, model.base)):
            if keep_below is not None:
                memo[key] = (model.calibrated(raw),)
                continue
            near = [
                {"example": str(model.example[i]), "cosine": float(c), "votes_0": int(examples.votes[i, 0]), "votes_1": int(examples.votes[i, 1])}
                for i, c in list(zip(found, cosines))[:3]
            ]
            memo[key] = (model.calibrated(raw), shown(words, known, counts, examples) if len(found) else [], near)
        out = [memo[key] for key in keys]
        if len(memo) >= 10_000:
            memo.clear()
        return out

    def run(batches):
        memo: dict[bytes, tuple] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, 4 * QUERIES):
                part = batch.slice(start, 4 * QUERIES)
                judged = judge(part.column(low).to_pylist(), memo)
                rest = part.drop_columns([low])
                if keep_below is not None:
                    yield rest.filter(pa.array([j[0] < keep_below for j in judged], pa.bool_()))
                    continue
                made = [pa.array([j[k] for j in judged], t) for k, t in enumerate((pa.float64(), pa.list_(pa.string()), pa.list_(fields)))]
                yield pa.RecordBatch.from_arrays([*rest.columns, *made], names=[*rest.schema.names, *names])

    near = "array<struct<example: string, cosine: double, votes_0: long, votes_1: long>>"
    added = f"score double, terms array<string>, evidence {near}"
    return fed.mapInArrow(run, kept.schema if keep_below is not None else with_fields(kept, added))


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """``docs`` with the toxicity of every whole text: ``score`` (0 to 1), ``terms`` (its words that go with the label, and its ten known words of most weight), ``evidence``
    (the three nearest examples: ``example`` id, ``cosine``, ``votes_0``, ``votes_1``).

    Null counts as empty. A text without a word of the examples, an empty one too, has no neighbours; its score is
    the share of label 1 among such labelled texts. Examples with equal vectors are one neighbour with all
    their votes; neighbours that tie with the k-th all vote. Each row stands alone, whatever its id.
    Columns of ``docs`` with these names are replaced.
    """
    return _scored(docs, model, text_col, None)


def keep_clean(docs: DataFrame, model: ToxicityModel, below: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score less than ``below``."""
    return _scored(docs, model, text_col, below)
