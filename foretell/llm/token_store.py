"""Token ids in directly addressable codes: any token of a file is read without decoding others.

A file holds ids in levels of chunks. Level 0 has the lowest bits of every id, the next level the next bits of those ids
that have more, and so on. A bitmap per level says which ids go on, and a rank directory (ones before
every 512th bit) says where: the place on the next level is the number of ones before the bit.
"""

from __future__ import annotations

import json
import os
import re
import string
import struct
import uuid
from array import array
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from foretell.llm.archive import Reader, open_store
from foretell.session import cut_lineage, scratch_path, ship_package

#: Bits of the chunks of each level, each 8, 16 or 32; together they hold 32 bits.
WIDTHS = (8, 8, 16)
#: Bits between two entries of a rank directory.
RANK_BITS = 512
#: Ids of a file, and ids that a task holds when it reads whole documents.
FILE_IDS, READ_IDS = 1 << 24, 1 << 20
#: Characters of text that are encoded at a time, and parts of texts that a worker remembers.
SLICE_CHARS, CACHE_PARTS = 1 << 23, 800_000
#: How a byte-level vocabulary writes a blank.
BLANK = "\u0120"
MAGIC = b"idcodes1"
_HEAD = struct.Struct("<8sQQQB")  # magic, ids, place and bytes of the documents' table, levels
_LEVEL = struct.Struct("<BQQQQ")  # bits, chunks, places of chunks, bitmap and directory


def pack_ids(ids: np.ndarray, documents: pa.Table, widths: tuple[int, ...] = WIDTHS) -> bytes:
    """A file of unsigned 32-bit ``ids`` and a table of its documents (any columns, and ``stop``: ids up to its end)."""
    if sum(widths) < 32 or not set(widths) <= {8, 16, 32}:
        raise ValueError("chunks of 8, 16 or 32 bits must hold 32 bits together")
    body, levels, at = [], [], _HEAD.size + _LEVEL.size * len(widths)

    def put(data: bytes) -> int:
        nonlocal at
        body.append(data)
        at += len(data)
        return at - len(data)

    rest = ids.astype(np.uint64)
    for bits in widths:
        chunks = put((rest & np.uint64((1 << bits) - 1)).astype(f"<u{bits // 8}").tobytes())
        more = (rest >> np.uint64(bits)) > 0
        bitmap = np.packbits(more, bitorder="little")
        bitmap = np.pad(bitmap, (0, -len(bitmap) % (RANK_BITS // 8)))
        ones = np.bitwise_count(bitmap).reshape(-1, RANK_BITS // 8).sum(axis=1, dtype=np.uint64)
        ranks = np.concatenate(([np.uint64(0)], np.cumsum(ones)))
        levels.append((bits, len(rest), chunks, put(bitmap.tobytes()), put(ranks.astype("<u8").tobytes())))
        rest = rest[more] >> np.uint64(bits)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, documents.schema) as out:
        out.write_table(documents)
    table = sink.getvalue().to_pybytes()
    head = _HEAD.pack(MAGIC, len(ids), put(table), len(table), len(widths))
    return b"".join([head, *[_LEVEL.pack(*level) for level in levels], *body])


class IdFile:
    """Random access to the ids of a file, by reads of the bytes needed."""

    def __init__(self, read: Reader):
        self.read = read
        magic, self.size, self._table_at, self._table_size, levels = _HEAD.unpack(read(_HEAD.size, 0))
        if magic != MAGIC:
            raise ValueError("not a file of directly addressable ids")
        data = read(_LEVEL.size * levels, _HEAD.size)
        self.levels = [_LEVEL.unpack_from(data, k * _LEVEL.size) for k in range(levels)]

    def documents(self) -> pa.Table:
        return pa.ipc.open_stream(self.read(self._table_size, self._table_at)).read_all()

    def _rank(self, level: int, bit: int) -> int:
        """Ones before a bit: one entry of the directory and the bits behind it."""
        _, _, _, bitmap, ranks = self.levels[level]
        block, rest = divmod(bit, RANK_BITS)
        before, = struct.unpack("<Q", self.read(8, ranks + 8 * block))
        if not rest:
            return before
        bits = np.unpackbits(np.frombuffer(self.read(-(-rest // 8), bitmap + block * RANK_BITS // 8), np.uint8), bitorder="little")
        return before + int(bits[:rest].sum())

    def __getitem__(self, i: int) -> int:
        """One id: a chunk and a bit per level."""
        if not 0 <= i < self.size:
            raise IndexError(i)
        value = shift = 0
        for level, (bits, _, chunks, bitmap, _) in enumerate(self.levels):
            width = bits // 8
            value |= int.from_bytes(self.read(width, chunks + i * width), "little") << shift
            shift += bits
            if shift >= 32 or not self.read(1, bitmap + i // 8)[0] >> i % 8 & 1:
                break
            i = self._rank(level, i)
        return value

    def slice(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` to before ``stop``: one run of chunks and bits on each level."""
        if not 0 <= start <= stop <= self.size:
            raise IndexError((start, stop))
        out = np.zeros(stop - start, np.uint32)
        where, shift = np.arange(stop - start), 0
        for level, (bits, _, chunks, bitmap, _) in enumerate(self.levels):
            n = stop - start
            if not n:
                break
            width = bits // 8
            part = np.frombuffer(self.read(n * width, chunks + start * width), f"<u{width}").astype(np.uint32)
            out[where] |= part << np.uint32(shift)
            shift += bits
            if shift >= 32:
                break
            first = start // 8
            flags = np.unpackbits(np.frombuffer(self.read(-(-stop // 8) - first, bitmap + first), np.uint8), bitorder="little")
            flags = flags[start - 8 * first :][:n].astype(bool)
            where = where[flags]
            start = self._rank(level, start)
            stop = start + len(where)
        return out


#: A visible character before a blank and another one: a byte-level tokenizer always parts words there.
_SEAM = re.compile(r"(?<=\S) (?=\S)")
#: What ``\S`` leaves out, for Arrow's expressions.
_WHITE = r"[\t-\r\x1c- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Texts where some blank or line break is no seam.
_ODD = f"{_WHITE}[ \n]|[ \n]{_WHITE}|^[ \n]|[ \n]$"


class Encoder:
    """Ids of texts by the tokenizers library, which sees a part between two seams once while it is remembered.

    A byte-level tokenizer also parts letters from the punctuation behind them, and a line break from both neighbours.
    """

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives each worker a core; the library's threads would spin for work
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        spec = json.loads(self.tokenizer.to_str())
        cut = spec["pre_tokenizer"] or {}
        usual = cut.get("type") == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"] and not spec["normalizer"]
        if not usual or any(not t["content"].isascii() or set(t["content"]) & set(" \n") for t in spec["added_tokens"]):
            raise ValueError(f"{name} is not a plain byte-level tokenizer")
        # punctuation that no added token holds can be parted from the letters before it
        self.marks = "".join(set(string.punctuation).difference(*[t["content"] for t in spec["added_tokens"]]))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, dict[str, bytes]] = {"": {}, " ": {}}  # ids of parts, by what stands before them
        self.line = self._each(["\n"])[0]
        # a line break of several tokens is never found, so parts behind breaks are then encoded one by one
        self.break_id = int.from_bytes(self.line, "little") if len(self.line) == 4 else 1 << 32
        blank = [i for token, i in self.tokenizer.get_vocab().items() if token.startswith(BLANK)]
        self.blank = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
        self.blank[blank] = True

    def _learn(self, parts: list[str], before: str = "") -> list[bytes]:
        """Ids of each part with ``before`` in front, packed in 32 bits."""
        known = self.known[before]
        found = list(map(known.get, parts))
        new = {p for p, ids in zip(parts, found) if ids is None}
        if not new:
            return found
        if len(known) + len(new) > CACHE_PARTS:
            known.clear()
            new.update(parts)
        stems = {p: p.rstrip(self.marks) for p in new}
        split = [(p, stem, p[len(stem) :]) for p, stem in stems.items() if len(stem) < len(p) and stem[-1:].isalpha()]
        whole = new.difference([p for p, _, _ in split])
        whole.update([stem for _, stem, _ in split if stem not in known])
        whole = list(whole)
        for k in range(0, len(whole), 4096):
            some = whole[k : k + 4096]
            known.update(zip(some, self._joined(some, before) or self._each([before + p for p in some])))
        ends = {rest for _, _, rest in split}
        ends = dict(zip(ends, self._each(list(ends))))
        known.update([(p, known[stem] + ends[rest]) for p, stem, rest in split])
        return [known[p] if ids is None else ids for p, ids in zip(parts, found)]

    def _each(self, parts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def _joined(self, parts: list[str], before: str) -> list[bytes] | None:
        """As ``_each`` of parts with ``before`` in front, but of one text with a seam between any two; None if some part has a blank.

        A token that begins with a blank begins a part, and line breaks are tokens of their own.
        """
        text = before + (before or "\n").join(parts)
        if len(text.split()) != len(parts):
            return None
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        if before:
            stops = starts = np.append(np.flatnonzero(self.blank[ids]), len(ids)).tolist()
        else:
            stops = np.append(np.flatnonzero(ids == self.break_id), len(ids)).tolist()
            starts = [0, *[k + 1 for k in stops]]
        if len(starts) != len(parts) + 1:
            return None
        raw = ids.tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip(starts, stops[1:] if before else stops)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        column = pa.array(texts, pa.large_string())
        odd = np.asarray(pc.match_substring_regex(column, _ODD))
        plain = iter(self._plain(column.filter(pa.array(~odd))))
        return [self._odd(text) if o else next(plain) for text, o in zip(texts, odd.tolist())]

    def _odd(self, text: str) -> np.ndarray:
        first, *later = _SEAM.split(text)
        return np.frombuffer(b"".join([*self._learn([first]), *self._learn(later, " ")]), np.uint32)

    def _plain(self, texts: pa.Array) -> list[np.ndarray]:
        """Texts whose blanks and line breaks are all seams: distinct parts are looked up, then joined by number."""
        if not len(texts):
            return []
        lines = pc.split_pattern(texts, "\n")
        per_text = np.asarray(lines.value_lengths())
        lists = pc.split_pattern(lines.flatten(), " ")
        per_line = np.asarray(lists.value_lengths())
        coded = lists.flatten().dictionary_encode()
        code, words = np.asarray(coded.indices).astype(np.int64), coded.dictionary.to_pylist()
        firsts = np.cumsum(per_line) - per_line  # the part that begins a line has no blank in front
        heads = self._learn([words[k] for k in code[firsts].tolist()])
        fresh = np.ones(len(firsts), bool)
        fresh[np.cumsum(per_text) - per_text] = False
        code[firsts] = len(words) + np.arange(len(firsts))
        used = np.zeros(len(words) + len(firsts), bool)
        used[code] = True
        used = np.flatnonzero(used[: len(words)]).tolist()
        ids = [b""] * len(words)
        for k, found in zip(used, self._learn([words[k] for k in used], " ")):
            ids[k] = found
        ids += [self.line + head if f else head for head, f in zip(heads, fresh.tolist())]
        held = np.empty(len(ids), object)
        held[:] = ids
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        ends = np.cumsum(sizes[code])[np.cumsum(per_line) - 1][np.cumsum(per_text) - 1]
        out = np.frombuffer(b"".join(held[code].tolist()), np.uint32)
        return np.split(out, ends[:-1])


@lru_cache(2)
def load(name: str) -> Encoder:
    return Encoder(name)


def encode_texts(texts: list[str], name: str, end_id: int | None) -> list[np.ndarray]:
    """Ids of each text by the tokenizers library, with the end id."""
    tail = np.array([] if end_id is None else [end_id], np.uint32)
    out: list[np.ndarray] = []
    start = total = 0
    for k, text in enumerate(texts):
        total += len(text)
        if total >= SLICE_CHARS or k == len(texts) - 1:
            out += [np.concatenate((ids, tail)) for ids in load(name).encode(texts[start : k + 1])]
            start, total = k + 1, 0
    return out


def write_ids(
    docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", *, tokenizer: str = "byte_bpe_50k.json",
    end_id: int | None = 0, file_ids: int = FILE_IDS, partitions: int | None = None,
) -> DataFrame:
    """Encode every whole text and write the ids in ascending order of ``id_col``; returns the files.

    Columns: ``path``, ``part`` and ``number`` (order of the files), ``start`` (ids in all files before), ``ids``,
    ``documents``. ``end_id`` follows each document (None: nothing does). Null texts are empty. A null id comes first; rows that
    repeat an id are documents of their own, in the order of their text's hash. Texts are shuffled once, by ranges of id and hash, so that an id
    that many rows share is spread; each task streams its range to files of about ``file_ids`` ids. Files of attempts that
    failed are in the folder, but not in the result.
    """
    spark = docs.sparkSession
    ship_package(spark)
    store, place = open_store(folder)
    store.create_dir(place, recursive=True)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    order = ["id", "hash", "row"]
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    rows = rows.select(F.spark_partition_id().alias("part"), "id", "text")

    def run(batches):
        number, size, held, names, stops, part = 0, 0, [], [], [], 0

        def flush():
            documents = pa.table({"id": pa.concat_arrays(names), "stop": pa.array(stops, pa.int64())})
            data = pack_ids(np.concatenate(held), documents)
            path = f"{folder}/{uuid.uuid4().hex}.ids"  # a repeated task writes another file
            where, at = open_store(path)
            with where.open_output_stream(at) as out:
                out.write(data)
            return pa.RecordBatch.from_pydict({
                "path": pa.array([path]), "part": pa.array([part], pa.int32()), "number": pa.array([number], pa.int32()),
                "ids": pa.array([size], pa.int64()), "documents": pa.array([len(stops)], pa.int64()),
            })

        for batch in batches:
            texts = batch.column("text")
            for k in range(0, batch.num_rows, 256):
                slice_ = batch.slice(k, 256)
                part = slice_.column("part")[0].as_py()
                made = encode_texts(texts.slice(k, 256).to_pylist(), tokenizer, end_id)
                held += made
                names.append(slice_.column("id"))
                stops += (size + np.cumsum([len(m) for m in made])).tolist()
                size = stops[-1]
                if size >= file_ids:
                    yield flush()
                    number, size, held, names, stops = number + 1, 0, [], [], []
        if stops:
            yield flush()

    files = cut_lineage(rows.mapInArrow(run, "path string, part int, number int, ids long, documents long"))
    # one row per range of the shuffle
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.groupBy("part").agg(F.sum("ids").alias("total"))
    bases = bases.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return files.join(bases, "part").select(
        "path", "part", "number", (F.col("base") + F.coalesce(F.sum("ids").over(inside), F.lit(0))).alias("start"), "ids", "documents",
    )


def read_ids(files: DataFrame, id_type: str = "long", id_col: str = "doc_id") -> DataFrame:
    """Documents of the files: ``id_col``, ``start`` (ids of all documents before), ``n_tokens``, ``ids`` (little-endian, 32 bits)."""
    ship_package(files.sparkSession)
    paths = cut_lineage(files.select("path", "start"))
    # a row stands for a whole file, so partitions are counted, not left to their bytes
    spread = paths.repartition(max(1, paths.count()), "path")

    def run(batches):
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                store, place = open_store(path)
                with store.open_input_file(place) as source:
                    file = IdFile(lambda n, at: source.read_at(n, at))  # noqa: B023
                    documents = file.documents()
                    names, stops = documents.column("id").combine_chunks(), documents.column("stop").to_numpy()
                    starts = np.concatenate(([0], stops[:-1]))
                    first = 0
                    while first < len(stops):
                        last = max(first + 1, int(np.searchsorted(stops, starts[first] + READ_IDS, side="right")))
                        raw = file.slice(int(starts[first]), int(stops[last - 1])).astype("<u4").tobytes()
                        cuts = list(zip((starts[first:last] - starts[first]).tolist(), (stops[first:last] - starts[first]).tolist()))
                        yield pa.RecordBatch.from_arrays(
                            [names.slice(first, last - first), pa.array(base + starts[first:last]), pa.array(stops[first:last] - starts[first:last]),
                             pa.array([raw[4 * a : 4 * b] for a, b in cuts], pa.binary())],
                            names=[id_col, "start", "n_tokens", "ids"],
                        )
                        first = last

    return spread.mapInArrow(run, f"`{id_col}` {id_type}, start long, n_tokens long, ids binary")


def stored_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``write_ids`` to a new folder below the shared one, and ``read_ids`` of its files.

    Options are those of ``write_ids``. An empty table gives no files and no rows; other columns of ``docs`` are not read.
    """
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    return read_ids(write_ids(docs, scratch_path(docs.sparkSession, "ids"), id_col, text_col, **options), kind, id_col)
