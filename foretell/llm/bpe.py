"""Byte-level BPE: a segment tree over adjacent pair ranks picks each merge."""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foretell.llm.common import spare_name, with_fields
from foretell.session import ship_package

#: Words kept per worker process, and characters of text that are cut into words at a time.
CACHE_WORDS, SLICE_CHARS = 200_000, 1 << 19
#: Rows of a result batch.
SLICE_ROWS = 64
#: Cells of a block of words that are merged together.
BLOCK_CELLS = 1 << 19
NONE = np.int64(1) << 62


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 stands for itself."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    letters = {chr(b): b for b in plain}
    others = (b for b in range(256) if b not in plain)
    return letters | {chr(256 + i): b for i, b in enumerate(others)}


class Bpe:
    """A byte-level BPE vocabulary read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, cut = spec["model"], spec["pre_tokenizer"]
        usual = (
            model["type"] == "BPE" and cut["type"] == "ByteLevel" and not cut["add_prefix_space"]
            and spec["normalizer"] is None and not model.get("ignore_merges") and not model.get("dropout")
            and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"])
        )
        if not usual:
            raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
        letters, vocab = _byte_letters(), model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*vocab.values(), *self.special.values()])
        self.bytes = [b""] * size
        for token, i in vocab.items():
            self.bytes[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.of_byte = np.zeros(256, np.int64)
        for c, b in letters.items():
            self.of_byte[b] = vocab[c]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.words = regex.compile(public_tokenizers.PATTERN)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.cache: dict[str, bytes] = {}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, NONE where the pair does not merge."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, packed as little-endian unsigned 32-bit integers.

        Words of about one length are merged together. Row w of the tree belongs to word w: leaf p
        holds ``rank << 32 | p`` of the pair that starts at symbol p, inner nodes the
        least below them. So the root is the leftmost pair of lowest rank. A merge changes three
        leaves and the nodes above them.
        """
        out: list[bytes] = [b""] * len(words)
        by_width: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if w:
                by_width.setdefault(1 << max(1, (len(w) - 1).bit_length()), []).append(i)
        for width, rows in by_width.items():
            step = max(1, BLOCK_CELLS // width)
            for start in range(0, len(rows), step):
                part = rows[start : start + step]
                for i, ids in zip(part, self._merge_block([words[i] for i in part], width)):
                    out[i] = ids
        return out

    def _merge_block(self, words: list[bytes], width: int) -> list[bytes]:
        n = len(words)
        length = np.array([len(w) for w in words], np.int64)
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width)
        column = np.arange(width)
        alive = column < length[:, None]
        symbol = np.full((n, width + 1), -1, np.int64)  # one more column: what follows the last symbol
        symbol[:, :width] = np.where(alive, self.of_byte[raw], -1)
        after = np.minimum(column + 1, length[:, None])
        after = np.where(after == length[:, None], width, after)
        before = np.broadcast_to(column - 1, (n, width)).copy()
        tree = np.full((n, 2 * width), NONE, np.int64)
        rank = self.rank(symbol[:, :-1], symbol[:, 1:])
        rank[~alive | (after == width)] = NONE
        tree[:, width:] = np.where(rank == NONE, NONE, rank << 32 | column)
        level = width
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2
        flat_tree, flat_symbol, flat_after, flat_before = tree.ravel(), symbol.ravel(), after.ravel(), before.ravel()
        flat_alive = alive.ravel()
        w = np.arange(n)
        while True:
            root = flat_tree[w * (2 * width) + 1]
            w = w[root != NONE]
            if not len(w):
                break
            root = root[root != NONE]
            base, symbols, leaves = w * width, w * (width + 1), w * (2 * width)
            p = root & 0xFFFFFFFF
            q = flat_after[base + p]
            r = flat_after[base + q]
            flat_symbol[symbols + p] = self.merged[root >> 32]
            flat_after[base + p] = r
            flat_alive[base + q] = False
            inner = r < width
            flat_before[(base + r)[inner]] = p[inner]
            o = flat_before[base + p]
            first = o < 0
            o = np.where(first, p, o)
            now = flat_symbol[symbols + p]
            right = np.where(inner, self.rank(now, flat_symbol[symbols + r]), NONE)
            left = np.where(first, right, self.rank(flat_symbol[symbols + o], now))
            leaf = np.concatenate((leaves + width + q, leaves + width + p, leaves + width + o))
            value = np.concatenate((np.full(len(w), NONE), right, left))
            place = np.concatenate((q, p, o))
            flat_tree[leaf] = np.where(value == NONE, NONE, value << 32 | place)
            row, node = np.tile(leaves, 3), width + place
            level = width
            while level > 1:
                node = node >> 1
                flat_tree[row + node] = np.minimum(flat_tree[row + 2 * node], flat_tree[row + 2 * node + 1])
                level >>= 1
        ids = symbol[:, :width][alive].astype("<u4")
        ends = np.cumsum(alive.sum(axis=1)) * 4
        packed = ids.tobytes()
        return [packed[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def split(self, text: str) -> list[str]:
        """Pre-tokens in order; special tokens stand alone."""
        if self.specials is None or not any(s in text for s in self.special):
            return self.words.findall(text)
        return [w for part in self.specials.split(text) for w in ([part] if part in self.special else self.words.findall(part))]

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self.split(t) for t in texts]
        new = set().union(*cut).difference(self.cache)
        if len(self.cache) + len(new) > CACHE_WORDS:
            self.cache.clear()
            new = set().union(*cut)
        plain = [w for w in new if w not in self.special]
        self.cache.update(zip(plain, self.merge([w.encode() for w in plain])))
        self.cache.update({w: np.uint32(self.special[w]).astype("<u4").tobytes() for w in new if w in self.special})
        return [b"".join(map(self.cache.__getitem__, words)) for words in cut]

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(2)
def load(path: str) -> Bpe:
    return Bpe(path)


def _append(df: DataFrame, column: str, added: dict[str, str], work) -> DataFrame:
    """``df`` with columns (names and types) made of ``column`` by a function of lists, some rows at a time."""
    source = spare_name(df, "_source")
    kept = df.drop(*added)
    fed = kept.withColumn(source, F.col(column))
    kinds = [{"binary": pa.binary(), "string": pa.string()}[k] for k in added.values()]

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                made = [pa.array(x, k) for x, k in zip(work(part.column(source).to_pylist()), kinds)]
                rest = part.drop_columns([source])
                yield pa.RecordBatch.from_arrays([*rest.columns, *made], names=[*rest.schema.names, *added])

    return fed.mapInArrow(run, with_fields(kept, ", ".join(f"`{c}` {k}" for c, k in added.items())))


def _encoded(bpe: Bpe, texts: list[str | None]) -> list[bytes]:
    """Ids of each text; words are looked up for about SLICE_CHARS characters at a time."""
    out: list[bytes] = []
    start = total = 0
    for i, text in enumerate(texts):
        total += len(text or "")
        if total >= SLICE_CHARS or i == len(texts) - 1:
            out += bpe.encode([t or "" for t in texts[start : i + 1]])
            start, total = i + 1, 0
    return out


def _place(path: str | None) -> str:
    return path or public_tokenizers.path("byte_bpe_50k.json")


def encode(docs: DataFrame, text_col: str = "text", ids_col: str = "ids", *, path: str | None = None) -> DataFrame:
    """``docs`` with ``ids_col``: token ids of the whole text as little-endian unsigned 32-bit integers.

    As the tokenizer file defines them, without added start or end tokens; special tokens that
    stand in a text are recognised. Null counts as empty and gives no ids. Any length of text or
    of a run without blanks is encoded: memory is bounded by one text, time by n log n. An existing
    column of the name is replaced. Each row stands alone, whatever its other columns.
    """
    ship_package(docs.sparkSession)
    place = _place(path)
    return _append(docs, text_col, {ids_col: "binary"}, lambda texts: [_encoded(load(place), texts)])


def decode(rows: DataFrame, ids_col: str = "ids", text_col: str = "decoded", *, path: str | None = None) -> DataFrame:
    """``rows`` with ``text_col``: the text of the ids, special tokens included. Null ids give an empty text.

    Bytes that are no UTF-8 become replacement characters.
    """
    ship_package(rows.sparkSession)
    place = _place(path)
    return _append(rows, ids_col, {text_col: "string"}, lambda ids: [[load(place).decode(x or b"") for x in ids]])


def round_trip(
    docs: DataFrame, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded", *, path: str | None = None,
) -> DataFrame:
    """``encode`` and ``decode`` of its ids, by one Python worker for each task instead of two."""
    ship_package(docs.sparkSession)
    place = _place(path)

    def work(texts):
        ids = _encoded(load(place), texts)
        return [ids, [load(place).decode(x) for x in ids]]

    return _append(docs, text_col, {ids_col: "binary", decoded_col: "string"}, work)


def unpack(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, "<u4")
