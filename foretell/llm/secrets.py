"""Secret scan: fixed patterns, and random strings that a tokenizer cannot pack."""

from __future__ import annotations

import base64
import re
from bisect import bisect_left
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foretell.llm.common import runs, with_fields
from foretell.session import ship_package

KINDS = ("assign", "access", "hex", "random")
SPANS = "array<struct<kind: string, start: int, end: int, base: boolean>>"
ASSIGN = re.compile(
    r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Shapes of digests that random keys have as well.
DIGEST = r"(?:[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{56}|[0-9A-F]{64}|[0-9A-F]{96}|[0-9A-F]{128}|[A-Z2-7]{32}|[A-Z2-7]{52}={0,4})"
NAMED = r"(?i:md5|sha-?(?:1|224|256|384|512))"
#: What the token test leaves out: SHA-1 digests, other digests that are named, identifiers, numbers.
KNOWN = re.compile(
    rf"[0-9A-F]{{40}}|{NAMED}[/=_-]{DIGEST}|sha(?:256|384|512)-[A-Za-z0-9+/]+={{0,2}}"
    r"|[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
    r"|[0-9+/=_-]+"
)
DIGEST = re.compile(DIGEST)
#: Between marks; a UUID is one piece.
PIECE = re.compile(rb"(?<![A-Za-z0-9])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![A-Za-z0-9])|[A-Za-z0-9]+")
#: The end of a text that names the digest which follows.
NAMES_DIGEST = re.compile(rf"(?<![A-Za-z0-9])(?:{NAMED}\x20?[:=/_-]\x20?|(?i:urn):(?:[A-Za-z0-9-]{{1,16}}:)*)[\"']?\Z")


def _class(letters: str) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[list(letters.encode())] = 1
    return table


_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
HEX, TOKEN = _class(_DIGITS + "abcdef"), _class(_DIGITS + _LOWER + _LOWER.upper() + "+/=_-")


@lru_cache(2)
def vocabulary(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("secrets", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _long_runs(data: bytes, table: np.ndarray, least: int) -> list[tuple[int, int]]:
    starts, ends = runs(data, table)
    keep = ends - starts >= least
    return list(zip(starts[keep].tolist(), ends[keep].tolist()))


def _known(data: bytes, start: int, end: int) -> bool:
    word = data[start:end].decode()
    if KNOWN.fullmatch(word):
        return True
    return bool(DIGEST.fullmatch(word) and NAMES_DIGEST.search(data[max(0, start - 48) : start].decode("latin-1")))


def _stretches(data: bytes, start: int, end: int, free, hard) -> list[tuple[int, int]]:
    """Parts of a run between marks, joined where neighbours are ``hard`` to pack too, or shorter than 4 characters."""
    out, first, last = [], None, None
    for m in PIECE.finditer(data, start, end):
        if b"-" not in m[0] and free(*m.span()) and hard(*m.span()):
            first, last = m.start() if first is None else first, m.end()
        elif first is not None and (m.end() - m.start() > 3 or not free(*m.span())):
            out.append((first, last))
            first = None
    return out if first is None else [*out, (first, last)]


def find_secrets(text: str, encoding: tiktoken.Encoding, least_chars: int, most_chars_per_token: float) -> list[tuple]:
    """Spans (kind, start, end, base) of a text in code points, by start, then kind."""
    data = text.encode()
    plain = len(data) == len(text)
    seen = [0, 0]  # a place in bytes and in code points; runs come in order

    def place(at: tuple[int, int]) -> tuple[int, int]:
        if plain:
            return at
        seen[1] += len(data[seen[0] : at[0]].decode())
        seen[0] = at[0]
        return seen[1], seen[1] + at[1] - at[0]  # runs are ASCII

    found = []
    low = text.lower()
    if any(k in low for k in ("passw", "secret", "token", "api")):
        found += [("assign", *m.span(), True) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span(), True) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *place(x), True) for x in _long_runs(data, HEX, 24)]
    starts, ends = [], []  # of the base spans, merged
    for s, e in sorted((s, e) for _, s, e, _ in found):
        if ends and s < ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    seen[:] = [0, 0]
    for at in _long_runs(data, TOKEN, least_chars):
        if _known(data, *at):
            continue
        shift = place(at)[0] - at[0]

        def free(start: int, end: int) -> bool:
            k = bisect_left(starts, end + shift)
            return k == 0 or ends[k - 1] <= start + shift

        def hard(start: int, end: int) -> bool:
            return end - start <= most_chars_per_token * len(encoding.encode_ordinary(data[start:end].decode()))

        if free(*at) and hard(*at):
            parts = [at]
        else:  # words beside a random part pack well and hide it
            parts = [x for x in _stretches(data, *at, free, hard) if x[1] - x[0] >= least_chars and not _known(data, *x) and hard(*x)]
        found += [("random", s + shift, e + shift, False) for s, e in parts]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def scan_secrets(
    docs: DataFrame, text_col: str = "text", *, least_chars: int = 20, most_chars_per_token: float = 2.0,
    path: str | None = None, spans_col: str = "spans", redacted_col: str = "redacted",
) -> DataFrame:
    """Secrets in every whole text: ``docs`` with ``spans`` and ``redacted`` (names by parameters).

    ``spans``: ``kind``, ``start``, ``end`` (code points, end exclusive) and ``base``, by start, then
    assign, access, hex, random. Assignments to secret names, access keys and long hex runs are base. A run of
    at least ``least_chars`` of letters, digits and ``+/=_-`` that takes a token for every
    ``most_chars_per_token`` characters or fewer is random, unless it is an upper-case SHA-1, another digest that
    is named as one, a UUID, or a number, or overlaps a base span; else its parts between ``+/=_-`` that do so by themselves,
    with neighbours that do so too, if they are that long. ``redacted``: the text
    with each stretch of spans as ``[SECRET]``; the text itself where there are none.

    Null counts as empty in ``spans`` and stays null in ``redacted``. Columns of ``docs`` with
    these two names are replaced. Each row stands alone, whatever its id.
    """
    ship_package(docs.sparkSession)
    place = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    fed = docs.drop(spans_col, redacted_col)
    column = next(c for c in fed.columns if c.lower() == text_col.lower())

    def redact(text, spans):
        out, done = [], 0
        for _, start, end, _ in spans:
            if start >= done:
                out += [text[done:start], "[SECRET]"]
            done = max(done, end)
        return "".join([*out, text[done:]])

    def run(batches):
        encoding = vocabulary(place)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
        for batch in batches:
            texts = batch.column(column).to_pylist()
            found = [find_secrets(t or "", encoding, least_chars, most_chars_per_token) for t in texts]
            spans = pa.array([[dict(zip(("kind", "start", "end", "base"), s)) for s in f] for f in found], kind)
            clean = pa.array([redact(t, f) if f else t for t, f in zip(texts, found)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, spans, clean], names=[*batch.schema.names, spans_col, redacted_col])

    return fed.mapInArrow(run, with_fields(fed, f"`{spans_col}` {SPANS}, `{redacted_col}` string"))
