"""Personal data: fixed patterns, and a character BiLSTM-CRF that learns from the spans they find."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from itertools import accumulate
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foretell.session import ship_package

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind: string, start: int, end: int, base: boolean>>"
#: Tags: nothing, then first and later characters of each kind.
TAGS = 1 + 2 * len(KINDS)
#: Characters that every span of these kinds has one of.
TRIGGER = re.compile(r"[0-9@]+")
#: Context on each side of a trigger; length of a window and the step to the next.
MARGIN, WINDOW, STEP = 32, 96, 48

_LOCAL = r"[A-Za-z0-9._%+-]++"
_DOMAIN = r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
# Matches that begin where a run begins, or where the match before ended, so that long runs are read once.
_EMAIL_HERE, _EMAIL = re.compile(_LOCAL + _DOMAIN), re.compile(r"(?<![A-Za-z0-9._%+-])" + _LOCAL + _DOMAIN)
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans by the fixed patterns, leftmost and non-overlapping within a kind; a match that fails its test is dropped."""
    out = []
    if "@" in text:
        at = 0
        while m := _EMAIL_HERE.match(text, at) or _EMAIL.search(text, at):
            out.append(("email", *m.span()))
            at = m.end()
    if not TRIGGER.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def regions(text: str) -> list[tuple[int, int]]:
    """Ranges around digits and @, merged. Outside of them no span of these kinds can be."""
    out: list[list[int]] = []
    for m in TRIGGER.finditer(text):
        low, high = max(0, m.start() - MARGIN), min(len(text), m.end() + MARGIN)
        if out and low <= out[-1][1]:
            out[-1][1] = high
        else:
            out.append([low, high])
    return [(a, b) for a, b in out]


def windows(length: int) -> list[tuple[int, int]]:
    """Overlapping windows that cover a region."""
    starts = list(range(0, max(1, length - WINDOW + STEP), STEP))
    return [(s, min(length, s + WINDOW)) for s in starts]


def letters(text: str) -> np.ndarray:
    """Character classes: ASCII as it is, then other letters and the rest; 0 is padding."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    wide = np.array([128 + (not c.isalpha()) for c in text if ord(c) >= 128], np.int64)
    codes[codes >= 128] = wide
    return codes + 1


SYMBOLS = 131


def tag_sequence(length: int, spans: list[tuple[str, int, int]], offset: int) -> np.ndarray:
    tags = np.zeros(length, np.int64)
    for kind, start, end in spans:
        a, b = max(0, start - offset), min(length, end - offset)
        if a < b and not tags[a:b].any():
            tags[a:b] = 2 + 2 * KINDS.index(kind)
            if start >= offset:
                tags[a] -= 1
    return tags


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Tagger:
    """Weights of the network; all arrays are small and of fixed shape."""

    w: dict[str, np.ndarray]

    @staticmethod
    def fresh(embed: int = 12, hidden: int = 16, seed: int = 5) -> Tagger:
        rng = np.random.default_rng(seed)
        w = {"embed": rng.normal(0, 0.3, (SYMBOLS, embed)), "out": rng.normal(0, 0.3, (2 * hidden, TAGS)), "bias": np.zeros(TAGS)}
        for side in "fb":
            w[f"{side}_x"] = rng.normal(0, 0.3, (embed, 4 * hidden))
            w[f"{side}_h"] = rng.normal(0, 0.3, (hidden, 4 * hidden))
            w[f"{side}_b"] = np.repeat([0.0, 1.0, 0.0, 0.0], hidden)  # in, forget, out, new
        w["move"] = np.zeros((TAGS, TAGS))
        return Tagger({k: v.astype(np.float32) for k, v in w.items()})

    def _pass(self, side: str, x: np.ndarray, mask: np.ndarray, keep: bool):
        """Hidden states of one direction over (time, row); masked steps carry the state on."""
        wx, wh, b = self.w[f"{side}_x"], self.w[f"{side}_h"], self.w[f"{side}_b"]
        steps, rows, size = len(x), x.shape[1], len(wh)
        table = self.w["embed"] @ wx + b  # what each symbol adds to the gates
        h, c = np.zeros((rows, size), np.float32), np.zeros((rows, size), np.float32)
        out, saved = np.empty((steps, rows, size), np.float32), []
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z = table[x[t]] + h @ wh
            g = _sigmoid(z[:, : 3 * size])
            i, f, o, n = g[:, :size], g[:, size : 2 * size], g[:, 2 * size :], np.tanh(z[:, 3 * size :])
            m = mask[t][:, None]
            c2 = np.where(m, f * c + i * n, c)
            h2 = np.where(m, o * np.tanh(c2), h)
            if keep:
                saved.append((t, h, c, i, f, o, n, c2))
            h, c = h2, c2
            out[t] = h
        return out, saved

    def emissions(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Tag scores of symbols (time, row)."""
        both = np.concatenate([self._pass(s, x, mask, False)[0] for s in "fb"], axis=2)
        return both @ self.w["out"] + self.w["bias"]

    def gradient(self, x: np.ndarray, mask: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Negative log-likelihood per row under the CRF, and its gradient by back-propagation through time."""
        w, rows = self.w, x.shape[1]
        passes = {s: self._pass(s, x, mask, True) for s in "fb"}
        both = np.concatenate([passes["f"][0], passes["b"][0]], axis=2)
        score = both @ w["out"] + w["bias"]
        loss, d_score, d_move = crf_loss(score, mask, tags, w["move"])
        d = {k: np.zeros_like(v) for k, v in w.items()}
        d["move"], d["bias"] = d_move, d_score.sum((0, 1))
        d["out"] = np.einsum("trh,trk->hk", both, d_score)
        d_both = d_score @ w["out"].T
        size = len(w["f_h"])
        for k, s in enumerate("fb"):
            dh, dc = np.zeros((rows, size), np.float32), np.zeros((rows, size), np.float32)
            d_table = np.zeros((SYMBOLS, 4 * size), np.float32)
            for t, h, c, i, f, o, n, c2 in reversed(passes[s][1]):
                m = mask[t][:, None]
                dh = dh + d_both[t][:, k * size : (k + 1) * size]
                live, tanh = np.where(m, dh, 0), np.tanh(c2)
                dc2 = np.where(m, dc, 0) + live * o * (1 - tanh * tanh)
                dz = np.concatenate((dc2 * n * i * (1 - i), dc2 * c * f * (1 - f), live * tanh * o * (1 - o), dc2 * i * (1 - n * n)), axis=1)
                np.add.at(d_table, x[t], dz)
                d[f"{s}_h"] += h.T @ dz
                dc = np.where(m, dc2 * f, dc)
                dh = np.where(m, 0, dh) + dz @ w[f"{s}_h"].T
            d["embed"] += d_table @ w[f"{s}_x"].T
            d[f"{s}_x"] += w["embed"].T @ d_table
            d[f"{s}_b"] += d_table.sum(0)
        return loss / rows, {k: v / rows for k, v in d.items()}


def _logsum(x, axis):
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def crf_loss(score, mask, tags, move):
    """Forward-backward over (time, row, tag): loss, gradients of scores and transitions. Rows begin at time 0."""
    steps, rows, k = score.shape
    alpha, beta = np.empty(score.shape), np.zeros(score.shape)
    alpha[0] = score[0]
    for t in range(1, steps):
        new = _logsum(alpha[t - 1][:, :, None] + move, 1) + score[t]
        alpha[t] = np.where(mask[t][:, None], new, alpha[t - 1])
    for t in range(steps - 2, -1, -1):
        new = _logsum(move[None] + (score[t + 1] + beta[t + 1])[:, None, :], 2)
        beta[t] = np.where(mask[t + 1][:, None], new, beta[t + 1])
    total = _logsum(alpha[-1], 1)
    at = np.arange(rows)
    d_score = np.exp(alpha + beta - total[None, :, None]) * mask[:, :, None]
    gold = np.zeros(rows)
    d_move = np.zeros((k, k))
    for t in range(steps):
        m = mask[t]
        gold += np.where(m, score[t, at, tags[t]], 0)
        d_score[t, at, tags[t]] -= m
        if t:
            pair = alpha[t - 1][:, :, None] + move + (score[t] + beta[t])[:, None, :] - total[:, None, None]
            d_move += (np.exp(pair) * m[:, None, None]).sum(0)
            gold += np.where(m, move[tags[t - 1], tags[t]], 0)
            np.subtract.at(d_move, (tags[t - 1][m], tags[t][m]), 1)
    return float((total - gold).sum()), d_score.astype(np.float32), d_move.astype(np.float32)


def viterbi(score: np.ndarray, lengths: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Best tags (time, row) of scores (time, row, tag); a row ends after its length."""
    steps, rows, _ = score.shape
    back = np.zeros(score.shape, np.int8)
    best = score[0].copy()
    at = np.arange(rows)
    for t in range(1, steps):
        ways = best[:, :, None] + move
        back[t] = ways.argmax(1)
        live = (t < lengths)[:, None]
        best = np.where(live, ways.max(1) + score[t], best)
    tags = np.zeros((steps, rows), np.int64)
    now = best.argmax(1)
    for t in range(steps - 1, -1, -1):
        tags[t] = np.where(t < lengths, now, 0)
        now = np.where((t < lengths) & (t > 0), back[t, at, now], now)
    return tags


def train_tagger(examples: list[tuple[np.ndarray, np.ndarray]], *, steps: int = 240, batch: int = 48, rate: float = 0.02, seed: int = 11) -> Tagger:
    """Adam on windows (symbols, tags) drawn in a fixed random order."""
    tagger, rng = Tagger.fresh(), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in tagger.w.items()}
    second = {k: np.zeros_like(v) for k, v in tagger.w.items()}
    for step in range(1, steps + 1 if examples else 0):
        part = [examples[i] for i in rng.integers(0, len(examples), batch)]
        x, mask, tags = pad([p[0] for p in part]), pad([np.ones(len(p[0]), bool) for p in part]), pad([p[1] for p in part])
        _, d = tagger.gradient(x, mask, tags)
        norm = np.sqrt(sum(float((g * g).sum()) for g in d.values()))
        pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in d.items():
            g = g * min(1.0, 5 / (norm + 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            tagger.w[k] = (tagger.w[k] - pace * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return tagger


def pad(rows: list[np.ndarray]) -> np.ndarray:
    """(time, row) from sequences of different lengths."""
    out = np.zeros((max(map(len, rows)), len(rows)), rows[0].dtype)
    for i, r in enumerate(rows):
        out[: len(r), i] = r
    return out


#: Weight of a character within its window: highest in the middle, where context is on both sides.
_CENTRE = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)


def decode_regions(tagger: Tagger, parts: list[str], cells: int = 1 << 16) -> list[list[tuple[str, int, int]]]:
    """Spans of each region. Scores of overlapping windows are averaged, weighted towards their middles, and
    one path is decoded over the whole region."""
    symbols = [letters(p) for p in parts]
    work = sorted(((i, s, e) for i, p in enumerate(parts) for s, e in windows(len(p))), key=lambda w: w[2] - w[1])
    scores = [np.zeros((len(p), TAGS), np.float32) for p in parts]
    weights = [np.zeros((len(p), 1), np.float32) for p in parts]
    per = max(1, cells // WINDOW)
    for start in range(0, len(work), per):
        group = work[start : start + per]
        x = pad([symbols[i][s:e] for i, s, e in group])
        out = tagger.emissions(x, x > 0)
        for r, (i, s, e) in enumerate(group):
            centre = _CENTRE[: e - s, None] if e - s == WINDOW else np.ones((e - s, 1), np.float32)
            scores[i][s:e] += out[: e - s, r] * centre
            weights[i][s:e] += centre
    found: list[list] = [[] for _ in parts]
    order = sorted(range(len(parts)), key=lambda i: len(parts[i]))
    at = 0
    while at < len(order):
        group = [order[at]]
        while at + len(group) < len(order) and len(parts[order[at + len(group)]]) * (len(group) + 1) <= cells:
            group.append(order[at + len(group)])
        at += len(group)
        lengths = np.array([len(parts[i]) for i in group])
        block = np.zeros((lengths.max(), len(group), TAGS), np.float32)
        for r, i in enumerate(group):
            block[: len(parts[i]), r] = scores[i] / weights[i]
        tags = viterbi(block, lengths, tagger.w["move"])
        for r, i in enumerate(group):
            found[i] = tag_spans(tags[: lengths[r], r])
    return found


def tag_spans(tags: np.ndarray) -> list[tuple[str, int, int]]:
    """Spans that begin with a first tag and go on with later tags of its kind."""
    out, start, kind = [], None, 0
    for t in [*np.flatnonzero(tags).tolist(), len(tags)]:
        tag = int(tags[t]) if t < len(tags) else 0
        if start is not None and not (t == end and tag and tag % 2 == 0 and (tag - 1) // 2 == kind):
            out.append((KINDS[kind], start, end))
            start = None
        if tag % 2:
            start, kind = t, (tag - 1) // 2
        end = t + 1
    return out


#: Digits that a span of each kind has at least and at most; an email needs its @.
DIGITS = {"ip": (4, 12), "card": (12, 19), "phone": (7, 15)}


def plausible(kind: str, text: str) -> bool:
    if kind == "email":
        return text.count("@") == 1 and 0 < text.index("@") < len(text) - 1
    low, high = DIGITS[kind]
    return low <= len(_digits(text)) <= high


class Overlaps:
    """Spans by start, to find those that meet a range without looking at all of them."""

    def __init__(self, spans: list[tuple[str, int, int]]):
        self.spans = spans
        self.starts = [s[1] for s in spans]
        self.reach = list(accumulate((s[2] for s in spans), max))

    def between(self, low: int, high: int) -> list[tuple[str, int, int]]:
        first = bisect_right(self.reach, low)  # all spans before it end by then
        return [s for s in self.spans[first : bisect_left(self.starts, high)] if s[2] > low]


def _examples(batches):
    """Windows of regions with tags of the base spans, as bytes."""
    for batch in batches:
        symbols, tags, rank = [], [], []
        for text in batch.column("text").to_pylist():
            if not TRIGGER.search(text):
                continue
            spans = Overlaps(base_spans(text))
            for low, high in regions(text):
                for s, e in windows(high - low):
                    part = text[low + s : low + e]
                    own = spans.between(low + s, low + e)
                    symbols.append(part)
                    tags.append(tag_sequence(len(part), own, low + s).astype(np.int8).tobytes())
                    rank.append(len({k for k, *_ in own}))
        yield pa.RecordBatch.from_arrays(
            [pa.array(symbols, pa.string()), pa.array(tags, pa.binary()), pa.array(rank, pa.int64())], names=["part", "tags", "kinds"]
        )


def fit_tagger(docs: DataFrame, text_col: str = "text", *, max_windows: int = 3_000) -> Tagger:
    """Train on at most ``max_windows`` distinct windows of the documents, chosen by a hash of their text.

    Labels are the spans of the fixed patterns. Training is a few seconds of numpy on the driver.
    """
    ship_package(docs.sparkSession)
    texts = docs.select(F.coalesce(text_col, F.lit("")).alias("text")).where(F.col("text").rlike("[0-9@]"))
    made = texts.mapInArrow(_examples, "part string, tags binary, kinds long").distinct()
    rows = made.orderBy(F.xxhash64("part"), "part", "tags").limit(max_windows).collect()
    return train_tagger([(letters(r.part), np.frombuffer(r.tags, np.int8).astype(np.int64)) for r in rows if r.part])


def find_pii(texts: list[str], tagger: Tagger) -> list[list[tuple]]:
    """Spans (kind, start, end, base) of each text by start, then kind: all base spans, and those of the
    network that overlap none."""
    base = [Overlaps(base_spans(t)) for t in texts]
    out = [[(*s, True) for s in b.spans] for b in base]
    places = [(i, a, b) for i, t in enumerate(texts) for a, b in regions(t)]
    for (i, a, _), spans in zip(places, decode_regions(tagger, [texts[i][a:b] for i, a, b in places])):
        for kind, s, e in spans:
            if not base[i].between(a + s, a + e) and plausible(kind, texts[i][a + s : a + e]):
                out[i].append((kind, a + s, a + e, False))
    return [sorted(s, key=lambda x: (x[1], KINDS.index(x[0]), x[2])) for s in out]


def scan_pii(docs: DataFrame, tagger: Tagger, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Personal data in every whole text: ``id_col`` and ``spans`` (``kind``, ``start``, ``end`` in code points, end
    exclusive, ``base``), by start, then email, ip, card, phone.

    Null counts as empty. Each row stands alone, whatever its id. Texts of any length are read whole:
    every range around a digit or @, without which none of these kinds can be, goes through the
    network in overlapping windows.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        fields = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                found = find_pii(part.column("text").to_pylist(), tagger)
                spans = pa.array([[dict(zip(("kind", "start", "end", "base"), s)) for s in f] for f in found], fields)
                yield pa.RecordBatch.from_arrays([part.column("id"), spans], names=["id", "spans"])

    return rows.mapInArrow(run, f"id {kind}, spans {SPANS}").withColumnRenamed("id", id_col)
