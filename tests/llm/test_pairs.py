"""Operators on pairs against brute force."""

import math
import random

import numpy as np
import pytest

from foretell.llm import decontaminate, ngram_join, vector_dedup
from foretell.llm.common import components, gram_hashes, word_hashes


def groups(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in links:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def expected(ids, links):
    """id, links, least id of the component, by row."""
    root = groups(len(ids), links)
    out = []
    for i, own in enumerate(ids):
        members = [ids[k] for k in range(len(ids)) if root[k] == root[i] and ids[k] is not None]
        low = min(members) if members else None
        out.append((own, sum(i in p for p in links), low, own == low))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_word_hashes_agree_across_texts():
    a, b = word_hashes("one two three two".encode()), word_hashes("... three, two! é".encode())
    assert a[1] == a[3] == b[1] and a[2] == b[0] and len(set(a.tolist())) == 3 and len(b) == 3
    assert len(gram_hashes(a, 2)) == 3 and len(gram_hashes(a, 9)) == 1 and len(word_hashes(b"")) == 0


def test_components_of_a_chain_a_star_and_nothing(spark):
    edges = [(i, i + 1) for i in range(20, 60)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {found[i] for i in range(20, 61)} == {20} and {found[i] for i in range(100, 140)} == {100} and 7 not in found
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def jaccard_links(texts, n=5, threshold=0.8):
    words = [(t or "").lower().split() for t in texts]
    sets = [{tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} for w in words]
    return [(i, j) for i in range(len(sets)) for j in range(i) if len(sets[i] & sets[j]) * 5 >= 4 * len(sets[i] | sets[j])]


def corpus(text):
    base = text(1, 120)
    out = [(1, base), (2, base.upper()), (3, f"  {base}\n"), (4, None), (5, ""), (6, " \t "), (7, "four short words here"), (8, "Four  short words here")]
    rng = random.Random(3)
    for k in range(40):  # near copies of one text, more than a tile
        words = base.split()
        for _ in range(rng.randrange(1, 4)):
            words[rng.randrange(len(words))] = f"edit{rng.randrange(9)}"
        out.append((10 + k, " ".join(words)))
    chain = text(2, 80).split()
    out += [(100 + k, " ".join(chain[k * 3 : k * 3 + 60])) for k in range(6)]
    out += [(200, text(4)), (200, text(4)), (200, text(5)), (None, text(6)), (None, text(6)), (201, text(6)), (300, text(9, 4000))]
    return out


def test_jaccard_join_is_brute_force(frame, text, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE_ROWS", 7)
    rows = corpus(text)
    got = ngram_join.jaccard_join(frame(rows, "doc_id long, text string"))
    assert got.columns == ["doc_id", "n_links", "class_id", "kept"]
    assert rows_of(got) == expected([r[0] for r in rows], jaccard_links([r[1] for r in rows]))


def test_jaccard_join_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.jaccard_join(empty).count() == 0


@pytest.mark.parametrize("recall", [0.9, 0.999, 0.999999])
def test_bands_reach_the_recall(recall):
    bands, rows = ngram_join.plan_bands(0.8, recall)
    assert bands * rows <= 128 and 1 - (1 - 0.8**rows) ** bands >= recall
    with pytest.raises(ValueError):
        ngram_join.plan_bands(0.1, 0.999999, 8)


def vectors():
    rng = np.random.default_rng(4)
    out, k = [], 0
    for label in (0, 1):
        base = rng.normal(size=(6, 12))
        for _ in range(70):
            v = base[rng.integers(6)] + rng.normal(size=12) * rng.choice([0.02, 0.2, 0.6])
            out.append((k, [float(np.float32(x)) for x in v], label))
            k += 1
    one = out[0][1]
    odd = [(900, one, 0), (900, one, 0), (901, one, None), (902, None, 0), (903, [], 0), (904, [0.0] * 12, 0), (905, one[:-1] + [None], 0),
           (906, one[:-1] + [math.nan], 0), (907, one[:-1] + [math.inf], 0), (908, one[:5], 0), (None, one, 0), (909, [-0.0, 1.0], 1), (910, [0.0, 2.0], 1)]
    return out + odd


def cosine_links(rows, threshold):
    def good(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    out = []
    for i, (_, v, a) in enumerate(rows):
        for j, (_, w, b) in enumerate(rows[:i]):
            if good(v, a) and good(w, b) and a == b and len(v) == len(w):
                x, y = np.array(v), np.array(w)
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= threshold:
                    out.append((i, j))
    return out


@pytest.mark.parametrize("threshold", [0.93, 0.6])
def test_vector_duplicates_are_brute_force(frame, monkeypatch, threshold):
    monkeypatch.setattr(vector_dedup, "TILE_ROWS", 16)
    monkeypatch.setattr(vector_dedup, "BLOCK_ROWS", 5)
    rows = vectors()
    links = cosine_links(rows, threshold)
    got = vector_dedup.vector_duplicates(frame(rows, "vec_id long, embedding array<float>, label int"), threshold=threshold)
    assert len(links) > 100 and got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert rows_of(got) == expected([r[0] for r in rows], links)


def test_vector_duplicates_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vector_dedup.vector_duplicates(empty).count() == 0


def smith_waterman(a, b):
    best, h = 0, [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            s = 2 if a[i - 1] == b[j - 1] else -1
            h[i][j] = max(0, h[i - 1][j - 1] + s, h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_alignment_is_smith_waterman():
    rng = np.random.default_rng(0)
    for _ in range(60):
        a, b = (rng.integers(0, 4, rng.integers(1, 14)).astype(np.uint64) for _ in "ab")
        score, start, end = decontaminate.align(a, b)
        assert score == smith_waterman(a.tolist(), b.tolist())
        assert score == 0 or smith_waterman(a.tolist(), b[start:end].tolist()) == score


def test_contamination(frame, text):
    items = [(k, text(1000 + k, 30)) for k in range(12)] + [(50, None), (51, "two words"), (0, text(77, 20)), (None, text(78, 20))]
    item = dict(items[1:12])
    edited = item[3].split()
    for k in (4, 11, 18, 25):
        edited[k] = "changed"
    del edited[8]
    docs = [
        (1, f"{text(1)} {item[1].upper()} {text(2)}"), (2, text(3)), (3, f"{text(4, 3000)} {' '.join(edited)}. {text(5)}"), (4, None), (5, ""),
        (6, " ".join(item[5].split()[:10]) + " " + text(6)), (7, item[7]), (7, text(8)), (8, f"{item[7]} {text(9)} {item[8]}"),
        (9, text(77, 20)), (None, f"{text(10)} {item[9]}"), (10, f"{text(11)} {text(78, 20)}"), *[(100 + k, f"{text(k + 500)} {item[2]}") for k in range(30)],
    ]
    got = decontaminate.contaminated(frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string"))
    pairs = {(r.doc_id, r.item_id): r for r in got.collect()}
    wanted = {(1, 1), (3, 3), (7, 7), (8, 7), (8, 8), (9, 0), (None, 9), (10, None), *((100 + k, 2) for k in range(30))}
    assert set(pairs) == wanted and got.count() == len(wanted)
    assert pairs[1, 1].score == 1 and pairs[1, 1].passage == item[1] and pairs[1, 1].last_word - pairs[1, 1].first_word == 30
    assert 0.6 < pairs[3, 3].score < 1


def test_contamination_of_nothing(spark):
    docs, items = (spark.createDataFrame([], f"{c} long, text string") for c in ("doc_id", "item_id"))
    some = spark.createDataFrame([(1, "a b c d e")], "doc_id long, text string")
    assert decontaminate.contaminated(docs, items).count() == 0 and decontaminate.contaminated(some, items).count() == 0
