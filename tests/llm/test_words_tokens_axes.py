"""Spelling variants, directly addressable ids and whitening against brute force."""

import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

from foretell.llm import token_store, variants, whitening


def plain_words(rows, least=7, spoil=31):
    found = Counter()
    for doc, text in rows:
        for run in regex.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % spoil == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                found[run] += 1
    return found


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(rows, least_count=2, ratio=10):
    words = {w: n for w, n in plain_words(rows).items() if n >= least_count}
    form, near = {}, {}
    for w, n in words.items():
        near[w] = [v for v in words if one_edit(v, w)]
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        if best and words[best] >= ratio * n:
            form[w] = best
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return out


def spelling_rows(seed=5):
    rng = random.Random(seed)
    base = ["documents", "elephant", "Générale", "ÀÉÎÕÜßÿ", "aaaaaaaa", "abababab", "letters", "international", "x" * 70]
    rows = []
    for k in range(60):
        words = []
        for _ in range(60):
            w = rng.choice(base)
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", "z", "é", w[at] * 2, "a"]) + w[at + rng.randrange(2) :]
            if rng.random() < 0.06:
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice("xy") + w[at:]
            words.append(w.upper() if rng.random() < 0.2 else w)
        rows.append((k, rng.choice([" ", "-", "1", "\n"]).join(words)))
    rows += [(None, "letterz letterz lettert"), (3, "letters " * 400), (3, "letters " * 400), (70, None), (71, ""), (72, "short ones 12 here"), (73, "q" * 5000), (74, "q" * 5000)]
    return rows + [(81, "chainsaw " * 300 + "chainsav " * 20 + "chainsv chainsv")]


@pytest.mark.parametrize("tile, levels", [(1 << 15, None), (3, 1), (5, 3), (1 << 15, 8)])
def test_spelling_variants_are_brute_force(spark, frame, monkeypatch, tile, levels):
    rows = spelling_rows()
    docs = frame(rows, "doc_id long, text string")
    monkeypatch.setattr(variants, "TILE_WORDS", tile)
    want = plain_variants(rows)
    assert any(root not in (w, form) for w, form, root, *_ in want) and len(want) > 200
    if levels is None:
        got = variants.spelling_variants(docs)
    else:
        words = spark.createDataFrame([(w, n) for w, n in plain_words(rows).items() if n >= 2], "word string, n long")
        got = variants.variant_forms(words, levels=levels)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_leaves_and_blocks_of_any_size(spark, monkeypatch):
    monkeypatch.setattr(variants, "LEAF_WORDS", 1)
    monkeypatch.setattr(variants, "CELLS", 40)
    rows = spelling_rows(8)[:12]
    words = {w: n for w, n in plain_words(rows).items() if n >= 2}
    got = variants.variant_forms(spark.createDataFrame(list(words.items()), "word string, n long"), ratio=2)
    assert {tuple(r) for r in got.collect()} == plain_variants(rows, ratio=2)


def test_no_words_no_rows(spark):
    assert variants.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert variants.spelling_variants(spark.createDataFrame([(1, "a b c"), (None, None)], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError):
        variants.variant_forms(spark.createDataFrame([], "word string, n long"), ratio=1)


def test_ties_take_the_smaller_form(spark):
    words = [("letters", 1), ("lettery", 50), ("letterx", 50), ("lettexs", 7), ("lettersé", 50)]
    got = {r.word: r for r in variants.variant_forms(spark.createDataFrame(words, "word string, n long")).collect()}
    assert got["letters"].form == "lettersé" and got["letters"].n_near == 4 and got["letterx"].form is None
    assert got["letterx"].n_near == 2 and got["lettersé"].root == "lettersé"


@pytest.mark.parametrize("widths", [(8, 8, 16), (16, 16), (32,), (8, 8, 8, 8)])
def test_any_id_of_a_file(widths):
    rng = np.random.default_rng(2)
    ids = np.concatenate((rng.integers(0, 300, 3000), rng.integers(0, 2**32, 700), [0, 2**32 - 1, 255, 256, 65535, 65536])).astype(np.uint32)
    rng.shuffle(ids)
    data = token_store.pack_ids(ids, pa.table({"id": ["a"], "stop": [len(ids)]}), widths)
    reads = []

    def read(n, at):
        reads.append(n)
        return data[at : at + n]

    file = token_store.IdFile(read)
    assert file.documents().to_pylist() == [{"id": "a", "stop": len(ids)}]
    reads.clear()
    assert [file[i] for i in range(len(ids))] == ids.tolist()
    assert max(reads) <= token_store.RANK_BITS // 8  # no run of ids is decoded for one of them
    for a, b in [(0, len(ids)), (5, 5), (0, 1), (511, 513), (100, 2999), (len(ids), len(ids))]:
        assert file.slice(a, b).tolist() == ids[a:b].tolist()
    for bad in (-1, len(ids)):
        with pytest.raises(IndexError):
            file[bad]
    empty = token_store.pack_ids(ids[:0], pa.table({"id": ["a"], "stop": [0]}), widths)
    assert token_store.IdFile(lambda n, at: empty[at : at + n]).slice(0, 0).tolist() == []
    with pytest.raises(ValueError):
        token_store.pack_ids(ids, pa.table({"id": ["a"]}), (8, 8))
    with pytest.raises(ValueError):
        token_store.IdFile(lambda n, at: b"x" * n)


def test_parts_of_a_text_encode_alike(text, monkeypatch):
    monkeypatch.setattr(token_store, "CACHE_PARTS", 30)
    theirs = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(4)
    odd = ["".join(rng.choice("ab  \n\t1'!é\x85\x1c\u3000🙂") for _ in range(400)) for _ in range(20)]
    texts = [text(3, 900), *odd, "x" * 900, " " * 900, "a<|endoftext|> <|endoftext|> b" * 40, "", " a", "a ", "a  b", "a b\n c", "one two three", "one, two;\nthree's 'tis we'll\nfour.) five_ six<|endoftext|>\n<|end, x|> 7. é. ß!? don't'"]
    encoder = token_store.Encoder("byte_bpe_50k.json")
    for some in (texts, *[[t] for t in texts]):
        for whole, ids in zip(some, encoder.encode(some)):
            assert ids.tolist() == theirs.encode(whole, add_special_tokens=False).ids
    assert token_store.encode_texts(["", "a b"], "byte_bpe_50k.json", 7)[0].tolist() == [7]


@pytest.mark.parametrize("file_ids, end", [(1 << 24, 0), (40, 0), (40, None)])
def test_stored_ids_are_the_library_s(frame, text, monkeypatch, file_ids, end):
    monkeypatch.setattr(token_store, "READ_IDS", 30)
    theirs = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(k, text(k, 3 + 7 * (k % 5))) for k in range(40)]
    rows += [(5, text(5, 38)), (5, "another"), (5, "another"), (None, "no id"), (-3, None), (-2, ""), (900, "é🙂\x00 <|endoftext|>"), (901, text(9, 5000))]
    docs = frame(rows, "doc_id long, text string")
    got = token_store.stored_ids(docs, file_ids=file_ids, end_id=end, partitions=5).collect()
    tail = [] if end is None else [end]
    want = sorted((-10**9 if d is None else d, tuple(theirs.encode(t or "", add_special_tokens=False).ids + tail)) for d, t in rows)
    found = [(-10**9 if r.doc_id is None else r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got]
    assert sorted(found) == want
    total = 0
    for r in sorted(got, key=lambda r: (r.start, r.n_tokens)):  # in order of ids, without gaps
        assert r.start == total
        total += r.n_tokens
    by_start = [r.doc_id for r in sorted(got, key=lambda r: (r.start, r.n_tokens)) if r.n_tokens]
    assert by_start == sorted(by_start, key=lambda d: -10**9 if d is None else d)
    assert token_store.stored_ids(docs.limit(0)).count() == 0


def test_ids_of_any_type_name_documents(spark):
    docs = spark.createDataFrame([("b", "two"), ("a", "one"), (None, "none")], "name string, body string")
    got = token_store.stored_ids(docs, "name", "body").collect()
    assert [r.name for r in sorted(got, key=lambda r: r.start)] == [None, "a", "b"]


def plain_whitening(rows, top=4):
    """By fractions, one at a time."""
    good = [(i, [int(np.floor(256 * float(c))) for c in v]) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = {}
    for d in {len(x) for _, x in good if x}:
        fit = {tuple(x) for _, x in good if len(x) == d}
        n = len(fit)
        s = [sum(x[i] for x in fit) for i in range(d)]
        cov = np.array([[float(sum(Fraction(n * x[i] - s[i], n) * Fraction(n * x[j] - s[j], n) for x in fit) / n) for j in range(d)] for i in range(d)])
        values, vectors = np.linalg.eigh(cov)
        for i, x in good:
            if len(x) == d:
                y = np.array([float(Fraction(n * x[k] - s[k], n)) for k in range(d)])
                for c in range(min(top, d)):
                    e = values[d - 1 - c]
                    w = y @ vectors[:, d - 1 - c] / np.sqrt(e) if e > 1e-9 else None
                    out.setdefault((i, c + 1), []).append((n, sum((n * x[k] - s[k]) ** 2 for k in range(d)), w, e / np.trace(cov) if np.trace(cov) else None))
    return out


def check_whitening(got, want):
    found = {}
    for r in got:
        found.setdefault((r.vec_id, r.component), []).append(r)
    assert set(found) == set(want)
    signs = {}
    for key, rows in want.items():
        assert len(rows) == len(found[key])
        for r, (n, deviation, w, share) in zip(sorted(found[key], key=lambda r: (r.n, int(r.deviation))), sorted(rows, key=lambda t: t[:2])):
            assert r.n == n and int(r.deviation) == deviation
            assert (share is None and r.explained is None) or r.explained == pytest.approx(share, rel=1e-9, abs=1e-12)
            if w is None:
                assert r.whitened is None
                continue
            if abs(w) > 1e-6:
                assert signs.setdefault((n, r.component), np.sign(w * r.whitened)) == np.sign(w * r.whitened)
            assert abs(r.whitened) == pytest.approx(abs(w), rel=1e-7, abs=1e-9)
            assert r.identity_error < 1e-9


def test_whitening_is_brute_force(frame):
    rng = np.random.default_rng(3)
    mix = rng.normal(size=(6, 6)) * np.arange(1, 7)
    rows = [(k, (rng.normal(size=6) @ mix / 20).astype(np.float32).tolist()) for k in range(120)]
    rows += [(200 + k, rows[0][1]) for k in range(60)]  # copies count once in the fit
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (302, [float("nan")] + [0.0] * 5), (303, [float("inf")] + [0.0] * 5), (304, [])]
    rows += [(0, rows[1][1]), (None, rows[2][1]), (305, [-0.0] * 6)]
    docs = frame(rows, "vec_id long, embedding array<float>")
    got = whitening.whiten(docs)
    assert {"id", "key", "component", "whitened"} <= set(got.columns) and "embedding" not in got.columns
    check_whitening(got.collect(), plain_whitening(rows))


def test_whitening_of_several_lengths_and_flat_ones(spark):
    rng = np.random.default_rng(4)
    rows = [(k, rng.normal(size=3).tolist()) for k in range(30)] + [(100 + k, rng.normal(size=2).tolist()) for k in range(20)]
    rows += [(500, [0.25]), (501, [0.25])]  # no variance at all
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    check_whitening([r for r in got if r.vec_id < 500], {k: v for k, v in plain_whitening(rows).items() if k[0] < 500})
    assert [(r.component, r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in got if r.vec_id >= 500] == [(1, 1, 0, None, None, None)] * 2
    assert whitening.whiten(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_whitening_stays_exact_for_large_entries(spark):
    rng = np.random.default_rng(5)
    rows = [(k, (rng.normal(size=3) * [1e9, 1e12, 3e10]).tolist()) for k in range(25)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    check_whitening(got, plain_whitening(rows))
    rows += [(90, [1e300, -1e300, 0.0])]  # the nearest 64-bit numbers stand for what is beyond them
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).where("vec_id = 90").collect()
    assert [r.component for r in got] == [1, 2, 3] and got[0].deviation is None and got[0].n == 26


def test_squares_do_not_overflow():
    y = np.array([[(1 << 45) - 1, -(1 << 45)]] * whitening.BLOCK_ROWS)
    assert whitening._squares(y + y).tolist() == [len(y) * (2 * int(v)) ** 2 for v in y[0]]


def test_new_parts_are_encoded_together():
    """The library gets one text for many new parts, whatever stands in them; ids are those of each text by itself."""
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    given = []

    class Spy:
        def encode_batch_fast(self, texts, add_special_tokens):
            given.extend(texts)
            return library.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    encoder = token_store.Encoder("byte_bpe_50k.json")
    encoder.tokenizer = Spy()
    many = [" ".join(f"w{i}q{k}é" for k in range(100)) + f"\nline{i} it's Ġx (a),b" for i in range(20)]
    got = encoder.encode(many)
    assert len(given) < 40
    odd = ["", "\n", "a\t", "b\t c", "x <|endoftext|> y<|endoftext|>z", "<|endoftext|>\nq", "Ġ Ġx\nĠ", "n b o　", "\x1cf \x85g", "e\n\nf  g ", "Ġ"]
    got += encoder.encode(odd) + encoder.encode(odd[::-1])
    for text, ids in zip([*many, *odd, *odd[::-1]], got, strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text
