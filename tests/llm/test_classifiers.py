"""Nearest examples and FTRL against their definitions, and the pipeline against its stages in plain Python."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from foretell.llm import quality, toxicity
from foretell.llm.labels import fold, labelled_sample
from tests.llm.test_pairs import groups, jaccard_links


def test_fold_is_crc32(spark):
    ids = [0, 7, -3, 123456789012, None]
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", fold(F.col("doc_id"), 4).alias("f")).collect()
    assert {r.doc_id: r.f for r in rows} == {i: zlib.crc32(b"" if i is None else str(i).encode()) % 4 for i in ids}


def test_search_is_exact():
    rng = np.random.default_rng(2)
    vectors = []
    for _ in range(500):
        terms = np.sort(rng.choice(40, rng.integers(1, 6), replace=False))
        w = rng.integers(1, 4, len(terms)).astype(float)
        vectors.append((terms, w / np.sqrt(w @ w)))
    index = toxicity.BlockMaxIndex(vectors, 40)
    dense = np.zeros((500, 40))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    for i in range(60):
        cosine = dense @ dense[i]
        found, scores = index.search(*vectors[i], 7)
        least = np.sort(cosine)[-7]
        wanted = set(np.flatnonzero((cosine > 0) & (cosine >= least - 1e-9)).tolist())
        assert set(found.tolist()) == wanted and np.allclose(scores, cosine[found])
    assert len(toxicity.BlockMaxIndex([], 3).search(np.array([1]), np.array([1.0]), 5)[0]) == 0


def test_isotonic_rises():
    least, rate = toxicity.isotonic(np.array([0.1, 0.1, 0.2, 0.5, 0.9, 0.9]), np.array([0, 1, 0, 1, 1, 1.0]))
    assert (np.diff(rate) >= 0).all() and least[0] == 0.1 and rate[-1] > 0.8


def toxic_rows(text, n=400):
    rng = random.Random(9)
    rows, labels = [], []
    for k in range(n):
        words = text(k, 40).split()
        bad = k % 5 == 0
        for _ in range(3 * bad):
            words.insert(rng.randrange(len(words)), rng.choice(["vile", "grim", "foul"]))
        rows.append((k, " ".join(words)))
        labels.append((k, int(bad)))
    return rows, labels


def test_toxicity(frame, spark, text):
    rows, labels = toxic_rows(text)
    extra = [(900, None), (901, ""), (None, "so vile and grim"), (902, "VILE, vile; grim!"), (902, "twice"), (903, text(77, 5000))]
    docs = frame([*rows, *extra], "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (None, 1), (5, None), (5, 0), (5, 1), (999, 1)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, marks, use=fold(F.col("doc_id"), 4) != 2)
    assert set(model.terms) == {"vile", "grim", "foul"}
    got = toxicity.score_toxicity(docs, model)
    assert got.columns == [*[c for c in docs.columns if c != "score"], "score", "terms", "evidence"]
    out = got.collect()
    assert len(out) == len(rows) + len(extra)
    for r in out:
        assert 0 <= r.score <= 1 and (r.score >= 0.3) == any(w in (r.text or "").lower() for w in ("vile", "grim", "foul"))
        assert bool(r.evidence) == bool(r.terms)
    clean = toxicity.keep_clean(docs, model, 0.3)
    assert clean.columns == docs.columns and clean.count() == sum(r.score < 0.3 for r in out)
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("marks", [[], [(1, 0), (2, 0)], [(1, 1), (2, 1)]])
def test_toxicity_with_few_labels(spark, marks):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model = toxicity.fit_toxicity(docs, spark.createDataFrame(marks, "doc_id long, toxic int"))
    assert all(0 <= r.score <= 1 for r in toxicity.score_toxicity(docs, model).collect())


def test_samples_are_bounded(spark):
    docs = spark.createDataFrame([(k % 50, f"text {k}") for k in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(k % 60, k % 2) for k in range(120)], "doc_id long, quality int")
    got = labelled_sample(docs, labels, "doc_id", "text", "quality", None, 20).collect()
    assert len(got) <= 20 and len({r.id for r in got}) == len(got)


def test_ftrl_is_its_definition():
    rng, alpha, beta, l1, l2 = np.random.default_rng(1), 0.5, 1.0, 0.05, 0.1
    model, z, n = quality.Ftrl(5, alpha, beta, l1, l2), [0.0] * 5, [0.0] * 5

    def weight(i):
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - np.sign(z[i]) * l1) / ((beta + n[i] ** 0.5) / alpha + l2)

    for _ in range(40):
        at, x, y = np.sort(rng.choice(5, 3, replace=False)), rng.normal(size=3), float(rng.integers(2))
        w = [weight(i) for i in at]
        p = 1 / (1 + np.exp(-sum(a * b for a, b in zip(w, x))))
        for k, i in enumerate(at):
            g = (p - y) * x[k]
            sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / alpha
            z[i] += g - sigma * w[k]
            n[i] += g * g
        model.update(at, x, y)
    assert np.allclose(model.weights(), [weight(i) for i in range(5)])


def test_quality(frame, spark, text):
    rows = [(k, " ".join(f"{w}!!" for w in text(k).upper().split()) if k % 4 == 0 else text(k)) for k in range(300)]
    extra = [(900, None), (901, ""), (None, "x"), (1, text(5, 4000))]
    docs = frame([*rows, *extra], "doc_id long, text string")
    marks = spark.createDataFrame([(k, int(k % 4 > 0)) for k in range(300)] + [(None, 1), (7, None)], "doc_id long, quality int")
    model = quality.fit_quality(docs, marks, use=fold(F.col("doc_id"), 3) != 1)
    out = quality.score_quality(docs, model).collect()
    assert len(out) == len(rows) + len(extra) and all(0 <= r.score <= 1 for r in out)
    by = {r.doc_id: r.score for r in out if r.doc_id not in (1, None)}
    held = [k for k in range(2, 300) if zlib.crc32(str(k).encode()) % 3 == 1]
    assert np.mean([(by[k] >= 0.5) == (k % 4 > 0) for k in held]) > 0.97
    again = quality.fit_quality(docs.repartition(7), marks.repartition(3), use=fold(F.col("doc_id"), 3) != 1)
    assert (again.weights == model.weights).all() and again.bias == model.bias  # however the rows are dealt
    nothing = quality.fit_quality(docs, marks.limit(0))
    assert {r.score for r in quality.score_quality(docs, nothing).collect()} == {0.5}


def test_pipeline_is_its_stages(spark, tmp_path, text):
    rows, labels = toxic_rows(text, 200)
    items = [(k, text(5000 + k, 20)) for k in range(3)]
    texts = dict(rows)
    texts |= {300: texts[1], 301: texts[2] + " more", 302: f"{text(6000)} {items[1][1]} {text(6001)}", 303: None, 304: "",
              305: f"{text(6002)} password=hunter2222 {text(6003)}", 306: "short", 307: "SHORT"}
    docs = [(k, t, "en", f"src{k % 3}", len(t or "")) for k, t in texts.items()]
    for name, data, schema in (
        ("documents", docs, "doc_id long, text string, lang string, source string, n_chars long"),
        ("labels", labels, "doc_id long, toxic int"), ("benchmark", items, "item_id long, text string"),
    ):
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    kept = {k: t for k, t in texts.items() if not any(w in (t or "") for w in ("vile", "grim", "foul"))}
    ids = sorted(kept)
    root = groups(len(ids), jaccard_links([kept[i] for i in ids]))
    kept = {i: kept[i] for n, i in enumerate(ids) if root[n] == n}
    kept = {k: t for k, t in kept.items() if not any(item in (t or "") for _, item in items)}
    kept = {k: (t or "").replace("password=hunter2222", "[SECRET]") for k, t in kept.items()}
    from foretell.llm import bpe
    import public_tokenizers

    tokenizer = bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
    got = entry.queries()["pipeline"](spark, str(tmp_path)).collect()
    assert {r.doc_id: tokenizer.decode(bytes(r.ids)) for r in got} == kept and len(got) == len(kept)
    assert 300 not in kept and 302 not in kept and 306 in kept and 307 not in kept and "[SECRET]" in kept[305]


def test_stages_keep_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), sf_dir).count() == 0


def test_stages_with_repeated_rows_nulls_and_clashing_columns(spark, sf_dir, text):
    names = ("row", "leaked", "spans", "redacted", "id", "key", "n_links", "_low", "score", "ids", "decoded")
    rows = [(1, text(1)), (1, text(1)), (1, text(2)), (2, text(2)), (None, text(2)), (None, text(3)), (3, None), (3, None), (4, ""), (5, "api_key=abcdefgh x")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), *names) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names))
    stages = dict(corpus_pipeline.STAGES)
    out = {n: stages[n](spark, docs, sf_dir).collect() for n in stages}
    for name in ("toxicity", "decontamination", "secrets"):
        assert len(out[name]) == len(rows) and out[name][0].asDict().keys() == docs.first().asDict().keys()
    assert sorted(((r.doc_id, r.text) for r in out["ngram_jaccard"]), key=str) == sorted([(1, text(1)), (1, text(2)), (None, text(3)), (3, None), (5, rows[-1][1])], key=str)
    secret = [r for r in out["secrets"] if r.doc_id == 5][0]
    assert (secret.text, secret.n_chars, secret.spans, secret.redacted) == ("[SECRET] x", 10, "spans", "redacted")
    assert sorted(r.n_tokens for r in out["bpe"])[:3] == [0, 0, 0]


def test_near_copies_of_toxic_examples_without_a_common_toxic_word(spark, text):
    rows, labels = toxic_rows(text)
    rows += [(1000 + k, text(7000 + k, 60)) for k in range(40)]  # toxic by words of their own
    labels += [(1000 + k, 1) for k in range(40)]
    copies = [(2000 + k, " ".join([*text(7000 + k, 60).split()[:-5], *text(8000 + k, 5).split()])) for k in range(40)]
    docs = spark.createDataFrame([*rows, *copies], "doc_id long, text string")
    model = toxicity.fit_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    used = set(model.example)
    out = {r.doc_id: r for r in toxicity.score_toxicity(docs, model).collect()}
    near = [r for k, r in out.items() if k >= 2000 and k - 1000 in used]
    assert len(near) > 20 and all(r.score >= 0.3 and r.terms and r.evidence[0].example == str(r.doc_id - 1000) for r in near)
    clean = [out[k].score for k in range(400) if k % 5]
    assert np.mean([s < 0.3 for s in clean]) > 0.97


def test_toxicity_is_brute_force(spark, text):
    rows, labels = toxic_rows(text, 240)
    rows += [(1000 + k, "") for k in range(60)] + [(2000, rows[1][1]), (2001, rows[1][1]), (2002, text(91, 30)), (2003, text(91, 30)), (3000, "nothing_known_here")]
    labels += [(1000 + k, int(k < 50)) for k in range(60)] + [(2000, 1), (2001, 1), (2002, 0), (2003, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), k=6)
    out = {r.doc_id: r for r in toxicity.score_toxicity(docs, model).collect()}
    assert out[1000].score == out[3000].score == pytest.approx(50 / 60) and not out[1000].evidence

    texts, truth = dict(rows), dict(labels)
    words = {i: Counter(re.findall(r"\w+", t.lower())) for i, t in texts.items()}
    known = toxicity.load(model.path)
    seen = Counter(w for c in words.values() for w in c)
    weight = {}
    for w in set().union(*(words[i] for i in model.example)):
        h = toxicity.Words(w).hashes[0]
        at = int(np.searchsorted(known.keys, h))
        assert known.keys[at] == h
        weight[w] = float(known.idf[at])
        plain = math.log((1 + len(rows)) / (1 + seen[w])) + 1
        assert weight[w] == pytest.approx(plain) if w not in model.terms else weight[w] > plain

    def vector(i):
        v = {w: (1 + math.log(n)) * weight[w] for w, n in words[i].items() if w in weight}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / size for w, x in v.items()}

    votes = {}
    for i, label in truth.items():
        key = frozenset(words[i].items())
        votes.setdefault(key, [0, 0])[label] += 1
    assert votes[frozenset(words[2002].items())] == [1, 1]
    vectors = {i: vector(i) for i in model.example}
    for i, row in out.items():
        own = vector(i) if any(w in weight for w in words[i]) else {}
        near = sorted(((sum(x * v.get(w, 0) for w, x in own.items()), e) for e, v in vectors.items()), reverse=True)
        near = [(c, e) for c, e in near if c > 0]
        if not near:
            assert row.score == model.unknown
            continue
        near = [(c, e) for c, e in near if c >= near[min(6, len(near)) - 1][0] - 1e-9]
        assert [x.cosine for x in row.evidence] == pytest.approx([c for c, _ in near[:3]])
        share = {e: votes[frozenset(words[e].items())] for _, e in near}
        pull = [(c * c / (1.01 - min(c, 1) ** 2), share[e][1] / sum(share[e])) for c, e in near]
        raw = (sum(p * s for p, s in pull) + model.base) / (sum(p for p, _ in pull) + 1)
        assert row.score == pytest.approx(model.calibrated(raw), abs=1e-9)
        assert all((x.votes_0, x.votes_1) == tuple(votes[frozenset(words[int(x.example)].items())]) for x in row.evidence)


@pytest.mark.parametrize("k, dense, block", [(1, 8, 4), (15, 0, 64), (40, 16, 8), (5, 1000, 3)])
def test_block_search_is_exact_for_any_layout(monkeypatch, k, dense, block):
    monkeypatch.setattr(toxicity, "DENSE_TERMS", dense)
    monkeypatch.setattr(toxicity, "BLOCK", block)
    monkeypatch.setattr(toxicity, "POSTINGS", 50)
    rng = np.random.default_rng(k)
    full = (rng.random((300, 60)) < rng.random(60) ** 3) * rng.random((300, 60))
    full[:40] = full[40]  # ties
    full = full[full.any(axis=1)]
    full /= np.linalg.norm(full, axis=1, keepdims=True)
    vectors = [(np.flatnonzero(v), v[v > 0]) for v in full]
    index = toxicity.BlockMaxIndex(vectors, 60)
    queries = [*vectors[::7], (np.array([59]), np.array([1.0])), (np.array([], int), np.array([]))]
    for (terms, w), (found, scores) in zip(queries, index.search_many(queries, k)):
        cosine = full[:, terms] @ w
        least = np.sort(cosine)[-k]
        assert set(found.tolist()) == set(np.flatnonzero((cosine > 0) & (cosine >= least - 1e-9)).tolist()) and np.allclose(scores, cosine[found])


def test_arrays_of_a_file(tmp_path):
    arrays = {"a": np.arange(7, dtype=np.int32), "b": np.zeros((0, 3), np.float32), "c": np.random.default_rng(1).random((5, 4))}
    toxicity.write_arrays(arrays, f"file://{tmp_path}/x")
    got = toxicity.read_arrays(f"{tmp_path}/x")
    assert list(got) == list(arrays) and all(got[n].dtype == x.dtype and np.array_equal(got[n], x) for n, x in arrays.items())


def test_vectors_of_examples_reach_the_driver_in_parts(spark, text, monkeypatch):
    some, words = random.Random(5), text(1, 600).split()
    rows, labels = [(k, " ".join(some.sample(words, 300))) for k in range(300)], [(k, k % 2) for k in range(300)]
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    whole = toxicity.load(toxicity.fit_toxicity(docs, marks).path).index.arrays
    sizes, kind = [], type(docs)
    collect = kind.toArrow
    monkeypatch.setattr(kind, "toArrow", lambda df: sizes.append((t := collect(df)).nbytes) or t)
    monkeypatch.setattr(toxicity, "SENT", 50)
    monkeypatch.setattr(toxicity, "FILLED", 7)
    parts = toxicity.load(toxicity.fit_toxicity(docs, marks).path).index.arrays
    assert all(np.array_equal(parts[n], x) for n, x in whole.items())
    assert sizes and max(sizes) < (whole["term"].nbytes + whole["weight"].nbytes) / 3
