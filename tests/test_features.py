import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import xxhash
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from foretell.features import columns as C
from foretell.features import fit as fit_module
from foretell.features import text as TX
from foretell.features import topics as TP
from foretell.features.fit import block_features, fit_features, one_hot_frame
from foretell.features.spec import FEATURE_SETS, FeatureSpec


@pytest.fixture(scope="module")
def numbers(spark):
    rows = [(i, v, "Passed") for i, v in enumerate([1.0, None, 2.0, 4.0, 10.0])]
    return spark.createDataFrame(rows, "bill_id long, x double, status_new string")


def values(df, name):
    return [r[name] for r in df.orderBy("bill_id").collect()]


@pytest.mark.parametrize("op, filled", [("impute_mean", 4.25), ("impute_median", 3.0), ("impute_fixed", 0.0)])
def test_imputation(numbers, op, filled):
    fitted = fit_features(numbers, FeatureSpec({"x": {op: []}}))
    assert values(fitted.columns(numbers), "x") == [1.0, filled, 2.0, 4.0, 10.0]
    assert fitted.applied["x"] == [("impute_fixed", filled)]


@pytest.mark.parametrize("op", ["impute_mean", "impute_median"])
def test_all_missing_column_gets_zero(spark, op):
    df = spark.createDataFrame([(1, None, "Passed")], "bill_id long, x double, status_new string")
    assert values(fit_features(df, FeatureSpec({"x": {op: [], "normalize": []}})).columns(df), "x") == [0.0]


def test_normalize_is_gated_and_refitted_values_are_reused(spark):
    def frame(xs):
        return spark.createDataFrame([(i, x, "Passed") for i, x in enumerate(xs)], "bill_id long, x double, status_new string")

    spec = FeatureSpec({"x": {"normalize": []}})
    fitted = fit_features(frame([0.0, 5.0, 20.0]), spec)
    assert values(fitted.columns(frame([0.0, 5.0, 20.0, 30.0])), "x") == [0.0, 0.25, 1.0, 1.5]
    small = fit_features(frame([0.0, 5.0, 10.0]), spec)
    assert values(small.columns(frame([7.0])), "x") == [7.0]


def test_fill_value_extends_range_only_when_something_is_missing(spark):
    rows = [(1, 50.0, "Passed"), (2, None, "Passed"), (3, 100.0, "Passed")]
    df = spark.createDataFrame(rows, "bill_id long, x double, status_new string")
    fitted = fit_features(df, FeatureSpec({"x": {"impute_fixed": 0, "normalize": []}}))
    assert values(fitted.columns(df), "x") == [0.5, 0.0, 1.0]


def test_one_hot_ints_unknown_is_zero(spark):
    df = spark.createDataFrame([(i, v, "Passed") for i, v in enumerate([0, 2, 5, None])], "bill_id long, p int, status_new string")
    fitted = fit_features(df, FeatureSpec({"p": {"one_hot": 3}}))
    rows = [tuple(r)[2:] for r in fitted.columns(df).orderBy("bill_id").collect()]
    assert rows == [(1.0, 0.0, 0.0), (0.0, 0.0, 1.0), (0.0, 0.0, 0.0), (0.0, 0.0, 0.0)]
    assert fitted.feature_names() == ["p_0", "p_1", "p_2"]


def test_categories_come_from_training_rows(spark):
    train = spark.createDataFrame([(1, "b", "Passed"), (2, "a", "Passed"), (3, None, "Passed")], "bill_id long, c string, status_new string")
    later = spark.createDataFrame([(4, "z", "Failed")], train.schema)
    fitted = fit_features(train, FeatureSpec({"c": {"impute_fixed": "m", "one_hot": []}}))
    assert fitted.feature_names() == ["c_a", "c_b", "c_m"]
    assert tuple(fitted.columns(later).first())[2:] == (0.0, 0.0, 0.0)


def test_too_many_categories_is_loud_and_long_form_works(spark, monkeypatch):
    monkeypatch.setattr(fit_module, "MAX_CATEGORIES", 3)
    df = spark.range(10).select(F.col("id").alias("bill_id"), F.concat(F.lit("c"), "id").alias("c"), F.lit("Passed").alias("status_new"))
    with pytest.raises(ValueError, match="one_hot_long"):
        fit_features(df, FeatureSpec({"c": {"one_hot": "auto"}}))
    got = C.one_hot_long(df, "bill_id", "c").orderBy("idx").collect()
    assert [r.idx for r in got] == list(range(10))


def test_category_table_is_the_one_hot_vector(spark):
    train = spark.createDataFrame([(1, "b", "Passed"), (2, "a", "Passed"), (3, None, "Passed"), (4, "c", "Failed")], "bill_id long, c string, status_new string")
    later = train.unionByName(spark.createDataFrame([(5, "z", "Failed")], train.schema))
    for before in ({}, {"impute_fixed": "m"}):
        vectors, names = [], []
        for op in ("one_hot", "one_hot_table"):
            fitted = fit_features(train, FeatureSpec({"bill_id": {}, "c": before | {op: []}, "c::2": {"mark_blanks": [], op: ["x"] if op == "one_hot" else []}}))
            layout = fitted.layout()
            assert len(layout["c"]) == 3 + bool(before) and layout["c"].start == 1
            rows = fitted.transform(later).select("bill_id", vector_to_array("features").alias("v"), fit_module.vector_entries("features").alias("e")).collect()
            vectors.append({r.bill_id: r.v[: layout["c"].stop] for r in rows})
            names.append(fitted.feature_names()[: layout["c"].stop])
            for r in rows:
                full = [0.0] * len(r.v)
                for entry in r.e:
                    full[entry["at"]] = entry["value"]
                assert full == r.v
        assert vectors[0] == vectors[1] and names[0] == names[1] and vectors[1][5][1:] == [0.0] * (3 + bool(before))


def test_hash_matches_published_hash(spark):
    words = ["alpha", "beta", "γ", "", "a longer category value"]
    df = spark.createDataFrame([(w,) for w in words], "c string")
    for r in df.select("c", C.hash_bucket("c", 100).alias("b"), C.hash_sign("c").alias("s")).collect():
        h = xxhash.xxh64(r.c.encode(), seed=42).intdigest()
        signed = h - 2**64 if h >= 2**63 else h
        assert r.b == signed % 100
        assert r.s == (1.0 if (h >> 62) & 1 == 0 else -1.0)


def test_hash_vector_has_one_signed_entry(spark):
    df = spark.createDataFrame([(i, w, "Passed") for i, w in enumerate(["a", "b", "c", None])], "bill_id long, c string, status_new string")
    df = df.fillna("none", ["c"])
    fitted = fit_features(df, FeatureSpec({"c": {"hash_column": {"n_features": 1 << 20}}}))
    want = {r.bill_id: (r.b, r.s) for r in df.select("bill_id", C.hash_bucket("c").alias("b"), C.hash_sign("c").alias("s")).collect()}
    for r in fitted.transform(df).collect():
        assert r.features.size == 1 << 20
        assert (int(r.features.indices[0]), r.features.values[0]) == want[r.bill_id]


def test_mark_blanks(spark):
    df = spark.createDataFrame([(1, "a", "Passed"), (2, None, "Passed")], "bill_id long, c string, status_new string")
    fitted = fit_features(df, FeatureSpec({"c": {"mark_blanks": True, "one_hot": ["a", "Unknown"]}}))
    assert fitted.feature_names() == ["c_a", "c_Unknown", "c_is_null?"]
    assert [tuple(r)[2:] for r in fitted.columns(df).orderBy("bill_id").collect()] == [(1.0, 0.0, 0.0), (0.0, 1.0, 1.0)]


def test_labels(spark):
    df = spark.createDataFrame([("Passed",), ("Failed",), ("Failed_Final",)], "s string")
    assert [r[0] for r in df.select(C.label("s")).collect()] == [1.0, 0.0, 0.0]
    assert [r[0] for r in df.select(C.label("s", "ternary")).collect()] == [1.0, 0.0, 2.0]
    assert [r[0] for r in df.select(C.label_one_hot("s", "ternary")).collect()][2] == [0.0, 0.0, 1.0]


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(1, "tax tax bill", "Passed"), (2, "bill", "Failed"), (3, None, "Failed")]
    return spark.createDataFrame(rows, "bill_id long, text string, status_new string")


def test_tfidf_golden(spark, corpus):
    docs = corpus.where("text is not null")
    table = spark.createDataFrame([("text", "bill", 0), ("text", "road", 1), ("text", "tax", 2)], "column string, term string, idx long")
    fitted = fit_features(docs, FeatureSpec({"text": {"tfidf": []}}), vocab=TX.VectorVocabulary(table))
    assert fitted.feature_names() == ["text::bill", "text::road", "text::tax"]
    first = fitted.transform(docs).where("bill_id = 1").first().features.toArray()
    assert list(first) == pytest.approx([0.335176, 0.0, 0.942156], abs=1e-6)
    idf = {r.term: r.idf for r in TX.idf_long(TX.bow_long(docs, "bill_id", "text"), 2).collect()}
    assert idf == pytest.approx({"bill": 1.0, "tax": 1.405465}, abs=1e-6)


def test_long_and_vector_forms_agree(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{rng.randint(0, 30)}" for _ in range(rng.randint(1, 40))), "Passed") for i in range(60)]
    docs = spark.createDataFrame(rows, "bill_id long, text string, status_new string").repartition(7)
    fitted = fit_features(docs, FeatureSpec({"text": {"tfidf": []}}))
    names = [n.split("::")[1] for n in fitted.feature_names()]
    assert names == sorted(names)
    vectors = {r.bill_id: dict(zip(names, r.features.toArray())) for r in fitted.transform(docs).collect()}
    for r in TX.tfidf_long(docs, "bill_id", "text").collect():
        assert vectors[r.bill_id][r.term] == pytest.approx(r.weight)
    lengths = [math.sqrt(sum(v * v for v in row.values())) for row in vectors.values()]
    assert lengths == pytest.approx([1.0] * 60)


def test_missing_text_is_an_empty_document(corpus):
    fitted = fit_features(corpus, FeatureSpec({"text": {"bow": []}}))
    got = {r.bill_id: list(r.features.toArray()) for r in fitted.transform(corpus).collect()}
    assert got == {1: [1.0, 2.0], 2: [1.0, 0.0], 3: [0.0, 0.0]}


def test_same_text_column_twice_and_topics(corpus):
    spec = FeatureSpec({"text": {"bow": []}, "text::2": {"lda": 2}})
    fitted = fit_features(corpus, spec)
    assert fitted.feature_names() == ["text::bill", "text::tax", "text::topic_0", "text::topic_1"]
    assert fitted.transform(corpus).first().features.size == 4


def test_topics_without_a_matrix_on_the_driver(spark, monkeypatch):
    """Beyond the driver's limit no local model is fitted; two kinds of documents still get two topics."""
    monkeypatch.setattr(TX, "MAX_DRIVER_WEIGHTS", 0)
    monkeypatch.setattr(TX, "MAX_VECTOR_TERMS", 10)  # of vectors by term, not of topics
    monkeypatch.setattr(TX.VectorVocabulary, "counter", None)
    monkeypatch.setattr(TX, "LDA", None)
    for name, value in (("STEPS", 6), ("BATCH_FRACTION", 0.5), ("LEARNING_OFFSET", 4)):  # so few documents need long steps
        monkeypatch.setattr(TP, name, value)
    rng = random.Random(5)
    words = [[f"{side}word{k}" for k in range(40)] for side in "ab"]
    rows = [(i, " ".join(rng.choice(words[i % 2]) for _ in range(30)), "Passed", 1.5) for i in range(600)]
    rows += [(600, None, "Passed", 1.5), (601, "unknown", "Passed", 1.5), (601, rows[0][1], "Passed", 1.5)]
    docs = spark.createDataFrame(rows, "bill_id long, text string, status_new string, x double")
    spec = FeatureSpec({"x": {}, "text": {"lda": 2}})
    fitted = fit_features(docs.where("bill_id < 601"), spec)
    assert fitted.feature_names() == ["x", "text::topic_0", "text::topic_1"]
    got = [(r.bill_id, list(r.features.toArray())) for r in fitted.transform(docs).collect()]
    assert len(got) == 603 and all(v[0] == 1.5 for _, v in got)
    assert [v[1:] for i, v in got if i == 600] == [[0.0, 0.0]]
    assert sorted(sum(v[1:]) for i, v in got if i == 601) == pytest.approx([0.0, 1.0])
    assert all(sum(v[1:]) == pytest.approx(1) for i, v in got if i < 600)
    first = [v[1] for _, v in sorted(got) if v[1]]
    sides = [sum(first[k:600:2]) / 300 for k in (0, 1)]
    assert max(sides) > 0.9 and min(sides) < 0.1


def test_gamma_functions_and_start():
    x = np.array([0.01, 0.5, 1.0, 3.5, 200.0])
    step = 1e-5
    slope = [(math.lgamma(v * (1 + step)) - math.lgamma(v * (1 - step))) / (2 * v * step) for v in x]
    assert TP.digamma(x) == pytest.approx(slope, rel=1e-6)
    assert TP.trigamma(x) == pytest.approx((TP.digamma(x * (1 + step)) - TP.digamma(x * (1 - step))) / (2 * x * step), rel=1e-6)
    draw = TP.start_draw(np.arange(100_000), 3, 17)
    assert draw.mean(axis=0) == pytest.approx([1, 1, 1], abs=2e-3) and draw.std(axis=0) == pytest.approx([0.1] * 3, rel=0.02)
    assert np.abs(np.corrcoef(draw.T) - np.eye(3)).max() < 0.02


def test_log_gamma():
    x = np.array([0.01, 0.5, 1.0, 3.5, 200.0, 1e6])
    assert TP.log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-9, abs=1e-9)


def plain_updates(beta, counts, alpha, change=TP.INFERENCE_CHANGE / 100):
    """Topic parameters of one document, and the number of updates."""
    gamma = np.ones(len(alpha))
    for number in itertools.count(1):
        theta = np.exp(TP.digamma(gamma) - TP.digamma(gamma.sum(keepdims=True)))
        new = theta * (beta * (counts / (beta @ theta))[:, None]).sum(axis=0) + alpha
        if np.abs(new - gamma).mean() <= change:
            return new, number
        gamma = new


def test_topics_of_documents_are_those_that_plain_updates_reach(monkeypatch):
    """Also where documents leave and enter while others are at work."""
    rng = np.random.default_rng(3)
    beta = rng.gamma(2, 0.5, (300, 3)) * np.array([0.2, 1, 0.6]) / 100
    sizes = rng.integers(1, 60, 40)
    term = np.concatenate([rng.choice(300, n, replace=False) for n in sizes])
    counts, alpha = rng.integers(1, 9, len(term)).astype(float), np.full(3, 0.4)
    first = np.cumsum(sizes) - sizes
    want = [plain_updates(beta[term[f : f + n]], counts[f : f + n], alpha)[0] for f, n in zip(first, sizes)]
    for room in (1, 200, 1 << 15):
        monkeypatch.setattr(TP, "PART_TERMS", room)
        got = TP.infer(beta, term, counts, sizes, alpha)
        assert got.sum(axis=1) == pytest.approx(alpha.sum() + np.add.reduceat(counts, first))
        assert np.abs(got - want).max() < 0.2  # of sums of some 200
    assert len(TP.infer(beta, term[:0], counts[:0], sizes[:0], alpha)) == 0
    # topics that are much alike: an update moves little
    monkeypatch.setattr(TP, "PART_TERMS", 1 << 15)
    seen, expectation = [], TP._log_expectation
    monkeypatch.setattr(TP, "_log_expectation", lambda g: seen.append(len(g)) or expectation(g))
    alike, counts, alpha = rng.gamma(100, 0.01, (1000, 5)) / 1000, rng.integers(1, 4, 1000).astype(float), np.full(5, 0.2)
    TP.infer(alike, np.arange(1000), counts, np.array([1000]), alpha)
    assert len(seen) < plain_updates(alike, counts, alpha, TP.INFERENCE_CHANGE)[1] / 3


def test_chunks_of_documents(monkeypatch):
    """Each document and token is in one chunk, in order; only a document that is longer alone makes a chunk too long."""
    monkeypatch.setattr(TP, "CHUNK_TOKENS", 7)
    texts = [["a"] * 3, None, ["b"] * 4, [], ["c"] * 9, ["d"], ["e", "f"] * 3, [], ["a"], None]
    schema = pa.schema([("part", pa.int32()), ("key", pa.int64()), ("terms", pa.list_(pa.string()))])
    batch = lambda lo, hi: pa.record_batch([[2] * (hi - lo), list(range(lo, hi)), texts[lo:hi]], schema=schema)
    want = [t for text in texts for t in text or []]
    for cuts in ([0, 10], [0, 1, 4, 4, 5, 10], list(range(11))):
        found = list(TP._chunks([batch(lo, hi) for lo, hi in zip(cuts, cuts[1:])]))
        assert [c[:2] for c in found] == [(2 << 32, k) for k in range(len(found))]
        assert [k for c in found for k in c[2]] == list(range(10)) and [t for c in found for t in c[4].to_pylist()] == want
        assert all(sum(c[3]) == len(c[4]) <= 7 or len(set(c[4].to_pylist())) == 1 for c in found)


def test_documents_of_a_batch_and_terms_that_have_no_place():
    times = TP.times_drawn(np.arange(200_000), 4, 0.05, 17)
    assert times.mean(axis=0) == pytest.approx([0.05] * 4, rel=0.05) and times.var(axis=0) == pytest.approx([0.05] * 4, rel=0.05)
    assert np.abs(np.corrcoef(times.T) - np.eye(4)).max() < 0.02
    assert (TP.times_drawn(np.arange(500, 600), 4, 0.05, 17) == times[500:600]).all()  # by document, whatever is beside it
    texts = [["x", "y", "x"], ["z"], [], ["y", "z", "z"]] * 50
    rows = pa.record_batch([[0] * 200, list(range(200)), texts], names=["part", "key", "terms"])
    found = pa.Table.from_batches(TP._batches_of([rows], 4, 0.5, 17))
    drawn = TP.times_drawn(np.arange(200), 4, 0.5, 17)
    assert pc.sum(found.column("documents")).as_py() == 200
    terms = found.filter(pc.is_valid(found.column("term")))
    assert terms.column("term").to_pylist() == ["x", "y", "z"] and terms.column("turns").to_pylist() == [15] * 3
    weights = TP.Weights(2, 17, (0.5, 0.5), (100.0, 100.0))
    for turn in range(4):
        docs = found.filter(pc.equal(found.column("turn"), turn)).column("docs").to_pylist()
        # "z" is not in the vocabulary, so documents with no other term are left out
        table = pa.table({"code": [1, 0, None], "at": [7, 9, None], "added": pa.array([None, [1.0, 2.0], None], pa.list_(pa.float64())), "docs": [None, None, *docs], "later": [True, False, None]})
        at, beta, marks, sizes, term, counts = TP._chunk(table, weights)
        here = [(k, drawn[k, turn]) for k in range(200) if drawn[k, turn] and k % 4 in (0, 3)]
        assert list(at) == [7, 9] and list(marks) == [n for _, n in here] and list(sizes) == [2 if k % 4 == 0 else 1 for k, _ in here]
        assert sum(counts[term == 1]) == 2 * sum(k % 4 == 0 for k, _ in here) and sum(counts[term == 0]) == len(here)
        found_at, added, later = TP._statistics(table, weights, 1.0).to_pydict().values()
        stats = dict(zip(found_at, added))
        assert dict(zip(found_at, later)) == {7: True, 9: False, TP.LOG_SHARES: False, TP.DOCUMENTS: False, TP.ADDED: False}
        assert stats[TP.DOCUMENTS] == [sum(n for _, n in here)] * 2
        # each token is shared out between the topics
        assert sum(stats[7]) == pytest.approx(sum(n for _, n in here)) and sum(stats[9]) == pytest.approx(2 * sum(n for k, n in here if k % 4 == 0))
        assert stats[TP.ADDED] == pytest.approx([stats[7][k] + stats[9][k] for k in (0, 1)])


def test_topics_leave_counted_terms_where_they_are(spark, monkeypatch):
    """Documents are not dealt out by term or id, nor written as texts, to be fitted."""
    monkeypatch.setattr(TX, "MAX_DRIVER_WEIGHTS", 0)
    vocab = TX.VectorVocabulary(spark.createDataFrame([("text", "tax", 0), ("text", "bill", 1)], "column string, term string, idx int"))
    docs = spark.createDataFrame([(k, "tax bill unknown" if k % 3 else None) for k in range(90)], "bill_id long, text string")
    for name in ("TextVectors", "cut_lineage"):
        monkeypatch.setattr(TX, name, None)
    model = TX.fit_text_op(docs, "text", "lda", 2, vocab)[0]
    terms = {r.term: (r.at, r.added) for r in model.terms.collect()}
    assert sorted(terms) == ["bill", "tax"] and [terms[t][0] for t in ("tax", "bill")] == [0, 1]
    # a topic's total is that of its terms: what every batch added to them came to the end
    start = TP.start_draw(np.arange(2), 2, 17).sum(axis=0)
    total = model.weights.left * (start + np.add(terms["tax"][1], terms["bill"][1])) + (1 - model.weights.left) * 0.5 * 2
    assert total == pytest.approx(model.weights.totals)
    got = {r.bill_id: r.entries for r in model.entries(docs, "bill_id", 5).collect()}
    assert sorted(got) == [k for k in range(90) if k % 3]
    assert all([e["at"] for e in v] == [5, 6] and sum(e["value"] for e in v) == pytest.approx(1) for v in got.values())


def test_oversized_vocabulary_is_loud(spark, corpus, monkeypatch):
    monkeypatch.setattr(TX, "MAX_VECTOR_TERMS", 1)
    with pytest.raises(ValueError, match="long form"):
        fit_features(corpus, FeatureSpec({"text": {"bow": []}}))


def test_columns_to_read():
    spec = FEATURE_SETS["no_text"]
    assert {"introduced_date", "session_start_date", "session_end_date", "sponsors", "iter_2"} <= spec.columns(2)
    assert not any("::" in c for c in spec.columns(2))
    assert FEATURE_SETS["all"].text_columns() == ["bill_description", "bill_text"]


def test_unknown_operation(numbers):
    with pytest.raises(ValueError, match="unknown"):
        fit_features(numbers, FeatureSpec({"x": {"bert": []}}))


def test_one_scan_fits_a_whole_specification(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(100).select(
        F.col("id").alias("bill_id"), *[(F.col("id") * k).cast("double").alias(f"x{k}") for k in range(1, 6)],
        F.lit("Passed").alias("status_new"), F.lit("unused").alias("wide"),
    ).write.parquet(path)
    df = spark.read.parquet(path)
    spec = FeatureSpec({f"x{k}": {"impute_mean": [], "normalize": []} for k in range(1, 6)})
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("fit-once", "fit")
    fitted = fit_features(df, spec)
    jobs = tracker.getJobIdsForGroup("fit-once")
    spark.sparkContext.setJobGroup("", "")
    assert len(jobs) <= 2  # map side and final merge of one aggregation
    plan = fitted.columns(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "wide" not in plan[plan.index("ReadSchema"):]


def test_block_features_split_by_role(spark):
    rows = [(i, 1 + (i % 4), float(i), "Passed" if i % 2 else "Failed") for i in range(40)]
    facts = spark.createDataFrame(rows, "bill_id long, iter_1 int, x double, status_new string")
    fitted, train, valid = block_features(facts, FeatureSpec({"x": {"impute_mean": []}}), 1)
    assert (train.count(), valid.count()) == (10, 10)
    assert set(train.columns) == {"bill_id", "features", "label"}
    with pytest.raises(ValueError):
        block_features(facts, FeatureSpec({"x": {}}), 1, history="never")


def test_one_hot_frame(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "y"), ("c", "x")], "p string, q string")
    got = {r.p: list(r.v) for r in one_hot_frame(df, ["p", "q"]).select("p", vector_to_array("one_hot").alias("v")).collect()}
    assert got == {"a": [1, 0, 0, 0, 1], "b": [0, 1, 0, 1, 0], "c": [0, 0, 1, 1, 0]}


def test_history_of_all_rows_is_computed_once(spark):
    """Fit and both slices read history that is kept; its window is in none of their plans."""
    outcome = ["introduced_date", "status_new"]
    spec = FeatureSpec({
        "sponsors": {"sponsor_pass_rate": outcome, "impute_mean": []}, "sponsors::2": {"sponsor_total_bills": outcome, "impute_mean": []},
    })
    rows = [(i, 1 + 2 * (i % 2), f"{2000 + i}-01-01", "Passed" if i % 3 else "Failed", "7, 8" if i % 2 else "7") for i in range(8)]
    facts = spark.createDataFrame(rows, "bill_id long, iter_1 int, introduced_date string, status_new string, sponsors string")
    _, train, valid = block_features(facts.withColumn("introduced_date", F.to_date("introduced_date")), spec, 1, history="all")
    for part in (train, valid):
        assert "Window" not in part._jdf.queryExecution().executedPlan().toString()
    got = {r.bill_id: list(r.features.toArray()) for r in train.unionByName(valid).collect()}
    assert got[4] == pytest.approx([2 / 3, 3.0])  # sponsor 7 on bills 0 to 2; bill 3 is only 365 days older; 1 and 2 passed


def test_text_vectors_name_no_places_and_keep_their_order(spark):
    """A text between scalar columns fills its own places, and nothing on the driver names each term."""
    rows = [(1, 1.0, "b a b", 5.0, "Passed"), (2, 0.0, None, 6.0, "Failed"), (2, 0.0, None, 6.0, "Failed"), (3, 3.0, "zz", 0.0, "Failed")]
    df = spark.createDataFrame(rows, "bill_id long, x double, text string, y double, status_new string")
    table = spark.createDataFrame([("text", "aa", 3), ("text", "bb", 5), ("text", "zz", 9)], "column string, term string, idx long")
    df = df.withColumn("text", F.regexp_replace("text", "([ab])", "$1$1"))
    spec = FeatureSpec({"x": {"impute_fixed": 0}, "text": {"bow": []}, "y": {"impute_fixed": 0}})
    fitted = fit_features(df, spec, vocab=TX.VectorVocabulary(table))
    found = fitted.transform(df)
    assert not found.schema["features"].metadata
    got = sorted((r.bill_id, *r.features.toArray()) for r in found.collect())
    assert got == [(1, 1.0, 1.0, 2.0, 0.0, 5.0), (2, 0.0, 0.0, 0.0, 0.0, 6.0), (2, 0.0, 0.0, 0.0, 0.0, 6.0), (3, 3.0, 0.0, 0.0, 1.0, 0.0)]
    assert fitted.feature_names() == ["x", "text::aa", "text::bb", "text::zz", "y"]


def test_terms_of_one_document_need_no_table(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "tax bill bill"), (2, "tax road"), (3, None), (None, "tax sea")], "doc_id long, text string")
    tables = []
    sized = TX._sized
    monkeypatch.setattr(TX, "_sized", lambda table: tables.append(sorted(r.term for r in table.collect())) or sized(table))
    got = {(r.doc_id, r.term): r.weight for r in TX.tfidf_long(docs, "doc_id", "text").collect()}
    assert tables == [["tax"]]
    one, three = math.log(5 / 2) + 1, math.log(5 / 4) + 1
    length = math.hypot(2 * one, three)
    assert got == pytest.approx({
        (1, "bill"): 2 * one / length, (1, "tax"): three / length, (2, "tax"): three / math.hypot(one, three), (2, "road"): one / math.hypot(one, three),
        (None, "tax"): three / math.hypot(one, three), (None, "sea"): one / math.hypot(one, three),
    })


def test_a_long_text_is_scaled_in_one_pass(spark):
    """The norm of a document is not computed again for each of its terms: the lambda that scales holds no aggregate."""
    docs = spark.createDataFrame([(k, " ".join(f"w{j}" for j in range(k, k + 50))) for k in range(4)], "doc_id long, text string")
    weights = spark.createDataFrame([(f"w{j}", j, 1.0 + j) for j in range(60)], "term string, idx long, weight double")
    found = TX.TextVectors("text", 60, weights, True).entries(docs, "doc_id")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 1
    assert not re.search(r"/ sqrt\(aggregate\(", plan, re.IGNORECASE)
    for row in found.collect():
        assert [e.at for e in row.entries] == list(range(row.doc_id, row.doc_id + 50))
        norm = sum((1.0 + e.at) ** 2 for e in row.entries) ** 0.5
        assert all(e.value == pytest.approx((1.0 + e.at) / norm) for e in row.entries)
