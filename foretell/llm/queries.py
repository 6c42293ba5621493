"""The operators as registered queries on whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foretell.llm import (
    archive, bpe, decontaminate, ngram_join, pii, quality, secrets, token_store, toxicity, url_filter, variants, vector_dedup, whitening,
)
from foretell.llm.labels import fold
from foretell.session import scratch_path

URL_RULES = [
    ("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and the benchmark item it holds."""
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.vector_duplicates(_table(spark, sf_dir, "embeddings"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the token ids of every text and of their decoded text."""
    return bpe.round_trip(_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page to packages, and describe the records that are read back."""
    records = archive.page_records(_table(spark, sf_dir, "pages"), least_revisit_bytes=0)
    packages = archive.write_packages(records, scratch_path(spark, "warc"))
    found = archive.read_records(archive.read_index(packages))
    page = lambda c: F.expr(f"try_cast(nullif(substring_index({c}, ':', -1), '') as bigint)")
    return found.select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"),
    )


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by the examples outside fold 2 of 4."""
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, _table(spark, sf_dir, "labels"), use=fold(F.col("doc_id"), 4) != 2)
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "terms", "evidence",
    )


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_join(_table(spark, sf_dir, "documents"))


def _span_digests(found: DataFrame, *kinds: str) -> DataFrame:
    """Counts of base spans of the given kinds, their digest, and all spans as text."""
    as_text = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in kinds],
        F.sha2(as_text(base).cast("binary"), 256).alias("base_sha256"), as_text(F.col("spans")).alias("spans"),
    )


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return _span_digests(found, "assign", "access", "hex")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return _span_digests(pii.scan_pii(docs, pii.fit_tagger(docs)), "email", "ip", "card", "phone")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model learnt outside fold 1 of 3."""
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, _table(spark, sf_dir, "labels"), use=fold(F.col("doc_id"), 3) != 1)
    return quality.score_quality(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(_table(spark, sf_dir, "documents"))


def op12_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the ids of every text in directly addressable codes, and describe what is read back."""
    return token_store.stored_ids(_table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened coordinates of every vector; a ``deviation`` beyond 64 bits is null."""
    return whitening.whiten(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).withColumn(
        "deviation", F.expr("try_cast(deviation AS long)"))


QUERIES = {f.__name__: f for f in (
    op1_decontamination, op2_embedding_dedup, op3_bpe, op4_warc, op5_url_filter, op6_toxicity,
    op7_ngram_jaccard, op8_secrets, op9_pii, op10_quality, op11_spelling_variants, op12_token_store, op13_whitening,
)}

_COMPONENTS = """
reach(a, b) AS (
    SELECT id, id FROM node
    UNION
    SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b
)
"""

_CRC_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"

ORACLES = {
    # crc32 by its table of bytes; letters are one byte, or 195 and another
    "op11_spelling_variants": f"""
WITH RECURSIVE crc AS (
    SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: {_CRC_STEP})) AS t
), found AS (
    SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]{{7,}}')) AS r FROM documents WHERE text IS NOT NULL
), runs AS (
    SELECT doc_id, translate(r, '{variants.UPPER}', '{variants.LOWER}') AS run, count(*) AS n FROM found GROUP BY 1, 2
), bytes AS (
    SELECT run, n, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR) || ':' || run, ''),
        lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [195, unicode(x) - 64] END)) AS b FROM runs
), hashed AS (
    SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(b, lambda x: CAST(x AS BIGINT))),
        lambda c, x: xor(c >> 8, t[CAST((xor(c, x) & 255) + 1 AS INTEGER)])), 4294967295) AS h FROM bytes, crc
), spoilt AS (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word, n FROM hashed
), words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spoilt WHERE length(word) >= 7 GROUP BY 1 HAVING sum(n) >= 2
), cut AS (
    SELECT word, n, i, substr(word, 1, CAST(i AS INTEGER) - 1) || substr(word, CAST(i AS INTEGER) + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
    SELECT a.word AS word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
), ranked AS (
    SELECT word, other, other_n, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place, count(*) OVER (PARTITION BY word) AS n_near FROM near
), forms AS (
    SELECT words.word AS word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * n THEN other END AS form, CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
    FROM words LEFT JOIN (SELECT * FROM ranked WHERE place = 1) best ON best.word = words.word
), chain(word, reached, depth) AS (
    SELECT word, word, 0 FROM forms
    UNION ALL
    SELECT chain.word, forms.form, depth + 1 FROM chain JOIN forms ON forms.word = chain.reached WHERE forms.form IS NOT NULL
)
SELECT forms.word AS word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, arg_max(reached, depth) AS root FROM chain GROUP BY 1) r ON r.word = forms.word
""",
    "op2_embedding_dedup": f"""
WITH RECURSIVE node AS (
    SELECT vec_id AS id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
), good AS (
    SELECT * FROM node WHERE label IS NOT NULL AND len(v) > 0
        AND len(list_filter(v, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND list_sum(list_transform(v, lambda x: x * x)) > 0
), link AS (
    SELECT p.id AS a, q.id AS b FROM good p JOIN good q ON p.label = q.label AND p.id <> q.id AND len(p.v) = len(q.v)
    WHERE list_cosine_similarity(p.v, q.v) >= 0.93
), {_COMPONENTS}
SELECT node.id AS vec_id, (SELECT count(*) FROM link WHERE link.a = node.id) AS n_links, min(reach.b) AS component_id,
    node.id = min(reach.b) AS kept
FROM node JOIN reach ON reach.a = node.id GROUP BY node.id
""",
    "op7_ngram_jaccard": f"""
WITH RECURSIVE words AS (
    SELECT doc_id AS id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \\t\\n\\r\\f\\v]+'), lambda x: x <> '') AS w
    FROM documents
), node AS (
    SELECT id, list_distinct(CASE WHEN len(w) = 0 THEN [''] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS grams FROM words
), gram AS (
    SELECT id, len(grams) AS n, unnest(grams) AS g FROM node
), link AS (
    SELECT p.id AS a, q.id AS b FROM gram p JOIN gram q ON p.g = q.g AND p.id <> q.id
    GROUP BY p.id, q.id, p.n, q.n HAVING count(*) * 5 >= 4 * (p.n + q.n - count(*))
), {_COMPONENTS}
SELECT node.id AS doc_id, (SELECT count(*) FROM link WHERE link.a = node.id) AS n_links, min(reach.b) AS class_id,
    node.id = min(reach.b) AS kept
FROM node JOIN reach ON reach.a = node.id GROUP BY node.id
""",
}
