"""Corpus cleaning from raw documents to token ids, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foretell.llm import bpe, decontaminate, ngram_join, secrets, toxicity
from foretell.llm.common import spare_name
from foretell.session import scratch_path

#: SQL can express neither the nearest-neighbour scores nor the tokenizer.
ORACLE_SQL = None

TOXIC = 0.3  # score from which a document goes


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that score ``TOXIC`` or more by the labelled examples among ``docs``."""
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model, TOXIC)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near duplicates: that with the least id.

    Rows that repeat an id are told apart by their text; of rows equal in both, one stays. A null id comes last.
    """
    row = spare_name(docs, "row")
    digest = F.md5(F.coalesce("text", F.lit("")))
    named = docs.withColumn(row, F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", digest.alias("digest")))
    kept = ngram_join.jaccard_join(named, row).where("kept").select(row).distinct()
    return named.join(kept, row, "left_semi").dropDuplicates([row]).drop(row)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item; rows that share an id go together."""
    found = decontaminate.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    leaked = spare_name(docs, "leaked")
    ids = found.select(F.col("doc_id").alias(leaked)).distinct()
    return docs.join(ids, F.col("doc_id").eqNullSafe(F.col(leaked)), "left_anti")


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in texts by a mark; ``n_chars`` follows. All documents stay."""
    spans, redacted = spare_name(docs, "spans"), spare_name(docs, "redacted")
    found = secrets.scan_secrets(docs, spans_col=spans, redacted_col=redacted)
    changed = F.size(spans) > 0
    values = {
        "text": F.col(redacted),
        "n_chars": F.when(changed, F.length(redacted).cast("long")).otherwise(F.col("n_chars")),
    }
    return found.select(*[values.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, after a check that they decode to it."""
    rows = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"))
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return rows.select(
        "doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.when(same, F.col("ids")).otherwise(F.raise_error(F.lit("a text does not survive encoding"))).alias("ids"),
        F.sha2("ids", 256).alias("ids_sha256"),
    )


STAGES = [
    ("toxicity", toxic_documents), ("ngram_jaccard", near_duplicates), ("decontamination", decontamination),
    ("secrets", secret_redaction), ("bpe", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
