"""Bag-of-words, tf-idf and topics, as long tables and as vectors.

The long form ``(id, term, value)`` holds any vocabulary. Count and tf-idf vectors get the places of
their terms by a join, so that no process holds a large vocabulary; they refuse one that is too large for a
vector. Topics, a model of terms by topics, are Spark ML's while that is small, and a table beyond that (``topics``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import SparkContext
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizerModel, SQLTransformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foretell.features.topics import TopicShares, fit_topics
from foretell.functions.text import word_tokens
from foretell.operators.ordinal import global_ordinal, ordinal_within
from foretell.session import cut_lineage

#: Terms of a vector.
MAX_VECTOR_TERMS = 10_000_000
#: Size up to which a table of terms is sent to every executor.
MAX_BROADCAST_BYTES = 64 << 20
#: Terms times topics up to which the driver holds a model of topics; it needs about ten times their bytes and the terms.
MAX_DRIVER_WEIGHTS = 1 << 21


def vocabulary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, term, idx)``: the distinct tokens of each text column, alphabetical."""
    tall = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("text")) for c in columns])
    texts = df.select(F.explode(tall).alias("t")).select("t.*")
    # written, so that the texts are cut into tokens once
    terms = cut_lineage(texts.select("column", F.explode(word_tokens("text")).alias("term")).distinct())
    numbered = ordinal_within(terms, ["column"], ["term"], "idx")
    return numbered.withColumn("idx", F.col("idx") - 1)


def bow_long(
    df: DataFrame, id_column: str, text: str, vocab: DataFrame | None = None
) -> DataFrame:
    """``(id, term, tf)``, restricted to the vocabulary's terms if one is given."""
    tokens = df.select(id_column, F.explode(word_tokens(text)).alias("term"))
    counts = tokens.groupBy(id_column, "term").agg(F.count("*").alias("tf"))
    return counts if vocab is None else counts.join(vocab.select("term"), "term", "left_semi")


def document_counts(counts: DataFrame) -> DataFrame:
    """``(term, df)`` of rows for each term of each document; only combined counts are shuffled."""
    return counts.groupBy("term").agg(F.count("*").alias("df"))


def smoothed_idf(n_documents, df: Column) -> Column:
    return F.log((1 + n_documents) / (1 + df)) + 1


def with_idf(seen: DataFrame, n_documents) -> DataFrame:
    return seen.select("term", smoothed_idf(n_documents, F.col("df")).alias("idf"))


def idf_long(counts: DataFrame, n_documents) -> DataFrame:
    """``(term, idf)`` with smoothed document frequencies: ``ln((1 + n) / (1 + df)) + 1``.

    ``counts`` has a row for each term of each document.
    """
    return with_idf(document_counts(counts), n_documents)


def _sized(table: DataFrame) -> DataFrame:
    """A written table of terms, to be broadcast if its bytes, now known, allow it."""
    table = cut_lineage(table)
    size = table.agg(F.sum(F.octet_length("term") + 40)).first()[0] or 0
    return F.broadcast(table) if size <= MAX_BROADCAST_BYTES else table


def tfidf_long(
    df: DataFrame, id_column: str, text: str, train: DataFrame | None = None,
    vocab: DataFrame | None = None,
) -> DataFrame:
    """``(id, term, weight)``: tf x idf, each document scaled to length 1.

    ``train`` holds the documents the document frequencies come from (default: ``df``). A
    vocabulary term that no training document has gets the idf of frequency zero.

    Texts are dealt by id once; the terms of a document are then counted, weighted and scaled where it lies.
    Only an idf table too large to broadcast makes the counted terms move to it and back. Terms of one document, most of
    a vocabulary, are not in the table if the documents are their own: what it lacks has that idf.
    """
    fitted = df if train is None else train
    n = fitted.agg(F.count("*")).scalar()
    seen = document_counts(fitted.select(F.explode(F.array_distinct(word_tokens(text))).alias("term")))
    if vocab is not None:
        unseen = F.log(1 + n.cast("double")) + 1
        known = vocab.select("term").distinct().join(with_idf(seen, n), "term", "left")
        idf, other = known.select("term", F.coalesce("idf", unseen).alias("idf")), None
    elif train is not None:
        idf, other = with_idf(seen, n), None
    else:
        # every term is in a document, so those that are in no table are in one
        idf, other = with_idf(seen.where("df > 1"), n), smoothed_idf(n, F.lit(1))
    idf = _sized(idf)
    tokens = df.select(id_column, text).repartition(id_column).select(id_column, F.explode(word_tokens(text)).alias("term"))
    counts = tokens.groupBy(id_column, "term").agg(F.count("*").alias("tf"))
    weighted = counts.join(idf, "term") if other is None else counts.join(idf, "term", "left").withColumn("idf", F.coalesce("idf", other))
    weighted = weighted.withColumn("w", F.col("tf") * F.col("idf"))
    # one document per window group: its distinct terms came from its rows
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy(id_column)))
    return weighted.select(id_column, "term", (F.col("w") / length).alias("weight"))


class VectorVocabulary:
    """A vocabulary table ready for vectors: size and count model per column, made once.

    One object serves every block of a run. The model's terms go from the table to the JVM's model; Python gets them
    only where feature names are asked for.
    """

    def __init__(self, table: DataFrame):
        self.table = table
        self._sizes: dict[str, int] = {}
        self._models: dict[str, CountVectorizerModel] = {}

    def _ordered(self, column: str) -> DataFrame:
        return self.table.where(F.col("column") == column).orderBy("idx").select("term")

    def size(self, column: str) -> int:
        n = self.count(column)
        if n > MAX_VECTOR_TERMS:
            raise ValueError(
                f"{column} has over {MAX_VECTOR_TERMS} terms, too many for one vector: "
                "use the long form (bow_long, tfidf_long)"
            )
        return n

    def count(self, column: str) -> int:
        """Terms of a column, of any number."""
        if column not in self._sizes:
            n = self.table.where(F.col("column") == column).count()
            if not n:
                raise ValueError(f"{column} has no tokens")
            self._sizes[column] = n
        return self._sizes[column]

    def places(self, column: str) -> DataFrame:
        """``(term, idx)`` with the places 0 to size - 1 in the order of the table."""
        n, table = self.count(column), self.table.where(F.col("column") == column).select("term", "idx")
        low, high = table.agg(F.min("idx"), F.max("idx")).first()
        if (low, high) == (0, n - 1):
            return table
        return global_ordinal(table, ["idx", "term"], "__at").select("term", (F.col("__at") - 1).alias("idx"))

    def terms(self, column: str) -> list[str]:
        self.size(column)
        return self._ordered(column).toArrow().column("term").to_pylist()

    def counter(self, column: str, words: str, counts: str) -> CountVectorizerModel:
        if column not in self._models:
            self.size(column)
            strings = SparkContext.getOrCreate()._jvm.org.apache.spark.sql.Encoders.STRING()
            terms = getattr(self._ordered(column)._jdf, "as")(strings).collect()  # an array of the JVM
            self._models[column] = CountVectorizerModel._create_from_java_class(
                "org.apache.spark.ml.feature.CountVectorizerModel", terms
            )
        model = self._models[column]
        return model.copy({model.inputCol: words, model.outputCol: counts})


@dataclass(frozen=True)
class TermNames:
    """The terms of a column as feature names: their number is known, they are read when looked at."""

    vocab: VectorVocabulary
    column: str

    def __len__(self) -> int:
        return self.vocab.size(self.column)

    def __iter__(self):
        return iter(self.vocab.terms(self.column))


@dataclass(frozen=True)
class TextVectors:
    """Fitted count or tf-idf vectors of a text column.

    ``weights`` is ``(term, idx, weight)``, written, and broadcast if its bytes allow it.
    """

    column: str
    size: int
    weights: DataFrame
    unit: bool  # each document scaled to length 1

    def entries(self, rows: DataFrame, key: str, offset: int = 0) -> DataFrame:
        """``(key, entries)``: places, shifted by ``offset``, and values of each row with terms of the vocabulary.

        Rows are dealt by their key once and their terms counted there; only weights too large to broadcast make
        the counted terms move to them and back.
        """
        texts = rows.select(key, F.col(self.column).alias("__text")).repartition(key)
        counts = texts.select(key, F.explode(word_tokens("__text")).alias("term")).groupBy(key, "term").agg(F.count("*").alias("__tf"))
        found = counts.join(self.weights, "term").groupBy(key).agg(
            F.array_sort(F.collect_list(F.struct((F.col("idx") + offset).cast("int").alias("at"), (F.col("__tf") * F.col("weight")).alias("value")))).alias("entries")
        )
        if not self.unit:
            return found
        return found.select(key, unit_entries(F.col("entries")).alias("entries"))


def unit_entries(entries: Column) -> Column:
    """Entries scaled to length 1. The length is the field of a one-element array: as a column it would be merged into
    the lambda and computed again for each entry."""
    length = F.sqrt(F.aggregate(entries, F.lit(0.0), lambda a, e: a + e["value"] * e["value"]))
    scaled = lambda row: F.transform(
        row["entries"], lambda e: F.struct(e["at"].alias("at"), (e["value"] / row["length"]).alias("value"))
    )
    return F.transform(F.array(F.struct(entries.alias("entries"), length.alias("length"))), scaled)[0]


def sparse_vector(entries: Column, size: int) -> Column:
    """A vector as it is stored, of entries in rising places; read back with a vector's type, it is one."""
    return F.struct(
        F.lit(0).cast("byte").alias("type"), F.lit(size).alias("size"),
        F.transform(entries, lambda e: e["at"]).alias("indices"), F.transform(entries, lambda e: e["value"]).alias("values"),
    )


def fit_text_op(
    df: DataFrame, column: str, op: str, params, vocab: VectorVocabulary, tag: str = "t",
    seed: int = 17,
) -> tuple[TextVectors | TopicShares | PipelineModel, str, TermNames | list[str]]:
    """Fitted transformers for one text column, their output column and feature names."""
    terms = TermNames(vocab, column)
    words, counts = f"__{tag}_words", f"__{tag}_counts"
    if op in ("bow", "tfidf"):
        weights = vocab.places(column).withColumn("weight", F.lit(1.0))
        if op == "tfidf":
            n = df.count()
            idf = idf_long(df.select(F.explode(F.array_distinct(word_tokens(column))).alias("term")), F.lit(n))
            unseen = F.log(F.lit(1.0 + n)) + 1
            weights = weights.join(idf, "term", "left").select("term", "idx", F.coalesce("idf", unseen).alias("weight"))
        return TextVectors(column, vocab.size(column), _sized(weights), op == "tfidf"), counts, terms
    topics = int(params) if params else 10
    names, size = [f"topic_{i}" for i in range(topics)], vocab.count(column)
    if size * topics > MAX_DRIVER_WEIGHTS:
        return fit_topics(df, vocab.places(column), column, topics, size, seed), counts, names
    # a missing text has no tokens
    pattern = r"[\\p{L}\\p{N}_]{2,}"
    tokens = SQLTransformer(
        statement=f"SELECT *, regexp_extract_all(lower(coalesce(`{column}`, '')), '{pattern}', 0) "
        f"AS `{words}` FROM __THIS__"
    )
    vectors = vocab.counter(column, words, counts)
    counted = vectors.transform(tokens.transform(df.select(column)))
    out = f"__{tag}_topics"
    model = LDA(
        k=topics, featuresCol=counts, topicDistributionCol=out, optimizer="online", seed=seed
    ).fit(counted)
    return PipelineModel([tokens, vectors, model]), out, names
