"""Bounded samples of labelled texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foretell.session import cut_lineage


def fold(id_column: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, use: Column | None, limit: int,
) -> DataFrame:
    """``id``, ``text`` (null as empty), ``label`` of at most ``limit`` labelled documents, chosen by a hash of the id.

    ``use``: condition on the labels' rows. Rows without id or label are left out; of repeated labels the largest
    counts, of repeated documents the least text. The sample's ids are joined by broadcast, as
    ``limit`` bounds them.
    """
    known = labels if use is None else labels.where(use)
    known = known.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna()
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    chosen = cut_lineage(known.orderBy(F.xxhash64("id"), "id").limit(limit))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
