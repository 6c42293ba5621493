"""Word counts and vocabulary comparison between groups of texts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foretell.functions.text import (
    STOPWORDS,
    TOPICS,
    keyword_flag,
    whitespace_tokens,
)


def word_counts(
    texts: DataFrame, text: str, by: Sequence[str] = (), stopwords: Iterable[str] = STOPWORDS
) -> DataFrame:
    """``(by.., word, n)``; stopwords are removed before lower-casing, so "The" survives."""
    words = texts.select(*by, F.explode(whitespace_tokens(text)).alias("word"))
    words = words.where(~F.col("word").isin(*stopwords))  # a compiled set test per row
    return words.groupBy(*by, F.lower("word").alias("word")).agg(F.count("*").alias("n"))


def by_frequency(counts: DataFrame) -> DataFrame:
    """Ascending by count, then by word."""
    return counts.orderBy("n", "word")


def words_only_in(counts: DataFrame, group_column: str, group: str, other: str) -> DataFrame:
    """Words of one group that the other never uses, with their counts."""
    mine = counts.where(F.col(group_column) == group)
    theirs = counts.where(F.col(group_column) == other).select("word")
    return mine.join(theirs, "word", "left_anti").select("word", "n")


def topic_flags(texts: DataFrame, text: str, topics: Mapping[str, str] = TOPICS) -> DataFrame:
    """One boolean column per keyword topic."""
    return texts.withColumns({f"topic_{t}": keyword_flag(text, p) for t, p in topics.items()})


def topic_counts(
    texts: DataFrame, text: str, by: Sequence[str] = (), topics: Mapping[str, str] = TOPICS
) -> DataFrame:
    """Matching texts per topic (and group), all topics in one pass."""
    flagged = topic_flags(texts, text, topics)
    return flagged.groupBy(*by).agg(
        F.count("*").alias("n_texts"),
        *[F.count_if(f"topic_{t}").alias(f"n_{t}") for t in topics],
    )
