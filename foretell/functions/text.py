"""Text expressions: tokens, stopwords, cleaning, keyword flags."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from foretell.functions.scalar import col, without_punctuation_and_digits
from foretell.functions.stemming import stem_words

# fixed values: the English stopword list
STOPWORDS = tuple(
    """
    i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself
    yourselves he him his himself she she's her hers herself it it's its itself they them
    their theirs themselves what which who whom this that that'll these those am is are was
    were be been being have has had having do does did doing a an the and but if or because
    as until while of at by for with about against between into through during before after
    above below to from up down in out on off over under again further then once here there
    when where why how all any both each few more most other some such no nor not only own
    same so than too very s t can will just don don't should should've now d ll m o re ve y
    ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven
    haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn
    shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
    """.split()
)

# fixed values: fused words split in two when tokenising
FUSED_WORDS = (
    ("can", "not"), ("gim", "me"), ("lem", "me"), ("gon", "na"), ("wan", "na"), ("got", "ta"),
)
_FUSED = r"\b(" + "|".join(rf"{head}(?={tail}\b)" for head, tail in FUSED_WORDS) + ")"

# fixed values: keyword topics counted per group
TOPICS = {
    "immigration": (
        "immigrant|immigration|visa|undocumented|sanctuary cit|"
        "deferred action for childhood arrivals|daca|h-1b|illegal alien|non-citizen|"
        "noncitizen|first gen|1st gen|deport|asylum|migrant|foreign worker"
    ),
    "asian": "china|chinese|asia|asian|korea|japan|india",
    "african": "africa|african american",
}


def word_tokens(text: Column | str) -> Column:
    """Lower-cased runs of two or more word characters, in text order."""
    return F.regexp_extract_all(F.lower(col(text)), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))


def whitespace_tokens(text: Column | str) -> Column:
    return F.filter(F.split(F.trim(col(text)), r"\s+"), lambda t: t != "")


def drop_stopwords(tokens: Column | str, stopwords: Iterable[str] = STOPWORDS) -> Column:
    """Case-sensitive removal; the literal list becomes one hash-set test per token."""
    words = list(stopwords)
    return F.filter(col(tokens), lambda t: ~t.isin(words))


def clean_tokens(text: Column | str, stopwords: Iterable[str] = STOPWORDS) -> Column:
    """Strip, lower, drop punctuation and digits, split, drop stopwords."""
    plain = without_punctuation_and_digits(F.lower(F.trim(col(text))))
    return drop_stopwords(whitespace_tokens(F.regexp_replace(plain, _FUSED, "$1 ")), stopwords)


def clean_text(
    text: Column | str, stopwords: Iterable[str] = STOPWORDS, stem: bool = True
) -> Column:
    """Cleaned words joined by one blank; a missing text stays missing."""
    words = F.array_join(clean_tokens(text, stopwords), " ")
    return stem_words(words) if stem else words


def keyword_flag(text: Column | str, pattern: str) -> Column:
    """True where the lower-cased text matches; a missing text does not."""
    return F.coalesce(F.lower(col(text)).rlike(pattern), F.lit(False))
