"""English suffix stripping after M. F. Porter, "An algorithm for suffix stripping" (1980).

The suffix tables below are the published ones together with the widely used later
amendments (irregular words, short words, ``-ied``, ``-logi``, ``-fulli``, final ``y``
only after a consonant). Texts are stemmed where they are read, without a shuffle of words: batches of them go to a
Python worker, which stems a distinct word of a batch once and remembers the words it had.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from foretell.functions.scalar import col
from foretell.session import ship_package

#: Letters of a word up to which its stem is remembered.
LONGEST_REMEMBERED = 40

# fixed values: irregular words
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

# fixed values: suffix tables of steps 2 to 4, in published order
STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"),
    ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"),
    ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
    ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful"), ("logi", "log"),
)
STEP_3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
)
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
    "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)


def _by_last_letter(table):
    """Suffix entries grouped by last letter, keeping their order."""
    groups: dict[str, list] = {}
    for entry in table:
        suffix = entry if isinstance(entry, str) else entry[0]
        groups.setdefault(suffix[-1], []).append(entry)
    return groups


_STEP_2, _STEP_3, _STEP_4 = map(_by_last_letter, (STEP_2, STEP_3, STEP_4))
_VOWEL = re.compile("[aeiou]")
_CONSONANT = re.compile("[^vy]")
_Y_RUN = re.compile("(^|[cv])(y+)")


def _alternate(run: re.Match) -> str:
    letters = [run[1]]
    for _ in run[2]:
        letters.append("v" if letters[-1] == "c" else "c")
    return "".join(letters)


def _shape(word: str) -> str:
    """The word as a string of c and v; ``y`` is a vowel after a consonant."""
    shape = _CONSONANT.sub("c", _VOWEL.sub("v", word.replace("v", "c")))
    if "y" in shape:
        shape = _Y_RUN.sub(_alternate, shape)
    return shape


def _measure(stem: str) -> int:
    return _shape(stem).count("vc")


def _short_end(stem: str) -> bool:
    shape = _shape(stem)
    if len(stem) == 2:
        return shape == "vc"
    return shape.endswith("cvc") and stem[-1] not in "wxy"


def _double_consonant(stem: str) -> bool:
    return len(stem) > 1 and stem[-1] == stem[-2] and _shape(stem)[-1] == "c"


def _plural(w: str) -> str:
    if w.endswith("sses"):
        return w[:-2]
    if w.endswith("ies"):
        return w[:-1] if len(w) == 4 else w[:-2]
    return w[:-1] if w.endswith("s") and not w.endswith("ss") else w


def _past(w: str) -> str:
    if w.endswith("ied"):
        return w[:-1] if len(w) == 4 else w[:-2]
    if w.endswith("eed"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    cut = next((n for s, n in (("ed", 2), ("ing", 3)) if w.endswith(s) and "v" in _shape(w[:-n])), 0)
    if not cut:
        return w
    w = w[:-cut]
    if w.endswith(("at", "bl", "iz")):
        return w + "e"
    if _double_consonant(w):
        return w if w[-1] in "lsz" else w[:-1]
    return w + "e" if _measure(w) == 1 and _short_end(w) else w


def _final_y(w: str) -> str:
    long_enough = len(w) > 2 and _shape(w[:-1])[-1] == "c"
    return w[:-1] + "i" if w.endswith("y") and long_enough else w


def _first_suffix(w: str, table) -> str:
    for suffix, new in table.get(w[-1:], ()):
        if w.endswith(suffix):
            stem = w[: -len(suffix)]
            seen = w[:-3] if suffix == "logi" else stem
            return stem + new if _measure(seen) > 0 else w
    return w


def _double_suffix(w: str) -> str:
    while w.endswith("alli") and _measure(w[:-4]) > 0:
        w = w[:-2]
    return _first_suffix(w, _STEP_2)


def _long_suffix(w: str) -> str:
    suffix = next((s for s in _STEP_4.get(w[-1:], ()) if w.endswith(s)), None)
    if suffix is None:
        return w
    stem = w[: -len(suffix)]
    kept = suffix == "ion" and not stem.endswith(("s", "t"))
    return w if kept or _measure(stem) < 2 else stem


def _final_e(w: str) -> str:
    if w.endswith("e"):
        m = _measure(w[:-1])
        if m > 1 or (m == 1 and not _short_end(w[:-1])):
            return w[:-1]
    return w


def _final_l(w: str) -> str:
    return w[:-1] if w.endswith("ll") and _measure(w[:-1]) > 1 else w


def _stem(word: str) -> str:
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    word = _final_y(_past(_plural(word)))
    word = _first_suffix(_double_suffix(word), _STEP_3)
    return _final_l(_final_e(_long_suffix(word)))


_remembered = lru_cache(maxsize=200_000)(_stem)


def _lower_stem(word: str) -> str:
    return _remembered(word) if len(word) <= LONGEST_REMEMBERED else _stem(word)


def stem_word(word: str) -> str:
    return _lower_stem(word.lower())


def stem_texts(texts: pa.Array) -> pa.Array:
    """Each blank-separated word of lower-case texts stemmed, a distinct word of the batch once."""
    words = pc.split_pattern(texts, " ")
    coded = words.values.dictionary_encode()
    stems = pa.array([_lower_stem(w) for w in coded.dictionary.to_pylist()], coded.dictionary.type)
    stemmed = pa.ListArray.from_arrays(words.offsets, stems.take(coded.indices), mask=texts.is_null())
    return pc.binary_join(stemmed, " ")


def stem_words(text: Column | str) -> Column:
    """Each blank-separated word of a text stemmed. A missing text stays missing."""
    ship_package(SparkSession.active())
    # lowered by the JVM, which also leaves no bytes that Python cannot read
    return F.arrow_udf(stem_texts, "string")(F.lower(col(text)))
