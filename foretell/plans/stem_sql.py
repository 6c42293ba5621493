"""SQL for the stems of words, to compare the column expressions with: one view per step over distinct words."""

from __future__ import annotations

from foretell.functions.stemming import IRREGULAR, STEP_2, STEP_3, STEP_4


def _shape(x: str) -> str:
    plain = f"regexp_replace(translate({x}, 'vaeiou', 'cvvvvv'), '[^vy]', 'c', 'g')"
    letter = "CASE WHEN c <> 'y' THEN c WHEN right(a, 1) = 'c' THEN 'v' ELSE 'c' END"
    return (
        f"CASE WHEN contains({x}, 'yy') THEN list_reduce(list_prepend('', string_split({plain}, '')), lambda a, c: a || {letter}) "
        f"ELSE translate(replace({plain}, 'cy', 'cv'), 'y', 'c') END"
    )


def _short(n: int) -> str:
    return f"left(w, length(w) - {n})"


_ONCE, _TWICE = "contains(sh, 'vc')", "regexp_matches(sh, 'vc.*vc')"
_SHORT_END = "CASE WHEN length(x) = 2 THEN sh = 'vc' ELSE sh LIKE '%cvc' AND right(x, 1) NOT IN ('w', 'x', 'y') END"


def _suffix_views(name: str, source: str, suffixes, value: str) -> dict[str, str]:
    seen = "CASE WHEN suf = 'logi' THEN left(w, length(w) - 3) ELSE x END"
    return {
        f"{name}_suffix": f"SELECT word, low, w, regexp_extract(w, '(?:{'|'.join(suffixes)})$') AS suf FROM {source}",
        f"{name}_stem": f"SELECT *, left(w, length(w) - length(suf)) AS x FROM {name}_suffix",
        f"{name}_shape": f"SELECT *, {_shape(seen)} AS sh FROM {name}_stem",
        name: f"SELECT word, low, {value} AS w FROM {name}_shape",
    }


def _replaced(table) -> str:
    new = " ".join(f"WHEN '{s}' THEN '{n}'" for s, n in table)
    return f"CASE WHEN suf = '' OR NOT {_ONCE} THEN w ELSE x || CASE suf {new} END END"


def stem_views(words: str) -> dict[str, str]:
    """Views that end in ``stems(word, stem)``, for a view of distinct ``word``."""
    step = lambda source, x: f"SELECT *, {x} AS x, {_shape(x)} AS sh FROM {source}"
    return {
        "plural": f"""SELECT word, low, CASE WHEN w NOT LIKE '%s' THEN w WHEN w LIKE '%sses' THEN {_short(2)}
            WHEN w LIKE '%ies' THEN CASE WHEN length(w) = 4 THEN {_short(1)} ELSE {_short(2)} END WHEN w LIKE '%ss' THEN w ELSE {_short(1)} END AS w
            FROM (SELECT word, lower(word) AS low, lower(word) AS w FROM {words})""",
        "past_cut": "SELECT *, CASE WHEN w LIKE '%ing' OR w LIKE '%eed' THEN 3 WHEN w LIKE '%ed' THEN 2 ELSE 0 END AS cut FROM plural",
        "past_shape": step("past_cut", "left(w, length(w) - cut)"),
        "past": f"""SELECT word, low, CASE WHEN w LIKE '%ied' THEN CASE WHEN length(w) = 4 THEN {_short(1)} ELSE {_short(2)} END WHEN cut = 0 THEN w
            WHEN w LIKE '%eed' THEN CASE WHEN {_ONCE} THEN {_short(1)} ELSE w END WHEN NOT contains(sh, 'v') THEN w
            WHEN regexp_matches(x, '(at|bl|iz)$') THEN x || 'e'
            WHEN length(x) > 1 AND right(x, 1) = substr(x, length(x) - 1, 1) AND right(sh, 1) = 'c'
            THEN CASE WHEN right(x, 1) IN ('l', 's', 'z') THEN x ELSE left(x, length(x) - 1) END
            WHEN {_ONCE} AND NOT {_TWICE} AND {_SHORT_END} THEN x || 'e' ELSE x END AS w FROM past_shape""",
        "y_shape": step("past", _short(1)),
        "final_y": "SELECT word, low, CASE WHEN w LIKE '%y' AND length(w) > 2 AND right(sh, 1) = 'c' THEN x || 'i' ELSE w END AS w FROM y_shape",
        "alli_shape": step("final_y", _short(4)),
        "alli": f"SELECT word, low, CASE WHEN w LIKE '%alli' AND {_ONCE} THEN {_short(2)} ELSE w END AS w FROM alli_shape",
        **_suffix_views("second", "alli", [s for s, _ in STEP_2], _replaced(STEP_2)),
        **_suffix_views("third", "second", [s for s, _ in STEP_3], _replaced(STEP_3)),
        **_suffix_views(
            "fourth", "third", STEP_4,
            f"CASE WHEN suf = '' OR NOT {_TWICE} OR (suf = 'ion' AND right(x, 1) NOT IN ('s', 't')) THEN w ELSE x END",
        ),
        "e_shape": step("fourth", _short(1)),
        "final_e": f"SELECT word, low, CASE WHEN w LIKE '%e' AND ({_TWICE} OR ({_ONCE} AND NOT {_SHORT_END})) THEN x ELSE w END AS w FROM e_shape",
        "l_shape": step("final_e", _short(1)),
        "final_l": f"SELECT word, low, CASE WHEN w LIKE '%ll' AND {_TWICE} THEN {_short(1)} ELSE w END AS w FROM l_shape",
        "stems": "SELECT word, CASE low " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in IRREGULAR.items())
        + " ELSE CASE WHEN length(low) <= 2 THEN low ELSE w END END AS stem FROM final_l",
    }


def with_views(views: dict[str, str], body: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({q})" for n, q in views.items()) + " " + body


def stemmed_texts_sql(texts: str, clean: str) -> str:
    """``doc_id`` and the stemmed words of a query's ``clean`` column under the name ``clean``; missing stays missing."""
    views = {
        "cleaned": texts,
        "tokens": "SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM (SELECT doc_id, string_split(clean, ' ') AS ws FROM cleaned)",
        "token_words": "SELECT DISTINCT word FROM tokens",
        **stem_views("token_words"),
        "joined": "SELECT doc_id, string_agg(stem, ' ' ORDER BY pos) AS stemmed FROM tokens JOIN stems USING (word) GROUP BY 1",
    }
    return with_views(views, f"SELECT doc_id, stemmed AS {clean} FROM cleaned LEFT JOIN joined USING (doc_id)")
