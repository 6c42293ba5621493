"""Scalar expressions: dates, casts, labels, code parsing, safe arithmetic."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: status codes of the progress table and the day limit of the label
STATUS_PASSED = 4
STATUS_FAILED = 6
OUTCOME_WINDOW_DAYS = 365

# fixed values: ASCII punctuation and digits removed when cleaning text
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
DIGITS = "0123456789"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def year_of(d: Column | str) -> Column:
    return F.year(col(d)).cast("int")


def in_years(d: Column | str, start_year: int, end_year: int) -> Column:
    """``start_year <= year(d) <= end_year`` written on the bare column.

    Comparing the column itself with two date literals lets the scan skip row groups,
    which ``year(d)`` would not.
    """
    d = col(d)
    return (d >= F.lit(date(start_year, 1, 1))) & (d < F.lit(date(end_year + 1, 1, 1)))


def days_between(end: Column | str, start: Column | str) -> Column:
    return F.datediff(col(end), col(start)).cast("long")


def parse_iso_date(text: Column | str) -> Column:
    """``YYYY-MM-DD`` text to date; blank text is missing."""
    return F.to_date(F.nullif(F.trim(col(text)), F.lit("")), "yyyy-MM-dd")


def flag_letter(text: Column | str) -> Column:
    """``t``/``f`` to boolean."""
    t = F.lower(F.trim(col(text)))
    return F.when(t == "t", True).when(t == "f", False)


def id_list(text: Column | str) -> Column:
    """``"12, 45"`` to ``[12, 45]``."""
    parts = F.split(col(text), ",")
    return F.transform(parts, lambda x: F.trim(x).cast("bigint"))


def outcome_label(diff: Column | str, status: Column | str) -> Column:
    """Passed or Failed when decided inside the window, otherwise Failed_Final."""
    timely = col(diff) <= OUTCOME_WINDOW_DAYS
    return (
        F.when(timely & (col(status) == STATUS_FAILED), "Failed")
        .when(timely & (col(status) == STATUS_PASSED), "Passed")
        .otherwise("Failed_Final")
    )


def without_punctuation_and_digits(text: Column | str) -> Column:
    return F.translate(col(text), PUNCTUATION + DIGITS, "")


def _district_parts(code: Column | str) -> Column:
    return F.split(F.trim(col(code)), "-")


def district_chamber(code: Column | str) -> Column:
    """``SD-013`` is upper, ``HD-101`` is lower, anything else is null."""
    parts = _district_parts(code)
    house = F.when(F.size(parts) == 2, parts[0])
    return F.when(house == "SD", "upper").when(house == "HD", "lower")


def district_number(code: Column | str) -> Column:
    parts = _district_parts(code)
    return F.when(F.size(parts) == 2, parts[1].try_cast("int"))


def is_bad_district(code: Column | str) -> Column:
    """True where the code is not ``<chamber>-<number>``."""
    return F.coalesce(
        (F.size(_district_parts(code)) != 2) | district_number(code).isNull(), F.lit(True)
    )


def geometric_mean(a: Column | str, b: Column | str) -> Column:
    return F.sqrt(col(a) * col(b))


def clip01(x: Column | str) -> Column:
    return F.least(F.greatest(col(x), F.lit(0.0)), F.lit(1.0))


def ratio(num: Column | str, den: Column | str) -> Column:
    """Null, not an error, on a zero denominator."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def int_part(x: Column | str) -> Column:
    """Truncation of a non-negative double, as ``int(x)``."""
    return F.floor(col(x)).cast("long")


def present_or(value: Column | str, fallback) -> Column:
    return F.coalesce(col(value), fallback if isinstance(fallback, Column) else F.lit(fallback))


def normalized_header(name: str) -> str:
    """Lower case, ``#`` spelled ``num``, blanks as ``_``, other symbols dropped."""
    name = name.strip().lower().replace("#", "num").replace(" ", "_")
    return re.sub(r"\W", "", name)
