"""CSV and text extracts: session dates, census extracts, variable lists."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foretell.functions.scalar import flag_letter, normalized_header
from foretell.operators.profile import assert_unique

SESSION_DATES = (
    "session_entry_id int, session_year int, state_name string, convene_date date, "
    "adjourn_date date, special string, notes string"
)
DISTRICT_RACES = (
    "state string, state_legislative_district_upper_chamber string, "
    "race_white long, race_black long, race_asian long"
)

# fixed values: key columns by geographic level, from coarse to fine
TOP_LEVELS = ("state", "us")
SECOND_LEVELS = (
    "county", "state_legislative_district_upper_chamber", "state_legislative_district_lower_chamber",
)
FOURTH_LEVELS = ("block_group", "block")


def read_session_dates(spark: SparkSession, path: str) -> DataFrame:
    """Session dates; notes may span lines, an empty date is missing, flags are t/f.

    Multi-line CSV cannot be split, so a file is one task: keep big extracts in many files.
    """
    raw = (
        spark.read.schema(SESSION_DATES)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )
    return raw.withColumn("special", flag_letter("special"))


def read_district_races(spark: SparkSession, path: str) -> DataFrame:
    """Census extract with codes kept as text (``001``, ``ZZZ``)."""
    return spark.read.schema(DISTRICT_RACES).option("header", True).csv(path)


def normalize_columns(df: DataFrame) -> DataFrame:
    names = [normalized_header(c) for c in df.columns]
    clash = sorted({n for n in names if names.count(n) > 1})
    if clash:
        raise ValueError(f"columns {clash} would collide")
    return df.toDF(*names)


def geography_keys(columns: Sequence[str]) -> list[str]:
    """Key columns of an extract, read off its leading columns."""
    keys = ["state" if columns[0] == "state" else "us"]
    if len(columns) > 1 and columns[1] in SECOND_LEVELS:
        keys.append(columns[1])
    if len(columns) > 2 and columns[2] == "tract":
        keys.append("tract")
    if len(columns) > 3 and columns[3] in FOURTH_LEVELS:
        keys.append(columns[3])
    return keys


def keyed_extract(df: DataFrame) -> DataFrame:
    """Normalised extract whose geography columns are checked to be a key."""
    named = normalize_columns(df)
    return assert_unique(named, geography_keys(named.columns))


def flatten_geography(df: DataFrame, column: str, levels: Sequence[str]) -> DataFrame:
    """An array of (level, code) pairs to one leading code column per level."""
    codes = [
        F.get(F.col(column), i)["code"].alias(normalized_header(name))
        for i, name in enumerate(levels)
    ]
    return df.select(*codes, *[c for c in df.columns if c != column])


def concat_geographies(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def read_variable_list(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``('code', 'header', 'label')`` as columns."""
    pattern = r"""^\(\s*'([^']*)'\s*,\s*'([^']*)'\s*,\s*['"](.*)['"]\s*\)\s*$"""
    line = F.col("value")
    return spark.read.text(path).where(line.rlike(pattern)).select(
        *[F.regexp_extract(line, pattern, i).alias(n) for i, n in enumerate(("code", "header", "label"), 1)]
    )


def rename_by_variables(df: DataFrame, variables: DataFrame) -> DataFrame:
    """Column codes to their headers; the list has one row per column of ``df``."""
    known = variables.where(F.col("code").isin(list(df.columns))).select("code", "header")
    return df.withColumnsRenamed({r.code: r.header for r in known.collect()})


def search_variables(catalog: DataFrame, keyword: str) -> DataFrame:
    return catalog.where(F.lower("label").contains(keyword.lower()))


def csv_text(df: DataFrame) -> DataFrame:
    """Flags as t/f and dates as text, ready for a CSV writer."""

    def text(f: T.StructField):
        c = F.col(f.name)
        if isinstance(f.dataType, T.BooleanType):
            c = F.when(c, "t").when(~c, "f")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        return c.alias(f.name)

    return df.select(*[text(f) for f in df.schema.fields])
