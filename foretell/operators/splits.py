"""Temporal train/validation assignment, by year blocks and by calendar periods."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foretell.functions.scalar import in_years
from foretell.operators.joins import in_range
from foretell.session import scratch_path, small_table

# fixed values: role codes of a row inside a temporal block
UNUSED, TRAIN, TRAIN_BUFFER, VALIDATION, VALIDATION_BUFFER = 0, 1, 2, 3, 4


def block_starts(
    start_year: int, end_year: int, split_list: Sequence[int] = (2, 1, 1, 1), update_freq: int = 2
) -> list[int]:
    """Number of skipped years of each block that still fits into the years."""
    room = end_year - start_year + 1 - sum(split_list)
    return list(range(0, room + 1, update_freq)) if room >= 0 else []


def block_roles(skipped: int, n_years: int, split_list: Sequence[int], before: int) -> list[int]:
    """Role of every year of the range for a block that skips ``skipped`` years."""
    roles = [before] * skipped
    for role, length in enumerate(split_list, start=TRAIN):
        roles += [role] * length
    return (roles + [UNUSED] * n_years)[:n_years]


def with_block_columns(
    df: DataFrame,
    date_column: str,
    start_year: int = 2009,
    end_year: int = 2019,
    split_list: Sequence[int] = (2, 1, 1, 1),
    update_freq: int = 2,
    type_val: int = 0,
) -> DataFrame:
    """Columns ``iter_1 .. iter_n`` with the row's role in each block, in one projection.

    ``type_val`` is the role of the years before a block: 0 rolls the training window,
    1 expands it. Rows outside the years (or without a date) get null.
    """
    n_years = end_year - start_year + 1
    index = F.year(date_column) - start_year + 1
    inside = in_years(date_column, start_year, end_year)
    columns = {}
    for i, skipped in enumerate(block_starts(start_year, end_year, split_list, update_freq), 1):
        roles = block_roles(skipped, n_years, split_list, type_val)
        by_year = F.element_at(F.array(*[F.lit(r) for r in roles]), index)
        columns[f"iter_{i}"] = F.when(inside, by_year)
    return df.withColumns(columns)


def block_count(df: DataFrame) -> int:
    return sum(1 for c in df.columns if c.startswith("iter_"))


def long_blocks(df: DataFrame) -> DataFrame:
    """One row per fact row and block, columns ``block_id`` and ``role``; nulls left out.

    Written with ``partitionBy("block_id", "role")`` a block is read by partition pruning.
    """
    blocks = [c for c in df.columns if c.startswith("iter_")]
    kept = [c for c in df.columns if c not in blocks]
    pairs = F.array(
        *[
            F.struct(F.lit(int(c[5:])).alias("block_id"), F.col(c).cast("int").alias("role"))
            for c in blocks
        ]
    )
    used = F.filter(pairs, lambda p: p["role"].isNotNull())
    return df.select(*kept, F.explode(used).alias("__b")).select(*kept, "__b.block_id", "__b.role")


def block_slice(df: DataFrame, block_id: int, role: int) -> DataFrame:
    """Rows of one role of one block, from wide or long form."""
    if "block_id" in df.columns:
        return df.where((F.col("block_id") == block_id) & (F.col("role") == role))
    return df.where(F.col(f"iter_{block_id}") == role)


def block_summary(long_form: DataFrame, label: str) -> DataFrame:
    """Rows, positives and share of positives per block and role."""
    return long_form.groupBy("block_id", "role").agg(
        F.count("*").alias("n"),
        F.sum(label).cast("long").alias("positives"),
        F.avg(F.col(label).cast("double")).alias("base_rate"),
    )


def _shift(day: date, freq: str, amount: int) -> date:
    """Calendar step; a month step keeps the day of month where the month has it."""
    if freq in ("months", "years"):
        months = day.year * 12 + day.month - 1 + amount * (12 if freq == "years" else 1)
        year, month = divmod(months, 12)
        next_month = date(year + (month == 11), (month + 1) % 12 + 1, 1)
        return date(year, month + 1, min(day.day, (next_month - timedelta(days=1)).day))
    if freq not in ("weeks", "days", "hours", "minutes", "seconds"):
        raise ValueError(f"unknown period unit {freq!r}")
    # on whole days, a step below one day has no effect
    return day + timedelta(days=timedelta(**{freq: amount}).days)


class CalendarSplits:
    """Rolling train/test periods in calendar units.

    Train covers ``[s, s + train)``, test ``[e + gap, e + gap + test)`` with ``e`` the end of
    train; each split starts one test period later, while the test ends before the last day.
    """

    def __init__(self, train_period: int = 30, test_period: int = 7, freq: str = "days"):
        self.train_period, self.test_period, self.freq = train_period, test_period, freq
        self.n_splits = 0

    def periods(self, first: date, last: date, start: date | None = None, gap: int = 0):
        """``(split, role, start, end)`` for data between two days."""

        def step(d: date, n: int) -> date:
            return _shift(d, self.freq, n)

        begin = step(start or step(first, self.train_period), -self.train_period)
        out, split = [], 0
        while True:
            end_train = step(begin, self.train_period)
            start_test = step(end_train, gap)
            end_test = step(start_test, self.test_period)
            if end_test >= last:
                break
            split += 1
            out.append((split, "train", begin, end_train))
            out.append((split, "test", start_test, end_test))
            moved = step(begin, self.test_period)
            if moved <= begin:
                raise ValueError("the test period does not move the split forward")
            begin = moved
        self.n_splits = split
        return out

    def split_table(
        self, df: DataFrame, date_column: str, start: date | None = None, gap: int = 0
    ) -> DataFrame:
        if date_column not in df.columns:
            raise KeyError(date_column)
        day = F.col(date_column).cast("date")
        span = df.agg(F.min(day).alias("first"), F.max(day).alias("last")).first()
        rows = [] if span.first is None else self.periods(span.first, span.last, start, gap)
        return small_table(
            df.sparkSession, rows, "split int, role string, start_date date, end_date date"
        )

    def split(
        self, df: DataFrame, date_column: str, start: date | None = None, gap: int = 0
    ) -> DataFrame:
        """``df`` with columns ``split`` and ``role``; a row may be in many splits.

        The periods are unrolled to days, so rows meet them in an equi-join on the day. The
        calendar is written first, which gives the planner its true size for the choice of join.
        """
        periods = self.split_table(df, date_column, start, gap)
        days = F.sequence("start_date", F.date_sub("end_date", 1))
        filled = periods.where("start_date < end_date")
        path = scratch_path(df.sparkSession, "calendar")
        filled.select("split", "role", F.explode(days).alias("day")).write.parquet(path)
        calendar = df.sparkSession.read.parquet(path)
        return in_range(df, calendar, date_column)

    def get_n_splits(self) -> int:
        return self.n_splits
