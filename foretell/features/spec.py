"""Feature specifications: which column goes through which operations, in order."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

# operations that read further columns, named in their parameters
SECONDARY_OPS = (
    "time_since_session_start", "time_till_session_end", "sponsor_pass_rate", "sponsor_total_bills",
)
TEXT_OPS = ("bow", "tfidf", "lda")
HISTORY_OPS = ("sponsor_pass_rate", "sponsor_total_bills")


@dataclass(frozen=True)
class FeatureSpec:
    """``ops`` maps a column (``column::i`` to use it again) to ``{operation: parameters}``."""

    ops: Mapping[str, Mapping[str, Any]]
    id_column: str = "bill_id"
    label_column: str = "status_new"

    @classmethod
    def from_config(cls, info: Mapping[str, Any]) -> FeatureSpec:
        """From a ``feature_info`` entry of a JSON configuration."""
        return cls(
            ops=info["feature_ops"],
            id_column=info.get("index_col_name", "bill_id"),
            label_column=info.get("label_col_name", "status_new"),
        )

    @staticmethod
    def column_of(key: str) -> str:
        return key.split("::")[0]

    def secondary_columns(self) -> set[str]:
        return {c for ops in self.ops.values() for op in SECONDARY_OPS for c in ops.get(op, ())}

    def columns(self, block_id: int | None = None) -> set[str]:
        """Every column the features, the label and the block filter need."""
        used = {self.column_of(k) for k in self.ops} | self.secondary_columns()
        used |= {self.id_column, self.label_column}
        return used | ({f"iter_{block_id}"} if block_id is not None else set())

    def has_history(self) -> bool:
        return any(op in ops for ops in self.ops.values() for op in HISTORY_OPS)

    def text_columns(self) -> list[str]:
        found = [self.column_of(k) for k, ops in self.ops.items() if any(o in TEXT_OPS for o in ops)]
        return list(dict.fromkeys(found))


# fixed values: columns, operations and names of the feature sets (to the end of the file)
# columns of the labelled fact that are only mean-imputed
COMPOSITION = ["dem_senate_perc", "rep_senate_perc", "dem_house_perc", "rep_house_perc"]
SPONSOR_COUNTS = ["sponsor_count", "rep_sponsor_count", "sen_sponsor_count"]
CENSUS = [
    "population", "median_age", "median_income", "female_ratio", "black_ratio", "asian_ratio",
    "white_ratio", "high_education", "unemployment", "poverty",
]


def _categories() -> dict:
    return {
        "party_id": {"impute_fixed": 0, "one_hot": 3},
        "introduced_body": {"impute_fixed": "H", "one_hot": ["H", "S"]},
    }


def _session_days(**after) -> dict:
    return {
        "introduced_date": {"time_since_session_start": ["session_start_date"], **after},
        "introduced_date::2": {"time_till_session_end": ["session_end_date"], **after},
    }


def _history() -> dict:
    outcome = ["introduced_date", "status_new"]
    return {
        "sponsors": {"sponsor_pass_rate": outcome, "impute_mean": []},
        "sponsors::2": {"sponsor_total_bills": outcome, "impute_mean": []},
    }


def _mean_imputed() -> dict:
    return {c: {"impute_mean": []} for c in COMPOSITION + SPONSOR_COUNTS + CENSUS}


def _texts(*columns: str) -> dict:
    return {c: {"tfidf": []} for c in columns}


def _mixed(*texts: str) -> dict:
    days = _session_days(impute_mean=[])
    return _categories() | days | _history() | _texts(*texts) | _mean_imputed()


FEATURE_SETS: dict[str, FeatureSpec] = {
    "description_only": FeatureSpec(_texts("bill_description")),
    "text_only": FeatureSpec(_texts("bill_text")),
    "description_text": FeatureSpec(_texts("bill_description", "bill_text")),
    "no_text": FeatureSpec(
        _categories() | _session_days(impute_median=[], normalize=[]) | _history() | _mean_imputed()
    ),
    "hybrid_description": FeatureSpec(_mixed("bill_description")),
    "hybrid_text": FeatureSpec(_mixed("bill_text")),
    "all": FeatureSpec(_mixed("bill_description", "bill_text")),
    "dummy": FeatureSpec(
        _categories() | {"sponsors": _history()["sponsors"]}
    ),
    "baseline": FeatureSpec({"bill_id": {}}),
}
