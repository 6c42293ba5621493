"""The fact with texts is built from the bills that have one and from their sessions alone."""

import re
from datetime import date

import pytest

from foretell.features.fit import block_features
from foretell.features.spec import FEATURE_SETS
from foretell.operators.splits import with_block_columns
from foretell.plans.standins import Relations


@pytest.fixture(scope="module")
def relations(spark, tmp_path_factory):
    """Twelve bills of three sessions; bills 1, 2 and 4 have a text of type 1, bill 11 is the last of their sessions."""
    folder = tmp_path_factory.mktemp("described")
    session = lambda k: 3 if k in (9, 10) else 1 + k % 2
    orders = [(k, session(k), date(1995, 1, k), "1-URGENT", "F" if k % 3 else "O", 10.0 * k) for k in range(1, 12)]
    lines = [(k, s) for k in range(1, 12) for s in {k % 4 + 1, 4}]
    rows = {
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderdate date, o_orderpriority string, o_orderstatus string, o_totalprice double"),
        "lineitem": (lines + lines[:5], "l_orderkey long, l_suppkey long"),
        "supplier": ([(s, s) for s in range(1, 5)], "s_suppkey long, s_nationkey long"),
        "documents": ([(k, f"tax bill {k}", "en", "web") for k in (3, 4, 5, 6, 12, 14, 33 * 3 + 1)], "doc_id long, text string, lang string, source string"),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{folder}/{name}.parquet")
    return Relations(spark, str(folder))


def test_sessions_keep_all_their_bills(relations):
    got = {r.bill_id: r for r in relations.described_facts.collect()}
    assert {k: r.bill_text for k, r in got.items()} == {1: "tax bill 4", 2: "tax bill 6", 4: "tax bill 14"}
    whole = {r.bill_id: r for r in relations.facts.collect()}
    assert all(got[k][c] == whole[k][c] for k in got for c in relations.facts.columns)
    assert got[1].session_end_date == date(1995, 1, 11) and got[2].session_end_date == date(1995, 1, 8)
    seats = {r.session_id: r for r in relations.chambers.collect()}
    assert all(got[k][c] == seats[1 + k % 2][c] for k in got for c in seats[1].asDict() if c != "session_id")


def test_sponsors_are_filtered_before_they_are_dealt(relations):
    plan = relations.described_facts._jdf.queryExecution().optimizedPlan().toString().splitlines()
    dealt = [k for k, line in enumerate(plan) if "RepartitionByExpression" in line]
    assert dealt and all(re.search("Join LeftSemi", "".join(plan[k + 1 : k + 3])) for k in dealt)


def test_slices_hold_only_what_the_features_read(relations, monkeypatch):
    from foretell.features import fit

    written = []
    keep = fit.cut_lineage
    monkeypatch.setattr(fit, "cut_lineage", lambda df: written.append(df.columns) or keep(df))
    facts = with_block_columns(relations.described_facts, "introduced_date", 1994, 1998, (2, 1, 1, 1))
    block_features(facts, FEATURE_SETS["no_text"], 1)
    assert any("sponsors" in columns for columns in written)
    assert not any("bill_text" in columns for columns in written)
