"""Registered queries: feature operations, specifications and text features."""

from __future__ import annotations

from functools import partial

from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from foretell.features import columns as C
from foretell.features import text as TX
from foretell.features.fit import block_features, fit_features, one_hot_frame, vector_entries, with_history
from foretell.features.spec import FEATURE_SETS, FeatureSpec
from foretell.functions.scalar import id_list
from foretell.operators.history import delayed_history, sponsors_from_list
from foretell.operators.splits import TRAIN, block_slice, with_block_columns
from foretell.plans.catalog_functions import TOKENS, new_schema
from foretell.plans.catalog_relational import HISTORY, role_sql
from foretell.plans.registry import query, r6, rounded
from foretell.plans.standins import sql_with
from foretell.session import cut_lineage, scratch_path, small_table
from foretell.sources import tables

YEARS = (1995, 2001)


def fitted_columns(df, ops, id_column, label="source", train=None):
    """Features of one specification, fitted on ``train`` (default: all rows)."""
    spec = FeatureSpec(ops, id_column, label)
    fitted = fit_features(df if train is None else train, spec)
    return fitted.columns(df).drop("label")


DOCS = "labelled_documents"


@query("E1_impute_mean", sql_with(DOCS, f"SELECT doc_id, round(coalesce(quality, (SELECT avg(quality) FROM {DOCS})), 6) AS quality FROM {DOCS}"))
def e1(t):
    return rounded(fitted_columns(t.labelled_documents, {"quality": {"impute_mean": []}}, "doc_id"), "quality")


@query("E2_impute_median", sql_with(DOCS, f"SELECT doc_id, CAST(coalesce(quality, (SELECT median(quality) FROM {DOCS})) AS DOUBLE) AS quality FROM {DOCS}"))
def e2(t):
    return fitted_columns(t.labelled_documents, {"quality": {"impute_median": []}}, "doc_id")


@query("E3_impute_fixed", sql_with(DOCS, f"SELECT doc_id, CAST(coalesce(quality, 0) AS DOUBLE) AS quality, CAST(coalesce(toxic, 7) AS DOUBLE) AS toxic FROM {DOCS}"))
def e3(t):
    ops = {"quality": {"impute_fixed": []}, "toxic": {"impute_fixed": 7}}
    return fitted_columns(t.labelled_documents, ops, "doc_id")


def hot_sql(column: str, values, prefix: str = "") -> str:
    return ", ".join(
        f"CASE WHEN {column} = {v!r} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"{prefix or column}_{v}\"" for v in values
    )


LANGS = ["de", "en", "es", "fr"]


@query(
    "E4_one_hot",
    sql_with(DOCS, f"SELECT doc_id, {hot_sql('lang', LANGS)}, {hot_sql('quality', [0, 1, 2])}, {hot_sql('toxic', [1])} FROM {DOCS}"),
)
def e4(t):
    """Categories from the rows, as a count, and as a list; unknown and missing give zeros."""
    ops = {"lang": {"one_hot": []}, "quality": {"one_hot": 3}, "toxic": {"one_hot": [1]}}
    return fitted_columns(t.labelled_documents, ops, "doc_id")


@query("E4_one_hot_long", "SELECT doc_id, source AS category, dense_rank() OVER (ORDER BY source) - 1 AS idx FROM documents")
def e4_long(t):
    return C.one_hot_long(t.table("documents"), "doc_id", "source")


@query(
    "E4_one_hot_table",
    "WITH c AS (SELECT DISTINCT l_partkey FROM lineitem WHERE l_shipdate < DATE '1998-01-01'), "
    "k AS (SELECT l_partkey, row_number() OVER (ORDER BY l_partkey) - 1 AS idx FROM c) "
    "SELECT l_orderkey, l_linenumber, l_suppkey, idx AS place, (SELECT count(*) FROM c) AS size FROM lineitem LEFT JOIN k USING (l_partkey)",
)
def e4_table(t):
    """Parts as one sparse vector by a category table of early rows; a part that is new there has no entry."""
    rows = t.table("lineitem").withColumn("id", F.struct("l_orderkey", "l_linenumber", "l_suppkey"))
    spec = FeatureSpec({"l_partkey": {"one_hot_table": []}}, "id", "l_linestatus")
    fitted = fit_features(rows.where("l_shipdate < date'1998-01-01'"), spec)
    places = vector_entries("features")
    return fitted.transform(rows).select(
        "id.*", F.when(F.size(places) > 0, places[0]["at"]).cast("long").alias("place"),
        F.lit(len(fitted.layout()["l_partkey"])).cast("long").alias("size"),
    )


STATUSES = ["F", "O", "P"]


@query("E4b_one_hot_from_table", f"SELECT o_orderkey, {hot_sql('o_orderstatus', STATUSES)} FROM orders")
def e4b(t):
    schema = new_schema(t.spark)
    tables.table_from_query(t.spark, t.table("orders").select("o_orderstatus"), schema, "statuses")
    ops = {"o_orderstatus": {"one_hot": ["##from_db", ["o_orderstatus", "statuses", schema]]}}
    return fitted_columns(t.table("orders"), ops, "o_orderkey", "o_orderpriority")


@query("E5_mark_blanks", sql_with(DOCS, f"SELECT doc_id, coalesce(CAST(quality AS VARCHAR), 'Unknown') AS quality, quality IS NULL AS quality_is_null FROM {DOCS}"))
def e5(t):
    value, missing = C.mark_blanks("quality")
    return t.labelled_documents.select("doc_id", value.alias("quality"), missing.alias("quality_is_null"))


@query(
    "E6_normalize",
    "WITH r AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem WHERE l_shipdate < DATE '1998-01-01') "
    "SELECT l_orderkey, l_linenumber, l_partkey, round((l_extendedprice - lo) / (hi - lo), 6) AS l_extendedprice, l_discount FROM lineitem, r",
)
def e6(t):
    """Fitted on early rows, applied to all; discounts stay as they are."""
    rows = t.table("lineitem")
    spec = FeatureSpec({"l_extendedprice": {"normalize": []}, "l_discount": {"normalize": []}}, "l_orderkey", "l_linestatus")
    fitted = fit_features(rows.where("l_shipdate < date'1998-01-01'"), spec)
    low, high = dict(fitted.applied["l_extendedprice"])["normalize"]
    small = dict(fitted.applied["l_discount"])["normalize"]
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", r6(C.normalize("l_extendedprice", low, high)).alias("l_extendedprice"),
        C.normalize("l_discount", *small).alias("l_discount"),
    )


@query("E7_hash_column")
def e7(t):
    """Signed bucket of every document source."""
    return t.table("documents").select(
        "doc_id", C.hash_bucket("source", 64).alias("bucket"), C.hash_sign("source").alias("sign")
    )


@query("E7_buckets_by_value", "SELECT source, count(*) AS n, 1::BIGINT AS buckets, true AS inside FROM documents GROUP BY source")
def e7_buckets(t):
    """Equal values share one bucket below the size, and one sign."""
    rows = e7(t).join(t.table("documents").select("doc_id", "source"), "doc_id")
    return rows.groupBy("source").agg(
        F.count("*").alias("n"), F.countDistinct("bucket", "sign").alias("buckets"),
        F.bool_and(F.col("bucket").between(0, 63) & F.abs("sign").isin(1.0)).alias("inside"),
    )


@query("E7_hash_vector", "SELECT doc_id, 1.0::DOUBLE AS norm, 64 AS size FROM documents")
def e7_vector(t):
    """The hashed column as a sparse vector: one entry of size 1 per row."""
    spec = FeatureSpec({"source": {"hash_column": {"n_features": 64}}}, "doc_id", "lang")
    docs = t.table("documents")
    values = vector_to_array("features")
    rows = fit_features(docs, spec).transform(docs)
    total = F.aggregate(F.transform(values, F.abs), F.lit(0.0), lambda a, x: a + x)
    return rows.select("doc_id", total.alias("norm"), F.size(values).alias("size"))


@query(
    "E8_time_since_session_start",
    sql_with("facts", "SELECT bill_id, CAST(introduced_date - session_start_date AS DOUBLE) AS time_since_session_start FROM facts"),
)
def e8(t):
    return fitted_columns(t.facts, {"introduced_date": {"time_since_session_start": ["session_start_date"]}}, "bill_id", "status_new")


@query(
    "E9_time_till_session_end",
    sql_with("facts", "SELECT bill_id, CAST(session_end_date - introduced_date AS DOUBLE) AS time_till_session_end FROM facts"),
)
def e9(t):
    return fitted_columns(t.facts, {"introduced_date": {"time_till_session_end": ["session_end_date"]}}, "bill_id", "status_new")


@query("E10_sponsor_history_from_lists", sql_with("outcomes sponsors", f"SELECT * FROM ({HISTORY}) WHERE bill_id IN (SELECT bill_id FROM sponsors)"))
def e10(t):
    """History computed from the packed sponsor lists of the fact."""
    bridge = sponsors_from_list(t.facts, "bill_id", "sponsors")
    return rounded(delayed_history(t.facts, bridge), "sponsor_pass_rate")


COUNTS = f"SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, {TOKENS.format(c='text')} AS term FROM documents) GROUP BY 1, 2"


@query("E11_bow", COUNTS)
def e11(t):
    docs = t.table("documents")
    return TX.bow_long(docs, "doc_id", "text", TX.vocabulary(docs, ["text"]))


def term_totals(rows, n_terms):
    """Sum and document count per vector position, of the stored entries of every row's vector."""
    entries = rows.select(F.explode(vector_entries("features")).alias("e")).where("e.value != 0")
    sums = entries.groupBy(F.col("e.at").cast("long").alias("idx")).agg(F.count("*").alias("df"), F.sum("e.value").alias("total"))
    places = rows.sparkSession.range(n_terms).withColumnRenamed("id", "idx").join(sums, "idx", "left")
    return places.select("idx", F.coalesce("df", F.lit(0)).alias("df"), r6(F.coalesce("total", F.lit(0.0))).alias("total"))


@query(
    "E11_bow_vector",
    f"SELECT row_number() OVER (ORDER BY term) - 1 AS idx, count(*) AS df, CAST(sum(tf) AS DOUBLE) AS total FROM ({COUNTS}) GROUP BY term",
)
def e11_vector(t):
    """Count vectors of every document, summed up per vocabulary position."""
    docs = t.table("documents")
    fitted = fit_features(docs, FeatureSpec({"text": {"bow": []}}, "doc_id", "lang"))
    return term_totals(fitted.transform(docs), fitted.size())


IDF = """SELECT term, ln((1 + (SELECT count(*) FROM {docs}))::DOUBLE / (1 + count(*))) + 1 AS idf FROM {counts} GROUP BY 1"""
TFIDF = """SELECT doc_id, term, round(tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id)), 6) AS weight
    FROM counts JOIN idf USING (term)"""


@query("E12_tfidf", f"WITH counts AS ({COUNTS}), idf AS ({IDF.format(docs='documents', counts='counts')}) {TFIDF}")
def e12(t):
    return rounded(TX.tfidf_long(t.table("documents"), "doc_id", "text"), "weight")


@query(
    "E12_tfidf_vector",
    f"WITH counts AS ({COUNTS}), idf AS ({IDF.format(docs='documents', counts='counts')}), w AS ("
    "SELECT term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id)) AS weight FROM counts JOIN idf USING (term)) "
    "SELECT row_number() OVER (ORDER BY term) - 1 AS idx, count(*) AS df, round(sum(weight), 6) AS total FROM w GROUP BY term",
)
def e12_vector(t):
    docs = t.table("documents")
    fitted = fit_features(docs, FeatureSpec({"text": {"tfidf": []}}, "doc_id", "lang"))
    return term_totals(fitted.transform(docs), fitted.size())


@query("E13_lda_topics")
def e13(t):
    docs = t.table("documents")
    fitted = fit_features(docs, FeatureSpec({"text": {"lda": 5}}, "doc_id", "lang"))
    return fitted.transform(docs).select("doc_id", vector_to_array("features").alias("topics"))


@query("E13_topic_shares", "SELECT doc_id, 5 AS topics, 1.0::DOUBLE AS total FROM documents")
def e13_shares(t):
    """A document's topic shares are k numbers from 0 to 1 that sum to 1."""
    shares = e13(t).where(F.forall("topics", lambda x: x.between(0, 1)))
    total = F.aggregate("topics", F.lit(0.0), lambda a, x: a + x)
    return shares.select("doc_id", F.size("topics").alias("topics"), r6(total).alias("total"))


@query(
    "E14_labels",
    sql_with(
        "outcomes",
        "SELECT bill_id, CASE WHEN status_new = 'Passed' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label, "
        "CASE WHEN s = 'Passed' THEN 1.0::DOUBLE WHEN s = 'Failed' THEN 0.0::DOUBLE ELSE 2.0::DOUBLE END AS label_3, "
        "CASE WHEN status_new = 'Passed' THEN '0.0,1.0' ELSE '1.0,0.0' END AS hot "
        "FROM (SELECT *, CASE WHEN introduced_date < DATE '1997-01-01' THEN 'Failed_Final' ELSE status_new END AS s FROM outcomes)",
    ),
)
def e14(t):
    early = F.when(F.col("introduced_date") < "1997-01-01", "Failed_Final").otherwise(F.col("status_new"))
    hot = F.transform(C.label_one_hot("status_new", "binary"), lambda x: x.cast("string"))
    return t.outcomes.select(
        "bill_id", C.label("status_new").alias("label"), C.label(early, "ternary").alias("label_3"),
        F.array_join(hot, ",").alias("hot"),
    )


MIXED = {
    "party_id": {"impute_fixed": 0, "one_hot": 3},
    "introduced_body": {"impute_fixed": "H", "one_hot": ["H", "S"]},
    "introduced_date": {"time_since_session_start": ["session_start_date"], "impute_median": [], "normalize": []},
    "introduced_date::2": {"time_till_session_end": ["session_end_date"], "impute_median": [], "normalize": []},
    "sponsors": {"sponsor_pass_rate": ["introduced_date", "status_new"], "impute_mean": []},
    "sponsors::2": {"sponsor_total_bills": ["introduced_date", "status_new"], "impute_mean": []},
    "sponsor_count": {"impute_mean": []},
    "rep_sponsor_count": {"impute_mean": []},
}
MIXED_SPEC = FeatureSpec(MIXED)
# history drawn from all rows, statistics from the training rows of block 2
MIXED_VIEWS = {
    "hist": HISTORY.replace("round(sum(h.passed)::DOUBLE / nullif(sum(h.total), 0), 6)", "sum(h.passed)::DOUBLE / nullif(sum(h.total), 0)"),
    "rows_": f"""SELECT f.*, h.sponsor_pass_rate, h.sponsor_total_bills, introduced_date - session_start_date AS since,
        session_end_date - introduced_date AS till, {role_sql(1, 1)} AS role FROM facts f JOIN hist h USING (bill_id)""",
    "fit": """SELECT avg(sponsor_pass_rate) AS rate, min(since) AS s0, max(since) AS s1, min(till) AS t0, max(till) AS t1
        FROM rows_ WHERE role = 1""",
    "features": f"""SELECT bill_id, role, CASE WHEN status_new = 'Passed' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label,
        {hot_sql('party_id', [0, 1, 2])}, {hot_sql('introduced_body', ['H', 'S'])},
        (since - s0)::DOUBLE / (s1 - s0) AS time_since_session_start, (till - t0)::DOUBLE / (t1 - t0) AS time_till_session_end,
        coalesce(sponsor_pass_rate, rate) AS sponsor_pass_rate, CAST(sponsor_total_bills AS DOUBLE) AS sponsor_total_bills,
        CAST(sponsor_count AS DOUBLE) AS sponsor_count, CAST(rep_sponsor_count AS DOUBLE) AS rep_sponsor_count FROM rows_, fit""",
}
MIXED_ROUNDED = ("time_since_session_start", "time_till_session_end", "sponsor_pass_rate")


_FACTS: dict[tuple, str] = {}


def blocked_facts(t, relation="facts"):
    """A stand-in fact with block columns, written once per session and data folder."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir, relation)
    if key not in _FACTS:
        path = scratch_path(t.spark, relation)
        with_block_columns(getattr(t, relation), "introduced_date", *YEARS, update_freq=1, type_val=1).write.parquet(path)
        _FACTS[key] = path
    return t.spark.read.parquet(_FACTS[key])


@query(
    "E15_feature_specification",
    sql_with(
        "facts outcomes sponsors",
        "SELECT * EXCLUDE (role) REPLACE (" + ", ".join(f"round({c}, 6) AS {c}" for c in MIXED_ROUNDED) + ") FROM features",
        **MIXED_VIEWS,
    ),
)
def e15(t):
    """One specification fitted on block 2's training rows, applied to every row, by name."""
    facts = cut_lineage(with_history(blocked_facts(t), MIXED_SPEC))
    fitted = fit_features(block_slice(facts, 2, TRAIN), MIXED_SPEC)
    return rounded(fitted.columns(facts), *MIXED_ROUNDED)


_TOTAL = " + ".join(
    f'"{c}"' for c in ("party_id_0", "party_id_1", "party_id_2", "introduced_body_H", "introduced_body_S",
                      "time_since_session_start", "time_till_session_end", "sponsor_pass_rate", "sponsor_total_bills",
                      "sponsor_count", "rep_sponsor_count")
)


@query(
    "E16_features_and_labels",
    sql_with(
        "facts outcomes sponsors",
        f"SELECT bill_id, CASE role WHEN 1 THEN 'train' ELSE 'validation' END AS role, label, 11 AS n_features, round({_TOTAL}, 6) AS total "
        "FROM features WHERE role IN (1, 3)",
        **MIXED_VIEWS,
    ),
)
def e16(t):
    """Feature vectors of both roles of block 2; the vector is summed for comparison."""
    _, train, valid = block_features(blocked_facts(t), MIXED_SPEC, 2, history="all")
    rows = train.withColumn("role", F.lit("train")).unionByName(valid.withColumn("role", F.lit("validation")))
    values = vector_to_array("features")
    return rows.select(
        "bill_id", "role", "label", F.size(values).alias("n_features"),
        r6(F.aggregate(values, F.lit(0.0), lambda a, x: a + x)).alias("total"),
    )


DAY_COLUMNS = {"introduced_date": ("time_since_session_start", "since"), "introduced_date::2": ("time_till_session_end", "till")}
HISTORY_COLUMNS = {"sponsors": "sponsor_pass_rate", "sponsors::2": "sponsor_total_bills"}
NAMED_SETS = [n for n in FEATURE_SETS if n not in ("dummy", "baseline")]


def named_set_sql(name: str) -> str:
    """Block 2 of a named set on the described fact: every scalar feature by name, and sum and norm of each text's part.

    Statistics and document frequencies are those of the training rows, history that of a row's own slice.
    """
    shown, fits = [], []
    for key, ops in FEATURE_SETS[name].ops.items():
        column = FeatureSpec.column_of(key)
        if "tfidf" in ops:
            shown += [f"round(coalesce({column}_w.total, 0), 6) AS {column}_total", f"round(coalesce({column}_w.norm, 0), 6) AS {column}_norm"]
        elif "one_hot" in ops:
            values = range(ops["one_hot"]) if isinstance(ops["one_hot"], int) else ops["one_hot"]
            shown.append(hot_sql(column, values))
        elif key in DAY_COLUMNS:
            feature, days = DAY_COLUMNS[key]
            fits += [f"median({days}) AS {days}_fill" if "impute_median" in ops else f"avg({days}) AS {days}_fill", f"min({days}) AS {days}_low", f"max({days}) AS {days}_high"]
            value = f"coalesce({days}, {days}_fill)::DOUBLE"
            if "normalize" in ops:
                value = f"CASE WHEN {days}_low < -10 OR {days}_high > 10 THEN ({value} - {days}_low) / ({days}_high - {days}_low) ELSE {value} END"
            shown.append(f"round({value}, 6) AS {feature}")
        else:
            column = HISTORY_COLUMNS.get(key, column)
            fits.append(f"avg({column}) AS {column}_fill")
            shown.append(f"round(coalesce({column}::DOUBLE, {column}_fill, 0), 6) AS {column}")
    views = {
        "slice_rows": f"SELECT * FROM (SELECT *, {role_sql(1, 1)} AS role FROM described_facts) WHERE role IN (1, 3)",
        "slice_hist": _SLICE.replace("dummy_rows", "slice_rows").replace("AS pass_rate FROM", "AS sponsor_pass_rate, coalesce(sum(total), 0)::DOUBLE AS sponsor_total_bills FROM"),
        "set_rows": "SELECT *, introduced_date - session_start_date AS since, session_end_date - introduced_date AS till FROM slice_rows JOIN slice_hist USING (bill_id)",
        "set_fit": f"SELECT {', '.join([*fits, 'count(*) AS one'])} FROM set_rows WHERE role = 1",
    }
    joins = ""
    for column in FEATURE_SETS[name].text_columns():
        views |= {
            f"{column}_t": f"SELECT bill_id, role, term, count(*) AS tf FROM (SELECT bill_id, role, {TOKENS.format(c=column)} AS term FROM set_rows) GROUP BY 1, 2, 3",
            f"{column}_idf": f"SELECT term, ln((1 + (SELECT count(*) FROM set_rows WHERE role = 1))::DOUBLE / (1 + count(*))) + 1 AS idf FROM {column}_t WHERE role = 1 GROUP BY 1",
            f"{column}_w": f"SELECT bill_id, sum(tf * idf) / sqrt(sum(tf * idf * tf * idf)) AS total, 1.0::DOUBLE AS norm FROM {column}_t JOIN {column}_idf USING (term) GROUP BY 1",
        }
        joins += f" LEFT JOIN {column}_w ON {column}_w.bill_id = r.bill_id"
    return sql_with(
        "described_facts sponsors",
        "SELECT r.bill_id, CASE role WHEN 1 THEN 'train' ELSE 'validation' END AS role, CASE WHEN status_new = 'Passed' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label, "
        f"{', '.join(shown)} FROM set_rows r CROSS JOIN set_fit{joins}", **views,
    )


def named_set(t, name: str):
    """Vectors of block 2 read back by the fitted layout: scalar features by name, sum and norm of each text's part."""
    fitted, train, valid = block_features(blocked_facts(t, "described_facts"), FEATURE_SETS[name], 2)
    rows = train.withColumn("role", F.lit("train")).unionByName(valid.withColumn("role", F.lit("validation")))
    names, layout = fitted.feature_names(), fitted.layout()
    texts = {key: places for key, places in layout.items() if key in fitted.text_models}
    scalar = [p for key, places in layout.items() if key not in texts for p in places]
    rows = rows.withColumn("entries", vector_entries("features"))
    if scalar:
        rows = VectorSlicer(inputCol="features", outputCol="scalars", indices=scalar).transform(rows)
        rows = rows.withColumn("scalars", vector_to_array("scalars"))
    shown = [r6(F.col("scalars")[k]).alias(names[p]) for k, p in enumerate(scalar)]
    for key, places in texts.items():
        part = F.filter("entries", lambda e: e["at"].between(places.start, places.stop - 1))
        total = F.aggregate(part, F.lit(0.0), lambda a, e: a + e["value"])
        norm = F.sqrt(F.aggregate(part, F.lit(0.0), lambda a, e: a + e["value"] * e["value"]))
        shown += [r6(total).alias(f"{key}_total"), r6(norm).alias(f"{key}_norm")]
    return rows.select("bill_id", "role", "label", *shown)


@query("E17_named_feature_set")
def e17(t):
    """The small named set on the stand-in fact, with history from the slice as written."""
    _, train, valid = block_features(blocked_facts(t), FEATURE_SETS["dummy"], 1)
    rows = train.withColumn("role", F.lit("train")).unionByName(valid.withColumn("role", F.lit("validation")))
    return rows.select("bill_id", "role", "label", vector_to_array("features").alias("features"))


@query(
    "E18_one_hot_every_column",
    "SELECT doc_id, 24 AS size, 2.0::DOUBLE AS ones, dense_rank() OVER (ORDER BY lang) - 1 AS first_one FROM documents",
)
def e18(t):
    """Language and source of every document as one vector (4 + 20 categories)."""
    rows = one_hot_frame(t.table("documents").select("doc_id", "lang", "source"), ["lang", "source"])
    v = vector_to_array("one_hot")
    return rows.select(
        "doc_id", F.size(v).alias("size"), F.aggregate(v, F.lit(0.0), lambda a, x: a + x).alias("ones"),
        (F.array_position(v, F.lit(1.0)) - 1).alias("first_one"),
    )


@query(
    "E19_one_pass_fit",
    sql_with(
        DOCS,
        "SELECT 'n_chars' AS feature, round(m, 6) AS fill, round(lo, 6)::DOUBLE AS low, round(hi, 6)::DOUBLE AS high FROM s "
        "UNION ALL SELECT 'quality', round(q, 6), 0, 1 FROM s",
        s=f"SELECT avg(n_chars) AS m, min(n_chars) AS lo, max(n_chars) AS hi, avg(quality) AS q FROM {DOCS}",
    ),
)
def e19(t):
    """Fill values and ranges of two columns come out of one aggregation."""
    spec = FeatureSpec({c: {"impute_mean": [], "normalize": []} for c in ("n_chars", "quality")}, "doc_id", "lang")
    applied = fit_features(t.labelled_documents.select("doc_id", "lang", "n_chars", "quality"), spec).applied
    rows = [(c, float(dict(ops)["impute_fixed"]), *map(float, dict(ops)["normalize"])) for c, ops in applied.items()]
    return rounded(small_table(t.spark, rows, "feature string, fill double, low double, high double"), "fill", "low", "high")


@query("Z1_operations_by_name", sql_with(DOCS, f"SELECT doc_id, CAST(coalesce(quality, 1) AS DOUBLE) AS quality FROM {DOCS}"))
def z1(t):
    return fitted_columns(t.labelled_documents, {"quality": {"impute_fixed": 1}}, "doc_id")


@query("X7_id_list_ints", sql_with("facts", "SELECT bill_id, len(string_split(sponsors, ',')) AS n, list_sum(list_transform(string_split(sponsors, ','), lambda x: CAST(trim(x) AS BIGINT))) AS total FROM facts"))
def x7_ints(t):
    ids = id_list("sponsors")
    return t.facts.select(
        "bill_id", F.size(ids).cast("long").alias("n"),
        F.aggregate(ids, F.lit(0).cast("long"), lambda a, x: a + x).alias("total"),
    )


_SLICE = """SELECT bill_id, sum(passed)::DOUBLE / nullif(sum(total), 0) AS pass_rate FROM (
    SELECT f.bill_id, f.role, s.sponsor_id, f.introduced_date FROM dummy_rows f JOIN sponsors s USING (bill_id)) f LEFT JOIN (
    SELECT role AS r, sponsor_id AS sp, introduced_date AS d, count(*) AS total, count(*) FILTER (status_new = 'Passed') AS passed
    FROM dummy_rows JOIN sponsors USING (bill_id) GROUP BY 1, 2, 3) e
    ON e.r = f.role AND e.sp = f.sponsor_id AND e.d < f.introduced_date - INTERVAL 365 DAY GROUP BY bill_id"""


@query(
    "E17_small_named_set",
    sql_with(
        "facts sponsors",
        "SELECT bill_id, CASE role WHEN 1 THEN 'train' ELSE 'validation' END AS role, CASE WHEN status_new = 'Passed' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label, "
        "party_id, introduced_body, round(coalesce(pass_rate, (SELECT coalesce(avg(pass_rate), 0) FROM dummy_rows JOIN dummy_hist USING (bill_id) WHERE role = 1)), 6) AS pass_rate "
        "FROM dummy_rows JOIN dummy_hist USING (bill_id)",
        dummy_rows=f"SELECT * FROM (SELECT *, {role_sql(1, 1)} AS role FROM facts) WHERE role IN (1, 3)", dummy_hist=_SLICE,
    ),
)
def e17_small(t):
    """The vectors of the named set read back: party, chamber and the sponsors' rate within the slice."""
    _, train, valid = block_features(blocked_facts(t), FEATURE_SETS["dummy"], 2)
    rows = train.withColumn("role", F.lit("train")).unionByName(valid.withColumn("role", F.lit("validation")))
    x = vector_to_array("features")
    party = F.when(x[0] == 1, 0).when(x[1] == 1, 1).when(x[2] == 1, 2)
    return rows.select(
        "bill_id", "role", "label", party.alias("party_id"), F.when(x[3] == 1, "H").when(x[4] == 1, "S").alias("introduced_body"), r6(x[5]).alias("pass_rate"))


for _name in NAMED_SETS:
    query(f"E17_{_name}", named_set_sql(_name))(partial(named_set, name=_name))
