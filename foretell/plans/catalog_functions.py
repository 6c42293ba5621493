"""Registered queries: sources, projections, scalar functions, texts, splits, groups, metrics."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from foretell.features.text import vocabulary
from foretell.functions import scalar as X
from foretell.functions.text import (
    FUSED_WORDS,
    TOPICS,
    clean_text,
    drop_stopwords,
    keyword_flag,
    whitespace_tokens,
    word_tokens,
)
from foretell.functions.stemming import stem_words
from foretell.operators import groups as G
from foretell.operators import metrics as M
from foretell.operators import textstats as TS
from foretell.operators.joins import members_only
from foretell.operators.preprocess import preprocess
from foretell.operators.profile import (
    box_plots,
    correlations,
    duplicate_keys,
    missing_values,
    status_distributions,
)
from foretell.operators.splits import (
    TRAIN,
    CalendarSplits,
    block_slice,
    long_blocks,
    with_block_columns,
)
from foretell.plans.catalog_relational import (
    BLOCK_ROLES,
    BOX,
    CORR,
    DETAIL,
    FACT,
    FACT_TABLES,
    FINAL_TEXT,
    LANG_WORDS,
    LISTS,
    MISSING,
    DOC_COLUMNS,
    NEWEST,
    NUMBERS,
    SETS,
    STATE,
    STATUS_VIEWS,
    STOP_SQL,
    TOP,
    YEARS,
    blocked_outcomes,
    detail_of,
    role_sql,
)
from foretell.plans.registry import query, r6, rounded
from foretell.plans.stem_sql import stem_views, stemmed_texts_sql, with_views
from foretell.plans.standins import TIEBREAK, sql_with
from foretell.session import scratch_path
from foretell.sources import artifacts, files, tables

# sources and sinks


def new_schema(spark) -> str:
    """An own database whose tables live in the shared scratch folder."""
    name = f"foretell_{uuid.uuid4().hex[:12]}"
    tables.create_schema(spark, name, scratch_path(spark, name))
    return name


BILLS_SQL = sql_with("bills", "SELECT * FROM bills")


@query("S1_read_columns", sql_with("bills", "SELECT bill_id, introduced_date FROM bills"))
def s1(t):
    schema = new_schema(t.spark)
    tables.table_from_query(t.spark, t.bills, schema, "bills")
    return tables.read_columns(t.spark, ["bill_id", "introduced_date"], schema, "bills")


@query("S2_run_sql", sql_with("bills", "SELECT bill_type, count(*) AS n FROM bills GROUP BY 1"))
def s2(t):
    t.bills.createOrReplaceTempView("foretell_bills")
    return tables.run_sql(t.spark, "SELECT bill_type, count(*) AS n FROM foretell_bills GROUP BY bill_type;")


@query("S2_run_sql_without_rows", "SELECT o_orderkey AS bill_id FROM orders WHERE o_totalprice < 0")
def s2_empty(t):
    t.table("orders").createOrReplaceTempView("foretell_orders")
    return tables.run_sql(t.spark, "SELECT o_orderkey AS bill_id FROM foretell_orders WHERE o_totalprice < 0")


@query("S3_create_table_as", BILLS_SQL)
def s3(t):
    schema = new_schema(t.spark)
    t.bills.createOrReplaceTempView("foretell_bills")
    tables.table_from_query(t.spark, t.sessions, schema, "out")
    return tables.table_from_query(t.spark, "SELECT * FROM foretell_bills;", schema, "out")


@query("S4_drop_table", "SELECT count(*) AS n_kept, FALSE AS dropped_exists FROM orders")
def s4(t):
    schema = new_schema(t.spark)
    for name in ("kept", "dropped"):
        tables.table_from_query(t.spark, t.bills.select("bill_id"), schema, name)
    tables.drop_table(t.spark, schema, "dropped")
    tables.drop_table(t.spark, schema, "never_there")
    exists = t.spark.catalog.tableExists(f"{schema}.dropped")
    return t.spark.table(f"{schema}.kept").agg(F.count("*").alias("n_kept")).select(
        "n_kept", F.lit(exists).alias("dropped_exists")
    )


@query(
    "S5_write_table_with_id",
    "SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS id, o_orderkey AS bill_id, o_totalprice AS score, "
    "CAST(o_orderdate AS DATE) AS introduced_date FROM orders",
)
def s5(t):
    rows = t.table("orders").select(
        F.col("o_orderkey").alias("bill_id"),
        F.col("o_totalprice").alias("score"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("introduced_date"),
    )
    return tables.write_table(rows, new_schema(t.spark), "facts", ["bill_id"])


@query(
    "S6_write_column",
    "SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT) AS nation, n AS n_orders FROM customer "
    "LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey",
)
def s6(t):
    """The table is made by the first column and keeps unmatched ids null in the second."""
    schema = new_schema(t.spark)
    nations = t.table("customer").select(
        F.col("c_custkey").alias("key"), F.col("c_nationkey").cast("long").alias("nation")
    )
    tables.write_column(t.spark, nations, "key", "nation", schema, "customers")
    orders = t.table("orders").groupBy(F.col("o_custkey").alias("key")).agg(F.count("*").alias("n_orders"))
    return tables.write_column(t.spark, orders, "key", "n_orders", schema, "customers")


SESSION_ROWS = """
    SELECT CAST(c_custkey AS INTEGER) AS session_entry_id, CAST(coalesce(year(first), 1900) AS INTEGER) AS session_year,
           lower(c_name) AS state_name, first AS convene_date, CASE WHEN c_custkey % 4 <> 0 THEN last END AS adjourn_date,
           c_nationkey = 0 AS special, 'runs "' || c_mktsegment || '"' || chr(10) || 'second, line' AS notes
    FROM customer LEFT JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first,
         CAST(max(o_orderdate) AS DATE) AS last FROM orders GROUP BY 1) ON o_custkey = c_custkey"""


@query("S7_session_dates_csv", SESSION_ROWS)
def s7(t):
    """Written as CSV with quoted multi-line notes and read back with the session schema."""
    spans = t.session_dates.withColumnRenamed("session_id", "c_custkey")
    rows = t.table("customer").join(spans, "c_custkey", "left").select(
        F.col("c_custkey").cast("int").alias("session_entry_id"),
        F.coalesce(F.year("start_date"), F.lit(1900)).alias("session_year"),
        F.lower("c_name").alias("state_name"),
        F.col("start_date").alias("convene_date"),
        F.when(F.col("c_custkey") % 4 != 0, F.col("end_date")).alias("adjourn_date"),
        (F.col("c_nationkey") == 0).alias("special"),
        F.concat(F.lit('runs "'), "c_mktsegment", F.lit('"\nsecond, line')).alias("notes"),
    )
    path = scratch_path(t.spark, "session_dates")
    files.csv_text(rows).write.option("header", True).option("escape", '"').csv(path)
    return files.read_session_dates(t.spark, path)


DISTRICT_ROWS = """
    SELECT '17' AS state, lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS state_legislative_district_upper_chamber,
           count(*) FILTER (c_mktsegment = 'BUILDING') AS race_white, count(*) FILTER (c_mktsegment = 'MACHINERY') AS race_black,
           count(*) FILTER (c_mktsegment NOT IN ('BUILDING', 'MACHINERY')) AS race_asian
    FROM customer GROUP BY ALL"""


def district_rows(t):
    segment = F.col("c_mktsegment")
    return t.table("customer").groupBy(
        F.lit("17").alias("state"),
        F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("state_legislative_district_upper_chamber"),
    ).agg(
        F.count_if(segment == "BUILDING").alias("race_white"),
        F.count_if(segment == "MACHINERY").alias("race_black"),
        F.count_if(~segment.isin("BUILDING", "MACHINERY")).alias("race_asian"),
    )


@query("S8_district_races_csv", DISTRICT_ROWS)
def s8(t):
    path = scratch_path(t.spark, "districts")
    district_rows(t).write.option("header", True).csv(path)
    return files.read_district_races(t.spark, path)


@query("S9_normalized_headers", "SELECT n_name AS state_name, n_nationkey AS num_of_state, n_regionkey AS region FROM nation")
def s9(t):
    raw = t.table("nation").select(
        F.col("n_name").alias("State Name"), F.col("n_nationkey").alias("# of State"),
        F.col("n_regionkey").alias("Region!"),
    )
    return files.normalize_columns(raw)


@query(
    "S10_key_violations",
    "SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def s10(t):
    return duplicate_keys(t.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("S10_keyed_extract", DISTRICT_ROWS)
def s10_extract(t):
    return files.keyed_extract(district_rows(t))


@query(
    "S11_flatten_geography",
    "SELECT CAST(n_regionkey AS VARCHAR) AS us_region, CAST(n_nationkey AS VARCHAR) AS state, n_customers "
    "FROM nation JOIN (SELECT c_nationkey, count(*) AS n_customers FROM customer GROUP BY 1) ON c_nationkey = n_nationkey",
)
def s11(t):
    customers = t.table("customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count("*").alias("n_customers")
    )

    def level(name, code):
        return F.struct(F.lit(name).alias("level"), F.col(code).cast("string").alias("code"))

    rows = t.table("nation").join(customers, "n_nationkey").select(
        F.array(level("us region", "n_regionkey"), level("state", "n_nationkey")).alias("geography"),
        "n_customers",
    )
    return files.flatten_geography(rows, "geography", ["us region", "state"])


@query("S12_concat_geographies", "SELECT n_regionkey AS region, n_nationkey AS state, c_custkey FROM nation JOIN customer ON c_nationkey = n_nationkey")
def s12(t):
    """One frame per region, columns in different order, stacked by name."""
    rows = t.table("nation").join(t.table("customer"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_regionkey").alias("region"), F.col("n_nationkey").alias("state"), "c_custkey"
    )
    frames = [rows.where(F.col("region") == r) for r in range(4)]
    frames.append(rows.where(F.col("region") >= 4).select("c_custkey", "state", "region"))
    return files.concat_geographies(frames)


VARIABLES_SQL = (
    "SELECT 'P' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') || 'E' AS code, "
    "'part_' || CAST(p_partkey AS VARCHAR) AS header, 'Estimate!!Total!!' || p_name || ', ' || p_type AS label FROM part"
)


def written_variables(t):
    line = F.format_string(
        "('P%09dE', 'part_%d', 'Estimate!!Total!!%s, %s')", "p_partkey", "p_partkey", "p_name", "p_type"
    )
    path = scratch_path(t.spark, "variables")
    t.table("part").select(line.alias("value")).write.text(path)
    return files.read_variable_list(t.spark, path)


@query("S13_variable_list", VARIABLES_SQL)
def s13(t):
    return written_variables(t)


@query("S14_variable_search", f"SELECT * FROM ({VARIABLES_SQL}) WHERE lower(label) LIKE '%widget%'")
def s14(t):
    return files.search_variables(written_variables(t), "Widget")


TOKENS = r"unnest(regexp_extract_all(lower({c}), '[\p{{L}}\p{{N}}_]{{2,}}'))"
VOCAB_SQL = f"""SELECT "column", term, row_number() OVER (PARTITION BY "column" ORDER BY term) - 1 AS idx FROM (
    SELECT DISTINCT 'text' AS "column", {TOKENS.format(c="text")} AS term FROM documents
    UNION ALL SELECT DISTINCT 'source' AS "column", {TOKENS.format(c="source")} AS term FROM documents)"""


@query("S15_vocabulary_store", VOCAB_SQL)
def s15(t):
    path = scratch_path(t.spark, "vocabulary")
    for _ in range(2):  # built the first time, read the second
        vocab = artifacts.vocabulary_at(t.spark, path, lambda: vocabulary(t.table("documents"), ["text", "source"]))
    return vocab


GROUP_ROWS = " UNION ALL ".join(
    f"SELECT '{g}' AS \"group\", '{c}' AS chamber, {n} AS number"
    for g, by in G.GROUP_DISTRICTS.items() for c, ns in by.items() for n in ns
)
PARSED = """SELECT DISTINCT bill_id, CASE split_part(district, '-', 1) WHEN 'SD' THEN 'upper' WHEN 'HD' THEN 'lower' END AS chamber,
    CAST(split_part(district, '-', 2) AS INTEGER) AS number
    FROM sponsors JOIN bills USING (bill_id) JOIN people p ON p.person_id = sponsor_id AND p.session_id = bills.session_id"""
MEMBERS = 'SELECT DISTINCT "group", bill_id FROM parsed JOIN group_districts USING (chamber, number)'
ALL_MEMBERS = """SELECT "group", bill_id FROM members UNION ALL
    SELECT DISTINCT 'white', bill_id FROM parsed WHERE bill_id NOT IN (SELECT bill_id FROM members)"""
GROUP_VIEWS = {"parsed": PARSED, "group_districts": GROUP_ROWS, "members": MEMBERS, "all_members": ALL_MEMBERS}


def parsed_of(t):
    return G.parsed_districts(G.sponsor_districts(t.sponsors, t.bills, t.people))


def members_of(t):
    return G.audit_groups(parsed_of(t), G.group_table(t.spark))


@query("S16_group_store", sql_with("sponsors bills people", 'SELECT "group", bill_id FROM all_members', **GROUP_VIEWS))
def s16(t):
    path = scratch_path(t.spark, "groups")
    artifacts.save_groups(members_of(t), path)
    return artifacts.load_groups(t.spark, path)


# projections and filters


@query(
    "F1_preprocess",
    "SELECT o_orderkey AS bill_id, CAST(floor(o_totalprice) AS BIGINT) AS amount, o_orderstatus, CAST(o_custkey AS DOUBLE) AS session_id FROM orders",
)
def f1(t):
    """Half-up differences between engines are avoided by casting a floored price."""
    rows = t.table("orders").withColumn("price", F.floor("o_totalprice").cast("double"))
    ops = {
        "o_orderkey": ["rename::bill_id"],
        "price": ["retype::int64", "rename::amount"],
        "o_orderstatus": [],
        "o_custkey": ["rename::session_id", "retype::float64"],
    }
    return preprocess(rows, ops)


@query("F2_rename", "SELECT o_orderdate AS session_start_date FROM orders")
def f2(t):
    return preprocess(t.table("orders"), {"o_orderdate": ["rename::session_start_date"]})


@query("F3_retype", "SELECT CAST(l_quantity AS BIGINT) AS l_quantity, CAST(l_linenumber AS DOUBLE) AS l_linenumber FROM lineitem")
def f3(t):
    return preprocess(t.table("lineitem"), {"l_quantity": ["retype::int64"], "l_linenumber": ["retype::float64"]})


@query(
    "F4_columns_to_read",
    "SELECT o_orderkey AS bill_id, o_orderdate AS intro, o_orderstatus AS status, o_totalprice AS price FROM orders",
)
def f4(t):
    from foretell.features.spec import FeatureSpec

    spec = FeatureSpec(
        {"price": {"impute_mean": []}, "price::2": {"normalize": []}, "intro": {"time_since_session_start": ["intro"]}},
        label_column="status",
    )
    wide = t.table("orders").select(
        F.col("o_orderkey").alias("bill_id"), F.col("o_orderdate").alias("intro"),
        F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"), "o_orderpriority",
    )
    return wide.select(*sorted(spec.columns()))


@query(
    "F5_block_role_filter",
    sql_with("outcomes", "SELECT bill_id, introduced_date, status_new FROM roles WHERE block_id = 2 AND role = 1", roles=BLOCK_ROLES),
)
def f5(t):
    return block_slice(long_blocks(blocked_outcomes(t)), 2, TRAIN).select("bill_id", "introduced_date", "status_new")


@query(
    "F6_predicates",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 100000 AND o_totalprice <= 200000 AND o_orderpriority = '2-HIGH'",
)
def f6(t):
    return t.table("orders").where(
        (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") >= 100000)
        & (F.col("o_totalprice") <= 200000) & (F.col("o_orderpriority") == "2-HIGH")
    ).select("o_orderkey", "o_totalprice")


@query("F7_id_membership", sql_with("scores sponsors bills people", """SELECT id, score FROM scores WHERE id IN (SELECT bill_id FROM members WHERE "group" = 'asian')""", **GROUP_VIEWS))
def f7(t):
    wanted = members_of(t).where("group = 'asian'").withColumnRenamed("bill_id", "id")
    return members_only(t.scores.select("id", "score"), wanted, "id")


@query(
    "F8_newest_rows_of_a_state",
    sql_with("progress bill_state states status_catalog", f"SELECT bill_id, status FROM ({DETAIL}) WHERE state_id = {STATE} AND seq = 1", newest=NEWEST),
)
def f8(t):
    return detail_of(t, None).where(f"state_id = {STATE} AND seq = 1").select("bill_id", "status")


@query(
    "F9_keyword_flag",
    f"SELECT doc_id, regexp_matches(lower(text), '{TOPICS['immigration']}') AS immigration, regexp_matches(lower(text), 'the|und') AS common FROM documents",
)
def f9(t):
    return t.table("documents").select(
        "doc_id", keyword_flag("text", TOPICS["immigration"]).alias("immigration"),
        keyword_flag("text", "the|und").alias("common"),
    )


# scalar functions


@query(
    "X1_year_text",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y') AS year_text, CAST(strftime(o_orderdate, '%Y') AS INTEGER) AS year FROM orders",
)
def x1(t):
    return t.table("orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy").alias("year_text"), X.year_of("o_orderdate").alias("year")
    )


@query("X2_extract_year", "SELECT event_id, CAST(EXTRACT(YEAR FROM ts) AS INTEGER) AS year FROM events")
def x2(t):
    return t.table("events").select("event_id", X.year_of("ts").alias("year"))


@query("X3_date_difference", "SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_shipdate AS DATE) - DATE '1995-01-01' AS BIGINT) AS days FROM lineitem")
def x3(t):
    return t.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", X.days_between("l_shipdate", F.lit("1995-01-01").cast("date")).alias("days")
    )


@query(
    "X4_parse_date",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) END AS parsed FROM orders",
)
def x4(t):
    """Every third date is blank text."""
    text = F.when(F.col("o_orderkey") % 3 == 0, " ").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t.table("orders").select("o_orderkey", X.parse_iso_date(text).alias("parsed"))


@query(
    "X5_case_label",
    "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity <= 365 AND l_linenumber = 6 THEN 'Failed' "
    "WHEN l_quantity <= 365 AND l_linenumber = 4 THEN 'Passed' ELSE 'Failed_Final' END AS label FROM lineitem",
)
def x5(t):
    return t.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", X.outcome_label("l_quantity", "l_linenumber").alias("label")
    )


@query("X6_casts", "SELECT CAST(o_orderkey AS VARCHAR) AS key_text, CAST(CAST(o_orderkey AS VARCHAR) AS INTEGER) AS key_int FROM orders")
def x6(t):
    text = F.col("o_orderkey").cast("string")
    return t.table("orders").select(text.alias("key_text"), text.cast("int").alias("key_int"))


@query("X7_split_id_list", "SELECT l_orderkey AS bill_id, l_suppkey AS sponsor_id, count(*) AS n FROM lineitem GROUP BY 1, 2")
def x7(t):
    from foretell.operators.facts import sponsor_list

    rows = t.table("lineitem").select(F.col("l_orderkey").alias("bill_id"), F.col("l_suppkey").alias("sponsor_id"))
    ids = sponsor_list(rows).select("bill_id", F.explode(X.id_list("sponsors")).alias("sponsor_id"))
    return ids.groupBy("bill_id", "sponsor_id").agg(F.count("*").alias("n"))


@query("X8_strip_lower", "SELECT doc_id, md5(lower(trim(text, ' '))) AS text_md5 FROM documents")
def x8(t):
    return t.table("documents").select("doc_id", F.md5(F.lower(F.trim("text"))).alias("text_md5"))


_DROPPED = (X.PUNCTUATION + X.DIGITS).replace("'", "''")


@query("X9_drop_punctuation_and_digits", f"SELECT doc_id, md5(translate(text, '{_DROPPED}', '')) AS text_md5 FROM documents")
def x9(t):
    return t.table("documents").select("doc_id", F.md5(X.without_punctuation_and_digits("text")).alias("text_md5"))


@query(
    "X10_parse_district",
    sql_with(
        "people",
        "SELECT session_id, person_id, CASE WHEN district LIKE 'SD-%' THEN 'upper' ELSE 'lower' END AS chamber, "
        "CAST(substr(district, 4) AS INTEGER) AS number, person_id % 7 = 0 AS bad FROM people",
    ),
)
def x10(t):
    """Every seventh code loses its dash and is reported as bad."""
    people = t.people.withColumn(
        "code", F.when(F.col("person_id") % 7 == 0, F.replace("district", F.lit("-"), F.lit(""))).otherwise(F.col("district"))
    )
    return people.select(
        "session_id", "person_id", X.district_chamber("district").alias("chamber"),
        X.district_number("district").alias("number"), X.is_bad_district("code").alias("bad"),
    )


@query("X11_geometric_mean", "SELECT o_orderkey, round(sqrt(o_totalprice * o_custkey), 6) AS g FROM orders")
def x11(t):
    return t.table("orders").select("o_orderkey", r6(X.geometric_mean("o_totalprice", F.col("o_custkey").cast("double"))).alias("g"))


@query(
    "X12_clip_divide_truncate",
    "SELECT l_orderkey, l_linenumber, l_partkey, round(least(greatest(l_discount * 20 - 0.5::DOUBLE, 0), 1), 6) AS clipped, "
    "round(l_quantity / nullif(l_discount, 0), 6) AS divided, CAST(floor(l_extendedprice * 0.29::DOUBLE) AS BIGINT) AS truncated FROM lineitem",
)
def x12(t):
    return t.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", r6(X.clip01(F.col("l_discount") * 20 - 0.5)).alias("clipped"),
        r6(X.ratio("l_quantity", "l_discount")).alias("divided"),
        X.int_part(F.col("l_extendedprice") * F.lit(0.29)).alias("truncated"),
    )


@query("X13_present_or", sql_with("labelled_documents", "SELECT doc_id, coalesce(quality, -1) AS quality, quality IS NULL AS is_null FROM labelled_documents"))
def x13(t):
    return t.labelled_documents.select("doc_id", X.present_or("quality", -1).alias("quality"), F.col("quality").isNull().alias("is_null"))


@query("X14_word_tokens", f"SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, {TOKENS.format(c='text')} AS term FROM documents) GROUP BY 1, 2")
def x14(t):
    words = t.table("documents").select("doc_id", F.explode(word_tokens("text")).alias("term"))
    return words.groupBy("doc_id", "term").agg(F.count("*").alias("n"))


SPACED = r"trim(regexp_replace({c}, '\s+', ' ', 'g'))"


@query(
    "X15_whitespace_tokens",
    f"SELECT doc_id, count(*) AS n, count(DISTINCT w) AS n_distinct FROM (SELECT doc_id, unnest(string_split({SPACED.format(c='text')}, ' ')) AS w FROM documents) WHERE w <> '' GROUP BY 1",
)
def x15(t):
    words = t.table("documents").select("doc_id", F.explode(whitespace_tokens("text")).alias("w"))
    per_word = words.groupBy("doc_id", "w").agg(F.count("*").alias("n"))
    return per_word.groupBy("doc_id").agg(F.sum("n").alias("n"), F.count("*").alias("n_distinct"))


# texts


_fused = "translate(lower(trim(text, ' ')), '" + _DROPPED + "', '')"
for _head, _tail in FUSED_WORDS:
    _fused = f"regexp_replace({_fused}, '\\b({_head})({_tail})\\b', '\\1 \\2', 'g')"
CLEAN_SQL = (
    "SELECT doc_id, coalesce(string_agg(w, ' ' ORDER BY i) FILTER (w <> '' AND w NOT IN (" + STOP_SQL + ")), '') AS clean FROM "
    f"(SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (SELECT doc_id, string_split({SPACED.format(c=_fused)}, ' ') AS ws FROM documents)) GROUP BY 1"
)


@query("T1_clean_text_unstemmed", f"SELECT doc_id, md5(clean) AS clean_md5 FROM ({CLEAN_SQL})")
def t1_plain(t):
    return t.table("documents").select("doc_id", F.md5(clean_text("text", stem=False)).alias("clean_md5"))


@query("T1_clean_text", stemmed_texts_sql(CLEAN_SQL, "clean"))
def t1(t):
    """With stemming."""
    return t.table("documents").select("doc_id", clean_text("text").alias("clean"))


@query("T2_clean_text_column", stemmed_texts_sql(CLEAN_SQL, "bill_text"))
def t2(t):
    """Cleaning as an operation of the column preparation."""
    return preprocess(t.table("documents"), {"doc_id": [], "text": ["clean_text_data", "rename::bill_text"]})


@query(
    "T3_stopwords_case_sensitive",
    f"SELECT doc_id, count(*) AS n FROM (SELECT doc_id, unnest(string_split({SPACED.format(c='text')}, ' ')) AS w FROM documents) WHERE w <> '' AND w NOT IN ({STOP_SQL}) GROUP BY 1",
)
def t3(t):
    kept = drop_stopwords(whitespace_tokens("text"))
    return t.table("documents").select("doc_id", F.size(kept).cast("long").alias("n")).where("n > 0")


@query("T4_word_counts_by_group", LANG_WORDS)
def t4(t):
    return TS.word_counts(t.table("documents"), "text", ["lang"])


@query(
    "T5_words_only_in_one_group",
    f"WITH w AS ({LANG_WORDS}) SELECT word, n FROM w WHERE lang = 'de' AND word NOT IN (SELECT word FROM w WHERE lang = 'es')",
)
def t5(t):
    return TS.words_only_in(TS.word_counts(t.table("documents"), "text", ["lang"]), "lang", "de", "es")


TOPIC_SQL = ", ".join(f"count(*) FILTER (regexp_matches(lower(text), '{p}')) AS n_{n}" for n, p in TOPICS.items())


@query("T6_topic_counts_by_group", f"SELECT source, count(*) AS n_texts, {TOPIC_SQL} FROM documents GROUP BY 1")
def t6(t):
    return TS.topic_counts(t.table("documents"), "text", ["source"])


PARTS = {"english": "tion|thing", "german": "keit|ung", "spanish": "ción"}


@query(
    "T6_topics_that_occur",
    "SELECT lang, count(*) AS n_texts, " + ", ".join(f"count(*) FILTER (regexp_matches(lower(text), '{p}')) AS n_{n}" for n, p in PARTS.items())
    + " FROM documents GROUP BY 1",
)
def t6_parts(t):
    """The same count with patterns that the documents have."""
    return TS.topic_counts(t.table("documents"), "text", ["lang"], PARTS)


# temporal splits


@query(
    "V1_block_columns_expanding",
    sql_with("outcomes", "SELECT bill_id, " + ", ".join(f"{role_sql(b, 1)} AS iter_{b + 1}" for b in range(3)) + " FROM outcomes"),
)
def v1(t):
    return blocked_outcomes(t, 1).select("bill_id", "iter_1", "iter_2", "iter_3")


@query(
    "V1_block_columns_rolling",
    sql_with("outcomes", "SELECT bill_id, " + ", ".join(f"{role_sql(b, 0)} AS iter_{i}" for i, b in ((1, 0), (2, 2))) + " FROM outcomes"),
)
def v1_rolling(t):
    rows = with_block_columns(t.outcomes, "introduced_date", *YEARS, update_freq=2, type_val=0)
    return rows.select("bill_id", "iter_1", "iter_2")


@query(
    "V2_long_blocks",
    sql_with("outcomes", "SELECT bill_id, block_id, role FROM roles WHERE role IS NOT NULL", roles=BLOCK_ROLES),
)
def v2(t):
    """Written partitioned by block and role, then read back."""
    path = scratch_path(t.spark, "blocks")
    long_blocks(blocked_outcomes(t)).select("bill_id", "block_id", "role").write.partitionBy("block_id", "role").parquet(path)
    return t.spark.read.schema("bill_id long, block_id int, role int").parquet(path)


SPLITS = """SELECT CAST(i + 1 AS INTEGER) AS split, d AS train_from, d + 14 AS train_to, d + 15 AS test_from, d + 19 AS test_to
    FROM (SELECT i, first + CAST(i * 4 AS INTEGER) AS d, last FROM
          (SELECT CAST(min(ts) AS DATE) AS first, CAST(max(ts) AS DATE) AS last FROM events), range(10000) r(i))
    WHERE d + 19 < last"""
SPLIT_ROWS = """SELECT split, 'train' AS role, event_id FROM events JOIN splits ON CAST(ts AS DATE) >= train_from AND CAST(ts AS DATE) < train_to
    UNION ALL SELECT split, 'test', event_id FROM events JOIN splits ON CAST(ts AS DATE) >= test_from AND CAST(ts AS DATE) < test_to"""


def event_splits(t):
    splitter = CalendarSplits(train_period=14, test_period=4, freq="days")
    return splitter, splitter.split(t.table("events").select("event_id", "ts"), "ts", gap=1)


@query("V3_calendar_splits", f"WITH splits AS ({SPLITS}) {SPLIT_ROWS}")
def v3(t):
    return event_splits(t)[1].select("split", "role", "event_id")


@query("V4_number_of_splits", f"WITH splits AS ({SPLITS}) SELECT count(*) AS n_splits, (SELECT count(*) FROM events) AS n_events FROM splits")
def v4(t):
    splitter, _ = event_splits(t)
    return t.table("events").agg(F.count("*").alias("n_events")).select(
        F.lit(splitter.get_n_splits()).cast("long").alias("n_splits"), "n_events"
    )


@query(
    "J11_range_join",
    f"WITH splits AS ({SPLITS}), r AS ({SPLIT_ROWS}) SELECT split, role, count(*) AS n FROM r GROUP BY 1, 2",
)
def j11(t):
    return event_splits(t)[1].groupBy("split", "role").agg(F.count("*").alias("n"))


@query(
    "J9_vocabulary_lookup",
    f"""WITH v AS ({VOCAB_SQL}) SELECT doc_id, idx, count(*) AS n FROM (SELECT doc_id, {TOKENS.format(c='text')} AS term FROM documents)
    JOIN v ON v.term = term AND "column" = 'text' WHERE v.term = term GROUP BY 1, 2""".replace("JOIN v ON v.term = term AND", "d JOIN v ON v.term = d.term AND").replace(" WHERE v.term = term", ""),
)
def j9(t):
    docs = t.table("documents")
    vocab = vocabulary(docs, ["text"]).select("term", "idx")
    words = docs.select("doc_id", F.explode(word_tokens("text")).alias("term"))
    counts = words.groupBy("doc_id", "term").agg(F.count("*").alias("n"))
    return counts.join(vocab, "term").select("doc_id", "idx", "n")


# audit groups


@query("B1_sponsor_districts", sql_with("sponsors bills people", f"SELECT bill_id, sponsor_id, district FROM sponsors JOIN bills USING (bill_id) JOIN people p ON p.person_id = sponsor_id AND p.session_id = bills.session_id WHERE state_id = {STATE}"))
def b1(t):
    return G.sponsor_districts(t.sponsors, t.bills, t.people, STATE)


@query("B2_parsed_districts", sql_with("sponsors bills people", "SELECT * FROM parsed", parsed=PARSED))
def b2(t):
    return parsed_of(t)


@query("B2_district_sets", sql_with("sponsors bills people", "SELECT bill_id, len(upper) AS n_upper, len(lower) AS n_lower FROM sets", sets=SETS))
def b2_sets(t):
    sets = G.district_sets(parsed_of(t))
    return sets.select("bill_id", F.size("upper").cast("long").alias("n_upper"), F.size("lower").cast("long").alias("n_lower"))


@query("B3_group_members", sql_with("sponsors bills people", "SELECT * FROM members", **GROUP_VIEWS))
def b3(t):
    return G.group_members(parsed_of(t), G.group_table(t.spark))


@query("B4_reference_group", sql_with("sponsors bills people", "SELECT bill_id FROM all_members WHERE \"group\" = 'white'", **GROUP_VIEWS))
def b4(t):
    parsed = parsed_of(t)
    members = G.group_members(parsed, G.group_table(t.spark))
    return G.with_reference_group(parsed, members).where("group = 'white'").select("bill_id")


def confusion_sql(hit: str) -> str:
    tp, pp, p = f"count(*) FILTER (y = 1 AND {hit})", f"count(*) FILTER ({hit})", "count(*) FILTER (y = 1)"
    return f"coalesce({tp}::DOUBLE / nullif({pp}, 0), 0)", f"coalesce({tp}::DOUBLE / nullif({p}, 0), 0)", f"coalesce(2.0::DOUBLE * {tp} / nullif({pp} + {p}, 0), 0)"


_PREC, _REC, _F1 = confusion_sql("predicted = 1")
GROUP_METRICS = f"""SELECT "group", count(*) AS n, round(1 - {_PREC}, 6) AS "FDR", round({_REC}, 6) AS "TPR"
    FROM flagged JOIN all_members ON bill_id = id GROUP BY 1"""


def flagged_of(t):
    return top_scores(t).withColumnRenamed("id", "bill_id")


def top_scores(t):
    return M.flag_top(t.scores.select("id", "score", "y"), 0.3)


@query("B5_group_metrics", sql_with("scores sponsors bills people", GROUP_METRICS, **GROUP_VIEWS, flagged=TOP.format(k=0.3)))
def b5(t):
    return rounded(G.group_metrics(flagged_of(t), members_of(t)), "FDR", "TPR")


@query(
    "B6_disparities",
    sql_with(
        "scores sponsors bills people",
        """SELECT a."group", round(a.fdr / nullif(b.fdr, 0), 6) AS "FDR_disparity", round(a.tpr / nullif(b.tpr, 0), 6) AS "TPR_disparity"
        FROM gm a, gm b WHERE a."group" <> 'white' AND b."group" = 'white'""",
        **GROUP_VIEWS, flagged=TOP.format(k=0.3),
        gm=f'SELECT "group", 1 - {_PREC} AS fdr, {_REC} AS tpr FROM flagged JOIN all_members ON bill_id = id GROUP BY 1',
    ),
)
def b6(t):
    metrics = G.group_metrics(flagged_of(t), members_of(t))
    return rounded(G.disparities(metrics), "FDR_disparity", "TPR_disparity")


SHARES = """SELECT state_legislative_district_upper_chamber AS district, race, round(share, 6) AS share, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY race ORDER BY share DESC, state_legislative_district_upper_chamber) AS rank FROM (
        UNPIVOT (SELECT state_legislative_district_upper_chamber, race_white / (race_white + race_black + race_asian) AS race_white,
            race_black / (race_white + race_black + race_asian) AS race_black,
            race_asian / (race_white + race_black + race_asian) AS race_asian FROM d)
        ON race_white, race_black, race_asian INTO NAME race VALUE share)) WHERE rank <= 5"""


@query("B7_top_districts_by_share", f"WITH d AS ({DISTRICT_ROWS}) {SHARES}")
def b7(t):
    key = "state_legislative_district_upper_chamber"
    best = G.top_districts_by_share(district_rows(t), [key], ["race_white", "race_black", "race_asian"], 5)
    return rounded(best.withColumnRenamed(key, "district"), "share")


# evaluation

_HIT = "score >= 250000"
_P5, _R5, _F5 = confusion_sql(_HIT)


@query(
    "M1_threshold_metrics",
    sql_with(
        "grouped_scores",
        f'SELECT "group", round({_P5}, 6) AS precision, round({_R5}, 6) AS recall, round({_F5}, 6) AS f1, '
        f'round(1 - {_P5}, 6) AS "FDR", round({_R5}, 6) AS "TPR" FROM grouped_scores GROUP BY 1',
    ),
)
def m1(t):
    out = M.threshold_metrics(t.grouped_scores, threshold=250000, by=["group"])
    return rounded(out, "precision", "recall", "f1", "FDR", "TPR")


AT_K = """SELECT count(*) FILTER (predicted = 1) AS n_top, count(*) FILTER (predicted = 1 AND y = 1) AS hits,
    round(count(*) FILTER (predicted = 1 AND y = 1)::DOUBLE / nullif(count(*) FILTER (predicted = 1), 0), 6) AS precision,
    round(count(*) FILTER (predicted = 1 AND y = 1)::DOUBLE / nullif(count(*) FILTER (y = 1), 0), 6) AS recall"""


@query("M2_metrics_at_k", sql_with("scores", f"{AT_K} FROM flagged", flagged=TOP.format(k=0.3)))
def m2(t):
    return rounded(M.metrics_at_k(top_scores(t)), "precision", "recall")


BY_GROUP_TOP = """SELECT *, CAST(rk <= floor(0.3::DOUBLE * count(*) OVER (PARTITION BY "group")) AS INTEGER) AS predicted
    FROM (SELECT *, row_number() OVER (PARTITION BY "group" ORDER BY score DESC, id) AS rk FROM grouped_scores)"""


@query("M2_metrics_at_k_by_group", sql_with("grouped_scores", f'{AT_K}, "group" FROM flagged GROUP BY "group"', flagged=BY_GROUP_TOP))
def m2_groups(t):
    flagged = M.flag_top(t.grouped_scores, 0.3, ["group"])
    return rounded(M.metrics_at_k(flagged, ["group"]), "precision", "recall")


CURVE = """SELECT i AS point, round(p, 6) AS proportion, n, round(hits::DOUBLE / nullif(n, 0), 6) AS precision,
    CASE WHEN n > 0 THEN round(hits::DOUBLE / (SELECT sum(y) FROM scores), 6) END AS recall
    FROM (SELECT i, 0.0002::DOUBLE + i * 0.0002::DOUBLE AS p,
                 CAST(floor((0.0002::DOUBLE + i * 0.0002::DOUBLE) * (SELECT count(*) FROM scores)) AS BIGINT) AS n FROM range(5000) r(i))
    LEFT JOIN (SELECT row_number() OVER (ORDER BY score DESC, id) AS rk, sum(y) OVER (ORDER BY score DESC, id) AS hits FROM scores) ON rk = n"""


@query("M3_precision_recall_curve", sql_with("scores", CURVE))
def m3(t):
    return rounded(M.pr_curve(t.scores.select("id", "score", "y")), "proportion", "precision", "recall")


@query("M4_score_histogram", sql_with("scores", "SELECT b AS bin, round(lo + b * w, 6) AS left_edge, count(score) AS n FROM (SELECT min(score) AS lo, (max(score) - min(score)) / 20 AS w FROM scores), range(20) r(b) LEFT JOIN scores ON least(floor((score - lo) / w), 19) = b GROUP BY ALL"))
def m4(t):
    return rounded(M.score_histogram(t.scores, 20), "left_edge")


@query(
    "M5_cross_tabs_by_group",
    sql_with("grouped_scores", 'SELECT "group", predicted = 1 AS is_top, round(avg(y), 6) AS y, round(avg(score), 4) AS score FROM flagged GROUP BY 1, 2', flagged=BY_GROUP_TOP),
)
def m5(t):
    flagged = M.flag_top(t.grouped_scores, 0.3, ["group"])
    return M.cross_tabs(flagged, ["y", "score"], ["group"]).select(
        "group", "is_top", r6("y").alias("y"), F.round("score", 4).alias("score")
    )


@query(
    "M7_long_results",
    sql_with("grouped_scores", 'UNPIVOT (SELECT "group", precision, recall FROM m) ON precision, recall INTO NAME metric VALUE value', flagged=BY_GROUP_TOP, m=f'{AT_K}, "group" FROM flagged GROUP BY "group"'),
)
def m7(t):
    flagged = M.flag_top(t.grouped_scores, 0.3, ["group"])
    return rounded(M.long_results(M.metrics_at_k(flagged, ["group"]), ["group"], ["precision", "recall"]), "value")


@query(
    "M8_base_rates",
    sql_with(
        "grouped_scores",
        'SELECT "group", count(*) AS total, CAST(sum(y) AS BIGINT) AS passed, round(sum(y)::DOUBLE / count(*), 6) AS base_rate, '
        'round(least(greatest(sum(y)::DOUBLE / floor(count(*) * 0.3::DOUBLE), 0), 1), 6) AS best_precision FROM grouped_scores GROUP BY 1',
    ),
)
def m8(t):
    return rounded(M.base_rates(t.grouped_scores, ["group"]), "base_rate", "best_precision")


# profiling

KINDS = """SELECT kind, status, count(*) AS n FROM (
    SELECT 'all' AS kind, status FROM d UNION ALL SELECT 'final', status FROM d WHERE seq = 1
    UNION ALL SELECT 'relabelled', CASE WHEN count_year >= 2 AND status NOT IN ('Passed', 'Failed') THEN 'AssignFail' ELSE status END FROM d WHERE seq = 1)
    WHERE status IS NOT NULL GROUP BY 1, 2"""
ODD_STATUS = "SELECT * EXCLUDE (status), CASE WHEN bill_id % 2 = 0 THEN status ELSE 'Engrossed' END AS status FROM d0"


@query(
    "P1_status_distributions",
    sql_with("progress bill_state states status_catalog", KINDS, newest=NEWEST, d0=DETAIL, d=ODD_STATUS),
)
def p1(t):
    """Bills with an odd id count as still engrossed, so that some get relabelled."""
    details = detail_of(t, None)
    undecided = F.when(F.col("bill_id") % 2 == 0, F.col("status")).otherwise("Engrossed")
    return status_distributions(details.withColumn("status", undecided))


@query("P2_missing_values", sql_with("labelled_documents", MISSING))
def p2(t):
    return missing_values(t.labelled_documents.select(*DOC_COLUMNS))


@query("P3_float_column_summary", BOX)
def p3(t):
    return rounded(box_plots(t.table("events"), ["value", "user_id"]), "q1", "median", "q3")


@query("P4_correlation_matrix", CORR)
def p4(t):
    return rounded(correlations(t.table("lineitem"), NUMBERS), "corr")


# registries


@query("Z2_query_by_name", sql_with("progress", "SELECT bill_id, CASE WHEN count(*) = count(progress_date) THEN CAST(max(progress_date) - min(progress_date) AS BIGINT) END AS diff FROM progress GROUP BY 1"))
def z2(t):
    from foretell.plans.run import QUERIES as by_name

    return by_name["bill_date_difference"](t.progress)


_YEARS_OF_FACT = "SELECT state_id, bill_id FROM bills JOIN sessions USING (session_id) WHERE year(introduced_date) BETWEEN 1996 AND 1999"


@query("Z2_run_takes_its_queries", sql_with(
    FACT_TABLES, FACT.format(text="md5(doc) AS doc_md5", source="final_text"),
    **STATUS_VIEWS | {"lists": LISTS, "final_text": FINAL_TEXT, "bill_state": _YEARS_OF_FACT}))
def z2_run(t):
    """The facts that a configuration asks for by the names of three queries, each written to its table."""
    from foretell.plans.run import QueryStep, RunSettings, run_queries

    names = ("map_bill_to_state_query", "bill_date_difference", "bill_final_query")
    schema = new_schema(t.spark)
    settings = RunSettings(
        queries=tuple(QueryStep(n, schema, f"t{k}") for k, n in enumerate(names)),
        query_params={"start_year": 1996, "end_year": 1999}, test_params={"start_year": 2000, "end_year": 2000},
    )
    relations = {n: getattr(t, n) for n in ("bills", "sessions", "states", "progress", "status_catalog", "sponsors", "texts", "session_dates", "acs", "composition")}
    facts = run_queries(t.spark, relations, settings, TIEBREAK)
    return facts.withColumn("doc_md5", F.md5("doc")).drop("doc")


@query("Z4_stems_of_words", with_views(
    {"words": f"SELECT DISTINCT {TOKENS.format(c='text')} AS word FROM documents", **stem_views("words")}, "SELECT word, stem FROM stems"))
def z4(t):
    """Every distinct word of the documents with its stem."""
    words = t.table("documents").select(F.explode(word_tokens("text")).alias("word")).distinct()
    return words.select("word", stem_words("word").alias("stem"))


@query(
    "Z3_metrics_by_name",
    sql_with("scores", f"SELECT metric, round(value, 6) AS value FROM (UNPIVOT (SELECT {_P5} AS precision, {_R5} AS recall, {_F5} AS f1, 1 - {_P5} AS \"FDR\", {_R5} AS \"TPR\" FROM scores) ON precision, recall, f1, \"FDR\", \"TPR\" INTO NAME metric VALUE value)"),
)
def z3(t):
    names = list(M.METRICS)
    wide = M.threshold_metrics(t.scores, names, 250000)
    return rounded(M.long_results(wide, [], names), "value")
