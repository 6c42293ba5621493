"""Registered queries: relational facts, joins, aggregations, windows, ordinals, sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from foretell.operators import facts as Q
from foretell.operators import groups as G
from foretell.operators import joins as J
from foretell.operators.baseline import mean_rate, pass_counters, pass_rates
from foretell.operators.history import delayed_history
from foretell.operators.metrics import cross_tabs, flag_top, ranked, score_histogram, top_fraction
from foretell.operators.ordinal import exact_quantiles, global_ordinal, mini_batches, ordinal_within
from foretell.operators.profile import box_plots, correlations, missing_values
from foretell.operators.splits import block_summary, long_blocks, with_block_columns
from foretell.operators.textstats import by_frequency, word_counts
from foretell.plans.registry import query, r6, rounded
from foretell.plans.standins import TIEBREAK, sql_with
from foretell.functions.text import STOPWORDS

TIES_DESC = ", ".join(f"{c} DESC" for c in TIEBREAK)
STOP_SQL = ", ".join("'" + w.replace("'", "''") + "'" for w in STOPWORDS)

NEWEST = f"""
    SELECT *, row_number() OVER (PARTITION BY bill_id
        ORDER BY progress_date DESC NULLS FIRST, {TIES_DESC}) AS seq
    FROM progress"""
DIFF = """
    SELECT bill_id, CASE WHEN count(*) = count(progress_date)
        THEN CAST(max(progress_date) - min(progress_date) AS BIGINT) END AS diff
    FROM progress GROUP BY bill_id"""
LABEL = """CASE WHEN diff <= 365 AND bill_status = 6 THEN 'Failed'
    WHEN diff <= 365 AND bill_status = 4 THEN 'Passed' ELSE 'Failed_Final' END"""
LABELLED = f"""
    SELECT bill_id, diff, progress_date AS final_date, bill_status, {LABEL} AS status_new
    FROM newest JOIN date_diff USING (bill_id) WHERE seq = 1"""
LEAD = "SELECT bill_id, arg_min(party_id, sponsor_id) AS party_id FROM sponsors GROUP BY bill_id"
FINAL_STATUS = """
    SELECT bill_id, state_id, state_abbreviation, final_date, bill_status, status, diff, party_id,
           status_new
    FROM labelled JOIN bill_state USING (bill_id) JOIN states USING (state_id)
    JOIN lead_sponsor USING (bill_id) LEFT JOIN status_catalog ON status_id = bill_status"""
STATUS_VIEWS = {
    "newest": NEWEST, "date_diff": DIFF, "labelled": LABELLED, "lead_sponsor": LEAD,
    "final_status": FINAL_STATUS,
}
LISTS = """
    SELECT bill_id, string_agg(CAST(sponsor_id AS VARCHAR), ', ' ORDER BY sponsor_id) AS sponsors
    FROM sponsors GROUP BY bill_id"""
FINAL_TEXT = """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY bill_id
        ORDER BY doc_date DESC NULLS FIRST, doc_id DESC) AS rn FROM texts WHERE type_id = 1)
    WHERE rn = 1"""
CLEANED = """
    SELECT bill_id, lower(doc) AS bill_text, bill_description FROM (SELECT *, row_number()
        OVER (PARTITION BY bill_id ORDER BY doc_id) AS rn FROM texts) WHERE rn = 1"""
STATE = 3


def outcomes_of(t):
    return Q.bill_outcomes(t.progress, TIEBREAK)


def cleaned_texts(t):
    first = t.texts.groupBy("bill_id").agg(F.min("doc_id").alias("doc_id"))
    return t.texts.join(first, ["bill_id", "doc_id"]).select(
        "bill_id", F.lower("doc").alias("bill_text"), "bill_description"
    )


def final_status_of(t, state_id):
    return Q.final_status(
        t.progress, t.bill_state, t.status_catalog, t.states, t.sponsors, state_id, TIEBREAK
    )


def full_fact(t, texts, state_id):
    return Q.final_fact(
        final_status_of(t, state_id), t.bills, texts, t.session_dates, Q.sponsor_list(t.sponsors),
        t.acs, t.composition,
    )


@query(
    "Q0_labelled_outcomes",
    sql_with("progress", "SELECT * FROM labelled", newest=NEWEST, date_diff=DIFF, labelled=LABELLED),
)
def labelled_outcomes(t):
    """Span, newest status and label of every bill, from one aggregation."""
    return outcomes_of(t)


@query(
    "Q1_map_bill_to_state",
    sql_with(
        "bills sessions",
        "SELECT state_id, bill_id FROM bills JOIN sessions USING (session_id) "
        "WHERE year(introduced_date) BETWEEN 1996 AND 1999",
    ),
)
def q1(t):
    return Q.bills_by_state(t.bills, t.sessions, 1996, 1999)


@query("Q2_bill_date_difference", sql_with("progress", "SELECT * FROM date_diff", date_diff=DIFF))
def q2(t):
    return Q.date_difference(t.progress)


@query(
    "Q3_rank_states_by_bill_count",
    sql_with(
        "bills sessions states",
        "SELECT state_id, state_abbreviation, count(bill_id) AS count, row_number() OVER "
        "(ORDER BY count(bill_id) DESC, state_id) AS rank FROM bills JOIN sessions USING (session_id) "
        "JOIN states USING (state_id) WHERE year(introduced_date) BETWEEN 1996 AND 1999 GROUP BY 1, 2",
    ),
)
def q3(t):
    return Q.rank_states(t.bills, t.sessions, t.states, 1996, 1999)


DETAIL = """
    SELECT bill_id, state_id, progress_date, bill_status, status,
           CAST(date_part('year', age(progress_date, min(progress_date) OVER (PARTITION BY bill_id))) AS INTEGER) AS count_year,
           seq
    FROM newest JOIN bill_state USING (bill_id) JOIN states USING (state_id)
    LEFT JOIN status_catalog ON status_id = bill_status"""


def detail_of(t, state_id):
    return Q.bill_detail(t.progress, t.bill_state, t.status_catalog, t.states, state_id, TIEBREAK)


@query(
    "Q4_bill_detail",
    sql_with("progress bill_state states status_catalog", f"{DETAIL} WHERE state_id = {STATE}", newest=NEWEST),
)
def q4(t):
    return detail_of(t, STATE)


@query(
    "Q5_final_status",
    sql_with("progress bill_state states status_catalog sponsors", "SELECT * FROM final_status", **STATUS_VIEWS),
)
def q5(t):
    return final_status_of(t, None)


@query(
    "Q6_final_text",
    sql_with(
        "texts", "SELECT bill_id, doc_id, doc_date, md5(doc) AS doc_md5 FROM final_text",
        final_text=FINAL_TEXT,
    ),
)
def q6(t):
    return Q.final_text(t.texts).select("bill_id", "doc_id", "doc_date", F.md5("doc").alias("doc_md5"))


@query("Q7_sponsor_list", sql_with("sponsors", "SELECT * FROM lists", lists=LISTS))
def q7(t):
    return Q.sponsor_list(t.sponsors)


@query(
    "Q8_status_label_counts",
    sql_with(
        "progress", "SELECT status_new, count(*) AS n FROM labelled GROUP BY 1",
        newest=NEWEST, date_diff=DIFF, labelled=LABELLED,
    ),
)
def q8(t):
    return outcomes_of(t).groupBy("status_new").agg(F.count("*").alias("n"))


FACT_TABLES = "progress bill_state states status_catalog sponsors bills texts session_dates acs composition"
FACT = """
    SELECT bill_id, year, session_id, start_date, end_date, state_id, state_abbreviation, bill_status,
           status, final_date, diff, party_id, bill_type, introduced_date, introduced_body, sponsors,
           status_new, bill_description, {text}, sponsor_count, rep_sponsor_count, sen_sponsor_count,
           population, median_income, poverty
    FROM (SELECT *, CAST(year(introduced_date) AS INTEGER) AS year
          FROM final_status JOIN (SELECT bill_id, session_id, bill_type, introduced_date, introduced_body
                                  FROM bills WHERE bill_type = 'B') USING (bill_id))
    JOIN {source} USING (bill_id) JOIN session_dates USING (session_id) JOIN lists USING (bill_id)
    JOIN acs USING (year) JOIN composition USING (bill_id)"""


@query(
    "Q9_bill_final",
    sql_with(
        FACT_TABLES, FACT.format(text="md5(doc) AS doc_md5", source="final_text"),
        **STATUS_VIEWS, lists=LISTS, final_text=FINAL_TEXT,
    ),
)
def q9(t):
    fact = full_fact(t, Q.final_text(t.texts), None)
    return fact.withColumn("doc_md5", F.md5("doc")).drop("doc")


@query(
    "Q10_bill_final_processed_text",
    sql_with(
        FACT_TABLES,
        FACT.format(text="md5(bill_text) AS text_md5", source="cleaned") + f" WHERE state_id = {STATE}",
        **STATUS_VIEWS, lists=LISTS, cleaned=CLEANED,
    ),
)
def q10(t):
    fact = full_fact(t, cleaned_texts(t), STATE)
    return fact.withColumn("text_md5", F.md5("bill_text")).drop("bill_text")


SPONSOR_OUTCOMES = """
    SELECT sponsor_id, s.party_id AS party_id, bill_id, status_new
    FROM final_status JOIN bills USING (bill_id) JOIN {texts} USING (bill_id)
    JOIN session_dates USING (session_id) JOIN sponsors s USING (bill_id)"""


@query(
    "Q11_bill_sponsor",
    sql_with(FACT_TABLES, SPONSOR_OUTCOMES.format(texts="texts"), **STATUS_VIEWS),
)
def q11(t):
    return Q.sponsor_outcomes(final_status_of(t, None), t.bills, t.texts, t.session_dates, t.sponsors)


@query(
    "Q11_bill_sponsor_distinct_versions",
    sql_with(
        FACT_TABLES,
        SPONSOR_OUTCOMES.format(texts="(SELECT DISTINCT bill_id FROM texts)"), **STATUS_VIEWS,
    ),
)
def q11_distinct(t):
    return Q.sponsor_outcomes(
        final_status_of(t, None), t.bills, t.texts, t.session_dates, t.sponsors, distinct_versions=True
    )


@query(
    "Q12_condition_on_query",
    sql_with(
        "progress", "SELECT * FROM labelled WHERE diff > 100 AND bill_status = 4",
        newest=NEWEST, date_diff=DIFF, labelled=LABELLED,
    ),
)
def q12(t):
    return Q.with_condition(outcomes_of(t), "diff > 100 AND bill_status = 4")


@query(
    "Q13_sponsor_sessions",
    sql_with("sponsors bills", "SELECT sponsor_id, bill_id, session_id FROM sponsors JOIN bills USING (bill_id)"),
)
def q13(t):
    return Q.sponsor_sessions(t.sponsors, t.bills)


@query(
    "Q14_sponsor_districts_any_session",
    sql_with(
        "sponsors people",
        "SELECT bill_id, sponsor_id, district, count(*) AS n FROM sponsors "
        f"JOIN (SELECT person_id, district FROM people WHERE state_id = {STATE}) ON person_id = sponsor_id "
        "GROUP BY ALL",
    ),
)
def q14(t):
    found = G.sponsor_districts(t.sponsors, t.bills, t.people, STATE, match_session=False)
    return found.groupBy("bill_id", "sponsor_id", "district").agg(F.count("*").alias("n"))


# joins


@query(
    "J1_inner_on",
    sql_with(
        "bills sessions states",
        "SELECT bill_id, b.session_id, s.state_id, state_abbreviation FROM bills b "
        "JOIN sessions s ON b.session_id = s.session_id JOIN states st ON s.state_id = st.state_id",
    ),
)
def j1(t):
    return t.bills.select("bill_id", "session_id").join(t.sessions, "session_id").join(t.states, "state_id").select(
        "bill_id", "session_id", "state_id", "state_abbreviation"
    )


@query(
    "J2_inner_using",
    sql_with(
        "bills session_dates sponsors",
        "SELECT bill_id, session_id, start_date, end_date, sponsors FROM bills "
        "JOIN session_dates USING (session_id) JOIN lists USING (bill_id)", lists=LISTS,
    ),
)
def j2(t):
    return t.bills.join(t.session_dates, "session_id").join(Q.sponsor_list(t.sponsors), "bill_id").select(
        "bill_id", "session_id", "start_date", "end_date", "sponsors"
    )


@query(
    "J3_left_outer",
    "SELECT o_orderkey AS bill_id, count(l_orderkey) AS n_progress, min(l_linenumber) AS first_line "
    "FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1",
)
def j3(t):
    lines = t.table("lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("n"), F.min("l_linenumber").alias("first_line")
    )
    bills = t.table("orders").select(F.col("o_orderkey").alias("bill_id"))
    return bills.join(lines, F.col("l_orderkey") == F.col("bill_id"), "left").select(
        "bill_id", F.coalesce("n", F.lit(0)).alias("n_progress"), "first_line"
    )


@query(
    "J4_first_and_last_row",
    sql_with(
        "progress",
        "SELECT bill_id, f.progress_date AS first_date, l.progress_date AS last_date FROM "
        "(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY bill_id ORDER BY progress_date) AS rn FROM progress) WHERE rn = 1) f "
        "JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY bill_id ORDER BY progress_date DESC) AS rn FROM progress) WHERE rn = 1) l "
        "USING (bill_id)",
    ),
)
def j4(t):
    """First and last progress date per bill: one aggregation in place of a self-join."""
    return t.progress.groupBy("bill_id").agg(
        F.min("progress_date").alias("first_date"), F.max("progress_date").alias("last_date")
    )


@query(
    "J5_last_wins_lookup",
    "WITH seat AS (SELECT o_custkey AS session_id, arg_max(o_orderstatus, o_orderkey) AS last_status "
    "FROM orders GROUP BY 1) SELECT c_custkey AS session_id, c_name, last_status "
    "FROM customer JOIN seat ON session_id = c_custkey",
)
def j5(t):
    right = t.table("orders").select(
        F.col("o_custkey").alias("session_id"), F.col("o_orderstatus").alias("last_status"), "o_orderkey"
    )
    left = t.table("customer").select(F.col("c_custkey").alias("session_id"), "c_name")
    return J.last_wins_lookup(left, right, ["session_id"], "last_status", ["o_orderkey"])


@query(
    "J6_semi_join",
    sql_with(
        "bills", "SELECT bill_id, session_id FROM bills WHERE bill_id IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)",
    ),
)
def j6(t):
    large = t.table("lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("bill_id"))
    return J.members_only(t.bills, large, "bill_id").select("bill_id", "session_id")


@query(
    "J7_anti_join",
    sql_with("bills", "SELECT bill_id, session_id FROM bills WHERE bill_id NOT IN (SELECT l_orderkey FROM lineitem)"),
)
def j7(t):
    lines = t.table("lineitem").select(F.col("l_orderkey").alias("bill_id"))
    return J.non_members(t.bills, lines, "bill_id").select("bill_id", "session_id")


@query(
    "J8_update_join",
    "SELECT c_custkey, CASE WHEN n IS NULL THEN c_mktsegment ELSE 'orders_' || CAST(n AS VARCHAR) END AS c_mktsegment "
    "FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON o_custkey = c_custkey",
)
def j8(t):
    changes = t.table("orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.concat(F.lit("orders_"), F.count("*").cast("string")).alias("new")
    )
    base = t.table("customer").select("c_custkey", "c_mktsegment")
    return J.update_column(base, changes, "c_custkey", "c_mktsegment", "new")


HISTORY = """
    SELECT b.bill_id, CAST(coalesce(sum(h.passed), 0) AS BIGINT) AS hist_passed,
           CAST(coalesce(sum(h.total), 0) AS BIGINT) AS sponsor_total_bills,
           round(sum(h.passed)::DOUBLE / nullif(sum(h.total), 0), 6) AS sponsor_pass_rate
    FROM outcomes b LEFT JOIN (
        SELECT s.bill_id, e.passed, e.total
        FROM sponsors s JOIN outcomes o ON o.bill_id = s.bill_id
        JOIN (SELECT sponsor_id, introduced_date, count(*) AS total,
                     count(*) FILTER (status_new = 'Passed') AS passed
              FROM sponsors JOIN outcomes USING (bill_id) GROUP BY 1, 2) e
        ON e.sponsor_id = s.sponsor_id AND e.introduced_date < o.introduced_date - INTERVAL 365 DAY
    ) h ON h.bill_id = b.bill_id GROUP BY b.bill_id"""


@query("J10_delayed_history_join", sql_with("outcomes sponsors", HISTORY))
def j10(t):
    return rounded(delayed_history(t.outcomes, t.sponsors), "sponsor_pass_rate")


@query(
    "J12_lookup_with_fallback",
    sql_with(
        "sponsor_status",
        "SELECT bill_id, sponsor_id, round(coalesce(rate, (SELECT avg(rate) FROM rates)), 6) AS rate "
        "FROM sponsor_status LEFT JOIN rates USING (sponsor_id)",
        rates="SELECT sponsor_id, avg(CASE WHEN status_new = 'Passed' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS rate "
        "FROM sponsor_status WHERE introduced_date < DATE '1995-01-10' GROUP BY 1",
    ),
)
def j12(t):
    rates = pass_rates(t.sponsor_status.where("introduced_date < date'1995-01-10'"), "sponsor_id")
    rows = t.sponsor_status.select("bill_id", "sponsor_id")
    return rounded(J.lookup_or(rows, rates, "sponsor_id", "rate", mean_rate(rates), "rate"), "rate")


# aggregations


@query(
    "A1_bills_per_state",
    sql_with(
        "bills sessions states",
        "SELECT state_id, state_abbreviation, count(bill_id) AS n FROM bills JOIN sessions USING (session_id) "
        "JOIN states USING (state_id) GROUP BY 1, 2",
    ),
)
def a1(t):
    return t.bills.join(t.sessions, "session_id").join(t.states, "state_id").groupBy(
        "state_id", "state_abbreviation"
    ).agg(F.count("bill_id").alias("n"))


@query(
    "A2_ordered_string_aggregation",
    "SELECT l_orderkey AS bill_id, string_agg(CAST(l_suppkey AS VARCHAR), ', ' ORDER BY l_suppkey) AS sponsors FROM lineitem GROUP BY 1",
)
def a2(t):
    """Repeated sponsors stay in the list."""
    rows = t.table("lineitem").select(F.col("l_orderkey").alias("bill_id"), F.col("l_suppkey").alias("sponsor_id"))
    return Q.sponsor_list(rows)


@query(
    "A3_count_column",
    sql_with("labelled_documents", "SELECT count(doc_id) AS n_rows, count(quality) AS n_labelled FROM labelled_documents"),
)
def a3(t):
    return t.labelled_documents.agg(F.count("doc_id").alias("n_rows"), F.count("quality").alias("n_labelled"))


@query(
    "A4_group_sizes",
    sql_with("labelled_documents", "SELECT quality, toxic, count(*) AS n FROM labelled_documents WHERE quality IS NOT NULL AND toxic IS NOT NULL GROUP BY 1, 2"),
)
def a4(t):
    """Rows with a missing key are not counted."""
    return t.labelled_documents.where("quality is not null and toxic is not null").groupBy("quality", "toxic").agg(
        F.count("*").alias("n")
    )


@query(
    "A5_mean_and_median",
    sql_with(
        "labelled_documents",
        "SELECT round(avg(quality), 6) AS mean_quality, round(median(n_chars), 6) AS median_chars, "
        "round(median(quality), 6) AS median_quality FROM labelled_documents",
    ),
)
def a5(t):
    docs = t.labelled_documents.select("quality", "n_chars")
    q = exact_quantiles(docs, ["quality", "n_chars"], [0.5])

    def median(name):
        return r6(F.max(F.when(F.col("column") == name, F.col("value"))))

    mean = docs.agg(F.avg("quality")).scalar()
    return q.agg(median("n_chars").alias("median_chars"), median("quality").alias("median_quality")).select(
        r6(mean).alias("mean_quality"), "median_chars", "median_quality"
    )


@query(
    "A5_quantiles_of_large_columns",
    "SELECT round(quantile_cont(l_extendedprice, 0.5), 6) AS price_50, round(quantile_cont(l_extendedprice, 0.9), 6) AS price_90, "
    "round(quantile_cont(l_quantity, 0.25), 6) AS quantity_25 FROM lineitem",
)
def a5_quantiles(t):
    q = exact_quantiles(t.table("lineitem"), ["l_extendedprice", "l_quantity"], [0.25, 0.5, 0.9])

    def pick(name, p):
        return r6(F.max(F.when((F.col("column") == name) & (F.col("p") == p), F.col("value"))))

    return q.agg(
        pick("l_extendedprice", 0.5).alias("price_50"), pick("l_extendedprice", 0.9).alias("price_90"),
        pick("l_quantity", 0.25).alias("quantity_25"),
    )


@query("A6_min_max", "SELECT min(l_extendedprice) AS low, max(l_extendedprice) AS high FROM lineitem")
def a6(t):
    return t.table("lineitem").agg(F.min("l_extendedprice").alias("low"), F.max("l_extendedprice").alias("high"))


DOC_COLUMNS = ("doc_id", "lang", "source", "n_chars", "quality", "toxic")
MISSING = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS total, count(*) - count({c}) AS missing FROM labelled_documents"
    for c in DOC_COLUMNS
)


@query("A7_missing_values", sql_with("labelled_documents", MISSING))
def a7(t):
    return missing_values(t.labelled_documents.select(*DOC_COLUMNS))


NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
CORR = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
    for a in NUMBERS for b in NUMBERS
)


@query("A8_correlations", CORR)
def a8(t):
    return rounded(correlations(t.table("lineitem"), NUMBERS), "corr")


BOX = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(q1, 6) AS q1, round(m, 6) AS median, round(q3, 6) AS q3,
        min({c}) FILTER ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))::DOUBLE AS low_whisker,
        max({c}) FILTER ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))::DOUBLE AS high_whisker,
        count(*) FILTER (NOT {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
        FROM {src}, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS m, quantile_cont({c}, 0.75) AS q3 FROM {src})
        GROUP BY ALL"""
    for c, src in (("value", "events"), ("user_id", "events"))
)


@query("A9_box_plot_summary", BOX)
def a9(t):
    return rounded(box_plots(t.table("events"), ["value", "user_id"]), "q1", "median", "q3")


COUNTERS = """SELECT {k}, count(*) FILTER (status_new = 'Passed') AS passed,
    count(*) FILTER (status_new <> 'Passed') AS failed FROM sponsor_status GROUP BY 1"""


@query("A10_pass_counters_by_sponsor", sql_with("sponsor_status", COUNTERS.format(k="sponsor_id")))
def a10(t):
    return pass_counters(t.sponsor_status, "sponsor_id")


@query("A10_pass_counters_by_party", sql_with("sponsor_status", COUNTERS.format(k="party_id")))
def a10_party(t):
    return pass_counters(t.sponsor_status, "party_id")


RATE = "round(avg(CASE WHEN status_new = 'Passed' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6)"


@query("A11_pass_rates", sql_with("sponsor_status", f"SELECT sponsor_id, {RATE} AS rate FROM sponsor_status GROUP BY 1"))
def a11(t):
    return rounded(pass_rates(t.sponsor_status, "sponsor_id"), "rate")


@query(
    "A12_mean_of_rates",
    sql_with(
        "sponsor_status",
        "SELECT round((SELECT avg(r) FROM (SELECT avg(CASE WHEN status_new = 'Passed' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS r FROM sponsor_status GROUP BY sponsor_id)), 6) AS mean_spr, "
        "round((SELECT avg(r) FROM (SELECT avg(CASE WHEN status_new = 'Passed' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS r FROM sponsor_status GROUP BY party_id)), 6) AS mean_ppr",
    ),
)
def a12(t):
    parties = mean_rate(pass_rates(t.sponsor_status, "party_id"))
    return pass_rates(t.sponsor_status, "sponsor_id").agg(r6(F.avg("rate")).alias("mean_spr")).select(
        "mean_spr", r6(parties).alias("mean_ppr")
    )


WORDS = f"""
    SELECT {{by}} lower(word) AS word, count(*) AS n
    FROM (SELECT {{by}} unnest(regexp_split_to_array(trim(regexp_replace(text, '\\s+', ' ', 'g')), ' ')) AS word FROM documents)
    WHERE word <> '' AND word NOT IN ({STOP_SQL}) GROUP BY ALL"""


@query("A13_word_counts", WORDS.format(by=""))
def a13(t):
    return by_frequency(word_counts(t.table("documents"), "text"))


SETS = """SELECT bill_id,
    coalesce(list_sort(list(DISTINCT CAST(split_part(district, '-', 2) AS INTEGER)) FILTER (district LIKE 'SD-%')), []) AS upper,
    coalesce(list_sort(list(DISTINCT CAST(split_part(district, '-', 2) AS INTEGER)) FILTER (district LIKE 'HD-%')), []) AS lower
    FROM sponsors JOIN bills USING (bill_id) JOIN people p ON p.person_id = sponsor_id AND p.session_id = bills.session_id
    GROUP BY bill_id"""
SETS_TEXT = (
    "SELECT bill_id, array_to_string(upper, ',') AS upper, array_to_string(lower, ',') AS lower FROM sets"
)


@query("A14_district_sets", sql_with("sponsors bills people", SETS_TEXT, sets=SETS))
def a14(t):
    sets = G.district_sets(G.parsed_districts(G.sponsor_districts(t.sponsors, t.bills, t.people)))
    return sets.select(
        "bill_id",
        *[F.array_join(F.transform(c, lambda n: n.cast("string")), ",").alias(c) for c in ("upper", "lower")],
    )


@query(
    "A15_cross_tab_means",
    sql_with(
        "scores",
        "SELECT rk <= floor(0.3::DOUBLE * (SELECT count(*) FROM scores)) AS is_top, round(avg(y), 6) AS y, "
        "round(avg(session_id), 6) AS session_id FROM (SELECT *, row_number() OVER (ORDER BY score DESC, id) AS rk FROM scores) GROUP BY 1",
    ),
)
def a15(t):
    return rounded(cross_tabs(flag_top(t.scores), ["y", "session_id"]), "y", "session_id")


HISTOGRAM = """SELECT b AS bin, round(lo + b * w, 6) AS left_edge, count(score) AS n
    FROM (SELECT min(score) AS lo, (max(score) - min(score)) / 100 AS w FROM scores), range(100) r(b)
    LEFT JOIN scores ON least(floor((score - lo) / w), 99) = b GROUP BY ALL"""


@query("A16_histogram", sql_with("scores", HISTOGRAM))
def a16(t):
    return rounded(score_histogram(t.scores), "left_edge")


@query(
    "A17_mean_rates_per_bill",
    sql_with(
        "sponsor_status",
        "SELECT bill_id, round(avg(s), 6) AS spr, round(avg(p), 6) AS ppr FROM sponsor_status "
        "JOIN (SELECT sponsor_id, avg(CASE WHEN status_new = 'Passed' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS s FROM sponsor_status GROUP BY 1) USING (sponsor_id) "
        "JOIN (SELECT party_id, avg(CASE WHEN status_new = 'Passed' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS p FROM sponsor_status GROUP BY 1) USING (party_id) GROUP BY 1",
    ),
)
def a17(t):
    from foretell.operators.baseline import RateBaseline

    return rounded(RateBaseline.fit(t.sponsor_status).bill_rates(t.sponsor_status), "spr", "ppr")


YEARS = (1995, 2001)


def role_sql(skipped: int, before: int) -> str:
    """Role by year offset for one block of split (2, 1, 1, 1)."""
    off = f"(year(introduced_date) - {YEARS[0]} - {skipped})"
    return (
        f"CASE WHEN year(introduced_date) NOT BETWEEN {YEARS[0]} AND {YEARS[1]} THEN NULL "
        f"WHEN {off} < 0 THEN {before} WHEN {off} < 2 THEN 1 WHEN {off} = 2 THEN 2 "
        f"WHEN {off} = 3 THEN 3 WHEN {off} = 4 THEN 4 ELSE 0 END"
    )


BLOCK_ROLES = " UNION ALL ".join(
    f"SELECT *, {b + 1} AS block_id, {role_sql(b, 1)} AS role FROM outcomes" for b in range(3)
)


def blocked_outcomes(t, type_val=1):
    return with_block_columns(t.outcomes, "introduced_date", *YEARS, update_freq=1, type_val=type_val)


@query(
    "A18_block_summary",
    sql_with(
        "outcomes",
        "SELECT block_id, role, count(*) AS n, count(*) FILTER (status_new = 'Passed') AS positives, "
        f"{RATE} AS base_rate FROM roles WHERE role IS NOT NULL GROUP BY 1, 2", roles=BLOCK_ROLES,
    ),
)
def a18(t):
    rows = long_blocks(blocked_outcomes(t)).withColumn("y", (F.col("status_new") == "Passed").cast("int"))
    return rounded(block_summary(rows, "y"), "base_rate")


# windows


@query("W1_newest_first_numbers", sql_with("progress", NEWEST))
def w1(t):
    order = [F.col("progress_date").desc_nulls_first(), *[F.desc(c) for c in TIEBREAK]]
    return ordinal_within(t.progress, ["bill_id"], order, "seq")


@query(
    "W2_oldest_row",
    sql_with(
        "progress",
        f"SELECT bill_id, progress_date, bill_status, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY bill_id ORDER BY progress_date NULLS LAST, {TIES_DESC}) AS rn FROM progress) WHERE rn = 1",
    ),
)
def w2(t):
    """The earliest row per bill by aggregation; ties go to the higher tie-break columns."""
    back = [(-F.col(c)).alias(c) for c in TIEBREAK]
    order = F.struct(F.col("progress_date").isNull(), "progress_date", *back)
    first = t.progress.groupBy("bill_id").agg(
        F.min_by(F.struct("progress_date", "bill_status", "l_linenumber"), order).alias("r")
    )
    return first.select("bill_id", "r.*")


@query(
    "W3_explicit_row_index",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS idx FROM orders",
)
def w3(t):
    return global_ordinal(t.table("orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], "idx").select(
        "o_orderkey", "idx"
    )


@query("W4_newest_document", sql_with("texts", "SELECT bill_id, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY bill_id ORDER BY doc_date DESC NULLS FIRST, doc_id DESC) AS rn FROM texts) WHERE rn = 1"))
def w4(t):
    order = F.struct(F.col("doc_date").isNull(), "doc_date", "doc_id")
    return t.texts.groupBy("bill_id").agg(F.max_by("doc_id", order).alias("doc_id"))


@query(
    "W5_rank_of_groups",
    "SELECT l_suppkey, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, l_suppkey) AS rank FROM lineitem GROUP BY 1",
)
def w5(t):
    counts = t.table("lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"))
    return global_ordinal(counts, [F.desc("n"), "l_suppkey"], "rank")


@query("W6_delayed_pass_rate", sql_with("outcomes sponsors", f"SELECT bill_id, sponsor_pass_rate FROM ({HISTORY})"))
def w6(t):
    return rounded(delayed_history(t.outcomes, t.sponsors), "sponsor_pass_rate").select("bill_id", "sponsor_pass_rate")


@query("W7_delayed_total", sql_with("outcomes sponsors", f"SELECT bill_id, sponsor_total_bills FROM ({HISTORY})"))
def w7(t):
    return delayed_history(t.outcomes, t.sponsors).select("bill_id", "sponsor_total_bills")


@query("W8_score_rank", sql_with("scores", "SELECT id, score, y, row_number() OVER (ORDER BY score DESC, id) AS rank FROM scores"))
def w8(t):
    return ranked(t.scores.select("id", "score", "y"))


@query(
    "W9_positives_by_depth",
    sql_with(
        "scores",
        "SELECT depth, CAST(count(*) FILTER (y = 1) AS BIGINT) AS hits FROM (SELECT *, row_number() OVER (ORDER BY score DESC, id) AS rk FROM scores) "
        "JOIN (SELECT CAST(floor(d / 10.0::DOUBLE * (SELECT count(*) FROM scores)) AS BIGINT) AS depth FROM range(1, 11) r(d)) ON rk <= depth GROUP BY 1",
    ),
)
def w9(t):
    """Cumulative positives at every tenth of the ranking."""
    from foretell.operators.metrics import pr_curve

    curve = pr_curve(t.scores, step=0.1)
    return curve.select(F.col("n").alias("depth"), F.round(F.col("precision") * F.col("n")).cast("long").alias("hits"))


# sorts, limits, ordinals


@query("R1_ordered_output", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey")
def r1(t):
    return t.table("orders").select("o_orderkey", "o_orderdate", "o_totalprice").orderBy("o_orderdate", "o_orderkey")


@query("R2_top_one_per_group", "SELECT o_custkey, arg_max(o_orderkey, o_totalprice) AS o_orderkey, max(o_totalprice) AS o_totalprice FROM orders GROUP BY 1")
def r2(t):
    return t.table("orders").groupBy("o_custkey").agg(
        F.max_by("o_orderkey", "o_totalprice").alias("o_orderkey"), F.max("o_totalprice").alias("o_totalprice")
    )


TOP = """SELECT *, CAST(rank <= floor({k}::DOUBLE * (SELECT count(*) FROM scores)) AS INTEGER) AS predicted
    FROM (SELECT id, score, y, row_number() OVER (ORDER BY score DESC, id) AS rank FROM scores)"""


@query("R3_top_fraction", sql_with("scores", TOP.format(k=0.3)))
def r3(t):
    return top_fraction(t.scores.select("id", "score", "y"), 0.3)


@query("R3_top_fraction_double_arithmetic", sql_with("scores", TOP.format(k=0.29)))
def r3_double(t):
    return top_fraction(t.scores.select("id", "score", "y"), 0.29)


@query(
    "R4_global_ordinal",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, row_number() OVER "
    "(ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate) AS ordinal FROM lineitem",
)
def r4(t):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    order = [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    return global_ordinal(t.table("lineitem").select(*keys), order)


@query(
    "R5_mini_batches",
    "SELECT * FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 256 AS batch_id FROM orders) "
    "WHERE batch_id < (SELECT count(*) // 256 FROM orders)",
)
def r5(t):
    return mini_batches(t.table("orders").select("o_orderkey"), ["o_orderkey"], 256)


@query(
    "R7_top_per_group",
    "SELECT o_orderpriority, o_orderkey, o_totalprice, rank FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 3",
)
def r7(t):
    from pyspark.sql import Window as W

    best = W.partitionBy("o_orderpriority").orderBy(F.desc("o_totalprice"), "o_orderkey")
    rows = t.table("orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return rows.withColumn("rank", F.row_number().over(best)).where("rank <= 3")


# sets


@query(
    "U1_row_concat",
    "SELECT o_orderkey AS id, 'order' AS kind FROM orders UNION ALL SELECT c_custkey, 'customer' FROM customer",
)
def u1(t):
    from foretell.sources.files import concat_geographies

    orders = t.table("orders").select(F.col("o_orderkey").alias("id"), F.lit("order").alias("kind"))
    customers = t.table("customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"))
    return concat_geographies([orders, customers])


@query(
    "U2_sets_that_intersect",
    sql_with(
        "sponsors bills people",
        "SELECT DISTINCT bill_id FROM sponsors JOIN bills USING (bill_id) JOIN people p ON p.person_id = sponsor_id "
        "AND p.session_id = bills.session_id WHERE district IN ('SD-008', 'SD-023', 'SD-028', 'SD-001', 'SD-009')",
    ),
)
def u2(t):
    sets = G.district_sets(G.parsed_districts(G.sponsor_districts(t.sponsors, t.bills, t.people)))
    wanted = F.array(*[F.lit(n) for n in G.GROUP_DISTRICTS["asian"]["upper"]])
    return sets.where(F.arrays_overlap("upper", wanted)).select("bill_id")


LANG_WORDS = WORDS.format(by="lang,")


@query(
    "U3_vocabulary_difference",
    f"WITH w AS ({LANG_WORDS}) SELECT word, n FROM w WHERE lang = 'en' AND word NOT IN (SELECT word FROM w WHERE lang = 'fr')",
)
def u3(t):
    from foretell.operators.textstats import words_only_in

    return words_only_in(word_counts(t.table("documents"), "text", ["lang"]), "lang", "en", "fr")


@query("U4_distinct", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def u4(t):
    return t.table("lineitem").select("l_partkey", "l_suppkey").distinct()
