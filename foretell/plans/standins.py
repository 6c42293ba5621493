"""The relations of the library, defined on the shared test tables.

Each relation is stated twice: as a DataFrame here and as a SQL view body in
``standin_sql``, so that results can be compared across engines.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foretell.operators.facts import final_text, sponsor_list
from foretell.operators.joins import members_only
from foretell.session import scratch_path, small_table

# fixed values: status codes and names
STATUS_NAMES = (
    (1, "Introduced"), (2, "Engrossed"), (3, "Enrolled"), (4, "Passed"), (5, "Vetoed"), (6, "Failed"),
)
# census figures as aggregates of the year's orders, the same in both engines
CENSUS_OF = {
    "population": "count(*)", "median_age": "avg(o_custkey % 90)", "median_income": "avg(o_totalprice)",
} | {
    name: f"avg(CASE WHEN {column} = '{value}' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)"
    for name, column, value in (
        ("female_ratio", "o_orderpriority", "1-URGENT"), ("black_ratio", "o_orderpriority", "2-HIGH"),
        ("asian_ratio", "o_orderpriority", "3-MEDIUM"), ("white_ratio", "o_orderpriority", "5-LOW"),
        ("high_education", "o_orderstatus", "O"), ("unemployment", "o_orderstatus", "P"), ("poverty", "o_orderstatus", "F"),
    )
}
TIEBREAK = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


class Relations:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def bills(self) -> DataFrame:
        urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
        return self.table("orders").select(
            F.col("o_orderkey").alias("bill_id"),
            F.col("o_custkey").alias("session_id"),
            F.col("o_orderdate").cast("date").alias("introduced_date"),
            F.when(urgent, "S").otherwise("H").alias("introduced_body"),
            F.when(F.col("o_orderpriority") == "5-LOW", "R").otherwise("B").alias("bill_type"),
        )

    @cached_property
    def sessions(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("session_id"), F.col("c_nationkey").cast("int").alias("state_id")
        )

    @cached_property
    def states(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").cast("int").alias("state_id"),
            F.col("n_name").alias("state_abbreviation"),
        )

    @cached_property
    def bill_state(self) -> DataFrame:
        return self.bills.join(self.sessions, "session_id").select("state_id", "bill_id")

    @cached_property
    def progress(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("bill_id"),
            F.col("l_shipdate").cast("date").alias("progress_date"),
            F.when(F.col("l_linestatus") == "O", 4).otherwise(6).alias("bill_status"),
            *TIEBREAK,
        )

    @cached_property
    def status_catalog(self) -> DataFrame:
        return small_table(self.spark, STATUS_NAMES, "status_id int, status string")

    @cached_property
    def sponsors(self) -> DataFrame:
        return self.sponsors_of()

    def sponsors_of(self, wanted: DataFrame | None = None) -> DataFrame:
        """Distinct sponsors of every bill, or of the ``wanted`` ones alone."""
        pairs = self.table("lineitem").select(
            F.col("l_orderkey").alias("bill_id"), F.col("l_suppkey").alias("sponsor_id")
        )
        if wanted is not None:
            pairs = members_only(pairs, wanted, "bill_id")
        # dealt by bill, so that everything grouped by bill below shares this one shuffle
        pairs = pairs.repartition("bill_id").distinct()
        parties = self.table("supplier").select(
            F.col("s_suppkey").alias("sponsor_id"), (F.col("s_nationkey") % 3).cast("int").alias("party_id")
        )
        return pairs.join(parties, "sponsor_id").select("bill_id", "sponsor_id", "party_id")

    @cached_property
    def people(self) -> DataFrame:
        """Every sponsor sits in the sessions of the bills they sponsored."""
        seats = self.sponsors.join(self.bill_session, "bill_id").select(
            "session_id", F.col("sponsor_id").alias("person_id")
        ).distinct()
        chamber = F.when(F.col("person_id") % 2 == 0, "SD-").otherwise("HD-")
        number = F.lpad((F.col("person_id") % 59 + 1).cast("string"), 3, "0")
        return seats.join(self.sessions, "session_id").select(
            "session_id", "person_id", "state_id", F.concat(chamber, number).alias("district")
        )

    @cached_property
    def bill_session(self) -> DataFrame:
        return self.bills.select("bill_id", "session_id")

    @cached_property
    def session_dates(self) -> DataFrame:
        return self.bills.groupBy("session_id").agg(
            F.min("introduced_date").alias("start_date"), F.max("introduced_date").alias("end_date")
        )

    @cached_property
    def texts(self) -> DataFrame:
        """About three versions per bill; type 1 on even document ids."""
        return self.table("documents").select(
            F.expr("doc_id div 3").alias("bill_id"),
            "doc_id",
            (F.col("doc_id") % 2 + 1).cast("int").alias("type_id"),
            F.date_add(F.lit("2010-01-01").cast("date"), F.col("doc_id").cast("int")).alias("doc_date"),
            F.col("text").alias("doc"),
            F.concat_ws(" ", "lang", "source").alias("bill_description"),
        )

    @cached_property
    def acs(self) -> DataFrame:
        """One row per year."""
        per_year = self.table("orders").groupBy(F.year("o_orderdate").alias("year")).agg(
            F.count("*").alias("population"),
            F.round(F.avg("o_totalprice"), 6).alias("median_income"),
            F.round(F.avg((F.col("o_orderstatus") == "F").cast("double")), 6).alias("poverty"),
        )
        return per_year

    @cached_property
    def composition(self) -> DataFrame:
        return self.composition_of(self.sponsors)

    @staticmethod
    def composition_of(sponsors: DataFrame, *others: Column) -> DataFrame:
        """Sponsor counts per bill, and other aggregates of its sponsors."""
        return sponsors.groupBy("bill_id").agg(
            F.count("*").alias("sponsor_count"),
            F.count_if(F.col("party_id") == 2).alias("rep_sponsor_count"),
            F.count_if(F.col("sponsor_id") % 2 == 0).alias("sen_sponsor_count"), *others,
        )

    @cached_property
    def outcomes(self) -> DataFrame:
        """Bills with a status for the history operators: F orders passed."""
        passed = F.when(F.col("o_orderstatus") == "F", "Passed").otherwise("Failed")
        return self.table("orders").select(
            F.col("o_orderkey").alias("bill_id"),
            F.col("o_orderdate").cast("date").alias("introduced_date"),
            passed.alias("status_new"),
        )

    @cached_property
    def facts(self) -> DataFrame:
        """The labelled fact of every sponsored bill, with packed sponsor lists."""
        return self.facts_of(self.sponsors, self.outcomes, self.bills, self.session_dates)

    def facts_of(self, sponsors: DataFrame, outcomes: DataFrame, bills: DataFrame, session_dates: DataFrame) -> DataFrame:
        composition = self.composition_of(sponsors, F.min_by("party_id", "sponsor_id").alias("party_id"))
        # sessions are joined while rows are thin
        dated = bills.select("bill_id", "session_id", "introduced_body").join(
            session_dates.withColumnsRenamed(
                {"start_date": "session_start_date", "end_date": "session_end_date"}
            ),
            "session_id",
        ).drop("session_id")
        return (
            outcomes.join(dated, "bill_id")
            .join(sponsor_list(sponsors), "bill_id")
            .join(composition, "bill_id")
            .select(
                "bill_id", "introduced_date", "status_new", "introduced_body", "party_id", "sponsors",
                "sponsor_count", "rep_sponsor_count", "sen_sponsor_count", "session_start_date", "session_end_date",
            )
        )

    def chambers_of(self, sponsors: DataFrame, bill_session: DataFrame) -> DataFrame:
        """Shares of parties 1 and 2 among the senate and house seats of a session; null where a chamber has none."""
        seats = sponsors.join(bill_session, "bill_id").select("session_id", "sponsor_id", "party_id").distinct()
        senate = F.col("sponsor_id") % 2 == 0
        share = lambda party, seat: F.avg(F.when(seat, (F.col("party_id") == party).cast("double")))
        return seats.groupBy("session_id").agg(
            share(1, senate).alias("dem_senate_perc"), share(2, senate).alias("rep_senate_perc"),
            share(1, ~senate).alias("dem_house_perc"), share(2, ~senate).alias("rep_house_perc"),
        )

    @cached_property
    def chambers(self) -> DataFrame:
        return self.chambers_of(self.sponsors, self.bill_session)

    @cached_property
    def census(self) -> DataFrame:
        """Population figures, one row per year."""
        return self.table("orders").groupBy(F.year("o_orderdate").alias("year")).agg(
            *[F.expr(e).alias(n) for n, e in CENSUS_OF.items()]
        )

    def _written(self, rows: DataFrame, label: str) -> DataFrame:
        """``rows`` written once and read back, so that the planner knows their size."""
        path = scratch_path(self.spark, label)
        rows.write.parquet(path)
        return self.spark.read.parquet(path)

    @cached_property
    def described_facts(self) -> DataFrame:
        """The fact with every column a named feature set reads, for bills with a text of type 1.

        The inner join to the texts is drawn forward: keys of bills with a text, and of their sessions, are written, and
        sponsor rows are semi-joined to them before they are shuffled and aggregated. A session's dates and seats
        come from all of its bills.
        """
        typed = self.texts.where("type_id = 1 and bill_id is not null").select("bill_id").distinct()
        wanted = self._written(members_only(self.bill_session, typed, "bill_id"), "described-bills")
        sessions = wanted.select("session_id").distinct()
        their_bills = self._written(members_only(self.bills.drop("bill_type"), sessions, "session_id"), "described-sessions")
        session_dates = their_bills.groupBy("session_id").agg(
            F.min("introduced_date").alias("start_date"), F.max("introduced_date").alias("end_date")
        )
        only = lambda rows: members_only(rows, wanted, "bill_id")
        sponsors = self.sponsors_of(their_bills)
        facts = self.facts_of(only(sponsors), only(self.outcomes), only(their_bills), session_dates)
        bill_session = their_bills.select("bill_id", "session_id")
        chambers = self.chambers_of(sponsors, bill_session)
        texts = final_text(self.texts).select("bill_id", "bill_description", F.col("doc").alias("bill_text"))
        return (
            facts.join(only(bill_session), "bill_id").join(chambers, "session_id")
            .withColumn("year", F.year("introduced_date")).join(self.census, "year")
            .join(texts, "bill_id").drop("session_id", "year")
        )

    @cached_property
    def sponsor_status(self) -> DataFrame:
        """Sponsor rows with the outcome of their bill."""
        return self.sponsors.join(self.outcomes, "bill_id").select(
            "sponsor_id", "party_id", "bill_id", "status_new", "introduced_date"
        )

    @cached_property
    def scores(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("id"),
            F.col("o_totalprice").alias("score"),
            (F.col("o_orderstatus") == "F").cast("int").alias("y"),
            F.col("o_custkey").alias("session_id"),
        )

    @cached_property
    def grouped_scores(self) -> DataFrame:
        """Scores with an audit group per row."""
        party = self.table("customer").select(
            F.col("c_custkey").alias("session_id"),
            F.concat(F.lit("g"), (F.col("c_nationkey") % 3).cast("string")).alias("group"),
        )
        return self.scores.join(party, "session_id").select("id", "score", "y", "group")

    @cached_property
    def labelled_documents(self) -> DataFrame:
        """Documents with nullable labels."""
        return self.table("documents").join(self.table("labels"), "doc_id", "left").select(
            "doc_id", "lang", "source", "n_chars", "quality", "toxic", "text"
        )


_STATUS_VALUES = ", ".join(f"({i}, '{n}')" for i, n in STATUS_NAMES)

standin_sql: dict[str, str] = {
    "bills": """
        SELECT o_orderkey AS bill_id, o_custkey AS session_id,
               CAST(o_orderdate AS DATE) AS introduced_date,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'S' ELSE 'H' END AS introduced_body,
               CASE WHEN o_orderpriority = '5-LOW' THEN 'R' ELSE 'B' END AS bill_type
        FROM orders""",
    "sessions": "SELECT c_custkey AS session_id, CAST(c_nationkey AS INTEGER) AS state_id FROM customer",
    "states": "SELECT CAST(n_nationkey AS INTEGER) AS state_id, n_name AS state_abbreviation FROM nation",
    "bill_state": "SELECT state_id, bill_id FROM bills JOIN sessions USING (session_id)",
    "progress": """
        SELECT l_orderkey AS bill_id, CAST(l_shipdate AS DATE) AS progress_date,
               CASE WHEN l_linestatus = 'O' THEN 4 ELSE 6 END AS bill_status,
               l_linenumber, l_partkey, l_suppkey, l_extendedprice
        FROM lineitem""",
    "status_catalog": f"SELECT * FROM (VALUES {_STATUS_VALUES}) AS s(status_id, status)",
    "sponsors": """
        SELECT DISTINCT l_orderkey AS bill_id, l_suppkey AS sponsor_id,
               CAST(s_nationkey % 3 AS INTEGER) AS party_id
        FROM lineitem JOIN supplier ON s_suppkey = l_suppkey""",
    "people": """
        SELECT DISTINCT session_id, sponsor_id AS person_id, state_id,
               CASE WHEN sponsor_id % 2 = 0 THEN 'SD-' ELSE 'HD-' END
                 || lpad(CAST(sponsor_id % 59 + 1 AS VARCHAR), 3, '0') AS district
        FROM sponsors JOIN bills USING (bill_id) JOIN sessions USING (session_id)""",
    "session_dates": """
        SELECT session_id, min(introduced_date) AS start_date, max(introduced_date) AS end_date
        FROM bills GROUP BY session_id""",
    "texts": """
        SELECT doc_id // 3 AS bill_id, doc_id, CAST(doc_id % 2 + 1 AS INTEGER) AS type_id,
               CAST(DATE '2010-01-01' + CAST(doc_id AS INTEGER) AS DATE) AS doc_date, text AS doc,
               lang || ' ' || source AS bill_description
        FROM documents""",
    "acs": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS population,
               round(avg(o_totalprice), 6) AS median_income,
               round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS poverty
        FROM orders GROUP BY 1""",
    "composition": """
        SELECT bill_id, count(*) AS sponsor_count,
               count(*) FILTER (party_id = 2) AS rep_sponsor_count,
               count(*) FILTER (sponsor_id % 2 = 0) AS sen_sponsor_count
        FROM sponsors GROUP BY bill_id""",
    "outcomes": """
        SELECT o_orderkey AS bill_id, CAST(o_orderdate AS DATE) AS introduced_date,
               CASE WHEN o_orderstatus = 'F' THEN 'Passed' ELSE 'Failed' END AS status_new
        FROM orders""",
    "sponsor_status": """
        SELECT sponsor_id, party_id, bill_id, status_new, introduced_date
        FROM sponsors JOIN outcomes USING (bill_id)""",
    "facts": """
        SELECT bill_id, introduced_date, status_new, introduced_body, party_id, sponsors,
               sponsor_count, rep_sponsor_count, sen_sponsor_count,
               start_date AS session_start_date, end_date AS session_end_date
        FROM outcomes JOIN (SELECT bill_id, session_id, introduced_body FROM bills) USING (bill_id)
        JOIN (SELECT bill_id, arg_min(party_id, sponsor_id) AS party_id,
                     string_agg(CAST(sponsor_id AS VARCHAR), ', ' ORDER BY sponsor_id) AS sponsors
              FROM sponsors GROUP BY bill_id) USING (bill_id)
        JOIN composition USING (bill_id) JOIN session_dates USING (session_id)""",
    "chambers": """
        SELECT session_id, avg(CASE WHEN party_id = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) FILTER (sponsor_id % 2 = 0) AS dem_senate_perc,
               avg(CASE WHEN party_id = 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) FILTER (sponsor_id % 2 = 0) AS rep_senate_perc,
               avg(CASE WHEN party_id = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) FILTER (sponsor_id % 2 <> 0) AS dem_house_perc,
               avg(CASE WHEN party_id = 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) FILTER (sponsor_id % 2 <> 0) AS rep_house_perc
        FROM (SELECT DISTINCT session_id, sponsor_id, party_id FROM sponsors JOIN bills USING (bill_id)) GROUP BY 1""",
    "census": f"""
        SELECT CAST(year(o_orderdate) AS INTEGER) AS year, {', '.join(f'{e} AS {n}' for n, e in CENSUS_OF.items())}
        FROM orders GROUP BY 1""",
    "described_facts": """
        SELECT f.*, dem_senate_perc, rep_senate_perc, dem_house_perc, rep_house_perc, population, median_age, median_income,
               female_ratio, black_ratio, asian_ratio, white_ratio, high_education, unemployment, poverty, bill_description, bill_text
        FROM facts f JOIN (SELECT bill_id, session_id FROM bills) USING (bill_id) JOIN chambers USING (session_id)
        JOIN census ON census.year = year(introduced_date)
        JOIN (SELECT bill_id, arg_max(bill_description, doc_date) AS bill_description, arg_max(doc, doc_date) AS bill_text
              FROM texts WHERE type_id = 1 GROUP BY 1) USING (bill_id)""",
    "scores": """
        SELECT o_orderkey AS id, o_totalprice AS score,
               CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y, o_custkey AS session_id
        FROM orders""",
    "grouped_scores": """
        SELECT id, score, y, 'g' || CAST(c_nationkey % 3 AS VARCHAR) AS "group"
        FROM scores JOIN customer ON c_custkey = session_id""",
    "labelled_documents": """
        SELECT d.doc_id, lang, source, n_chars, quality, toxic, text
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
}

_NEEDS = {
    "bill_state": ("bills", "sessions"),
    "people": ("sponsors", "bills", "sessions"),
    "session_dates": ("bills",),
    "composition": ("sponsors",),
    "grouped_scores": ("scores",),
    "sponsor_status": ("sponsors", "outcomes"),
    "chambers": ("sponsors", "bills"),
    "described_facts": ("facts", "bills", "chambers", "census", "texts"),
    "facts": ("outcomes", "bills", "sponsors", "composition", "session_dates"),
}


def sql_with(names: str, body: str, **extra: str) -> str:
    """``body`` preceded by the named stand-in views (and what they need) and extra views."""
    wanted: list[str] = []

    def need(name: str) -> None:
        for other in _NEEDS.get(name, ()):
            need(other)
        if name not in wanted:
            wanted.append(name)

    for name in names.split():
        need(name)
    views = {n: standin_sql[n] for n in wanted} | extra
    return "WITH " + ", ".join(f"{n} AS ({q})" for n, q in views.items()) + " " + body
