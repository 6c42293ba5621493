from datetime import date

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foretell.functions import scalar as X
from foretell.functions import stemming
from foretell.functions.stemming import stem_word
from foretell.functions.text import STOPWORDS, clean_text, clean_tokens, drop_stopwords, keyword_flag, whitespace_tokens, word_tokens
from foretell.operators import textstats as TS
from foretell.operators.preprocess import preprocess
from foretell.sources import artifacts, files, tables


# examples printed in the 1980 paper, and the later amendments
STEMS = {
    "caresses": "caress", "ponies": "poni", "caress": "caress", "cats": "cat", "feed": "feed",
    "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing",
    "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan",
    "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file",
    "happy": "happi", "relational": "relat", "conditional": "condit", "valenci": "valenc",
    "digitizer": "digit", "conformabli": "conform", "radicalli": "radic", "differentli": "differ",
    "vileli": "vile", "analogousli": "analog", "vietnamization": "vietnam", "predication": "predic",
    "operator": "oper", "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope",
    "callousness": "callous", "formaliti": "formal", "sensitiviti": "sensit", "sensibiliti": "sensibl",
    "triplicate": "triplic", "formative": "form", "formalize": "formal", "electriciti": "electr",
    "electrical": "electr", "hopeful": "hope", "goodness": "good", "revival": "reviv",
    "allowance": "allow", "inference": "infer", "airliner": "airlin", "gyroscopic": "gyroscop",
    "adjustable": "adjust", "defensible": "defens", "irritant": "irrit", "replacement": "replac",
    "adjustment": "adjust", "dependent": "depend", "adoption": "adopt", "homologou": "homolog",
    "communism": "commun", "activate": "activ", "angulariti": "angular", "homologous": "homolog",
    "effective": "effect", "bowdlerize": "bowdler", "probate": "probat", "rate": "rate",
    "cease": "ceas", "controll": "control", "roll": "roll",
    "skies": "sky", "dying": "die", "ties": "tie", "died": "die", "enjoy": "enjoy", "by": "by",
    "taxes": "tax", "legislative": "legisl", "bills": "bill",
}


@pytest.mark.parametrize("word, stem", sorted(STEMS.items()))
def test_stems(word, stem):
    assert stem_word(word) == stem


def test_clean_text(spark):
    df = spark.createDataFrame([(None,), (" The 3 Taxes, don't! ",), ("We cannot; gonna",), ("",)], "t string")
    got = [r[0] for r in df.select(clean_tokens("t")).collect()]
    assert got == [None, ["taxes", "dont"], ["gon", "na"], []]
    assert [r[0] for r in df.select(clean_text("t")).collect()] == [None, "tax dont", "gon na", ""]


def test_a_word_is_stemmed_once_for_a_batch(spark, monkeypatch):
    seen, stem = [], stemming._lower_stem
    monkeypatch.setattr(stemming, "_lower_stem", lambda w: seen.append(w) or stem(w))
    texts = pa.array(["taxes bills taxes", None, "", " bills  taxes"])
    assert stemming.stem_texts(texts).to_pylist() == ["tax bill tax", None, "", " bill  tax"]
    assert stemming.stem_texts(texts.slice(1)).to_pylist() == [None, "", " bill  tax"]
    assert sorted(seen[:3]) == ["", "bills", "taxes"] and len(seen) == 6
    monkeypatch.undo()
    stemming._remembered.cache_clear()
    assert stemming.stem_word("b" * 50 + "ing") == "b" * 50 + "ing" and not stemming._remembered.cache_info().currsize
    df = spark.createDataFrame([(" ".join(STEMS),), (None,), ("",)], "t string").selectExpr("t", "cast(x'7461786573ff20c3' as string) as bytes")
    cleaned = df.select(clean_text("t").alias("t"), stemming.stem_words("bytes").alias("bytes"))
    want = " ".join(stem for word, stem in STEMS.items() if word not in STOPWORDS)
    assert [r.t for r in cleaned.collect()] == [want, None, ""] and cleaned.first().bytes == "taxes\ufffd \ufffd"
    # not an expression that is interpreted for every token
    assert "ArrowEvalPython" in cleaned._jdf.queryExecution().optimizedPlan().toString()


def test_tokens_and_stopwords(spark):
    df = spark.createDataFrame([("The the tax-Bill a É2",)], "t string")
    assert df.select(drop_stopwords(whitespace_tokens("t"))).first()[0] == ["The", "tax-Bill", "É2"]
    assert df.select(word_tokens("t")).first()[0] == ["the", "the", "tax", "bill", "é2"]
    plan = df.select(drop_stopwords(whitespace_tokens("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert "INSET" in plan  # one hash test per token


def test_word_counts_and_topics(spark):
    df = spark.createDataFrame([("a", "The the tax"), ("b", "tax Visa"), ("b", None)], "g string, t string")
    counts = TS.word_counts(df, "t", ["g"])
    assert {(r.g, r.word): r.n for r in counts.collect()} == {("a", "the"): 1, ("a", "tax"): 1, ("b", "tax"): 1, ("b", "visa"): 1}
    assert [r.word for r in TS.words_only_in(counts, "g", "a", "b").collect()] == ["the"]
    topics = {r.g: (r.n_texts, r.n_immigration) for r in TS.topic_counts(df, "t", ["g"]).collect()}
    assert topics == {"a": (1, 0), "b": (2, 1)}
    assert df.select(F.count_if(keyword_flag("t", "tax"))).first()[0] == 2


def test_scalars(spark):
    df = spark.createDataFrame([("SD-013",), ("HD-101",), ("013",), (None,), ("SD-x",), ("A-B-1",)], "d string")
    got = [tuple(r) for r in df.select(X.district_chamber("d"), X.district_number("d"), X.is_bad_district("d")).collect()]
    assert got == [("upper", 13, False), ("lower", 101, False), (None, None, True), (None, None, True), ("upper", None, True), (None, None, True)]
    dates = spark.createDataFrame([("2020-02-29",), ("",), (None,)], "s string")
    assert [r[0] for r in dates.select(X.parse_iso_date("s")).collect()] == [date(2020, 2, 29), None, None]
    assert spark.range(1).select(X.id_list(F.lit("12, 45"))).first()[0] == [12, 45]
    assert spark.range(1).select(X.ratio(F.lit(1), F.lit(0))).first()[0] is None
    assert [X.normalized_header(h) for h in ("State Name", "# of x", "a-b!")] == ["state_name", "num_of_x", "ab"]


def test_preprocess(spark):
    df = spark.createDataFrame([("5", "x", "The Taxes")], "a string, b string, t string")
    out = preprocess(df, {"t": ["clean_text_data", "rename::clean"], "a": ["retype::int64"]})
    assert out.columns == ["clean", "a"] and tuple(out.first()) == ("tax", 5)
    bad = spark.createDataFrame([("five",)], "a string")
    assert preprocess(bad, {"a": ["retype::int64"]}, strict=False).first().a is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        preprocess(bad, {"a": ["retype::int64"]}).collect()
    with pytest.raises(ValueError):
        preprocess(df, {"a": ["lemmatize"]})


def test_session_dates_csv(spark, tmp_path):
    path = tmp_path / "dates.csv"
    path.write_text(
        "session_entry_id,session_year,state_name,convene_date,adjourn_date,special,notes\n"
        '1,2011,alabama,2011-03-01,2011-06-09,f,""\n'
        '2,2011,alaska,2011-01-18,,t,"two ""quoted""\nlines"\n'
    )
    first, second = files.read_session_dates(spark, str(path)).orderBy("session_entry_id").collect()
    assert first.adjourn_date == date(2011, 6, 9) and first.special is False
    assert second.adjourn_date is None and second.special is True and second.notes == 'two "quoted"\nlines'


def test_district_codes_stay_text(spark, tmp_path):
    path = tmp_path / "races.csv"
    path.write_text(
        "state,state_legislative_district_upper_chamber,race_white,race_black,race_asian\n"
        "17,001,10,20,30\n17,ZZZ,0,0,0\n"
    )
    got = files.read_district_races(spark, str(path)).collect()
    assert [(r[0], r[1], r.race_asian) for r in got] == [("17", "001", 30), ("17", "ZZZ", 0)]


def test_variable_list(spark, tmp_path):
    path = tmp_path / "vars.txt"
    path.write_text("('C1', 'race_white', 'Estimate!!White')\n('C2', 'race_black', \"Estimate!!Black's\")\n")
    variables = files.read_variable_list(spark, str(path))
    assert [tuple(r) for r in variables.orderBy("code").collect()] == [("C1", "race_white", "Estimate!!White"), ("C2", "race_black", "Estimate!!Black's")]
    df = spark.createDataFrame([(1, 2, 3)], "C1 int, C2 int, other int")
    assert files.rename_by_variables(df, variables).columns == ["race_white", "race_black", "other"]
    assert files.search_variables(variables, "WHITE").count() == 1


def test_headers_and_keys(spark):
    with pytest.raises(ValueError):
        files.normalize_columns(spark.createDataFrame([(1, 2)], ["a b", "A B"]))
    assert files.geography_keys(["state", "county", "tract", "block_group", "x"]) == ["state", "county", "tract", "block_group"]
    assert files.geography_keys(["state", "race"]) == ["state"]
    with pytest.raises(ValueError):
        files.keyed_extract(spark.createDataFrame([("17", 1), ("17", 2)], "state string, n int"))


def test_tables(spark):
    out = tables.table_from_query(spark, "SELECT 1 AS a, 'x' AS b;", "t_schema", "t")
    assert out.collect()[0].a == 1
    assert tables.table_from_query(spark, "SELECT 2 AS c", "t_schema", "t").columns == ["c"]
    tables.drop_table(spark, "t_schema", "t")
    assert not spark.catalog.tableExists("t_schema.t")
    df = spark.createDataFrame([(3, "2020-01-02", 1.5), (1, "", 2.5)], "k int, introduced_date string, x float")
    written = tables.write_table(df, "t_schema", "typed", ["k"])
    assert dict(written.dtypes) == {"id": "bigint", "k": "bigint", "introduced_date": "date", "x": "double"}
    assert [(r.id, r.introduced_date) for r in written.orderBy("id").collect()] == [(0, None), (1, date(2020, 1, 2))]


def test_write_column(spark):
    first = spark.createDataFrame([(1, 10), (2, 20)], "k long, v long")
    tables.write_column(spark, first, "k", "v", "t_schema", "cols")
    out = tables.write_column(spark, spark.createDataFrame([(2, "b"), (9, "z")], "k long, w string"), "k", "w", "t_schema", "cols")
    assert sorted(tuple(r) for r in out.collect()) == [(1, 10, None), (2, 20, "b")]
    with pytest.raises(ValueError):
        tables.write_column(spark, first, "k", "v", "t_schema", "cols")


def test_artifacts(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return spark.createDataFrame([("text", "tax", 0)], artifacts.VOCABULARY)

    path = str(tmp_path / "vocab")
    for _ in range(2):
        assert artifacts.vocabulary_at(spark, path, build).first().term == "tax"
    assert len(built) == 1
    groups = spark.createDataFrame([("white", 1), ("black", 2)], "`group` string, bill_id long")
    artifacts.save_groups(groups, str(tmp_path / "groups"))
    one = artifacts.load_groups(spark, str(tmp_path / "groups")).where("group = 'black'")
    assert [r.bill_id for r in one.collect()] == [2]
    assert "PartitionFilters: [isnotnull(group" in one._jdf.queryExecution().executedPlan().toString()
