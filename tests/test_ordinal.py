import random

import pytest
from pyspark.sql import functions as F

from foretell.operators import ordinal as O


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    # group 0 holds over half of the rows and many equal scores
    return [(i, rng.choice([0, 0, 0, 1, 2]), float(rng.randint(0, 20))) for i in range(3000)]


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_global_ordinal_is_sorted_position(spark, rows, parts):
    df = spark.createDataFrame(rows, "id long, g int, score double").repartition(parts)
    got = {r.id: r.ordinal for r in O.global_ordinal(df, [F.desc("score"), "id"]).collect()}
    want = sorted(rows, key=lambda r: (-r[2], r[0]))
    assert got == {r[0]: i + 1 for i, r in enumerate(want)}


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_ordinal_within_hot_group(spark, rows, parts):
    """The hot group spans ranges, the others lie inside one."""
    df = spark.createDataFrame(rows, "id long, g int, score double").repartition(parts)
    numbered = O.ordinal_within(df, ["g"], [F.desc("score"), "id"], "seq")
    got = {r.id: r.seq for r in numbered.collect()}
    want = {}
    for g in (0, 1, 2):
        mine = sorted((r for r in rows if r[1] == g), key=lambda r: (-r[2], r[0]))
        want.update({r[0]: i + 1 for i, r in enumerate(mine)})
    assert got == want


def test_null_keys_keep_their_group(spark):
    df = spark.createDataFrame([(i, None) for i in range(50)], "id long, g string")
    got = O.ordinal_within(df, ["g"], ["id"], "seq")
    assert got.where("seq = id + 1").count() == 50
    assert O.ordinal_within(df.limit(0), ["g"], ["id"], "seq").count() == 0


def test_no_task_holds_a_whole_hot_group(spark):
    df = spark.range(20_000).select("id", F.lit(1).alias("g"))
    placed = O.sorted_ranges(df, ["g", "id"])
    sizes = [r["count"] for r in placed.groupBy("__pid").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 20_000


def test_ranges_follow_the_rows(spark, monkeypatch):
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert [O.range_count(spark, n) for n in (0, 1, 4096, 4097, 10**6)] == [1, 1, 1, min(2, usual), usual]
    assert O.range_count(spark, 10**12) == -(-(10**12) // O.MOST_RANGE_ROWS)
    df = spark.range(500)
    assert O.sorted_ranges(df, ["id"]).select("__pid").distinct().count() == 1
    monkeypatch.setattr(O, "LEAST_RANGE_ROWS", 100)
    assert O.sorted_ranges(df, ["id"]).select("__pid").distinct().count() > 1
    assert O.sorted_ranges(df, ["id"], rows=1).select("__pid").distinct().count() == 1


def test_mini_batches(spark):
    df = spark.range(10)
    sizes = {r.batch_id: r["count"] for r in O.mini_batches(df, ["id"], 4).groupBy("batch_id").count().collect()}
    assert sizes == {0: 4, 1: 4}
    assert O.mini_batches(df, ["id"], 4, drop_tail=False).count() == 10


def test_exact_quantiles(spark):
    rng = random.Random(1)
    data = [(float(rng.randint(0, 50)), rng.random() if i % 3 else None) for i in range(997)]
    df = spark.createDataFrame(data, "a double, b double").repartition(5)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {(r.column, r.p): r.value for r in O.exact_quantiles(df, ["a", "b"], probs).collect()}
    for name in ("a", "b"):
        want = df.agg(F.percentile(name, F.array(*[F.lit(p) for p in probs])).alias("q")).first().q
        for p, v in zip(probs, want):
            assert got[(name, p)] == pytest.approx(v)
    assert len(got) == 10
