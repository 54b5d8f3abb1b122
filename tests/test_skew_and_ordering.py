import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from smeltworks.operators import skew
from smeltworks.operators.dedup import latest_by
from smeltworks.operators.ordering import add_history, add_ranks
from smeltworks.operators.skew import hot_keys, join_unique, orphans
from smeltworks.plans import analytics
from smeltworks.sources.scratch import materialise


@pytest.fixture(scope="module")
def skewed(spark):
    """1,200 rows, a third of them on key 7, some NULL keys."""
    rnd = random.Random(1)
    keys = [7] * 400 + [None] * 50 + [rnd.randint(0, 60) for _ in range(750)]
    return materialise(spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id int, k int"))


@pytest.fixture(scope="module")
def parents(spark):
    return spark.createDataFrame([(k, f"p{k}") for k in range(0, 61, 2)] + [(7, "p7")], "k int, name string")


def test_hot_keys_get_parts_by_their_weight(skewed):
    assert hot_keys(skewed, ["k"]).isEmpty()
    ((found, parts),) = hot_keys(skewed, ["k"], hot_rows=100).collect()
    assert found == skewed.where("k = 7").select(F.xxhash64("k")).first()[0]
    assert parts >= 4


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_split_join_equals_plain_join(skewed, parents, rows, how, null_safe):
    parents = parents.unionByName(parents.sparkSession.createDataFrame([(None, "none")], "k int, name string"))
    hot = hot_keys(skewed, ["k"], hot_rows=30)
    assert hot.count() >= 2 - (not null_safe)
    split = join_unique(skewed, parents, ["k"], how, hot=hot, null_safe=null_safe)
    plain = join_unique(skewed, parents, ["k"], how, hot=False, null_safe=null_safe)
    assert split.columns == plain.columns
    assert rows(split) == rows(plain)


def test_split_join_spreads_the_hot_key(skewed, parents):
    hot = hot_keys(skewed, ["k"], hot_rows=100)
    spark = skewed.sparkSession
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = join_unique(skewed, parents, ["k"], "inner", hot=hot).where("k = 7").select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert tasks > 1


def test_join_keys_of_different_types_are_refused(skewed, parents):
    with pytest.raises(TypeError):
        join_unique(skewed, parents.withColumn("k", F.col("k").cast("bigint")), ["k"])


def test_orphans(skewed, parents, rows):
    known = {r.k for r in parents.collect()}
    want = [(r.id, r.k) for r in skewed.collect() if r.k not in known]
    assert rows(orphans(skewed, parents, ["k"]), "id", "k") == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_latest_by_cuts_before_the_shuffle(skewed):
    df = latest_by(skewed, ["k"], ["id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert df.count() == skewed.select("k").distinct().count()


@pytest.fixture(scope="module")
def scores(spark):
    """Ties, a NULL group, NULL values, a third of the rows on one value."""
    rnd = random.Random(2)
    data = []
    for i in range(900):
        group = rnd.choice(["a", "a", "b", None])
        value = 0 if i % 3 == 0 else rnd.choice([None, *range(1, 200)])
        data.append((i, group, value))
    data.append((900, "alone", 5))
    return materialise(spark.createDataFrame(data, "id int, g string, v int"))


def test_single_row_groups_have_percentile_zero(scores):
    got = add_ranks(scores, "v", {"in_group": ["g"]}, {"pct": ["g"]})
    assert got.where("id = 900").select(F.col("pct").cast("string")).first()[0] == "0.000"


def test_ranks_in_groups_against_spark_window(scores, rows):
    order = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())
    assert rows(add_ranks(scores, "v", {"in_group": ["g"]})) == rows(scores.withColumn("in_group", F.rank().over(order)))


def test_ranks_against_spark_window(scores, rows):
    want = scores.withColumn("overall", F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())))
    assert rows(add_ranks(scores, "v", {"overall": []})) == rows(want)


def test_percentiles_round_the_exact_share(scores):
    got = add_ranks(scores, "v", {}, {"pct": []}).select("v", "pct").distinct().collect()
    values = sorted([r.v if r.v is not None else -1 for r in scores.collect()])
    for r in got:
        below, others = values.index(r.v if r.v is not None else -1), len(values) - 1
        assert int(r.pct * 1000) == (2 * below * 1000 + others) // (2 * others)


def test_history_of_hot_owners_equals_plain_windows(spark, rows):
    rnd = random.Random(4)
    data = [(1 if i % 3 else rnd.randint(2, 9), f"2021-01-{rnd.randint(1, 28):02d}", i) for i in range(600)]
    df = spark.createDataFrame(data, "c int, d string, id int").withColumn("d", F.col("d").cast("date"))
    hot = hot_keys(df, ["c"], hot_rows=30)
    assert not hot.isEmpty()
    split, plain = add_history(df, "c", "d", "id", hot), add_history(df, "c", "d", "id", False)
    assert rows(split, *plain.columns) == rows(plain, *plain.columns)


def test_history_orders_days_by_id(spark, rows, day):
    df = spark.createDataFrame([(1, day("2021-01-05"), 3), (1, day("2021-01-05"), 2), (1, day("2021-01-01"), 9)], "c int, d date, id int")
    got = add_history(df, "c", "d", "id", False)
    assert rows(got, "order_number", "id", "days_since_last_order") == [(1, 9, None), (2, 2, 4), (3, 3, 0)]


def test_top_k_keeps_ties(spark, rows):
    data = [(1, "x", 9), (2, "x", 9), (3, "x", 8), (4, "x", 7), (5, "y", 1), (6, "x", 8), (7, "z", None)]
    df = spark.createDataFrame(data, "product_id int, category string, v int").selectExpr(
        "product_id", "category", "concat('p', product_id) AS product_name", "cast(v AS decimal(15,2)) AS total_revenue"
    )
    got = analytics.top_products_per_category(materialise(df))
    assert rows(got, "product_id", "rank_in_category") == [(1, 1), (2, 1), (3, 3), (5, 1), (6, 3), (7, 1)]


def test_orphans_with_known_hot_keys_take_no_sample_of_the_child(spark, rows, monkeypatch):
    child = spark.createDataFrame([(i % 5, i) for i in range(40)], "k int, v int")
    parent = spark.createDataFrame([(0,), (1,), (2,)], "k int")
    hot, expected = skew.hot_keys(child, ["k"], hot_rows=2), rows(skew.orphans(child, parent, ["k"]))
    monkeypatch.setattr(skew, "hot_keys", lambda *args, **kwargs: pytest.fail("the child is computed for a sample"))
    assert rows(skew.orphans(child, parent, ["k"], hot)) == rows(skew.orphans(child, parent, ["k"], False)) == expected
    assert len(expected) == 16
