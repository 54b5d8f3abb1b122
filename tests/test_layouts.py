import json
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from harness import queries
from smeltworks.operators import distinct, sorting
from smeltworks.operators.json_profile import json_paths, json_schema
from smeltworks.plans import analytics
from smeltworks.sources.buckets import save_bucketed

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().toString()


# -- distinct counts


def test_numbers_have_no_gaps_and_known_keys_keep_theirs(spark):
    keys = spark.createDataFrame([(f"k{i % 700}" if i % 9 else None,) for i in range(3000)], "key string").repartition(7)
    first = {r.key: r.number for r in distinct.number_keys(keys, "key").collect()}
    assert sorted(first.values()) == list(range(1, len(first) + 1)) and None not in first
    known = spark.createDataFrame(list(first.items()), "key string, number bigint")
    more = spark.createDataFrame([("k1",), ("new a",), ("new b",), ("new a",)], "key string")
    second = {r.key: r.number for r in distinct.number_keys(more, "key", known).collect()}
    assert {k: second[k] for k in first} == first and {second["new a"], second["new b"]} == {len(first) + 1, len(first) + 2}
    assert distinct.number_keys(keys.where("false"), "key").isEmpty()
    none = distinct.number_keys(keys, "key", known.where("false")).collect()
    assert sorted(r.number for r in none) == list(range(1, len(first) + 1))


def test_bitmaps_merge_to_exact_counts_over_several_buckets(spark):
    rng = random.Random(3)
    rows = [(rng.randint(1, 30), rng.randint(1, 100_000), "x") for _ in range(20_000)] + [(7, 5, "x")] * 2000 + [(8, None, "x")]
    days = spark.createDataFrame(rows, "day int, number bigint, bucket string")
    daily = distinct.member_bitmaps(days, "number", "day")
    half = F.when(F.col("day") <= 15, "first").otherwise("second")
    got = {r.half: (r.members, r.summed) for r in distinct.distinct_by_period(daily, half=half).collect()}
    seen = {(d, n) for d, n, _ in rows if n is not None}
    for name, wanted in (("first", range(1, 16)), ("second", range(16, 31))):
        mine = [(d, n) for d, n in seen if d in wanted]
        assert got[name] == (len({n for _, n in mine}), len(mine))
    # Bitmaps of an increment are merged with those kept before.
    parts = distinct.member_bitmaps(days.where("day <= 20"), "number", "day").unionByName(distinct.member_bitmaps(days.where("day >= 10"), "number", "day"))
    whole = distinct.count_members(distinct.merge_bitmaps(parts, day=F.col("day")), "day")
    assert sorted(whole.collect()) == sorted(distinct.count_members(daily, "day").collect())
    assert distinct.member_bitmaps(days.where("false"), "number", "day").isEmpty()


def test_no_bitmap_travels_when_days_are_built(spark):
    days = spark.range(1000).selectExpr("id % 7 AS day", "id AS number")
    text = distinct.member_bitmaps(days, "number", "day")._jdf.queryExecution().executedPlan().toString()
    assert text.rindex("bitmap_construct_agg") < text.index("Exchange")


# -- sorted output


def test_sorted_files_are_in_order_and_prune(spark, tmp_path):
    df = spark.range(20_000).select(F.expr("CASE WHEN id % 50 = 0 THEN NULL ELSE date_add(DATE'2024-01-01', int(hash(id) % 200)) END").alias("day"), "id")
    keys = F.col("day"), F.col("id")
    sorting.write_sorted(df, f"{tmp_path}/s", *keys, files=6)
    assert tuple(sorting.order_proof(spark, f"{tmp_path}/s", *keys).first()) == (20_000, 0, 0)
    files = sorting.file_ranges(spark, f"{tmp_path}/s", *keys).orderBy("file").collect()
    assert len(files) > 1 and files[0].least.day is None
    one = spark.read.parquet(f"{tmp_path}/s").where("day = DATE'2024-01-09'")
    assert "PushedFilters: [IsNotNull(day), EqualTo(day,2024-01-09)]" in one._jdf.queryExecution().toString() or "EqualTo(day" in plan(one)
    assert sum(f.least.day is None or f.least.day <= one.first().day <= f.greatest.day for f in files if f.greatest.day) <= 3


def test_disorder_is_found(spark, tmp_path):
    one = [(3,), (1,), (2,)]
    spark.createDataFrame(one, "k int").coalesce(1).write.parquet(f"{tmp_path}/a")
    assert tuple(sorting.order_proof(spark, f"{tmp_path}/a", F.col("k")).first()) == (3, 1, 0)
    two = spark.createDataFrame([(i,) for i in range(100)], "k int")
    two.repartition(4, "k").sortWithinPartitions("k").write.parquet(f"{tmp_path}/b")
    proof = sorting.order_proof(spark, f"{tmp_path}/b", F.col("k")).first()
    assert proof.inversions == 0 and proof.overlaps > 0
    sorting.write_sorted(two.where("false"), f"{tmp_path}/c", F.col("k"))
    assert tuple(sorting.order_proof(spark, f"{tmp_path}/c", F.col("k")).first()) == (0, 0, 0)


# -- layouts


def test_tables_by_key_are_joined_without_a_shuffle(spark, tmp_path):
    left = save_bucketed(spark.range(1000).selectExpr("id AS k", "id * 2 AS a"), "layout_left", "k", 4, f"{tmp_path}/l")
    right = save_bucketed(spark.range(3000).selectExpr("id % 1000 AS k", "id AS b"), "layout_right", "k", 4, f"{tmp_path}/r")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = left.join(right.groupBy("k").agg(F.sum("b").alias("b")), "k")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.agg(F.sum("b")).first()[0] == 2999 * 1500 and joined.count() == 1000
        assert "Exchange" not in queries.bucketed_order_totals(spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_months_known_at_run_time_prune_folders(spark, tmp_path):
    spark.range(1200).selectExpr("id", "format_string('2024-%02d', id % 12 + 1) AS _sale_month").write.partitionBy("_sale_month").parquet(f"{tmp_path}/sales")
    spark.createDataFrame([(f"2024-{m:02d}", m) for m in range(1, 13)], "month string, amount int").write.parquet(f"{tmp_path}/months")
    found = analytics.sales_in(spark.read.parquet(f"{tmp_path}/sales"), spark.read.parquet(f"{tmp_path}/months").where("amount > 10"))
    assert found.count() == 200 and "dynamicpruning" in plan(found).lower()
    assert "dynamicpruning" in plan(queries.sales_busy_months(spark, SF)).lower()


# -- JSON


def _value(rng, depth):
    kind = rng.choice(["int", "float", "text", "null", "bool"] + ["object", "array"] * 2 * (depth < 4))
    if kind == "object":
        return {rng.choice("abc"): _value(rng, depth + 1) for _ in range(rng.randint(0, 3))}
    if kind == "array":
        return [_value(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {"int": rng.randint(-5, 5), "float": 0.5, "text": "é", "null": None, "bool": True}[kind]


def test_json_paths_equal_duckdb(spark):
    rng = random.Random(5)
    texts = [json.dumps(_value(rng, 0)) for _ in range(300)]
    df = spark.createDataFrame([(t, "x", "y") for t in texts] + [(None, "x", "y")], "doc string, path string, v string")
    got = sorted(tuple(r) for r in json_paths(df, "doc").collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE d (doc VARCHAR)")
    con.executemany("INSERT INTO d VALUES (?)", [[t] for t in texts])
    wanted = con.sql(r"""
SELECT regexp_replace(t.fullkey, '\[[0-9]+\]', '[*]', 'g') AS path,
       CASE t.type WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer' WHEN 'DOUBLE' THEN 'number' WHEN 'VARCHAR' THEN 'string' ELSE lower(t.type) END AS kind,
       count(*) AS n
FROM d, json_tree(d.doc) t GROUP BY 1, 2""").fetchall()
    assert got == sorted(wanted)


@pytest.mark.parametrize("text, path", [("{", ("$", "invalid")), ("", ("$", "invalid")), ("null", ("$", "null")), ("[]", ("$", "array")), ("{}", ("$", "object"))])
def test_json_of_odd_documents(spark, text, path):
    df = spark.createDataFrame([(text,), (None,)], "doc string")
    assert [tuple(r) for r in json_paths(df, "doc").collect()] == [(*path, 1)]
    assert json_paths(df.where("false"), "doc").isEmpty()


def test_json_schema_of_all_documents(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('{"a": 2, "b": ["x"]}',), ("{",), (None,)], "doc string")
    assert json_schema(df, "doc").first()[0] == "OBJECT<a: BIGINT, b: ARRAY<STRING>>"
    assert json_schema(df.where("false"), "doc").first()[0] is None
