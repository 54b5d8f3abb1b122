import random
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from pyspark.sql import functions as F

from smeltworks.functions import (
    canonical_uuid,
    div_round,
    exact_avg,
    is_present,
    month_index,
    pct_change,
    safe_decimal,
    safe_int,
    year_month,
)
from smeltworks.functions.numbers import ratio


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x string")


def test_uuid_is_lowered_and_must_be_canonical(spark):
    good = "ABCDEF01-0000-4000-8000-00000000000A"
    bad = ["ABCDEF01000-0-4000-8000-00000000000A", good + "\n", "-" * 36, good[:-1], None]
    got = [r[0] for r in texts(spark, [good, *bad]).select(canonical_uuid("x")).collect()]
    assert got == [good.lower()] + [None] * len(bad)


def test_blank_text_is_not_present(spark):
    got = [r[0] for r in texts(spark, ["a", "  ", "", None, "\t"]).select(is_present("x")).collect()]
    # Only blanks are trimmed, a tab is text.
    assert got == [True, False, False, False, True]


def test_safe_casts(spark):
    values = ["12.5", "12.", "12.345", "12.5\n", "", " 5", "-5", "1e3", None, "99999999999"]
    df = texts(spark, values).select(safe_decimal("x", 10, 2).alias("d"), safe_int("x", default=1).alias("i"))
    decimals, integers = zip(*df.collect())
    assert [str(d) for d in decimals[:3]] == ["12.50", "12.00", "12.35"]
    assert all(d == 0 for d in decimals[3:9])
    assert decimals[9] is None
    assert integers[0] == 1 and integers[8] == 1 and integers[9] is None
    assert [r[0] for r in texts(spark, ["7", "007", "7.0"]).select(safe_int("x")).collect()] == [7, 7, 0]


def test_div_round_matches_fractions(spark):
    rnd = random.Random(5)
    pairs = [(rnd.randint(-(10**k), 10**k), rnd.randint(1, 10**j)) for k in (1, 3, 9, 18) for j in (1, 2, 6) for _ in range(40)]
    pairs += [(1, 2), (-1, 2), (3, 2), (-3, 2), (5, 10), (0, 3)]
    df = spark.createDataFrame(pairs, "n bigint, d bigint").select("n", "d", div_round(F.col("n"), F.col("d")).alias("q"))
    for n, d, q in df.collect():
        half_away = int(abs(Fraction(n, d)) + Fraction(1, 2))
        assert q == (half_away if n >= 0 else -half_away)


def test_exact_avg_rounds_once(spark):
    # 0.045 / 1 would be 0.05 if rounded from 0.0450; a double average of 0.01, 0.02, 0.02 hides the third digit.
    df = spark.createDataFrame([(1, "0.01"), (1, "0.02"), (2, "0.05"), (2, "0.04"), (3, "-0.01"), (3, "-0.02")], "g int, x string")
    df = df.withColumn("x", F.col("x").cast("decimal(12,2)")).groupBy("g").agg(exact_avg(F.sum("x"), F.count("x")).alias("a"))
    assert {g: str(a) for g, a in df.collect()} == {1: "0.02", 2: "0.05", 3: "-0.02"}


def test_exact_avg_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "x decimal(12,2)").agg(exact_avg(F.sum("x"), F.count("x")).alias("a"))
    assert df.first().a is None


def test_exact_avg_against_decimal_module(spark):
    rnd = random.Random(3)
    data = [(g, Decimal(rnd.randint(0, 10**8)) / 100) for g in range(200) for _ in range(rnd.randint(1, 9))]
    df = spark.createDataFrame(data, "g int, x decimal(12,2)").groupBy("g").agg(exact_avg(F.sum("x"), F.count("x"), "decimal(12,2)"))
    want = {}
    for g, x in data:
        want.setdefault(g, []).append(x)
    for g, got in df.collect():
        exact = Fraction(sum(want[g])) / len(want[g])
        assert Fraction(got) == Fraction(int(exact * 100 + Fraction(1, 2)), 100)


def test_pct_change(spark):
    data = [("150", "100"), ("50", "100"), ("100", "300"), ("1", "0"), ("1", None), ("100.005", "100")]
    df = spark.createDataFrame(data, "a string, b string").select(F.col("a").cast("decimal(15,2)"), F.col("b").cast("decimal(15,2)"))
    got = [r[0] for r in df.select(pct_change(F.col("a"), F.col("b"), 2, "decimal(6,2)")).collect()]
    assert [None if g is None else str(g) for g in got] == ["50.00", "-50.00", "-66.67", None, None, "0.01"]


def test_growth_beyond_its_type_fails(spark):
    import pytest

    df = spark.createDataFrame([("100000", "1")], "a string, b string").select(F.col("a").cast("decimal(15,2)"), F.col("b").cast("decimal(15,2)"))
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        df.select(pct_change(F.col("a"), F.col("b"), 2, "decimal(6,2)")).collect()
    assert str(df.select(pct_change(F.col("a"), F.col("b"), 2, "decimal(12,2)")).first()[0]) == "9999900.00"


def test_ratio(spark):
    df = spark.createDataFrame([(1, 3), (0, 0)], "p bigint, w bigint").select(ratio(F.col("p"), F.col("w"), 4, "decimal(5,4)"))
    assert [r[0] for r in df.collect()] == [Decimal("0.3333").quantize(Decimal("0.0001"), ROUND_HALF_UP), None]


def test_calendar(spark):
    df = spark.sql("SELECT DATE '2020-12-31' AS d, DATE '2021-01-01' AS e")
    got = df.select(
        year_month("d").alias("m"),
        month_index(F.year("d"), F.month("d")).alias("i"),
        month_index(F.year("e"), F.month("e")).alias("j"),
    ).first()
    assert got.m == "2020-12" and got.j == got.i + 1
