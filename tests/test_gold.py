import datetime

import pytest
from pyspark.sql import functions as F
from samples import money, silver_items, silver_orders

from smeltworks.plans import analytics, gold
from smeltworks.sources.scratch import materialise

D1, D2 = "2021-01-01", "2021-01-02"


@pytest.fixture
def orders(spark):
    return silver_orders(spark, [
        (1, 10, D1, "completed", "100"),
        (2, 10, D2, "completed", "10"),
        (3, 11, D2, "cancelled", "40"),
        (4, 12, D1, "completed", "7"),
        (5, 12, D2, "shipped", "8"),
    ])


@pytest.fixture
def items(spark):
    # Order 4 has no items.
    return silver_items(spark, [
        (1, 1, 2, "5", "10"), (1, 2, 1, "3", "3"), (1, 2, 1, "3", "3"),
        (2, 1, 1, "5", "5"),
        (3, 1, 4, "5", "20"),
        (5, 3, 1, "1", "1"),
    ])


def test_daily_revenue(orders, items, rows, day):
    got = gold.daily_revenue(orders, items)
    assert rows(got, "revenue_date", "order_count", "gross_revenue", "net_revenue", "avg_order_value", "unique_customers", "new_customers") == [
        # The order without items is left out; three items weigh the one order three times.
        (day(D1), 1, money("16.00"), money("16.00"), money("100.00"), 1, 1),
        # Customer 12 is not new on day two: its first order, although without items, was the day before.
        (day(D2), 3, money("26.00"), money("6.00"), money("19.33"), 3, 1),
    ]


def test_average_order_value_weighs_by_items(spark):
    orders = silver_orders(spark, [(1, 1, D1, "completed", "10"), (2, 2, D1, "completed", "40")])
    items = silver_items(spark, [(1, 1, 1, "1", "1")] * 3 + [(2, 1, 1, "1", "1")])
    assert gold.daily_revenue(orders, items).first().avg_order_value == money("17.50")


def daily(spark, pairs):
    df = spark.createDataFrame(pairs, "d string, g string")
    return df.selectExpr(
        "cast(d AS date) AS revenue_date", "1L AS order_count", "cast(g AS decimal(15,2)) AS gross_revenue",
        "cast(g AS decimal(15,2)) AS net_revenue", "cast(g AS decimal(10,2)) AS avg_order_value", "1L AS unique_customers",
    )


def test_growth_over_calendar_month_and_over_previous_row(spark, rows):
    frame = daily(spark, [("2020-12-15", "100"), ("2021-01-01", "50"), ("2021-01-31", "60"), ("2021-03-01", "220"), ("2021-04-01", "0"), ("2021-05-01", "5")])
    calendar = rows(gold.monthly_revenue(frame), "year_month", "mom_growth_pct")
    assert calendar == [
        ("2020-12", None), ("2021-01", money("10.00")), ("2021-03", None), ("2021-04", money("-100.00")), ("2021-05", None),
    ]
    previous = rows(gold.monthly_revenue(frame, mom="previous_row"), "year_month", "mom_growth_pct")
    assert previous[2] == ("2021-03", money("100.00"))


def test_monthly_average_is_a_plain_mean_of_days(spark):
    frame = daily(spark, [("2021-01-01", "1"), ("2021-01-02", "2"), ("2021-01-03", "2")])
    assert gold.monthly_revenue(frame).first().avg_order_value == money("1.67")


def test_weeks_start_on_monday(spark, rows, day):
    frame = daily(spark, [("2021-01-03", "1"), ("2021-01-04", "2"), ("2021-01-10", "3")])
    assert rows(gold.weekly_revenue(frame), "week_start", "gross_revenue") == [
        (day("2020-12-28"), money("1.00")), (day("2021-01-04"), money("5.00")),
    ]


def people(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "customer_id int").selectExpr(
        "customer_id", "'n' AS full_name", "concat(customer_id, '@x') AS email", "'gold' AS tier", "'UK' AS country"
    )


def test_customer_ltv(spark, orders, items, rows, day):
    got = gold.customer_ltv(people(spark, [10, 11, 12, 13]), orders, items, datetime.date(2021, 1, 12), high=20, medium=5)
    assert rows(got, "customer_id", "first_order_date", "last_order_date", "total_orders", "total_revenue", "avg_order_value", "days_since_last", "ltv_segment") == [
        (10, day(D1), day(D2), 2, money("21.00"), money("77.50"), 10, "HIGH"),
        # Only a cancelled order, or none at all: no dates, revenue 0, LOW.
        (11, None, None, 0, money("0.00"), None, None, "LOW"),
        (12, day(D1), day(D2), 2, money("1.00"), money("7.50"), 10, "LOW"),
        (13, None, None, 0, money("0.00"), None, None, "LOW"),
    ]


def test_churn_is_tested_before_value(spark, orders, items):
    old = gold.customer_ltv(people(spark, [10]), orders, items, datetime.date(2021, 7, 1), high=1, medium=1).first()
    assert (old.days_since_last, old.ltv_segment) == (180, "CHURNED")
    young = gold.customer_ltv(people(spark, [10]), orders, items, datetime.date(2021, 6, 30), high=1000, medium=21).first()
    assert (young.days_since_last, young.ltv_segment) == (179, "MEDIUM")


@pytest.fixture
def products(spark):
    return spark.createDataFrame(
        [(1, "pen", "a", "1"), (2, "ink", "a", "2"), (3, "cap", "b", None), (4, "new", "a", "1"), (5, "free", "a", "1")],
        "product_id int, product_name string, category string, cost string",
    ).withColumn("cost", F.col("cost").cast("decimal(10,2)"))


def test_product_performance(spark, orders, items, products, rows):
    more = items.unionByName(silver_items(spark, [(1, 5, 1, "0", "0")]))
    got = gold.product_performance(products, more, orders)
    assert rows(got, "product_id", "total_units_sold", "total_revenue", "total_profit", "order_count", "avg_selling_price", "revenue_rank", "category_rank") == [
        # Units and revenue include the cancelled order 3, the order count does not.
        (1, 7, money("35.00"), money("28.00"), 2, money("5.00"), 1, 1),
        (2, 2, money("6.00"), money("2.00"), 1, money("3.00"), 2, 2),
        # Unknown cost: no profit.
        (3, 1, money("1.00"), money("0.00"), 1, money("1.00"), 3, 1),
        # Never sold ranks after sold for nothing.
        (4, 0, money("0.00"), money("0.00"), 0, None, 5, 4),
        (5, 1, money("0.00"), money("-1.00"), 1, money("0.00"), 4, 3),
    ]


def test_order_summary(spark, orders, items, rows):
    got = gold.order_summary(orders, people(spark, [10, 12]), items)
    assert rows(got, "order_id", "customer_name", "item_count", "calculated_total") == [
        (1, "n", 3, money("16.00")), (2, "n", 1, money("5.00")), (5, "n", 1, money("1.00")),
    ]


def test_category_revenue(spark, orders, items, products, rows):
    got = gold.category_revenue(products, items, orders)
    assert rows(got, "category", "year_month", "units_sold", "gross_revenue", "net_revenue") == [
        ("a", "2021-01", 9, money("41.00"), money("21.00")), ("b", "2021-01", 1, money("1.00"), money("1.00")),
    ]


def test_wider_money(spark):
    orders = silver_orders(spark, [(1, 1, D1, "completed", "1")])
    items = silver_items(spark, [(1, 1, 1, "1", "9999999999.99")] * 1001)
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        gold.daily_revenue(orders, items, money="decimal(15,2)").collect()
    assert gold.daily_revenue(orders, items).first().gross_revenue == money("10009999999989.99")


def test_rolling_windows_count_rows(spark, rows):
    frame = daily(spark, [(f"2021-01-{n:02d}", str(n)) for n in (1, 2, 3, 4, 5, 6, 7, 20)])
    got = analytics.running_revenue(frame).orderBy("revenue_date").collect()
    assert [r.running_total for r in got][-1] == money("48.00")
    # Seven rows back from the 20th is the 2nd, whatever the gap.
    assert got[-1].rolling_7d_avg == money("6.71") and got[0].rolling_7d_avg == money("1.00")
    assert analytics.rolling_month(frame).orderBy("revenue_date").collect()[-1].rolling_30d_avg == money("6.00")


def test_month_growth(spark, rows):
    months = [(f"20{20 + n // 12}-{n % 12 + 1:02d}-01", str(100 + n)) for n in range(14)]
    got = analytics.month_growth(gold.monthly_revenue(daily(spark, months))).orderBy("year_month").collect()
    assert got[0].mom_growth_pct is None and got[1].mom_growth_pct == money("1.0")
    assert got[13].same_month_last_year == money("101.00") and got[13].yoy_growth_pct == money("11.9")


def test_best_month(spark, rows):
    orders = silver_orders(spark, [(1, 1, "2021-01-05", "completed", "1"), (2, 1, "2021-02-05", "completed", "1"), (3, 1, "2021-03-05", "refunded", "1")])
    items = silver_items(spark, [(1, 1, 1, "1", "5"), (2, 1, 1, "1", "5"), (3, 1, 1, "1", "99")])
    assert rows(analytics.best_month(orders, items), "best_month", "month_revenue", "total_ltv") == [
        ("2021-01", money("5.00"), money("10.00")), ("2021-02", money("5.00"), money("10.00")),
    ]


def test_tiles(spark, orders, items):
    ltv = gold.customer_ltv(people(spark, [10, 11, 12, 13]), orders, items, datetime.date(2021, 1, 12), high=20, medium=5)
    assert gold.total_ltv(ltv).first().total_ltv == money("22.00")
    assert gold.churn_rate(ltv).first().churn_rate == 0
    tile = gold.kpi_tiles(gold.daily_revenue(orders, items), orders).first()
    assert (tile.total_revenue, tile.unique_customers) == (money("42.00"), 3)
    assert {r.ltv_segment: r.customers for r in gold.ltv_by_segment(ltv).collect()} == {"HIGH": 1, "LOW": 3}
    assert gold.revenue_by_tier(ltv).first().revenue_per_customer == money("5.50")


def test_totals_beyond_thirteen_digits(spark, rows):
    big = "9999999999.99"
    day = datetime.date(2021, 1, 1)
    daily = spark.createDataFrame(
        [(day + datetime.timedelta(days=n), money(big) * 1000) for n in range(40)], "revenue_date date, gross_revenue decimal(28,2)"
    )
    last = analytics.running_revenue(daily).orderBy("revenue_date").tail(1)[0]
    assert last.running_total == money(big) * 40_000 and last.rolling_7d_avg == money(big) * 1000
    ltv = daily.select(F.lit("gold").alias("tier"), F.lit(1).alias("total_orders"), F.col("gross_revenue").alias("total_revenue"))
    assert gold.total_ltv(ltv).first().total_ltv == money(big) * 40_000
    assert gold.revenue_by_tier(ltv).first().revenue_per_customer == money(big) * 1000


def test_kpi_tiles_need_no_join(spark, orders, items):
    plan = gold.kpi_tiles(gold.daily_revenue(orders, items), orders)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" not in plan.split("Aggregate")[0] and "Union" in plan


def test_product_totals_read_the_items_once(spark, orders, items, products, tmp_path):
    items.write.parquet(f"{tmp_path}/items")
    stored = spark.read.parquet(f"{tmp_path}/items")
    totals = gold.product_totals(products, stored, orders)
    assert totals._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_items_are_dealt_before_they_are_summed_per_product(spark, capsys):
    orders = silver_orders(spark, [(1, 1, "2024-01-01", "completed", "5")])
    items = silver_items(spark, [(1, 1, 2, "1", "2"), (1, 1, 1, "1", "1")])
    products = spark.createDataFrame([(1, "pen", "office")], "product_id int, product_name string, category string").selectExpr("*", "cast(1 AS decimal(10,2)) AS cost")
    got = gold.product_totals(products, items, orders)
    assert (got.first().total_units_sold, got.first().order_count) == (3, 1)
    capsys.readouterr()
    got.explain()
    assert "REPARTITION_BY_COL" in capsys.readouterr().out


def test_facts_that_know_what_earns_need_no_orders(spark, rows, capsys):
    orders = silver_orders(spark, [(1, 1, "2021-01-02", "completed", "5"), (2, 1, "2021-01-09", "cancelled", "7"), (3, 2, "2021-02-01", "shipped", "7")])
    items = silver_items(spark, [(1, 1, 2, "3", "6"), (1, 1, 1, "3", "3"), (1, 2, 1, "4", "4"), (2, 1, 5, "3", "15"), (3, 2, 1, "4", "4"), (9, 1, 1, "3", "3")])
    products = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "y")], "product_id int, product_name string, category string").selectExpr("*", "cast(1 AS decimal(10,2)) AS cost")
    facts = gold.order_facts(orders, items)
    assert rows(facts, "order_id", "product_id", "earns", "n_items") == [(1, 1, True, 2), (1, 2, True, 1), (2, 1, False, 1), (3, 2, True, 1)]
    known = items.where("order_id <> 9")
    for sums in (gold.product_totals, gold.category_revenue):
        assert rows(sums(products, facts, orders)) == rows(sums(products, known, orders))
        sums(products, materialise(facts), orders).explain()
        assert capsys.readouterr().out.count("Join") == 1


def test_facts_of_an_order_with_very_many_items_are_split(spark, rows, monkeypatch):
    from smeltworks.operators.skew import hot_keys

    orders = silver_orders(spark, [(1, 1, "2021-01-02", "completed", "5"), (2, 1, "2021-01-09", "cancelled", "7")])
    items = silver_items(spark, [(1 if n % 9 else 2, n % 3, 1, "3", "6") for n in range(90)])
    plain = rows(gold.order_facts(orders, items))
    monkeypatch.setattr("smeltworks.operators.skew.hot_keys", lambda df, keys: hot_keys(df, keys, hot_rows=5))
    assert rows(gold.order_facts(orders, items)) == plain
