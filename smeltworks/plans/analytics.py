"""Window queries over gold and silver tables.

Windows without a partition run in one task. They are used only over daily and monthly tables, which have one
row per calendar day or month whatever the volume of orders. Everything over customers, products or orders is
partitioned by a key or goes through ``operators.ordering``.
"""

from typing import Literal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smeltworks.functions import exact_avg, pct_change, year_month
from smeltworks.operators.ordering import add_history, add_ranks
from smeltworks.operators.skew import join_unique
from smeltworks.plans.gold import earns, order_totals
from smeltworks.schemas import GOLD_MONEY


def running_revenue(daily: DataFrame, money: str = GOLD_MONEY) -> DataFrame:
    """Cumulative revenue and the average of the last 7 rows (rows, not days)."""
    days = Window.orderBy(F.col("revenue_date").asc_nulls_last())
    week = days.rowsBetween(-6, 0)
    return daily.select(
        "revenue_date",
        "gross_revenue",
        F.sum("gross_revenue").over(days.rowsBetween(Window.unboundedPreceding, 0)).cast(money).alias("running_total"),
        exact_avg(F.sum("gross_revenue").over(week), F.count("gross_revenue").over(week), money).alias("rolling_7d_avg"),
    )


def rolling_month(daily: DataFrame, money: str = GOLD_MONEY) -> DataFrame:
    """Average of the last 30 rows."""
    month = Window.orderBy(F.col("revenue_date").asc_nulls_last()).rowsBetween(-29, 0)
    total, n = F.sum("gross_revenue").over(month), F.count("gross_revenue").over(month)
    return daily.select("revenue_date", "gross_revenue", exact_avg(total, n, money).alias("rolling_30d_avg"))


def customer_ranks(ltv: DataFrame) -> DataFrame:
    """Rank by revenue within the tier and overall, and percentile within the tier, of customers with orders.

    ``ltv`` must be a stored table.
    """
    buyers = ltv.where("total_orders > 0").select("customer_id", "full_name", "tier", "total_revenue")
    return add_ranks(
        buyers,
        "total_revenue",
        {"rank_in_tier": ["tier"], "overall_rank": []},
        {"percentile_in_tier": ["tier"]},
    )


def month_growth(monthly: DataFrame) -> DataFrame:
    """Revenue beside the previous row and the row 12 before, with growth in percent."""
    months = Window.orderBy(F.col("year_month").asc_nulls_last())
    gross = F.col("gross_revenue")
    previous, last_year = F.lag(gross, 1).over(months), F.lag(gross, 12).over(months)
    return monthly.select(
        "year_month",
        "gross_revenue",
        previous.alias("prev_month"),
        last_year.alias("same_month_last_year"),
        pct_change(gross, previous, 1, "decimal(12,1)").alias("mom_growth_pct"),
        pct_change(gross, last_year, 1, "decimal(12,1)").alias("yoy_growth_pct"),
    )


def order_history(orders: DataFrame, hot: DataFrame | Literal[False] | None = None) -> DataFrame:
    """Completed orders with the customer's first and last date, the order's number and the days since the
    order before. Orders of one day follow their id."""
    done = orders.where("status = 'completed'").select("customer_id", "order_id", "order_date", "total_amount")
    return add_history(done, "customer_id", "order_date", "order_id", hot)


def top_products_per_category(performance: DataFrame, k: int = 3) -> DataFrame:
    """Products whose rank by revenue within their category is at most ``k``; equals share a rank.

    Ranks come from distinct revenues: at most ``k`` per category leave each map task. ``performance`` should be
    a stored table, as it is read twice.
    """
    counted = performance.groupBy("category", "total_revenue").agg(F.count("*").alias("_n"))
    best = Window.partitionBy("category").orderBy(F.col("total_revenue").desc_nulls_last())
    upto = F.sum("_n").over(best.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = (
        counted.withColumns({"_place": F.row_number().over(best), "_upto": upto})
        .where(F.col("_place") <= k)
        .withColumn("rank_in_category", F.col("_upto") - F.col("_n") + 1)
        .where(F.col("rank_in_category") <= k)
        .drop("_n", "_place", "_upto")
    )
    return join_unique(performance, ranked, ["category", "total_revenue"], "inner", null_safe=True).select(
        "category", "product_name", "product_id", "total_revenue", "rank_in_category"
    )


def best_month(orders: DataFrame, items: DataFrame, money: str = GOLD_MONEY) -> DataFrame:
    """Each customer's months of greatest spending, and what the customer spent in all.

    Spending is the item value of orders that earn; equal months are all kept.
    """
    spent = (
        orders.where(earns())
        .select("order_id", "customer_id", year_month("order_date").alias("best_month"))
        .join(order_totals(items), "order_id")
        .groupBy("customer_id", "best_month")
        .agg(F.sum("items_total").cast(money).alias("month_revenue"))
    )
    # At most one row per customer and calendar month.
    customer = Window.partitionBy("customer_id")
    place = F.rank().over(customer.orderBy(F.col("month_revenue").desc_nulls_last()))
    return (
        spent.withColumns({"_place": place, "total_ltv": F.sum("month_revenue").over(customer).cast(money)})
        .where("_place = 1")
        .select("customer_id", "best_month", "month_revenue", "total_ltv")
    )


def busy_months(orders: DataFrame, money: str = GOLD_MONEY) -> DataFrame:
    """``(month, amount, average)`` per month of orders: what it sold and what an average month did."""
    by_month = orders.groupBy(year_month("order_date").alias("month")).agg(F.sum("total_amount").cast(money).alias("amount"))
    return by_month.withColumn("average", exact_avg(F.sum("amount").over(Window.partitionBy()), F.count("amount").over(Window.partitionBy()), money))


def sales_in(sales: DataFrame, months: DataFrame, folder: str = "_sale_month") -> DataFrame:
    """Rows of a table with one folder per month whose month is in ``months(month)``, known only when it runs.

    With stored, filtered ``months`` Spark reads these first and lists no other folder (dynamic partition pruning).
    """
    return sales.join(months.select(F.col("month").alias(folder)), folder)
