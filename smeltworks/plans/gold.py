"""Silver to gold: business tables.

Items are summed per order before any join, so joins on the order are one to one, no distinct count needs an
expanded plan, and an order with very many items is folded on the map side. Wherever ``items`` are asked for, rows of
``order_facts``, in which that is already done, may be given instead.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smeltworks.functions import exact_avg, month_index, pct_change, year_month
from smeltworks.functions.numbers import ratio
from smeltworks.operators.ordering import add_ranks
from smeltworks.operators.skew import hot_keys, join_unique
from smeltworks.schemas import GOLD_MONEY
from smeltworks.sources.intervals import TimeModel, later
from smeltworks.sources.scratch import materialise
from smeltworks.sources.tables import StoredTable

# Orders in these states earn nothing.
DEAD_STATUSES = ("cancelled", "refunded")


def earns() -> Column:
    """True for orders that count as revenue."""
    return ~F.col("status").isin(*DEAD_STATUSES)


def order_facts(orders: DataFrame, items: DataFrame, money: str = GOLD_MONEY) -> DataFrame:
    """The items of each order by product: how many, their value, units, unit prices and how many of these there are. ``orders`` has one
    row for each order, or for each date of one. Where it has a status, ``earns`` says whether the order earns, so that sales of products and
    categories need no join to the orders.

    Items are dealt by order for the join, and the groups, each within an order, need no other deal; those of a hot order are
    split in the join and fold before they meet.
    """
    sold = items.select("order_id", "product_id", "quantity", "line_total", "unit_price")
    named = ["order_date", *([earns().alias("earns")] if "status" in orders.columns else [])]
    dated = join_unique(sold, orders.select("order_id", *named), ["order_id"])
    keys = [c for c in ("order_id", "product_id", "order_date", "earns") if c in dated.columns]
    return dated.groupBy(*keys).agg(
        F.count("*").alias("n_items"),
        F.sum("line_total").cast(money).alias("items_total"),
        F.sum("quantity").alias("units"),
        F.sum("unit_price").cast(money).alias("prices"),
        F.count("unit_price").alias("priced"),
    )


def dated_facts(orders: DataFrame, items: DataFrame, money: str = GOLD_MONEY) -> DataFrame:
    """``order_facts`` of orders whose id may repeat: once for each date that an order has. Stored by date they give the items of
    any range without reading the others; of a range with several dates of an order, one row per order and product counts."""
    return order_facts(orders.select("order_id", "order_date").distinct(), items, money)


def _summed(items: DataFrame) -> bool:
    """Whether ``items`` are facts."""
    return "n_items" in items.columns


def _flagged(items: DataFrame) -> bool:
    """Whether ``items`` are facts that know whether their order earns."""
    return _summed(items) and "earns" in items.columns


def _renamed(names: dict[str, str]) -> list[Column]:
    return [F.col(old).alias(new) for old, new in names.items()]


def order_totals(items: DataFrame) -> DataFrame:
    """Item count and value per order."""
    counted = F.sum("n_items") if _summed(items) else F.count("*")
    total = F.sum("items_total" if _summed(items) else "line_total")
    return items.groupBy("order_id").agg(counted.alias("n_items"), total.alias("items_total"))


def daily_revenue(
    orders: DataFrame, items: DataFrame, money: str = GOLD_MONEY, start=None, end=None, days: DataFrame | None = None
) -> DataFrame:
    """One row per date with sold items, of ``start <= date < end`` or of the ``days(order_date)`` if these are given.

    Orders without items count for nothing but the first order date of their customer. The average order value
    weighs an order by its number of items. For a range or days, only their orders are joined to their items; of all other
    orders just the customer and the date are read, for the first order dates of the customers concerned.
    """
    firsts = None
    if start is not None or days is not None:
        every = orders
        if days is None:
            orders = orders.where((F.col("order_date") >= F.lit(start)) & (F.col("order_date") < F.lit(end)))
        else:
            orders = orders.join(days, "order_date", "left_semi")
            every = every.join(orders.select("customer_id"), "customer_id", "left_semi")
        firsts = every.groupBy("customer_id").agg(F.min("order_date").alias("first_day"))
        # Facts carry their date: ranges are cut by it, as far as the caller has not done so.
        if not _summed(items):
            items = items.join(orders.select("order_id"), "order_id", "left_semi")
        elif days is not None:
            items = items.join(days, "order_date", "left_semi")
    sold = orders.select("order_id", "customer_id", "order_date", "status", "total_amount").join(
        order_totals(items), "order_id", "left"
    )
    per_customer = sold.groupBy("customer_id", "order_date").agg(
        F.count("n_items").alias("orders"),
        F.sum("n_items").alias("n_items"),
        F.sum("items_total").alias("gross"),
        F.sum(F.when(earns(), F.col("items_total")).otherwise(0)).alias("net"),
        F.sum(F.col("total_amount") * F.col("n_items")).alias("amount"),
    )
    # At most one row per customer and calendar day, however many orders a customer has.
    if firsts is None:
        first_day = F.min("order_date").over(Window.partitionBy("customer_id"))
        dated = per_customer.withColumn("first_day", first_day)
    else:
        dated = per_customer.join(firsts, "customer_id")
    return (
        dated.where("orders > 0")
        .groupBy(F.col("order_date").alias("revenue_date"))
        .agg(
            F.sum("orders").alias("order_count"),
            F.sum("gross").cast(money).alias("gross_revenue"),
            F.coalesce(F.sum("net"), F.lit(0)).cast(money).alias("net_revenue"),
            exact_avg(F.sum("amount"), F.sum("n_items")).alias("avg_order_value"),
            F.count("*").alias("unique_customers"),
            F.count_if(F.col("order_date") == F.col("first_day")).alias("new_customers"),
        )
    )


def _rolled_up(daily: DataFrame, *period: Column, money: str) -> DataFrame:
    """Sums over daily rows. Unique customers are summed per day and daily averages are averaged unweighted."""
    return daily.groupBy(*period).agg(
        F.sum("order_count").alias("order_count"),
        F.sum("gross_revenue").cast(money).alias("gross_revenue"),
        F.sum("net_revenue").cast(money).alias("net_revenue"),
        exact_avg(F.sum("avg_order_value"), F.count("avg_order_value")).alias("avg_order_value"),
        F.sum("unique_customers").alias("unique_customers"),
    )


def monthly_revenue(daily: DataFrame, mom: str = "calendar", money: str = GOLD_MONEY) -> DataFrame:
    """Monthly sums with growth over the calendar month before, or over the ``previous_row``.

    The two differ where a month has no revenue: the calendar month before is then missing and growth is NULL.
    """
    day = F.col("revenue_date")
    monthly = _rolled_up(
        daily,
        year_month(day).alias("year_month"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        money=money,
    )
    gross = F.col("gross_revenue")
    # One row per calendar month in all, so one task is enough, and no self join reads the days twice.
    months = Window.orderBy(F.col("year_month").asc_nulls_last())
    index = month_index(F.col("year"), F.col("month"))
    previous = F.lag(gross).over(months)
    if mom == "calendar":
        previous = F.when(F.lag(index).over(months) == index - 1, previous)
    elif mom != "previous_row":
        raise ValueError(f"mom is 'calendar' or 'previous_row', not {mom!r}")
    return monthly.withColumn("_previous", previous).select(
        "year_month",
        "year",
        "month",
        "order_count",
        "gross_revenue",
        "net_revenue",
        "avg_order_value",
        pct_change(gross, F.col("_previous"), 2, "decimal(6,2)").alias("mom_growth_pct"),
        "unique_customers",
    )


def weekly_revenue(daily: DataFrame, money: str = GOLD_MONEY) -> DataFrame:
    """Weekly sums; weeks start on Monday."""
    week = F.to_date(F.date_trunc("week", F.col("revenue_date"))).alias("week_start")
    return _rolled_up(daily, week, money=money)


def customer_ltv(
    customers: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    as_of,
    high: int = 1000,
    medium: int = 200,
    churn_days: int = 180,
    money: str = GOLD_MONEY,
) -> DataFrame:
    """Lifetime value, recency and segment of every customer, from orders that earn.

    Churn is tested before value. Customers without orders have no dates, revenue 0, segment LOW.
    """
    valued = (
        orders.where(earns())
        .select("order_id", "customer_id", "order_date", "total_amount")
        .join(order_totals(items), "order_id", "left")
    )
    # An order without items is still one row of the outer join.
    weight = F.coalesce("n_items", F.lit(1))
    per_customer = valued.groupBy("customer_id").agg(
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.count("*").alias("_orders"),
        F.sum("items_total").alias("_revenue"),
        F.sum(F.col("total_amount") * weight).alias("_amount"),
        F.sum(weight).alias("_weight"),
    )
    ltv = (
        customers.select("customer_id", "full_name", "email", "tier", "country")
        .join(per_customer, "customer_id", "left")
        .select(
            "customer_id",
            "full_name",
            "email",
            "tier",
            "country",
            "first_order_date",
            "last_order_date",
            F.coalesce("_orders", F.lit(0)).alias("total_orders"),
            F.coalesce("_revenue", F.lit(0)).cast(money).alias("total_revenue"),
            exact_avg(F.col("_amount"), F.col("_weight")).alias("avg_order_value"),
        )
    )
    return judged(ltv, as_of, high, medium, churn_days)


def judged(ltv: DataFrame, as_of, high: int = 1000, medium: int = 200, churn_days: int = 180) -> DataFrame:
    """Lifetime values with the two columns that depend on the day they are looked at."""
    idle = F.datediff(F.lit(as_of).cast("date"), F.col("last_order_date"))
    segment = (
        F.when(idle >= churn_days, "CHURNED")
        .when(F.col("total_revenue") >= high, "HIGH")
        .when(F.col("total_revenue") >= medium, "MEDIUM")
        .otherwise("LOW")
    )
    return ltv.withColumn("days_since_last", idle).withColumn("ltv_segment", segment)


def product_totals(products: DataFrame, items: DataFrame, orders: DataFrame, money: str = GOLD_MONEY) -> DataFrame:
    """Sales per product, before ranking. ``_ranked`` is NULL for products never sold.

    Units, revenue and cost include cancelled and refunded orders; only the order count leaves them out.
    """
    # One scan and one full-size shuffle of the items: to their order, where they fold to a row per order and product.
    flagged = orders.select("order_id", earns().alias("_earns"))
    if _flagged(items):
        named = {"units": "_units", "items_total": "_revenue", "prices": "_prices", "priced": "_priced", "earns": "_earns"}
        pairs = items.select("product_id", *_renamed(named))
    elif _summed(items):
        named = _renamed({"units": "_units", "items_total": "_revenue", "prices": "_prices", "priced": "_priced"})
        pairs = items.select("order_id", "product_id", *named).join(flagged, "order_id", "left")
    else:
        sold = items.select("order_id", "product_id", "quantity", "line_total", "unit_price")
        pairs = (
            join_unique(sold, flagged, ["order_id"], "left")
            # Dealt before they are summed: few items share order and product, so sums in the map tasks would hold whole file splits.
            .repartition("order_id", "product_id")
            .groupBy("order_id", "product_id")
            .agg(
                F.sum("quantity").alias("_units"),
                F.sum("line_total").alias("_revenue"),
                F.sum("unit_price").alias("_prices"),
                F.count("unit_price").alias("_priced"),
                F.max("_earns").alias("_earns"),
            )
        )
    sales = pairs.groupBy("product_id").agg(
        *[F.sum(c).alias(c) for c in ("_units", "_revenue", "_prices", "_priced")], F.count_if("_earns").alias("_orders")
    )
    revenue = F.col("_revenue").cast(money)
    cost = F.col("_units") * F.col("cost")
    return (
        products.select("product_id", "product_name", "category", "cost")
        .join(sales, "product_id", "left")
        .select(
            "product_id",
            "product_name",
            "category",
            F.coalesce("_units", F.lit(0)).alias("total_units_sold"),
            F.coalesce(revenue, F.lit(0)).cast(money).alias("total_revenue"),
            F.coalesce(F.col("_revenue") - cost, F.lit(0)).cast(money).alias("total_profit"),
            F.coalesce("_orders", F.lit(0)).alias("order_count"),
            exact_avg(F.col("_prices"), F.col("_priced")).alias("avg_selling_price"),
            revenue.alias("_ranked"),
        )
    )


def product_performance(
    products: DataFrame,
    items: DataFrame,
    orders: DataFrame,
    money: str = GOLD_MONEY,
) -> DataFrame:
    """Sales per product with its rank by revenue, overall and within the category.

    Products never sold rank last, after products whose revenue is 0.
    """
    return ranked_products(product_totals(products, items, orders, money))


def ranked_products(totals: DataFrame) -> DataFrame:
    """Product totals with their ranks."""
    ranks = {"revenue_rank": [], "category_rank": ["category"]}
    return add_ranks(materialise(totals, "products"), "_ranked", ranks).drop("_ranked")


def order_summary(orders: DataFrame, customers: DataFrame, items: DataFrame, money: str = GOLD_MONEY) -> DataFrame:
    """Orders that have items, with their customer and item totals."""
    hot = hot_keys(orders, ["customer_id"])
    buyers = customers.select(
        "customer_id", F.col("full_name").alias("customer_name"), "email", "tier", "country"
    )
    summed = orders.select("order_id", "customer_id", "order_date", "status", "total_amount").join(
        order_totals(items), "order_id"
    )
    return join_unique(summed, buyers, ["customer_id"], "inner", hot=hot).select(
        "order_id",
        "order_date",
        "status",
        "total_amount",
        "customer_name",
        "email",
        "tier",
        "country",
        F.col("n_items").alias("item_count"),
        F.col("items_total").cast(money).alias("calculated_total"),
    )


def category_revenue(products: DataFrame, items: DataFrame, orders: DataFrame, money: str = GOLD_MONEY) -> DataFrame:
    """Revenue by product category and month; net leaves out cancelled and refunded orders."""
    dated = orders.select("order_id", year_month("order_date").alias("year_month"), earns().alias("_earns"))
    if _flagged(items):
        named = _renamed({"units": "quantity", "items_total": "line_total", "earns": "_earns"})
        sold = items.select("product_id", year_month("order_date").alias("year_month"), *named)
    elif _summed(items):
        sold = items.select("order_id", "product_id", F.col("units").alias("quantity"), F.col("items_total").alias("line_total"))
        sold = sold.join(dated, "order_id")
    else:
        hot = hot_keys(items, ["order_id"])
        sold = join_unique(items.select("order_id", "product_id", "quantity", "line_total"), dated, ["order_id"], hot=hot)
    per_product = (
        sold.groupBy("product_id", "year_month")
        .agg(
            F.sum("quantity").alias("units"),
            F.sum("line_total").alias("gross"),
            F.sum(F.when(F.col("_earns"), F.col("line_total")).otherwise(0)).alias("net"),
        )
    )
    # At most one row per product and month is left to join.
    return (
        per_product.join(products.select("product_id", "category"), "product_id")
        .groupBy("category", "year_month")
        .agg(
            F.sum("units").alias("units_sold"),
            F.sum("gross").cast(money).alias("gross_revenue"),
            F.sum("net").cast(money).alias("net_revenue"),
        )
    )


def completed_by_day(orders: DataFrame, money: str = GOLD_MONEY) -> DataFrame:
    """Count and amount of completed orders per day: the full-refresh sample."""
    return orders_by_day(orders.where("status = 'completed'"), money)


def orders_by_day(orders: DataFrame, money: str = GOLD_MONEY) -> DataFrame:
    """Count and amount of orders per day: the partition-reload sample."""
    return orders.groupBy(F.col("order_date").alias("revenue_date")).agg(
        F.count("*").alias("order_count"), F.sum("total_amount").cast(money).alias("gross_revenue")
    )


def kpi_tiles(daily: DataFrame, orders: DataFrame, money: str = GOLD_MONEY) -> DataFrame:
    """Total revenue, average order value and number of distinct customers, as one row."""
    revenue = daily.agg(
        F.sum("gross_revenue").cast(money).alias("total_revenue"),
        F.sum("net_revenue").cast(money).alias("net_revenue"),
        exact_avg(F.sum("avg_order_value"), F.count("avg_order_value")).alias("avg_order_value"),
    )
    buyers = orders.agg(F.count_distinct("customer_id").alias("unique_customers"))
    # Two single rows, put together without a join.
    both = revenue.unionByName(buyers, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def ltv_by_segment(ltv: DataFrame, money: str = GOLD_MONEY) -> DataFrame:
    """Customers and lifetime value per segment."""
    return ltv.groupBy("ltv_segment").agg(
        F.count("*").alias("customers"), F.sum("total_revenue").cast(money).alias("total_ltv")
    )


def revenue_by_tier(ltv: DataFrame, money: str = GOLD_MONEY) -> DataFrame:
    """Revenue and customers per tier, with the average per customer."""
    return ltv.groupBy("tier").agg(
        F.count("*").alias("customers"),
        F.sum("total_orders").alias("total_orders"),
        F.sum("total_revenue").cast(money).alias("total_revenue"),
        exact_avg(F.sum("total_revenue"), F.count("*"), money).alias("revenue_per_customer"),
    )


def total_ltv(ltv: DataFrame, money: str = GOLD_MONEY) -> DataFrame:
    """Lifetime value of all customers, as one row."""
    return ltv.agg(F.sum("total_revenue").cast(money).alias("total_ltv"), F.count("*").alias("customers"))


def churn_rate(ltv: DataFrame) -> DataFrame:
    """Share of customers whose segment is CHURNED."""
    churned, everyone = F.count_if(F.col("ltv_segment") == "CHURNED"), F.count("*")
    return ltv.agg(
        churned.alias("churned_customers"),
        everyone.alias("customers"),
        ratio(churned, everyone, 4, "decimal(5,4)").alias("churn_rate"),
    )


def top_products(performance: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` products with the greatest revenue; the id decides between equals."""
    return (
        performance.select("product_id", "product_name", "category", "total_revenue")
        .orderBy(F.col("total_revenue").desc_nulls_last(), F.col("product_id").asc_nulls_last())
        .limit(k)
    )


def time_models(
    daily: StoredTable, weekly: StoredTable, monthly: StoredTable, category: StoredTable, orders: DataFrame, items: DataFrame, products: DataFrame
) -> list[TimeModel]:
    """The revenue tables as models of the interval ledger. Give stored ``dated_facts`` as ``items``, else every range reads and joins all
    items. Weeks and months are made from the stored days, growth of a month from the
    month before it, so a changed month changes the next one."""

    def inside(rows, start, end) -> DataFrame:
        return rows.where((F.col("order_date") >= F.lit(start)) & (F.col("order_date") < F.lit(end)))

    def sold(start, end) -> DataFrame:
        return inside(items, start, end).dropDuplicates(["order_id", "product_id"]) if _summed(items) else items

    def days(start, end) -> DataFrame:
        return daily_revenue(orders, sold(start, end), start=start, end=end)

    def of_days(start, end) -> DataFrame:
        rows = daily.read(daily.folders_between(start, end) if daily.spec.ordered_by else None)
        return rows.where((F.col("revenue_date") >= F.lit(start)) & (F.col("revenue_date") < F.lit(end)))

    def weeks(start, end) -> DataFrame:
        return weekly_revenue(of_days(start, end))

    def months(start, end) -> DataFrame:
        known = monthly_revenue(of_days(later(start, "month", -1), end))
        return known.where(F.col("year_month") >= _month(start))

    def categories(start, end) -> DataFrame:
        return category_revenue(products, sold(start, end), inside(orders, start, end))

    return [
        TimeModel("daily_revenue", daily, "revenue_date", days),
        TimeModel("weekly_revenue", weekly, "week_start", weeks, "week", after=("daily_revenue",)),
        TimeModel("monthly_revenue", monthly, "year_month", months, "month", _month, 1, ("daily_revenue",)),
        TimeModel("category_revenue", category, "year_month", categories, "month", _month, after=("daily_revenue",)),
    ]


def _month(day) -> str:
    return f"{day:%Y-%m}"
