"""Gold tables after an increment: what the newly loaded silver rows touch is found, only that is computed anew.

A silver row shows when it was loaded, and the run log keeps up to which load gold has been brought. Orders loaded since, or having
items loaded since, are the touched ones. Their items, and no others, are summed into ``order_facts``; dates, customers,
products and months that a touched order can have changed are then computed from facts and put in place of their rows.
A run that breaks leaves its mark where it was: the next one finds the same rows again and comes to the same tables.
"""

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltworks.operators.loads import LoadMetrics, replace_groups, replace_table
from smeltworks.plans import gold
from smeltworks.sources.scratch import materialise
from smeltworks.sources.tables import StoredTable


@dataclass(frozen=True)
class Touched:
    """Keys whose gold rows may have changed, each a small stored table without repetitions."""

    orders: DataFrame  # order_id, order_date
    days: DataFrame  # order_date
    customers: DataFrame  # customer_id
    products: DataFrame  # product_id
    months: DataFrame  # year_month


def loaded_since(rows: DataFrame, mark: datetime.datetime) -> DataFrame:
    """Silver rows of loads after ``mark``. Files that hold none are skipped by their statistics."""
    return rows.where(F.col("_silver_loaded_at") > F.lit(mark))


def newest_load(*tables: DataFrame) -> datetime.datetime | None:
    """When the newest row of any silver table was loaded."""
    seconds = [t.agg(F.max("_silver_loaded_at").cast("double").alias("s")).first().s for t in tables]
    known = [s for s in seconds if s is not None]
    epoch = datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc)
    return epoch + datetime.timedelta(microseconds=round(max(known) * 1_000_000)) if known else None


def touched_orders(orders: DataFrame, items: DataFrame, mark: datetime.datetime) -> DataFrame:
    """Orders loaded after ``mark``, or with items that were."""
    fresh = loaded_since(orders, mark).select("order_id", "order_date", "customer_id")
    by_item = loaded_since(items, mark).select("order_id").distinct()
    found = orders.select("order_id", "order_date", "customer_id").join(by_item, "order_id", "left_semi")
    return materialise(fresh.unionByName(found).distinct(), "touched-orders")


def load_facts(facts: StoredTable, orders: DataFrame, items: StoredTable, touched: DataFrame) -> LoadMetrics:
    """The facts of touched orders anew. Of the items, only the folders of these orders are read, and in them only their rows."""
    folders = items.folders_of(items.with_partition(touched))
    theirs = items.read(folders).join(touched.select("order_id"), "order_id", "left_semi")
    known = orders.join(touched.select("order_id"), "order_id", "left_semi")
    return replace_groups(facts, gold.order_facts(known, theirs), touched.select("order_id", "order_date"))


def touched_keys(
    touched: DataFrame, customers: DataFrame, products: DataFrame, orders: DataFrame, facts: DataFrame, performance: DataFrame, mark: datetime.datetime
) -> Touched:
    """What follows from touched orders, customers and products.

    A new order can make another day the first one of its customer, so the first day of all their other orders counts as
    touched too: the number of new customers of that day may go down. A product that has changed its category moves the
    sales of all its months.
    """
    named = touched.select("order_id")
    theirs = orders.select("order_id", "order_date", "customer_id").join(touched.select("customer_id"), "customer_id", "left_semi")
    others = theirs.join(named, "order_id", "left_anti")
    firsts = others.groupBy("customer_id").agg(F.min("order_date").alias("order_date")).select("order_date")
    days = materialise(touched.select("order_date").unionByName(firsts).distinct(), "touched-days")
    changed = loaded_since(customers, mark).select("customer_id")
    buyers = materialise(touched.select("customer_id").unionByName(changed).distinct(), "touched-customers")
    renewed = loaded_since(products, mark).select("product_id", "category")
    sold = facts.join(named, "order_id", "left_semi").select("product_id")
    goods = materialise(renewed.select("product_id").unionByName(sold).distinct(), "touched-products")
    before = performance.select("product_id", F.col("category").alias("_before"))
    moved = renewed.join(before, "product_id").where(~F.col("category").eqNullSafe(F.col("_before"))).select("product_id")
    shifted = facts.select("product_id", "order_date").join(moved, "product_id", "left_semi").select("order_date")
    months = touched.select("order_date").unionByName(shifted).select(gold.year_month("order_date").alias("year_month"))
    return Touched(touched, days, buyers, goods, materialise(months.distinct(), "touched-months"))


def merged_ltv(
    stored: DataFrame, touched: Touched, customers: DataFrame, orders: DataFrame, facts: DataFrame, as_of: datetime.date, **thresholds
) -> DataFrame:
    """Lifetime values: those of touched customers from their own orders, all others as stored but judged by the new day."""
    buyers = customers.join(touched.customers, "customer_id", "left_semi")
    theirs = orders.join(touched.customers, "customer_id", "left_semi")
    sold = facts.join(theirs.select("order_id"), "order_id", "left_semi")
    fresh = gold.customer_ltv(buyers, theirs, sold, as_of, **thresholds)
    rest = stored.join(touched.customers, "customer_id", "left_anti").select(*fresh.columns)
    return fresh.unionByName(gold.judged(rest, as_of, **thresholds))


def merged_products(stored: DataFrame, touched: Touched, products: DataFrame, facts: DataFrame, orders: DataFrame) -> DataFrame:
    """Product performance: totals of touched products from their own sales, all others as stored, then the ranks of all."""
    goods = products.join(touched.products, "product_id", "left_semi")
    sold = facts.join(touched.products, "product_id", "left_semi")
    fresh = gold.product_totals(goods, sold, orders)
    # Every item has a price, so only products that were never sold have no average.
    kept = stored.join(touched.products, "product_id", "left_anti")
    rest = kept.withColumn("_ranked", F.when(F.col("avg_selling_price").isNotNull(), F.col("total_revenue")))
    return gold.ranked_products(fresh.unionByName(rest.select(*fresh.columns)))


def load_gold_increment(house, mark: datetime.datetime, as_of: datetime.date, **thresholds) -> dict[str, LoadMetrics]:
    """Bring the gold tables from the state of ``mark`` to that of silver. The result equals a full rebuild, row by row.

    Read: of the items, those of touched orders; of the facts, touched months for daily and category revenue, and all of them, three
    narrow columns, for touched customers and products. Monthly revenue is made anew from the daily rows. Lifetime values
    and ranks, which depend on the day and on one another, are written in full, from stored rows where nothing was touched.
    """
    customers, products, orders = (house.silver(n).read() for n in ("customers", "products", "orders"))
    items, store = house.silver("order_items"), house.gold
    touched = touched_orders(orders, items.read(), mark)
    done = {"order_facts": load_facts(store("order_facts"), orders, items, touched)}
    facts = store("order_facts").read()
    keys = touched_keys(touched, customers, products, orders, facts, store("product_performance").read(), mark)

    days = gold.daily_revenue(orders, _facts_of(house, keys.days), days=keys.days)
    done["daily_revenue"] = replace_groups(store("daily_revenue"), days, keys.days.withColumnRenamed("order_date", "revenue_date"))
    done["monthly_revenue"] = replace_table(store("monthly_revenue"), gold.monthly_revenue(store("daily_revenue").read()))
    ltv = merged_ltv(store("customer_ltv").read(), keys, customers, orders, facts, as_of, **thresholds)
    done["customer_ltv"] = replace_table(store("customer_ltv"), ltv)
    ranked = merged_products(store("product_performance").read(), keys, products, facts, orders)
    done["product_performance"] = replace_table(store("product_performance"), ranked)
    first_days = keys.months.select(F.to_date(F.concat("year_month", F.lit("-01"))).alias("order_date"))
    monthly = gold.category_revenue(products, _facts_of(house, first_days), orders)
    done["category_revenue"] = replace_groups(store("category_revenue"), monthly, keys.months)
    return done


def _facts_of(house, days: DataFrame) -> DataFrame:
    """Facts of the months in which ``days(order_date)`` lie; no other folder is read."""
    table = house.gold("order_facts")
    return table.read(table.folders_of(table.with_partition(days)))
