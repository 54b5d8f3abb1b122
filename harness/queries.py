"""Registered queries: (spark, sf_dir) -> DataFrame, over whole driver tables."""

import datetime
import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harness.mapping import BRONZE_SQL, bronze, silver, table
from harness.oracles import AS_OF, CHURN_DAYS, HIGH, MEDIUM
from smeltworks.operators import capture, constraints, distinct, loads, sorting
from smeltworks.operators.json_profile import json_paths
from smeltworks.operators.skew import hot_keys, orphans
from smeltworks.plans import analytics, gold, medallion
from smeltworks.plans import silver as cleaning
from smeltworks.schemas import (
    BRONZE,
    CUSTOMERS,
    GOLD,
    GOLD_MONEY,
    ORDERS,
    SALES,
    SALES_PARTITIONED,
    WEEKLY_REVENUE,
    TableSpec,
    bucketed,
    columns,
    silver_spec,
)
from smeltworks.sources import catalog
from smeltworks.sources.buckets import save_bucketed
from smeltworks.sources.intervals import DIRTY, IntervalLedger, TimeModel, refresh
from smeltworks.sources.raw import ingest_bronze, read_raw
from smeltworks.sources.runs import RunLog
from smeltworks.sources.scratch import materialise, scratch_path
from smeltworks.sources.tables import StoredTable
from smeltworks.streaming.changes import ChangeStream
from smeltworks.streaming.events import EventWindows
from smeltworks.streaming.watermark import incremental_load

AS_OF_DATE = datetime.date.fromisoformat(AS_OF)
# The range of the interval loads: whole months and whole weeks.
INTERVAL = (datetime.date(1995, 5, 1), datetime.date(1997, 9, 1))
THRESHOLDS = {"high": HIGH, "medium": MEDIUM, "churn_days": CHURN_DAYS}

# The two-column revenue sample of the refresh and reload patterns, one folder per month.
DAY_SAMPLE = TableSpec(
    "day_sample",
    columns(f"""
revenue_date date
order_count bigint
gross_revenue {GOLD_MONEY}
"""),
    keys=("revenue_date",),
    partition={"_month": "date_format(revenue_date, 'yyyy-MM')"},
    ordered_by="revenue_date",
)

# -- inputs


def _daily(spark, d) -> DataFrame:
    return gold.daily_revenue(silver(spark, d, "orders"), silver(spark, d, "items"))


def _monthly(spark, d) -> DataFrame:
    return gold.monthly_revenue(_daily(spark, d))


def _ltv(spark, d) -> DataFrame:
    return gold.customer_ltv(
        silver(spark, d, "customers"), silver(spark, d, "orders"), silver(spark, d, "items"), AS_OF_DATE, **THRESHOLDS
    )


def _performance(spark, d) -> DataFrame:
    return gold.product_performance(
        silver(spark, d, "products"), silver(spark, d, "items"), silver(spark, d, "orders")
    )


def _clean(spark, d, name: str) -> DataFrame:
    raw = bronze(spark, d, f"raw_{name}")
    if name == "orders":
        return cleaning.clean_orders(raw, _kept(spark, d, "customers"))
    if name == "order_items":
        return cleaning.clean_order_items(raw, _kept(spark, d, "orders"), _kept(spark, d, "products"))
    return cleaning.CLEANERS[name](raw)


def _kept(spark, d, name: str) -> DataFrame:
    """A cleaned table as the silver layer holds it: stored."""
    return materialise(_clean(spark, d, name), name)


def _shown(df: DataFrame) -> DataFrame:
    """Silver rows without load-time columns; the creation time as text."""
    out = df.withColumnRenamed("_source_batch", "source_batch").drop("_silver_loaded_at", "_is_valid")
    if "created_at" in out.columns:
        out = out.withColumn("created_at", F.col("created_at").cast("string"))
    return out


def _stored(spark, spec: TableSpec) -> StoredTable:
    return StoredTable(spark, scratch_path(spark, spec.name), spec)


def _batch(df: DataFrame, number: int) -> DataFrame:
    return df.where(F.col("_batch_id") == f"batch-{number}")


# -- silver with the skew path forced


def silver_orders_hot_customers(spark, d) -> DataFrame:
    """Orders cleaned with the split join switched on for every customer the sample finds."""
    raw, customers = bronze(spark, d, "raw_orders"), _kept(spark, d, "customers")
    hot = hot_keys(raw.select(F.lower("customer_id").alias("customer_id")), ["customer_id"], hot_rows=2)
    return _shown(cleaning.clean_orders(raw, customers, hot={"customer_id": hot}))


def order_history_hot_customers(spark, d) -> DataFrame:
    """Order histories with the range-partitioned path switched on for every customer the sample finds."""
    orders = silver(spark, d, "orders")
    hot = hot_keys(orders.where("status = 'completed'"), ["customer_id"], hot_rows=2)
    return analytics.order_history(orders, hot)


def rejected_orders(spark, d) -> DataFrame:
    """Orders that do not reach silver, with reasons."""
    lost = cleaning.rejects("orders", bronze(spark, d, "raw_orders"), {"customers": _kept(spark, d, "customers")})
    return lost.select("order_id", F.col("_batch_id").alias("batch_id"), F.col("_errors").alias("reasons"))


def orphan_items(spark, d) -> DataFrame:
    """Items whose order is not completed: an anti join against a part of the parent table."""
    orders, raw = _kept(spark, d, "orders"), bronze(spark, d, "raw_order_items")
    # The raw rows show the hot orders; the cleaned ones would be cleaned once more for that.
    hot = {c: cleaning.hot_parents(raw, c) for c in ("order_id", "product_id")}
    items = cleaning.clean_order_items(raw, orders, _kept(spark, d, "products"), hot=hot)
    return orphans(items, orders.where("status = 'completed'"), ["order_id"], hot["order_id"]).select(
        "order_item_id", "order_id", "quantity"
    )


# -- loads


def _bronze_table(spark, d, name: str, replay: bool = False) -> StoredTable:
    target, raw = _stored(spark, BRONZE[name]), bronze(spark, d, name)
    for number in (1, 2, 1) if replay else (1, 2):
        ingest_bronze(
            target, _batch(raw, number), f"batch-{number}", f"{name}.csv", ingested_at=f"2024-01-0{number} 00:00:00"
        )
    return target


def bronze_batches(spark, d) -> DataFrame:
    """Two batches appended, the first one delivered twice."""
    rows = _bronze_table(spark, d, "raw_orders", replay=True).read().withColumnRenamed("_batch_id", "batch_id")
    return rows.drop("_id", "_ingested_at", "_source_file")


def csv_ingest(spark, d) -> DataFrame:
    """Raw CSV files, one folder per batch, into a bronze table."""
    return _file_ingest(spark, d, "csv", header=True)


def _file_ingest(spark, d, kind: str, **options) -> DataFrame:
    raw, target = bronze(spark, d, "raw_orders"), _stored(spark, BRONZE["raw_orders"])
    for number in (1, 2):
        folder = scratch_path(spark, kind)
        rows = _batch(raw, number).drop("_id", "_ingested_at", "_source_file", "_batch_id")
        rows.write.format(kind).options(**options).save(folder)
        ingest_bronze(target, read_raw(spark, folder, "raw_orders", kind), f"batch-{number}")
    return target.read().groupBy(F.col("_batch_id").alias("batch_id")).agg(
        F.count("*").alias("row_count"),
        F.count("order_id").alias("order_ids"),
        F.count("currency").alias("currencies"),
        F.count_distinct("total_amount").alias("amounts"),
    )


def json_ingest(spark, d) -> DataFrame:
    """Raw JSON lines, one folder per batch, into a bronze table."""
    return _file_ingest(spark, d, "json")


def validate_bronze(spark, d) -> DataFrame:
    """Gate on empty tables, then row counts."""
    tables = {name: bronze(spark, d, name) for name in BRONZE_SQL}
    constraints.require_non_empty(tables)
    return constraints.table_counts(tables)


def upsert_customers(spark, d) -> DataFrame:
    """Upsert of all columns, one batch after the other, the second one twice."""
    target, raw = _stored(spark, silver_spec("customers", 8)), bronze(spark, d, "raw_customers")
    for number in (1, 2, 2):
        loads.upsert(target, cleaning.clean_customers(_batch(raw, number)))
    return _shown(target.read())


def upsert_orders(spark, d) -> DataFrame:
    """Upsert of some columns: creation times stay as first loaded."""
    target, raw = _stored(spark, silver_spec("orders", 8)), bronze(spark, d, "raw_orders")
    customers = _kept(spark, d, "customers")
    for number in (1, 2):
        loads.upsert(target, cleaning.clean_orders(_batch(raw, number), customers))
    return _shown(target.read())


def rebucketed_upsert(spark, d) -> DataFrame:
    """Before the second batch comes, the table is laid out anew with another number of buckets."""
    raw = bronze(spark, d, "raw_customers")
    wide, narrow = (_stored(spark, silver_spec("customers", buckets)) for buckets in (8, 3))
    loads.upsert(wide, cleaning.clean_customers(_batch(raw, 1)))
    loads.replace_table(narrow, wide.read())
    loads.upsert(narrow, cleaning.clean_customers(_batch(raw, 2)))
    return _shown(narrow.read())


def incremental_late_parent(spark, d) -> DataFrame:
    """Half of the customers come one increment after their orders."""
    house = medallion.Warehouse(spark, scratch_path(spark, "late"), buckets=8)
    customers, stamp = _batch(bronze(spark, d, "raw_customers"), 1), "2024-01-01 00:00:00"
    orders = _batch(bronze(spark, d, "raw_orders"), 1)
    for parity in (0, 1):
        some = customers.where(F.col("_id") % 2 == parity).withColumn("_batch_id", F.lit(f"half-{parity}"))
        ingest_bronze(house.bronze("raw_customers"), some, f"half-{parity}", ingested_at=f"2024-01-0{parity + 1} 00:00:00")
        ingest_bronze(house.bronze("raw_orders"), orders, "batch-1", ingested_at=stamp)
        for name in ("customers", "orders"):
            medallion.load_silver_increment(house, name, datetime.timedelta(0))
    return _shown(house.silver("orders").read())


def customers_full_refresh(spark, d) -> DataFrame:
    """The customer model rebuilt in full, twice."""
    target, raw = _stored(spark, CUSTOMERS), bronze(spark, d, "raw_customers")
    loads.replace_table(target, cleaning.clean_customers(_batch(raw, 1)))
    loads.replace_table(target, cleaning.clean_customers(raw))
    return _shown(target.read())


def insert_new_orders(spark, d) -> DataFrame:
    """Known orders are left alone, the others come in with amount 0."""
    orders = silver(spark, d, "orders")
    spec = TableSpec("order_facts", orders.schema, keys=("order_id",), partition=bucketed(("order_id",), 8))
    target = _stored(spark, spec)
    loads.insert_new(target, orders.where("status = 'completed'"))
    loads.insert_new(target, orders.withColumn("total_amount", F.lit(0)))
    return target.read()


def orders_by_key(spark, d) -> DataFrame:
    """The largest order of each status, looked up in the stored orders by its key alone."""
    orders = silver(spark, d, "orders")
    spec = TableSpec("order_facts", orders.schema, keys=("order_id",), partition=bucketed(("order_id",), 8))
    target = _stored(spark, spec)
    loads.replace_table(target, orders)
    largest = orders.groupBy("status").agg(F.max_by("order_id", F.struct("total_amount", "order_id")).alias("order_id"))
    return loads.stored_rows(target, largest)


def catalog_after_inserts(spark, d) -> DataFrame:
    """A table grown by several loads, read by its catalog name."""
    orders = silver(spark, d, "orders")
    spec = TableSpec("order_facts", orders.schema, keys=("order_id",), partition=bucketed(("order_id",), 8))
    target = _stored(spark, spec)
    prefix = _layers(spark)
    for status in ("completed", "shipped", "cancelled", "refunded"):
        loads.insert_new(target, orders.where(F.col("status") == status))
        catalog.register(target, f"{prefix}gold.order_facts")
    return spark.sql(f"SELECT order_id, customer_id, order_date, status, total_amount FROM {prefix}gold.order_facts")


def _layers(spark) -> str:
    """New catalog databases, one per layer, and the prefix of their names: no two queries share any."""
    prefix = f"q{uuid.uuid4().hex[:12]}_"
    catalog.create_layers(spark, prefix, scratch_path(spark, "catalog"))
    return prefix


def _completed_days(spark, d) -> StoredTable:
    target = _stored(spark, DAY_SAMPLE)
    loads.replace_table(target, gold.completed_by_day(silver(spark, d, "orders")))
    return target


def replace_table(spark, d) -> DataFrame:
    """Full refresh over a table that held something else."""
    target, orders = _stored(spark, DAY_SAMPLE), silver(spark, d, "orders")
    loads.replace_table(target, gold.orders_by_day(orders))
    loads.replace_table(target, gold.completed_by_day(orders))
    return target.read()


def replace_partition(spark, d) -> DataFrame:
    """Reload of one day."""
    target, day = _completed_days(spark, d), datetime.date(1998, 3, 10)
    orders = silver(spark, d, "orders").where(F.col("order_date") == F.lit(day))
    loads.replace_partition(target, gold.orders_by_day(orders), "revenue_date", day)
    return target.read()


def backfill_range(spark, d) -> DataFrame:
    """Rebuild of a date range in one job."""

    def build(start, end):
        orders = silver(spark, d, "orders")
        return gold.orders_by_day(orders.where((F.col("order_date") >= F.lit(start)) & (F.col("order_date") < F.lit(end))))

    target = _completed_days(spark, d)
    loads.backfill(target, build, "revenue_date", datetime.date(1998, 2, 10), datetime.date(1998, 5, 20))
    return target.read()


def daily_revenue_backfill(spark, d) -> DataFrame:
    """The whole daily table, with a range of it first emptied and then rebuilt from its own orders."""
    orders, items = silver(spark, d, "orders"), silver(spark, d, "items")
    target = _stored(spark, medallion.GOLD["daily_revenue"])
    loads.replace_table(target, gold.daily_revenue(orders, items))
    start, end = datetime.date(1996, 5, 10), datetime.date(1997, 2, 3)
    loads.replace_range(target, target.read().where("false"), "revenue_date", start, end)
    loads.backfill(target, lambda lo, hi: gold.daily_revenue(orders, items, start=lo, end=hi), "revenue_date", start, end)
    return target.read().drop("_computed_at")


def _incremental(spark, d, buffer: datetime.timedelta) -> DataFrame:
    raw, customers = bronze(spark, d, "raw_orders"), _kept(spark, d, "customers")
    source, target = _stored(spark, BRONZE["raw_orders"]), _stored(spark, silver_spec("orders", 8))
    log = RunLog(spark, scratch_path(spark, "runs"))
    for number in (1, 2):
        ingest_bronze(
            source, _batch(raw, number), f"batch-{number}", ingested_at=f"2024-01-0{number} 00:00:00"
        )
        incremental_load(
            source, log, "bronze_orders", lambda rows: cleaning.clean_orders(rows, customers), target, buffer
        )
    return _shown(target.read())


def stream_orders(spark, d, arrival: tuple[int, ...], delayed: bool = False) -> DataFrame:
    """Bronze files taken in by a stream, one run per arriving batch, newest row per order kept; ``delayed``: all
    change sets are collected first and applied at the end."""
    raw, customers = bronze(spark, d, "raw_orders"), _kept(spark, d, "customers")
    stamps = [T.StructField("_ingested_at", T.TimestampType()), T.StructField("_id", T.LongType())]
    schema = T.StructType([*ORDERS.schema.fields, *stamps])
    everything = tuple(c for c in schema.names if c != "order_id")
    spec = ORDERS.like("orders", schema=schema, update_cols=everything, partition=bucketed(("order_id",), 8))
    target, inbox = _stored(spark, spec), scratch_path(spark, "inbox")
    feed = ChangeStream(
        spark,
        inbox,
        BRONZE["raw_orders"].schema,
        lambda rows: cleaning.project_orders(rows, customers),
        target,
        scratch_path(spark, "stream"),
        newest_first=["_ingested_at", "_id"],
        order_col="_ingested_at",
    )
    for number in arrival:
        _batch(raw, number).write.mode("append").parquet(inbox)
        feed.collect_changes() if delayed else feed.run()
    if delayed:
        feed.run()
        feed.drop_applied()
    return _shown(target.read()).drop("_ingested_at", "_id")


def _sales(spark, d) -> StoredTable:
    """A fact table with one folder per month."""
    orders, items = silver(spark, d, "orders"), silver(spark, d, "items")
    sales = items.join(orders, "order_id").select(
        F.monotonically_increasing_id().alias("sale_id"),
        F.col("order_id").cast("string"),
        F.col("customer_id").cast("string"),
        F.col("product_id").cast("string"),
        F.col("order_date").alias("sale_date"),
        F.lit("all").alias("region"),
        F.lit("web").alias("channel"),
        "quantity",
        "unit_price",
        # The price of the sale after discount, so that the generated total is the item's.
        F.lit(0).alias("discount_pct"),
        "line_total",
    )
    spec = SALES_PARTITIONED.like("sales_partitioned", generated={})
    target = _stored(spark, spec)
    loads.replace_table(target, sales)
    return target


def sales_month(spark, d) -> DataFrame:
    """The fact table, read for two months."""
    target = _sales(spark, d)
    start, end = datetime.date(1998, 3, 1), datetime.date(1998, 5, 1)
    two = target.read(target.folders_between(start, end))
    two = two.where((F.col("sale_date") >= F.lit(start)) & (F.col("sale_date") < F.lit(end)))
    return two.groupBy(F.date_format("sale_date", "yyyy-MM").alias("sale_month")).agg(
        F.count("*").alias("sales"), F.sum("line_total").cast("decimal(18,2)").alias("revenue")
    )


def sales_busy_months(spark, d) -> DataFrame:
    """The fact table, read for months above the average, which only the orders tell."""
    months = materialise(analytics.busy_months(silver(spark, d, "orders")), "months").where("amount > average")
    rows = analytics.sales_in(_sales(spark, d).read(helpers=True), months)
    return rows.groupBy(F.col("_sale_month").alias("sale_month")).agg(
        F.count("*").alias("sales"), F.sum("line_total").cast("decimal(18,2)").alias("revenue")
    )


# -- layouts


def bucketed_order_totals(spark, d) -> DataFrame:
    """Items summed per order and joined to the orders, both laid out by order."""
    stored = {
        name: save_bucketed(silver(spark, d, name), f"bucketed_{name}", "order_id", 8, scratch_path(spark, f"bucketed_{name}"))
        for name in ("orders", "items")
    }
    totals = gold.order_totals(stored["items"]).withColumn("items_total", F.col("items_total").cast(GOLD_MONEY))
    return stored["orders"].select("order_id", "order_date").join(totals, "order_id")


def sorted_orders(spark, d) -> DataFrame:
    """Orders written in the order of date and id: what the files prove."""
    path, keys = scratch_path(spark, "sorted_orders"), (F.col("order_date"), F.col("order_id"))
    sorting.write_sorted(silver(spark, d, "orders"), path, *keys)
    return sorting.order_proof(spark, path, *keys)


# -- distinct counts


def distinct_customers(spark, d, **groups) -> DataFrame:
    """Customers with orders per group of days and tiers, from one bitmap per day and tier."""
    customers = silver(spark, d, "customers").select("customer_id", "tier")
    numbers = distinct.number_keys(customers, "customer_id").join(customers, "customer_id")
    orders = silver(spark, d, "orders").select("customer_id", "order_date").join(numbers, "customer_id")
    daily = materialise(distinct.member_bitmaps(orders, "number", "order_date", "tier"), "bitmaps")
    found = distinct.distinct_by_period(daily, **groups)
    return found.withColumnsRenamed({"members": "customers", "summed": "summed_customers"})


# -- change capture


def _customer_rows(spark, d) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


def _next_delivery(rows: DataFrame) -> DataFrame:
    """The customers as delivered a day later: one segment has left, another is billed anew, a third has moved to new numbers."""
    segment = F.col("c_mktsegment")
    billed = rows.where(segment != "MACHINERY").withColumn(
        "c_acctbal", F.when(segment == "BUILDING", F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    )
    return billed.withColumn("c_custkey", F.when(segment == "FURNITURE", -F.col("c_custkey")).otherwise(F.col("c_custkey")))


def snapshot_changes(spark, d) -> DataFrame:
    """What differs between two full deliveries of the customers."""
    rows = _customer_rows(spark, d)
    return capture.snapshot_changes(rows, _next_delivery(rows), ["c_custkey"])


def _tracked(spark, d, name: str, key: str, rows: DataFrame) -> StoredTable:
    spec = TableSpec(name, rows.schema, keys=(key,), partition=bucketed((key,), 8))
    return _stored(spark, capture.tracked(spec))


def deliveries_with_deletes(spark, d) -> DataFrame:
    """Live rows after two full deliveries, the second one twice, and the first one once more, too late."""
    rows = _customer_rows(spark, d)
    target, log = _tracked(spark, d, "customers", "c_custkey", rows), RunLog(spark, scratch_path(spark, "runs"))
    first, second = (datetime.datetime(2024, 1, n, tzinfo=datetime.timezone.utc) for n in (1, 2))
    for delivery, at in ((rows, first), (_next_delivery(rows), second), (_next_delivery(rows), second), (rows, first)):
        capture.load_delivery(target, delivery, at, log)
    return capture.live(target)


def change_log_with_deletes(spark, d) -> DataFrame:
    """Orders after a change log that arrives newest part first: placed, changed by status, deleted if refused; then old tombstones go."""
    orders = table(spark, d, "orders")
    rows = orders.select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("status"), "o_totalprice")
    target = _tracked(spark, d, "orders", "o_orderkey", rows)
    placed = F.col("o_orderdate").cast("timestamp")

    def entry(op: str, hours: int, status) -> DataFrame:
        return orders.select("o_orderkey", "o_custkey", status.alias("status"), "o_totalprice", F.lit(op).alias("_op"),
                             (placed + F.make_dt_interval(hours=F.lit(hours))).alias("_changed_at"), "o_orderstatus", "o_orderpriority")

    first = entry("insert", 0, F.lit("placed")).drop("o_orderstatus", "o_orderpriority")
    moved = entry("update", 5, F.col("o_orderstatus")).where("o_orderstatus <> 'O'").drop("o_orderstatus", "o_orderpriority")
    refused = entry("delete", 3, F.lit(None)).where("o_orderpriority = '5-LOW'").drop("o_orderstatus", "o_orderpriority")
    for part in (moved.unionByName(refused), first, refused):
        capture.apply_changes(target, part)
    capture.purge(target, datetime.datetime(2030, 1, 1, tzinfo=datetime.timezone.utc))
    return capture.live(target)


# -- intervals


@functools.cache
def _time_tables(app: str, d: str) -> tuple[dict[str, StoredTable], IntervalLedger]:
    """Revenue tables filled in three steps: one year, of which July's orders have not been paid yet; then a longer range, of which
    only what is missing is loaded; then July, dirty."""
    spark = SparkSession.active()
    specs = {n: GOLD[n] for n in ("daily_revenue", "monthly_revenue", "category_revenue")} | {"weekly_revenue": WEEKLY_REVENUE}
    tables = {n: _stored(spark, spec) for n, spec in specs.items()}
    ledger = IntervalLedger(spark, scratch_path(spark, "ledger"))
    orders, products = silver(spark, d, "orders"), silver(spark, d, "products")
    facts = gold.dated_facts(orders, silver(spark, d, "items"))
    layout = {"_month": "date_format(order_date, 'yyyy-MM')"}
    stored = _stored(spark, TableSpec("dated_facts", facts.schema, partition=layout, ordered_by="order_date"))
    loads.replace_table(stored, facts)
    items = stored.read()
    july = (datetime.date(1996, 7, 1), datetime.date(1996, 8, 1))
    unpaid = F.col("order_date").between(F.lit(july[0]), F.lit(july[1] - datetime.timedelta(days=1)))
    early = orders.withColumn("status", F.when(unpaid, "cancelled").otherwise(F.col("status")))

    def models(known: DataFrame) -> list[TimeModel]:
        ordered = (tables[n] for n in ("daily_revenue", "weekly_revenue", "monthly_revenue", "category_revenue"))
        return gold.time_models(*ordered, known, items, products)

    refresh(ledger, models(early), datetime.date(1996, 1, 1), datetime.date(1997, 1, 1))
    refresh(ledger, models(early), *INTERVAL)
    ledger.record("daily_revenue", july, DIRTY)
    refresh(ledger, models(orders), *INTERVAL)
    return tables, ledger


def interval_table(spark, d, name: str) -> DataFrame:
    """A revenue table that was loaded interval by interval."""
    return _time_tables(spark.sparkContext.applicationId, d)[0][name].read().drop("_computed_at")


def interval_ledger(spark, d) -> DataFrame:
    """The intervals of each model after all loads, and how many days of loading they took."""
    ledger = _time_tables(spark.sparkContext.applicationId, d)[1]
    days = ledger.events().where("state = 'loaded'").groupBy("model").agg(F.sum(F.date_diff("end", "start")).cast("bigint").alias("days_loaded"))
    out = None
    for model in ("daily_revenue", "weekly_revenue", "monthly_revenue", "category_revenue"):
        one = ledger.intervals(model).select(F.lit(model).alias("model"), "start", "end", "state")
        out = one if out is None else out.unionByName(one)
    return out.join(days, "model")


# -- events


def _event_windows(spark, d, arrival: list, lateness: str) -> EventWindows:
    """Daily counts per type from events that arrive in files, one for each condition of ``arrival``, a run after each."""
    events = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    inbox = scratch_path(spark, "inbox")
    total = F.sum(F.col("value").cast("decimal(18,2)")).cast("decimal(18,2)")
    windows = EventWindows(spark, inbox, events.schema, scratch_path(spark, "windows"), "1 day", lateness, ["event_type"], total=total)
    for condition in arrival:
        events.where(condition).write.mode("append").parquet(inbox)
        windows.run()
    return windows


def events_stream(spark, d) -> DataFrame:
    """Closed daily windows of a stream whose events come in order, a third of the month at a time."""
    thirds = ["day(ts) <= 10", "day(ts) BETWEEN 11 AND 20", "day(ts) > 20"]
    return _by_day(_event_windows(spark, d, thirds, "1 hour").closed())


def _by_day(windows: DataFrame) -> DataFrame:
    return windows.select(F.to_date("window_start").alias("day"), "event_type", "events", "total")


def events_stream_out_of_order(spark, d) -> DataFrame:
    """The same from events that come out of order, errors two days after the rest, which the stream waits for."""
    arrives = "ts + make_dt_interval(CASE WHEN event_type = 'error' THEN 2 ELSE 0 END)"
    first, second = "TIMESTAMP '2024-01-11 00:00:00'", "TIMESTAMP '2024-01-21 00:00:00'"
    parts = [f"{arrives} < {first}", f"{arrives} >= {first} AND {arrives} < {second}", f"{arrives} >= {second}"]
    return _by_day(_event_windows(spark, d, parts, "3 days").closed())


def events_stream_late(spark, d) -> DataFrame:
    """What becomes of events if the first ten days come after all others: those of closed days are late."""
    got = _event_windows(spark, d, ["day(ts) > 10", "day(ts) <= 10"], "1 hour").arrivals()
    return spark.createDataFrame([(got.read, got.counted, got.open, got.late)], "read bigint, counted bigint, waiting bigint, late bigint")


# -- quality


def quality_checks(spark, d) -> DataFrame:
    """Failing rows per rule, one pass per table."""
    kept, raw = _kept(spark, d, "orders"), bronze(spark, d, "raw_order_items")
    cleaned = cleaning.clean_order_items(raw, kept, _kept(spark, d, "products"))
    orders = constraints.check_quality(
        kept,
        {"amount is positive": "total_amount > 0", "creation time is present": "created_at IS NOT NULL"},
    )
    items = constraints.check_quality(cleaned, {"discount is not full": "discount < 100"})
    return orders.select(F.lit("orders").alias("table_name"), "*").unionByName(
        items.select(F.lit("order_items").alias("table_name"), "*")
    )


def unique_emails(spark, d) -> DataFrame:
    """Rows left when every row whose unique column is contested goes to quarantine."""
    batch = table(spark, d, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.lit("acct"), F.floor("c_acctbal").cast("string")).alias("email"),
    )
    return constraints.enforce_unique(batch, None, CUSTOMERS, "quarantine")


def enforce_sales(spark, d) -> DataFrame:
    """Sales per combination of broken checks."""
    sales = table(spark, d, "lineitem").select(
        F.when(F.col("l_linestatus") == "F", "web").when(F.col("l_returnflag") == "R", "phone").alias("channel"),
        (F.col("l_quantity").cast("int") - 1).alias("quantity"),
        F.lit(1).cast("decimal(10,2)").alias("unit_price"),
        (F.col("l_tax") * 1500).cast("decimal(5,2)").alias("discount_pct"),
    )
    only_checks = SALES.like("sales", not_null=())
    reasons = constraints.row_errors(only_checks)
    return sales.groupBy(reasons.alias("reasons")).agg(F.count("*").alias("sales"))


# -- the whole run


@functools.cache
def _house(app: str, d: str) -> medallion.Warehouse:
    spark = SparkSession.active()
    house = medallion.Warehouse(spark, scratch_path(spark, "warehouse"), buckets=8, prefix=f"h{uuid.uuid4().hex[:12]}_")
    for name in BRONZE_SQL:
        for number in (1, 2):
            rows = _batch(bronze(spark, d, name), number)
            ingest_bronze(house.bronze(name), rows, f"batch-{number}", ingested_at=f"2024-01-0{number} 00:00:00")
    medallion.run_medallion(house, AS_OF_DATE, **THRESHOLDS)
    return house


def _ran(spark, d) -> medallion.Warehouse:
    """A warehouse that was filled from the driver tables, once per session and scale."""
    return _house(spark.sparkContext.applicationId, d)


@functools.cache
def _stepped_house(app: str, d: str) -> medallion.Warehouse:
    spark = SparkSession.active()
    house = medallion.Warehouse(spark, scratch_path(spark, "steps"), buckets=8)
    for number, since in ((1, None), (2, datetime.timedelta(0))):
        for name in BRONZE_SQL:
            rows = _batch(bronze(spark, d, name), number)
            ingest_bronze(house.bronze(name), rows, f"batch-{number}", ingested_at=f"2024-01-0{number} 00:00:00")
        medallion.run_medallion(house, AS_OF_DATE, since=since, **THRESHOLDS)
    return house


def stepped_gold(spark, d, name: str) -> DataFrame:
    """A gold table after a full run over the first batch and an incremental one over the second, once per session and scale."""
    return _stepped_house(spark.sparkContext.applicationId, d).gold(name).read().drop("_computed_at")


def run_log(spark, d) -> DataFrame:
    """The logged state of the whole run, with the rows each silver table was loaded from."""
    counts = [
        F.get_json_object("metadata", f"$.{n}").cast("bigint").alias(n)
        for n in ("customers", "products", "orders", "order_items")
    ]
    return _ran(spark, d).log().runs().where("pipeline_name = 'medallion'").select("pipeline_name", "layer", "status", *counts)


def catalog_query(spark, d) -> DataFrame:
    """Ad-hoc SQL over a gold table by its layer name."""
    prefix = _layers(spark)
    target = _stored(spark, medallion.GOLD["daily_revenue"])
    loads.replace_table(target, _daily(spark, d))
    catalog.register(target, f"{prefix}gold.daily_revenue")
    return spark.sql(f"""
WITH monthly AS (
  SELECT date_format(revenue_date, 'yyyy-MM') AS year_month, CAST(sum(gross_revenue) AS DECIMAL(28,2)) AS gross_revenue,
         sum(order_count) AS order_count
  FROM {prefix}gold.daily_revenue GROUP BY 1)
SELECT year_month, gross_revenue, order_count FROM monthly WHERE order_count > 100""")


def order_summary_view(spark, d) -> DataFrame:
    """The helper view, by its catalog name, over the tables of the whole run."""
    house = _ran(spark, d)
    medallion.register(house)
    return spark.sql(f"SELECT * FROM {house.prefix}silver.v_order_summary")


# -- plain SQL


def month_gaps(spark, d) -> DataFrame:
    """Every calendar month between first and last order, from a recursive query, with refunded orders."""
    silver(spark, d, "orders").createOrReplaceTempView("smeltworks_orders")
    return spark.sql("""
WITH RECURSIVE bounds AS (
  SELECT to_date(date_trunc('month', min(order_date))) AS lo, to_date(date_trunc('month', max(order_date))) AS hi
  FROM smeltworks_orders),
months(month_start, hi) MAX RECURSION LEVEL 12000 AS (
  SELECT lo, hi FROM bounds
  UNION ALL
  SELECT to_date(add_months(month_start, 1)), hi FROM months WHERE month_start < hi),
refunded AS (
  SELECT to_date(date_trunc('month', order_date)) AS month_start, count(*) AS refunded_orders
  FROM smeltworks_orders WHERE status = 'refunded' GROUP BY 1)
SELECT m.month_start, coalesce(r.refunded_orders, 0) AS refunded_orders
FROM months m LEFT JOIN refunded r ON m.month_start = r.month_start""")


def events_json(spark, d) -> DataFrame:
    """JSON properties of click events, per type."""
    k = F.variant_get(F.parse_json("props"), "$.k", "bigint")
    return (
        table(spark, d, "events")
        .select("event_type", k.alias("k"))
        .groupBy("event_type")
        .agg(F.count("*").alias("events"), F.sum("k").alias("k_total"), F.max("k").alias("k_max"))
    )


def registry() -> dict:
    """All queries by name."""
    no_buffer, hour = datetime.timedelta(0), datetime.timedelta(hours=1)
    return {
        "daily_revenue": _daily,
        "monthly_revenue": _monthly,
        "monthly_revenue_previous_row": lambda s, d: gold.monthly_revenue(_daily(s, d), mom="previous_row"),
        "weekly_revenue": lambda s, d: gold.weekly_revenue(_daily(s, d)),
        "customer_ltv": _ltv,
        "product_performance": _performance,
        "order_summary": lambda s, d: gold.order_summary(
            silver(s, d, "orders"), silver(s, d, "customers"), silver(s, d, "items")
        ),
        "category_revenue": lambda s, d: gold.category_revenue(
            silver(s, d, "products"), silver(s, d, "items"), silver(s, d, "orders")
        ),
        "high_value_orders": lambda s, d: cleaning.flag_high_value(silver(s, d, "orders")),
        "completed_by_day": lambda s, d: gold.completed_by_day(silver(s, d, "orders")),
        "kpi_tiles": lambda s, d: gold.kpi_tiles(_daily(s, d), silver(s, d, "orders")),
        "total_ltv": lambda s, d: gold.total_ltv(_ltv(s, d)),
        "customers_by_segment": lambda s, d: gold.ltv_by_segment(_ltv(s, d)),
        "revenue_by_tier": lambda s, d: gold.revenue_by_tier(_ltv(s, d)),
        "churn_rate": lambda s, d: gold.churn_rate(_ltv(s, d)),
        "top_products": lambda s, d: gold.top_products(_performance(s, d)),
        "running_revenue": lambda s, d: analytics.running_revenue(_daily(s, d)),
        "rolling_30_rows": lambda s, d: analytics.rolling_month(_daily(s, d)),
        "customer_ranks": lambda s, d: analytics.customer_ranks(materialise(_ltv(s, d))),
        "month_growth": lambda s, d: analytics.month_growth(_monthly(s, d)),
        "order_history": lambda s, d: analytics.order_history(silver(s, d, "orders")),
        "order_history_hot_customers": order_history_hot_customers,
        "top_products_per_category": lambda s, d: analytics.top_products_per_category(materialise(_performance(s, d))),
        "best_month": lambda s, d: analytics.best_month(silver(s, d, "orders"), silver(s, d, "items")),
        "silver_customers": lambda s, d: _shown(_clean(s, d, "customers")),
        "silver_products": lambda s, d: _shown(_clean(s, d, "products")),
        "silver_orders": lambda s, d: _shown(_clean(s, d, "orders")),
        "silver_orders_hot_customers": silver_orders_hot_customers,
        "silver_order_items": lambda s, d: _shown(_clean(s, d, "order_items")),
        "rejected_orders": rejected_orders,
        "orphan_items": orphan_items,
        "bronze_batches": bronze_batches,
        "csv_ingest": csv_ingest,
        "json_ingest": json_ingest,
        "validate_bronze": validate_bronze,
        "upsert_customers": upsert_customers,
        "upsert_orders": upsert_orders,
        "rebucketed_upsert": rebucketed_upsert,
        "incremental_late_parent": incremental_late_parent,
        "catalog_after_inserts": catalog_after_inserts,
        "customers_full_refresh": customers_full_refresh,
        "insert_new_orders": insert_new_orders,
        "orders_by_key": orders_by_key,
        "replace_table": replace_table,
        "replace_partition": replace_partition,
        "backfill_range": backfill_range,
        "daily_revenue_backfill": daily_revenue_backfill,
        "incremental_load": lambda s, d: _incremental(s, d, no_buffer),
        "incremental_load_buffered": lambda s, d: _incremental(s, d, hour),
        "stream_upsert": lambda s, d: stream_orders(s, d, (1, 2)),
        "stream_upsert_out_of_order": lambda s, d: stream_orders(s, d, (2, 1)),
        "stream_upsert_delayed": lambda s, d: stream_orders(s, d, (1, 2), delayed=True),
        "sales_month": sales_month,
        "sales_busy_months": sales_busy_months,
        "bucketed_order_totals": bucketed_order_totals,
        "sorted_orders": sorted_orders,
        "distinct_customers_by_month": lambda s, d: distinct_customers(s, d, year_month=F.date_format("order_date", "yyyy-MM")),
        "distinct_customers_by_week": lambda s, d: distinct_customers(s, d, week_start=F.date_trunc("week", "order_date").cast("date")),
        "distinct_customers_by_tier": lambda s, d: distinct_customers(s, d, tier=F.col("tier"), year=F.year("order_date")),
        "snapshot_changes": snapshot_changes,
        "deliveries_with_deletes": deliveries_with_deletes,
        "change_log_with_deletes": change_log_with_deletes,
        **{
            f"interval_{name}": functools.partial(interval_table, name=name)
            for name in ("daily_revenue", "weekly_revenue", "monthly_revenue", "category_revenue")
        },
        "interval_ledger": interval_ledger,
        "quality_checks": quality_checks,
        "unique_emails": unique_emails,
        "enforce_sales": enforce_sales,
        "medallion_daily_revenue": lambda s, d: _ran(s, d).gold("daily_revenue").read().drop("_computed_at"),
        "medallion_customer_ltv": lambda s, d: _ran(s, d).gold("customer_ltv").read().drop("_computed_at"),
        "medallion_product_performance": lambda s, d: _ran(s, d).gold("product_performance").read().drop("_computed_at"),
        **{f"increment_{name}": functools.partial(stepped_gold, name=name) for name in GOLD},
        "run_log": run_log,
        "catalog_query": catalog_query,
        "order_summary_view": order_summary_view,
        "month_gaps": month_gaps,
        "events_json": events_json,
        "events_json_paths": lambda s, d: json_paths(table(s, d, "events"), "props"),
        "events_stream": events_stream,
        "events_stream_out_of_order": events_stream_out_of_order,
        "events_stream_late": events_stream_late,
    }
