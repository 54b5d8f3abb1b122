import collections
import datetime

import pytest
from samples import bronze, customer, item, order, product, uid

from smeltworks.operators.constraints import ConstraintViolation, conform
from smeltworks.plans import medallion
from smeltworks.plans.incremental import load_facts
from smeltworks.schemas import GOLD, SILVER
from smeltworks.sources.raw import ingest_bronze
from smeltworks.sources.scratch import scratch_path

AS_OF = datetime.date(2021, 6, 1)


def fill(house, batch, **tables):
    for name, records in tables.items():
        frame = bronze(house.spark, f"raw_{name}", records)
        ingest_bronze(house.bronze(f"raw_{name}"), frame, batch, ingested_at=f"2024-01-0{batch[-1]} 00:00:00")


def content(table, rows):
    return rows(table.read().drop("_silver_loaded_at", "_computed_at"))


@pytest.fixture
def house(spark, tmp_path):
    return medallion.Warehouse(spark, f"file://{tmp_path}/house", buckets=2)


GOOD = {
    "customers": [customer(1), customer(2)],
    "products": [product(1)],
    "orders": [order(1), order(2, customer_id=uid(2, "c"), status="cancelled"), order(3, customer_id=uid(9, "c"))],
    "order_items": [item(1), item(2, order_id=uid(2)), item(3, order_id=uid(3))],
}


def test_a_run_fills_all_layers_and_repeats_itself(house, rows):
    fill(house, "b1", **GOOD)
    done = medallion.run_medallion(house, AS_OF)
    assert {n: m.processed for n, m in done.items()} == {
        "customers": 2, "products": 1, "orders": 2, "order_items": 2, "order_facts": 2, "daily_revenue": 1, "monthly_revenue": 1,
        "customer_ltv": 2, "product_performance": 1, "category_revenue": 1,
    }
    tables = [house.silver(n) for n in SILVER] + [house.gold(n) for n in GOLD]
    once = [content(t, rows) for t in tables]
    again = medallion.run_medallion(house, AS_OF)
    assert [content(t, rows) for t in tables] == once
    assert again["orders"].inserted == 0 and again["orders"].updated == 2
    # A new batch changes what it should, and daily comes before monthly.
    fill(house, "b2", orders=[order(4, order_date="2021-04-01")], order_items=[item(9, order_id=uid(4))])
    medallion.run_medallion(house, AS_OF, since=datetime.timedelta(0))
    months = rows(house.gold("monthly_revenue").read(), "year_month", "order_count")
    assert months == [("2021-03", 2), ("2021-04", 1)]
    log = house.log().runs()
    assert rows(log.where("layer = 'all'"), "status") == [("SUCCESS",)] * 3
    assert rows(log.where("layer = 'silver'"), "pipeline_name") == sorted((f"silver_{n}",) for n in SILVER for _ in range(3))
    assert rows(log.where("layer = 'gold'"), "status") == [("SUCCESS",)] * 3


def test_an_empty_bronze_table_stops_the_run(house):
    fill(house, "b1", customers=[customer(1)])
    with pytest.raises(ConstraintViolation, match="empty tables"):
        medallion.run_medallion(house, AS_OF)
    assert house.log().runs().first().status == "FAILED"
    assert not house.silver("customers").exists()


def test_bad_rows_fail_the_run_or_are_left_out(house, rows):
    bad = {**GOOD, "customers": [*GOOD["customers"], customer(3, tier="vip"), customer(4, email="user1@x.org")]}
    fill(house, "b1", **bad)
    with pytest.raises(Exception, match="tier breaks check"):
        medallion.run_medallion(house, AS_OF)
    medallion.run_medallion(house, AS_OF, on_error="quarantine")
    # 1 and 4 contest one email; with 1 gone its order goes too.
    assert rows(house.silver("customers").read(), "customer_id") == [(uid(2, "c"),)]
    assert rows(house.silver("orders").read(), "order_id") == [(uid(2),)]
    assert rows(house.rejects("customers").read(), "rejected_key", "_errors") == [
        (uid(1, "c"), "email is not unique"), (uid(3, "c"), "tier breaks check"), (uid(4, "c"), "email is not unique"),
    ]
    assert rows(house.rejects("orders").read(), "rejected_key", "_errors") == [
        (uid(1), "customer_id is unknown"), (uid(3), "customer_id is unknown"),
    ]


def test_shared_email_fails_the_run(house):
    fill(house, "b1", **{**GOOD, "customers": [customer(1), customer(2, email="USER1@x.org ")]})
    with pytest.raises(ConstraintViolation, match="customers.email is not unique"):
        medallion.run_medallion(house, AS_OF)


def test_counts_and_quality_report(house, rows):
    fill(house, "b1", **GOOD)
    assert rows(medallion.validate_bronze(house), "table_name", "row_count") == [
        ("raw_customers", 2), ("raw_order_items", 3), ("raw_orders", 3), ("raw_products", 1),
    ]
    medallion.run_medallion(house, AS_OF)
    report = medallion.quality_report(house)
    assert report.where("failing_rows > 0").isEmpty() and report.count() == 11


def test_sql_over_the_catalog(house, rows):
    spark = house.spark
    fill(house, "b1", **GOOD)
    medallion.run_medallion(house, AS_OF)
    medallion.register(house)
    got = spark.sql("""
        SELECT full_name, tier, total_revenue, RANK() OVER (PARTITION BY tier ORDER BY total_revenue DESC) AS rank_in_tier
        FROM gold.customer_ltv WHERE total_orders > 0 ORDER BY tier, rank_in_tier""").collect()
    assert len(got) == 1 and got[0].rank_in_tier == 1
    assert spark.table("silver.v_order_summary").count() == 2
    assert spark.table("bronze.raw_orders").where("_batch_id = 'b1'").count() == 3
    before = spark.table("silver.orders").count()
    fill(house, "b2", orders=[order(5)])
    medallion.load_silver(house, "orders")
    medallion.register(house)
    assert spark.table("silver.orders").count() == before + 1


@pytest.mark.parametrize(("on_error", "buffer"), [("fail", 0), ("quarantine", 1)])
def test_increments_equal_a_full_run(spark, tmp_path, rows, on_error, buffer):
    houses = [medallion.Warehouse(spark, f"file://{tmp_path}/{n}", buckets=2) for n in ("full", "increments")]
    full, steps = houses
    second = {
        "customers": [customer(3)], "products": [product(2)], "orders": [order(1, status="refunded"), order(7)],
        "order_items": [item(7, order_id=uid(7), product_id=uid(2, "d"))],
    }
    for batch, tables in (("b1", GOOD), ("b2", second)):
        for house in houses:
            fill(house, batch, **tables)
        late = datetime.timedelta(hours=buffer)
        done = {n: medallion.load_silver_increment(steps, n, late, on_error) for n in SILVER}
    counts = {n: done[n].processed for n in SILVER}
    if buffer:
        # The hour before the mark, which is the whole first batch, was read again.
        assert counts == {"customers": 3, "products": 2, "orders": 3, "order_items": 3}
    else:
        assert counts == {"customers": 1, "products": 1, "orders": 2, "order_items": 1}
    for name in SILVER:
        medallion.load_silver(full, name, on_error)
        keep = [c for c in full.silver(name).spec.schema.names if c not in ("_silver_loaded_at", "created_at")]
        assert rows(steps.silver(name).read(), *keep) == rows(full.silver(name).read(), *keep)
    if on_error == "quarantine":
        for name in ("orders", "order_items"):
            assert rows(steps.rejects(name).read(), "rejected_key", "_errors") == rows(full.rejects(name).read(), "rejected_key", "_errors")


SECOND = {
    # A new name, a customer of nothing.
    "customers": [customer(2, last_name="Else"), customer(3)],
    # Another category and cost, a product nobody buys.
    "products": [product(1, category="Tools", cost="1"), product(3)],
    # Another state; an order before its customer's first one; one without items; one that had to wait for its customer.
    "orders": [order(2, customer_id=uid(2, "c"), status="completed"), order(5, order_date="2021-01-02"), order(6, customer_id=uid(3, "c"))],
    # An item changed, items of old and new orders, a product that lay unsold.
    "order_items": [item(1, quantity="7"), item(8, order_id=uid(1), product_id=uid(2, "d")), item(9, order_id=uid(5)), item(10, order_id=uid(5))],
}


def test_gold_after_an_increment_equals_a_full_rebuild(spark, tmp_path, rows, monkeypatch):
    first = {
        **GOOD, "products": [product(1), product(2)],
        "customers": [*GOOD["customers"], customer(7)],
        "orders": [*GOOD["orders"], order(4, customer_id=uid(3, "c"), order_date="2021-02-03"), order(7, customer_id=uid(7, "c"), order_date="2021-05-05")],
        "order_items": [*GOOD["order_items"], item(4, order_id=uid(4)), item(7, order_id=uid(7), product_id=uid(2, "d"))],
    }
    full, steps = (medallion.Warehouse(spark, f"file://{tmp_path}/{n}", buckets=8) for n in ("full", "steps"))
    for house in (full, steps):
        fill(house, "b1", **first)
        medallion.run_medallion(house, AS_OF)
        fill(house, "b2", **SECOND)
    later = AS_OF + datetime.timedelta(days=150)
    medallion.run_medallion(full, later)
    done = medallion.run_medallion(steps, later, since=datetime.timedelta(0))
    for name in GOLD:
        assert content(steps.gold(name), rows) == content(full.gold(name), rows), name
    assert content(steps.gold("order_facts"), rows) == content(full.gold("order_facts"), rows)
    assert done["daily_revenue"].processed < full.gold("daily_revenue").read().count()
    # A run that broke before its mark moved is simply repeated; the one after it finds nothing new and writes no day.
    for house in (full, steps):
        fill(house, "b3", orders=[order(2, customer_id=uid(2, "c"), status="refunded")])
    with monkeypatch.context() as m:
        m.setattr("smeltworks.plans.incremental.merged_ltv", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            medallion.run_medallion(steps, later, since=datetime.timedelta(0))
    medallion.bring_gold(steps, later, datetime.timedelta(0))
    medallion.load_silver(full, "orders")
    medallion.load_gold(full, later)
    for name in GOLD:
        assert content(steps.gold(name), rows) == content(full.gold(name), rows), name
    again = medallion.bring_gold(steps, later, datetime.timedelta(0))
    assert (again["order_facts"].processed, again["daily_revenue"].processed, again["category_revenue"].processed) == (0, 0, 0)


def test_only_items_of_touched_orders_are_read(house):
    fill(house, "b1", **GOOD)
    medallion.run_medallion(house, AS_OF)
    orders, items = house.silver("orders").read(), house.silver("order_items")
    touched = orders.where(orders.order_id == uid(1)).select("order_id", "order_date", "customer_id")
    folders = items.folders_of(items.with_partition(touched))
    assert len(folders) == 1
    plan = items.read(folders).join(touched, "order_id", "left_semi")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(concat_ws" in plan or "PartitionFilters: [concat_ws" in plan
    got = load_facts(house.gold("order_facts"), orders, items, touched)
    assert got.processed == 1


def test_a_late_parent_brings_its_waiting_rows(house, rows):
    def increment():
        for name in SILVER:
            medallion.load_silver_increment(house, name, datetime.timedelta(0))

    fill(house, "b1", customers=[customer(1)], products=[product(1)], orders=[order(1), order(2, customer_id=uid(2, "c"))], order_items=[item(1), item(2, order_id=uid(2))])
    increment()
    assert house.silver("orders").read().count() == 1 and house.waiting("orders").read().count() == 1
    # A newer row of the waiting order replaces it, and the parent comes with it.
    fill(house, "b2", customers=[customer(2)], orders=[order(2, customer_id=uid(2, "c"), status="shipped")])
    increment()
    assert rows(house.silver("orders").read(), "order_id", "status") == [(uid(1), "completed"), (uid(2), "shipped")]
    assert house.silver("order_items").read().count() == 2
    assert house.waiting("orders").read().isEmpty() and house.waiting("order_items").read().isEmpty()
    fill(house, "b3", orders=[order(3, customer_id=uid(3, "c"))])
    increment()
    fill(house, "b4", customers=[customer(3)])
    increment()
    assert house.silver("orders").read().count() == 3


def test_a_run_leaves_no_intermediate_tables(house):
    spark = house.spark
    fill(house, "b1", **GOOD)
    root = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark)).getParent()
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())

    def left():
        return {str(s.getPath()) for s in files.listStatus(root)} if files.exists(root) else set()

    before = left()
    medallion.run_medallion(house, AS_OF, on_error="quarantine")
    assert left() == before


def test_rows_with_parents_are_sorted_and_joined_once_per_load(house, monkeypatch):
    fill(house, "b1", **GOOD)
    medallion.load_silver(house, "customers")
    calls, latest_by = [], medallion.silver.latest_by
    monkeypatch.setattr(medallion.silver, "latest_by", lambda *args: calls.append(args) or latest_by(*args))
    medallion.load_silver(house, "orders")
    assert len(calls) == 1 and house.silver("orders").read().count() == 2 and house.waiting("orders").read().count() == 1
    fill(house, "b2", orders=[order(4), order(5, customer_id=uid(9, "c"))])
    medallion.load_silver_increment(house, "orders", datetime.timedelta(0))
    assert len(calls) == 2 and house.silver("orders").read().count() == 3 and house.waiting("orders").read().count() == 2


def test_facts_of_an_older_version_are_told_apart(house):
    facts = house.gold("order_facts")
    assert medallion._facts_complete(house)
    old = house.spark.createDataFrame([], facts.full_schema).drop("earns")
    old.unionByName(house.spark.sql("SELECT 'o' AS order_id, '2021-01' AS _month"), allowMissingColumns=True).write.partitionBy("_month").parquet(facts.path)
    assert not medallion._facts_complete(house)


def test_every_orphan_is_counted(house, rows):
    def store(name, keys):
        table = house.silver(name)
        known = house.spark.createDataFrame(keys, ", ".join(f"{c} string" for c in list(keys[0]._fields)))
        table.append(table.with_partition(conform(known, table.spec)))

    row = collections.namedtuple("row", "order_item_id order_id product_id")
    store("order_items", [row("1", "a", "p"), row("2", "b", "p"), row("3", "b", "q"), row("4", None, "p")])
    store("orders", [collections.namedtuple("row", "order_id customer_id")("a", "c")])
    report = {(r.table_name, r.rule): r.failing_rows for r in medallion.quality_report(house).collect()}
    assert report["order_items", "order_id is known"] == 3 and report["order_items", "product_id is known"] == 4
    assert report["orders", "customer_id is known"] == 1
