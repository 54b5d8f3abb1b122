import datetime

import pytest
from pyspark.sql import functions as F
from samples import silver_items, silver_orders

from smeltworks.plans import gold
from smeltworks.schemas import GOLD, WEEKLY_REVENUE, TableSpec, columns
from smeltworks.sources import intervals
from smeltworks.sources.intervals import DIRTY, IntervalLedger, TimeModel, floor, later, load_missing, merged, refresh, whole
from smeltworks.sources.scratch import materialise
from smeltworks.sources.tables import StoredTable


@pytest.fixture
def ledger(spark, tmp_path):
    return IntervalLedger(spark, f"file://{tmp_path}/ledger")


def shown(ledger, model="m"):
    return sorted((str(r.start), str(r.end), r.state) for r in ledger.intervals(model).collect())


def test_units_of_the_calendar(day):
    assert floor(day("2024-03-03"), "week") == day("2024-02-26") and floor(day("2024-03-03"), "month") == day("2024-03-01")
    assert later(day("2024-01-31"), "month") == day("2024-02-01") and later(day("2024-01-05"), "month", -1) == day("2023-12-01")
    assert later(day("2024-12-30"), "week") == day("2025-01-06") and later(day("2024-02-28"), "day") == day("2024-02-29")
    assert whole((day("2024-02-15"), day("2024-03-01")), "month") == (day("2024-02-01"), day("2024-03-01"))
    assert merged([(5, 7), (1, 3), (3, 4), (6, 9)]) == [(1, 4), (5, 9)]


def test_neighbours_merge_and_gaps_show(ledger, day):
    assert ledger.missing("m", day("2024-01-01"), day("2024-01-05")) == [(day("2024-01-01"), day("2024-01-05"))]
    for start, end in (("2024-01-03", "2024-01-05"), ("2024-01-05", "2024-01-08"), ("2024-01-10", "2024-01-12"), ("2024-01-04", "2024-01-06")):
        ledger.record("m", (day(start), day(end)))
    ledger.record("other", (day("2024-01-01"), day("2024-02-01")))
    assert shown(ledger) == [("2024-01-03", "2024-01-08", "loaded"), ("2024-01-10", "2024-01-12", "loaded")]
    assert ledger.missing("m", day("2024-01-01"), day("2024-01-13")) == [
        (day("2024-01-01"), day("2024-01-03")), (day("2024-01-08"), day("2024-01-10")), (day("2024-01-12"), day("2024-01-13")),
    ]
    assert ledger.missing("m", day("2024-01-04"), day("2024-01-07")) == [] == ledger.missing("m", day("2024-01-09"), day("2024-01-09"))
    ledger.record("m", (day("2024-01-05"), day("2024-01-07")), DIRTY)
    assert shown(ledger)[1] == ("2024-01-05", "2024-01-07", "dirty")
    assert ledger.missing("m", day("2024-01-03"), day("2024-01-08")) == [(day("2024-01-05"), day("2024-01-07"))]
    with pytest.raises(ValueError, match="empty"):
        ledger.record("m", (day("2024-01-05"), day("2024-01-05")))


def make(spark, tmp_path, name, unit, calls, source, after=(), reach=0):
    """A model whose rows say what the unit before them held, so that a missing follow-up load would show."""
    spec = TableSpec(name, columns("d date\nn bigint\nbefore bigint"), keys=("d",))
    table = StoredTable(spark, f"file://{tmp_path}/{name}", spec)

    def build(start, end):
        calls.append((name, str(start), str(end)))
        unit_of = F.to_date(F.date_trunc(unit, "d"))
        sums = source().groupBy(unit_of.alias("d")).agg(F.sum("n").alias("n"))
        earlier = sums.select(F.to_date(F.add_months("d", 1) if unit == "month" else F.date_add("d", 1)).alias("d"), F.col("n").alias("before"))
        return sums.join(earlier, "d", "left").where(F.col("d").between(F.lit(start), F.lit(end - datetime.timedelta(days=1))))

    return TimeModel(name, table, "d", build, unit, reach=reach, after=after)


def test_only_gaps_are_loaded_and_dependents_follow(spark, tmp_path, ledger, day):
    calls, values = [], {str(day("2024-01-01") + datetime.timedelta(days=i)): i for i in range(120)}

    def source():
        return spark.createDataFrame(list(values.items()), "d string, n bigint").withColumn("d", F.col("d").cast("date"))

    daily = make(spark, tmp_path, "daily", "day", calls, source)
    monthly = make(spark, tmp_path, "monthly", "month", calls, source, ("daily",), 1)

    def content():
        return {str(r.d): (r.n, r.before) for r in monthly.table.read().collect()}

    refresh(ledger, [daily, monthly], day("2024-02-01"), day("2024-03-15"))
    assert calls == [("daily", "2024-02-01", "2024-03-15"), ("monthly", "2024-02-01", "2024-04-01")]
    calls.clear()
    assert refresh(ledger, [daily, monthly], day("2024-02-01"), day("2024-03-15")) == {"daily": [], "monthly": []} and calls == []
    refresh(ledger, [daily, monthly], day("2024-01-01"), day("2024-04-01"))
    # January is new and February depends on it; March is there already but the days behind it are new.
    assert calls == [
        ("daily", "2024-01-01", "2024-02-01"), ("daily", "2024-03-15", "2024-04-01"),
        ("monthly", "2024-01-01", "2024-03-01"), ("monthly", "2024-03-01", "2024-04-01"),
    ]
    calls.clear()
    values["2024-01-10"] = 1000
    ledger.record("daily", (day("2024-01-10"), day("2024-01-11")), DIRTY)
    # What is dirty is loaded wherever it lies.
    refresh(ledger, [daily, monthly], day("2024-02-01"), day("2024-03-01"))
    assert calls == [("daily", "2024-01-10", "2024-01-11"), ("monthly", "2024-01-01", "2024-03-01")]
    months = {m: sum(n for d, n in values.items() if d.startswith(m)) for m in ("2024-01", "2024-02", "2024-03")}
    assert content() == {"2024-01-01": (months["2024-01"], None), "2024-02-01": (months["2024-02"], months["2024-01"]), "2024-03-01": (months["2024-03"], months["2024-02"])}
    assert daily.table.read().count() == 91


def test_a_load_that_breaks_goes_on_where_it_was(spark, tmp_path, ledger, day, monkeypatch):
    calls = []
    rows = spark.createDataFrame([("2024-01-02", 1), ("2024-01-06", 2)], "d string, n bigint").withColumn("d", F.col("d").cast("date"))
    daily = make(spark, tmp_path, "daily", "day", calls, lambda: rows)
    ledger.record("daily", (day("2024-01-03"), day("2024-01-05")))
    ledger.record("reader", (day("2024-01-01"), day("2024-02-01")))
    replace_range, seen = intervals.replace_range, []

    def once(*args):
        if seen:
            raise RuntimeError("lost")
        seen.append(args)
        return replace_range(*args)

    monkeypatch.setattr(intervals, "replace_range", once)
    with pytest.raises(RuntimeError, match="lost"):
        load_missing(ledger, daily, day("2024-01-01"), day("2024-01-08"), ["reader"])
    # The reader knows of both gaps, of the second one before it is loaded.
    assert ledger.dirty("reader") == [(day("2024-01-01"), day("2024-01-03")), (day("2024-01-05"), day("2024-01-08"))]
    monkeypatch.setattr(intervals, "replace_range", replace_range)
    done, metrics = load_missing(ledger, daily, day("2024-01-01"), day("2024-01-08"))
    assert done == [(day("2024-01-05"), day("2024-01-08"))] and metrics.processed == 1 and daily.table.read().count() == 2


def test_models_read_dated_facts_like_items(spark, tmp_path, day, rows, monkeypatch):
    # Order 1 comes twice with two dates, order 2 twice with one; the last range holds both dates of order 1.
    records = [(1, 1, "2024-01-30", "completed", "5"), (1, 1, "2024-02-02", "completed", "5"), (2, 1, "2024-02-03", "shipped", "7"),
               (2, 1, "2024-02-03", "shipped", "7"), (3, 2, "2024-02-20", "cancelled", "9"), (4, 2, None, "completed", "1")]
    orders = silver_orders(spark, records)
    items = silver_items(spark, [(1, 1, 2, "1", "2"), (1, 1, 1, "1", "1"), (1, 2, 1, "4", "4"), (2, 2, 1, "4", "4"), (3, 1, 5, "1", "5"), (4, 1, 1, "1", "1")])
    products = spark.createDataFrame([(1, "pen"), (2, "ink")], "product_id int, category string")
    facts = materialise(gold.dated_facts(orders, items), "facts")
    tables = [StoredTable(spark, f"file://{tmp_path}/{spec.name}", spec) for spec in (GOLD["daily_revenue"], WEEKLY_REVENUE, GOLD["monthly_revenue"], GOLD["category_revenue"])]
    monkeypatch.setattr(gold, "join_unique", lambda *args, **kwargs: pytest.fail("all items are joined"))
    by_fact = gold.time_models(*tables, orders, facts, products)
    ranges = [(day(low), day(high)) for low, high in (("2024-01-01", "2024-02-01"), ("2024-02-01", "2024-03-01"), ("2024-01-01", "2024-03-01"))]
    built = [rows(m.build(*r)) for m in (by_fact[0], by_fact[3]) for r in ranges]
    monkeypatch.undo()
    by_item = gold.time_models(*tables, orders, items, products)
    assert built[0] and built[3] and built == [rows(m.build(*r)) for m in (by_item[0], by_item[3]) for r in ranges]
