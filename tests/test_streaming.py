import datetime
import itertools

import pytest
from pyspark.sql import types as T
from samples import bronze, customer, order, uid

from smeltworks.operators.loads import LoadMetrics
from smeltworks.plans import silver
from smeltworks.schemas import BRONZE, ORDERS, bucketed, silver_spec
from smeltworks.sources.raw import ingest_bronze, read_raw
from smeltworks.sources.runs import EPOCH, RunLog
from smeltworks.sources.tables import StoredTable
from smeltworks.streaming.changes import ChangeStream
from smeltworks.streaming.watermark import incremental_load

HOUR = datetime.timedelta(hours=1)


@pytest.fixture
def customers(spark):
    return silver.clean_customers(bronze(spark, "raw_customers", [customer(1)]))


@pytest.fixture
def setting(spark, tmp_path, customers):
    source = StoredTable(spark, f"file://{tmp_path}/raw_orders", BRONZE["raw_orders"])
    target = StoredTable(spark, f"file://{tmp_path}/orders", silver_spec("orders", 4))
    log = RunLog(spark, f"file://{tmp_path}/runs")

    def load(buffer=datetime.timedelta(0), transform=None):
        clean = transform or (lambda rows: silver.clean_orders(rows, customers))
        return incremental_load(source, log, "bronze_orders", clean, target, buffer)

    return source, target, log, load


def take(spark, source, batch, stamp, *records):
    return ingest_bronze(source, bronze(spark, "raw_orders", list(records)), batch, ingested_at=stamp)


def statuses(target):
    return {r.order_id: r.status for r in target.read().collect()}


def test_only_new_rows_are_read_and_the_mark_is_what_was_read(spark, setting):
    source, target, log, load = setting
    assert log.last_watermark("bronze_orders") == EPOCH and load() == LoadMetrics()
    take(spark, source, "b1", "2024-01-01 10:00:00", order(1), order(2))
    assert load().inserted == 2
    assert log.last_watermark("bronze_orders") == datetime.datetime(2024, 1, 1, 10, tzinfo=datetime.timezone.utc)
    assert load().processed == 0
    take(spark, source, "b2", "2024-01-02 10:00:00", order(2, status="refunded"), order(3))
    got = load()
    assert (got.processed, got.inserted, got.updated) == (2, 1, 1)
    assert statuses(target) == {uid(1): "completed", uid(2): "refunded", uid(3): "completed"}


def test_rows_that_land_during_a_run_are_taken_by_the_next(spark, setting, customers):
    source, target, log, load = setting
    take(spark, source, "b1", "2024-01-01 10:00:00", order(1))

    def slow(rows):
        take(spark, source, "b2", "2024-01-01 10:30:00", order(2))
        return silver.clean_orders(rows, customers)

    assert load(transform=slow).inserted == 1
    assert load().inserted == 1
    assert set(statuses(target)) == {uid(1), uid(2)}


def test_late_rows_need_the_buffer(spark, setting):
    source, target, log, load = setting
    take(spark, source, "b1", "2024-01-01 10:00:00", order(1))
    load()
    take(spark, source, "late", "2024-01-01 09:30:00", order(2))
    assert load().processed == 0
    assert load(HOUR).inserted == 1
    once = statuses(target)
    load(HOUR)
    assert statuses(target) == once
    # The mark never goes back.
    assert log.last_watermark("bronze_orders").hour == 10


def test_a_failed_run_is_logged_and_does_not_move_the_mark(spark, setting):
    source, target, log, load = setting
    take(spark, source, "b1", "2024-01-01 10:00:00", order(1, order_date="no date"))
    with pytest.raises(Exception, match="order_date is not a date"):
        load()
    failed = log.events().where("status = 'FAILED'").first()
    assert "order_date is not a date" in failed.error_message
    assert log.last_watermark("bronze_orders") == EPOCH and target.read().isEmpty()


def test_other_pipelines_and_failures_do_not_count(spark, setting):
    log = setting[2]
    stamp = datetime.datetime(2024, 5, 5, 1, 2, 3, 456789, tzinfo=datetime.timezone.utc)
    log.log_run("other", "silver", "SUCCESS", watermark=stamp + HOUR)
    log.log_run("mine", "silver", "FAILED", watermark=stamp + HOUR)
    log.log_run("mine", "silver", "SUCCESS", watermark=stamp)
    assert log.last_watermark("mine") == stamp
    with pytest.raises(ValueError):
        log.log_run("mine", "silver", "DONE")


def test_log_keeps_events_and_folds_runs(spark, setting):
    log = setting[2]
    run = log.log_run("p", "all", "RUNNING")
    log.log_run("p", "all", "SUCCESS", LoadMetrics(3, 2, 1), run_id=run, metadata={"n": 3})
    assert log.events().count() == 2
    last = log.runs().first()
    assert (last.status, last.rows_processed, last.rows_inserted, last.rows_updated) == ("SUCCESS", 3, 2, 1)
    assert last.metadata == '{"n": 3}'


def test_bronze_batches_are_appended_once(spark, setting):
    source = setting[0]
    assert take(spark, source, "b1", "2024-01-01 10:00:00", order(1), order(2)).inserted == 2
    assert take(spark, source, "b1", "2024-01-01 11:00:00", order(1), order(2)).inserted == 0
    take(spark, source, "b2", "2024-01-02 10:00:00", order(1))
    rows = source.read().collect()
    assert len(rows) == 3 and len({r._id for r in rows}) == 3
    assert min(r._id for r in rows if r._batch_id == "b2") > max(r._id for r in rows if r._batch_id == "b1")


@pytest.mark.parametrize("kind", ["csv", "json", "parquet"])
def test_raw_files_stay_text(spark, tmp_path, kind):
    path = f"file://{tmp_path}/{kind}"
    frame = spark.createDataFrame([("007", " x ", None)], "order_id string, status string, currency string")
    full = frame.selectExpr("order_id", "'1' AS customer_id", "'d' AS order_date", "status", "'1.50' AS total_amount", "currency", "'t' AS created_at")
    writer = full.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.format(kind).save(path)
    got = read_raw(spark, path, "raw_orders", kind).first()
    assert (got.order_id, got.status, got.currency, got.total_amount) == ("007", " x ", None, "1.50")
    assert got._source_file.endswith(kind)


# -- streams


def stream_table(spark, path):
    stamps = [T.StructField("_ingested_at", T.TimestampType()), T.StructField("_id", T.LongType())]
    schema = T.StructType([*ORDERS.schema.fields, *stamps])
    everything = tuple(c for c in schema.names if c != "order_id")
    spec = ORDERS.like("orders", schema=schema, update_cols=everything, partition=bucketed(("order_id",), 4))
    return StoredTable(spark, path, spec)


@pytest.fixture
def stream(spark, tmp_path, customers):
    def start(name, files_per_trigger=1000):
        target = stream_table(spark, f"file://{tmp_path}/{name}/orders")
        return ChangeStream(
            spark, f"file://{tmp_path}/{name}/inbox", BRONZE["raw_orders"].schema,
            lambda rows: silver.project_orders(rows, customers), target, f"file://{tmp_path}/{name}/home",
            ["_ingested_at", "_id"], "_ingested_at", files_per_trigger=files_per_trigger,
        )

    return start


def batches(spark):
    return [
        bronze(spark, "raw_orders", [order(1, at=1), order(2, at=1), order(3, at=1, customer_id=uid(9, "c"))]),
        bronze(spark, "raw_orders", [order(1, at=2, status="shipped", _id=11), order(4, at=2, _id=12)]),
        bronze(spark, "raw_orders", [order(1, at=3, status="refunded", _id=21), order(2, at=3, order_date=None, _id=22)]),
    ]


def drop(feed, frame):
    frame.coalesce(1).write.mode("append").parquet(feed.source)


def test_stream_equals_batch_in_any_order(spark, stream, customers):
    frames = batches(spark)
    union = frames[0].unionByName(frames[1]).unionByName(frames[2])
    want = {r.order_id: r.status for r in silver.clean_orders(union, customers).collect()}
    for i, arrival in enumerate(itertools.islice(itertools.permutations(range(3)), 0, 6, 2)):
        feed = stream(f"order{i}")
        for n in arrival:
            drop(feed, frames[n])
            feed.run()
        assert statuses(feed.target) == want


def test_one_run_takes_all_files_in_several_micro_batches(spark, stream):
    feed = stream("micro", files_per_trigger=1)
    for frame in batches(spark):
        drop(feed, frame)
    assert len(feed.run()) == 1
    assert statuses(feed.target)[uid(1)] == "refunded"
    assert feed.pending() == []


def test_a_run_that_dies_before_applying_is_finished_by_the_next(spark, stream):
    feed = stream("crash")
    first, second, _ = batches(spark)
    drop(feed, first)
    feed.collect_changes()
    assert feed.target.read().isEmpty() and len(feed.pending()) == 1
    drop(feed, second)
    again = stream("crash")
    assert len(again.run()) == 2
    assert statuses(again.target) == {uid(1): "shipped", uid(2): "completed", uid(4): "completed"}


def test_applying_twice_changes_nothing(spark, stream):
    feed = stream("twice")
    drop(feed, batches(spark)[0])
    feed.collect_changes()
    (name,) = feed.pending()
    feed.apply(name)
    once = statuses(feed.target)
    feed.apply(name)
    assert statuses(feed.target) == once
    feed.run()
    assert statuses(feed.target) == once


def test_change_sets_collected_long_before_they_are_applied(spark, stream, customers):
    frames = batches(spark)
    feed = stream("delayed")
    for frame in frames:
        drop(feed, frame)
        feed.collect_changes()
    assert len(feed.pending()) == 3
    feed.run()
    union = frames[0].unionByName(frames[1]).unionByName(frames[2])
    assert statuses(feed.target) == {r.order_id: r.status for r in silver.clean_orders(union, customers).collect()}
    assert not feed.pending() and feed.drop_applied() == 3 and feed.run() == []


def test_a_change_set_that_lost_rows_is_refused(spark, stream):
    feed = stream("lossy")
    drop(feed, batches(spark)[0])
    feed.collect_changes()
    (name,) = feed.pending()
    feed._fs.mkdirs(feed._path(f"{feed.home}/counts/_change_set={name}/rows=99"))
    feed._fs.delete(feed._path(f"{feed.home}/counts/_change_set={name}/rows=2"), True)
    with pytest.raises(RuntimeError, match="2 of its 99 rows"):
        feed.run()
    assert feed.pending() == [name]
