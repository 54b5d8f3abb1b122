import datetime

import pytest
from pyspark.sql import functions as F

from smeltworks.operators import capture
from smeltworks.operators.capture import apply_changes, live, load_delivery, purge, snapshot_changes, tracked
from smeltworks.schemas import TableSpec, bucketed, columns, monthly
from smeltworks.sources.runs import RunLog
from smeltworks.sources.tables import StoredTable

SPEC = TableSpec(
    "people",
    columns("""
id int
name string
n int
twice int
"""),
    keys=("id",),
    not_null=("id", "name"),
    checks={"n": "n >= 0"},
    generated={"twice": "n * 2"},
    partition=bucketed(("id",), 4),
)


def at(hour):
    return datetime.datetime(2024, 1, 1, hour, tzinfo=datetime.timezone.utc)


def people(spark, *records):
    return spark.createDataFrame(list(records), "id int, name string, n int")


def log_of(spark, *records):
    rows = [(i, name, n, op, at(hour)) for i, name, n, op, hour in records]
    return spark.createDataFrame(rows, "id int, name string, n int, _op string, _changed_at timestamp")


def shown(table):
    return sorted((r.id, r.name, r.n, r.twice) for r in live(table).collect())


@pytest.fixture
def table(spark, tmp_path):
    return StoredTable(spark, f"file://{tmp_path}/people", tracked(SPEC))


@pytest.fixture
def runs(spark, tmp_path):
    return RunLog(spark, f"file://{tmp_path}/runs")


def test_differences_of_two_snapshots(spark, rows):
    before = people(spark, (1, "a", 1), (2, "b", 2), (3, None, 3), (4, "d", None), (6, "", None))
    after = people(spark, (1, "a", 1), (2, "b", 9), (3, "c", 3), (5, "e", 5), (6, None, None))
    want = [(2, "b", 9, "update"), (3, "c", 3, "update"), (4, None, None, "delete"), (5, "e", 5, "insert"), (6, None, None, "update")]
    assert rows(snapshot_changes(before, after, ["id"]), "id", "name", "n", "_op") == want
    assert snapshot_changes(after, after, ["id"]).isEmpty()
    assert snapshot_changes(before.where("false"), after, ["id"]).where("_op = 'insert'").count() == 5
    # The order of columns of the older side does not matter, further columns of it neither.
    assert snapshot_changes(after.select("n", F.lit(1).alias("x"), "name", "id"), after, ["id"]).isEmpty()


def test_nulls_that_change_places_are_a_difference(spark):
    one = spark.createDataFrame([(1, None, "x")], "id int, a string, b string")
    two = spark.createDataFrame([(1, "x", None)], "id int, a string, b string")
    assert [r._op for r in snapshot_changes(one, two, ["id"]).collect()] == ["update"]


@pytest.mark.parametrize("side", [0, 1])
def test_a_snapshot_with_double_keys_is_refused(spark, side):
    sides = [people(spark, (1, "a", 1)), people(spark, (1, "a", 1))]
    sides[side] = people(spark, (1, "a", 1), (1, "a", 1))
    with pytest.raises(Exception, match="more than one row for one key"):
        snapshot_changes(*sides, ["id"]).collect()


def test_deliveries_delete_what_they_lack(spark, table, runs):
    first = people(spark, (1, "a", 1), (2, "b", 2), (3, "c", 3))
    assert load_delivery(table, first, at(1), runs).inserted == 3
    second = people(spark, (1, "a", 1), (3, "z", 3), (4, "d", 4))
    got = load_delivery(table, second, at(2), runs)
    assert (got.processed, got.inserted, got.updated) == (3, 1, 2)
    want = [(1, "a", 1, 2), (3, "z", 3, 6), (4, "d", 4, 8)]
    assert shown(table) == want
    # Again, and late: nothing.
    assert load_delivery(table, second, at(2), runs).processed == 0 and shown(table) == want
    assert load_delivery(table, first, at(1), runs).processed == 0 and shown(table) == want
    # What was deleted may come back, an empty delivery deletes all.
    load_delivery(table, first, at(3), runs)
    assert shown(table) == [(1, "a", 1, 2), (2, "b", 2, 4), (3, "c", 3, 6)]
    load_delivery(table, first.where("false"), at(4), runs)
    assert shown(table) == [] and table.read().count() == 4
    # Tombstones hold no data.
    assert table.read().where("name IS NOT NULL OR n IS NOT NULL").isEmpty()


def test_changes_come_in_any_order(spark, table):
    history = [
        (1, "a", 1, "insert", 1), (1, None, None, "delete", 3), (1, "b", 2, "update", 2),
        (2, "x", 1, "insert", 1), (2, None, None, "delete", 2), (2, "y", 5, "insert", 4),
        (3, None, None, "delete", 5), (3, "late", 1, "insert", 4),
        (4, "p", 1, "update", 6), (4, "q", 1, "update", 6), (5, "r", 1, "update", 6), (5, None, None, "delete", 6),
    ]
    want = [(2, "y", 5, 10), (4, "q", 1, 2)]
    apply_changes(table, log_of(spark, *history))
    assert shown(table) == want
    apply_changes(table, log_of(spark, *history))
    for one in reversed(history[:6]):
        apply_changes(table, log_of(spark, one))
        assert shown(table) == want
    # An older delete does not remove a newer row, an older row does not wake a newer tombstone.
    apply_changes(table, log_of(spark, (2, None, None, "delete", 3), (1, "w", 1, "update", 2)))
    assert shown(table) == want


def test_row_rules_hold_for_live_rows_only(spark, table):
    with pytest.raises(Exception, match="n breaks check"):
        apply_changes(table, log_of(spark, (1, "a", -1, "insert", 1)))
    with pytest.raises(Exception, match="name present breaks check"):
        apply_changes(table, log_of(spark, (1, None, 1, "insert", 1)))
    apply_changes(table, log_of(spark, (1, None, -1, "delete", 1)))
    assert shown(table) == [] and table.read().count() == 1


def test_purge_rewrites_only_folders_with_old_tombstones(spark, table):
    apply_changes(table, log_of(spark, *[(i, "a", i, "insert", 1) for i in range(20)]))
    apply_changes(table, log_of(spark, (3, None, None, "delete", 2), (4, None, None, "delete", 8)))
    files = {f: sorted(s.getPath().getName() for s in table._fs.listStatus(p)) for f, p in table._places().items()}
    assert purge(table, at(1)) == 0 and purge(table, at(5)) == 1 and purge(table, at(5)) == 0
    after = {f: sorted(s.getPath().getName() for s in table._fs.listStatus(p)) for f, p in table._places().items()}
    assert sum(files[f] != after[f] for f in files) == 1
    assert len(shown(table)) == 18 and table.read().where("_deleted").count() == 1
    apply_changes(table, log_of(spark, *[(i, None, None, "delete", 9) for i in range(20)]))
    assert purge(table, at(10)) == 20 and table.read().isEmpty() and table.folders() == set()
    apply_changes(table, log_of(spark, (1, "new", 1, "insert", 11)))
    assert shown(table) == [(1, "new", 1, 2)]


def test_a_delete_finds_its_row_in_a_dated_folder(spark, tmp_path, day):
    spec = TableSpec("dated", columns("id int\nd date\nn int"), keys=("id",), partition=monthly("d", ("id",), 1))
    table = StoredTable(spark, f"file://{tmp_path}/dated", tracked(spec))
    rows = [(1, day("2024-01-05"), 1, "insert", at(1)), (2, day("2024-02-05"), 2, "insert", at(1))]
    kinds = "id int, d date, n int, _op string, _changed_at timestamp"
    apply_changes(table, spark.createDataFrame(rows, kinds))
    apply_changes(table, spark.createDataFrame([(1, None, None, capture.DELETE, at(2))], kinds))
    assert [(r.id, r.n) for r in live(table).collect()] == [(2, 2)] and table.read().count() == 2
