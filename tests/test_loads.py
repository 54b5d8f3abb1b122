import datetime

import pytest
from pyspark.sql import functions as F
from samples import money

from smeltworks.operators import constraints, loads
from smeltworks.schemas import SALES, SALES_PARTITIONED, TableSpec, bucketed, columns, monthly
from smeltworks.sources import catalog, tables
from smeltworks.sources.tables import StoredTable

SPEC = TableSpec(
    "things",
    columns("""
id int
name string
n int
double_n int
at int
loaded timestamp
"""),
    keys=("id",),
    defaults={"loaded": "current_timestamp()"},
    generated={"double_n": "n * 2"},
    update_cols=("name", "n", "at", "loaded"),
    partition=bucketed(("id",), 4),
)


@pytest.fixture
def make(spark, tmp_path):
    def table(spec=SPEC):
        return StoredTable(spark, f"file://{tmp_path}/{spec.name}", spec)

    return table


def things(spark, records):
    return spark.createDataFrame(records, "id int, name string, n int, at int")


def files(table):
    """Names of the data files of every folder."""
    return {f: {s.getPath().getName() for s in table._fs.listStatus(p) if not s.getPath().getName().startswith(".")} for f, p in table._places().items()}


def changed(before, after):
    return {f for f in before | after if before.get(f) != after.get(f)}


def content(table):
    return sorted(tuple(r) for r in table.read().select("id", "name", "n", "double_n").collect())


def test_upsert_inserts_updates_and_overwrites_with_null(spark, make):
    table = make()
    assert table.read().isEmpty() and not table.exists()
    first = loads.upsert(table, things(spark, [(1, "a", 1, 1), (2, "b", 2, 1)]))
    assert (first.processed, first.inserted, first.updated) == (2, 2, 0)
    second = loads.upsert(table, things(spark, [(2, None, 5, 2), (3, "c", 3, 2)]))
    assert (second.processed, second.inserted, second.updated) == (2, 1, 1)
    assert content(table) == [(1, "a", 1, 2), (2, None, 5, 10), (3, "c", 3, 6)]


@pytest.mark.parametrize("partition", [bucketed(("id",), 4), {}])
def test_upsert_twice_is_upsert_once(spark, make, partition):
    table = make(SPEC.like("things", partition=partition))
    loads.upsert(table, things(spark, [(i, "a", i, 1) for i in range(20)]))
    change = things(spark, [(i, "b", i + 1, 2) for i in range(15, 25)])
    loads.upsert(table, change)
    once = content(table)
    again = loads.upsert(table, change)
    assert content(table) == once and (again.inserted, again.updated) == (0, 10)


def test_upsert_of_some_columns_keeps_the_rest(spark, make):
    table = make()
    loads.upsert(table, things(spark, [(1, "a", 1, 1)]))
    loads.upsert(table, things(spark, [(1, "z", 9, 2), (2, "b", 2, 2)]), update_cols=["n"])
    assert content(table) == [(1, "a", 9, 18), (2, "b", 2, 4)]


def test_upsert_touches_only_its_buckets(spark, make):
    table = make()
    loads.upsert(table, things(spark, [(i, "a", i, 1) for i in range(40)]))
    before = files(table)
    loads.upsert(table, things(spark, [(3, "b", 3, 2)]))
    after = files(table)
    assert len(changed(before, after)) == 1 and before.keys() == after.keys() and len(after) == 4


def test_two_source_rows_per_key_fail_and_change_nothing(spark, make):
    table = make()
    loads.upsert(table, things(spark, [(1, "a", 1, 1)]))
    before = files(table)
    with pytest.raises(Exception, match="more than one row for one key"):
        loads.upsert(table, things(spark, [(1, "b", 1, 1), (1, "c", 1, 1)]))
    assert files(table) == before and content(table) == [(1, "a", 1, 2)]


def test_older_row_does_not_overwrite_when_ordered(spark, make):
    table = make()
    loads.upsert(table, things(spark, [(1, "new", 1, 5)]), order_col="at")
    late = loads.upsert(table, things(spark, [(1, "late", 2, 4)]), order_col="at")
    assert content(table) == [(1, "new", 1, 2)] and late.updated == 0
    loads.upsert(table, things(spark, [(1, "late", 2, 4)]))
    assert content(table) == [(1, "late", 2, 4)]


def test_empty_source(spark, make):
    table = make()
    loads.upsert(table, things(spark, []))
    assert content(table) == []
    loads.upsert(table, things(spark, [(1, "a", 1, 1)]))
    loads.upsert(table, things(spark, []))
    assert content(table) == [(1, "a", 1, 2)]


def test_insert_new_ignores_known_keys(spark, make):
    table = make()
    loads.insert_new(table, things(spark, [(1, "a", 1, 1)]))
    before = files(table)
    got = loads.insert_new(table, things(spark, [(1, "z", 9, 2), (2, "b", 2, 2), (2, "b", 2, 2)]))
    assert (got.processed, got.inserted) == (3, 1) and all(names <= files(table)[f] for f, names in before.items())
    assert content(table) == [(1, "a", 1, 2), (2, "b", 2, 4)]
    assert loads.insert_new(table, things(spark, [(2, "y", 0, 3)])).inserted == 0


def test_replace_table_forgets_what_is_gone(spark, make):
    table = make()
    loads.replace_table(table, things(spark, [(1, "a", 1, 1), (2, "b", 2, 1)]))
    for _ in range(2):
        got = loads.replace_table(table, things(spark, [(2, "c", 3, 1)]))
        assert content(table) == [(2, "c", 3, 6)] and got.processed == 1
    loads.replace_table(table, things(spark, []))
    assert content(table) == []


def test_refresh_can_check_its_keys(spark, make):
    table = make()
    loads.replace_table(table, things(spark, [(1, "a", 1, 1)]), check_keys=True)
    with pytest.raises(constraints.ConstraintViolation, match="more than once"):
        loads.replace_table(table, things(spark, [(2, "a", 1, 1), (2, "b", 1, 1)]), check_keys=True)
    assert content(table) == [(1, "a", 1, 2)]


@pytest.mark.parametrize("load", [loads.upsert, loads.insert_new, loads.replace_table])
def test_every_load_keeps_the_row_rules(spark, make, load):
    table = make(SPEC.like("things", not_null=("id", "name"), checks={"n": "n >= 0"}))
    load(table, things(spark, [(1, "a", 1, 1)]))
    with pytest.raises(Exception, match="name is null"):
        load(table, things(spark, [(2, None, 1, 1)]))
    with pytest.raises(Exception, match="n breaks check"):
        load(table, things(spark, [(2, "b", -1, 1)]))
    assert content(table) == [(1, "a", 1, 2)]


@pytest.mark.parametrize("spec", [SPEC, SPEC.like("things", partition={})])
@pytest.mark.parametrize("load", [loads.replace_table, loads.upsert, loads.insert_new])
def test_a_load_that_fails_leaves_the_table_as_it_was(spark, make, spec, load):
    table = make(spec)
    loads.replace_table(table, things(spark, [(1, "a", 1, 1)]))
    before = files(table)
    broken = things(spark, [(2, "b", 1, 1)]).withColumn("n", F.raise_error(F.lit("boom")).cast("int"))
    with pytest.raises(Exception, match="boom"):
        load(table, broken)
    assert files(table) == before and content(table) == [(1, "a", 1, 2)]
    load(table, things(spark, [(3, "c", 1, 1)]))
    assert content(table)[-1] == (3, "c", 1, 2)


def test_a_refresh_may_read_its_own_table(spark, make):
    table = make()
    loads.replace_table(table, things(spark, [(i, "a", i, 1) for i in range(9)]))
    for left in (8, 7):
        loads.replace_table(table, table.read().where(F.col("id") < left))
        assert len(content(table)) == left
    leftover = [s.getPath().getName() for s in table._fs.listStatus(table._jvm_path(table.path).getParent())]
    assert leftover == [table.spec.name]


def test_a_large_folder_is_written_by_several_tasks(spark, make, monkeypatch):
    table = make(SPEC.like("things", partition={}))
    loads.upsert(table, things(spark, [(i, "a", i, 1) for i in range(1000)]))
    assert [len(names) for names in files(table).values()] == [1]
    monkeypatch.setattr(tables, "TASK_BYTES", 2000)
    # Else these few rows would be read as one partition again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = loads.upsert(table, things(spark, [(i, "b", i, 2) for i in range(500, 1500)]))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert (got.inserted, got.updated) == (500, 500) and len(content(table)) == 1500
    assert [len(names) > 1 for names in files(table).values()] == [True]


def test_groups_are_replaced_whole(spark, make):
    table = make(DAYS)
    start = [("2021-01-30", 1), ("2021-01-31", 2), ("2021-02-01", 3), ("2021-03-01", 4), (None, 5)]
    loads.replace_table(table, days(spark, start))
    before = files(table)
    groups = days(spark, [("2021-01-31", 0), ("2021-02-01", 0), (None, 0), ("2021-05-05", 0)]).select("d")
    for _ in range(2):
        loads.replace_groups(table, days(spark, [("2021-01-31", 9), ("2021-05-05", 6)]), groups)
        assert day_content(table) == [("2021-01-30", 1), ("2021-01-31", 9), ("2021-03-01", 4), ("2021-05-05", 6)]
    assert files(table)[("2021-03",)] == before[("2021-03",)] and ("2021-02",) not in files(table)
    other = make(DAYS.like("other", partition=bucketed(("n",), 3)))
    loads.replace_table(other, days(spark, start))
    loads.replace_groups(other, days(spark, [("2021-01-31", 9), ("2021-05-05", 6)]), groups)
    assert day_content(other) == day_content(table)


DAYS = TableSpec(
    "days",
    columns("""
d date
n int
"""),
    keys=("d",),
    partition={"_month": "date_format(d, 'yyyy-MM')"},
    ordered_by="d",
)


def days(spark, records):
    return spark.createDataFrame(records, "d string, n int").withColumn("d", F.col("d").cast("date"))


def day_content(table):
    return sorted((str(r.d), r.n) for r in table.read().collect())


@pytest.mark.parametrize("spec", [DAYS, DAYS.like("days", ordered_by=""), DAYS.like("days", partition={}, ordered_by="")])
def test_reload_of_a_day(spark, make, day, spec):
    table = make(spec)
    loads.replace_table(table, days(spark, [("2021-01-30", 1), ("2021-01-31", 2), ("2021-02-01", 3)]))
    for _ in range(2):
        loads.replace_partition(table, days(spark, [("2021-01-31", 9)]), "d", day("2021-01-31"))
        assert day_content(table) == [("2021-01-30", 1), ("2021-01-31", 9), ("2021-02-01", 3)]
    loads.replace_partition(table, days(spark, []), "d", day("2021-01-31"))
    assert day_content(table) == [("2021-01-30", 1), ("2021-02-01", 3)]
    loads.replace_partition(table, days(spark, []), "d", day("2021-02-01"))
    assert day_content(table) == [("2021-01-30", 1)]
    loads.replace_partition(table, days(spark, [("2021-05-05", 4)]), "d", day("2021-05-05"))
    assert day_content(table) == [("2021-01-30", 1), ("2021-05-05", 4)]


def test_reload_rewrites_only_the_months_it_touches(spark, make, day):
    table = make(DAYS)
    loads.replace_table(table, days(spark, [("2021-01-30", 1), ("2021-02-01", 3), ("2021-03-01", 3)]))
    before = files(table)
    loads.replace_partition(table, days(spark, [("2021-02-02", 9)]), "d", day("2021-02-02"))
    assert changed(before, files(table)) == {("2021-02",)}


def test_rows_outside_the_range_fail(spark, make, day):
    table = make(DAYS)
    loads.replace_table(table, days(spark, [("2021-01-30", 1)]))
    with pytest.raises(Exception, match="outside the range"):
        loads.replace_range(table, days(spark, [("2021-02-05", 1)]), "d", day("2021-01-01"), day("2021-02-05"))
    assert day_content(table) == [("2021-01-30", 1)]


def test_backfill_is_one_load_over_the_range(spark, make, day):
    table = make(DAYS)
    loads.replace_table(table, days(spark, [("2020-12-31", 1), ("2021-01-15", 1), ("2021-02-15", 1), ("2021-03-01", 1)]))
    calls = []

    def build(start, end):
        calls.append((start, end))
        return days(spark, [("2021-01-01", 5), ("2021-02-28", 6)])

    for _ in range(2):
        loads.backfill(table, build, "d", day("2021-01-01"), day("2021-03-01"))
        assert day_content(table) == [("2020-12-31", 1), ("2021-01-01", 5), ("2021-02-28", 6), ("2021-03-01", 1)]
    assert calls == [(datetime.date(2021, 1, 1), datetime.date(2021, 3, 1))] * 2


SALE = {
    "sale_id": 1, "order_id": "o", "customer_id": "c", "product_id": "p", "sale_date": "2024-01-15", "region": "EU",
    "channel": "web", "quantity": 2, "unit_price": "10.00", "discount_pct": "5",
}


def sales(spark, *changes):
    records = [{**SALE, "sale_id": i + 1, **c} for i, c in enumerate(changes)]
    ddl = ", ".join(f"{k} {'int' if isinstance(v, int) else 'string'}" for k, v in SALE.items())
    return spark.createDataFrame([tuple(r.values()) for r in records], ddl)


def test_sales_checks(spark, rows):
    frame = constraints.conform(
        sales(spark, {}, {"channel": "phone"}, {"quantity": 0}, {"unit_price": "-1"}, {"discount_pct": "101"}, {"region": None}, {"channel": None}),
        SALES,
    )
    assert [r.sale_id for r in constraints.enforce(frame, SALES, "quarantine").orderBy("sale_id").collect()] == [1, 7]
    reasons = {r.sale_id: r._errors for r in constraints.rejected(frame, SALES).collect()}
    assert reasons == {
        2: "channel breaks check", 3: "quantity breaks check", 4: "unit_price breaks check",
        5: "discount_pct breaks check", 6: "region is null",
    }
    with pytest.raises(Exception, match="constraint violation"):
        constraints.enforce(frame, SALES).collect()
    assert frame.where("sale_id = 1").first().line_total == money("19.00")


def test_sales_month_is_pruned(spark, make, day):
    table = make(SALES_PARTITIONED)
    loads.replace_table(table, sales(spark, {}, {"sale_date": "2024-02-01"}, {"sale_date": "2024-03-31"}))
    assert table.folders_between(day("2024-02-01"), day("2024-02-29")) == {("2024-02",)}
    plan = table.read({("2024-02",)})._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(concat_ws" in plan
    plan = table.read(helpers=True).where("_sale_month = '2024-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_sale_month" in plan
    assert SALES_PARTITIONED.schema == SALES.schema


def test_defaults_fill_absent_columns_only(spark):
    spec = TableSpec("t", columns("a int\nb string\nc timestamp"), defaults={"b": "'EUR'", "c": "current_timestamp()"})
    got = constraints.conform(spark.sql("SELECT 1 AS a"), spec).first()
    assert got.b == "EUR" and got.c is not None
    assert constraints.conform(spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b"), spec).first().b is None


UNIQUE = TableSpec("u", columns("id string\nemail string"), keys=("id",), unique=("email",))


def mails(spark, records):
    return spark.createDataFrame(records, "id string, email string")


def test_unique_within_a_batch_and_against_the_target(spark, rows):
    target = mails(spark, [("1", "a"), ("2", "b"), ("9", "x"), ("8", "x")])
    fine = mails(spark, [("1", "a"), ("3", "c")])
    assert rows(constraints.enforce_unique(fine, target, UNIQUE)) == rows(fine)
    batch = mails(spark, [("3", "a"), ("4", "d"), ("5", "d"), ("6", "e"), ("7", None), ("1", "z"), ("0", None)])
    with pytest.raises(constraints.ConstraintViolation, match="email is not unique"):
        constraints.enforce_unique(batch, target, UNIQUE)
    # 3 takes the mail that 1 gives up in the same batch: refused as well.
    kept = constraints.enforce_unique(batch, target, UNIQUE, "quarantine")
    assert rows(kept, "id") == [("0",), ("1",), ("6",), ("7",)]


def test_duplicate_keys(spark, rows):
    assert rows(constraints.duplicate_keys(mails(spark, [("1", "a"), ("1", "b"), ("2", "c")]), ["id"])) == [("1", 2)]


def test_quality_is_one_pass(spark, rows):
    frame = spark.createDataFrame([(1,), (-1,), (None,)], "x int")
    report = constraints.check_quality(frame, {"positive": "x > 0", "present": "x IS NOT NULL"})
    assert rows(report, "rule", "failing_rows", "checked_rows") == [("positive", 2, 3), ("present", 1, 3)]


def test_gate_on_empty_tables(spark):
    full, empty = spark.range(3), spark.range(0)
    constraints.require_non_empty({"full": full})
    with pytest.raises(constraints.ConstraintViolation, match="empty tables: none"):
        constraints.require_non_empty({"full": full, "none": empty})
    assert {r.table_name: r.row_count for r in constraints.table_counts({"full": full, "none": empty}).collect()} == {"full": 3, "none": 0}


def test_directory_values_that_need_escaping(spark, make, rows):
    spec = TableSpec(
        "odd",
        columns("""
id string
n int
"""),
        keys=("id",),
        update_cols=("n",),
        partition={"_part": "id"},
    )
    table = make(spec)
    data = [("2024-01-05T10:00:00", 1), ("a/b", 2), ("x=y", 3), ("50%", 4), ("it's", 5), ("plain", 6)]
    for extra in (0, 10):
        loads.upsert(table, spark.createDataFrame([(i, n + extra) for i, n in data], "id string, n int"))
    want = sorted((i, n + 10) for i, n in data)
    assert rows(table.read()) == want
    prefix = "escaped_"
    catalog.create_layers(spark, prefix, f"{table.path}_catalog")
    catalog.register(table, f"{prefix}gold.odd")
    assert rows(spark.sql(f"SELECT id, n FROM {prefix}gold.odd")) == want
    assert rows(spark.sql(f"SELECT n FROM {prefix}gold.odd WHERE _part = 'a/b'")) == [(12,)]


def test_catalog_follows_the_folders(spark, make):
    prefix, table = "grown_", make()
    flat = make(SPEC.like("flat", partition={}))
    catalog.create_layers(spark, prefix, f"{table.path}_catalog")
    for stored in (table, flat):
        name = f"{prefix}gold.{stored.spec.name}"
        for start in (0, 5, 9):
            loads.insert_new(stored, things(spark, [(i, "a", i, 1) for i in range(start, start + 6)]))
            catalog.register(stored, name)
            assert spark.table(name).count() == stored.read().count()
        loads.replace_table(stored, things(spark, [(1, "z", 1, 1)]))
        catalog.register(stored, name)
        assert [r.name for r in spark.table(name).collect()] == ["z"]
    elsewhere = make(SPEC.like("elsewhere"))
    loads.insert_new(elsewhere, things(spark, [(7, "e", 1, 1)]))
    catalog.register(elsewhere, f"{prefix}gold.things")
    assert [r.id for r in spark.table(f"{prefix}gold.things").collect()] == [7] and len(content(table)) == 1


def test_an_upsert_rewrites_the_months_it_touches(spark, make, rows, day):
    spec = TableSpec(
        "dated",
        columns("""
id int
d date
n int
"""),
        keys=("id",),
        update_cols=("n",),
        partition=monthly("d", ("id",), 2),
    )
    table = make(spec)

    def frame(*records):
        return spark.createDataFrame([(i, day(d), n) for i, d, n in records], "id int, d date, n int")

    loads.upsert(table, frame(*[(i, f"2021-{i % 12 + 1:02d}-10", 0) for i in range(48)]))
    before = files(table)
    # 5 is stored in June; its date in the batch is another one and is not taken. 99 is new in March.
    metrics = loads.upsert(table, frame((5, "2021-09-01", 7), (99, "2021-03-05", 8)))
    assert (metrics.inserted, metrics.updated) == (1, 1)
    assert {f[0] for f in changed(before, files(table))} == {"2021-06", "2021-03"}
    got = {r.id: (str(r.d), r.n) for r in table.read().collect()}
    assert len(got) == 49 and got[5] == ("2021-06-10", 7) and got[99] == ("2021-03-05", 8)
    loads.insert_new(table, frame((5, "2021-11-01", 1), (100, "2021-11-01", 1)))
    assert table.read().count() == 50
    with pytest.raises(ValueError, match="move rows"):
        loads.upsert(table, frame((1, "2021-01-01", 1)), update_cols=["d"])


# -- key lookups


def rows_scanned(df):
    """Rows that the file scans of an executed plan put out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = (plan.executedPlan() if "Adaptive" in plan.getClass().getName() else plan).collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_lookup_reads_only_files_that_can_hold_the_keys(spark, make):
    table = make()
    for batch in range(5):  # every file spans all ids, so only Bloom filters can tell files apart
        rows = spark.range(batch, 20_000, 5).selectExpr("cast(id AS int) AS id", "'x' AS name", "1 AS n", "1 AS at")
        assert loads.insert_new(table, rows).inserted == 4000
    assert sum(map(len, files(table).values())) == 20

    def wanted(ids):
        return spark.createDataFrame([(i,) for i in ids], "id int")

    assert rows_scanned(table.lookup(wanted([7]), ["id"])) < 2000
    assert rows_scanned(table.lookup(wanted(range(30_000, 30_400)), ["id"])) < 2000
    assert rows_scanned(table.lookup(wanted(range(tables.LOOKUP_KEYS + 1)), ["id"])) == 20_000
    assert rows_scanned(table.lookup(wanted([None]), ["id"])) == 0


def test_stored_rows_of_few_many_unknown_and_null_keys(spark, make, monkeypatch):
    table = make()
    loads.replace_table(table, things(spark, [(i, f"n{i}", i, 1) for i in range(30)]))
    wanted = spark.createDataFrame([(3,), (3,), (None,), (29,), (77,)], "id int")
    for limit in (tables.LOOKUP_KEYS, 1):
        monkeypatch.setattr(tables, "LOOKUP_KEYS", limit)
        assert sorted(r.id for r in loads.stored_rows(table, wanted).collect()) == [3, 29]
        assert loads.insert_new(table, things(spark, [(29, "z", 0, 1), (100 + limit, "z", 0, 1)])).inserted == 1
    assert loads.stored_rows(table, wanted.where("false")).isEmpty()
    assert loads.stored_rows(make(SPEC.like("nothing")), wanted).isEmpty()


def test_a_first_load_is_split_by_its_rows(spark, make, monkeypatch):
    table = make(SPEC.like("things", partition={}))
    monkeypatch.setattr(loads, "TASK_ROWS", 100)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        loads.upsert(table, things(spark, [(i, "a", i, 1) for i in range(1000)]))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [len(names) > 1 for names in files(table).values()] == [True] and len(content(table)) == 1000


def test_checked_rows_are_merged_only_with_stored_ones(spark, make, monkeypatch):
    table, merges, merge = make(SPEC), [], loads._merge
    monkeypatch.setattr(loads, "_merge", lambda *args: merges.append(args) or merge(*args))
    rows = things(spark, [(i, "a", i, 1) for i in range(20)]).selectExpr("*", "n * 2 AS double_n", "current_timestamp() AS loaded")
    first = loads.upsert(table, rows, checked=True)
    assert (first.processed, first.inserted, first.updated) == (20, 20, 0) and not merges
    again = loads.upsert(table, rows.withColumn("name", F.lit("b")), checked=True)
    assert (again.processed, again.inserted, again.updated) == (20, 0, 20) and len(merges) == 1
    assert content(table) == [(i, "b", i, 2 * i) for i in range(20)]
    # The merge still refuses a key that comes twice.
    with pytest.raises(Exception, match="more than one row for one key"):
        loads.upsert(table, rows.unionByName(rows), checked=True)


def test_a_batch_of_one_folder_is_not_sorted(spark, make):
    table = make(TableSpec("lone_batch", columns("_id bigint\nn int\n_batch_id string"), partition={"_batch_id": "_batch_id"}))
    rows = spark.range(5).selectExpr("cast(id AS int) AS n", "'b1' AS _batch_id")
    assert loads.append_batch(table, rows, "b1").inserted == 5 and table.folders() == {("b1",)}
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    plans = [p for p in (runs.apply(i).physicalPlanDescription() for i in range(runs.size())) if "lone_batch" in p and "WriteFiles" in p]
    assert plans and not any("Sort" in p for p in plans)


def test_intermediate_tables_and_shuffles_go_with_their_scope(spark):
    from smeltworks.sources.scratch import _SHUFFLES_GO, materialise, scratch_scope

    def there(df):
        place = spark._jvm.org.apache.hadoop.fs.Path(df.inputFiles()[0]).getParent()
        return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)

    with scratch_scope(spark):
        outer = materialise(spark.range(3))
        with scratch_scope(spark):
            inner = materialise(spark.range(3))
            assert there(inner) and spark.conf.get(_SHUFFLES_GO) == "true"
        assert there(outer) and not there(inner) and spark.conf.get(_SHUFFLES_GO) == "true"
    assert not there(outer) and spark.conf.get(_SHUFFLES_GO) == "false"
