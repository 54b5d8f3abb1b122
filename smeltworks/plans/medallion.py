"""The whole run, in order of dependency: gate, silver, quality, gold, run log."""

import datetime
import functools
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltworks.operators.constraints import (
    ConstraintViolation,
    check_quality,
    enforce_unique,
    require_non_empty,
    table_counts,
)
from smeltworks.operators.loads import LoadMetrics, insert_new, replace_table, upsert
from smeltworks.operators.skew import orphans
from smeltworks.plans import gold, silver
from smeltworks.plans.incremental import load_gold_increment, newest_load
from smeltworks.schemas import BRONZE, GOLD, ORDER_FACTS, REJECTS, SILVER, silver_spec
from smeltworks.sources import catalog
from smeltworks.sources.runs import EPOCH, RunLog
from smeltworks.sources.scratch import materialise, scratch_scope
from smeltworks.sources.tables import StoredTable
from smeltworks.streaming.watermark import incremental_load

# Facts of silver that gold relies on; every predicate must be true for every row.
QUALITY_RULES = {
    "customers": {"email is present": "trim(email) <> ''", "tier is known": "tier IN ('bronze', 'silver', 'gold', 'platinum')"},
    "products": {"price is not negative": "price >= 0", "name is present": "trim(product_name) <> ''"},
    "orders": {"amount is not negative": "total_amount >= 0", "date is present": "order_date IS NOT NULL"},
    "order_items": {"quantity is not negative": "quantity >= 0", "discount is a percentage": "discount BETWEEN 0 AND 100"},
}


# Parent tables of a silver table.
PARENTS = {"orders": ("customers",), "order_items": ("orders", "products")}


@dataclass(frozen=True)
class Warehouse:
    """The tables below one root."""

    spark: SparkSession
    root: str
    buckets: int = 16
    # Put before the layer names in the catalog, so that several warehouses can share one.
    prefix: str = ""

    def bronze(self, name: str) -> StoredTable:
        return StoredTable(self.spark, f"{self.root}/bronze/{name}", BRONZE[name])

    def silver(self, name: str) -> StoredTable:
        return StoredTable(self.spark, f"{self.root}/silver/{name}", silver_spec(name, self.buckets))

    def gold(self, name: str) -> StoredTable:
        return StoredTable(self.spark, f"{self.root}/gold/{name}", ORDER_FACTS if name == "order_facts" else GOLD[name])

    def rejects(self, name: str) -> StoredTable:
        return StoredTable(self.spark, f"{self.root}/silver/rejected_{name}", REJECTS)

    def waiting(self, name: str) -> StoredTable:
        """Bronze rows of earlier increments whose parent has not come yet."""
        spec = BRONZE[f"raw_{name}"].like(f"waiting_{name}", partition={})
        return StoredTable(self.spark, f"{self.root}/silver/waiting_{name}", spec)

    def log(self) -> RunLog:
        return RunLog(self.spark, f"{self.root}/bronze/pipeline_runs")


def _scoped(load):
    """A load of a warehouse that leaves nothing but its tables: what it has stored in between is deleted when it ends, not with the run."""

    @functools.wraps(load)
    def scoped(house: Warehouse, *args, **options):
        with scratch_scope(house.spark):
            return load(house, *args, **options)

    return scoped


def register(house: Warehouse) -> None:
    """Put every loaded table and the helper view into the session catalog under its layer name."""
    catalog.create_layers(house.spark, house.prefix, f"{house.root}/catalog")
    for layer, names in (("bronze", BRONZE), ("silver", SILVER), ("gold", GOLD)):
        for name in names:
            table = getattr(house, layer)(name)
            if table.exists():
                catalog.register(table, f"{house.prefix}{layer}.{name}")
    catalog.create_views(house.spark, house.prefix)


def validate_bronze(house: Warehouse) -> DataFrame:
    """Fail if a bronze table is empty; else the row count of each."""
    tables = {name: house.bronze(name).read() for name in BRONZE}
    require_non_empty(tables)
    return table_counts(tables)


def _cleaned(house: Warehouse, name: str, bronze: DataFrame, on_error: str) -> DataFrame:
    """Bronze rows as silver rows, checked against the silver tables as they are now."""
    rows = silver.CLEANERS[name](bronze, *_parents(house, name).values(), on_error)
    target = house.silver(name)
    if not target.spec.unique:
        return rows
    rows = materialise(rows, f"clean-{name}")
    return enforce_unique(rows, target.read() if target.exists() else None, target.spec, on_error)


def _parents(house: Warehouse, name: str) -> dict[str, DataFrame]:
    return {p: house.silver(p).read() for p in PARENTS.get(name, ())}


def _latest(house: Warehouse, name: str, bronze: DataFrame) -> DataFrame | None:
    """For a table with parents its ``latest_known`` rows, stored: both what is loaded and what waits come from them."""
    parents = _parents(house, name)
    return materialise(silver.latest_known(name, bronze, parents), f"latest-{name}") if parents else None


@_scoped
def load_silver(house: Warehouse, name: str, on_error: str = "fail") -> LoadMetrics:
    """Clean a whole bronze table and upsert it. Under ``quarantine`` the rejects table is rebuilt.

    Rows that lack a parent are parked and the mark is moved, so that an increment can follow.
    """
    bronze, started = house.bronze(f"raw_{name}").read(), datetime.datetime.now(datetime.timezone.utc)
    latest = _latest(house, name, bronze)
    top = bronze.agg(F.max("_ingested_at").cast("double").alias("seconds")).first().seconds
    rows = _cleaned(house, name, bronze, on_error) if latest is None else silver.clean_latest(name, latest, on_error)
    if on_error == "quarantine":
        replace_table(house.rejects(name), _rejected(house, name, bronze, rows))
    metrics = upsert(house.silver(name), rows, stored=latest is not None, checked=True)
    if latest is not None:
        replace_table(house.waiting(name), silver.waiting(latest))
    mark = EPOCH if top is None else EPOCH + datetime.timedelta(microseconds=round(top * 1_000_000))
    house.log().log_run(f"silver_{name}", "silver", "SUCCESS", metrics, started_at=started, watermark=mark)
    return metrics


@_scoped
def load_silver_increment(
    house: Warehouse, name: str, buffer: datetime.timedelta, on_error: str = "fail"
) -> LoadMetrics:
    """Clean and upsert only the bronze rows since the last run, and the rows of earlier runs that waited for a parent.

    A row that is refused for nothing but an unknown parent waits in a table of its own until the parent comes or a newer row
    of its key is taken. The waiting rows are switched after the upsert and before the mark moves: a run that
    breaks in between is repeated with the same result.
    """
    source, target, parked = house.bronze(f"raw_{name}"), house.silver(name), house.waiting(name)
    seen = []

    def transform(bronze: DataFrame) -> DataFrame:
        latest = _latest(house, name, bronze)
        if latest is not None:
            seen.append(latest)
        rows = _cleaned(house, name, bronze, on_error) if latest is None else silver.clean_latest(name, latest, on_error)
        if on_error == "quarantine":
            insert_new(house.rejects(name), _rejected(house, name, bronze, rows))
        return rows

    def park() -> None:
        for latest in seen:
            replace_table(parked, silver.waiting(latest))

    old = parked.read() if parked.exists() else None
    return incremental_load(source, house.log(), f"silver_{name}", transform, target, buffer, waiting=old, after=park, stored=name in PARENTS, checked=True)


def _rejected(house: Warehouse, name: str, bronze: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of ``bronze`` that are neither in ``kept`` nor superseded."""
    spec = house.silver(name).spec
    key = spec.keys[0]
    lost = silver.rejects(name, bronze, _parents(house, name)).withColumnRenamed(key, "rejected_key")
    if spec.unique:
        passed = silver.CLEANERS[name](bronze, "quarantine")
        contested = orphans(passed, kept, [key]).select(
            F.col(key).alias("rejected_key"),
            F.lit(None).cast("bigint").alias("_id"),
            F.col("_source_batch").alias("_batch_id"),
            F.lit(f"{', '.join(spec.unique)} is not unique").alias("_errors"),
        )
        lost = lost.unionByName(contested)
    return lost


def quality_report(house: Warehouse) -> DataFrame:
    """Rows per silver table and rule that break it."""
    report = None
    for name, rules in QUALITY_RULES.items():
        one = check_quality(house.silver(name).read(), rules).select(F.lit(name).alias("table_name"), "*")
        report = one if report is None else report.unionByName(one)
    for child, parent, key in (
        ("orders", "customers", "customer_id"),
        ("order_items", "orders", "order_id"),
        ("order_items", "products", "product_id"),
    ):
        # Counted by parent first: one row per parent is looked up, however many children it has.
        counted = house.silver(child).read().groupBy(key).agg(F.count("*").alias("_rows"))
        lost = orphans(counted, house.silver(parent).read(), [key], hot=False)
        one = lost.agg(
            F.lit(child).alias("table_name"),
            F.lit(f"{key} is known").alias("rule"),
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("failing_rows"),
            F.lit(None).cast("bigint").alias("checked_rows"),
        )
        report = report.unionByName(one)
    return report


@_scoped
def load_gold(house: Warehouse, as_of: datetime.date, **thresholds) -> dict[str, LoadMetrics]:
    """Rebuild the gold tables. The items are read once, for their facts; monthly follows daily, as it reads it."""
    customers, products, orders, items = (house.silver(n).read() for n in SILVER)
    done = {"order_facts": replace_table(house.gold("order_facts"), gold.order_facts(orders, items))}
    items = house.gold("order_facts").read()
    done["daily_revenue"] = replace_table(house.gold("daily_revenue"), gold.daily_revenue(orders, items))
    done["monthly_revenue"] = replace_table(
        house.gold("monthly_revenue"), gold.monthly_revenue(house.gold("daily_revenue").read())
    )
    done["customer_ltv"] = replace_table(
        house.gold("customer_ltv"), gold.customer_ltv(customers, orders, items, as_of, **thresholds)
    )
    done["product_performance"] = replace_table(
        house.gold("product_performance"), gold.product_performance(products, items, orders)
    )
    done["category_revenue"] = replace_table(
        house.gold("category_revenue"), gold.category_revenue(products, items, orders)
    )
    return done


def _run_layers(house: Warehouse, as_of, on_error: str, since: datetime.timedelta | None, **thresholds) -> dict[str, LoadMetrics]:
    validate_bronze(house)
    if since is None:
        done = {name: load_silver(house, name, on_error) for name in SILVER}
    else:
        done = {name: load_silver_increment(house, name, since, on_error) for name in SILVER}
    broken = quality_report(house).where("failing_rows > 0").select("table_name", "rule").collect()
    if broken:
        raise ConstraintViolation("; ".join(f"{r.table_name}: {r.rule}" for r in broken))
    done.update(bring_gold(house, as_of, since, **thresholds))
    return done


def _facts_complete(house: Warehouse) -> bool:
    """Whether the stored facts have all columns that gold is made from; an older version wrote them without ``earns``."""
    facts = house.gold("order_facts")
    return not facts.folders() or set(facts.spec.schema.names) <= set(house.spark.read.parquet(facts.path).columns)


def bring_gold(house: Warehouse, as_of: datetime.date, since: datetime.timedelta | None, **thresholds) -> dict[str, LoadMetrics]:
    """Gold from silver: rebuilt, or, with ``since`` and once it has been built, only where newly loaded rows touch it.

    The mark in the run log is the time of the newest silver row that gold has seen. ``since`` is taken off it, for drivers whose
    clocks differ; rows that are seen twice change nothing.
    """
    log, started = house.log(), datetime.datetime.now(datetime.timezone.utc)
    reached = newest_load(*(house.silver(n).read() for n in SILVER))
    mark = log.last_watermark("gold")
    if since is None or mark == EPOCH or not _facts_complete(house):
        done = load_gold(house, as_of, **thresholds)
    else:
        done = load_gold_increment(house, mark - since, as_of, **thresholds)
    log.log_run("gold", "gold", "SUCCESS", LoadMetrics(), started_at=started, watermark=reached)
    return done


def run_medallion(
    house: Warehouse,
    as_of: datetime.date,
    on_error: str = "fail",
    since: datetime.timedelta | None = None,
    **thresholds,
) -> dict[str, LoadMetrics]:
    """One run over all of bronze, or with ``since`` (the buffer for late rows) over what is new since the last
    such run. Running it again on the same bronze leaves the same tables.

    A run that fails is logged as FAILED; a load that fails leaves its table as it was, and the next run repeats it. Intermediate
    tables are deleted when the run ends.
    """
    log, started = house.log(), datetime.datetime.now(datetime.timezone.utc)
    run_id = log.log_run("medallion", "all", "RUNNING", started_at=started)
    try:
        with scratch_scope(house.spark):
            done = _run_layers(house, as_of, on_error, since, **thresholds)
    except Exception as error:
        log.log_run("medallion", "all", "FAILED", run_id=run_id, started_at=started, error=str(error))
        raise
    total = LoadMetrics(
        *(sum(getattr(m, f) for m in done.values()) for f in ("processed", "inserted", "updated"))
    )
    counts = {name: m.processed for name, m in done.items()}
    log.log_run("medallion", "all", "SUCCESS", total, run_id=run_id, started_at=started, metadata=counts)
    return done
