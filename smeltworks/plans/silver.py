"""Bronze to silver: filter, keep the latest row per key, keep known parents, type and normalise."""

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltworks.functions import canonical_uuid, is_present, is_uuid, safe_decimal, safe_int
from smeltworks.operators.constraints import add_absent, reasons, row_errors, split_errors
from smeltworks.operators.dedup import latest_by
from smeltworks.operators.skew import hot_keys, join_unique
from smeltworks.schemas import CUSTOMERS, ORDER_ITEMS, ORDERS, PRODUCTS, TableSpec

NEWEST_FIRST = ["_ingested_at", "_id"]


@dataclass(frozen=True)
class Rule:
    """How one silver table comes from its bronze table."""

    spec: TableSpec
    # Key and parent ids; the key is first.
    ids: tuple[str, ...]
    # Rows that fail one of these never compete for "latest": a broken newer row must not hide a good one.
    required: Mapping[str, Column]
    # Typed columns from text.
    columns: Mapping[str, Column]
    # Casts without a fallback value: text that does not parse is an error.
    casts: Mapping[str, str] = field(default_factory=dict)
    # Parent table by id column.
    parents: Mapping[str, str] = field(default_factory=dict)


def _rules() -> dict[str, Rule]:
    return {
        "customers": Rule(
            CUSTOMERS,
            ids=("customer_id",),
            required={"email is blank": is_present("email")},
            columns={
                "first_name": F.trim("first_name"),
                "last_name": F.trim("last_name"),
                "email": F.lower(F.trim("email")),
                "country": F.upper(F.trim("country")),
                "tier": F.lower(F.trim("tier")),
            },
            casts={"signup_date": "date"},
        ),
        "products": Rule(
            PRODUCTS,
            ids=("product_id",),
            required={"product_name is null": F.col("product_name").isNotNull()},
            columns={
                "product_name": F.trim("product_name"),
                "category": F.coalesce(F.trim("category"), F.lit("Unknown")),
                "price": safe_decimal("price", 10, 2),
                "cost": safe_decimal("cost", 10, 2),
                "stock_qty": safe_int("stock_qty"),
            },
        ),
        "orders": Rule(
            ORDERS,
            ids=("order_id", "customer_id"),
            required={"order_date is null": F.col("order_date").isNotNull()},
            columns={
                "status": F.lower(F.trim("status")),
                "total_amount": safe_decimal("total_amount", 12, 2),
                "currency": F.coalesce(F.upper(F.trim("currency")), F.lit("USD")),
            },
            casts={"order_date": "date", "created_at": "timestamp"},
            parents={"customer_id": "customers"},
        ),
        "order_items": Rule(
            ORDER_ITEMS,
            ids=("order_item_id", "order_id", "product_id"),
            required={},
            columns={
                "quantity": safe_int("quantity", default=1),
                "unit_price": safe_decimal("unit_price", 10, 2),
                # Capped before the narrow cast: 1500 is 100, not an overflow.
                "discount": F.least(safe_decimal("discount", 38, 2), F.lit(100)).cast("decimal(5,2)"),
            },
            parents={"order_id": "orders", "product_id": "products"},
        ),
    }


def _eligible(bronze: DataFrame, rule: Rule) -> DataFrame:
    """Rows that pass the filter, with ids in canonical form."""
    # The pattern is matched once per id, in the filter: canonical ids that are tested after they are made cost it twice.
    rows = bronze
    for c in rule.ids:
        rows = rows.where(is_uuid(c))
    for condition in rule.required.values():
        rows = rows.where(condition)
    return rows.withColumns({c: F.lower(c) for c in rule.ids})


def _latest(bronze: DataFrame, rule: Rule) -> DataFrame:
    return latest_by(_eligible(bronze, rule), [rule.ids[0]], NEWEST_FIRST)


def hot_parents(bronze: DataFrame, c: str) -> DataFrame:
    """Hot values of a parent id; the raw column shows them without running the deduplication."""
    return hot_keys(bronze.select(canonical_uuid(c).alias(c)), [c])


def _typed(rows: DataFrame, rule: Rule, keep: tuple[str, ...] = tuple(NEWEST_FIRST)) -> DataFrame:
    """Typed columns plus ``_errors``: unparsable dates and broken row constraints; of other columns those in ``keep``."""
    unparsed = {
        f"_bad_{c}": F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(f"{c} is not a {t}"))
        for c, t in rule.casts.items()
    }
    carried = [c for c in keep if c in rows.columns]
    typed = rows.select(
        *rule.ids,
        *[F.col(c).try_cast(t).alias(c) for c, t in rule.casts.items()],
        *[expression.alias(name) for name, expression in rule.columns.items()],
        F.col("_batch_id").alias("_source_batch"),
        *carried,
        *[text.alias(name) for name, text in unparsed.items()],
    )
    types = {c: rule.spec.schema[c].dataType for c in rule.spec.generated}
    wide = {c: F.expr(e) for c, e in rule.spec.generated.items()}
    typed = add_absent(typed, rule.spec).withColumns({c: e.try_cast(types[c]) for c, e in wide.items()})
    # The test that seldom holds comes first: the expression is then not made a second time.
    oversize = [F.when(F.col(c).isNull() & e.isNotNull(), F.lit(f"{c} does not fit")) for c, e in wide.items()]
    broken = F.nullif(row_errors(rule.spec), F.lit(""))
    return typed.withColumn("_errors", reasons(*map(F.col, unparsed), broken, *oversize)).drop(*unparsed)


def _clean(
    name: str,
    bronze: DataFrame,
    parents: Mapping[str, DataFrame],
    on_error: str,
    hot: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    rule = _rules()[name]
    rows = _latest(bronze, rule)
    # The parent named first comes last: what is joined to it afterwards finds the rows dealt by its id.
    for c, parent in reversed(rule.parents.items()):
        split = hot_parents(bronze, c) if hot is None else hot.get(c, False)
        rows = join_unique(rows, parents[parent].select(c), [c], "left_semi", hot=split)
    return _as_declared(_typed(rows, rule), rule, on_error)


def _as_declared(typed: DataFrame, rule: Rule, on_error: str) -> DataFrame:
    good = split_errors(typed, rule.ids[0], on_error)
    return good.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in rule.spec.schema])


def clean_customers(bronze: DataFrame, on_error: str = "fail") -> DataFrame:
    """Customers with a valid id and an email; text trimmed, email and tier lower, country upper case."""
    return _clean("customers", bronze, {}, on_error)


def clean_products(bronze: DataFrame, on_error: str = "fail") -> DataFrame:
    """Products with a valid id and a name; unusable numbers become 0, no category becomes ``Unknown``."""
    return _clean("products", bronze, {}, on_error)


def clean_orders(
    bronze: DataFrame,
    customers: DataFrame,
    on_error: str = "fail",
    hot: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Orders of known customers; an unusable amount becomes 0, no currency becomes USD.

    ``hot`` overrides which parent ids are split, per id column.
    """
    return _clean("orders", bronze, {"customers": customers}, on_error, hot)


def clean_order_items(
    bronze: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    on_error: str = "fail",
    hot: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Items of known orders and products; quantity defaults to 1, discount is capped at 100."""
    return _clean("order_items", bronze, {"orders": orders, "products": products}, on_error, hot)


def latest_known(name: str, bronze: DataFrame, parents: Mapping[str, DataFrame]) -> DataFrame:
    """The latest row of each key, typed, and as ``_known`` whether all its parents are there; without them also as ``_raw``, the bronze
    row with ids in canonical form. Stored, it gives both ``clean_latest`` and ``waiting``, so that the rows are sorted, joined and typed
    once, however often they are read."""
    rule = _rules()[name]
    latest, known = _latest(bronze, rule), F.lit(True)
    for c, parent in rule.parents.items():
        mark = parents[parent].select(c, F.lit(True).alias(f"_known_{c}"))
        latest = join_unique(latest, mark, [c], "left", hot=hot_parents(bronze, c))
        known = known & F.col(f"_known_{c}").isNotNull()
    raw = F.when(~known, F.struct(*bronze.columns))
    return _typed(latest.withColumns({"_known": known, "_raw": raw}), rule, keep=("_known", "_raw"))


def clean_latest(name: str, latest: DataFrame, on_error: str = "fail") -> DataFrame:
    """What the cleaner of the table gives, from ``latest_known`` rows."""
    return _as_declared(latest.where("_known").drop("_known", "_raw"), _rules()[name], on_error)


def waiting(latest: DataFrame) -> DataFrame:
    """Of ``latest_known`` rows those that only lack a parent: refused by nothing but an unknown parent id."""
    return latest.where("NOT _known").select("_raw.*")


def project_orders(bronze: DataFrame, customers: DataFrame, on_error: str = "fail") -> DataFrame:
    """``clean_orders`` without keeping the latest row, so that it runs row by row on a stream.

    Keeps ``_ingested_at`` and ``_id`` for the deduplication that follows. ``customers`` is a static side.
    """
    rule = _rules()["orders"]
    known = _eligible(bronze, rule).join(customers.select("customer_id"), "customer_id", "left_semi")
    good = split_errors(_typed(known, rule), rule.ids[0], on_error)
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in rule.spec.schema]
    return good.select(*typed, *NEWEST_FIRST)


CLEANERS: dict[str, Callable[..., DataFrame]] = {
    "customers": clean_customers,
    "products": clean_products,
    "orders": clean_orders,
    "order_items": clean_order_items,
}


def rejects(name: str, bronze: DataFrame, parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Bronze rows that do not reach silver, with every reason; superseded rows are not rejects.

    Columns: the key as delivered, ``_id``, ``_batch_id``, ``_errors`` (reasons joined by ``; ``).
    """
    rule = _rules()[name]
    key = rule.ids[0]
    failed = [F.when(canonical_uuid(c).isNull(), F.lit(f"{c} is not a canonical id")) for c in rule.ids]
    failed += [F.when(~F.coalesce(ok, F.lit(False)), F.lit(text)) for text, ok in rule.required.items()]
    report = [key, "_id", "_batch_id", "_errors"]
    filtered = bronze.withColumn("_errors", reasons(*failed)).where("_errors <> ''").select(*report)
    latest = _latest(bronze, rule)
    unknown = []
    for c, parent in rule.parents.items():
        known = parents[parent].select(c, F.lit(True).alias(f"_known_{c}"))
        latest = join_unique(latest, known, [c], "left", hot=hot_parents(bronze, c))
        unknown.append(F.when(F.col(f"_known_{c}").isNull(), F.lit(f"{c} is unknown")))
    if unknown:
        orphaned = latest.withColumn("_errors", reasons(*unknown)).where("_errors <> ''").select(*report)
        filtered = filtered.unionByName(orphaned)
        for c in rule.parents:
            latest = latest.where(F.col(f"_known_{c}"))
    broken = (
        _typed(latest, rule)
        .where("_errors <> ''")
        .select(key, "_id", F.col("_source_batch").alias("_batch_id"), "_errors")
    )
    return filtered.unionByName(broken)


def flag_high_value(orders: DataFrame, above: int = 500) -> DataFrame:
    """Orders with ``is_high_value``."""
    return orders.withColumn("is_high_value", F.col("total_amount") > above)
