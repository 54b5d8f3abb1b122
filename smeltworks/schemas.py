"""Declared tables of the three layers: columns, keys, checks, defaults, generated columns, layout."""

import re
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

# Money in gold: wide enough for sums over any number of orders.
GOLD_MONEY = "decimal(28,2)"


def columns(text: str) -> T.StructType:
    """A schema from ``name type`` lines."""
    schema = T.StructType()
    for line in filter(None, text.splitlines()):
        name, kind = line.split(maxsplit=1)
        kind = kind.strip()
        schema.add(name, {"bigint": "long", "int": "integer"}.get(kind, kind))
    return schema


@dataclass(frozen=True)
class TableSpec:
    """What a table's DDL would say. Expressions are Spark SQL over the table's own columns; generated ones are
    cast to the declared type."""

    name: str
    schema: T.StructType
    keys: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    checks: Mapping[str, str] = field(default_factory=dict)
    defaults: Mapping[str, str] = field(default_factory=dict)
    generated: Mapping[str, str] = field(default_factory=dict)
    references: Mapping[str, str] = field(default_factory=dict)
    update_cols: tuple[str, ...] = ()
    # Folder columns, outermost first, with the expression that fills them.
    partition: Mapping[str, str] = field(default_factory=dict)
    # Column in which the text of the one folder column never decreases: range loads prune by it.
    ordered_by: str = ""

    def layout(self) -> Mapping[str, str]:
        """The folder columns; a table without any is one folder, so that it too is replaced when a job has succeeded."""
        return self.partition or {"_all": "0"}

    def laid_out_by(self) -> set[str]:
        """Columns that the folder columns are made from."""
        words = {w for e in self.partition.values() for w in re.findall(r"\w+", e)}
        return words & set(self.schema.names)

    def like(self, name: str, **changes) -> "TableSpec":
        """The same declaration under another name."""
        return replace(self, name=name, **changes)


def bucketed(keys: tuple[str, ...], buckets: int) -> dict[str, str]:
    """Folder layout for upserts: a hash of the key, so that a load rewrites only the buckets it touches."""
    return {"_bucket": f"cast(pmod(xxhash64({', '.join(keys)}), {buckets}) as int)"}


def monthly(date: str, keys: tuple[str, ...], buckets: int) -> dict[str, str]:
    """Folder layout for upserts of dated rows whose date no upsert changes: the month, then a hash of the key if a month
    is to have several folders. A load rewrites only the months, and in them the buckets, that it touches."""
    month = {"_month": f"coalesce(date_format({date}, 'yyyy-MM'), 'none')"}
    return month if buckets == 1 else {**month, **bucketed(keys, buckets)}


INGEST_COLUMNS = """
_id bigint
_ingested_at timestamp
_source_file string
_batch_id string
"""


def _bronze(name: str, business: str) -> TableSpec:
    raw = "\n".join(f"{c} string" for c in business.split())
    return TableSpec(
        name,
        columns(INGEST_COLUMNS + raw),
        not_null=("_ingested_at",),
        # By day first, so that an incremental read prunes folders.
        partition={"_ingest_date": "cast(_ingested_at as date)", "_batch_id": "_batch_id"},
    )


BRONZE = {
    spec.name: spec
    for spec in (
        _bronze("raw_customers", "customer_id first_name last_name email country signup_date tier"),
        _bronze("raw_products", "product_id product_name category price cost stock_qty"),
        _bronze("raw_orders", "order_id customer_id order_date status total_amount currency created_at"),
        _bronze("raw_order_items", "order_item_id order_id product_id quantity unit_price discount"),
    )
}


def raw_columns(spec: TableSpec) -> list[str]:
    """The business columns of a bronze table."""
    return [c for c in spec.schema.names if not c.startswith("_")]


PIPELINE_RUNS = TableSpec(
    "pipeline_runs",
    columns("""
run_id string
pipeline_name string
layer string
status string
rows_processed bigint
rows_inserted bigint
rows_updated bigint
started_at timestamp
finished_at timestamp
watermark timestamp
error_message string
metadata string
"""),
    keys=("run_id",),
    not_null=("run_id", "pipeline_name", "layer", "status", "started_at"),
    checks={"status": "status IN ('RUNNING', 'SUCCESS', 'FAILED')"},
)

_LOADED = """
_source_batch string
_silver_loaded_at timestamp
"""

CUSTOMERS = TableSpec(
    "customers",
    columns("""
customer_id string
first_name string
last_name string
email string
country string
signup_date date
tier string
full_name string
""" + _LOADED),
    keys=("customer_id",),
    not_null=("customer_id", "first_name", "last_name", "email"),
    unique=("email",),
    checks={"tier": "tier IN ('bronze', 'silver', 'gold', 'platinum')"},
    defaults={"_silver_loaded_at": "current_timestamp()"},
    # NULL if either name is NULL, unlike concat_ws.
    generated={"full_name": "concat(first_name, ' ', last_name)"},
    update_cols=(
        "first_name", "last_name", "email", "country", "signup_date", "tier", "_source_batch", "_silver_loaded_at",
    ),
)

PRODUCTS = TableSpec(
    "products",
    columns("""
product_id string
product_name string
category string
price decimal(10,2)
cost decimal(10,2)
margin_pct decimal(5,2)
stock_qty int
""" + _LOADED),
    keys=("product_id",),
    not_null=("product_id", "product_name", "price"),
    defaults={"_silver_loaded_at": "current_timestamp()"},
    generated={"margin_pct": "CASE WHEN price > 0 THEN round((price - cost) / price * 100, 2) END"},
    update_cols=(
        "product_name", "category", "price", "cost", "stock_qty", "_source_batch", "_silver_loaded_at",
    ),
)

ORDERS = TableSpec(
    "orders",
    columns("""
order_id string
customer_id string
order_date date
status string
total_amount decimal(12,2)
currency string
created_at timestamp
""" + _LOADED + "_is_valid boolean"),
    keys=("order_id",),
    not_null=("order_id", "customer_id", "order_date", "status", "total_amount", "currency"),
    checks={"currency": "length(currency) <= 3"},
    # The table's own default currency is EUR; the loader always supplies one and fills gaps with USD.
    defaults={"currency": "'EUR'", "_silver_loaded_at": "current_timestamp()", "_is_valid": "true"},
    # The customer and the dates of a known order never change.
    update_cols=("status", "total_amount", "currency", "_source_batch", "_silver_loaded_at"),
)

ORDER_ITEMS = TableSpec(
    "order_items",
    columns("""
order_item_id string
order_id string
product_id string
quantity int
unit_price decimal(10,2)
discount decimal(5,2)
line_total decimal(12,2)
""" + _LOADED),
    keys=("order_item_id",),
    not_null=("order_item_id", "order_id", "product_id", "quantity", "unit_price"),
    defaults={"discount": "0", "_silver_loaded_at": "current_timestamp()"},
    # Rounded per row by the declared type, before any sum.
    generated={"line_total": "quantity * unit_price * (1 - discount / 100)"},
    references={"order_id": "orders", "product_id": "products"},
    update_cols=("quantity", "unit_price", "discount", "_source_batch", "_silver_loaded_at"),
)

SILVER = {spec.name: spec for spec in (CUSTOMERS, PRODUCTS, ORDERS, ORDER_ITEMS)}


# Bronze rows that did not reach silver, with the reasons.
REJECTS = TableSpec(
    "rejects",
    columns("""
reject_id string
rejected_key string
_id bigint
_batch_id string
_errors string
"""),
    keys=("reject_id",),
    # Rows are told apart by their bronze number, rows of a contested value by their key.
    generated={"reject_id": "concat_ws(':', _batch_id, coalesce(cast(_id AS string), rejected_key))"},
)


def silver_spec(name: str, buckets: int) -> TableSpec:
    """A silver table laid out for upserts. Choose ``buckets`` so that one bucket is about 256 MB to 1 GB; a month of orders
    has an eighth of them."""
    spec = SILVER[name]
    if name == "orders":
        return spec.like(name, partition=monthly("order_date", spec.keys, max(1, buckets // 8)))
    if name == "order_items":
        # The order of an item never changes; the items of a few orders lie in few folders.
        return spec.like(name, partition=bucketed(("order_id",), buckets))
    return spec.like(name, partition=bucketed(spec.keys, buckets))


GOLD = {
    spec.name: spec
    for spec in (
        TableSpec(
            "daily_revenue",
            columns(f"""
revenue_date date
order_count bigint
gross_revenue {GOLD_MONEY}
net_revenue {GOLD_MONEY}
avg_order_value decimal(10,2)
unique_customers bigint
new_customers bigint
_computed_at timestamp
"""),
            keys=("revenue_date",),
            not_null=(
                "revenue_date", "order_count", "gross_revenue", "net_revenue", "avg_order_value", "unique_customers",
                "new_customers",
            ),
            defaults={"new_customers": "0", "_computed_at": "current_timestamp()"},
            partition={"_month": "date_format(revenue_date, 'yyyy-MM')"},
            ordered_by="revenue_date",
        ),
        TableSpec(
            "monthly_revenue",
            columns(f"""
year_month string
year int
month int
order_count bigint
gross_revenue {GOLD_MONEY}
net_revenue {GOLD_MONEY}
avg_order_value decimal(10,2)
mom_growth_pct decimal(6,2)
unique_customers bigint
_computed_at timestamp
"""),
            keys=("year_month",),
            not_null=(
                "year_month", "year", "month", "order_count", "gross_revenue", "net_revenue", "avg_order_value",
                "unique_customers",
            ),
            checks={"year_month": "length(year_month) <= 7"},
            defaults={"_computed_at": "current_timestamp()"},
        ),
        TableSpec(
            "customer_ltv",
            columns(f"""
customer_id string
full_name string
email string
tier string
country string
first_order_date date
last_order_date date
total_orders bigint
total_revenue {GOLD_MONEY}
avg_order_value decimal(10,2)
days_since_last int
ltv_segment string
_computed_at timestamp
"""),
            keys=("customer_id",),
            not_null=("customer_id", "total_orders", "total_revenue"),
            defaults={"total_orders": "0", "total_revenue": "0", "_computed_at": "current_timestamp()"},
        ),
        TableSpec(
            "product_performance",
            columns(f"""
product_id string
product_name string
category string
total_units_sold bigint
total_revenue {GOLD_MONEY}
total_profit {GOLD_MONEY}
order_count bigint
avg_selling_price decimal(10,2)
revenue_rank bigint
category_rank bigint
_computed_at timestamp
"""),
            keys=("product_id",),
            not_null=("product_id", "product_name", "total_units_sold", "total_revenue", "order_count"),
            defaults={"total_units_sold": "0", "order_count": "0", "_computed_at": "current_timestamp()"},
        ),
        TableSpec(
            "category_revenue",
            columns(f"""
category string
year_month string
units_sold bigint
gross_revenue {GOLD_MONEY}
net_revenue {GOLD_MONEY}
_computed_at timestamp
"""),
            keys=("category", "year_month"),
            defaults={"_computed_at": "current_timestamp()"},
        ),
    )
}

WEEKLY_REVENUE = TableSpec(
    "weekly_revenue",
    columns(f"""
week_start date
order_count bigint
gross_revenue {GOLD_MONEY}
net_revenue {GOLD_MONEY}
avg_order_value decimal(10,2)
unique_customers bigint
"""),
    keys=("week_start",),
    partition={"_year": "date_format(week_start, 'yyyy')"},
    ordered_by="week_start",
)

# What the items of an order add up to, by product: gold tables are made from these rows, by month of the order.
ORDER_FACTS = TableSpec(
    "order_facts",
    columns(f"""
order_id string
product_id string
order_date date
earns boolean
n_items bigint
items_total {GOLD_MONEY}
units bigint
prices {GOLD_MONEY}
priced bigint
"""),
    keys=("order_id", "product_id"),
    not_null=("order_id", "product_id", "order_date", "n_items"),
    partition={"_month": "date_format(order_date, 'yyyy-MM')"},
    ordered_by="order_date",
)

# The sample fact table: constraints on measures, one folder per month of sale.
SALES = TableSpec(
    "sales",
    columns("""
sale_id bigint
order_id string
customer_id string
product_id string
sale_date date
region string
channel string
quantity int
unit_price decimal(10,2)
discount_pct decimal(5,2)
line_total decimal(14,2)
created_at timestamp
updated_at timestamp
_batch_id string
_source string
"""),
    keys=("sale_id",),
    not_null=(
        "sale_id", "order_id", "customer_id", "product_id", "sale_date", "region", "quantity", "unit_price",
        "discount_pct",
    ),
    checks={
        "channel": "channel IN ('web', 'mobile', 'retail', 'b2b')",
        "quantity": "quantity > 0",
        "unit_price": "unit_price >= 0",
        "discount_pct": "discount_pct BETWEEN 0 AND 100",
    },
    defaults={
        "discount_pct": "0",
        "created_at": "current_timestamp()",
        "updated_at": "current_timestamp()",
    },
    generated={"line_total": "quantity * unit_price * (1 - discount_pct / 100)"},
)

SALES_PARTITIONED = SALES.like(
    "sales_partitioned",
    partition={"_sale_month": "date_format(sale_date, 'yyyy-MM')"},
    ordered_by="sale_date",
)
