"""Small hand-made frames."""

from decimal import Decimal

from smeltworks.schemas import BRONZE, raw_columns

STAMP = "2024-01-0{} 00:00:00"


def uid(n: int, kind: str = "a") -> str:
    return f"{kind * 8}-0000-4000-8000-{n:012d}"


def bronze(spark, name: str, records: list[dict]):
    """Bronze rows; ``at`` is a day number, ``_id`` counts up unless given."""
    spec = BRONZE[name]
    names = ["_id", "at", "_batch_id", *raw_columns(spec)]
    data = [
        tuple({"_id": i + 1, "at": 1, "_batch_id": "b1", **r}.get(c) for c in names) for i, r in enumerate(records)
    ]
    ddl = ", ".join(f"{c} {'bigint' if c == '_id' else 'int' if c == 'at' else 'string'}" for c in names)
    df = spark.createDataFrame(data, ddl)
    return df.selectExpr(
        "_id",
        "cast(concat('2024-01-0', at, ' 00:00:00') as timestamp) AS _ingested_at",
        "cast(NULL AS string) AS _source_file",
        "_batch_id",
        *raw_columns(spec),
    )


def customer(n=1, **changes):
    good = {
        "customer_id": uid(n, "c"),
        "first_name": "Ada",
        "last_name": "Byron",
        "email": f"user{n}@x.org",
        "country": "uk",
        "signup_date": "2021-01-02",
        "tier": "gold",
    }
    return {**good, **changes}


def order(n=1, **changes):
    good = {
        "order_id": uid(n),
        "customer_id": uid(1, "c"),
        "order_date": "2021-03-04",
        "status": "completed",
        "total_amount": "10.50",
        "currency": "eur",
        "created_at": "2021-03-04 05:06:07",
    }
    return {**good, **changes}


def product(n=1, **changes):
    good = {
        "product_id": uid(n, "d"),
        "product_name": "Pen",
        "category": "office",
        "price": "10",
        "cost": "4",
        "stock_qty": "7",
    }
    return {**good, **changes}


def item(n=1, **changes):
    good = {
        "order_item_id": uid(n, "e"),
        "order_id": uid(1),
        "product_id": uid(1, "d"),
        "quantity": "2",
        "unit_price": "3.50",
        "discount": "10",
    }
    return {**good, **changes}


def money(text: str) -> Decimal:
    return Decimal(text)


def silver_orders(spark, records):
    """(order_id, customer_id, date, status, amount) rows."""
    df = spark.createDataFrame(records, "order_id int, customer_id int, d string, status string, amount string")
    return df.selectExpr(
        "order_id", "customer_id", "cast(d AS date) AS order_date", "status",
        "cast(amount AS decimal(12,2)) AS total_amount",
    )


def silver_items(spark, records):
    """(order_id, product_id, quantity, unit price, line total) rows."""
    df = spark.createDataFrame(records, "order_id int, product_id int, quantity int, p string, t string")
    return df.selectExpr(
        "order_id", "product_id", "quantity", "cast(p AS decimal(10,2)) AS unit_price",
        "cast(t AS decimal(12,2)) AS line_total",
    )
