import datetime

import pytest
from samples import bronze, customer, item, money, order, product, uid

from smeltworks.operators import constraints
from smeltworks.plans import silver
from smeltworks.schemas import CUSTOMERS


@pytest.fixture
def customers(spark):
    return silver.clean_customers(bronze(spark, "raw_customers", [customer(1), customer(2)]))


def test_customer_is_normalised(spark):
    raw = customer(1, first_name=" Ada ", email=" Ada@X.org ", country=" uk", tier=" Gold ", signup_date="2021-01-02")
    got = silver.clean_customers(bronze(spark, "raw_customers", [raw])).first()
    assert (got.first_name, got.email, got.country, got.tier, got.full_name) == ("Ada", "ada@x.org", "UK", "gold", "Ada Byron")
    assert got.signup_date == datetime.date(2021, 1, 2) and got._source_batch == "b1"


def test_latest_wins_and_ties_go_to_the_greater_id(spark, rows):
    raw = [
        customer(1, email="old@x.org", at=1),
        customer(1, email="new@x.org", at=2),
        customer(2, email="first@x.org", _id=10),
        customer(2, email="second@x.org", _id=11),
    ]
    got = silver.clean_customers(bronze(spark, "raw_customers", raw))
    assert rows(got, "email") == [("new@x.org",), ("second@x.org",)]


def test_spellings_of_one_id_are_one_key(spark, rows):
    raw = [customer(1, email="a@x.org", at=1), customer(1, customer_id=uid(1, "c").upper(), email="b@x.org", at=2)]
    assert rows(silver.clean_customers(bronze(spark, "raw_customers", raw)), "customer_id", "email") == [(uid(1, "c"), "b@x.org")]


def test_broken_newer_row_does_not_hide_a_good_one(spark, rows):
    raw = [customer(1, email="old@x.org", at=1), customer(1, email="   ", at=2), customer(1, email=None, at=3)]
    assert rows(silver.clean_customers(bronze(spark, "raw_customers", raw)), "email") == [("old@x.org",)]


def test_bad_ids_and_nulls_drop_out(spark):
    raw = [customer(1, customer_id=None), customer(1, customer_id="bad-id"), customer(1, customer_id="-" * 36)]
    assert silver.clean_customers(bronze(spark, "raw_customers", raw)).isEmpty()


@pytest.mark.parametrize(
    ("change", "reason"),
    [
        ({"signup_date": "2021-13-01"}, "signup_date is not a date"),
        ({"tier": "vip"}, "tier breaks check"),
        ({"first_name": None}, "first_name is null"),
    ],
)
def test_bad_customer_fails_the_load_or_goes_to_quarantine(spark, rows, change, reason):
    frame = bronze(spark, "raw_customers", [customer(1), customer(2, **change)])
    with pytest.raises(Exception, match=reason):
        silver.clean_customers(frame).collect()
    assert rows(silver.clean_customers(frame, "quarantine"), "customer_id") == [(uid(1, "c"),)]
    assert rows(silver.rejects("customers", frame), "customer_id", "_errors") == [(uid(2, "c"), reason)]


def test_null_tier_and_null_signup_pass(spark):
    frame = bronze(spark, "raw_customers", [customer(1, tier=None, signup_date=None)])
    assert silver.clean_customers(frame).first().tier is None


def test_product_defaults(spark):
    raw = product(1, product_name=" Pen ", category=None, price="N/A", cost="-1", stock_qty="7.5")
    got = silver.clean_products(bronze(spark, "raw_products", [raw])).first()
    assert (got.product_name, got.category, got.price, got.cost, got.stock_qty, got.margin_pct) == (
        "Pen", "Unknown", money("0"), money("0"), 0, None,
    )
    good = silver.clean_products(bronze(spark, "raw_products", [product(1, price="9", cost="3")])).first()
    assert good.margin_pct == money("66.67")


def test_margin_that_does_not_fit_fails_or_goes_to_quarantine(spark):
    frame = bronze(spark, "raw_products", [product(1, price="1", cost="500")])
    with pytest.raises(Exception, match="margin_pct does not fit"):
        silver.clean_products(frame).collect()
    assert silver.clean_products(frame, "quarantine").isEmpty()
    assert silver.rejects("products", frame).first()._errors == "margin_pct does not fit"


def test_price_that_does_not_fit_is_an_error_not_a_default(spark):
    frame = bronze(spark, "raw_products", [product(1, price="123456789012.5")])
    assert silver.rejects("products", frame).first()._errors == "price is null"


def test_order_defaults(spark, customers):
    frame = bronze(spark, "raw_orders", [order(1, status=" Completed ", total_amount="x", currency=None, created_at=None)])
    got = silver.clean_orders(frame, customers).first()
    assert (got.status, got.total_amount, got.currency, got.created_at, got._is_valid) == (
        "completed", money("0"), "USD", None, True,
    )


def test_currency_is_at_most_three_letters(spark, customers):
    frame = bronze(spark, "raw_orders", [order(1, currency="EURO")])
    with pytest.raises(Exception, match="currency breaks check"):
        silver.clean_orders(frame, customers).collect()


def test_orders_of_unknown_customers_drop_out_even_if_broken(spark, customers, rows):
    raw = [order(1), order(2, customer_id=uid(9, "c"), order_date="no date")]
    frame = bronze(spark, "raw_orders", raw)
    assert rows(silver.clean_orders(frame, customers), "order_id") == [(uid(1),)]
    lost = silver.rejects("orders", frame, {"customers": customers})
    assert rows(lost, "order_id", "_errors") == [(uid(2), "customer_id is unknown")]


def test_latest_order_of_an_unknown_customer_hides_the_older_one(spark, customers):
    # Deduplication comes before the parent check.
    raw = [order(1, at=1), order(1, at=2, customer_id=uid(9, "c"))]
    assert silver.clean_orders(bronze(spark, "raw_orders", raw), customers).isEmpty()


def test_order_without_date_is_filtered_with_bad_date_is_an_error(spark, customers):
    frame = bronze(spark, "raw_orders", [order(1, order_date=None), order(2, order_date="2021-02-30")])
    with pytest.raises(Exception, match="order_date is not a date"):
        silver.clean_orders(frame, customers).collect()
    assert silver.clean_orders(frame, customers, "quarantine").isEmpty()


def test_item_defaults_and_caps(spark, customers, rows):
    orders = silver.clean_orders(bronze(spark, "raw_orders", [order(1)]), customers)
    products = silver.clean_products(bronze(spark, "raw_products", [product(1)]))
    raw = [
        item(1),
        item(2, quantity="x", unit_price="-1"),
        item(3, discount="150"),
        item(4, discount="123456"),
        item(5, quantity=None, discount=None, unit_price="0.335"),
        item(6, order_id=uid(9)),
        item(7, product_id=uid(9, "d")),
        item(8, product_id=None),
    ]
    got = silver.clean_order_items(bronze(spark, "raw_order_items", raw), orders, products)
    assert rows(got, "order_item_id", "quantity", "unit_price", "discount", "line_total") == [
        (uid(1, "e"), 2, money("3.50"), money("10.00"), money("6.30")),
        (uid(2, "e"), 1, money("0.00"), money("10.00"), money("0.00")),
        (uid(3, "e"), 2, money("3.50"), money("100.00"), money("0.00")),
        (uid(4, "e"), 2, money("3.50"), money("100.00"), money("0.00")),
        (uid(5, "e"), 1, money("0.34"), money("0.00"), money("0.34")),
    ]


def test_full_name_is_null_if_a_part_is(spark):
    df = spark.createDataFrame([("c", "Ada", None)], "customer_id string, first_name string, last_name string")
    assert constraints.conform(df, CUSTOMERS).first().full_name is None


def test_high_value_flag(spark, customers, rows):
    frame = bronze(spark, "raw_orders", [order(1, total_amount="500"), order(2, total_amount="500.01")])
    flagged = silver.flag_high_value(silver.clean_orders(frame, customers))
    assert rows(flagged, "order_id", "is_high_value") == [(uid(1), False), (uid(2), True)]


def test_hot_parent_gives_the_same_rows(spark, customers, rows):
    from smeltworks.operators.skew import hot_keys

    raw = [order(n, customer_id=uid(1 if n % 3 else 2 if n % 2 else 9, "c")) for n in range(1, 60)]
    frame = bronze(spark, "raw_orders", raw)
    hot = hot_keys(frame, ["customer_id"], hot_rows=5)
    assert not hot.isEmpty()
    split = silver.clean_orders(frame, customers, hot={"customer_id": hot})
    assert rows(split, "order_id") == rows(silver.clean_orders(frame, customers), "order_id")


def test_the_pattern_of_an_id_is_matched_once(spark, capsys):
    silver._latest(bronze(spark, "raw_orders", [order(1)]), silver._rules()["orders"]).explain()
    assert capsys.readouterr().out.count("RLIKE") == 2


def test_stored_latest_rows_give_clean_and_waiting_ones(spark, customers, rows):
    records = [order(1), order(1, status="shipped", at=2), order(2, customer_id=uid(9, "c")), order(3, order_id="bad")]
    raw = bronze(spark, "raw_orders", records)
    latest = silver.latest_known("orders", raw, {"customers": customers})
    shown = ["order_id", "customer_id", "status", "total_amount", "order_date"]
    assert rows(silver.clean_latest("orders", latest), *shown) == rows(silver.clean_orders(raw, customers), *shown)
    assert rows(silver.waiting(latest), "order_id", "_id") == [(uid(2), 3)]


def test_stored_latest_rows_are_typed_once(spark, customers, capsys):
    from smeltworks.sources.scratch import materialise

    raw = bronze(spark, "raw_orders", [order(1), order(2, customer_id=uid(9, "c"), total_amount="x1")])
    latest = materialise(silver.latest_known("orders", raw, {"customers": customers}))
    silver.clean_latest("orders", latest).explain()
    assert "RLIKE" not in capsys.readouterr().out
    # The rows that wait are as they came.
    assert [(r.order_id, r.total_amount) for r in silver.waiting(latest).collect()] == [(uid(2), "x1")]
    assert silver.waiting(latest).columns == raw.columns
