"""SQL counterparts of the registered queries, written directly from the definitions.

They use the plain form (distinct counts over the fan-out join, unpartitioned ranks) where the library
rewrites, so a rewrite that changes a result shows up.
"""

from harness.mapping import BRONZE_SQL, SILVER_SQL

AS_OF = "2001-08-01"
HIGH, MEDIUM, CHURN_DAYS = 25_000_000, 15_000_000, 180


def _ctes(*names_and_sql: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in names_and_sql) + "\n"


def _silver(*extra: tuple[str, str]) -> str:
    return _ctes(*SILVER_SQL.items(), *extra)


def div_round(n: str, d: str) -> str:
    """Integer quotient rounded half away from zero, for positive ``d``."""
    n, d = f"CAST({n} AS HUGEINT)", f"CAST({d} AS HUGEINT)"
    return f"(CASE WHEN {n} < 0 THEN -((2 * -{n} + {d}) // (2 * {d})) ELSE (2 * {n} + {d}) // (2 * {d}) END)"


def scaled(value: str, scale: int, to: str) -> str:
    """An integer as a decimal with ``scale`` fraction digits."""
    one = "0." + "0" * (scale - 1) + "1"
    return f"CAST(CAST({value} AS DECIMAL(18,0)) * CAST({one} AS DECIMAL({scale + 1},{scale})) AS {to})"


def avg2(x: str, over: str = "", to: str = "DECIMAL(10,2)") -> str:
    total, n = f"sum(CAST({x} * 100 AS BIGINT)) {over}", f"count({x}) {over}"
    return f"CASE WHEN {n} > 0 THEN {scaled(div_round(total, n), 2, to)} END"


def growth(now: str, before: str, scale: int, to: str) -> str:
    change = f"CAST(({now} - {before}) * 100 AS HUGEINT) * {100 * 10**scale}"
    quotient = div_round(change, f"CAST({before} * 100 AS HUGEINT)")
    return f"CASE WHEN {before} > 0 THEN {scaled(quotient, scale, to)} END"


OK = "o.status NOT IN ('cancelled', 'refunded')"

DAILY = (
    "daily",
    f"""
SELECT o.order_date AS revenue_date, count(DISTINCT o.order_id) AS order_count,
       CAST(sum(i.line_total) AS DECIMAL(28,2)) AS gross_revenue,
       CAST(coalesce(sum(i.line_total) FILTER (WHERE {OK}), 0) AS DECIMAL(28,2)) AS net_revenue,
       {avg2("o.total_amount")} AS avg_order_value,
       count(DISTINCT o.customer_id) AS unique_customers,
       count(DISTINCT o.customer_id) FILTER (WHERE NOT EXISTS (
         SELECT 1 FROM silver_orders e WHERE e.customer_id = o.customer_id AND e.order_date < o.order_date
       )) AS new_customers
FROM silver_orders o JOIN silver_items i USING (order_id)
GROUP BY o.order_date""",
)

_ROLLUP = f"""CAST(sum(order_count) AS BIGINT) AS order_count,
       CAST(sum(gross_revenue) AS DECIMAL(28,2)) AS gross_revenue,
       CAST(sum(net_revenue) AS DECIMAL(28,2)) AS net_revenue,
       {avg2("avg_order_value")} AS avg_order_value,
       CAST(sum(unique_customers) AS BIGINT) AS unique_customers"""

MONTHLY = (
    "monthly",
    f"""
SELECT strftime(revenue_date, '%Y-%m') AS year_month, CAST(year(revenue_date) AS INT) AS year,
       CAST(month(revenue_date) AS INT) AS month, {_ROLLUP}
FROM daily GROUP BY 1, 2, 3""",
)

_MONTH_COLUMNS = (
    "m.year_month, m.year, m.month, m.order_count, m.gross_revenue, m.net_revenue, m.avg_order_value, m.unique_customers"
)

LTV = (
    "ltv",
    f"""
SELECT c.customer_id, c.full_name, c.email, c.tier, c.country,
       min(o.order_date) AS first_order_date, max(o.order_date) AS last_order_date,
       count(DISTINCT o.order_id) AS total_orders,
       CAST(coalesce(sum(i.line_total), 0) AS DECIMAL(28,2)) AS total_revenue,
       {avg2("o.total_amount")} AS avg_order_value,
       CAST(date_diff('day', max(o.order_date), DATE '{AS_OF}') AS INT) AS days_since_last,
       CASE WHEN date_diff('day', max(o.order_date), DATE '{AS_OF}') >= {CHURN_DAYS} THEN 'CHURNED'
            WHEN sum(i.line_total) >= {HIGH} THEN 'HIGH'
            WHEN sum(i.line_total) >= {MEDIUM} THEN 'MEDIUM' ELSE 'LOW' END AS ltv_segment
FROM silver_customers c
LEFT JOIN silver_orders o ON c.customer_id = o.customer_id AND {OK}
LEFT JOIN silver_items i ON o.order_id = i.order_id
GROUP BY c.customer_id, c.full_name, c.email, c.tier, c.country""",
)

_SALES = (
    "sales",
    f"""
SELECT p.product_id, p.product_name, p.category, sum(i.quantity) AS units, sum(i.line_total) AS revenue,
       sum(i.quantity * p.cost) AS total_cost, count(DISTINCT o.order_id) AS orders,
       {avg2("i.unit_price")} AS price
FROM silver_products p LEFT JOIN silver_items i ON p.product_id = i.product_id
LEFT JOIN silver_orders o ON i.order_id = o.order_id AND {OK}
GROUP BY p.product_id, p.product_name, p.category""",
)

PRODUCTS = (
    "performance",
    """
SELECT product_id, product_name, category, CAST(coalesce(units, 0) AS BIGINT) AS total_units_sold,
       CAST(coalesce(revenue, 0) AS DECIMAL(28,2)) AS total_revenue,
       CAST(coalesce(revenue - total_cost, 0) AS DECIMAL(28,2)) AS total_profit,
       orders AS order_count, price AS avg_selling_price,
       rank() OVER (ORDER BY revenue DESC NULLS LAST) AS revenue_rank,
       rank() OVER (PARTITION BY category ORDER BY revenue DESC NULLS LAST) AS category_rank
FROM sales""",
)

_ID = "regexp_full_match({}, '[0-9a-fA-F]{{8}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{12}}')"


def _valid(*ids: str) -> str:
    return " AND ".join(_ID.format(i) for i in ids)


def _number(c: str, to: str, default: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '[0-9]+\\.?[0-9]*') THEN CAST({c} AS {to}) ELSE CAST({default} AS {to}) END"


def _whole(c: str, default: int) -> str:
    return f"CASE WHEN regexp_full_match({c}, '[0-9]+') THEN CAST({c} AS INT) ELSE {default} END"


def _latest(raw: str, key: str, where: str) -> str:
    return f"""
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY lower({key}) ORDER BY _ingested_at DESC, _id DESC) AS rn
  FROM {raw} WHERE {where}) WHERE rn = 1"""


def clean_ctes(restrict: str = "") -> list[tuple[str, str]]:
    """Cleaned tables as ``c_customers``, ``c_products``, ``c_orders``, ``c_items``; ``restrict`` limits the
    bronze rows seen."""
    where = f" AND {restrict}" if restrict else ""
    return [
        *BRONZE_SQL.items(),
        (
            "c_customers",
            f"""
SELECT lower(customer_id) AS customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name,
       lower(trim(email)) AS email, upper(trim(country)) AS country, CAST(signup_date AS DATE) AS signup_date,
       lower(trim(tier)) AS tier, trim(first_name) || ' ' || trim(last_name) AS full_name,
       _batch_id AS source_batch
FROM ({_latest("raw_customers", "customer_id", _valid("customer_id") + " AND trim(email) <> ''" + where)})""",
        ),
        (
            "c_products",
            f"""
SELECT *, CASE WHEN price > 0 THEN
         {scaled(div_round("(price - cost) * 1000000", "price * 100"), 2, "DECIMAL(5,2)")} END AS margin_pct
FROM (
SELECT lower(product_id) AS product_id, trim(product_name) AS product_name,
       coalesce(trim(category), 'Unknown') AS category, {_number("price", "DECIMAL(10,2)", "0")} AS price,
       {_number("cost", "DECIMAL(10,2)", "0")} AS cost, {_whole("stock_qty", 0)} AS stock_qty,
       _batch_id AS source_batch
FROM ({_latest("raw_products", "product_id", _valid("product_id") + " AND product_name IS NOT NULL" + where)}))""",
        ),
        (
            "c_orders",
            f"""
SELECT lower(r.order_id) AS order_id, lower(r.customer_id) AS customer_id, CAST(r.order_date AS DATE) AS order_date,
       lower(trim(r.status)) AS status, {_number("r.total_amount", "DECIMAL(12,2)", "0")} AS total_amount,
       coalesce(upper(trim(r.currency)), 'USD') AS currency,
       CAST(CAST(r.created_at AS TIMESTAMP) AS STRING) AS created_at, r._batch_id AS source_batch
FROM ({_latest("raw_orders", "order_id", _valid("order_id", "customer_id") + " AND order_date IS NOT NULL" + where)}) r
JOIN c_customers c ON lower(r.customer_id) = c.customer_id""",
        ),
        (
            "c_items",
            f"""
SELECT *, CAST(quantity * unit_price * (100 - discount) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS line_total
FROM (
SELECT lower(r.order_item_id) AS order_item_id, lower(r.order_id) AS order_id, lower(r.product_id) AS product_id,
       {_whole("r.quantity", 1)} AS quantity, {_number("r.unit_price", "DECIMAL(10,2)", "0")} AS unit_price,
       CAST(least({_number("r.discount", "DECIMAL(12,2)", "0")}, 100) AS DECIMAL(5,2)) AS discount,
       r._batch_id AS source_batch
FROM ({_latest("raw_order_items", "order_item_id", _valid("order_item_id", "order_id", "product_id") + where)}) r
JOIN c_orders o ON lower(r.order_id) = o.order_id
JOIN c_products p ON lower(r.product_id) = p.product_id)""",
        ),
    ]


def _cleaned(select: str) -> str:
    return _ctes(*clean_ctes()) + select


def _from_daily(select: str) -> str:
    return _silver(DAILY) + select


def _from_monthly(select: str) -> str:
    return _silver(DAILY, MONTHLY) + select


def _from_ltv(select: str) -> str:
    return _silver(LTV) + select


def _from_products(select: str) -> str:
    return _silver(_SALES, PRODUCTS) + select


def _gold_of_cleaned() -> list[tuple[str, str]]:
    """The silver names bound to the cleaned tables."""
    return [
        *clean_ctes(),
        ("silver_customers", "SELECT * FROM c_customers"),
        ("silver_orders", "SELECT * FROM c_orders"),
        ("silver_items", "SELECT * FROM c_items"),
        ("silver_products", "SELECT * FROM c_products"),
    ]


def _ranks() -> str:
    below = "rank() OVER (PARTITION BY tier ORDER BY total_revenue) - 1"
    others = "count(*) OVER (PARTITION BY tier) - 1"
    percent = scaled(div_round(f"({below}) * 1000", f"greatest({others}, 1)"), 3, "DECIMAL(4,3)")
    return f"""
SELECT customer_id, full_name, tier, total_revenue,
       rank() OVER (PARTITION BY tier ORDER BY total_revenue DESC) AS rank_in_tier,
       rank() OVER (ORDER BY total_revenue DESC) AS overall_rank, {percent} AS percentile_in_tier
FROM ltv WHERE total_orders > 0"""


_HISTORY = """
, done AS (SELECT customer_id, order_id, order_date, total_amount,
                  row_number() OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS order_number
           FROM silver_orders WHERE status = 'completed'),
span AS (SELECT customer_id, min(order_date) AS first_order_date, max(order_date) AS last_order_date
         FROM done GROUP BY customer_id)
SELECT d.*, s.first_order_date, s.last_order_date,
       CAST(date_diff('day', p.order_date, d.order_date) AS INT) AS days_since_last_order
FROM done d JOIN span s USING (customer_id)
LEFT JOIN done p ON p.customer_id = d.customer_id AND p.order_number = d.order_number - 1"""

_LAG = "lag(gross_revenue, {}) OVER (ORDER BY year_month)"

_DAYS = "ORDER BY revenue_date ROWS BETWEEN {} PRECEDING AND CURRENT ROW"

_ORDER_COLUMNS = "order_id, customer_id, order_date, status, total_amount, currency, created_at, source_batch"
_CUSTOMER_COLUMNS = (
    "customer_id, first_name, last_name, email, country, signup_date, tier, full_name, source_batch"
)

_CUSTOMERS = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"

_DELIVERY = """
SELECT CASE c_mktsegment WHEN 'FURNITURE' THEN -c_custkey ELSE c_custkey END AS c_custkey, c_name, c_nationkey,
       CASE c_mktsegment WHEN 'BUILDING' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, c_mktsegment
FROM customer WHERE c_mktsegment <> 'MACHINERY'"""


def _inside(day: str) -> str:
    return f"{day} >= DATE '1995-05-01' AND {day} < DATE '1997-09-01'"


def _closed_days(lateness: str) -> str:
    return f"""
SELECT CAST(date_trunc('day', ts) AS DATE) AS day, event_type, count(*) AS events,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total
FROM events GROUP BY 1, 2 HAVING date_trunc('day', max(ts)) + INTERVAL 1 DAY <= (SELECT max(ts) - {lateness} FROM events)"""


def _distinct_customers(**groups: str) -> str:
    columns, names = ", ".join(f"{e} AS {n}" for n, e in groups.items()), ", ".join(groups)
    return _silver() + f"""
, bought AS (
SELECT DISTINCT {columns}, o.order_date, o.customer_id FROM silver_orders o JOIN silver_customers c ON o.customer_id = c.customer_id)
SELECT {names}, count(DISTINCT customer_id) AS customers, count(*) AS summed_customers FROM bought GROUP BY {names}"""


def sql() -> dict[str, str]:
    """DuckDB text per registered query."""
    daily_columns = (
        "revenue_date, order_count, gross_revenue, net_revenue, avg_order_value, unique_customers, new_customers"
    )
    monthly_calendar = f"""
SELECT {_MONTH_COLUMNS}, {growth("m.gross_revenue", "p.gross_revenue", 2, "DECIMAL(6,2)")} AS mom_growth_pct
FROM monthly m LEFT JOIN monthly p
  ON make_date(p.year, p.month, 1) + INTERVAL 1 MONTH = make_date(m.year, m.month, 1)"""
    upserted = _ctes(*clean_ctes()) + f"""
, first_batch AS (
SELECT lower(order_id) AS order_id, CAST(CAST(created_at AS TIMESTAMP) AS STRING) AS created_at
FROM raw_orders WHERE _batch_id = 'batch-1' AND {_valid("order_id", "customer_id")} AND order_date IS NOT NULL)
SELECT l.order_id, l.customer_id, l.order_date, l.status, l.total_amount, l.currency,
       CASE WHEN f.order_id IS NULL THEN l.created_at ELSE f.created_at END AS created_at, l.source_batch
FROM c_orders l LEFT JOIN first_batch f ON l.order_id = f.order_id"""
    history = _silver() + _HISTORY
    ranks = _from_ltv(_ranks())
    performance = _from_products("SELECT * FROM performance")
    orders_clean = _cleaned(f"SELECT {_ORDER_COLUMNS} FROM c_orders")
    items_clean = _cleaned(
        "SELECT order_item_id, order_id, product_id, quantity, unit_price, discount, line_total, source_batch FROM c_items"
    )
    by_day = "SELECT order_date AS revenue_date, count(*) AS order_count, CAST(sum(total_amount) AS DECIMAL(28,2)) AS gross_revenue"
    events_json = """
SELECT event_type, count(*) AS events, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_total,
       max(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS k_max
FROM events GROUP BY event_type"""
    category_revenue = f"""
SELECT p.category, strftime(o.order_date, '%Y-%m') AS year_month, CAST(sum(i.quantity) AS BIGINT) AS units_sold,
       CAST(sum(i.line_total) AS DECIMAL(28,2)) AS gross_revenue,
       CAST(sum(CASE WHEN {OK} THEN i.line_total ELSE 0 END) AS DECIMAL(28,2)) AS net_revenue
FROM silver_items i JOIN silver_orders o ON i.order_id = o.order_id JOIN silver_products p ON i.product_id = p.product_id
GROUP BY 1, 2"""
    return {
        # gold
        "daily_revenue": _from_daily(f"SELECT {daily_columns} FROM daily"),
        "monthly_revenue": _from_monthly(monthly_calendar),
        "monthly_revenue_previous_row": _from_monthly(f"""
SELECT {_MONTH_COLUMNS}, {growth("gross_revenue", "before", 2, "DECIMAL(6,2)")} AS mom_growth_pct
FROM (SELECT *, {_LAG.format(1)} AS before FROM monthly) m"""),
        "weekly_revenue": _from_daily(
            f"SELECT CAST(date_trunc('week', revenue_date) AS DATE) AS week_start, {_ROLLUP} FROM daily GROUP BY 1"
        ),
        "customer_ltv": _from_ltv("SELECT * FROM ltv"),
        "product_performance": performance,
        "order_summary": _silver() + """
SELECT o.order_id, o.order_date, o.status, o.total_amount, c.full_name AS customer_name, c.email, c.tier, c.country,
       count(i.product_id) AS item_count, CAST(sum(i.line_total) AS DECIMAL(28,2)) AS calculated_total
FROM silver_orders o JOIN silver_customers c ON o.customer_id = c.customer_id
JOIN silver_items i ON o.order_id = i.order_id
GROUP BY o.order_id, o.order_date, o.status, o.total_amount, c.full_name, c.email, c.tier, c.country""",
        "category_revenue": _silver() + category_revenue,
        "high_value_orders": _silver() + "SELECT *, total_amount > 500 AS is_high_value FROM silver_orders",
        "completed_by_day": _silver() + f"{by_day} FROM silver_orders WHERE status = 'completed' GROUP BY 1",
        "kpi_tiles": _from_daily(f"""
SELECT CAST(sum(gross_revenue) AS DECIMAL(28,2)) AS total_revenue, CAST(sum(net_revenue) AS DECIMAL(28,2)) AS net_revenue,
       {avg2("avg_order_value")} AS avg_order_value,
       (SELECT count(DISTINCT customer_id) FROM silver_orders) AS unique_customers
FROM daily"""),
        "total_ltv": _from_ltv(
            "SELECT CAST(sum(total_revenue) AS DECIMAL(28,2)) AS total_ltv, count(*) AS customers FROM ltv"
        ),
        "customers_by_segment": _from_ltv("""
SELECT ltv_segment, count(*) AS customers, CAST(sum(total_revenue) AS DECIMAL(28,2)) AS total_ltv
FROM ltv GROUP BY ltv_segment"""),
        "revenue_by_tier": _from_ltv(f"""
SELECT tier, count(*) AS customers, CAST(sum(total_orders) AS BIGINT) AS total_orders,
       CAST(sum(total_revenue) AS DECIMAL(28,2)) AS total_revenue,
       {avg2("total_revenue", to="DECIMAL(28,2)")} AS revenue_per_customer
FROM ltv GROUP BY tier"""),
        "churn_rate": _from_ltv(f"""
SELECT churned_customers, customers,
       {scaled(div_round("churned_customers * 10000", "customers"), 4, "DECIMAL(5,4)")} AS churn_rate
FROM (SELECT count(*) FILTER (WHERE ltv_segment = 'CHURNED') AS churned_customers, count(*) AS customers FROM ltv)"""),
        "top_products": _from_products("""
SELECT product_id, product_name, category, total_revenue FROM performance
ORDER BY total_revenue DESC NULLS LAST, product_id LIMIT 10"""),
        # windows
        "running_revenue": _from_daily(f"""
SELECT revenue_date, gross_revenue,
       CAST(sum(gross_revenue) OVER ({_DAYS.format("UNBOUNDED")}) AS DECIMAL(28,2)) AS running_total,
       {avg2("gross_revenue", f"OVER ({_DAYS.format(6)})", "DECIMAL(28,2)")} AS rolling_7d_avg
FROM daily"""),
        "rolling_30_rows": _from_daily(f"""
SELECT revenue_date, gross_revenue,
       {avg2("gross_revenue", f"OVER ({_DAYS.format(29)})", "DECIMAL(28,2)")} AS rolling_30d_avg
FROM daily"""),
        "customer_ranks": ranks,
        "month_growth": _from_monthly(f"""
SELECT year_month, gross_revenue, prev_month, same_month_last_year,
       {growth("gross_revenue", "prev_month", 1, "DECIMAL(12,1)")} AS mom_growth_pct,
       {growth("gross_revenue", "same_month_last_year", 1, "DECIMAL(12,1)")} AS yoy_growth_pct
FROM (SELECT *, {_LAG.format(1)} AS prev_month, {_LAG.format(12)} AS same_month_last_year FROM monthly)"""),
        "order_history": history,
        "order_history_hot_customers": history,
        "top_products_per_category": _from_products("""
SELECT category, product_name, product_id, total_revenue, rank_in_category
FROM (SELECT *, rank() OVER (PARTITION BY category ORDER BY total_revenue DESC NULLS LAST) AS rank_in_category
      FROM performance) WHERE rank_in_category <= 3"""),
        "best_month": _silver() + f"""
, spent AS (
SELECT o.customer_id, strftime(o.order_date, '%Y-%m') AS best_month,
       CAST(sum(i.line_total) AS DECIMAL(28,2)) AS month_revenue
FROM silver_orders o JOIN silver_items i ON o.order_id = i.order_id WHERE {OK} GROUP BY 1, 2)
SELECT customer_id, best_month, month_revenue, total_ltv
FROM (SELECT *, CAST(sum(month_revenue) OVER (PARTITION BY customer_id) AS DECIMAL(28,2)) AS total_ltv,
             rank() OVER (PARTITION BY customer_id ORDER BY month_revenue DESC) AS place FROM spent)
WHERE place = 1""",
        # silver
        "silver_customers": _cleaned(f"SELECT {_CUSTOMER_COLUMNS} FROM c_customers"),
        "customers_full_refresh": _cleaned(f"SELECT {_CUSTOMER_COLUMNS} FROM c_customers"),
        "silver_products": _cleaned(
            "SELECT product_id, product_name, category, price, cost, margin_pct, stock_qty, source_batch FROM c_products"
        ),
        "silver_orders": orders_clean,
        "silver_orders_hot_customers": orders_clean,
        "silver_order_items": items_clean,
        "rejected_orders": _ctes(*clean_ctes()) + f"""
SELECT order_id, _batch_id AS batch_id, array_to_string(list_filter([
         CASE WHEN order_id IS NULL OR NOT {_valid("order_id")} THEN 'order_id is not a canonical id' END,
         CASE WHEN NOT {_valid("customer_id")} THEN 'customer_id is not a canonical id' END,
         CASE WHEN order_date IS NULL THEN 'order_date is null' END], lambda x: x IS NOT NULL), '; ') AS reasons
FROM raw_orders WHERE order_id IS NULL OR NOT ({_valid("order_id", "customer_id")}) OR order_date IS NULL
UNION ALL
SELECT lower(order_id), _batch_id, 'customer_id is unknown'
FROM ({_latest("raw_orders", "order_id", _valid("order_id", "customer_id") + " AND order_date IS NOT NULL")}) r
WHERE NOT EXISTS (SELECT 1 FROM c_customers c WHERE c.customer_id = lower(r.customer_id))""",
        "orphan_items": _ctes(*clean_ctes()) + """
SELECT order_item_id, order_id, quantity FROM c_items i
WHERE NOT EXISTS (SELECT 1 FROM c_orders o WHERE o.order_id = i.order_id AND o.status = 'completed')""",
        # loads
        "bronze_batches": _ctes(*BRONZE_SQL.items()) + """
SELECT _batch_id AS batch_id, order_id, customer_id, order_date, status, total_amount, currency, created_at
FROM raw_orders""",
        "json_ingest": _ctes(*BRONZE_SQL.items()) + """
SELECT _batch_id AS batch_id, count(*) AS row_count, count(order_id) AS order_ids, count(currency) AS currencies,
       count(DISTINCT total_amount) AS amounts FROM raw_orders GROUP BY 1""",
        "csv_ingest": _ctes(*BRONZE_SQL.items()) + """
SELECT _batch_id AS batch_id, count(*) AS row_count, count(order_id) AS order_ids, count(currency) AS currencies,
       count(DISTINCT total_amount) AS amounts FROM raw_orders GROUP BY 1""",
        "validate_bronze": _ctes(*BRONZE_SQL.items())
        + " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in BRONZE_SQL),
        "upsert_customers": _cleaned(f"SELECT {_CUSTOMER_COLUMNS} FROM c_customers"),
        "upsert_orders": upserted,
        "rebucketed_upsert": _cleaned(f"SELECT {_CUSTOMER_COLUMNS} FROM c_customers"),
        "incremental_late_parent": _ctes(*clean_ctes("_batch_id = 'batch-1'")) + f"SELECT {_ORDER_COLUMNS} FROM c_orders",
        "catalog_after_inserts": _silver() + "SELECT order_id, customer_id, order_date, status, total_amount FROM silver_orders",
        "stream_upsert_delayed": orders_clean,
        "insert_new_orders": _silver() + """
SELECT order_id, customer_id, order_date, status,
       CASE WHEN status = 'completed' THEN total_amount ELSE 0 END AS total_amount FROM silver_orders""",
        "orders_by_key": _silver() + """
SELECT order_id, customer_id, order_date, status, total_amount FROM silver_orders
QUALIFY row_number() OVER (PARTITION BY status ORDER BY total_amount DESC, order_id DESC) = 1""",
        "replace_table": _silver() + f"{by_day} FROM silver_orders WHERE status = 'completed' GROUP BY 1",
        "replace_partition": _silver() + f"""
{by_day} FROM silver_orders WHERE status = 'completed' AND order_date <> DATE '1998-03-10' GROUP BY 1
UNION ALL
{by_day} FROM silver_orders WHERE order_date = DATE '1998-03-10' GROUP BY 1""",
        "daily_revenue_backfill": _from_daily(f"SELECT {daily_columns} FROM daily"),
        "backfill_range": _silver() + f"""
{by_day} FROM silver_orders
WHERE status = 'completed' OR order_date >= DATE '1998-02-10' AND order_date < DATE '1998-05-20' GROUP BY 1""",
        "incremental_load": upserted,
        "incremental_load_buffered": upserted,
        "stream_upsert": orders_clean,
        "stream_upsert_out_of_order": orders_clean,
        "sales_month": _silver() + """
SELECT strftime(o.order_date, '%Y-%m') AS sale_month, count(*) AS sales, CAST(sum(i.line_total) AS DECIMAL(18,2)) AS revenue
FROM silver_items i JOIN silver_orders o ON i.order_id = o.order_id
WHERE o.order_date >= DATE '1998-03-01' AND o.order_date < DATE '1998-05-01' GROUP BY 1""",
        "sales_busy_months": _silver() + f"""
, by_month AS (
SELECT strftime(order_date, '%Y-%m') AS month, sum(total_amount) AS amount FROM silver_orders GROUP BY 1)
SELECT strftime(o.order_date, '%Y-%m') AS sale_month, count(*) AS sales, CAST(sum(i.line_total) AS DECIMAL(18,2)) AS revenue
FROM silver_items i JOIN silver_orders o ON i.order_id = o.order_id
WHERE strftime(o.order_date, '%Y-%m') IN (SELECT month FROM by_month WHERE amount > (SELECT {avg2("amount")} FROM by_month))
GROUP BY 1""",
        "bucketed_order_totals": _silver() + """
SELECT o.order_id, o.order_date, count(*) AS n_items, CAST(sum(i.line_total) AS DECIMAL(28,2)) AS items_total
FROM silver_orders o JOIN silver_items i ON o.order_id = i.order_id GROUP BY o.order_id, o.order_date""",
        "sorted_orders": _silver() + "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS inversions, CAST(0 AS BIGINT) AS overlaps FROM silver_orders",
        "distinct_customers_by_month": _distinct_customers(year_month="strftime(o.order_date, '%Y-%m')"),
        "distinct_customers_by_week": _distinct_customers(week_start="CAST(date_trunc('week', o.order_date) AS DATE)"),
        "distinct_customers_by_tier": _distinct_customers(tier="c.tier", year="CAST(year(o.order_date) AS INT)"),
        # change capture
        "snapshot_changes": f"""
WITH old AS ({_CUSTOMERS}), new AS ({_DELIVERY})
SELECT coalesce(n.c_custkey, o.c_custkey) AS c_custkey, n.c_name, n.c_nationkey, n.c_acctbal, n.c_mktsegment,
       CASE WHEN o.c_custkey IS NULL THEN 'insert' WHEN n.c_custkey IS NULL THEN 'delete' ELSE 'update' END AS _op
FROM old o FULL JOIN new n ON o.c_custkey = n.c_custkey
WHERE (o.c_custkey, o.c_name, o.c_nationkey, o.c_acctbal, o.c_mktsegment)
      IS DISTINCT FROM (n.c_custkey, n.c_name, n.c_nationkey, n.c_acctbal, n.c_mktsegment)""",
        "deliveries_with_deletes": _DELIVERY,
        "change_log_with_deletes": """
SELECT o_orderkey, o_custkey, CASE o_orderstatus WHEN 'O' THEN 'placed' ELSE o_orderstatus END AS status, o_totalprice
FROM orders WHERE o_orderpriority <> '5-LOW' OR o_orderstatus <> 'O'""",
        # intervals
        "interval_daily_revenue": _from_daily(f"SELECT {daily_columns} FROM daily WHERE {_inside('revenue_date')}"),
        "interval_weekly_revenue": _from_daily(f"""
SELECT CAST(date_trunc('week', revenue_date) AS DATE) AS week_start, {_ROLLUP} FROM daily
WHERE revenue_date >= DATE '1995-05-01' AND revenue_date < DATE '1997-09-01' GROUP BY 1"""),
        "interval_monthly_revenue": _from_monthly(
            monthly_calendar.replace("LEFT JOIN monthly p", "LEFT JOIN (SELECT * FROM monthly WHERE year_month >= '1995-05') p")
            + " WHERE m.year_month >= '1995-05' AND m.year_month < '1997-09'"
        ),
        "interval_category_revenue": _silver()
        + f"SELECT * FROM ({category_revenue}) WHERE year_month >= '1995-05' AND year_month < '1997-09'",
        "interval_ledger": """
SELECT model, DATE '1995-05-01' AS "start", upto AS "end", 'loaded' AS state, date_diff('day', DATE '1995-05-01', upto) + again AS days_loaded
FROM (VALUES ('daily_revenue', DATE '1997-09-01', 31), ('weekly_revenue', DATE '1997-09-01', 42),
             ('monthly_revenue', DATE '1997-09-01', 31), ('category_revenue', DATE '1997-09-01', 31)) v(model, upto, again)""",
        # quality
        "quality_checks": _ctes(*clean_ctes()) + """
SELECT 'orders' AS table_name, 'amount is positive' AS rule,
       count(*) FILTER (WHERE NOT coalesce(total_amount > 0, FALSE)) AS failing_rows, count(*) AS checked_rows FROM c_orders
UNION ALL
SELECT 'orders', 'creation time is present', count(*) FILTER (WHERE created_at IS NULL), count(*) FROM c_orders
UNION ALL
SELECT 'order_items', 'discount is not full', count(*) FILTER (WHERE NOT coalesce(discount < 100, FALSE)), count(*)
FROM c_items""",
        "unique_emails": """
SELECT customer_id, email FROM (
SELECT c_custkey AS customer_id, 'acct' || CAST(CAST(floor(c_acctbal) AS BIGINT) AS STRING) AS email,
       count(*) OVER (PARTITION BY floor(c_acctbal)) AS claims FROM customer) WHERE claims = 1""",
        "enforce_sales": _silver() + """
SELECT reasons, count(*) AS sales FROM (
SELECT array_to_string(list_filter([
         CASE WHEN channel NOT IN ('web', 'mobile', 'retail', 'b2b') THEN 'channel breaks check' END,
         CASE WHEN NOT quantity > 0 THEN 'quantity breaks check' END,
         CASE WHEN NOT discount_pct BETWEEN 0 AND 100 THEN 'discount_pct breaks check' END], lambda x: x IS NOT NULL), '; ')
       AS reasons
FROM (SELECT CASE l_linestatus WHEN 'F' THEN 'web' ELSE CASE l_returnflag WHEN 'R' THEN 'phone' END END AS channel,
             CAST(l_quantity AS INT) - 1 AS quantity, CAST(l_tax * 1500 AS DECIMAL(5,2)) AS discount_pct FROM lineitem))
GROUP BY 1""",
        # the whole run
        "medallion_daily_revenue": _ctes(*_gold_of_cleaned(), DAILY) + f"SELECT {daily_columns} FROM daily",
        "medallion_customer_ltv": _ctes(*_gold_of_cleaned(), LTV) + "SELECT * FROM ltv",
        "medallion_product_performance": _ctes(*_gold_of_cleaned(), _SALES, PRODUCTS) + "SELECT * FROM performance",
        "increment_daily_revenue": _ctes(*_gold_of_cleaned(), DAILY) + f"SELECT {daily_columns} FROM daily",
        "increment_monthly_revenue": _ctes(*_gold_of_cleaned(), DAILY, MONTHLY) + monthly_calendar,
        "increment_customer_ltv": _ctes(*_gold_of_cleaned(), LTV) + "SELECT * FROM ltv",
        "increment_product_performance": _ctes(*_gold_of_cleaned(), _SALES, PRODUCTS) + "SELECT * FROM performance",
        "increment_category_revenue": _ctes(*_gold_of_cleaned()) + category_revenue,
        "run_log": _ctes(*clean_ctes()) + """
SELECT 'medallion' AS pipeline_name, 'all' AS layer, 'SUCCESS' AS status,
       (SELECT count(*) FROM c_customers) AS customers, (SELECT count(*) FROM c_products) AS products,
       (SELECT count(*) FROM c_orders) AS orders, (SELECT count(*) FROM c_items) AS order_items""",
        "order_summary_view": _ctes(*clean_ctes()) + """
SELECT o.order_id, o.order_date, o.status, o.total_amount, c.full_name AS customer_name, c.email, c.tier, c.country,
       count(i.order_item_id) AS item_count, CAST(sum(i.line_total) AS DECIMAL(28,2)) AS calculated_total
FROM c_orders o JOIN c_customers c ON o.customer_id = c.customer_id JOIN c_items i ON o.order_id = i.order_id
GROUP BY o.order_id, o.order_date, o.status, o.total_amount, c.full_name, c.email, c.tier, c.country""",
        "catalog_query": _from_monthly("SELECT year_month, gross_revenue, order_count FROM monthly WHERE order_count > 100"),
        # plain SQL the warehouse offers
        "month_gaps": _silver() + """
, bounds AS (SELECT date_trunc('month', min(order_date)) AS lo, date_trunc('month', max(order_date)) AS hi FROM silver_orders),
months AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month_start FROM bounds),
sold AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month_start, count(*) AS refunded_orders
         FROM silver_orders WHERE status = 'refunded' GROUP BY 1)
SELECT m.month_start, coalesce(s.refunded_orders, 0) AS refunded_orders
FROM months m LEFT JOIN sold s ON m.month_start = s.month_start""",
        "events_json": events_json,
        "events_json_paths": """
SELECT regexp_replace(t.fullkey, '\\[[0-9]+\\]', '[*]', 'g') AS path,
       CASE t.type WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer' WHEN 'DOUBLE' THEN 'number' WHEN 'VARCHAR' THEN 'string'
            ELSE lower(t.type) END AS kind, count(*) AS n
FROM events, json_tree(events.props) t GROUP BY 1, 2""",
        "events_stream": _closed_days("INTERVAL 1 HOUR"),
        "events_stream_out_of_order": _closed_days("INTERVAL 3 DAYS"),
        "events_stream_late": """
WITH days AS (SELECT *, date_trunc('day', ts) + INTERVAL 1 DAY AS day_end FROM events),
mark AS (SELECT max(ts) FILTER (WHERE day(ts) > 10) - INTERVAL 1 HOUR AS first_mark, max(ts) - INTERVAL 1 HOUR AS last_mark FROM events),
fate AS (SELECT day(ts) <= 10 AND day_end <= first_mark AS late, day_end <= last_mark AS closed FROM days, mark)
SELECT count(*) AS read, count(*) FILTER (WHERE closed AND NOT late) AS counted,
       count(*) FILTER (WHERE NOT closed AND NOT late) AS waiting, count(*) FILTER (WHERE late) AS late FROM fate""",
    }
