"""Driver tables as silver tables and as dirty bronze batches.

Each mapping is one SQL text that Spark and DuckDB read alike, so both sides of a check see the same input.
All rows of the driver tables are used. Dirt depends on the data (nation, size, day of month), not on a sample.
So that rules can be told apart, the orders of one month are dated in the next one, which leaves a month without
revenue, and the items of some products are booked on others, which leaves products unsold and tied in rank.
"""

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

SILVER_SQL = {
    "silver_customers": """
SELECT c.c_custkey AS customer_id, c.c_name AS full_name, lower(c.c_name) || '@example.com' AS email,
       CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'silver' WHEN 'MACHINERY' THEN 'gold'
            WHEN 'HOUSEHOLD' THEN 'platinum' ELSE 'bronze' END AS tier,
       upper(n.n_name) AS country
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "silver_orders": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
       CASE WHEN year(o_orderdate) = 1996 AND month(o_orderdate) = 7 THEN CAST(o_orderdate AS DATE) + 31
            ELSE CAST(o_orderdate AS DATE) END AS order_date,
       CASE WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'O' THEN 'shipped'
            WHEN o_orderpriority = '1-URGENT' THEN 'refunded' ELSE 'cancelled' END AS status,
       CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount
FROM orders""",
    "silver_items": """
SELECT l_orderkey AS order_id, CASE WHEN l_partkey % 20 = 19 THEN l_partkey - 1 ELSE l_partkey END AS product_id,
       CAST(l_quantity AS INT) AS quantity,
       CAST(l_extendedprice AS DECIMAL(10,2)) AS unit_price,
       CAST(CAST(l_quantity AS INT) * CAST(l_extendedprice AS DECIMAL(10,2))
            * (1 - CAST(l_discount AS DECIMAL(5,2))) AS DECIMAL(12,2)) AS line_total
FROM lineitem""",
    "silver_products": """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
       CAST(p_retailprice AS DECIMAL(10,2)) AS price,
       CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 0.60 AS DECIMAL(10,2)) AS cost
FROM part""",
}

BATCH_1, BATCH_2 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"

# Two batches per table: everything first, later a correction of the rows that changed.
BRONZE_SQL = {
    "raw_customers": """
SELECT batch * 1000000000000 + c_custkey AS _id,
       CAST(CASE batch WHEN 1 THEN '2024-01-01 00:00:00' ELSE '2024-01-02 00:00:00' END AS TIMESTAMP) AS _ingested_at,
       'customers.csv' AS _source_file, 'batch-' || CAST(batch AS STRING) AS _batch_id,
       CASE WHEN c_nationkey = 1 AND c_mktsegment = 'BUILDING' THEN NULL
            WHEN c_nationkey = 2 AND c_mktsegment = 'BUILDING' THEN 'bad-id'
            WHEN c_nationkey = 3 AND batch = 2
            THEN upper('0c0c0c02-0000-4000-8000-' || lpad(CAST(c_custkey AS STRING), 12, '0'))
            ELSE '0c0c0c02-0000-4000-8000-' || lpad(CAST(c_custkey AS STRING), 12, '0') END AS customer_id,
       ' ' || split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) || ' ' AS last_name,
       CASE WHEN c_nationkey = 4 AND batch = 2 THEN '   '
            ELSE ' ' || CASE batch WHEN 1 THEN '' ELSE 'New.' END || replace(c_name, '#', '.') || '@Example.COM ' END
            AS email,
       ' nation ' || CAST(c_nationkey AS STRING) AS country,
       CASE WHEN c_nationkey = 5 THEN NULL ELSE '2021-0' || CAST(1 + c_nationkey // 3 AS STRING) || '-15' END
            AS signup_date,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN ' Silver' WHEN 'MACHINERY' THEN 'GOLD'
            WHEN 'HOUSEHOLD' THEN 'Platinum ' ELSE 'bronze' END AS tier
FROM (SELECT 1 AS batch, * FROM customer UNION ALL SELECT 2 AS batch, * FROM customer WHERE c_mktsegment <> 'MACHINERY') b""",
    "raw_products": """
SELECT batch * 1000000000000 + p_partkey AS _id,
       CAST(CASE batch WHEN 1 THEN '2024-01-01 00:00:00' ELSE '2024-01-02 00:00:00' END AS TIMESTAMP) AS _ingested_at,
       'products.csv' AS _source_file, 'batch-' || CAST(batch AS STRING) AS _batch_id,
       CASE WHEN p_size = 1 THEN NULL WHEN p_size = 2 THEN 'bad-id'
            ELSE '0d0d0d03-0000-4000-8000-' || lpad(CAST(p_partkey AS STRING), 12, '0') END AS product_id,
       CASE WHEN p_size = 3 THEN NULL ELSE ' ' || p_name || ' ' END AS product_name,
       CASE WHEN p_size = 4 THEN NULL ELSE p_type || ' ' END AS category,
       CASE WHEN p_size = 5 THEN 'N/A' WHEN p_size = 6 THEN '-5' WHEN p_size = 7 THEN '950.' WHEN p_size = 8 THEN NULL
            ELSE CAST(CAST(p_retailprice + batch AS DECIMAL(10,2)) AS STRING) END AS price,
       CASE WHEN p_size = 9 THEN ' 5' ELSE CAST(CAST(p_retailprice * 0.5 AS DECIMAL(12,4)) AS STRING) END AS cost,
       CASE WHEN p_size = 10 THEN '7.5' WHEN p_size = 11 THEN '' ELSE CAST(p_size * 10 AS STRING) END AS stock_qty
FROM (SELECT 1 AS batch, * FROM part UNION ALL SELECT 2 AS batch, * FROM part WHERE p_type = 'ECONOMY') b""",
    "raw_orders": """
SELECT batch * 1000000000000 + o_orderkey AS _id,
       CAST(CASE batch WHEN 1 THEN '2024-01-01 00:00:00' ELSE '2024-01-02 00:00:00' END AS TIMESTAMP) AS _ingested_at,
       'orders.csv' AS _source_file, 'batch-' || CAST(batch AS STRING) AS _batch_id,
       CASE WHEN day(o_orderdate) = 1 THEN NULL WHEN day(o_orderdate) = 2 THEN 'bad-id'
            WHEN day(o_orderdate) = 3 AND batch = 2
            THEN upper('0a0d0e01-0000-4000-8000-' || lpad(CAST(o_orderkey AS STRING), 12, '0'))
            ELSE '0a0d0e01-0000-4000-8000-' || lpad(CAST(o_orderkey AS STRING), 12, '0') END AS order_id,
       CASE WHEN day(o_orderdate) = 4 THEN 'ffffffff-0000-4000-8000-' ELSE '0c0c0c02-0000-4000-8000-' END
            || lpad(CAST(o_custkey AS STRING), 12, '0') AS customer_id,
       CASE WHEN day(o_orderdate) = 11 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS order_date,
       CASE WHEN batch = 2 OR o_orderstatus = 'F' THEN ' Completed ' WHEN o_orderstatus = 'O' THEN 'SHIPPED'
            ELSE 'cancelled' END AS status,
       CASE WHEN day(o_orderdate) = 5 THEN 'N/A' WHEN day(o_orderdate) = 6 THEN '-5'
            WHEN day(o_orderdate) = 7 THEN '12.' WHEN day(o_orderdate) = 8 THEN NULL
            ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) END AS total_amount,
       CASE WHEN day(o_orderdate) = 9 THEN NULL ELSE ' usd ' END AS currency,
       CASE WHEN day(o_orderdate) = 10 THEN NULL
            ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) || CASE batch WHEN 1 THEN ' 12:30:00' ELSE ' 18:00:00' END END
            AS created_at
FROM (SELECT 1 AS batch, * FROM orders UNION ALL SELECT 2 AS batch, * FROM orders WHERE o_orderpriority = '1-URGENT') b""",
    "raw_order_items": """
SELECT batch * 1000000000000 + l_orderkey * 10 + l_linenumber AS _id,
       CAST(CASE batch WHEN 1 THEN '2024-01-01 00:00:00' ELSE '2024-01-02 00:00:00' END AS TIMESTAMP) AS _ingested_at,
       'items.csv' AS _source_file, 'batch-' || CAST(batch AS STRING) AS _batch_id,
       CASE WHEN day(l_shipdate) = 1 THEN NULL WHEN day(l_shipdate) = 2 THEN 'bad-id'
            ELSE lpad(CAST(l_orderkey AS STRING), 8, '0') || '-' || lpad(CAST(l_linenumber AS STRING), 4, '0') || '-4000-'
                 || lpad(CAST(l_suppkey AS STRING), 4, '0') || '-' || lpad(CAST(l_partkey AS STRING), 12, '0') END
            AS order_item_id,
       CASE WHEN day(l_shipdate) = 3 THEN 'ffffffff-0000-4000-8000-' ELSE '0a0d0e01-0000-4000-8000-' END
            || lpad(CAST(l_orderkey AS STRING), 12, '0') AS order_id,
       '0d0d0d03-0000-4000-8000-' || lpad(CAST(l_partkey AS STRING), 12, '0') AS product_id,
       CASE WHEN day(l_shipdate) = 4 THEN 'x' WHEN day(l_shipdate) = 5 THEN NULL
            ELSE CAST(CAST(l_quantity AS INT) + batch AS STRING) END AS quantity,
       CASE WHEN day(l_shipdate) = 6 THEN '-1' ELSE CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS STRING) END
            AS unit_price,
       CASE WHEN day(l_shipdate) = 7 THEN '150' WHEN day(l_shipdate) = 8 THEN NULL
            ELSE CAST(CAST(abs(l_discount) * 100 AS DECIMAL(5,2)) AS STRING) END AS discount
FROM (SELECT 1 AS batch, * FROM lineitem UNION ALL SELECT 2 AS batch, * FROM lineitem WHERE l_returnflag = 'R') b""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    for name in TABLES:
        if name in sql:
            table(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(sql)


def silver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table in silver shape: ``customers``, ``orders``, ``items`` or ``products``."""
    return _run(spark, sf_dir, SILVER_SQL[f"silver_{name}"])


def bronze(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Both dirty batches of a raw table."""
    return _run(spark, sf_dir, BRONZE_SQL[name].replace("//", "DIV"))
