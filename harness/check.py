"""Run registered queries against their SQL counterparts in DuckDB.

    python -m harness.check [sf_dir] [name ...]
"""

import sys
import time

import duckdb

from harness import oracles
from harness.queries import registry
from smeltworks.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def rows(columns, data) -> list[tuple]:
    """Rows as sorted text tuples, columns by name."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(r[i]) for i in order) for r in data)


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(spark, con, name: str, sf_dir: str) -> str:
    """Empty text if both sides agree."""
    df = registry()[name](spark, sf_dir)
    ours = rows(df.columns, df.collect())
    query = oracles.sql().get(name)
    if query is None:
        return "" if ours else "no rows"
    result = con.sql(query)
    theirs = rows(result.columns, result.fetchall())
    if sorted(df.columns) != sorted(result.columns):
        return f"columns {sorted(df.columns)} and {sorted(result.columns)}"
    if ours != theirs:
        only = [r for r in ours if r not in set(theirs)][:2], [r for r in theirs if r not in set(ours)][:2]
        return f"{len(ours)} and {len(theirs)} rows; only here {only[0]}, only there {only[1]}"
    return ""


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = oracle_connection(sf_dir), 0
    for name in sys.argv[2:] or registry():
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main())
