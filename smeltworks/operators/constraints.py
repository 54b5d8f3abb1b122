"""Defaults, generated columns, NOT NULL, CHECK, UNIQUE and reference rules of a table spec."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltworks.operators.skew import join_unique
from smeltworks.schemas import TableSpec


class ConstraintViolation(ValueError):
    """Raised by checks that need a pass of their own; row checks raise inside the job."""


def add_absent(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Fill columns that ``df`` lacks from their defaults."""
    absent = [c for c in spec.schema.names if c not in df.columns and c not in spec.generated]
    return df.withColumns({c: F.expr(spec.defaults.get(c, "NULL")) for c in absent})


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Add absent columns from their defaults, recompute generated columns, cast and order as declared."""
    df = add_absent(df, spec)
    plain = [f for f in spec.schema if f.name not in spec.generated]
    df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in plain])
    return df.withColumns(generated_columns(spec)).select(*spec.schema.names)


def admit(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``conform``, then the row rules of the table, as a database checks them on every insert."""
    rows = conform(df, spec)
    return enforce(rows, spec) if spec.keys and (spec.not_null or spec.checks) else rows


def generated_columns(spec: TableSpec) -> dict[str, Column]:
    """Generated columns in their declared type; a value that does not fit fails the job."""
    return {c: F.expr(e).cast(spec.schema[c].dataType) for c, e in spec.generated.items()}


def reasons(*broken: Column) -> Column:
    """The non-NULL texts joined by ``; ``, empty if there are none. Plain text, not an array: array functions with
    lambdas would take the projection out of generated code."""
    return F.concat_ws("; ", *broken)


def row_errors(spec: TableSpec) -> Column:
    """The NOT NULL and CHECK rules a row breaks, as text. As in SQL, a check that is NULL holds."""
    broken = [F.when(F.col(c).isNull(), F.lit(f"{c} is null")) for c in spec.not_null]
    broken += [
        F.when(~F.coalesce(F.expr(check), F.lit(True)), F.lit(f"{name} breaks check"))
        for name, check in spec.checks.items()
    ]
    return reasons(*broken)


def enforce(df: DataFrame, spec: TableSpec, on_error: str = "fail") -> DataFrame:
    """Rows that keep the rules of ``spec``.

    ``fail``: the first broken row fails the job that reads the result. ``quarantine``: broken rows are left
    out; get them from ``rejected``.
    """
    return split_errors(df.withColumn("_errors", row_errors(spec)), spec.keys[0], on_error)


def split_errors(df: DataFrame, key: str, on_error: str) -> DataFrame:
    """Drop the ``_errors`` column by policy.

    Under ``fail`` the check rides on the key column, so it is made for exactly the rows that leave here, and in
    every job that reads the key, as all loads do. A filter would be pushed below the joins before it and trip
    over rows that they drop.
    """
    if on_error == "quarantine":
        return df.where("_errors = ''").drop("_errors")
    if on_error != "fail":
        raise ValueError(f"on_error is 'fail' or 'quarantine', not {on_error!r}")
    message = F.concat(F.lit("constraint violation: "), F.col("_errors"))
    failed = F.raise_error(message).cast(df.schema[key].dataType)
    return df.withColumn(key, F.when(F.col("_errors") != "", failed).otherwise(F.col(key))).drop("_errors")


def rejected(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows that break a rule, with the reasons in ``_errors``."""
    return df.withColumn("_errors", row_errors(spec)).where("_errors <> ''")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def contested(batch: DataFrame, target: DataFrame | None, column: str, key: str) -> DataFrame:
    """Values of a unique column claimed by more than one key in batch and target together.

    A value that moves between two keys within one batch is contested as well: accepting it would depend on
    the order in which rows are applied.
    """
    claims = batch.select(key, column)
    if target is not None:
        # Values the batch does not touch are the target's own business.
        touched = target.select(key, column).join(batch.select(column).distinct(), column, "left_semi")
        claims = claims.unionByName(touched.select(key, column))
    return (
        claims.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.min(key).alias("_low"), F.max(key).alias("_high"))
        .where("_low <> _high")
        .select(column)
    )


def enforce_unique(
    batch: DataFrame, target: DataFrame | None, spec: TableSpec, on_error: str = "fail"
) -> DataFrame:
    """Batch rows whose unique columns clash with no other row of batch or target."""
    key = spec.keys[0]
    for column in spec.unique:
        clashes = contested(batch, target, column, key)
        if on_error == "fail":
            if clashes.limit(1).count():
                raise ConstraintViolation(f"{spec.name}.{column} is not unique")
        else:
            batch = join_unique(batch, clashes, [column], "left_anti")
    return batch


def require_non_empty(tables: dict[str, DataFrame]) -> None:
    """Fail if any table has no rows. Each check stops at the first row."""
    empty = [name for name, df in tables.items() if df.isEmpty()]
    if empty:
        raise ConstraintViolation(f"empty tables: {', '.join(empty)}")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, in one job."""
    counts = [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count")) for name, df in tables.items()]
    out = counts[0]
    for one in counts[1:]:
        out = out.unionByName(one)
    return out


def check_quality(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """One row per rule with the number of rows that break it; all rules in a single pass.

    A rule is a SQL predicate that must be true; NULL counts as broken.
    """
    failing = [F.count_if(~F.coalesce(F.expr(p), F.lit(False))).alias(name) for name, p in rules.items()]
    totals = df.agg(F.count("*").alias("_rows"), *failing)
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("failing_rows")) for n in rules])
    return totals.select(F.explode(pairs).alias("r"), F.col("_rows").alias("checked_rows")).select(
        "r.rule", "r.failing_rows", "checked_rows"
    )
