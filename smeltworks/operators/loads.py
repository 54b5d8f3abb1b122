"""Idempotent loads: full replace, upsert, insert-or-ignore, range reload, reload of groups, append by batch.

A load is one writing job over Spark's own append or dynamic partition overwrite; a folder whose new content is empty, which
such an overwrite leaves alone, is removed after it. What a load costs:

============== ====================================================
replace_table  all rows
upsert         new rows, all rows of the folders they fall into
replace_range  all rows of the folders that the range touches
replace_groups all rows of the folders that the groups touch
insert_new     new rows, keys of the folders they can be in; for a small batch only of the row groups that can hold them
append_batch   new rows
============== ====================================================
"""

import datetime
from collections.abc import Callable
from dataclasses import dataclass
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltworks.operators.constraints import ConstraintViolation, admit, duplicate_keys, generated_columns
from smeltworks.operators.skew import join_unique
from smeltworks.sources.scratch import materialise, scratch_scope
from smeltworks.sources.tables import TASK_ROWS, StoredTable


@dataclass(frozen=True)
class LoadMetrics:
    """What a load did."""

    processed: int = 0
    inserted: int = 0
    updated: int = 0


def replace_table(table: StoredTable, df: DataFrame, check_keys: bool = False) -> LoadMetrics:
    """Full refresh. Running it again gives the same table, and rows gone from the source are gone here.

    ``check_keys`` looks for double keys in what was written before it takes the table's place. Rows grouped by their key
    need no check.
    """

    def unique(written: DataFrame) -> None:
        if not duplicate_keys(written, list(table.spec.keys)).isEmpty():
            raise ConstraintViolation(f"{table.spec.name}: a key occurs more than once")

    rows = table.with_partition(admit(df, table.spec))
    n = table.replace(rows, F.count("*").alias("n"), check=unique if check_keys else None)["n"]
    return LoadMetrics(n, n, 0)


def upsert(
    table: StoredTable,
    df: DataFrame,
    keys: list[str] | None = None,
    update_cols: list[str] | None = None,
    order_col: str | None = None,
    stored: bool = False,
    checked: bool = False,
) -> LoadMetrics:
    """Insert new keys; on known keys overwrite ``update_cols`` (NULLs too) and keep the rest.

    ``df`` must have one row per key, else the job fails and nothing is written. With ``order_col`` a known
    row is overwritten only by a row that is not older.

    ``stored`` says that ``df`` reads a stored table row by row, so that reading it again is cheap. ``checked`` says that it comes from
    the cleaner of this very table, with one row per key and its rules kept: rows are not checked again, and the first ones, having
    nothing to be merged with, are written as they are. Folder columns
    must depend on the keys or on columns that no upsert changes. In the second case a join of the keys alone (two
    pruned scans; the stored one skips row groups for a small batch) tells in which folders the known ones are. Source and target rows of the touched folders are
    hashed once, by folder and, where folders are large, a salt made from the key; merge and write need no further shuffle.
    """
    spec = table.spec
    keys = keys or list(spec.keys)
    update_cols = list(spec.update_cols) if update_cols is None else update_cols
    moving = spec.laid_out_by() & set(update_cols)
    if moving:
        raise ValueError(f"{spec.name}: an upsert of {sorted(moving)} would move rows between folders")
    source = table.with_partition(df.select(*spec.schema.names) if checked else admit(df, spec))
    cols = table.partition_cols
    if checked and not table.folders():
        n = table.append(source, F.count("*").alias("n"))["n"]
        return LoadMetrics(n, n, 0)
    with scratch_scope(table.spark):
        return _merge(table, source, keys, update_cols, order_col, stored, checked)


def _merge(
    table: StoredTable, source: DataFrame, keys: list[str], update_cols: list[str], order_col: str | None, stored: bool, single: bool
) -> LoadMetrics:
    """``upsert`` of rows with folder columns; ``single`` says that they have one row per key."""
    spec, cols = table.spec, table.partition_cols
    source = source if stored else materialise(source, f"upsert-{spec.name}")
    if table.exists() and not spec.laid_out_by() <= set(keys):
        source = materialise(_where_stored(table, source, keys, False if single else None), f"upsert-{spec.name}")
    touched = table.folders_of(source)
    target = table.read(touched, helpers=True)

    rest = [c for c in spec.schema.names if c not in keys]
    # A first load is measured by its rows, as nothing is stored yet.
    tasks = max(table.tasks_per_folder(), 1 + source.count() // (max(len(touched), 1) * TASK_ROWS))
    salt = F.pmod(F.xxhash64(*keys), F.lit(tasks)).alias("_salt")

    def side(df, new):
        return df.select(*cols, salt, *keys, F.lit(new).alias("_new"), F.struct(*rest).alias("_row"))

    both = side(source, True).unionByName(side(target, False)).repartition(*cols, "_salt")
    merged = both.groupBy(*cols, "_salt", *keys).agg(
        F.first(F.when(F.col("_new"), F.col("_row")), ignorenulls=True).alias("s"),
        F.first(F.when(~F.col("_new"), F.col("_row")), ignorenulls=True).alias("t"),
        F.count_if("_new").alias("_sources"),
    )
    has_s, has_t = F.col("s").isNotNull(), F.col("t").isNotNull()
    take = has_s & ~has_t | (has_s & _not_older(order_col))
    picked = merged.select(*cols, *keys, *[_pick(n, n in update_cols, take).alias(n) for n in rest], "_sources",
                           (has_s & ~has_t).alias("_inserted"), (take & has_t).alias("_updated"))
    # The check rides on the key: no column of a double key gets past it.
    twice = F.raise_error(F.lit(f"{spec.name}: source has more than one row for one key"))
    lone = F.when(F.col("_sources") > 1, twice.cast(spec.schema[keys[0]].dataType)).otherwise(F.col(keys[0]))
    got = table.overwrite(
        picked.withColumn(keys[0], lone).withColumns(generated_columns(spec)),
        F.coalesce(F.sum("_sources"), F.lit(0)).alias("processed"),
        F.count_if("_inserted").alias("inserted"),
        F.count_if("_updated").alias("updated"),
        placed=True,
    )
    return LoadMetrics(got["processed"], got["inserted"], got["updated"])


def _where_stored(table: StoredTable, source: DataFrame, keys: list[str], hot: Literal[False] | None = None) -> DataFrame:
    """``source`` with the folder columns of the stored row of its key, where there is one. ``hot`` as in ``join_unique``."""
    cols = table.partition_cols
    homes = table.lookup(source, keys).select(*keys, *[F.col(c).alias(f"_at_{c}") for c in cols])
    placed = join_unique(source, homes, keys, "left", hot=hot)
    return placed.withColumns({c: F.coalesce(f"_at_{c}", c) for c in cols}).drop(*[f"_at_{c}" for c in cols])


def _not_older(order_col: str | None) -> Column:
    if order_col is None:
        return F.lit(True)
    old, new = F.col(f"t.{order_col}"), F.col(f"s.{order_col}")
    return F.coalesce(new >= old, old.isNull())


def _pick(name: str, overwrite: bool, take: Column) -> Column:
    s, t = F.col(f"s.{name}"), F.col(f"t.{name}")
    if overwrite:
        return F.when(take, s).otherwise(t)
    return F.when(F.col("t").isNotNull(), t).otherwise(s)


def stored_rows(table: StoredTable, wanted: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The stored rows of the keys in ``wanted``, which is read twice. Keys that repeat count once, null and unknown ones find nothing.

    Few keys are looked up through the Bloom filters of the files, many by a join with the whole table.
    """
    keys = keys or list(table.spec.keys)
    return join_unique(table.lookup(wanted, keys), wanted.select(*keys).distinct(), keys, "left_semi", hot=False).select(*table.spec.schema.names)


def insert_new(table: StoredTable, df: DataFrame, keys: list[str] | None = None) -> LoadMetrics:
    """Insert-or-ignore: append rows of unknown keys, leave known ones alone. Of several source rows with one
    key a single one is kept. Existing files stay as they are."""
    keys = keys or list(table.spec.keys)
    with scratch_scope(table.spark):
        source = materialise(table.with_partition(admit(df, table.spec)), f"insert-{table.spec.name}")
        # A known key may lie in any folder unless the key alone decides.
        near = table.folders_of(source) if table.spec.partition and table.spec.laid_out_by() <= set(keys) else None
        known = table.lookup(source, keys, near).select(*keys)
        fresh = join_unique(source, known, keys, "left_anti").dropDuplicates(keys)
        return LoadMetrics(source.count(), table.append(fresh, F.count("*").alias("n"))["n"], 0)


def _rewrite(table: StoredTable, touched: set, outside: DataFrame, source: DataFrame) -> LoadMetrics:
    """The touched folders with the rows ``outside`` of what is replaced, and ``source``; those left without a row go."""
    both = outside.withColumn("_new", F.lit(False)).unionByName(source.withColumn("_new", F.lit(True)))
    emptied = (touched & table.folders()) - table.folders_of(source) - table.folders_of(outside)
    n = table.overwrite(both, F.count_if("_new").alias("n"))["n"]
    table.drop(emptied)
    return LoadMetrics(n, n, 0)


def replace_range(table: StoredTable, df: DataFrame, column: str, start, end) -> LoadMetrics:
    """Delete rows with ``start <= column < end`` and insert ``df`` in their place.

    Only folders that hold rows of the range are rewritten. An empty ``df`` empties the range. Rows of
    ``df`` outside the range fail the job.
    """
    lo, hi = F.lit(start), F.lit(end)

    def inside(c):
        return (F.col(c) >= lo) & (F.col(c) < hi)

    stray = F.raise_error(F.concat(F.lit(f"{column} outside the range: "), F.col(column).cast("string")))
    guarded = admit(df, table.spec).where(F.when(inside(column), True).otherwise(stray.cast("boolean")))
    with scratch_scope(table.spark):
        source = materialise(table.with_partition(guarded), f"range-{table.spec.name}")
        if table.spec.ordered_by == column:
            existing = table.folders_between(start, end)
        else:
            existing = table.folders_of(table.read(helpers=True).where(inside(column)))
        touched = table.folders_of(source) | existing
        outside = table.read(touched, helpers=True).where(~inside(column) | F.col(column).isNull())
        return _rewrite(table, touched, outside, source)


def replace_groups(table: StoredTable, df: DataFrame, groups: DataFrame) -> LoadMetrics:
    """Delete the rows whose ``groups.columns`` occur in ``groups``, one row per group, and insert ``df``, which has rows of these groups
    only. A group that ``df`` has no row of vanishes. Nulls are a group like any other.

    Only folders that hold rows of the groups are rewritten; those are known without reading the table where the folder
    columns are made from columns of ``groups``.
    """
    columns = groups.columns
    with scratch_scope(table.spark):
        source = materialise(table.with_partition(admit(df, table.spec)), f"groups-{table.spec.name}")
        if table.spec.partition and table.spec.laid_out_by() <= set(columns):
            touched = table.folders_of(table.with_partition(groups))
        else:
            hit = join_unique(table.read(helpers=True).select(*{*columns, *table.partition_cols}), groups, columns, "left_semi", null_safe=True)
            touched = table.folders_of(hit) | table.folders_of(source)
        outside = join_unique(table.read(touched, helpers=True), groups, columns, "left_anti", hot=False, null_safe=True)
        return _rewrite(table, touched, outside, source)


def replace_partition(table: StoredTable, df: DataFrame, column: str, value) -> LoadMetrics:
    """Reload the rows of one value of a date column: ``replace_range`` over a single day."""
    return replace_range(table, df, column, value, value + datetime.timedelta(days=1))


def backfill(table: StoredTable, build: Callable[..., DataFrame], column: str, start, end) -> LoadMetrics:
    """Rebuild ``[start, end)`` in one job. ``build(start, end)`` returns the rows of the range."""
    return replace_range(table, build(start, end), column, start, end)


def append_batch(table: StoredTable, df: DataFrame, batch_id: str) -> LoadMetrics:
    """Append a batch once: if the table already has a folder of ``batch_id``, nothing happens. The table must be laid out by
    ``_batch_id``. Rows are numbered on from the greatest number of the batch that was written last."""
    at = table.partition_cols.index("_batch_id")
    if any(f[at] == batch_id for f in table.folders()):
        return LoadMetrics()
    last = table.read(table.newest_folders()).agg(F.max("_id")).first()[0] or 0
    numbered = df.withColumn("_id", F.monotonically_increasing_id() + F.lit(last + 1))
    # All rows go to one folder: tasks write their rows as they come.
    n = table.append(table.with_partition(numbered), F.count("*").alias("n"), placed=True)["n"]
    return LoadMetrics(n, n, 0)
