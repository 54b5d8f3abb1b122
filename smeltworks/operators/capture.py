"""Change capture: what differs between two snapshots, and loads that take changes, deletes among them.

A tracked table keeps, beside its own columns, when a row was last changed and whether that was a delete. The row of a deleted
key stays as a tombstone without data: without it, a change that arrives late could not be told from a new row.
"""

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltworks.operators.dedup import latest_by
from smeltworks.operators.loads import LoadMetrics, upsert
from smeltworks.schemas import TableSpec, columns
from smeltworks.sources.runs import RunLog
from smeltworks.sources.scratch import materialise
from smeltworks.sources.tables import StoredTable

INSERT, UPDATE, DELETE = "insert", "update", "delete"


def tracked(spec: TableSpec) -> TableSpec:
    """``spec`` with the columns of change tracking. Row rules hold for live rows; a change brings a whole row, but for the
    columns that its folder is made from."""
    alive = {c: f"_deleted OR ({rule})" for c, rule in spec.checks.items()}
    alive |= {f"{c} present": f"_deleted OR {c} IS NOT NULL" for c in spec.not_null if c not in spec.keys}
    fixed = {*spec.keys, *spec.generated, *spec.laid_out_by()}
    return spec.like(
        f"tracked_{spec.name}",
        schema=columns("\n".join([*(f"{f.name} {f.dataType.simpleString()}" for f in spec.schema), "_changed_at timestamp", "_deleted boolean"])),
        not_null=(*spec.keys, "_changed_at", "_deleted"),
        checks=alive,
        defaults={**spec.defaults, "_deleted": "false"},
        update_cols=(*(c for c in spec.schema.names if c not in fixed), "_changed_at", "_deleted"),
    )


def live(table: StoredTable) -> DataFrame:
    """The rows of a tracked table that are not deleted, without the columns of change tracking."""
    return table.read().where("NOT _deleted").drop("_changed_at", "_deleted")


def _fingerprint(names: list[str]) -> Column:
    """128 bits of the values of a row. Each value comes with a flag, as hashing skips nulls."""
    flagged = [x for c in names for x in (F.col(c), F.col(c).isNull())]
    return F.struct(F.xxhash64(F.lit(0), *flagged), F.xxhash64(F.lit(1), *flagged))


def snapshot_changes(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that turn ``before`` into ``after``: the columns of ``after`` and ``_op``.

    Inserts and updates have their new values, deletes only their key. Rows that are equal in all columns of ``after`` give
    nothing. Both sides must have one row per key, else the job fails; null keys are keys like others. Of the old
    rows only keys and a hash are shuffled.
    """
    names = after.columns
    rest = [c for c in names if c not in keys]
    new = after.select(*keys, F.lit(True).alias("_new"), _fingerprint(rest).alias("_print"), F.struct(*rest).alias("_row"))
    nothing = F.lit(None).cast(new.schema["_row"].dataType)
    cast = before.select(*[F.col(c).cast(after.schema[c].dataType).alias(c) for c in names])
    old = cast.select(*keys, F.lit(False).alias("_new"), _fingerprint(rest).alias("_print"), nothing.alias("_row"))
    met = new.unionByName(old).groupBy(*keys).agg(
        F.first(F.when(F.col("_new"), F.col("_row")), ignorenulls=True).alias("_row"),
        F.first(F.when(F.col("_new"), F.col("_print")), ignorenulls=True).alias("_after"),
        F.first(F.when(~F.col("_new"), F.col("_print")), ignorenulls=True).alias("_before"),
        F.greatest(F.count_if("_new"), F.count_if(~F.col("_new"))).alias("_rows"),
    )
    twice = F.raise_error(F.lit("a snapshot has more than one row for one key")).cast("string")
    op = (
        F.when(F.col("_rows") > 1, twice)
        .when(F.col("_before").isNull(), INSERT)
        .when(F.col("_after").isNull(), DELETE)
        .when(F.col("_before") != F.col("_after"), UPDATE)
    )
    changed = met.withColumn("_op", op).where("_op IS NOT NULL")
    return changed.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in names], "_op")


def apply_changes(table: StoredTable, changes: DataFrame) -> LoadMetrics:
    """Apply a log of changes ``(columns, _op, _changed_at)`` to a tracked table.

    Of several changes of a key the latest counts, of equally late ones a delete, else the one whose values are greater. A
    change older than the stored row does nothing, whether that row is alive or deleted; so changes may come late, twice and in
    any order. A delete of an unknown key leaves a tombstone.
    """
    keys = list(table.spec.keys)
    gone = F.col("_op") == DELETE
    values = [c for c in changes.columns if c not in (*keys, "_op", "_changed_at")]
    rows = changes.select(*keys, *[F.when(~gone, F.col(c)).alias(c) for c in values], "_changed_at", gone.alias("_deleted"))
    latest = latest_by(rows, keys, ["_changed_at", "_deleted", *sorted(values)])
    return upsert(table, latest, order_col="_changed_at")


def load_delivery(table: StoredTable, df: DataFrame, delivered_at: datetime.datetime, log: RunLog) -> LoadMetrics:
    """Take a full delivery: rows that it lacks are deleted, rows that differ updated, new ones inserted.

    Only what changed is written. The same delivery again changes nothing. A delivery that is older than the last one taken is left
    out whole, since it cannot tell what happened after it.
    """
    pipeline, started = f"delivery_{table.spec.name}", datetime.datetime.now(datetime.timezone.utc)
    if delivered_at < log.last_watermark(pipeline):
        return LoadMetrics()
    current = live(table).select(*df.columns)
    changes = materialise(snapshot_changes(current, df, list(table.spec.keys)), "changes")
    metrics = LoadMetrics()
    if not changes.isEmpty():
        metrics = apply_changes(table, changes.withColumn("_changed_at", F.lit(delivered_at)))
    log.log_run(pipeline, "silver", "SUCCESS", metrics, started_at=started, watermark=delivered_at)
    return metrics


def purge(table: StoredTable, older_than: datetime.datetime) -> int:
    """Remove tombstones of before ``older_than``, to be called when no change from before that time can arrive any more.

    Only folders that hold such tombstones are rewritten; a folder of nothing else goes. Returns how many rows went.
    """
    rows = table.read(helpers=True)
    stale = F.col("_deleted") & (F.col("_changed_at") < F.lit(older_than))
    count = rows.where(stale).count()
    if count:
        touched = table.folders_of(rows.where(stale))
        rest = table.read(touched, helpers=True).where(~stale)
        left = table.folders_of(rest)
        table.overwrite(rest)
        table.drop(touched - left)
    return count
