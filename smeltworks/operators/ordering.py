"""Ranks and running positions that never put a whole group into one task."""

from collections.abc import Mapping
from typing import Literal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smeltworks.functions.numbers import ratio
from smeltworks.operators.skew import hot_keys, join_unique, key_hash
from smeltworks.sources.scratch import materialise


def place(df: DataFrame, order: list[Column]) -> DataFrame:
    """Range-partition by ``order`` and record the partition number as ``_part``.

    Range bounds are sampled per execution, so the placement is written out before anything counts on it.
    """
    ranged = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    return materialise(ranged, "placed")


def _same(columns: list[str], other: str) -> Column:
    condition = F.col("_part") == F.col(f"{other}_part")
    for c in columns:
        condition = condition & F.col(c).eqNullSafe(F.col(f"{other}{c}"))
    return condition


def add_ranks(
    df: DataFrame,
    value: str,
    ranks: Mapping[str, list[str]],
    percentiles: Mapping[str, list[str]] | None = None,
) -> DataFrame:
    """Add ``RANK() OVER (PARTITION BY group ORDER BY value DESC NULLS LAST)`` for each name in ``ranks``, and
    ``PERCENT_RANK()`` in ascending order, three decimals, for each name in ``percentiles``.

    ``df`` must be a stored table (a gold table or ``materialise``), as it is read more than once.

    Equal values collapse to one counted row per group, the counted rows are range-partitioned by value, each
    partition ranks its own rows, and the counts of the partitions before it are added. One group has at most one
    carried row per partition.
    """
    percentiles = percentiles or {}
    groups = list(dict.fromkeys(c for g in [*ranks.values(), *percentiles.values()] for c in g))
    counted = df.groupBy(*groups, value).agg(F.count("*").alias("_n"))
    placed = place(counted, [F.col(value).desc_nulls_last()])
    out = placed
    for i, group in enumerate(dict.fromkeys(tuple(g) for g in [*ranks.values(), *percentiles.values()])):
        out = _with_position(out, placed, value, list(group), f"_g{i}")
        above, peers, total = F.col(f"_g{i}_above"), F.col(f"_g{i}_peers"), F.col(f"_g{i}_total")
        for name, g in ranks.items():
            if tuple(g) == group:
                out = out.withColumn(name, above + 1)
        for name, g in percentiles.items():
            if tuple(g) == group:
                below = total - above - peers
                percent = F.coalesce(ratio(below, total - 1, 3, "decimal(4,3)"), F.lit(0).cast("decimal(4,3)"))
                out = out.withColumn(name, percent)
    names = [*ranks, *percentiles]
    keys = [*groups, value]
    return join_unique(df, out.select(*keys, *names), keys, "inner", null_safe=True)


def _with_position(out: DataFrame, placed: DataFrame, value: str, group: list[str], tag: str) -> DataFrame:
    """Per counted row: rows of its group with a greater value, with the same value, and in all."""
    sizes = placed.groupBy("_part", *group).agg(F.sum("_n").alias("_size"))
    # One row per group and partition, so these windows are as short as the number of partitions.
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = sizes.select(
        F.col("_part").alias(f"{tag}_part"),
        *[F.col(c).alias(f"{tag}{c}") for c in group],
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_carried"),
        F.sum("_size").over(whole).alias(f"{tag}_total"),
    )
    local = Window.partitionBy("_part", *group)
    upto = local.orderBy(F.col(value).desc_nulls_last()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    peers = F.sum("_n").over(Window.partitionBy("_part", *group, value))
    return (
        out.withColumns({f"{tag}_peers": peers, "_upto": F.sum("_n").over(upto)})
        .join(carried, _same(group, tag), "inner")
        .withColumn(f"{tag}_above", F.col("_carried") + F.col("_upto") - F.col(f"{tag}_peers"))
        .drop("_carried", "_upto", f"{tag}_part", *[f"{tag}{c}" for c in group])
    )


def add_history(
    df: DataFrame,
    owner: str,
    day: str,
    tie: str,
    hot: DataFrame | Literal[False] | None = None,
) -> DataFrame:
    """Per row of an owner's time line: first and last day, position, and days since the row before.

    ``(owner, day, tie)`` must be unique. Owners are handled by one window each, except hot ones, whose rows
    are range-partitioned by time and stitched together from per-partition edges. ``hot`` is a table of ``hot_keys``,
    made from ``df`` by default; ``False`` means that no owner is hot.
    """
    if hot is None:
        hot = hot_keys(df, [owner])
    if hot is False or hot.isEmpty():
        return _history_by_window(df, owner, day, tie)
    same = key_hash([owner]) == F.col("_hot")
    return _history_by_window(df.join(hot, same, "left_anti"), owner, day, tie).unionByName(
        _history_by_ranges(df.join(hot, same, "left_semi"), owner, day, tie)
    )


def _history_by_window(df: DataFrame, owner: str, day: str, tie: str) -> DataFrame:
    ordered = Window.partitionBy(owner).orderBy(F.col(day).asc_nulls_last(), F.col(tie).asc_nulls_last())
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.select(
        "*",
        F.first(day).over(whole).alias("first_order_date"),
        F.last(day).over(whole).alias("last_order_date"),
        F.row_number().over(ordered).cast("bigint").alias("order_number"),
        F.datediff(day, F.lag(day).over(ordered)).alias("days_since_last_order"),
    )


def _history_by_ranges(df: DataFrame, owner: str, day: str, tie: str) -> DataFrame:
    columns = df.columns
    placed = place(df, [F.col(owner), F.col(day), F.col(tie)])
    edges = placed.groupBy("_part", owner).agg(
        F.count("*").alias("_n"), F.min(day).alias("_lo"), F.max(day).alias("_hi")
    )
    whole = Window.partitionBy(owner)
    parts = whole.orderBy("_part")
    carried = edges.select(
        F.col("_part").alias("_edge_part"),
        F.col(owner).alias(f"_edge_{owner}"),
        F.min("_lo").over(whole).alias("first_order_date"),
        F.max("_hi").over(whole).alias("last_order_date"),
        F.coalesce(F.sum("_n").over(parts.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.lag("_hi").over(parts).alias("_day_before"),
    )
    local = Window.partitionBy("_part", owner).orderBy(day, tie)
    return (
        placed.withColumns({"_rn": F.row_number().over(local), "_lag": F.lag(day).over(local)})
        .join(carried, (F.col("_part") == F.col("_edge_part")) & (F.col(owner) == F.col(f"_edge_{owner}")))
        .select(
            *columns,
            "first_order_date",
            "last_order_date",
            (F.col("_rn") + F.col("_before")).cast("bigint").alias("order_number"),
            F.datediff(day, F.coalesce("_lag", "_day_before")).alias("days_since_last_order"),
        )
    )
