"""Joins to a unique side that stay balanced when one key holds a large share of the rows."""

from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltworks.sources.scratch import materialise

# A key is split into parts of about this many rows; one task handles fewer with ease.
HOT_ROWS = 1_000_000
# Sampled rows that stand for a hot key: enough to tell it from its neighbours.
SAMPLE_HITS = 100


def key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(_hot, _salts)``: hashes of the keys worth splitting, and into how many parts, as a stored table.

    Reads a sample of the key columns: one pruned scan and, at the default of one row in ten thousand, a small
    shuffle. The sample decides only where rows travel: a key missed or added here changes no result.
    """
    fraction = min(1.0, SAMPLE_HITS / hot_rows)
    sampled = df.select(*keys).sample(fraction=fraction, seed=17)
    counted = sampled.select(key_hash(keys).alias("_hot")).groupBy("_hot").count()
    salts = F.ceil(F.col("count") / (fraction * hot_rows)).cast("int") + 1
    return materialise(counted.where(F.col("count") >= hot_rows * fraction).select("_hot", salts.alias("_salts")), "hot")


def join_unique(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "inner",
    hot: DataFrame | Literal[False] | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Join to a side that has at most one row per key (``inner``, ``left``, ``left_semi``, ``left_anti``).

    Rows of hot keys get a salt from a hash of the whole row, and the one matching right row is repeated per
    salt of its key; all other keys have salt 0. ``hot`` is a table of ``hot_keys``; by default it is made from
    ``left``, and ``False`` means that no key is hot. The right side grows by one row per ``HOT_ROWS`` left rows at most.
    """
    for k in keys:
        if left.schema[k].dataType != right.schema[k].dataType:
            raise TypeError(f"join key {k}: {left.schema[k].dataType} and {right.schema[k].dataType}")
    if hot is None:
        hot = hot_keys(left, keys)
    right = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    matched = [
        F.col(k).eqNullSafe(F.col(f"_right_{k}")) if null_safe else F.col(k) == F.col(f"_right_{k}")
        for k in keys
    ]
    if hot is not False and not hot.isEmpty():
        row_salt = F.pmod(F.xxhash64(*left.columns), F.coalesce("_salts", F.lit(1))).cast("int")
        left = left.withColumn("_hash", key_hash(keys)).join(hot, F.col("_hash") == F.col("_hot"), "left")
        left = left.withColumn("_salt", row_salt).drop("_hash", "_hot", "_salts")
        copies = hot.select(F.col("_hot").alias("_right_hot"), F.col("_salts").alias("_copies"))
        right = right.withColumn("_right_hash", key_hash([f"_right_{k}" for k in keys]))
        right = right.join(copies, F.col("_right_hash") == F.col("_right_hot"), "left")
        salts = F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1)
        right = right.withColumn("_right_salt", F.explode(salts)).drop("_right_hash", "_right_hot", "_copies")
        matched.append(F.col("_salt") == F.col("_right_salt"))
    condition = matched[0]
    for part in matched[1:]:
        condition = condition & part
    joined = left.join(right, condition, how)
    return joined.drop("_salt", "_right_salt", *[f"_right_{k}" for k in keys])


def orphans(child: DataFrame, parent: DataFrame, keys: list[str], hot: DataFrame | Literal[False] | None = None) -> DataFrame:
    """Rows of ``child`` whose key has no row in ``parent``.

    ``hot`` as in ``join_unique``; give it where ``child`` is not a stored table, which would be computed once more for its sample.
    """
    return join_unique(child, parent.select(*keys), keys, "left_anti", hot=hot)
