"""Deal rows into cells for a self-join: rows that share a key meet, and a key with too many rows is cut up exactly."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltworks.sources.scratch import materialise

CELL_ROWS = 512


def deal(placed: DataFrame, keys: list[str], by: str, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``placed`` with ``lo, hi, chunk``, partitioned by ``keys, lo, hi``.

    The rows of a key with more than ``cell_rows`` rows are hashed (``by``) into chunks, and every pair of chunks
    ``lo <= hi`` becomes a cell that holds the rows of both, so that no task gets all rows of a key and every pair of rows still meets.
    """
    hot = placed.groupBy(*keys).count().where(F.col("count") > cell_rows)
    hot = materialise(hot.select(*keys, F.ceil(F.col("count") / cell_rows).cast("int").alias("chunks")), "hot")
    if hot.isEmpty():
        zero = F.lit(0)
        cut = placed.select("*", zero.alias("lo"), zero.alias("hi"), zero.alias("chunk"))
    else:
        cut = placed.join(hot, keys, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
        cut = cut.withColumn("chunk", F.pmod(F.xxhash64(by), F.col("chunks")).cast("int"))
        cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        cut = cut.select(*placed.columns, F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"), "chunk")
    return cut.repartition(*keys, "lo", "hi")


def cell_ranges(keys: list[np.ndarray], lo: np.ndarray, hi: np.ndarray, side: np.ndarray) -> np.ndarray:
    """``(a from, a to, b from, b to)`` per cell, for rows sorted by keys, lo, hi, side. Equal ranges: a chunk against itself."""
    columns = [*keys, lo, hi]
    fresh = np.r_[True, np.any([c[1:] != c[:-1] for c in columns], axis=0)]
    begin = np.flatnonzero(fresh)
    end = np.r_[begin[1:], len(lo)]
    ones = np.r_[0, np.cumsum(side)]
    middle = end - (ones[end] - ones[begin])  # where the second chunk of a cell begins
    own = (lo == hi)[begin]
    return np.stack([begin, np.where(own, end, middle), np.where(own, begin, middle), end])
