"""Connected components over a table of links."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltworks.sources.scratch import materialise


def merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels of positions after linking positions ``a`` and ``b``; a label is the smallest position of its class."""
    while True:
        la, lb = labels[a], labels[b]
        open_ = la != lb
        if not open_.any():
            return labels
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        least = np.minimum(la, lb)
        np.minimum.at(labels, la, least)
        np.minimum.at(labels, lb, least)
        while True:
            jumped = labels[labels]
            if (jumped == labels).all():
                break
            labels = jumped


def connected_components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` of bigint ids -> ``(id, component)`` for every id that has a link to another id.

    A component is named by its smallest id. Each round moves every node's larger neighbours, then its smaller ones,
    to the smallest neighbour, and stops when the links no longer change. The number of links never grows. Minima
    are partial aggregates, so a node with very many links costs one row per task; the joins back to
    the links are plain equi-joins, which adaptive execution splits for such a node. Null ids are ignored.
    """
    ends = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    now = materialise(links.where("a <> b").select(*ends).distinct(), "links")
    before = None
    while (state := _state(now)) != before:
        if not state[0]:
            break
        before = state
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialise(large, "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = materialise(moved.union(least).select(*ends).distinct(), "links")
    return now.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component")).union(
        now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )


def _state(links: DataFrame) -> tuple[int, int]:
    """Count and order-free checksum of the links: two numbers, whatever their number."""
    h = F.xxhash64("a", "b")
    row = links.agg(F.count("*"), F.bit_xor(h), F.sum(h.bitwiseAND(F.lit((1 << 31) - 1)))).first()
    return (row[0], row[1], row[2])
