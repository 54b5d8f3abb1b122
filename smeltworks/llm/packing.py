"""Harmonic packing: documents cut into pieces of reciprocal-capacity lengths, each class filling its own sequences.

A piece of class ``k`` is at most ``1/k`` and more than ``1/(k+1)`` of a sequence long, and ``k`` of them fill one, whoever made them.
So a task only has to number its pieces within each class; the counts of earlier tasks turn that number into a sequence.
Since documents may be cut, a remainder that would waste much of its place gives off a piece of exactly the next smaller
reciprocal length, which wastes nothing, and goes on with the rest: two or three pieces bring the waste below ``slack``.
The pieces that do not fill a class's last sequence, a bounded number, are put together first-fit by falling length.
"""

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from smeltworks.llm.common import short_batches, slices
from smeltworks.llm.words import word_encoder
from smeltworks.sources.scratch import materialise

CAPACITY = 4096
END_ID = 2
PIECES = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, class int, task int, rank bigint"


@functools.cache
def cut_rest(rest: int, capacity: int = CAPACITY, slack: int | None = None) -> tuple[int, ...]:
    """Lengths of the pieces of a document's last ``rest < capacity`` ids. ``slack``: ids a full class may leave unused."""
    slack = capacity // 64 if slack is None else slack
    pieces = []
    while rest:
        k = capacity // rest
        if capacity - k * rest <= slack:
            return (*pieces, rest)
        pieces.append(capacity // (k + 1))
        rest -= pieces[-1]
    return tuple(pieces)


def cuts(tokens: int, capacity: int = CAPACITY) -> list[int]:
    return [capacity] * (tokens // capacity) + [*cut_rest(tokens % capacity, capacity)]


def tokenised_pieces(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces with their ids (little-endian unsigned 32-bit) and their number within class and task, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = word_encoder(tokenizer), TaskContext.get().partitionId()
        counts: dict[int, int] = {}
        for batch in batches:
            for part in slices(batch):
                ids, ends = encoder.encode(part.column(1))
                yield _cut(part.column(0).to_pylist(), ids, ends, task, counts, capacity, end_id)
        encoder.forget()

    short_batches(docs.sparkSession)
    source = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return materialise(source.mapInArrow(run, PIECES), "pieces")


def _cut(doc_ids: list, ids: np.ndarray, ends: np.ndarray, task: int, counts: dict[int, int], capacity: int, end_id: int) -> pa.RecordBatch:
    closed = np.insert(ids, ends, end_id).astype("<u4")  # the end id after each document's own
    rows, at = [], 0
    for doc, end in zip(doc_ids, (ends + np.arange(1, len(ends) + 1)).tolist(), strict=True):
        start = 0
        for length in cuts(end - at, capacity):
            k = capacity // length
            rank = counts[k] = counts.get(k, -1) + 1
            rows.append((doc, start, length, closed[at + start : at + start + length].tobytes(), end - at, k, task, rank))
            start += length
        at = end
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "class", "task", "rank"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def assign(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset`` instead of ``class, task, rank``; further columns are carried along.

    Only counts per class and task are gathered, and per class (at most ``capacity`` rows) sent to the driver.
    """
    spark = pieces.sparkSession
    counts = pieces.groupBy("class", "task").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("class").orderBy("task").rowsBetween(W.unboundedPreceding, -1))
    starts = counts.select("class", "task", F.coalesce(before, F.lit(0)).alias("before"))
    totals = sorted((r["class"], r.n) for r in counts.groupBy("class").agg(F.sum("n").alias("n")).collect())
    base, classes = 0, []
    for k, n in totals:
        classes.append((k, base, n - n % k))
        base += n // k
    known = F.broadcast(spark.createDataFrame(classes, "class int, base bigint, full bigint"))
    placed = pieces.join(starts, ["class", "task"]).join(known, "class").withColumn("at", F.col("before") + F.col("rank"))
    full = placed.where("at < full").withColumn("sequence_id", F.col("base") + F.floor(F.col("at") / F.col("class")))
    # Below k pieces of class k are left: at most a few times the capacity over all classes.
    loose = placed.where("at >= full").select("class", "at", "length").repartition(1)
    packed = loose.mapInPandas(functools.partial(_first_fit, base=base, capacity=capacity), "class int, at bigint, sequence_id bigint")
    rest = placed.where("at >= full").join(packed, ["class", "at"])
    whole = full.unionByName(rest)
    earlier = W.partitionBy("sequence_id").orderBy("class", "at").rowsBetween(W.unboundedPreceding, -1)
    return whole.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0))).drop("class", "task", "rank", "base", "full", "before", "at")


def _first_fit(frames: Iterator[pd.DataFrame], base: int, capacity: int) -> Iterator[pd.DataFrame]:
    rows = pd.concat([*frames, pd.DataFrame({"class": [], "at": [], "length": []})]).astype("int64")
    rows = rows.sort_values(["length", "class", "at"], ascending=[False, True, True])
    room, chosen = np.zeros(0, np.int64), []
    for length in rows["length"].tolist():
        fits = np.flatnonzero(room >= length)
        if not len(fits):
            room = np.append(room, capacity)
            fits = [len(room) - 1]
        room[fits[0]] -= length
        chosen.append(base + fits[0])
    yield pd.DataFrame({"class": rows["class"].astype("int32"), "at": rows["at"], "sequence_id": np.array(chosen, np.int64)})


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents, placed: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    A document is its text's ids and the end id; a null or empty text is the end id alone. Each id is in exactly one piece, no
    sequence holds more than ``capacity`` ids, and offsets leave no gaps. Repeated rows are packed each; null ids are carried.
    An empty table gives no rows. Other columns are not read.
    """
    return assign(tokenised_pieces(docs, tokenizer, doc_id, text, capacity, end_id), capacity)


def packed_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """As ``pack``, with the checksum of a piece's ids in place of the ids."""
    pieces = tokenised_pieces(docs, tokenizer).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return assign(pieces).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
