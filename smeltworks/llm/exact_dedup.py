"""Exact dedup over a cuckoo-filter index of live digests.

Texts are reduced to the SHA-256 of their white-space-normalised form in the JVM. Each map task runs its digests through
its own index first, so that a text with very many copies leaves a task as one row; the rows are then dealt by
digest and meet in one index per partition. A filter miss is a new text; a hit is verified against the stored keys of its
content bucket, because a filter also hits on texts it has not seen.
"""

from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltworks.operators.skew import join_unique
from smeltworks.sources.scratch import materialise

SLOTS = 4
MAX_KICKS = 200
# Digests in one index of a task, about 100 MB of Python objects.
INDEX_ENTRIES = 200_000


class CuckooFilter:
    """16-bit fingerprints in buckets of four; a key lives in one of two buckets. Deletion is exact for inserted keys."""

    def __init__(self, buckets: int = 1024):
        self.buckets = buckets  # a power of two
        self.slots = array("H", bytes(2 * SLOTS * buckets))

    def _homes(self, key: bytes) -> tuple[int, int, int]:
        h = int.from_bytes(key[:8], "little")
        mark, first = (h & 0xFFFF) or 1, (h >> 16) & (self.buckets - 1)
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x9E3779B1)) & (self.buckets - 1)

    def contains(self, key: bytes) -> bool:
        mark, i, j = self._homes(key)
        slots = self.slots
        return mark in slots[i * SLOTS : i * SLOTS + SLOTS] or mark in slots[j * SLOTS : j * SLOTS + SLOTS]

    def insert(self, key: bytes) -> bool:
        """False on overflow: the filter has then lost one fingerprint and must be rebuilt from the keys."""
        mark, i, j = self._homes(key)
        if self._put(i, mark) or self._put(j, mark):
            return True
        slots, at = self.slots, j
        for kick in range(MAX_KICKS):
            victim = at * SLOTS + (kick + mark) % SLOTS
            mark, slots[victim] = slots[victim], mark
            at = self._other(at, mark)
            if self._put(at, mark):
                return True
        return False

    def delete(self, key: bytes) -> bool:
        mark, i, j = self._homes(key)
        for bucket in (i, j):
            for s in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.slots[s] == mark:
                    self.slots[s] = 0
                    return True
        return False

    def _put(self, bucket: int, mark: int) -> bool:
        slots = self.slots
        for s in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
            if not slots[s]:
                slots[s] = mark
                return True
        return False


class DigestIndex:
    """Live digests with their smallest id and number of copies; the filter answers first, the stored keys decide."""

    def __init__(self, buckets: int = 1024):
        self.filter = CuckooFilter(buckets)
        self.content: dict[int, list[list]] = {}

    def _find(self, digest: bytes) -> list | None:
        if self.filter.contains(digest):
            for entry in self.content.get(int.from_bytes(digest[8:16], "little"), ()):
                if entry[0] == digest:
                    return entry
        return None

    def add(self, digest: bytes, doc_id: int | None, copies: int = 1) -> bool:
        """True if the digest was not live before. The smallest id wins; null ids only count."""
        entry = self._find(digest)
        if entry is not None:
            entry[2] += copies
            if doc_id is not None and (entry[1] is None or doc_id < entry[1]):
                entry[1] = doc_id
            return False
        self.content.setdefault(int.from_bytes(digest[8:16], "little"), []).append([digest, doc_id, copies])
        if not self.filter.insert(digest):
            self._resize()
        return True

    def remove(self, digest: bytes, copies: int = 1) -> bool:
        """Take copies out; True if that was the last one. Unknown digests are ignored."""
        entry = self._find(digest)
        if entry is None:
            return False
        entry[2] -= copies
        if entry[2] > 0:
            return False
        bucket = int.from_bytes(digest[8:16], "little")
        self.content[bucket].remove(entry)
        if not self.content[bucket]:
            del self.content[bucket]
        return self.filter.delete(digest)

    def live(self) -> Iterator[list]:
        for entries in self.content.values():
            yield from entries

    def _resize(self) -> None:
        buckets = self.filter.buckets
        while True:
            buckets *= 2
            self.filter = CuckooFilter(buckets)
            if all(self.filter.insert(e[0]) for e in self.live()):
                return


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.unhex(F.sha2(normalised(F.col(text)), 256)).alias("digest"))


INDEX_SCHEMA = "digest binary, keep_id bigint, copies bigint"


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(digest, keep_id, copies)``, negative copies for removals, through one index; its live entries come out.

    A full index is put out and begun anew where the digest changes: what a task holds does not grow with its rows. Rows sorted
    by digest, insertions first, therefore come out exact; others may give a digest several rows to be merged later.
    """
    index, size, last = DigestIndex(), 0, None
    for batch in batches:
        for digest, keep_id, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if size >= INDEX_ENTRIES and digest != last:
                yield _live(index)
                index, size = DigestIndex(), 0
            last = digest
            if copies > 0:
                size += index.add(digest, keep_id, copies)
            else:
                size -= index.remove(digest, -copies)
    yield _live(index)


def _live(index: DigestIndex) -> pa.RecordBatch:
    rows = list(index.live())
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())],
        names=["digest", "keep_id", "copies"],
    )


def _merged(parts: DataFrame) -> DataFrame:
    """One row per live digest of ``parts``, dealt by digest."""
    ordered = parts.repartition("digest").sortWithinPartitions("digest", F.desc("copies"))
    return ordered.mapInArrow(_indexed, INDEX_SCHEMA)


def build_index(hashed: DataFrame) -> DataFrame:
    """``(doc_id, digest)`` -> one row ``(digest, keep_id, copies)`` per live digest."""
    single = hashed.select("digest", F.col("doc_id").cast("bigint").alias("keep_id"), F.lit(1).cast("bigint").alias("copies"))
    return _merged(single.mapInArrow(_indexed, INDEX_SCHEMA))


def update_index(index: DataFrame, stored: DataFrame, added: DataFrame | None = None, removed: DataFrame | None = None) -> DataFrame:
    """The index of ``stored`` after inserting ``added`` and then deleting ``removed``, all of ``(doc_id, digest)``.

    A digest leaves the index with its last copy. ``keep_id`` is the smallest live id: where a copy is deleted, it is found again among
    the documents of that digest, and no others are read beyond their digests. A removed row takes one equal row out, null ids
    included; one that is not there takes nothing.
    """
    parts = index.select("digest", "keep_id", "copies")
    if added is not None:
        parts = parts.unionByName(build_index(added))
        stored = stored.select("doc_id", "digest").unionByName(added.select("doc_id", "digest"))
    if removed is None:
        return _merged(parts)
    taken = materialise(removed.groupBy("digest", "doc_id").agg(F.count("*").alias("taken")), "removed")
    touched = join_unique(stored.select("digest", "doc_id"), taken.select("digest").distinct(), ["digest"], "left_semi")
    held = touched.groupBy("digest", "doc_id").agg(F.count("*").alias("held"))
    held = join_unique(held, taken, ["digest", "doc_id"], "left", null_safe=True)
    taken = F.least("held", F.coalesce("taken", F.lit(0)))
    first = F.min(F.when(F.col("held") > taken, F.col("doc_id").cast("bigint")))
    change = materialise(held.groupBy("digest").agg(F.sum(taken).alias("gone"), first.alias("first_id")), "change")
    out = change.where("gone > 0").select("digest", F.lit(None).cast("bigint").alias("keep_id"), (-F.col("gone")).alias("copies"))
    kept = _merged(parts.unionByName(out)).join(change.select("digest", "first_id", F.lit(True).alias("changed")), "digest", "left")
    return kept.select("digest", F.when(F.col("changed"), F.col("first_id")).otherwise(F.col("keep_id")).alias("keep_id"), "copies")


def seen(index: DataFrame, hashed: DataFrame) -> DataFrame:
    """``hashed`` with ``is_live``: whether the index holds the digest."""
    live = index.select("digest", F.lit(True).alias("is_live"))
    return hashed.join(live, "digest", "left").withColumn("is_live", F.coalesce("is_live", F.lit(False)))


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after replacing each run of ASCII white space by one space; null counts as empty. The
    smallest id of a group stays. Rows that repeat an id and its text all carry the verdict of that id. A row with a
    null id never stands for a group that has a real id; in a group of null ids alone ``keep_id`` is null and all are kept.
    An empty table gives no rows. Other columns are not read.
    """
    hashed = materialise(digests(docs, doc_id, text), "digests")
    groups = build_index(hashed)
    return hashed.join(groups, "digest").select(
        "doc_id",
        "keep_id",
        F.col("copies").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
