"""Parquet tables in partition folders, written by Spark's append and dynamic partition overwrite.

Spark stages what a job writes and moves it into place when the whole job has succeeded: a job that fails leaves the table
as it was. A table is read afresh after a load; a frame made before it may name files that are gone. One writer per table.
"""

import functools
import operator
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltworks.schemas import TableSpec
from smeltworks.sources.scratch import session_setting

# Fixed value: the folder of rows whose partition value is null.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
# A task merges and writes about this much of a folder. Read and sorted, rows take some ten times their bytes in files.
TASK_BYTES = 16 << 20
TASK_ROWS = 500_000
# Up to so many keys are looked up by their values, so that files and row groups without them are skipped; more are joined.
LOOKUP_KEYS = 500
# How often a row group that lacks a key is read for it. So low that a lookup of LOOKUP_KEYS keys still skips most.
BLOOM_MISSES = 1e-5
# Spark hands a list of this length to the reader value by value, and a longer one as a range only.
_IN_LIST = 10

Folder = tuple[str, ...]

_FIELDS: dict[tuple, list[T.StructField]] = {}


def _helper_fields(spark: SparkSession, spec: TableSpec) -> list[T.StructField]:
    """Folder columns that are not columns of the table, with the types of their expressions."""
    helper = {c: e for c, e in spec.layout().items() if c not in spec.schema.names}
    known = (spec.schema.simpleString(), *helper.items())
    if known not in _FIELDS:
        columns = [F.expr(e).alias(c) for c, e in helper.items()]
        _FIELDS[known] = spark.createDataFrame([], spec.schema).select(*columns).schema.fields if helper else []
    return _FIELDS[known]


class StoredTable:
    """A table at a path, declared by a spec."""

    def __init__(self, spark: SparkSession, path: str, spec: TableSpec):
        self.spark, self.path, self.spec = spark, path.rstrip("/"), spec
        self._jvm_path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._jvm_path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        self.partition_cols = list(spec.layout())
        self.full_schema = T.StructType([*spec.schema.fields, *_helper_fields(spark, spec)])

    # -- reading

    def exists(self) -> bool:
        """Whether anything was ever written, be it no rows."""
        return self._fs.exists(self._jvm_path(self.path))

    def _places(self) -> dict[Folder, object]:
        """Folders by their values, as text and unescaped."""
        if not self.exists():
            return {}
        depth = len(self.partition_cols)
        found = self._fs.globStatus(self._jvm_path("/".join([self.path, *["*=*"] * depth]))) or []
        names = {s.getPath(): s.getPath().toUri().getPath().split("/")[-depth:] for s in found}
        return {tuple(unquote(n.partition("=")[2]) for n in levels): path for path, levels in names.items()}

    def folders(self) -> set[Folder]:
        return set(self._places())

    def folders_between(self, start, end) -> set[Folder]:
        """Folders that can hold ``start <= spec.ordered_by < end``, by their names alone."""
        (expression,) = self.spec.layout().values()
        kind = T.StructType([self.spec.schema[self.spec.ordered_by]])
        bounds = self.spark.createDataFrame([(start,), (end,)], kind).select(F.expr(expression).cast("string").alias("v"))
        low, high = sorted(row.v for row in bounds.collect())
        return {f for f in self.folders() if low <= f[0] <= high}

    def _named(self) -> Column:
        """The folder of a row as one text, from folder columns only: a filter on it prunes folders."""
        return F.concat_ws("\1", *[F.coalesce(F.col(c).cast("string"), F.lit(NULL_FOLDER)) for c in self.partition_cols])

    def read(self, folders: set[Folder] | None = None, helpers: bool = False) -> DataFrame:
        """The rows, of the given folders only if ``folders`` is set. ``helpers`` keeps folder columns that are not columns of the table."""
        if self.exists() and folders != set():
            df = self.spark.read.schema(self.full_schema).option("basePath", self.path).parquet(self.path)
            if folders is not None:
                df = df.where(self._named().isin(["\1".join(f) for f in sorted(folders)]))
        else:
            # Without rows from Python, for which every executor would start a process.
            nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.full_schema]
            df = self.spark.range(1).select(*nothing).where(F.lit(False))
        return df.select(*(self.full_schema.names if helpers else self.spec.schema.names))

    def lookup(self, source: DataFrame, keys: list[str], folders: set[Folder] | None = None) -> DataFrame:
        """``read(folders, helpers=True)`` for finding the keys of ``source``: rows of other keys may be among the result.

        A single key with at most ``LOOKUP_KEYS`` values in ``source`` becomes a filter on these values, which the Bloom filters
        of the files answer. Otherwise all rows of the folders come back. Null keys find nothing.
        """
        rows = self.read(folders, helpers=True)
        if len(keys) > 1:
            return rows
        (key,) = keys
        values = source.select(key).where(F.col(key).isNotNull()).distinct().limit(LOOKUP_KEYS + 1).collect()
        if len(values) > LOOKUP_KEYS:
            return rows
        values = sorted(r[0] for r in values)
        parts = [F.col(key).isin(values[i : i + _IN_LIST]) for i in range(0, len(values), _IN_LIST)]
        return rows.where(functools.reduce(operator.or_, parts, F.lit(False)))

    # -- writing

    def with_partition(self, df: DataFrame) -> DataFrame:
        """Add the folder columns."""
        return df.withColumns({c: F.expr(e) for c, e in self.spec.layout().items() if c not in self.spec.schema.names})

    def folders_of(self, df: DataFrame) -> set[Folder]:
        """Folders that occur in rows with folder columns: at most as many as the table has."""
        rows = df.select(*[F.col(c).cast("string") for c in self.partition_cols]).distinct().collect()
        return {tuple(NULL_FOLDER if v is None else v for v in r) for r in rows}

    def tasks_per_folder(self) -> int:
        """Into how many tasks the rows of a folder of average size are split."""
        count = len(self._places())
        return 1 + self._fs.getContentSummary(self._jvm_path(self.path)).getLength() // (count * TASK_BYTES) if count else 1

    def append(self, df: DataFrame, *metrics: Column, placed: bool = False) -> dict:
        """Add rows with folder columns. Unless ``placed``, they are rebalanced by folder: small folders get one file, and a folder
        with a large share of the rows is split over tasks.

        Returns the ``metrics``, taken in the writing stage itself, where a task that runs again is counted once. They may
        use columns of ``df`` that are not stored.
        """
        return self._written(df, "append", metrics, placed)

    def overwrite(self, df: DataFrame, *metrics: Column, placed: bool = False) -> dict:
        """Replace the folders that occur in ``df``, which may read them; all others stay as they are."""
        return self._written(df, "overwrite", metrics, placed)

    def replace(self, df: DataFrame, *metrics: Column, check=None) -> dict:
        """Replace all rows, which ``df`` may read. The new rows are written beside the table and take its place when they
        are complete and ``check``, given a frame of them, has not raised."""
        beside = StoredTable(self.spark, f"{self.path}.new-{uuid.uuid4().hex}", self.spec)
        try:
            got = beside.append(df, *metrics)
            if check is not None:
                check(beside.read())
            old, own = self._jvm_path(f"{beside.path}-old"), self._jvm_path(self.path)
            if self.exists():
                self._fs.rename(own, old)
            if not self._fs.rename(self._jvm_path(beside.path), own):
                raise RuntimeError(f"{self.path}: the new rows in {beside.path} could not take its place; the old ones are in {old}")
            self._fs.delete(old, True)
        except Exception:
            if self.exists():
                self._fs.delete(self._jvm_path(beside.path), True)
            raise
        return got

    def drop(self, folders: set[Folder]) -> None:
        """Remove folders: what a dynamic overwrite leaves when their new content is empty."""
        for folder, place in self._places().items():
            if folder in folders:
                self._fs.delete(place, True)

    def newest_folders(self) -> set[Folder]:
        """The folders that were written last."""
        times = {f: self._fs.getFileStatus(p).getModificationTime() for f, p in self._places().items()}
        return {f for f, t in times.items() if t == max(times.values())}

    def _written(self, df: DataFrame, mode: str, metrics: tuple[Column, ...], placed: bool) -> dict:
        seen = Observation()
        if not placed:
            df = df.hint("rebalance", *self.partition_cols)
        df = df.observe(seen, *metrics) if metrics else df
        writer = df.select(*self.full_schema.names).write.mode(mode).partitionBy(*self.partition_cols)
        # A task sorts its rows by folder only if they are of more than one: those of a large folder or a batch are not.
        with session_setting(self.spark, "spark.sql.maxConcurrentOutputFileWriters", "1"):
            writer.options(**self._blooms()).option("partitionOverwriteMode", "dynamic").parquet(self.path)
        return seen.get if metrics else {}

    def _blooms(self) -> dict[str, str]:
        """Writer options: a Bloom filter per row group on a table's single key, as large as the keys of the row group need."""
        if len(self.spec.keys) != 1:
            return {}
        (key,) = self.spec.keys
        return {
            f"parquet.bloom.filter.enabled#{key}": "true",
            f"parquet.bloom.filter.fpp#{key}": str(BLOOM_MISSES),
            "parquet.bloom.filter.adaptive.enabled": "true",
            "parquet.bloom.filter.max.bytes": str(8 << 20),
        }
