"""Stream-fed upserts.

A file stream types the rows of newly arrived bronze files and appends them, marked with the run's change set,
through Spark's exactly-once file sink. A change set is then folded to the latest row per key and upserted. The
stream's checkpoint replaces the high-water mark; a change set stays pending until it has been applied, and
applying it again changes nothing.
"""

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltworks.operators.dedup import latest_by
from smeltworks.operators.loads import LoadMetrics, upsert
from smeltworks.sources.tables import StoredTable

SET = "_change_set"


class ChangeStream:
    """New files below ``source`` to rows of ``target``; its own state lives below ``home``."""

    def __init__(
        self,
        spark: SparkSession,
        source: str,
        source_schema: T.StructType,
        project: Callable[[DataFrame], DataFrame],
        target: StoredTable,
        home: str,
        newest_first: list[str],
        order_col: str | None = None,
        file_format: str = "parquet",
        files_per_trigger: int = 1000,
    ):
        """``project`` must be row by row (no aggregation). ``order_col`` keeps a late older row from
        overwriting a newer one and must be a column of the target. The sink's log keeps every change set."""
        self.spark, self.source, self.source_schema = spark, source, source_schema
        self.project, self.target, self.home = project, target, home.rstrip("/")
        self.newest_first, self.order_col = newest_first, order_col
        self.file_format, self.files_per_trigger = file_format, files_per_trigger
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.home).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        found = self._fs.globStatus(self._path(f"{self.home}/{folder}/{SET}=*")) or []
        return sorted(s.getPath().getName().partition("=")[2] for s in found)

    def pending(self) -> list[str]:
        """Change sets that have not been applied, oldest first."""
        done = set(self._names("applied"))
        return [n for n in self._names("changes") if n not in done]

    def collect_changes(self) -> None:
        """Process all files that are there now into a new change set, then stop."""
        rows = (
            self.spark.readStream.format(self.file_format)
            .schema(self.source_schema)
            .option("maxFilesPerTrigger", self.files_per_trigger)
            .load(self.source)
        )
        name = f"set-{time.time_ns():020d}"
        query = (
            self.project(rows)
            .withColumn(SET, F.lit(name))
            .writeStream.format("parquet")
            .partitionBy(SET)
            .option("checkpointLocation", f"{self.home}/checkpoint")
            .trigger(availableNow=True)
            .start(f"{self.home}/changes")
        )
        query.awaitTermination()
        if name in self._names("changes"):
            self._fs.mkdirs(self._path(f"{self.home}/counts/{SET}={name}/rows={self._rows(name).count()}"))

    def _rows(self, name: str) -> DataFrame:
        """A change set, read through the sink's own log: files of a broken run that were never committed are not in it."""
        schema = T.StructType([*self.target.spec.schema.fields, T.StructField(SET, T.StringType())])
        return self.spark.read.schema(schema).parquet(f"{self.home}/changes").where(F.col(SET) == name).drop(SET)

    def _collected(self, name: str) -> int | None:
        """Rows of a change set when it was collected, None if the run broke off before they were counted."""
        found = self._fs.globStatus(self._path(f"{self.home}/counts/{SET}={name}/rows=*")) or []
        return int(found[0].getPath().getName().partition("=")[2]) if found else None

    def apply(self, name: str) -> LoadMetrics:
        """Upsert one change set and mark it applied. A set that has lost rows since it was collected is refused."""
        if not self._fs.exists(self._path(f"{self.home}/changes/_spark_metadata")):
            return LoadMetrics()
        changes, expected = self._rows(name), self._collected(name)
        if expected is not None and (found := changes.count()) < expected:
            raise RuntimeError(f"{self.home}: change set {name} has {found} of its {expected} rows")
        latest = latest_by(changes, list(self.target.spec.keys), self.newest_first)
        metrics = upsert(self.target, latest, order_col=self.order_col)
        self._fs.mkdirs(self._path(f"{self.home}/applied/{SET}={name}"))
        return metrics

    def drop_applied(self) -> int:
        """Delete the files of change sets that have been applied. Returns how many sets went."""
        done = set(self._names("applied")) & set(self._names("changes"))
        for name in done:
            self._fs.delete(self._path(f"{self.home}/changes/{SET}={name}"), True)
        return len(done)

    def run(self) -> list[LoadMetrics]:
        """Apply what a broken run left, take in new files, apply them."""
        applied = [self.apply(name) for name in self.pending()]
        self.collect_changes()
        return applied + [self.apply(name) for name in self.pending()]
