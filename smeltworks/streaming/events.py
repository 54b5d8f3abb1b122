"""Event-time windows over a stream of events: counted once, when no more events are awaited for them."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Progress reports that a run can look back on; one is made per trigger.
REPORTS = "spark.sql.streaming.numRecentProgressUpdates"
MOST_REPORTS = 100_000


@dataclass(frozen=True)
class Arrivals:
    """What became of the events that a stream has read in all its runs."""

    read: int
    counted: int  # in windows that are closed and written
    open: int  # in windows that still wait
    late: int  # dropped, as their window had been closed


def per_window(events: DataFrame, size: str, keys: list[str], **measures: Column) -> DataFrame:
    """Events per time window and ``keys``, with further aggregates by name: the same on a table and on a stream."""
    window = F.window("ts", size)
    rows = events.groupBy(window.alias("window"), *keys).agg(F.count("*").alias("events"), *[m.alias(n) for n, m in measures.items()])
    return rows.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "events", *measures)


class EventWindows:
    """Files of events below ``source`` to a table of closed windows; both it and the state of the stream live below ``home``.

    A window is closed, and its rows written, when an event has been read that is ``lateness`` younger than its end. Events
    that come later than that are dropped and counted. The state holds one row per open window and key, however many events there are.
    """

    def __init__(
        self, spark: SparkSession, source: str, schema: T.StructType, home: str, size: str, lateness: str, keys: list[str],
        files_per_trigger: int = 1000, file_format: str = "parquet", **measures: Column,
    ):
        self.spark, self.source, self.schema, self.home = spark, source, schema, home.rstrip("/")
        self.size, self.lateness, self.keys, self.measures = size, lateness, keys, measures
        self.files_per_trigger, self.file_format = files_per_trigger, file_format

    def run(self) -> None:
        """Read all files that are there and not read yet, then stop. A run that breaks is taken up by the next one."""
        self.spark.conf.set(REPORTS, str(MOST_REPORTS))
        events = (
            self.spark.readStream.format(self.file_format)
            .schema(self.schema)
            .option("maxFilesPerTrigger", self.files_per_trigger)
            .load(self.source)
        )
        closed = per_window(events.withWatermark("ts", self.lateness), self.size, self.keys, **self.measures)
        query = (
            closed.writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", f"{self.home}/checkpoint")
            .trigger(availableNow=True)
            .start(f"{self.home}/windows")
        )
        query.awaitTermination()
        rows = sum(p.numInputRows for p in query.recentProgress)
        counted = self.spark.createDataFrame([(str(query.runId), rows)], "run string, rows bigint")
        counted.coalesce(1).write.mode("append").parquet(f"{self.home}/read")

    def closed(self) -> DataFrame:
        """The rows of closed windows, through the sink's own log: files of a broken run are not among them."""
        return self.spark.read.parquet(f"{self.home}/windows")

    def waiting(self) -> DataFrame:
        """Windows that are still open, with the events counted so far, from the state of the stream."""
        state = self.spark.read.format("statestore").load(f"{self.home}/checkpoint")
        return state.select("key.*", F.col("value.count").alias("events"))

    def arrivals(self) -> Arrivals:
        """What became of all events read so far."""
        read = self.spark.read.parquet(f"{self.home}/read").agg(F.sum("rows")).first()[0]
        counted, open_ = (rows.agg(F.coalesce(F.sum("events"), F.lit(0))).first()[0] for rows in (self.closed(), self.waiting()))
        return Arrivals(read, counted, open_, read - counted - open_)
