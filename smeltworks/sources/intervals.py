"""Which parts of time a model has been loaded for: an append-only ledger of days, and loads that fill only what is missing.

Every row of the ledger says that from one day up to another a model was loaded, or that what is there has become dirty. The last word on a day
counts; neighbouring days of one state are one interval, however many rows they came by. All of it is as small as the
calendar.
"""

import datetime
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from smeltworks.operators.loads import LoadMetrics, replace_range
from smeltworks.sources.tables import StoredTable

Day = datetime.date
Interval = tuple[Day, Day]
LEDGER = "model string, start date, end date, state string, at timestamp"
LOADED, DIRTY = "loaded", "dirty"
UNITS = ("day", "week", "month")


def floor(day: Day, unit: str) -> Day:
    """The first day of the unit that ``day`` lies in; weeks start on Monday."""
    if unit == "week":
        return day - datetime.timedelta(days=day.weekday())
    return day.replace(day=1) if unit == "month" else day


def later(day: Day, unit: str, steps: int = 1) -> Day:
    """The first day of the unit ``steps`` after that of ``day``."""
    day = floor(day, unit)
    if unit == "month":
        months = day.year * 12 + day.month - 1 + steps
        return Day(months // 12, months % 12 + 1, 1)
    return day + datetime.timedelta(days=steps * (7 if unit == "week" else 1))


def whole(interval: Interval, unit: str) -> Interval:
    """The least interval of whole units around one."""
    start, end = interval
    return floor(start, unit), later(end - datetime.timedelta(days=1), unit)


def merged(intervals: list[Interval]) -> list[Interval]:
    """Intervals in order, those that touch or overlap put together."""
    out: list[Interval] = []
    for start, end in sorted(intervals):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


class IntervalLedger:
    """The ledger, a Parquet table at a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())

    def record(self, model: str, interval: Interval, state: str = LOADED) -> None:
        if interval[0] >= interval[1]:
            raise ValueError(f"{model}: interval {interval} is empty")
        row = (model, *interval, state, datetime.datetime.now(datetime.timezone.utc))
        self.spark.createDataFrame([row], LEDGER).coalesce(1).write.mode("append").parquet(self.path)

    def events(self) -> DataFrame:
        """Every recorded row."""
        known = self._fs.exists(self._jvm_path)
        return self.spark.read.schema(LEDGER).parquet(self.path) if known else self.spark.createDataFrame([], LEDGER)

    def days(self, model: str) -> DataFrame:
        """``(day, state)``: the last state of every day that was ever recorded. Of equally late ones dirty counts."""
        rows = self.events().where(F.col("model") == model)
        each = rows.select(F.explode(F.sequence("start", F.date_sub("end", 1))).alias("day"), "state", "at")
        return each.groupBy("day").agg(F.max_by("state", F.struct("at", (F.col("state") == DIRTY).alias("dirty"))).alias("state"))

    def intervals(self, model: str) -> DataFrame:
        """``(start, end, state)``: the days, neighbours of one state put together."""
        return _islands(self.days(model))

    def missing(self, model: str, start: Day, end: Day) -> list[Interval]:
        """Intervals of ``[start, end)`` that are not loaded, or dirty."""
        if start >= end:
            return []
        calendar = self.spark.sql(f"SELECT explode(sequence(DATE '{start}', DATE '{end}' - INTERVAL 1 DAY)) AS day")
        done = self.days(model).where(F.col("state") == LOADED).select("day")
        open_ = calendar.select(F.to_date("day").alias("day")).join(done, "day", "left_anti")
        gaps = _islands(open_.withColumn("state", F.lit("missing"))).orderBy("start").collect()
        return [(r.start, r.end) for r in gaps]

    def dirty(self, model: str) -> list[Interval]:
        """Intervals that were loaded and have become dirty since."""
        return [(r.start, r.end) for r in self.intervals(model).where(F.col("state") == DIRTY).orderBy("start").collect()]


def _islands(days: DataFrame) -> DataFrame:
    """Runs of consecutive days of one state. In one run, a day less its rank among the days of its state is constant."""
    rank = F.row_number().over(Window.partitionBy("state").orderBy("day"))
    return (
        days.withColumn("_run", F.date_sub("day", rank))
        .groupBy("state", "_run")
        .agg(F.min("day").alias("start"), F.date_add(F.max("day"), 1).alias("end"))
        .select("start", "end", "state")
    )


@dataclass(frozen=True)
class TimeModel:
    """A table whose rows belong to units of time, and how those of a range are computed.

    ``build(start, end)`` returns the rows of whole units in ``[start, end)``, dates in the type of ``column`` by ``label``.
    ``reach`` is the number of units after a changed one whose rows depend on it. ``after`` names the models that it reads.
    """

    name: str
    table: StoredTable
    column: str
    build: Callable[[Day, Day], DataFrame]
    unit: str = "day"
    label: Callable[[Day], object] = lambda day: day
    reach: int = 0
    after: tuple[str, ...] = ()


def load_missing(
    ledger: IntervalLedger, model: TimeModel, start: Day, end: Day, readers: Iterable[str] = ()
) -> tuple[list[Interval], LoadMetrics]:
    """Load what ``model`` lacks of ``[start, end)``, and what of it is dirty wherever that lies, in whole units; what is loaded and
    clean is not touched.

    Units after a gap that depend on it and are loaded already are derived again along with it. Before a gap is loaded, its days
    become dirty for the ``readers``, the models that read this one; after it, the ledger is written: a run that breaks goes on where
    it was, and no reader misses a change. Returns the intervals that were loaded.
    """
    wanted = whole((start, end), model.unit)
    gaps = merged([whole(gap, model.unit) for gap in ledger.missing(model.name, *wanted) + ledger.dirty(model.name)])
    total, loaded = LoadMetrics(), []
    for low, high in gaps:
        last = high
        while last < later(high, model.unit, model.reach) and not ledger.missing(model.name, last, later(last, model.unit)):
            last = later(last, model.unit)
        for reader in readers:
            ledger.record(reader, (low, last), DIRTY)
        got = replace_range(model.table, model.build(low, last), model.column, model.label(low), model.label(last))
        ledger.record(model.name, (low, high))
        total = LoadMetrics(*(getattr(total, f) + getattr(got, f) for f in ("processed", "inserted", "updated")))
        loaded.append((low, high))
    return loaded, total


def refresh(ledger: IntervalLedger, models: list[TimeModel], start: Day, end: Day) -> dict[str, list[Interval]]:
    """Bring models up to date over ``[start, end)``, given in order of dependency.

    What a model loads anew is dirty for the models that read it, whether it lies in the range or not, so those load it
    too. Returns the intervals loaded by model.
    """
    done: dict[str, list[Interval]] = {}
    for model in models:
        readers = [m.name for m in models if model.name in m.after]
        done[model.name] = load_missing(ledger, model, start, end, readers)[0]
    return done
