"""Incremental load by high-water mark."""

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltworks.operators.loads import LoadMetrics, upsert
from smeltworks.sources.runs import EPOCH, RunLog
from smeltworks.sources.tables import StoredTable

NO_BUFFER = datetime.timedelta(0)


def newer_than(bronze: StoredTable, mark: datetime.datetime) -> DataFrame:
    """Rows ingested after ``mark``. Folders of older days are pruned; a day is allowed for sessions in another time zone."""
    recent = F.col("_ingest_date") >= F.lit(mark.date() - datetime.timedelta(days=1))
    rows = bronze.read(helpers=True).where(recent & (F.col("_ingested_at") > F.lit(mark)))
    return rows.select(*bronze.spec.schema.names)


def incremental_load(
    bronze: StoredTable,
    log: RunLog,
    pipeline: str,
    transform: Callable[[DataFrame], DataFrame],
    target: StoredTable,
    buffer: datetime.timedelta = NO_BUFFER,
    update_cols: list[str] | None = None,
    waiting: DataFrame | None = None,
    after: Callable[[], None] | None = None,
    stored: bool = False,
    checked: bool = False,
) -> LoadMetrics:
    """Transform rows newer than the last mark and upsert them.

    The new mark is the greatest ingestion time among the rows that were read, not the time the run ended, so
    rows that land during the run are picked up by the next one. ``buffer`` reads that much before the mark
    again for rows that arrive late; the overlap is harmless since the upsert is idempotent.

    ``waiting`` are rows that earlier runs had to leave, transformed along with the new ones; ``after`` is called when
    the upsert is done, before the mark moves. ``stored`` and ``checked`` say of what ``transform`` gives what they say to ``upsert``.
    """
    started = datetime.datetime.now(datetime.timezone.utc)
    mark = log.last_watermark(pipeline)
    since = mark if mark == EPOCH else mark - buffer
    # One listing of the files serves the mark and the load: rows that land later are in neither.
    fresh = newer_than(bronze, since)
    top = fresh.agg(F.max("_ingested_at").cast("double").alias("seconds")).first().seconds
    idle = top is None and (waiting is None or waiting.isEmpty())
    if idle:
        log.log_run(pipeline, "silver", "SUCCESS", LoadMetrics(), started_at=started, watermark=mark)
        return LoadMetrics()
    try:
        rows = fresh if waiting is None else fresh.unionByName(waiting)
        metrics = upsert(target, transform(rows), update_cols=update_cols, stored=stored, checked=checked)
        if after is not None:
            after()
    except Exception as error:
        log.log_run(pipeline, "silver", "FAILED", started_at=started, error=str(error))
        raise
    reached = mark if top is None else EPOCH + datetime.timedelta(microseconds=round(top * 1_000_000))
    log.log_run(pipeline, "silver", "SUCCESS", metrics, started_at=started, watermark=max(mark, reached))
    return metrics
