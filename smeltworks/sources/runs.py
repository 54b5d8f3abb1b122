"""The run log: one appended row per event of a run."""

import datetime
import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from smeltworks.operators.loads import LoadMetrics
from smeltworks.schemas import PIPELINE_RUNS

EPOCH = datetime.datetime(1970, 1, 1, tzinfo=datetime.timezone.utc)
STATUSES = ("RUNNING", "SUCCESS", "FAILED")


def _now() -> datetime.datetime:
    return datetime.datetime.now(datetime.timezone.utc)


class RunLog:
    """An append-only Parquet table at a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())

    def events(self) -> DataFrame:
        """Every logged row."""
        if not self._fs.exists(self._jvm_path):
            return self.spark.createDataFrame([], PIPELINE_RUNS.schema)
        return self.spark.read.schema(PIPELINE_RUNS.schema).parquet(self.path)

    def runs(self) -> DataFrame:
        """The last state of each run: finished rows before running ones."""
        last = Window.partitionBy("run_id").orderBy(F.col("finished_at").desc_nulls_last())
        return self.events().withColumn("_rn", F.row_number().over(last)).where("_rn = 1").drop("_rn")

    def log_run(
        self,
        pipeline: str,
        layer: str,
        status: str,
        metrics: LoadMetrics | None = None,
        run_id: str | None = None,
        started_at: datetime.datetime | None = None,
        watermark: datetime.datetime | None = None,
        error: str | None = None,
        metadata: dict | None = None,
    ) -> str:
        """Append one row; returns the run id."""
        if status not in STATUSES:
            raise ValueError(f"status {status!r} is not one of {STATUSES}")
        run_id, now = run_id or str(uuid.uuid4()), _now()
        row = (
            run_id,
            pipeline,
            layer,
            status,
            metrics.processed if metrics else None,
            metrics.inserted if metrics else None,
            metrics.updated if metrics else None,
            started_at or now,
            None if status == "RUNNING" else now,
            watermark,
            error,
            json.dumps(metadata) if metadata is not None else None,
        )
        frame = self.spark.createDataFrame([row], PIPELINE_RUNS.schema)
        frame.coalesce(1).write.mode("append").parquet(self.path)
        return run_id

    def last_watermark(self, pipeline: str) -> datetime.datetime:
        """Greatest mark of the pipeline's successful runs; 1970-01-01 UTC if there is none."""
        mark = (
            self.events()
            .where((F.col("pipeline_name") == pipeline) & (F.col("status") == "SUCCESS"))
            .agg(F.max("watermark").cast("double").alias("seconds"))
            .first()
            .seconds
        )
        return EPOCH if mark is None else EPOCH + datetime.timedelta(microseconds=round(mark * 1_000_000))
