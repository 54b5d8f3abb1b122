"""Cut lineage by writing a table into the cluster's shared checkpoint folder."""

import contextlib
import functools
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without one gets a folder of its own: on a cluster a driver-local folder would be
    invisible to the executors.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return _local_dir()


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="smeltworks-")


def scratch_path(spark: SparkSession, label: str = "step") -> str:
    """A new path below the checkpoint folder, grouped by application so that it can be removed with it."""
    app = spark.sparkContext.applicationId
    return f"{checkpoint_dir(spark)}/smeltworks/{app}/{label}-{uuid.uuid4().hex}"


# Paths written inside each open ``scratch_scope``, innermost last.
_OPEN: list[list[str]] = []
# Else shuffle files stay until the driver happens to collect its garbage.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def session_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for the time of the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what was materialised inside: for runs whose results are published tables, not data frames. What a job
    has shuffled goes when the job ends. Scopes may be nested."""
    _OPEN.append([])
    try:
        with session_setting(spark, _SHUFFLES_GO, "true"):
            yield
    finally:
        for path in _OPEN.pop():
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def materialise(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` and read it back: computed once, survives lost executors, has true size statistics."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if _OPEN:
        _OPEN[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
