"""Small helpers shared by the operators."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 4 << 20
# Rows of an Arrow batch between Spark and Python. Spark's own limit lets a batch of long texts reach gigabytes.
BATCH_ROWS = 1000
BATCH_LIMIT = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_columns(df: DataFrame, text: str, fields: str, compute: Callable[[list], list], keep: list[str] | None = None) -> DataFrame:
    """``df`` with columns computed in Python from one text column, a few MB of rows at a time.

    ``fields`` is a DDL string of the new columns; ``compute`` takes the batch's texts (None for null) and returns one
    list or Arrow array per new column. ``keep`` limits the columns carried along. An input column with the name of
    a new one is replaced.
    """
    short_batches(df.sparkSession)
    new = T._parse_datatype_string(fields)
    names = [c for c in (df.columns if keep is None else keep) if c not in new.names]
    carried = df.select(*[F.col(f"`{c}`") for c in names], F.col(f"`{text}`").alias("_text"))
    schema = T.StructType([*(carried.schema[c] for c in names), *new.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = None
        for batch in (part for whole in batches for part in slices(whole)):
            if kinds is None:
                from pyspark.sql.pandas.types import to_arrow_schema

                kinds = to_arrow_schema(T.StructType(new.fields))
            made = compute(batch.column(len(names)).to_pylist())
            arrays = [v if isinstance(v, pa.Array) else pa.array(v, f.type) for v, f in zip(made, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(names))), *arrays], names=[*names, *new.names]
            )
        pa.default_memory_pool().release_unused()

    return carried.mapInArrow(run, schema)


def short_batches(spark: SparkSession) -> None:
    """Lower the session's limit of rows per Arrow batch to what whole texts allow; a lower one stays as it is."""
    limit = int(spark.conf.get(BATCH_LIMIT, "0"))
    if limit <= 0 or limit > BATCH_ROWS:
        spark.conf.set(BATCH_LIMIT, str(BATCH_ROWS))


def slices(batch: pa.RecordBatch, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``size`` bytes: what Python holds at once does not grow with the batch."""
    step = max(1, batch.num_rows * size // max(batch.nbytes, 1))
    for i in range(0, batch.num_rows, step):
        yield batch.slice(i, step)


def gathered(batches: Iterator[pa.RecordBatch], names: list[str]) -> dict[str, np.ndarray] | None:
    """All rows of a partition as numpy arrays, None if there are none."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return None
    whole = pa.Table.from_batches(got)
    return {n: whole.column(n).to_numpy() for n in names}
