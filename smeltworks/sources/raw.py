"""Raw files and frames into bronze tables: every business column as text, plus batch metadata."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltworks.operators.loads import LoadMetrics, append_batch
from smeltworks.schemas import BRONZE, TableSpec, raw_columns
from smeltworks.sources.tables import StoredTable


def text_schema(spec: TableSpec) -> T.StructType:
    """The schema raw files are read with: declared, never inferred."""
    return T.StructType([T.StructField(c, T.StringType()) for c in raw_columns(spec)])


def read_raw(spark: SparkSession, path: str, table: str, file_format: str = "csv") -> DataFrame:
    """Raw CSV (with header), JSON lines or Parquet as text columns, with the file each row came from."""
    schema = text_schema(BRONZE[table])
    reader = spark.read
    if file_format == "csv":
        df = reader.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    elif file_format == "json":
        df = reader.schema(schema).json(path)
    elif file_format == "parquet":
        df = reader.parquet(path)
    else:
        raise ValueError(f"unknown raw format {file_format!r}")
    text = [F.col(c).cast("string").alias(c) for c in schema.names]
    return df.select(*text, F.col("_metadata.file_path").alias("_source_file"))


def ingest_bronze(
    table: StoredTable,
    df: DataFrame,
    batch_id: str,
    source_file: str | None = None,
    ingested_at: str | None = None,
) -> LoadMetrics:
    """Append ``df`` as one batch. A batch id that is already there is ignored, so a retry adds nothing.

    All rows of a batch share one ingestion time, as rows of one transaction would.
    """
    stamp = F.current_timestamp() if ingested_at is None else F.lit(ingested_at).cast("timestamp")
    source = F.col("_source_file") if "_source_file" in df.columns else F.lit(source_file)
    rows = df.select(
        stamp.alias("_ingested_at"),
        source.cast("string").alias("_source_file"),
        F.lit(batch_id).alias("_batch_id"),
        *[F.col(c).cast("string").alias(c) for c in raw_columns(table.spec)],
    )
    return append_batch(table, rows, batch_id)
