"""Sorted output: a table whose files hold consecutive ranges, each in order, and the proof that they do."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_sorted(df: DataFrame, path: str, *keys: Column, files: int | None = None) -> None:
    """Write ``df`` in ascending order of ``keys`` over all files in the order of their names. Nulls come first.

    Without ``files``, their largest number, Spark sizes them. Ranges come from a sample; rows with equal keys share a file, so add a unique key last where one value has many rows.
    """
    df.repartitionByRange(*([files] if files else []), *keys).sortWithinPartitions(*keys).write.parquet(path)


def file_ranges(spark: SparkSession, path: str, *keys: Column) -> DataFrame:
    """One row per file: ``file, n_rows, least, greatest, inversions``, the last being rows that are less than the row before."""
    rows = spark.read.parquet(path).select(
        F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("_at"), F.struct(*keys).alias("_key")
    )
    # A file is one sorted range, written by one task.
    before = F.lag("_key").over(Window.partitionBy("file").orderBy("_at"))
    return (
        rows.withColumn("_before", before)
        .groupBy("file")
        .agg(
            F.count("*").alias("n_rows"),
            F.min("_key").alias("least"),
            F.max("_key").alias("greatest"),
            F.count_if(F.col("_before") > F.col("_key")).alias("inversions"),
        )
    )


def order_proof(spark: SparkSession, path: str, *keys: Column) -> DataFrame:
    """One row: ``n_rows``, ``inversions`` inside files, and ``overlaps``, files that start below the end of the one before. Sorted
    output has none of either."""
    ranges = file_ranges(spark, path, *keys)
    # One row per file.
    end = F.lag("greatest").over(Window.orderBy("file"))
    return ranges.withColumn("_end", end).agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("inversions"), F.lit(0)).alias("inversions"),
        F.count_if(F.col("_end") > F.col("least")).alias("overlaps"),
    )
