"""What whole JSON documents hold: every path, with the kinds of values found there."""

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _kind(value: Column) -> Column:
    """JSON kind of a variant; whole numbers that fit 64 bits are integers."""
    head = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    return (
        F.when(value.isNull(), "invalid")
        .when(head == "VOID", "null")
        .when(head == "BIGINT", "integer")
        .when(head.isin("DOUBLE", "DECIMAL", "FLOAT"), "number")
        .otherwise(F.lower(head))
    )


def json_paths(df: DataFrame, document: str) -> DataFrame:
    """``(path, kind, n)``: how many values of each kind stand at each path of a JSON text column.

    ``$`` is the document, ``.key`` a field and ``[*]`` all elements of an array. Nulls of the column are left out; a text that is no JSON
    counts as ``invalid`` at ``$``. Each level of nesting is one ``variant_explode`` over the rows that still hold objects or arrays,
    and there are as many passes as the deepest document has levels; values stay variants and are never shuffled.
    """
    spark = df.sparkSession
    level = df.where(F.col(document).isNotNull()).select(F.lit("$").alias("path"), F.try_parse_json(document).alias("v"))
    levels = []
    while not levels or not level.isEmpty():
        level = level.withColumn("kind", _kind(F.col("v")))
        levels.append(level.select("path", "kind"))
        nested = level.where(F.col("kind").isin("object", "array"))
        below = nested.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
        step = F.when(F.col("kind") == "array", F.lit("[*]")).otherwise(F.concat(F.lit("."), F.col("key")))
        level = below.select(F.concat("path", step).alias("path"), F.col("value").alias("v"))
    return functools.reduce(DataFrame.unionByName, levels).groupBy("path", "kind").agg(F.count("*").alias("n"))


def json_schema(df: DataFrame, document: str) -> DataFrame:
    """One row ``schema``: the type that all documents share, as DDL; fields that disagree are ``VARIANT``. Null without documents."""
    schema = F.schema_of_variant_agg(F.try_parse_json(document)).alias("schema")
    return df.where(F.try_parse_json(document).isNotNull()).agg(F.count("*").alias("n"), schema).select(F.when(F.col("n") > 0, F.col("schema")).alias("schema"))
