"""Tables laid out by a hash of their key, so that joins and sums by that key need no shuffle."""

from pyspark.sql import DataFrame


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str) -> DataFrame:
    """Save ``df`` as catalog table ``name`` below ``path``, one sorted file per bucket, and return it as read back.

    Tables with the same key and number of buckets are joined bucket by bucket. Rows of one key share a bucket: use it for keys with a bounded
    number of rows, such as the items of an order, and choose ``buckets`` so that each holds a few hundred MB.
    """
    placed = df.repartition(buckets, key)
    placed.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)
