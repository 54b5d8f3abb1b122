"""Keep the latest row per key."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: list[str], newest_first: list[str]) -> DataFrame:
    """One row per key: the greatest by ``newest_first``, NULLs last.

    Filtering on ``row_number() = 1`` lets Spark cut every map task to one row per key before the shuffle, so
    a hot key costs at most one row per task.
    """
    order = [F.col(c).desc_nulls_last() for c in newest_first]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")
