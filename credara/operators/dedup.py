"""Keep one row per key."""

from pyspark.sql import DataFrame, Window, functions as F


def keep_first(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row per ``key`` in ``order`` (ascending, NULLs last); a NULL key is a key like any other.

    Spark cuts each task to one row per key before the shuffle (WindowGroupLimit), so a key with a third
    of all rows sends one row per task.
    """
    w = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
