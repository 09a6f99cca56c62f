"""Reductions a dashboard panel applies to a query result, as table operators."""

from pyspark.sql import Column, DataFrame, functions as F

from credara.functions.money import percent


def share_of_total(df: DataFrame, value: str, name: str = "share_pct") -> DataFrame:
    """Adds each row's share of the column total, in percent with one decimal."""
    total = df.select(F.sum(value)).scalar()
    return df.withColumn(name, percent(F.col(value), total))


def threshold_band(value: Column, limits: list[tuple[float, str]], base: str) -> Column:
    """``base`` below the first limit, then the label of the highest limit reached."""
    band = F.when(value.isNull(), F.lit(None).cast("string"))
    for limit, label in sorted(limits, reverse=True):
        band = band.when(value >= limit, label)
    return band.otherwise(base)


def series_mean(series: DataFrame, value: str) -> DataFrame:
    return series.agg(F.avg(value).alias("value"))


def series_last(series: DataFrame, time: str, value: str) -> DataFrame:
    """The last non-NULL value of a series."""
    return series.where(F.col(value).isNotNull()).agg(F.max_by(value, time).alias("value"))
