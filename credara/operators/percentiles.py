"""Exact percentiles of whole-number values in two scans, for groups of any size.

The built-in ``percentile`` keeps every distinct value of a group in one task. Here the first scan builds a mergeable
quantile sketch of each group, whose rank error is bounded. Two of its quantiles, one on either side of a percentile and
further away than that error, bracket the value that is looked for. The second scan counts the values inside the
brackets one by one and all others between two brackets together, so that running sums give exact ranks. About one value
in a hundred lies in a bracket, at every input size; groups too small for the error bound to mean anything are one
bracket.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from credara.functions.money import sum_cents
from credara.sources.workspace import Workspace

# A sketch's quantiles are off by at most one rank in so many.
_ACCURACY = 1_000
# Brackets begin and end this many times the error away from their percentile; one would do for large groups.
_MARGIN = 4


def _ranks(probs: list[float]) -> Column:
    """Zero-based ranks on both sides of each percentile's position."""
    structs = []
    for i, p in enumerate(probs):
        place = (F.col("n") - 1) * p
        structs += [F.struct(F.lit(2 * i).alias("t"), F.floor(place).alias("rank")),
                    F.struct(F.lit(2 * i + 1).alias("t"), F.ceil(place).alias("rank"))]
    return F.array(*structs)


def _scoped(rows: DataFrame, total: int | None) -> DataFrame:
    """Rows under their group and, where asked for, once more under ``total``."""
    if total is None:
        return rows.where(F.col("g").isNotNull())
    scopes = F.explode(F.array(F.lit(total).cast("bigint"), F.col("g")))
    return rows.select(scopes.alias("g"), "v").where(F.col("g").isNotNull())


def _brackets(scoped: DataFrame, probs: list[float]) -> DataFrame:
    """``g, n, total, tramos``: values between which each percentile must lie."""
    away = _MARGIN / _ACCURACY
    edges = [e for p in probs for e in (max(0.0, p - away), min(1.0, p + away))]
    sketch = scoped.groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), sum_cents(F.col("v")).alias("total"), F.min("v").alias("lo"), F.max("v").alias("hi"),
        F.percentile_approx("v", edges, _ACCURACY).alias("e"))
    pair = lambda low, high: F.struct(low.alias("lo"), high.alias("hi"))
    # an edge at 0 or 1 is the end itself: a sketch need not return the extremes
    sides = [pair(F.col("lo") if edges[2 * i] == 0 else F.col("e")[2 * i], F.col("hi") if edges[2 * i + 1] == 1 else F.col("e")[2 * i + 1])
             for i in range(len(probs))]
    small = F.col("n") <= _MARGIN * _ACCURACY
    return sketch.select("g", "n", "total", F.when(small, F.array(pair(F.col("lo"), F.col("hi")))).otherwise(F.array(*sides)).alias("tramos"))


def exact_percentiles(ws: Workspace, df: DataFrame, group: str, value: str, probs: list[float],
                      total: int | None = None) -> DataFrame:
    """Columns ``group``, ``n``, ``total`` (sum of values) and ``q0``, ``q1``, ... (linear interpolation).

    ``total`` adds one more group, under that number, of all rows; rows without a group count there only. The brackets
    are saved, so Catalyst knows their size and broadcasts them while that is small.
    """
    rows = (df.select(F.col(group).alias("g"), F.col(value).cast("bigint").alias("v"))
            .where(F.col("v").isNotNull()))
    scoped = _scoped(rows, total)
    brackets = ws.save("tramos", _brackets(scoped, probs))
    inside = F.exists("tramos", lambda x: F.col("v").between(x["lo"], x["hi"]))
    below = F.array_max(F.transform(F.filter("tramos", lambda x: x["hi"] < F.col("v")), lambda x: x["hi"]))
    # a value outside stands behind the last bracket below it
    counts = (scoped.join(brackets.select("g", "tramos"), "g")
              .select("g", F.when(inside, F.col("v")).otherwise(F.coalesce(below, F.lit(-(1 << 63)))).alias("b"), (~inside).alias("fuera"))
              .groupBy("g", "b", "fuera").agg(F.count(F.lit(1)).alias("c")))
    running = Window.partitionBy("g").orderBy("b", "fuera").rowsBetween(Window.unboundedPreceding, -1)
    missed = F.raise_error(F.lit("a rank lies outside of its bracket")).cast("bigint")
    targets = (counts.withColumn("before", F.coalesce(F.sum("c").over(running), F.lit(0)))
               .join(brackets.select("g", "n", "total"), "g").select("*", F.inline(_ranks(probs)))
               .where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("c")))
               .withColumn("b", F.when(F.col("fuera"), missed).otherwise(F.col("b"))))

    def quantile(i: int, p: float) -> Column:
        low, high = (F.max(F.when(F.col("t") == 2 * i + k, F.col("b"))).cast("double") for k in (0, 1))
        place = (F.first("n") - 1) * p
        return (low + (high - low) * (place - F.floor(place))).alias(f"q{i}")

    return (targets.groupBy(F.col("g").alias(group))
            .agg(F.first("n").alias("n"), F.first("total").alias("total"),
                 *[quantile(i, p) for i, p in enumerate(probs)]))
