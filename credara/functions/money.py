"""Money aggregates over whole cents.

Summing doubles depends on the order partitions arrive in; whole cents do not. One BIGINT sum would overflow
with 10^12 credits of up to 5 * 10^8 cents, and a wide decimal buffer is slow, so the upper and lower bits of
the cents are summed apart and put together once per group.
"""

from pyspark.sql import Column, functions as F

from credara.schemas import SEGMENTS

_LOW_BITS = 20


def cents(amount: Column) -> Column:
    """Whole cents (half up; amounts are non-negative) as BIGINT."""
    return F.floor(amount * 100.0 + 0.5)


def sum_cents(c: Column) -> Column:
    """Exact sum of BIGINT cents as a decimal."""
    upper, lower = F.sum(F.shiftright(c, _LOW_BITS)), F.sum(c.bitwiseAND((1 << _LOW_BITS) - 1))
    return upper.cast("decimal(20,0)") * F.lit(1 << _LOW_BITS).cast("decimal(7,0)") + lower.cast("decimal(20,0)")


def from_cents(c: Column) -> Column:
    return c.cast("double") / 100.0


def mean_from_cents(total: Column, n: Column, decimals: int = 2) -> Column:
    """Mean amount from a cent total, rounded to 2 or 0 decimals."""
    if decimals == 2:
        return F.round(F.try_divide(total.cast("double"), n)) / 100.0
    return F.round(F.try_divide(total.cast("double"), n * 100.0))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole with one decimal; NULL when there is nothing to divide."""
    return F.round(F.try_divide(part.cast("double") * 1000.0, whole)) / 10.0


def segment(amount: Column) -> Column:
    """Amount segment; the highest is open-ended, NULL amounts have none."""
    found = F.lit(None).cast("string")
    for name, low, high in SEGMENTS:
        at_least = F.lit(True) if low is None else amount >= low
        below = amount.isNotNull() if high is None else amount < high
        found = F.when(at_least & below, name).otherwise(found)
    return found
