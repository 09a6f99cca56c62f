"""Exact distinct counts that merge: bitmaps of dense keys.

A count of distinct members cannot be added up over days, a set can. Dense keys make sets of bits: a key belongs to a
bucket of 32,768 neighbours, and each group has one bitmap of 4 KB for each bucket that it touches. Bitmaps are built on
the map side, so a key that a third of all rows hold is one bit of every task. The union of any groups is an OR, and
since an OR does not care how often it is given the same set, a load that is tried twice counts once.

Group by something coarse: there are as many bitmaps as pairs of group and bucket. Keys of any BIGINT value work; NULL
keys are not counted, and a group that has no others counts zero. Groups may be NULL. Repeated rows change nothing.
"""

from pyspark.sql import Column, DataFrame, functions as F

from credara.sources.workspace import Workspace

BUCKET, BITS = "cubeta", "bits"


def bitmaps(rows: DataFrame, key: str, by: list[str]) -> DataFrame:
    """``by``, bucket and bits of the keys that each group holds."""
    k = F.col(key).cast("bigint")
    return (rows.groupBy(*by, F.bitmap_bucket_number(k).alias(BUCKET))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(k)).alias(BITS)))


def _united(parts: DataFrame, by: list[str | Column]) -> DataFrame:
    return parts.groupBy(*by, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def add_rows(ws: Workspace, stored: DataFrame | None, delta: DataFrame, key: str, by: list[str]) -> DataFrame:
    """The stored bitmaps with the keys of more rows."""
    new = bitmaps(delta, key, by)
    return ws.save("bitmaps", new if stored is None else _united(stored.unionByName(new), by))


def count_distinct(stored: DataFrame, by: list[str], name: str) -> DataFrame:
    """Distinct keys in each union of groups: ``by`` are columns of ``stored``, or made from them; none is the union of
    all. Filter ``stored`` for a part of the groups."""
    return (_united(stored, by).groupBy(*by)
            .agg(F.coalesce(F.sum(F.bitmap_count(BITS)), F.lit(0)).alias(name)))
