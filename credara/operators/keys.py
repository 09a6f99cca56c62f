"""Dense keys 1..n in a global order, without sending all rows through one task.

``row_number()`` over a window with no partition key plans a single-partition exchange. Here rows are
range-partitioned and sorted, their place is stored with them, and the per-partition row counts (one number
per partition) give each partition its offset.
"""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window, functions as F

from credara.sources.workspace import Workspace

PART, POS = "_parte", "_pos"
_ROW_BITS = (1 << 33) - 1    # monotonically_increasing_id: the low 33 bits count rows in the partition


def with_position(df: DataFrame, order: list[str]) -> DataFrame:
    """Sort globally (ascending, NULLs last) and add each row's partition and place in it.

    Give enough columns to make the order total. Save the result before use: the two columns describe one
    physical run.
    """
    by = [F.col(c).asc_nulls_last() for c in order]
    return _placed(df.repartitionByRange(*by), order)


def _placed(parted: DataFrame, order: list[str]) -> DataFrame:
    return (parted.sortWithinPartitions(*[F.col(c).asc_nulls_last() for c in order])
            .withColumn(PART, F.spark_partition_id())
            .withColumn(POS, F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))))


def key_from_position(placed: DataFrame, name: str) -> DataFrame:
    """Turn the stored places into the key. The broadcast side has one row per shuffle partition."""
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy(PART).agg(F.count(F.lit(1)).alias("_n"))
               .select(PART, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_antes")))
    keyed = placed.join(F.broadcast(offsets), PART)
    return keyed.select((F.col("_antes") + F.col(POS) + 1).alias(name),
                        *[c for c in placed.columns if c not in (PART, POS)])


def dense_key(ws: Workspace, df: DataFrame, order: list[str], name: str) -> DataFrame:
    return key_from_position(ws.save(f"orden_{name}", with_position(df, order)), name)


def dense_key_of_placed(ws: Workspace, df: DataFrame, parts: int, order: list[str], name: str) -> DataFrame:
    """``dense_key`` of rows that kept the partition ``with_position`` gave them for the first column of ``order``.

    They go back to that partition, so no ranges are sampled, which would compute ``df`` a second time.
    """
    placed = _placed(df.repartitionById(parts, PART).drop(PART), order)
    return key_from_position(ws.save(f"orden_{name}", placed), name)


def _same(left: DataFrame, right: DataFrame, columns: list[str]):
    return reduce(and_, [left[c].eqNullSafe(right[c]) for c in columns])


def extend_keys(ws: Workspace, known: DataFrame | None, members: DataFrame, order: list[str], name: str) -> DataFrame:
    """A key map that later loads can go on with: ``name`` and the columns ``order``, which are a member's identity.

    Members of ``known`` keep their keys, whether they come again or not, and no key is given twice; unseen ones are
    numbered in their order from the last key on. Nulls in ``order`` are values like any other; repeated members count
    once. The shuffles are by the whole identity, which is unique, so no key is hot.
    """
    members = members.select(*order).distinct()
    if known is None:
        return ws.save(f"claves_{name}", dense_key(ws, members, order, name))
    known = known.select(name, *order)
    unseen = members.join(known, _same(members, known, order), "left_anti")
    last = known.agg(F.coalesce(F.max(name), F.lit(0)).cast("bigint")).first()[0]
    new = dense_key(ws, unseen, order, name).withColumn(name, F.col(name) + last)
    return ws.save(f"claves_{name}", known.unionByName(new))


def with_keys(df: DataFrame, known: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with the key of each row's identity in front."""
    found = known.select(name, *[F.col(c).alias(f"_clave_{c}") for c in order])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_clave_{c}")) for c in order])
    return df.join(found, same, "left").select(name, *df.columns)
