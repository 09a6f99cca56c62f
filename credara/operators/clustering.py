"""Clustering by several columns: rows in the order of interleaved bits.

Rows sorted by one column are scattered by every other, so a filter on the second reads all files. In Morton order a file
holds a small box of all columns, and its statistics let a filter on any of them skip it.

Values are mapped to cells between the least and the greatest of their column, so that columns of different widths weigh
the same. Ties go on by further columns: cells that hold very many rows spread over several files. NULL has the cell of
the least value; an empty table stays as it is; a column with one value takes no part.
"""

from pyspark.sql import Column, DataFrame, functions as F

# Bits of each column; all together have to fit a BIGINT.
BITS = 16


def morton(cells: list[Column], bits: int = BITS) -> Column:
    """Bits of whole numbers below 2^bits, interleaved; the first column has the highest bit."""
    if bits * len(cells) > 62:
        raise ValueError("too many bits for a BIGINT")
    code = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, cell in enumerate(reversed(cells)):
            one = F.shiftright(cell.cast("bigint"), bit).bitwiseAND(F.lit(1).cast("bigint"))
            code = code.bitwiseOR(F.shiftleft(one, bit * len(cells) + i))
    return code


def _cell(column: str, low: int, high: int) -> Column:
    # in doubles, where the ends of a BIGINT can be far apart; rounding keeps the order, but may reach the bound
    steps = F.floor((F.col(column).cast("double") - F.lit(float(low))) / F.lit(float(high - low + 1)) * F.lit(float(1 << BITS)))
    return F.coalesce(F.least(steps, F.lit((1 << BITS) - 1)), F.lit(0))


def clustered(rows: DataFrame, columns: list[str], ties: list[str], files: int | None = None) -> DataFrame:
    """``rows`` in Morton order of whole-number ``columns``, then by ``ties``: one aggregate and one range shuffle.

    ``rows`` is read three times (bounds, sample, shuffle), so it should be a written table.
    """
    bounds = rows.agg(*[f(c).alias(f"{f.__name__}{i}") for i, c in enumerate(columns) for f in (F.min, F.max)]).first()
    cells = [_cell(c, bounds[2 * i], bounds[2 * i + 1]) for i, c in enumerate(columns)
             if bounds[2 * i] is not None and bounds[2 * i] < bounds[2 * i + 1]]
    if not cells:
        return rows
    order = [morton(cells), *[F.col(c) for c in ties]]
    dealt = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
    return dealt.sortWithinPartitions(*order)
