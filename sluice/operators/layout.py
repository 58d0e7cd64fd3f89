"""Order of rows for several index columns: a space-filling curve over the ranks of their values.

Sorted by a list of columns, files are narrow in the first one only.  Here each column is cut into ranges of about
equal row counts, whatever its type and distribution, and the bits of a row's range numbers are interleaved (Z-order),
so that files near each other on the curve are narrow in every column and a filter on any of them skips files.

Only the counts of values are sorted (``batch_bounds``).  A column's bounds, at most ``3 * cells + 1`` values, go
into the plan as a balanced tree of comparisons: no join, and about the logarithm of the bounds in comparisons a row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from sluice.operators.batches import batch_bounds, bound_value

#: Bits of a range number: no more than 63 in all.
BITS = 8


def _number(value: Column, lows: list[str], kind: DataType, first: int = 1) -> Column:
    """Number of the range that holds a value, by its lower bounds in ascending order; what is below them is ``first``."""
    if not lows:
        return F.lit(first)
    mid = len(lows) // 2
    return F.when(value < bound_value(lows[mid], kind), _number(value, lows[:mid], kind, first)) \
        .otherwise(_number(value, lows[mid + 1:], kind, first + mid + 1))


def range_number(df: DataFrame, column: str, rows: int, bits: int) -> Column:
    """The number, below ``2 ** bits``, of the range of ``column`` that a row is in; NULL is 0.  A value that many
    rows share has a range of its own."""
    cells = 2 ** (bits - 2)
    bounds = batch_bounds(df, column, max(1, -(-2 * rows // cells))).where("low IS NOT NULL").orderBy("batch")
    lows = [r.low for r in bounds.select("low").collect()]  # at most 3 * cells + 1 bounds
    c = F.col(column)
    return F.when(c.isNull(), 0).otherwise(_number(c, lows[1:], df.schema[column].dataType)).cast("long")


def z_order(df: DataFrame, columns: list[str]) -> Column:
    """A row's place on the curve through the ranges of ``columns`` (at most 21)."""
    bits = min(BITS, 63 // len(columns))
    if bits < 3:
        raise ValueError(f"too many columns for one layout: {len(columns)}")
    rows = df.count()
    numbers = [range_number(df, c, rows, bits) for c in columns]
    spread = [F.shiftleft(F.shiftright(n, b).bitwiseAND(F.lit(1)), b * len(columns) + i)
              for b in range(bits) for i, n in enumerate(numbers)]
    return reduce(lambda a, b: a.bitwiseOR(b), spread)
