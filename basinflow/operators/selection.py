"""Exact selection by rank without a sort or a buffer of all values.

The range that holds the wanted rank is cut into CELLS equal cells; one grouped
aggregate counts the values of each cell and their extremes, and the cell of
the rank becomes the next range.  A pass moves at most CELLS rows a partition
to the driver's CELLS rows, whatever the number of values.  It ends when the
cell holds one value, or few enough to be put in order (``few``).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELLS = 1024
FEW = 10_000


def nth(df: DataFrame, value: str, rank: int, cells: int = CELLS, few: int = FEW) -> float | None:
    """The ``rank``-th smallest (from 1) of a double column, NULL and NaN left
    out; None beyond the last.  ``df`` is read once a pass."""
    x = F.col(value).cast("double")
    live = df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    r = live.agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).first()
    n, low, high = r["n"], r["low"], r["high"]
    if not 1 <= rank <= n:
        return None
    while low < high:
        part = live.where(F.col("x").between(low, high))
        if n <= few:
            return part.orderBy("x").limit(rank).agg(F.max("x")).first()[0]      # at most ``few`` values
        # Halves, so that the width of any finite range is finite; the cell
        # number never falls as x grows, which is all that the counts need.
        least, most = max(low, -_LARGEST), min(high, _LARGEST)
        width = most / 2 - least / 2
        place = F.floor((F.col("x") / 2 - least / 2) / width * cells) if width > 0 else F.lit(0)
        cell = (F.when(F.col("x") < least, -1).when(F.col("x") > most, cells + 1)
                .otherwise(F.least(place, F.lit(cells)))).cast("int")
        found = (part.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
                 .collect())                                                     # at most ``cells`` + 3 rows
        for c in sorted(found, key=lambda c: c["cell"]):
            if rank <= c["n"]:
                break
            rank -= c["n"]
        if (c["n"], c["low"], c["high"]) == (n, low, high):                      # neighbours that no cell parts
            return _among_neighbours(part, rank)
        n, low, high = c["n"], c["low"], c["high"]
    return low


_LARGEST = 1.7976931348623157e308


def _among_neighbours(part: DataFrame, rank: int) -> float:
    """A range too narrow to be cut holds few different values: count them."""
    for r in part.groupBy("x").agg(F.count(F.lit(1)).alias("n")).orderBy("x").toLocalIterator():
        if rank <= r["n"]:
            return r["x"]
        rank -= r["n"]
    raise AssertionError("rank beyond the range")


def lower_median(df: DataFrame, value: str, **sizes) -> float | None:
    """The smallest value that at least half of all values do not exceed."""
    x = F.col(value).cast("double")
    n = df.agg(F.count(F.when(~F.isnan(x), 1)).alias("n")).first()["n"]
    return nth(df, value, math.ceil(n / 2), **sizes) if n else None
