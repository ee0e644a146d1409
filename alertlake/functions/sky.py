"""Sky cells: declination zones cut into right-ascension cells, numbered along each zone.

Tables are sorted by cell, so a box on the sky becomes a few ranges of numbers that files and row
groups outside of it can be skipped by.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

CELL = "sky_cell"
#: Degrees of a zone and of a cell along it.
STEP = 5
ZONES, CELLS = 180 // STEP, 360 // STEP


def _number(value: Column, most: int) -> Column:
    return F.greatest(F.least(F.floor(value / STEP), F.lit(most - 1)), F.lit(0))


def sky_cell(ra: Column, dec: Column) -> Column:
    """Cell of a position; the borders 360 and 90 belong to the last cell, a null position has none."""
    known = ra.isNotNull() & dec.isNotNull()
    return F.when(known, _number(dec + 90, ZONES) * CELLS + _number(ra, CELLS)).cast("int")


def cells_of_box(
    ra_min: float, ra_max: float, dec_min: float, dec_max: float, wrap: bool = False
) -> list[tuple[int, int]]:
    """Ranges of cells, both ends included, that hold every position of the box."""
    of = lambda value, most: max(0, min(most - 1, int(value // STEP)))
    first, last = of(ra_min, CELLS), of(ra_max, CELLS)
    if ra_min <= ra_max:
        along = [(first, last)]
    elif wrap:
        along = [(0, last), (first, CELLS - 1)] if last < first else [(0, CELLS - 1)]
    else:
        return []
    zones = range(of(dec_min + 90, ZONES), of(dec_max + 90, ZONES) + 1) if dec_min <= dec_max else ()
    found: list[tuple[int, int]] = []
    for low, high in sorted((z * CELLS + a, z * CELLS + b) for z in zones for a, b in along):
        if found and low <= found[-1][1] + 1:
            found[-1] = (found[-1][0], max(high, found[-1][1]))
        else:
            found.append((low, high))
    return found


def in_cells(ranges: list[tuple[int, int]]) -> Column:
    """Rows of the ranges, and rows that were stored without a cell."""
    cell = F.col(CELL)
    return reduce(Column.__or__, (cell.between(a, b) for a, b in ranges), cell.isNull())
