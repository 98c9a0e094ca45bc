"""Planar geometry as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cell_index(c: Column, cell_size: float) -> Column:
    """Grid cell of a coordinate: ``floor(c / cell_size)`` as a long.

    Matches Python ``c // cell_size`` whenever ``cell_size`` is exact in
    binary (0.5, 0.75, 2**-k, ...); for other sizes the two can differ at
    cell edges.
    """
    return F.floor(c / F.lit(float(cell_size))).cast("long")


def euclidean(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    dx = x1 - x2
    dy = y1 - y2
    return F.sqrt(dx * dx + dy * dy)
