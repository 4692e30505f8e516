"""Square grids over coordinates, one for each size of box: cells that a box covers."""

from __future__ import annotations

from math import log

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Cells of a level are so many times as wide as those of the level below.
STEP = 4


def _width(size: float, level: Column) -> Column:
    return F.lit(float(size)) * F.pow(F.lit(float(STEP)), level)


def level_of(box: Column, size: float) -> Column:
    """The finest level with cells as wide as the box, whatever its size, so that it touches four cells at most."""
    extent = F.greatest(box["xmax"] - box["xmin"], box["ymax"] - box["ymin"])
    coarse = F.ceil(F.log(F.greatest(extent, F.lit(float(size))) / size) / log(STEP))
    return F.when(extent.isNotNull(), coarse.cast("int"))


def cover(box: Column, size: float, level: Column) -> Column:
    """Cells of a level that a bounding box touches."""
    width = _width(size, level)
    xs = F.sequence(F.floor(box["xmin"] / width), F.floor(box["xmax"] / width))
    ys = F.sequence(F.floor(box["ymin"] / width), F.floor(box["ymax"] / width))
    return F.flatten(F.transform(xs, lambda cx: F.transform(ys, lambda cy: F.struct(cx.alias("cx"), cy.alias("cy")))))
