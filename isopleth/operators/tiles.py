"""Square tiles of a horizontal slice with a border of their neighbours' cells.

A stencil wants a cell's surroundings.  Here the slice is cut into tiles, and every tile also gets the
cells of its neighbours that lie within the reach of the stencil.  A cell is sent once to its own tile, and
again only if it is near an edge: with 64 cells to a side and a reach of two that makes 13 rows of 12.
A tile is one group of a few thousand cells, whatever the grid, so slices need not fit a task and a
function sees it as dense arrays.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isopleth.schema import Grid, series_of

#: Cells to a side of a tile.
SIDE = 64


def tile_cells(df: DataFrame, grid: Grid, reach: int, side: int = SIDE) -> DataFrame:
    """Every cell once for each tile that sees it.

    Adds tile_i, tile_j, the place x, y within the tile's array of ``side + 2 * reach`` cells to a side, and
    ``own`` for the one tile that holds the cell itself.  On a cyclic grid the first and last columns also
    see each other, more than once if the grid is narrower than the reach.  Rows without coordinates
    lie in no tile.
    """
    i, n = grid.i(), grid.nlon
    placed = df.withColumns({"__i": i, "__j": grid.j()})
    if grid.cyclic:
        turns = F.sequence(F.ceil((-reach - F.col("__i")) / n).cast("int"), F.floor((n + reach - 1 - F.col("__i")) / n).cast("int"))
        placed = placed.withColumn("__turn", F.explode(turns)).withColumn("__i", F.col("__i") + F.col("__turn") * n)
    else:
        placed = placed.withColumn("__turn", F.lit(0))

    def holders(index: str, last: int | None):
        first_tile, last_tile = (F.floor((F.col(index) + s * reach) / side).cast("int") for s in (-1, 1))
        if last is not None:
            first_tile, last_tile = F.greatest(first_tile, F.lit(0)), F.least(last_tile, F.lit(last))
        return F.explode(F.sequence(first_tile, last_tile))

    seen = placed.withColumn("tile_i", holders("__i", (n - 1) // side if grid.cyclic else None)).withColumn("tile_j", holders("__j", None))
    x, y = (F.col(f"__{c}") - F.col(f"tile_{c}") * side + reach for c in "ij")
    inside = [F.col(c).between(reach, reach + side - 1) for c in "xy"]
    own = inside[0] & inside[1] & (F.col("__turn") == 0)
    return seen.withColumns({"x": x, "y": y}).withColumn("own", own).drop("__i", "__j", "__turn")


def despike_by_tiles(
    df: DataFrame,
    grid: Grid,
    slice_keys: Sequence[str] | None = None,
    threshold: float = 150.0,
    ratio: float = 4.0,
    radius: int = 2,
    side: int = SIDE,
) -> DataFrame:
    """The result of ``neighbours.despike`` in one shuffle of the field, however many values exceed the threshold.

    For thresholds that many cells exceed; where they are rare, ``despike`` leaves the field in place.
    NULL and NaN are no neighbours and stay as they are.  Rows without coordinates are left out.
    """
    slice_keys = [*series_of(df), "date"] if slice_keys is None else list(slice_keys)
    cells = tile_cells(df.select(*slice_keys, "lat", "lon", F.col("value").cast("double").alias("value")), grid, radius, side)
    kinds = T.StructType([*cells.select(*slice_keys, "lat", "lon", "value").schema.fields, T.StructField("corrected", T.BooleanType())])
    return cells.groupBy(*slice_keys, "tile_i", "tile_j").applyInArrow(_median_filter(slice_keys, threshold, ratio, radius, side), kinds)


def _median_filter(slice_keys: list[str], threshold: float, ratio: float, radius: int, side: int) -> Callable[[pa.Table], pa.Table]:
    width = side + 2 * radius

    def run(tile: pa.Table) -> pa.Table:
        x, y, value, own = (tile.column(c).to_numpy() for c in ("x", "y", "value", "own"))
        own = own.astype(bool)
        plane = np.full((width, width), np.nan)
        plane[y, x] = value
        around = np.lib.stride_tricks.sliding_window_view(plane, (2 * radius + 1, 2 * radius + 1))
        asked = np.flatnonzero(own & (value > threshold))
        corrected = np.zeros(len(x), bool)
        if len(asked):
            median = np.nanmedian(around[y[asked] - radius, x[asked] - radius].reshape(len(asked), -1), axis=1)
            spike = value[asked] > ratio * median
            value = value.copy()
            value[asked[spike]] = median[spike]
            corrected[asked[spike]] = True
        lacking = tile.column("value").is_null().to_numpy()
        out = [*[tile.column(c) for c in (*slice_keys, "lat", "lon")], pa.array(value, pa.float64(), mask=lacking), pa.array(corrected)]
        return pa.table(out, names=[*slice_keys, "lat", "lon", "value", "corrected"]).filter(pa.array(own))

    return run
