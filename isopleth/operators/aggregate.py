"""Means over time and space.

All are partial + final hash aggregations, so a hot day, cell or band is reduced
before the shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isopleth.functions import scalars
from isopleth.operators.cleaning import time_slice
from isopleth.schema import Grid, key_join, series_of
from isopleth.session import materialise


def _cell(df: DataFrame, cell: Sequence[str] | None) -> list[str]:
    return [*series_of(df), "lat", "lon"] if cell is None else list(cell)


def daily_mean(df: DataFrame, cell: Sequence[str] | None = None) -> DataFrame:
    """Mean and number of non-missing steps per cell and day; by default each series for itself."""
    cell = _cell(df, cell)
    return df.groupBy(*cell, F.to_date("time").alias("date")).agg(
        F.avg("value").alias("value"), F.count("value").alias("n_steps")
    )


def period_mean(
    df: DataFrame, start: dt.date, end: dt.date, cell: Sequence[str] | None = None, col: str = "time"
) -> DataFrame:
    """Mean per cell over [start, end]; by default each series for itself."""
    return time_slice(df, start, end, col).groupBy(*_cell(df, cell)).agg(
        F.avg("value").alias("value"), F.count("value").alias("n_steps")
    )


def hovmoller(df: DataFrame, south: float, north: float, keys: Sequence[str] | None = None) -> DataFrame:
    """Time-longitude section: plain mean over a latitude band, by default of each series."""
    keys = [*series_of(df), "date", "lon"] if keys is None else keys
    return df.where(F.col("lat").between(south, north)).groupBy(*keys).agg(F.avg("value").alias("value"))


def boxes_with_cell(boxes: Sequence[tuple[str, float, float, float, float]]) -> Column:
    """Names of the boxes (name, north, west, south, east) that hold the row's lat and lon.

    The boxes are literals tested per row, so there is no nested-loop join.
    """

    def inside(corners: Sequence[float]) -> Column:
        return scalars.in_box(F.col("lat"), F.col("lon"), *[F.lit(float(x)) for x in corners])

    return F.array_compact(F.array(*[F.when(inside(corners), F.lit(name)) for name, *corners in boxes]))


def box_means(
    df: DataFrame,
    boxes: Sequence[tuple[str, float, float, float, float]],
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """cos(latitude)-weighted mean per named box (name, north, west, south, east), by default for each series and date.

    NULL cells carry no weight.  A cell inside several boxes counts in each.
    """
    keys = [*series_of(df), "date"] if keys is None else keys
    w = scalars.cos_weight(F.col("lat"))
    return (
        df.where(F.col("value").isNotNull())
        .select(*keys, (w * F.col("value")).alias("wv"), w.alias("w"), F.explode(boxes_with_cell(boxes)).alias("box"))
        .groupBy("box", *keys)
        .agg((F.sum("wv") / F.sum("w")).alias("value"), F.count("wv").alias("n_cells"))
    )


def remove_global_mean(df: DataFrame, slice_keys: Sequence[str] | None = None) -> DataFrame:
    """Subtract the cos(latitude)-weighted mean of each time slice (by default series and date).

    The means, one row per slice, are stored first; while they are small enough to
    broadcast the field is read twice but never shuffled.
    """
    slice_keys = [*series_of(df), "date"] if slice_keys is None else slice_keys
    w = F.when(F.col("value").isNotNull(), scalars.cos_weight(F.col("lat")))
    means = df.groupBy(*slice_keys).agg((F.sum(w * F.col("value")) / F.sum(w)).alias("slice_mean"))
    return key_join(df, materialise(means, "slice-means"), list(slice_keys), "left").withColumn(
        "value", F.col("value") - F.col("slice_mean")
    ).drop("slice_mean")


def coarsen(df: DataFrame, grid: Grid, factor: int = 2, keys: Sequence[str] | None = None) -> DataFrame:
    """Block mean over ``factor`` x ``factor`` cells, placed at the block centre.

    The centre follows from the block's index and the grid, so absent cells do not move it and a
    block across the date line stays there; longitudes are in [-180, 180).
    """
    keys = [*series_of(df), "date"] if keys is None else keys
    bi = F.floor(grid.i() / factor).cast("int").alias("bi")
    bj = F.floor(grid.j() / factor).cast("int").alias("bj")
    means = df.groupBy(*keys, bi, bj).agg(F.avg("value").alias("value"), F.count("value").alias("n_cells"))

    def centre(block: str, n: int) -> Column:
        """Middle cell index; the last block may be narrower."""
        first = F.col(block) * factor
        return (first + F.least(first + factor, F.lit(n)) - 1) / 2

    return means.withColumns(
        {
            "lat": grid.lat(centre("bj", grid.nlat)),
            "lon": scalars.wrap_longitude(grid.lon(centre("bi", grid.nlon))),
        }
    )
