"""Whole flows made of the operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isopleth.operators import aggregate, cleaning, climatology, combine, coverage, neighbours, patterns, timeseries
from isopleth.schema import FIELD_SCHEMA, Grid, with_cell_index
from isopleth.session import materialise
from isopleth.sources import tables


def clean(df: DataFrame, fills: Sequence[float] = (), limit: float | None = None) -> DataFrame:
    """Missing marks to NULL and longitudes to [-180, 180)."""
    return cleaning.wrap_longitudes(cleaning.null_missing(df, fills, limit))


def mean_field(
    df: DataFrame,
    start: dt.date,
    end: dt.date,
    area: tuple[float, float, float, float] | None,
    fills: Sequence[float] = (),
    cell: Sequence[str] | None = None,
) -> DataFrame:
    """Mean field of a period for an area, by default of each series: clean, cut, daily means, mean of the days."""
    rows = cleaning.time_slice(df, start, end)
    rows = cleaning.bounding_box(clean(rows, fills), area)
    return aggregate.period_mean(aggregate.daily_mean(rows, cell), start, end, cell, col="date")


def mean_fields(
    df: DataFrame,
    start: dt.date,
    end: dt.date,
    areas: Sequence[tuple[str, float, float, float, float]],
    fills: Sequence[float] = (),
    cell: Sequence[str] | None = None,
) -> DataFrame:
    """``mean_field`` of many named areas (name, north, west, south, east) in one pass, with a column ``area``.

    Cells outside all areas are left out before the shuffle; each cell is reduced once and only
    then given to every area that holds it.
    """
    rows = clean(cleaning.time_slice(df, start, end), fills)
    rows = rows.where(F.size(aggregate.boxes_with_cell(areas)) > 0)
    means = aggregate.period_mean(aggregate.daily_mean(rows, cell), start, end, cell, col="date")
    return means.select(F.explode(aggregate.boxes_with_cell(areas)).alias("area"), "*")


def normalise(
    df: DataFrame, var_key: str, source: str = "primary", fills: Sequence[float] = (), limit: float | None = None
) -> DataFrame:
    """A field of one variable as it arrives, in the canonical schema.

    Names, main variable, first level, missing marks, longitudes and the unit that the registry
    states for ``var_key``; an unknown key is an error.  The level is dropped, so it is NULL.
    """
    entry = tables.get_variable(var_key)
    rows = cleaning.squeeze_level(cleaning.pick_variable(cleaning.canonical_names(df)))
    rows = clean(rows, fills, limit).withColumns(
        {
            "source": F.lit(source),
            "var": F.lit(entry["var"]),
            "level": F.lit(None).cast("int"),
            "factor": F.lit(float(entry["factor"])),
        }
    )
    return cleaning.convert_units(rows).select(*[F.col(f.name).cast(f.dataType) for f in FIELD_SCHEMA])


def observed_period(
    primary: DataFrame,
    secondary: DataFrame,
    start: dt.date,
    end: dt.date,
    today: dt.date,
    hours: Sequence[int] | None = None,
    area: tuple[float, float, float, float] | None = None,
) -> DataFrame:
    """Observed field of a period: primary source as far as it goes, secondary after it."""
    rows = combine.splice_sources(primary, secondary, start, end, today)
    rows = cleaning.at_hours(rows, hours)
    return cleaning.bounding_box(cleaning.wrap_longitudes(rows), area)


def daily_anomaly(
    df: DataFrame,
    clim: DataFrame,
    clim_grid: Grid,
    field_grid: Grid,
    start: dt.date,
    end: dt.date,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """Check coverage, take daily means, bring the climatology (day_key, lat, lon, clim) to the field's grid, subtract.

    Each series of the field is treated for itself.  ``keys`` name the series columns in which field and
    climatology must agree, by default variable and level where both have them.  Field and climatology meet
    on cell indices, not on coordinates.
    """
    coverage.require_coverage(df, start, end, [c for c in ("var", "level") if c in df.columns])
    keys = [c for c in ("var", "level") if c in df.columns and c in clim.columns] if keys is None else list(keys)
    days = with_cell_index(aggregate.daily_mean(cleaning.time_slice(df, start, end)), field_grid)
    on_grid = neighbours.regrid_bilinear(
        clim.withColumnRenamed("clim", "value"), clim_grid, field_grid.lats, field_grid.lons, ("day_key", *keys)
    ).withColumnRenamed("value", "clim")
    stored = materialise(with_cell_index(on_grid, field_grid).select("i", "j", "day_key", *keys, "clim"), "climatology")
    return climatology.anomaly(days, stored, [*keys, "i", "j"]).drop("i", "j")


def oscillation_departures(
    df: DataFrame,
    base_start: dt.date,
    base_end: dt.date,
    south: float = -15.0,
    north: float = 15.0,
    days: int = 120,
    min_days: int | None = None,
) -> DataFrame:
    """Equatorial band means per (var, lon, date), minus the climatology, minus the preceding mean, normalised."""
    keys = ["var", "lon"]
    band = aggregate.hovmoller(df, south, north, [*keys, "date"])
    clim = materialise(climatology.daily_climatology(band, base_start, base_end, keys), "climatology")
    anomalies = climatology.anomaly(band, clim, keys)
    departures = timeseries.remove_preceding_mean(anomalies, keys, days, value="anomaly", min_days=min_days)
    return patterns.normalise_by_variable(departures)
