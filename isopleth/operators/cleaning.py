"""Standardise incoming fields: names, main variable, level, units, time, area."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isopleth.functions import scalars
from isopleth.schema import series_of
from isopleth.sources import tables


def canonical_names(df: DataFrame, scalar_time: dt.datetime | None = None) -> DataFrame:
    """latitude/longitude -> lat/lon (any case), valid_time -> time; add a scalar time if given."""
    have = set(df.columns)
    renames = {}
    for name in df.columns:
        target = {"latitude": "lat", "longitude": "lon"}.get(name.lower())
        if target and target not in have and target not in renames.values():
            renames[name] = target
    if "time" not in have and "valid_time" in have:
        renames["valid_time"] = "time"
    out = df.withColumnsRenamed(renames)
    if "time" not in out.columns:
        if scalar_time is None:
            raise ValueError("the field has no time column and no scalar time was given")
        out = out.withColumn("time", F.lit(scalar_time).cast("timestamp_ntz"))
    return out


def pick_variable(df: DataFrame, dims: Sequence[str] = ("time", "lat", "lon")) -> DataFrame:
    """Keep the dimensions and the first data column, renamed ``value``; auxiliaries are dropped."""
    skip = {*dims, *tables.AUXILIARY_COLUMNS, *tables.LEVEL_COLUMNS}
    data = [c for c in df.columns if c not in skip]
    if not data:
        raise KeyError(f"no data column among {df.columns}")
    levels = [c for c in df.columns if c in tables.LEVEL_COLUMNS and c not in dims]
    return df.select(*[c for c in dims if c in df.columns], *levels, F.col(data[0]).alias("value"))


def squeeze_level(
    df: DataFrame, order_col: str | None = None, keys: Sequence[str] | None = None
) -> DataFrame:
    """Keep the first level of every cell (lowest ``order_col``) and drop the level column.

    By default every source and variable keeps its own first level.
    """
    names = [c for c in df.columns if c in tables.LEVEL_COLUMNS]
    if not names:
        return df
    keys = [*[c for c in series_of(df) if c not in names], "time", "lat", "lon"] if keys is None else keys
    order = order_col or names[0]
    rest = [c for c in df.columns if c not in keys and c not in names and c != order]
    # one min_by per column keeps the buffers flat, so this stays a hash aggregation
    return df.groupBy(*keys).agg(*[F.min_by(c, order).alias(c) for c in rest])


def time_slice(
    df: DataFrame,
    start: dt.date | dt.datetime | None = None,
    end: dt.date | dt.datetime | None = None,
    col: str = "time",
) -> DataFrame:
    """Rows between two labels, both included; a plain date as end covers its whole day.

    Written as range comparisons on the raw column, which the Parquet scan can push
    down; a date column is compared with dates for the same reason.
    """
    out = df
    if isinstance(df.schema[col].dataType, T.DateType) and not any(isinstance(x, dt.datetime) for x in (start, end)):
        if start is not None:
            out = out.where(F.col(col) >= F.lit(start))
        return out.where(F.col(col) <= F.lit(end)) if end is not None else out
    if start is not None:
        out = out.where(F.col(col) >= _instant(start))
    if end is not None:
        if isinstance(end, dt.datetime):
            out = out.where(F.col(col) <= _instant(end))
        else:
            out = out.where(F.col(col) < _instant(end + dt.timedelta(days=1)))
    return out


def _instant(label: dt.date | dt.datetime) -> Column:
    if not isinstance(label, dt.datetime):
        label = dt.datetime.combine(label, dt.time())
    return F.lit(label.isoformat(sep=" ")).cast("timestamp_ntz")


def bounding_box(df: DataFrame, area: tuple[float, float, float, float] | None) -> DataFrame:
    """Rows inside (north, west, south, east); None keeps the globe."""
    if area is None:
        return df
    north, west, south, east = (F.lit(float(x)) for x in area)
    return df.where(scalars.in_box(F.col("lat"), F.col("lon"), north, west, south, east))


def normalise_hours(hours: Sequence[int] | None) -> list[int]:
    """Distinct ascending hours 0-23; None means the four synoptic hours, an empty list is an error."""
    chosen = sorted({int(h) for h in (tables.DEFAULT_HOURS if hours is None else hours)})
    if not chosen or chosen[0] < 0 or chosen[-1] > 23:
        raise ValueError(f"hours must be 0-23 and not empty: {hours}")
    return chosen


def at_hours(df: DataFrame, hours: Sequence[int] | None = None, col: str = "time") -> DataFrame:
    """Steps that fall on one of the hours, minute 0."""
    t = F.col(col)
    return df.where(F.hour(t).isin(normalise_hours(hours)) & (F.minute(t) == 0))


def null_missing(df: DataFrame, fills: Sequence[float] = (), limit: float | None = None) -> DataFrame:
    """NaN, fill values and implausible magnitudes of ``value`` become NULL."""
    return df.withColumn("value", scalars.null_if_missing(F.col("value"), fills, limit))


def wrap_longitudes(df: DataFrame) -> DataFrame:
    return df.withColumn("lon", scalars.wrap_longitude(F.col("lon")))


def resolve_variables(df: DataFrame, on_unknown: str = "error") -> DataFrame:
    """Join the variable registry on ``var_key``.

    ``on_unknown``: "error" fails the job and lists the known keys, "reject" keeps
    the row with a ``reject`` text, "drop" is not offered.
    """
    registry = F.broadcast(tables.variable_registry(df.sparkSession))
    joined = df.join(registry, "var_key", "left")
    known = ", ".join(sorted(r[0] for r in tables.VARIABLES))
    text = F.concat(F.lit("unknown variable '"), F.col("var_key"), F.lit(f"'; known: {known}"))
    unknown = F.col("primary_name").isNull()
    if on_unknown == "error":
        return joined.withColumn("var", F.when(unknown, F.raise_error(text)).otherwise(F.col("var")))
    if on_unknown == "reject":
        return joined.withColumn("reject", F.when(unknown, text))
    raise ValueError("on_unknown is 'error' or 'reject'")


def convert_units(df: DataFrame, primary: str = "primary") -> DataFrame:
    """Multiply the primary source by the registry factor; other sources already carry the unit."""
    factor = F.when(F.col("source") == primary, F.col("factor")).otherwise(F.lit(1.0))
    return df.withColumn("value", F.when(factor != 1.0, F.col("value") * factor).otherwise(F.col("value")))


def sort_field(df: DataFrame, within_partitions: bool = False) -> DataFrame:
    """Order by time, latitude and longitude; within partitions before a write, else globally."""
    cols = [c for c in ("time", "lat", "lon") if c in df.columns]
    return df.sortWithinPartitions(*cols) if within_partitions else df.orderBy(*cols)
