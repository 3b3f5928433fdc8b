"""Unit repair, degenerate days and masks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isopleth.functions import scalars
from isopleth.schema import key_join, series_of
from isopleth.session import materialise
from isopleth.sources import tables


def repair_units_by_slice(df: DataFrame, threshold: float, slice_keys: Sequence[str] | None = None) -> DataFrame:
    """Divide by gravity each time slice whose own mean exceeds ``threshold`` (geopotential, not height).

    The scale is judged per slice: a mean over a series of mixed origin would divide
    either everything or nothing.
    """
    slice_keys = [*series_of(df), "time"] if slice_keys is None else slice_keys
    scale = df.groupBy(*slice_keys).agg(F.avg("value").alias("slice_mean"))
    joined = key_join(df, materialise(scale, "slice-scale"), list(slice_keys), "left")
    geopotential = F.col("slice_mean") > threshold
    return (
        joined.withColumn(
            "value", F.when(geopotential, F.col("value") / tables.STANDARD_GRAVITY).otherwise(F.col("value"))
        )
        .withColumn("was_geopotential", F.coalesce(geopotential, F.lit(False)))
        .drop("slice_mean")
    )


def degenerate_days(
    df: DataFrame,
    series: Sequence[str] | None = None,
    date: str = "date",
    min_fraction: float = 0.02,
    relative: float = 0.5,
) -> DataFrame:
    """One row per series and day with the shares of negative and positive cells and a ``degenerate`` flag.

    A day is degenerate if its rarer sign falls below ``min_fraction``, or if either
    share falls below ``relative`` times the median share of the series.  The medians
    run over the day shares, one row per day of the calendar, never over the cells.
    """
    series = series_of(df) if series is None else series
    shares = df.where(F.col("value").isNotNull()).groupBy(*series, date).agg(
        (F.count_if(F.col("value") < 0) / F.count("value")).alias("frac_neg"),
        (F.count_if(F.col("value") > 0) / F.count("value")).alias("frac_pos"),
    )
    w = Window.partitionBy(*series)
    bad = (
        (F.least("frac_neg", "frac_pos") < min_fraction)
        | (F.col("frac_neg") < relative * F.median("frac_neg").over(w))
        | (F.col("frac_pos") < relative * F.median("frac_pos").over(w))
    )
    return shares.withColumn("degenerate", bad)


def drop_degenerate_days(
    df: DataFrame, series: Sequence[str] | None = None, date: str = "date", require_sound: bool = True, **limits: float
) -> DataFrame:
    """Rows of the sound days.

    A series that has days but no sound one is an error; without ``require_sound`` it has no rows
    and the other series keep theirs.
    """
    series = series_of(df) if series is None else series
    days = degenerate_days(df, series, date, **limits)
    sound = ~F.col("degenerate")
    if require_sound:
        n_sound = F.count_if(sound).over(Window.partitionBy(*series))
        none_left = F.raise_error(F.lit("every day of a series is degenerate")).cast("boolean")
        days = days.withColumn("n_sound", n_sound)
        sound = F.when(F.col("n_sound") == 0, none_left).otherwise(sound)
    kept = days.where(sound).select(*series, date)
    return key_join(df, materialise(kept, "sound-days"), [*series, date], "left_semi")


def keep_where_negative(df: DataFrame, companion: str, columns: Sequence[str], max_abs_lat: float = 20.0) -> DataFrame:
    """Keep vector columns only where the companion field is below zero in the tropics; else NULL."""
    keep = (F.col(companion) < 0) & (F.abs("lat") <= max_abs_lat)
    return df.withColumns({c: F.when(keep, F.col(c)) for c in columns})


def mask_weak_wind(df: DataFrame, threshold: float = 25.0) -> DataFrame:
    """Wind speed, NULL below the threshold."""
    speed = scalars.wind_speed(F.col("u"), F.col("v"))
    return df.withColumn("speed", F.when(speed >= threshold, speed))


def mask_latitudes(df: DataFrame, column: str = "value", low: float = 10.0, high: float = 75.0) -> DataFrame:
    """NULL near the equator and near the poles."""
    return df.withColumn(column, F.when(F.abs("lat").between(low, high), F.col(column)))
