"""Which days does a field hold?"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isopleth.schema import Grid, key_join, series_of



def _day(d: dt.date) -> Column:
    return F.lit(d.isoformat()).cast("date")


def present_days(df: DataFrame, keys: Sequence[str], col: str = "time") -> DataFrame:
    """Distinct days per key; partial aggregation reduces to one row per day before the shuffle."""
    return df.select(*keys, F.to_date(col).alias("day")).distinct()


def covers_period(df: DataFrame, start: dt.date, end: dt.date, keys: Sequence[str], col: str = "time") -> DataFrame:
    """Per key: does [first day, last day] contain the period?  An absent key has no row; see ``covers_wanted``."""
    day = F.to_date(col)
    return df.groupBy(*keys).agg(
        F.coalesce((F.min(day) <= _day(start)) & (F.max(day) >= _day(end)), F.lit(False)).alias("covers")
    )


def covers_wanted(df: DataFrame, wanted: DataFrame, keys: Sequence[str], col: str = "time") -> DataFrame:
    """``covers`` for each wanted row (keys, start_date, end_date); an absent series gives false."""
    day = F.to_date(col)
    have = df.groupBy(*keys).agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    ok = (F.col("first_day") <= F.col("start_date")) & (F.col("last_day") >= F.col("end_date"))
    return key_join(wanted, have, list(keys), "left").withColumn("covers", F.coalesce(ok, F.lit(False)))


def coverage_report(df: DataFrame, start: dt.date, end: dt.date, keys: Sequence[str], col: str = "time") -> DataFrame:
    """Per key: first and last day, days expected and present in the period, and a status.

    Two-step aggregation (days, then keys) so a key with many steps per day is
    reduced on the map side.
    """
    expected = (end - start).days + 1
    inside = F.col("day").between(_day(start), _day(end))
    status = (
        F.when((F.col("first_day") > _day(start)) | (F.col("last_day") < _day(end)), "out_of_range")
        .when(F.col("days_present") < expected, "gaps")
        .otherwise("ok")
    )
    return (
        present_days(df, keys, col)
        .groupBy(*keys)
        .agg(
            F.min("day").alias("first_day"),
            F.max("day").alias("last_day"),
            F.count_if(inside).alias("days_present"),
        )
        .withColumn("days_expected", F.lit(expected).cast("long"))
        .withColumn("status", status)
    )


def require_coverage(df: DataFrame, start: dt.date, end: dt.date, keys: Sequence[str], col: str = "time") -> None:
    """Raise with the requested and available range of the first series that falls short."""
    bad = coverage_report(df, start, end, keys, col).where(F.col("status") != "ok").limit(1).collect()
    if bad:
        r = bad[0]
        raise RuntimeError(
            f"{r['status']}: wanted {start} to {end} ({r['days_expected']} days), "
            f"have {r['first_day']} to {r['last_day']} ({r['days_present']} days in the period)"
        )


def missing_days(df: DataFrame, start: dt.date, end: dt.date, keys: Sequence[str], col: str = "time") -> DataFrame:
    """Days of the period that a series lacks."""
    present = present_days(df, keys, col)
    spine = present.select(*keys).distinct().withColumn("day", F.explode(F.sequence(_day(start), _day(end))))
    return key_join(spine, present, [*keys, "day"], "left_anti")


def missing_longitudes(df: DataFrame, west: float = 175.0, east: float = 181.0, grid: Grid | None = None) -> DataFrame:
    """Longitudes of the window that hold at least one missing value, for each series, with the counts.

    The window is in degrees east (0 to 360); longitudes meet it however they are wrapped, and are given
    as the field has them.  With ``grid``, its columns that a series has no row of are reported too
    (``n_rows`` 0), with the grid's longitude.
    """
    series = series_of(df)
    rows = df.select(*series, "lon", F.col("value").isNull().cast("int").alias("gap"), F.lit(1).alias("row"))
    if grid is not None:
        columns = F.explode(F.array(*[F.lit(float(x)) for x in grid.lons]))
        spine = df.select(*series).distinct() if series else df.select(F.lit(1).alias("one")).limit(1)
        rows = rows.unionByName(spine.select(*series, columns.alias("lon"), F.lit(0).alias("gap"), F.lit(0).alias("row")))
    at = F.pmod(F.round("lon", 6), F.lit(360.0))
    found = rows.where(at.between(west, east)).groupBy(*series, at.alias("at")).agg(
        F.coalesce(F.min(F.when(F.col("row") == 1, F.col("lon"))), F.min("lon")).alias("lon"),
        F.sum("gap").alias("n_missing"),
        F.sum("row").alias("n_rows"),
    )
    return found.where("n_missing > 0 or n_rows = 0").drop("at")
