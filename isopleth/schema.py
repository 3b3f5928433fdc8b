"""Canonical field table and the regular lat-lon grid it lies on.

A field is a long table with one row per (source, var, level, time, lat, lon).
Time is zone-free UTC (``timestamp_ntz``), so no result depends on the session
time zone.  A missing cell is a NULL value or an absent row; NaN never survives
the cleaning step.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIELD_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("var", T.StringType()),
        T.StructField("level", T.IntegerType()),
        T.StructField("time", T.TimestampNTZType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("value", T.DoubleType()),
    ]
)

#: Columns that tell series apart; no operator blends rows that differ in them unless told to.
SERIES = ("source", "var", "level")


def series_of(df: DataFrame) -> list[str]:
    """The series columns that the frame has."""
    return [c for c in SERIES if c in df.columns]


@dataclass(frozen=True)
class Grid:
    """Regular grid: first latitude/longitude, spacing and counts."""

    lat0: float
    dlat: float
    nlat: int
    lon0: float
    dlon: float
    nlon: int

    @property
    def cyclic(self) -> bool:
        return abs(self.nlon * self.dlon - 360.0) < 1e-9

    def i(self, lon: Column | str = "lon") -> Column:
        """Column index of a longitude; wraps on a cyclic grid."""
        lon = F.col(lon) if isinstance(lon, str) else lon
        raw = F.round((lon - self.lon0) / self.dlon).cast("int")
        return F.pmod(raw, F.lit(self.nlon)) if self.cyclic else raw

    def j(self, lat: Column | str = "lat") -> Column:
        """Row index of a latitude."""
        lat = F.col(lat) if isinstance(lat, str) else lat
        return F.round((lat - self.lat0) / self.dlat).cast("int")

    @property
    def lats(self) -> list[float]:
        return [self.lat0 + self.dlat * j for j in range(self.nlat)]

    @property
    def lons(self) -> list[float]:
        return [self.lon0 + self.dlon * i for i in range(self.nlon)]

    def lon(self, i: Column) -> Column:
        return i * F.lit(float(self.dlon)) + F.lit(float(self.lon0))

    def lat(self, j: Column) -> Column:
        return j * F.lit(float(self.dlat)) + F.lit(float(self.lat0))


def with_cell_index(df: DataFrame, grid: Grid) -> DataFrame:
    """Add the integer indices ``i`` (longitude) and ``j`` (latitude) used as join keys."""
    return df.withColumns({"i": grid.i(), "j": grid.j()})


def epoch_day(date: Column | str) -> Column:
    """Days since 1970-01-01, the integer axis of every day-based window."""
    return F.unix_date(F.to_date(date))


def key_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join that keeps the keys once and lets NULL levels match.

    ``level`` is the one key that may be NULL (single-level variables); the others are
    compared plainly, which keeps the join keys as they are and partitionings reusable.
    """
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    cond = None
    for k in keys:
        eq = left[k].eqNullSafe(renamed[f"__{k}"]) if k == "level" else left[k] == renamed[f"__{k}"]
        cond = eq if cond is None else cond & eq
    out = left.join(renamed, cond, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"__{k}" for k in keys])
