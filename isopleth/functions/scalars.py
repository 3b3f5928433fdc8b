"""Column functions.  All stay inside generated JVM code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from isopleth.sources import tables


def wrap_longitude(lon: Column) -> Column:
    """Longitude in [-180, 180); 180 itself becomes -180."""
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def null_if_missing(value: Column, fills: Sequence[float] = (), limit: float | None = None) -> Column:
    """NULL for NaN, for declared fill values and for magnitudes above ``limit``."""
    bad = F.isnan(value)
    if fills:
        bad = bad | value.isin([float(f) for f in fills])
    if limit is not None:
        bad = bad | (F.abs(value) > float(limit))
    return F.when(~bad, value)


def wind_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def wind_direction(u: Column, v: Column) -> Column:
    """Direction the wind blows from, degrees clockwise from north; NULL when calm."""
    angle = F.pmod(F.degrees(F.atan2(u, v)) + 180.0, F.lit(360.0))
    return F.when((u != 0) | (v != 0), angle)


def pa_to_hpa(pressure: Column) -> Column:
    return pressure / 100.0


def local_clock(time: Column, offset_hours: int = -3) -> Column:
    """UTC to a fixed-offset clock."""
    return time + F.make_dt_interval(hours=F.lit(offset_hours))


def floor_hours(time: Column, hours: int) -> Column:
    """Start of the ``hours``-wide bucket of the day that holds ``time``."""
    step = (F.floor(F.hour(time) / hours) * hours).cast("int")
    return F.to_date(time).cast("timestamp_ntz") + F.make_dt_interval(hours=step)


def title_case(word: Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the others."""
    return F.array_join(
        F.transform(
            F.split(word, ""),
            lambda c, k: F.when(
                (k > 0) & F.substring(word, k, F.lit(1)).rlike(r"^\p{L}$"), F.lower(c)
            ).otherwise(F.upper(c)),
        ),
        "",
    )


def area_display_name(area: Column) -> Column:
    """``zcit_3d_sul`` -> ``ZCIT 3D Sul``: acronyms in capitals, other words in title case."""
    words = F.transform(
        F.split(area, "_"),
        lambda w: F.when(F.lower(w).isin(list(tables.ACRONYMS)), F.upper(w)).otherwise(title_case(w)),
    )
    return F.array_join(words, " ")


def says_no_data_yet(message: Column) -> Column:
    """Does a source's error text mean that the period is not published yet?"""
    text = F.lower(message)
    hit = F.lit(False)
    for part in tables.NO_DATA_TEXTS:
        hit = hit | F.contains(text, F.lit(part))
    return hit


def latest_date_in(message: Column) -> Column:
    """Last published day quoted in a source's error text; NULL if absent or no real date."""
    found = F.regexp_extract(message, tables.LATEST_DATE_PATTERN, 1)
    return F.try_to_date(F.nullif(found, F.lit("")), "yyyy-MM-dd")


def to_ftp_url(
    url: Column,
    hosts: Sequence[str] = tables.FTP_MIRRORED_HOSTS,
    ftp_host: str = tables.FTP_HOST,
    prefix: str = tables.FTP_DROPPED_PREFIX,
) -> Column:
    """Send a mirrored HTTP address to the FTP host: path kept, query dropped, others unchanged."""
    host = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^?#]*)", 1)
    path = F.replace(F.regexp_replace(path, r";[^/]*$", ""), F.lit(prefix), F.lit("/"))
    mirrored = F.lit(False)
    for name in hosts:
        mirrored = mirrored | F.contains(host, F.lit(name))
    return F.when(mirrored, F.concat(F.lit(f"ftp://{ftp_host}"), path)).otherwise(url)


def calendar_key(date: Column) -> Column:
    """month*100+day with 29 February sharing the key of 28 February."""
    key = F.month(date) * 100 + F.dayofmonth(date)
    return F.when(key == 229, 228).otherwise(key)


def in_box(lat: Column, lon: Column, north: Column, west: Column, south: Column, east: Column) -> Column:
    """Inclusive box test on wrapped longitudes; west > east crosses the antimeridian."""
    inside = F.when(west <= east, lon.between(west, east)).otherwise((lon >= west) | (lon <= east))
    return lat.between(south, north) & inside


def cos_weight(lat: Column) -> Column:
    return F.cos(F.radians(lat))
