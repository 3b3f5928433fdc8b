"""Requests for field data: checking, splitting into work units, addresses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isopleth.operators.cleaning import normalise_hours, resolve_variables
from isopleth.sources import tables


def validate_requests(df: DataFrame) -> DataFrame:
    """Add ``reason``: NULL for a valid request, else why it cannot be served.

    Needs columns ``var_key, level, start_date, end_date``.
    """
    checked = resolve_variables(df, on_unknown="reject")
    reason = (
        F.when(F.col("reject").isNotNull(), F.lit("unknown variable"))
        .when(F.col("needs_level") & F.col("level").isNull(), F.lit("level required"))
        .when(~F.col("needs_level") & F.col("level").isNotNull(), F.lit("level not accepted"))
        .when(F.col("end_date") < F.col("start_date"), F.lit("end before start"))
    )
    return checked.select(*df.columns, reason.alias("reason"))


def month_units(df: DataFrame) -> DataFrame:
    """One row per month a request touches; the last month stops at the end date.

    The first month starts at day 1, as monthly files do, so slice after reading.
    """
    month = F.explode(
        F.sequence(F.trunc("start_date", "MM"), F.col("end_date"), F.expr("interval 1 month"))
    )
    return (
        df.where(F.col("end_date") >= F.col("start_date"))
        .withColumn("first_day", month)
        .withColumn("last_day", F.least(F.last_day("first_day"), F.col("end_date")))
        .withColumns({"year": F.year("first_day"), "month": F.month("first_day")})
    )


def day_units(df: DataFrame) -> DataFrame:
    """One row per day of a request."""
    day = F.explode(F.sequence(F.col("start_date"), F.col("end_date"), F.expr("interval 1 day")))
    return df.where(F.col("end_date") >= F.col("start_date")).withColumn("day", day)


def level_key(template: Column, needs_level: Column, level: Column) -> Column:
    return F.when(needs_level, F.replace(template, F.lit("{nivel}"), level.cast("string"))).otherwise(template)


def request_urls(
    df: DataFrame, hours: Sequence[int] | None = None, base: str = tables.FILTER_URL, on_unknown: str = "error"
) -> DataFrame:
    """One address per request row and hour.

    Needs ``var_key, level, day`` and ``north, west, south, east`` (NULL north = whole globe).
    An unknown variable raises; with ``on_unknown="reject"`` its address is NULL, as is that of a request
    without the level it needs, and the column ``reject`` says why.
    """
    wide = resolve_variables(df, on_unknown=on_unknown).withColumn(
        "hour", F.explode(F.array(*[F.lit(h) for h in normalise_hours(hours)]))
    )
    hh = F.lpad(F.col("hour").cast("string"), 2, "0")
    ymd = F.date_format("day", "yyyyMMdd")

    def pair(name: Column | str, value: Column) -> Column:
        name = F.lit(name) if isinstance(name, str) else name
        return F.concat(F.url_encode(name), F.lit("="), F.url_encode(value))

    on = F.lit("on")
    area = F.when(
        F.col("north").isNotNull(),
        F.concat_ws(
            "&",
            pair("subregion", on),
            pair("toplat", F.col("north").cast("string")),
            pair("leftlon", F.col("west").cast("string")),
            pair("bottomlat", F.col("south").cast("string")),
            pair("rightlon", F.col("east").cast("string")),
        ),
    )
    query = F.concat_ws(
        "&",
        pair("file", F.concat(F.lit("gdas.t"), hh, F.lit("z.pgrb2.0p25.f000"))),
        pair(level_key(F.col("level_key"), F.col("needs_level"), F.col("level")), on),
        pair(F.concat(F.lit("var_"), F.col("secondary_code")), on),
        pair("dir", F.concat(F.lit("/gdas."), ymd, F.lit("/"), hh, F.lit("/atmos"))),
        area,
    )
    if on_unknown != "reject":
        return wide.select(*df.columns, "hour", F.concat(F.lit(base + "?"), query).alias("url"))
    unknown, unlevelled = F.col("reject").isNotNull(), F.col("needs_level") & F.col("level").isNull()
    why = F.when(unknown, "unknown variable").when(unlevelled, "no level")
    url = F.when(why.isNull(), F.concat(F.lit(base + "?"), query))
    return wide.select(*df.columns, "hour", url.alias("url"), why.alias("reject"))
