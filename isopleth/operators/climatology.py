"""Day-of-year climatology and anomalies."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isopleth.functions import scalars
from isopleth.operators.cleaning import time_slice
from isopleth.schema import key_join


def daily_climatology(
    df: DataFrame, base_start: dt.date, base_end: dt.date, cell: Sequence[str], date: str = "date"
) -> DataFrame:
    """Mean per cell and calendar day over the base period; 29 February counts as 28 February."""
    base = time_slice(df, base_start, base_end, date)
    return base.groupBy(*cell, scalars.calendar_key(F.col(date)).alias("day_key")).agg(
        F.avg("value").alias("clim"), F.count("value").alias("n_years")
    )


def period_climatology(clim: DataFrame, start: dt.date, end: dt.date, cell: Sequence[str]) -> DataFrame:
    """Climatological mean of a period: each calendar day weighted by how often it occurs there.

    The weight table has at most 365 rows however long the period is.
    """
    days = clim.sparkSession.range(1).select(
        F.explode(
            F.sequence(F.lit(start.isoformat()).cast("date"), F.lit(end.isoformat()).cast("date"))
        ).alias("d")
    )
    weights = days.groupBy(scalars.calendar_key(F.col("d")).alias("day_key")).agg(F.count("d").alias("n"))
    return (
        clim.join(F.broadcast(weights), "day_key")  # 365 rows at most
        .where(F.col("clim").isNotNull())
        .groupBy(*cell)
        .agg((F.sum(F.col("clim") * F.col("n")) / F.sum("n")).alias("clim"), F.sum("n").alias("n_days"))
    )


def anomaly(df: DataFrame, clim: DataFrame, cell: Sequence[str], date: str = "date") -> DataFrame:
    """Value minus climatology of the same cell and calendar day; no climatology gives NULL.

    The climatology (cells x 365) grows with the grid, so it carries no broadcast
    hint.  Hand in a stored table: its size is then known, and a small one is joined
    without shuffling the field.
    """
    keyed = df.withColumn("day_key", scalars.calendar_key(F.col(date)))
    joined = key_join(keyed, clim.select(*cell, "day_key", "clim"), [*cell, "day_key"], "left")
    return joined.withColumn("anomaly", F.col("value") - F.col("clim")).drop("day_key")
