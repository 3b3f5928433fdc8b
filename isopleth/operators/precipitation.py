"""Accumulated precipitation: totals, increments, daily sums, types.

A run holds one row per forecast step, so a window over a run or a cell is
bounded by the number of steps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isopleth.sources import tables


def running_total(df: DataFrame, cell: Sequence[str], time: str, value: str = "value") -> DataFrame:
    """Sum from the first step on; a missing step adds nothing."""
    w = Window.partitionBy(*cell).orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("total", F.sum(F.coalesce(F.col(value), F.lit(0.0))).over(w))


def period_total(df: DataFrame, cell: Sequence[str], time: str) -> DataFrame:
    """Figure of a period of running totals: the last total, never their mean."""
    return df.groupBy(*cell).agg(F.max_by("total", time).alias("total"), F.max(time).alias("last_step"))


def de_accumulate(df: DataFrame, run: Sequence[str], step: str, total: str = "total") -> DataFrame:
    """Totals since the start of a run to increments per step; the first step keeps its value."""
    w = Window.partitionBy(*run).orderBy(step)
    return df.withColumn("increment", F.col(total) - F.lag(total, 1, 0.0).over(w))


def daily_sum_of_buckets(
    df: DataFrame, cell: Sequence[str], buckets: int = 4, time: str = "time", label_lag_hours: int = 0
) -> DataFrame:
    """Daily sum of buckets that reset; kept only when every bucket of the day is there once, with a value.

    Rows of one cell and time are one bucket; a bucket that is there twice does not stand for
    another that is missing, and its day is dropped.

    A bucket belongs to the day of its label; where labels mark the end of a bucket,
    ``label_lag_hours`` (its length) takes the 00 UTC bucket to the day before.
    """
    start = F.col(time) - F.make_dt_interval(hours=F.lit(label_lag_hours)) if label_lag_hours else F.col(time)
    one = df.groupBy(*cell, start.alias("bucket")).agg(F.sum("value").alias("value"), F.count("value").alias("rows"))
    return (
        one.groupBy(*cell, F.to_date("bucket").alias("date"))
        .agg(F.sum("value").alias("value"), F.count(F.lit(1)).alias("n"), F.max("rows").alias("most"), F.min("rows").alias("least"))
        .where((F.col("n") == buckets) & (F.col("most") == 1) & (F.col("least") == 1))
        .drop("n", "most", "least")
    )


def precipitation_class(code: str = "code"):
    """Type name of a precipitation code; NULL when it belongs to no class."""
    c = F.col(code)
    return (
        F.when(c.isin(*tables.RAIN_CODES), "rain")
        .when(c.isin(*tables.ICE_CODES), "ice")
        .when(c.isin(*tables.MIXED_CODES), "mixed")
        .when(c.isin(*tables.SNOW_CODES), "snow")
    )


def split_by_type(df: DataFrame, run: Sequence[str], step: str, code: str = "code") -> DataFrame:
    """Increment per type (zero outside its type), snow depth in cm and running totals per type."""
    kind = precipitation_class(code)
    types = ("rain", "ice", "mixed", "snow")
    w = Window.partitionBy(*run).orderBy(step).rowsBetween(Window.unboundedPreceding, 0)
    out = df.withColumn("kind", kind)
    out = out.withColumns(
        {t: F.when(F.col("kind") == t, F.col("increment")).otherwise(0.0) for t in types}
    ).withColumn("snow_cm", F.col("snow") * tables.SNOW_RATIO / 10.0)
    return out.withColumns({f"{t}_total": F.sum(t).over(w) for t in (*types, "snow_cm")})


def type_from_flags(df: DataFrame, flags: Sequence[tuple[str, str]]) -> DataFrame:
    """Type from yes/no columns (column, type): one set -> that type, several -> mixed, none -> dry."""
    count = sum((F.coalesce(F.col(c).cast("int"), F.lit(0)) for c, _ in flags), F.lit(0))
    single = F.coalesce(*[F.when(F.col(c).cast("int") == 1, F.lit(t)) for c, t in flags])
    return df.withColumn("kind", F.when(count == 0, "dry").when(count > 1, "mixed").otherwise(single))
