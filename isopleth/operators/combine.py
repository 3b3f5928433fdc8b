"""Put sources together: append, splice, mosaic, align, keep the latest."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isopleth.schema import key_join, series_of
from isopleth.session import materialise
from isopleth.sources import tables


def concat_steps(
    parts: Sequence[DataFrame], keys: Sequence[str] | None = None, check: bool = True
) -> DataFrame:
    """Append step tables of one grid; a (step, cell) that occurs twice in a series is an error.

    By default series, time and cell are the keys; only numbers are left to carry then, so
    the check is a hash aggregation and nothing is sorted.

    The check is an aggregation on the keys and shuffles the field once; pass
    ``check=False`` for parts known to be disjoint and the append needs no shuffle.
    """
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if not check:
        return rows
    keys = [*series_of(rows), "time", "lat", "lon"] if keys is None else keys
    rest = [c for c in rows.columns if c not in keys]
    once = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *[F.any_value(c).alias(c) for c in rest])
    twice = F.raise_error(F.lit("a cell occurs twice in one step")).cast("boolean")
    return once.where(F.when(F.col("__n") > 1, twice).otherwise(True)).drop("__n")


def last_primary_days(primary: DataFrame, series: Sequence[str], col: str = "time") -> DataFrame:
    """Last day of the primary source per series."""
    return primary.groupBy(*series).agg(F.max(F.to_date(col)).alias("last_day"))


def splice_sources(
    primary: DataFrame,
    secondary: DataFrame,
    start: dt.date,
    end: dt.date,
    today: dt.date,
    series: Sequence[str] = ("var", "level"),
    col: str = "time",
    last_days: DataFrame | None = None,
) -> DataFrame:
    """Primary source to its last day, secondary from the next day to ``end``.

    Gaps inside the primary range stay gaps.  A series that the primary source does not have
    comes from the secondary source from ``start`` on.  The last primary day is the one of the rows,
    or that of ``last_days`` (series, last_day), where a NULL means that the source has the series but its last
    day is unknown: then ``today - 8 days`` is taken.  The cutoffs, one row per series, are stored first, so
    neither source is shuffled while they fit a broadcast.
    """
    fallback = F.lit((today - dt.timedelta(days=tables.UNKNOWN_LAST_DAY_MARGIN)).isoformat()).cast("date")
    lo, hi = F.lit(start.isoformat()).cast("timestamp_ntz"), F.lit((end + dt.timedelta(days=1)).isoformat()).cast("timestamp_ntz")
    in_period = (F.col(col) >= lo) & (F.col(col) < hi)
    cutoffs = last_primary_days(primary, series, col) if last_days is None else last_days.select(*series, "last_day")
    cutoffs = materialise(cutoffs.withColumn("last_day", F.coalesce("last_day", fallback)), "cutoffs")
    keep = [c for c in primary.columns if c in secondary.columns]
    tail = (
        key_join(secondary.where(in_period), cutoffs, list(series), "left")
        .where(F.col("last_day").isNull() | (F.to_date(col) > F.col("last_day")))
        .select(*keep)
    )
    head = primary.where(in_period)
    if last_days is not None:  # what the primary source has beyond its stated last day gives way
        head = key_join(head, cutoffs, list(series), "left").where(F.to_date(col) <= F.col("last_day"))
    return head.select(*keep).unionByName(tail)


def align_fields(a: DataFrame, b: DataFrame, keys: Sequence[str], suffixes: tuple[str, str] = ("_a", "_b")) -> DataFrame:
    """Cells and steps present in both fields, values side by side."""
    left = a.select(*keys, F.col("value").alias("value" + suffixes[0]))
    right = b.select(*keys, F.col("value").alias("value" + suffixes[1]))
    return key_join(left, right, list(keys), "inner")


def mosaic(primary: DataFrame, secondary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Primary where it has a value, secondary elsewhere; ``origin`` tells which.

    The sources are appended as two columns and reduced by one hash aggregation
    instead of a full outer join: rows meet on the map side where they can, nothing
    is sorted, and each row crosses the network once at most.
    """
    first, none = F.col("value"), F.lit(None).cast("double")
    both = primary.select(*keys, first.alias("p"), none.alias("s")).unionByName(
        secondary.select(*keys, none.alias("p"), first.alias("s"))
    )
    return (
        both.groupBy(*keys)
        .agg(F.max("p").alias("p"), F.max("s").alias("s"))
        .where(F.col("p").isNotNull() | F.col("s").isNotNull())
        .select(
            *keys,
            F.coalesce("p", "s").alias("value"),
            F.when(F.col("p").isNotNull(), "primary").otherwise("secondary").alias("origin"),
        )
    )


def splice_forecast(
    observed: DataFrame, forecast: DataFrame, series: Sequence[str], day: str = "date", lead: str = "lead_days"
) -> DataFrame:
    """Observed days, then forecast days after the last observed one; lead 0 is dropped.

    A series without observations is all forecast.
    """
    last = materialise(observed.groupBy(*series).agg(F.max(day).alias("last_day")), "last-days")
    keep = [*series, day, "value"]
    ahead = (
        key_join(forecast.where(F.col(lead) > 0), last, list(series), "left")
        .where(F.col("last_day").isNull() | (F.col(day) > F.col("last_day")))
        .select(*keep, F.lit(True).alias("is_forecast"))
    )
    return observed.select(*keep, F.lit(False).alias("is_forecast")).unionByName(ahead)


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the greatest by ``order``.

    ``max_by`` reduces on the map side, so copies of one hot key never meet in one
    task the way a ranked window would make them.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("best"))
    return best.select(*keys, *[F.col(f"best.{c}").alias(c) for c in rest])


def latest_forecasts(records: DataFrame) -> DataFrame:
    """Latest record per (model, init, target)."""
    return keep_latest(records, ["model", "init", "target"], [F.col("loaded_at"), F.col("value")])


def upsert_forecasts(archive: DataFrame) -> DataFrame:
    """Verification archive: latest record per (model, init, target), with its lead."""
    return latest_forecasts(archive).withColumn("lead_days", F.date_diff("target", "init"))


def upsert_observed(archive: DataFrame, best_source: str = "primary") -> DataFrame:
    """Observed archive: one row per date, the best source wins, then the latest record."""
    rank = (F.col("source") == best_source).cast("int")
    return keep_latest(archive, ["date"], [rank, F.col("loaded_at"), F.col("value")])
