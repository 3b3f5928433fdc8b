"""Front passages per place."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isopleth.schema import epoch_day


def front_candidates(
    df: DataFrame, place: Sequence[str], dv_min: float, dtemp_min: float, step_hours: int = 6
) -> DataFrame:
    """Steps at which the meridional wind turns and the daily mean temperature falls.

    Needs ``time, v, temp`` with one row per place and step.  The turn compares
    steps exactly ``step_hours`` apart, the fall compares the means of consecutive days.

    The rows are placed and sorted once: both windows use the same order, and the
    thinning that follows stays in the same placement.
    """
    w = Window.partitionBy(*place).orderBy("day", "time")
    by_day = Window.partitionBy(*place).orderBy("day")
    steps = df.select(*place, "time", "v", "temp", epoch_day("time").alias("day"))
    steps = steps.select(
        *place,
        "time",
        "v",
        F.lag("v").over(w).alias("v0"),
        F.lag("time").over(w).alias("t0"),
        F.avg("temp").over(by_day.rangeBetween(0, 0)).alias("today"),
        F.avg("temp").over(by_day.rangeBetween(-1, -1)).alias("day_before"),
    )
    return steps.where(
        (F.col("v0") <= 0)
        & (F.col("v") > 0)
        & (F.col("v") - F.col("v0") > dv_min)
        & (F.col("time") == F.col("t0") + F.make_dt_interval(hours=F.lit(step_hours)))
        & (F.col("day_before") - F.col("today") > dtemp_min)
    ).select(*place, "time")


def thin_by_refractory(df: DataFrame, place: Sequence[str], hours: int) -> DataFrame:
    """Greedy thinning: an event counts iff ``hours`` have passed since the last counted one.

    Every place is sorted once and passed once: the rows of a partition stream by in order, and
    all that is carried is the place and the last counted instant.  Runs of any length cost
    time in proportion, and no place is held in memory.  Repeated instants count once.
    """
    origin, gap = F.lit("1970-01-01").cast("timestamp_ntz"), hours * 3_600_000_000
    keys = list(place)
    timed = df.where(F.col("time").isNotNull()).select(*keys, F.timestamp_diff("MICROSECOND", origin, F.col("time")).alias("h"))
    # a name for the place that compares fast; the place itself decides, so a clash of names does no harm
    name = F.xxhash64(*keys)
    placed = timed.withColumn("__p", name).repartition(*keys).sortWithinPartitions("__p", *keys, "h")

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, last = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            h = batch.column("h").to_numpy()
            columns = [batch.column(k) for k in keys]
            starts = [0, *_changes([batch.column("__p"), *columns]), batch.num_rows]
            keep: list[int] = []
            for lo, hi in zip(starts, starts[1:]):
                place_now = repr(tuple(c[lo].as_py() for c in columns))  # as text, since NaN differs from itself
                if place_now != here:
                    here, last = place_now, None
                k = lo
                while k < hi:
                    if last is not None:  # jump to the first row that is late enough
                        k = lo + int(np.searchsorted(h[lo:hi], last + gap))
                    if k < hi:
                        keep.append(k)
                        last = int(h[k])
                        k += 1
            yield batch.take(pa.array(keep, pa.int64())).select([*keys, "h"])

    schema = T.StructType([timed.schema[c] for c in (*keys, "h")])
    kept = placed.select(*keys, "h", "__p").mapInArrow(thin, schema)
    return kept.select(*keys, F.timestamp_add("MICROSECOND", F.col("h"), origin).alias("time"))


def _changes(columns: Sequence[pa.Array]) -> list[int]:
    """Rows at which any of the columns differs from the row before; NULL equals NULL, NaN equals NaN."""
    changed = np.zeros(max(0, len(columns[0]) - 1), bool)
    for c in columns:
        codes = c.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        changed |= codes[1:] != codes[:-1]
    return (np.flatnonzero(changed) + 1).tolist()


def front_passages(
    df: DataFrame,
    place: Sequence[str],
    dv_min: float = 2.0,
    dtemp_min: float = 1.0,
    refractory_hours: int = 24,
) -> DataFrame:
    """Dates of the front passages of each place."""
    return thin_by_refractory(front_candidates(df, place, dv_min, dtemp_min), place, refractory_hours)


def passages_per_place(events: DataFrame, place: Sequence[str]) -> DataFrame:
    return events.groupBy(*place).agg(F.count(F.lit(1)).alias("n_events"), F.min("time").alias("first_event"))
