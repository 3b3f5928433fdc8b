"""Moving means, blocks, filters and gap filling along the day axis.

Every series here holds one value per day (reduce with ``daily_mean`` first), so
a window partition is bounded by the length of the calendar -- some 366 rows a
year -- no matter how many raw rows fed it.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isopleth.functions import scalars
from isopleth.schema import epoch_day

#: Days of a block of the band-pass filter, in half widths; a block's row also holds half a width on either side.
BLOCK_SPANS = 4


def moving_mean(df: DataFrame, cell: Sequence[str], days: int = 5, date: str = "date") -> DataFrame:
    """Mean of [d, d+days-1] labelled by d, only where every day has a value."""
    w = Window.partitionBy(*cell).orderBy(epoch_day(date)).rangeBetween(0, days - 1)
    return (
        df.select(*cell, date, F.avg("value").over(w).alias("mean"), F.count("value").over(w).alias("n"))
        .where(F.col("n") == days)
        .select(*cell, date, F.col("mean").alias("value"))
    )


def block_means(
    df: DataFrame,
    cell: Sequence[str],
    anchor: dt.date,
    lengths: Sequence[int] = (5,),
    min_days: int | None = None,
    date: str = "date",
) -> DataFrame:
    """Consecutive blocks of one or more lengths; the first one starts the day after ``anchor``.

    Five-day blocks need four days, other lengths all days, unless ``min_days`` says
    otherwise.  All lengths share one scan and one aggregation.
    """
    origin = F.lit(anchor.isoformat()).cast("date")
    since = F.date_diff(F.col(date), origin)
    days = F.col("days")
    need = F.lit(min_days) if min_days is not None else F.when(days == 5, 4).otherwise(days)
    rows = df.where(F.col("value").isNotNull() & (since >= 1)).select(*cell, date, "value")
    if len(lengths) > 1:
        rows = rows.repartition(*cell)  # the copies below then need no shuffle of their own
    return (
        rows.withColumn("days", F.explode(F.array(*[F.lit(int(n)) for n in lengths])))
        .groupBy(*cell, "days", F.floor((since - 1) / days).cast("int").alias("block"))
        .agg(F.avg("value").alias("value"), F.count(F.lit(1)).alias("n_days"))
        .where(F.col("n_days") >= need)
        .withColumn("block_start", F.date_add(origin, F.col("block") * days + 1))
    )


def remove_preceding_mean(
    df: DataFrame,
    cell: Sequence[str],
    days: int = 120,
    date: str = "date",
    value: str = "value",
    min_days: int | None = None,
) -> DataFrame:
    """Value minus the mean of the preceding ``days`` days (the day itself left out).

    All of these days must have a value unless ``min_days`` asks for fewer.

    The sum over a window is the difference of two running sums, at its end and at its begin.
    Each day therefore stands in the order twice, and one growing frame answers for both places,
    so the work does not depend on the length of the window.  The sums are those of deviations
    from the first value of the series, which keeps their differences precise.  NaN counts as missing.
    """
    series = Window.partitionBy(*cell)
    v = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    rows = df.select(*cell, F.col(date).alias("__date"), epoch_day(date).alias("__day"), v.alias("__v"))
    whole = series.orderBy("__day").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("__base", F.first("__v", ignorenulls=True).over(whole))
    # every day stands at its own place, and once more where its window begins, as a question only
    places = F.array(
        F.struct(F.col("__day").alias("at"), (F.col("__v") - F.col("__base")).alias("dev"), F.lit(False).alias("begin")),
        F.struct((F.col("__day") - days).alias("at"), F.lit(None).cast("double").alias("dev"), F.lit(True).alias("begin")),
    )
    before = series.orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    asked = rows.select("*", F.inline(places)).withColumns(
        {"s": F.coalesce(F.sum("dev").over(before), F.lit(0.0)), "n": F.count("dev").over(before)}
    )
    own_day = series.orderBy("__day").rangeBetween(0, 0)
    begin = {c: F.max(F.when(F.col("begin"), F.col(c))).over(own_day) for c in ("s", "n")}
    found = asked.withColumns({"s0": begin["s"], "n0": begin["n"]}).where(~F.col("begin"))
    n = F.col("n") - F.col("n0")
    past = F.col("__base") + (F.col("s") - F.col("s0")) / n
    return found.where((n >= max(1, days if min_days is None else min_days)) & F.col("__v").isNotNull()).select(
        *cell, F.col("__date").alias(date), (F.col("__v") - past).alias("value")
    )


def lanczos_weights(half_width: int = 60, period_min: float = 20.0, period_max: float = 90.0) -> list[float]:
    """Band-pass weights for lags -half_width..half_width (Duchon, 1979)."""
    f_high, f_low = 1.0 / period_min, 1.0 / period_max
    out = []
    for k in range(-half_width, half_width + 1):
        if k == 0:
            out.append(2.0 * (f_high - f_low))
            continue
        x = math.pi * k
        sigma = math.sin(x / half_width) / (x / half_width)
        out.append((math.sin(2 * f_high * x) - math.sin(2 * f_low * x)) / x * sigma)
    return out


def lanczos_band_pass(
    df: DataFrame,
    cell: Sequence[str],
    half_width: int = 60,
    period_min: float = 20.0,
    period_max: float = 90.0,
    date: str = "date",
) -> DataFrame:
    """Centred band-pass; beyond the ends the first and last value are repeated.

    Overlap-save: a series is cut into blocks of the calendar, and each block, with ``half_width`` days of
    its neighbours on either side, is one row.  The rows are placed by series once; the
    blocks of an Arrow batch are then filtered by one product with a banded matrix.  A target
    that lacks a tap, or has a day among its taps that stands twice, is not emitted; one with a
    NaN or an infinite tap is NaN.
    """
    weights = np.array(lanczos_weights(half_width, period_min, period_max))
    length = BLOCK_SPANS * half_width
    series = Window.partitionBy(*cell)
    day = epoch_day(date)
    rows = df.where(F.col("value").isNotNull()).select(
        *cell,
        day.alias("day"),
        F.col("value").cast("double").alias("value"),
        F.min(day).over(series).alias("first"),
        F.max(day).over(series).alias("last"),
    )
    holders = F.sequence(*[F.floor((F.col("day") + shift) / length).cast("int") for shift in (-half_width, half_width)])
    blocks = (
        rows.select(*cell, "first", "last", F.struct("day", "value").alias("v"), F.explode(holders).alias("block"))
        .groupBy(*cell, "block")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.collect_list("v").alias("days"))
        .select(*cell, "block", "first", "last", "days")
    )
    kinds = T.StructType([*blocks.select(*cell, "block").schema.fields, T.StructField("filtered", T.ArrayType(T.DoubleType()))])
    target = F.col("block") * length + F.col("k")
    return (
        blocks.mapInArrow(_block_filter(weights, length), kinds)
        .select(*cell, "block", F.posexplode("filtered").alias("k", "value"))
        .where(F.col("value").isNotNull())
        .select(*cell, F.date_from_unix_date(target).alias(date), "value")
    )


def _block_filter(weights: np.ndarray, length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Filter of blocks of ``length`` days; a target that is not emitted is NULL in its block's array."""
    half = len(weights) // 2
    width = length + 2 * half
    band, taps = np.zeros((width, length)), np.zeros((width, length))
    for k in range(length):
        band[k : k + len(weights), k] = weights
        taps[k : k + len(weights), k] = 1.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            first, last, block = (batch.column(c).to_numpy()[:, None].astype(np.int64) for c in ("first", "last", "block"))
            begin = block * length - half
            days = batch.column("days")
            day, value = (x.to_numpy(zero_copy_only=False) for x in days.flatten().flatten())
            row = np.repeat(np.arange(n), np.diff(days.offsets.to_numpy()))
            at = day - begin[row, 0]
            own, times = np.zeros((n, width)), np.zeros((n, width))
            own[row, at] = value
            np.add.at(times, (row, at), 1.0)
            # a day beyond an end takes the place of that end
            places = np.clip(np.clip(begin + np.arange(width), first, last) - begin, 0, width - 1)
            own, times = np.take_along_axis(own, places, 1), np.take_along_axis(times, places, 1)
            odd = ~np.isfinite(own)
            out = np.where(odd, 0.0, own) @ band
            if odd.any():
                out[odd.astype(float) @ taps > 0] = np.nan
            target = block * length + np.arange(length)
            kept = ((times == 1.0).astype(float) @ taps == len(weights)) & (target >= first) & (target <= last)
            values = pa.array(out.ravel(), pa.float64(), mask=~kept.ravel())
            filtered = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * length), values)
            names = [c for c in batch.schema.names if c not in ("first", "last", "days")]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], filtered], [*names, "filtered"])

    return run


def fill_gaps_in_time(df: DataFrame, cell: Sequence[str], date: str = "date") -> DataFrame:
    """Linear fill between known neighbours; nothing beyond the ends; filled rows are flagged.

    Each known day looks one row ahead and generates the days up to it, so no date
    spine has to be joined.
    """
    w = Window.partitionBy(*cell).orderBy(date)
    known = df.where(F.col("value").isNotNull()).select(
        *cell,
        F.col(date).alias("d0"),
        F.col("value").alias("v0"),
        F.lead(date).over(w).alias("d1"),
        F.lead("value").over(w).alias("v1"),
    )
    last = F.coalesce(F.date_sub("d1", 1), F.col("d0"))
    step = F.date_diff(date, "d0")
    value = F.when(step == 0, F.col("v0")).otherwise(
        F.col("v0") + (F.col("v1") - F.col("v0")) * step / F.date_diff("d1", "d0")
    )
    return known.withColumn(date, F.explode(F.sequence("d0", last))).select(
        *cell, date, value.alias("value"), (step > 0).alias("filled")
    )


def fill_gaps_in_longitude(df: DataFrame, row: Sequence[str], dlon: float, cyclic: bool = False) -> DataFrame:
    """The same along a latitude circle between known longitudes; ``row`` names one circle.

    On a ``cyclic`` grid the first known longitude also follows the last, so that a gap across the
    date line is filled; longitudes are then given in [-180, 180).
    """
    w = Window.partitionBy(*row).orderBy("lon")
    circle = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def following(name: str, turn: float) -> Column:
        after = F.lead(name).over(w)
        return F.coalesce(after, F.first(name).over(circle) + turn) if cyclic else after

    known = df.where(F.col("value").isNotNull()).select(
        *row,
        F.col("lon").alias("x0"),
        F.col("value").alias("v0"),
        following("lon", 360.0).alias("x1"),
        following("value", 0.0).alias("v1"),
    )
    gaps = F.coalesce(F.round((F.col("x1") - F.col("x0")) / dlon).cast("int"), F.lit(1))
    wide = known.withColumn("gaps", gaps).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("gaps") - 1)))
    value = F.when(F.col("k") == 0, F.col("v0")).otherwise(
        F.col("v0") + (F.col("v1") - F.col("v0")) * F.col("k") / F.col("gaps")
    )
    lon = F.col("x0") + F.col("k") * dlon
    return wide.select(
        *row, (scalars.wrap_longitude(lon) if cyclic else lon).alias("lon"), value.alias("value"), (F.col("k") > 0).alias("filled")
    )
