"""Stored tables whose units are replaced as a whole while others read.

    root/data/version=<id>/<unit columns>/part-*.parquet    never changed once written
    root/ledger/part-*.parquet                              one file a publication

A unit is written to a fresh version folder, measured and checked there, and becomes visible by
one more file in the ledger, which points to it.  Readers see the pointers of the latest
publication of each unit, so they see either all of a publication or nothing of it; what was
written but not published is never seen, and the units before it stay as they were.

The pointers carry statistics of their units (rows, values, first and last instant, the days that
have rows), so coverage is answered from the ledger without opening a data file.

One publisher works on a table at a time; readers need no care.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isopleth.operators.combine import keep_latest
from isopleth.schema import SERIES
from isopleth.session import materialise, path_exists, remove_dir
from isopleth.sources.fields import MONTHLY, level_text

#: Touched units up to which a merge names them in a filter, so that directories are pruned when the plan is made.
LISTED_UNITS = 1000


@dataclass(frozen=True)
class Staged:
    """A written version that is not yet visible, and the statistics of its units."""

    root: str
    version: str
    units: tuple[str, ...]
    schema: str
    stats: DataFrame


def with_unit_columns(df: DataFrame, units: Sequence[str] = MONTHLY, time: str = "time") -> DataFrame:
    """Add the unit columns that follow from the level and the instant; a NULL level is ``none``."""
    parts = {"year": F.year(time), "month": F.month(time), "day": F.dayofmonth(time)}
    out = df.withColumns({c: parts[c] for c in units if c in parts and c not in df.columns})
    return out.withColumn("level", level_text(F.col("level"))) if "level" in units else out


def _read(spark: SparkSession, root: str, versions: Sequence[str], schema: str) -> DataFrame:
    """Rows of some versions, with the column ``version``; unit columns keep their types (no guessing from names)."""
    kind = T.StructType.fromJson(json.loads(schema)).add("version", "string")
    if not versions:
        return spark.createDataFrame([], kind)
    paths = [f"{root}/data/version={v}" for v in versions]
    return spark.read.schema(kind).option("basePath", f"{root}/data").parquet(*paths)


def stage(
    df: DataFrame, root: str, units: Sequence[str] = MONTHLY, time: str = "time", order: Sequence[str | Column] = ("lat", "lon")
) -> Staged:
    """Write the units of ``df`` to a fresh version and measure them.

    A unit's rows are brought together, a large unit is split.  Rows lie in the given order within
    a file, the instant last, so that the statistics of row groups tell places apart.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    rows = with_unit_columns(df, units, time)
    inner = [c for c in order if not isinstance(c, str) or c in rows.columns]
    placed = rows.hint("rebalance", *[F.col(c) for c in units]).sortWithinPartitions(*units, *inner, time)
    placed.write.partitionBy(*units).parquet(f"{root}/data/version={version}")
    # partition columns come last when a table is read
    schema = T.StructType([f for f in rows.schema.fields if f.name not in units] + [rows.schema[c] for c in units]).json()
    value = F.count("value") if "value" in rows.columns else F.count(F.lit(1))
    stats = _read(spark, root, [version], schema).groupBy("version", *units).agg(
        F.count(F.lit(1)).alias("n_rows"),
        value.alias("n_values"),
        F.min(time).cast("timestamp_ntz").alias("first_time"),
        F.max(time).cast("timestamp_ntz").alias("last_time"),
        F.array_sort(F.collect_set(F.to_date(time))).alias("days"),
    )
    return Staged(root, version, tuple(units), schema, materialise(stats, "unit-stats"))


def _ledger(spark: SparkSession, root: str) -> DataFrame | None:
    path = f"{root}/ledger"
    return spark.read.parquet(path) if path_exists(spark, path) else None


def publish(staged: Staged, check: Callable[[DataFrame], None] | None = None, batch: str | None = None) -> None:
    """Make a staged version visible; ``check`` may look at the units' statistics and raise.

    The pointers go into one file by one task (they are a row for each unit of the version), and a
    file appears in the ledger as a whole or not at all.
    """
    if check is not None:
        check(staged.stats)
    spark = staged.stats.sparkSession
    known = _ledger(spark, staged.root)
    seq = 1 + ((known.agg(F.max("seq")).first()[0] or 0) if known is not None else 0)
    rows = staged.stats.withColumns(
        {"seq": F.lit(seq).cast("long"), "batch": F.lit(batch).cast("string"), "schema": F.lit(staged.schema), "units": F.lit(",".join(staged.units))}
    )
    rows.coalesce(1).write.mode("append").parquet(f"{staged.root}/ledger")


def require_units(min_rows: int = 1, days_expected: int | None = None) -> Callable[[DataFrame], None]:
    """Check that every unit has rows enough and, if asked, that many days."""

    def check(stats: DataFrame) -> None:
        short = F.col("n_rows") < min_rows
        if days_expected is not None:
            short = short | (F.size("days") < days_expected)
        bad = stats.where(short).limit(1).collect()
        if bad:
            raise ValueError(f"unit falls short: {bad[0].asDict()}")

    return check


def pointers(spark: SparkSession, root: str) -> DataFrame:
    """One row per unit, that of its latest publication, with its statistics."""
    known = _ledger(spark, root)
    if known is None:
        raise FileNotFoundError(f"nothing is published below {root}")
    units = known.select("units").first()[0].split(",")
    return keep_latest(known, units, [F.col("seq")])


def read_published(spark: SparkSession, root: str, where: Column | None = None) -> DataFrame:
    """Rows of the published units; ``where`` picks units by their columns.

    The versions in use are named when the plan is made, so no other folder is listed; the
    pointers decide which units of a version still count.  They are a row a unit and stored, so
    the optimiser broadcasts them while they are small.
    """
    every = pointers(spark, root)
    last = every.orderBy(F.col("seq").desc()).first()
    units = last["units"].split(",")
    mine = (every if where is None else every.where(where)).select("version", *units)
    mine = materialise(mine, "pointers")
    versions = sorted(r["version"] for r in mine.select("version").distinct().collect())
    rows = _read(spark, root, versions, last["schema"])
    rows = rows.where(where) if where is not None else rows
    same = rows["version"] == mine["version"]
    for c in units:
        same = same & rows[c].eqNullSafe(mine[c])
    return rows.join(mine, same, "left_semi").drop("version")


def read_published_field(spark: SparkSession, root: str, where: Column | None = None) -> DataFrame:
    """The same for a field: canonical level again, unit columns of the calendar dropped."""
    out = read_published(spark, root, where)
    level = F.when(F.col("level") != "none", F.col("level")).cast("int")
    return out.withColumn("level", level).drop("year", "month", "day")


def unit_days(units: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """(keys, time) with one row per unit and day that has rows: what the coverage operators ask of a field.

    Feed it to ``coverage_report``, ``covers_period``, ``covers_wanted`` or ``missing_days``; the field is not read.
    """
    return units.select(*keys, F.explode("days").alias("time"))


def merge_batch(
    spark: SparkSession,
    root: str,
    batch: DataFrame,
    keep: Callable[[DataFrame], DataFrame],
    units: Sequence[str],
    time: str,
    name: str,
) -> bool:
    """Merge a batch into a published table, rewriting the units that it touches and no others.

    ``keep`` reduces old and new rows to those that stay (``keep_latest`` and its kin) and must not mind
    meeting the same row twice.  A batch that failed before its publication is merged again as if
    it had never been tried; one that is published already (by ``name``) is skipped.  Returns
    whether it was merged.
    """
    known = _ledger(spark, root)
    if known is not None and known.where(F.col("batch") == name).take(1):
        return False
    rows = with_unit_columns(batch, units, time)
    if known is not None:
        touched = materialise(rows.select(*units).distinct(), "touched")
        named = touched.limit(LISTED_UNITS + 1).collect()
        listed = None
        if len(named) <= LISTED_UNITS:  # literals prune directories when the plan is made
            for c in units:
                values = [r[c] for r in named]
                some = F.col(c).isin([v for v in set(values) if v is not None])
                some = some | F.col(c).isNull() if None in values else some
                listed = some if listed is None else listed & some
        old = read_published(spark, root, listed)
        same = [old[c].eqNullSafe(touched[c]) for c in units]
        rows = rows.unionByName(old.join(touched, same, "left_semi"))
    kept = keep(rows.drop(*[c for c in units if c not in batch.columns]))
    publish(stage(kept, root, units, time, ()), batch=name)
    return True


def remove_superseded(spark: SparkSession, root: str) -> list[str]:
    """Delete versions that no pointer names, staged leftovers among them; returns their names.

    Only while nothing is being staged and no reader still uses an older state.
    """
    live = {r["version"] for r in pointers(spark, root).select("version").distinct().collect()}
    files = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/data")
    found = files.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(files)
    names = [f.getPath().getName().removeprefix("version=") for f in found if f.getPath().getName().startswith("version=")]
    gone = sorted(set(names) - live)
    for v in gone:
        remove_dir(spark, f"{root}/data/version={v}")
    return gone
