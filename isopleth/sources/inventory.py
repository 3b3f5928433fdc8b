"""File inventory: what exists, how large and how old it is."""

from __future__ import annotations

import datetime as dt

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isopleth.sources import tables
from isopleth.sources.fields import MONTHLY


def plain_path(path: Column) -> Column:
    """One spelling of a path: local paths without ``file:``, no slash at the end."""
    return F.regexp_replace(F.regexp_replace(path, "^file:/+", "/"), "(?<=.)/+$", "")


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """path, modified (UTC), n_bytes of the files below ``root``; the contents are never read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
    )
    utc = F.timestamp_micros(F.unix_micros("modificationTime"))
    return files.select("path", utc.alias("modified"), F.col("length").alias("n_bytes"))


def directory_names(path: Column) -> Column:
    """Names behind the escapes of a file listing: the URI's, then those that a partitioned sink writes.

    Both write a character as % and two hexadecimal digits; a plus sign stands for itself.
    """
    for _ in range(2):
        path = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    return path


def list_units(spark: SparkSession, root: str, units: Sequence[str] = MONTHLY, pattern: str = "*.parquet") -> DataFrame:
    """One row per stored unit below ``root``: path, n_files, n_bytes, oldest, modified (the newest).

    ``path`` is the unit's directory relative to the root of the field, which is the name that
    planned work gives its outputs.  Files that lie in no such directory are left out.
    """
    directory = "/".join(f"{u}=[^/]*" for u in units)
    files = list_files(spark, root, pattern).withColumn("path", F.regexp_extract("path", f"({directory})/(?:[^/]+/)*[^/]+$", 1))
    files = files.withColumn("path", directory_names(F.col("path")))
    return (
        files.where(F.col("path") != "")
        .groupBy("path")
        .agg(
            F.count(F.lit(1)).alias("n_files"),
            F.sum("n_bytes").alias("n_bytes"),
            F.min("modified").alias("oldest"),
            F.max("modified").alias("modified"),
        )
    )


def check_files(
    wanted: DataFrame,
    inventory: DataFrame,
    now: dt.datetime,
    min_bytes: int = tables.MIN_FILE_BYTES,
    max_age_hours: float | None = None,
    force: bool = False,
) -> DataFrame:
    """Each wanted path: does it exist, is it large enough, is it too old, must it be fetched?

    An age of exactly ``max_age_hours`` is still fresh.  ``now`` is zone-aware.  Paths match
    however they are spelt; the result has the wanted spelling.
    """
    have = inventory.select(plain_path(F.col("path")).alias("__plain"), "modified", "n_bytes")
    joined = wanted.select("path", plain_path(F.col("path")).alias("__plain")).join(have, "__plain", "left")
    exists = F.col("n_bytes").isNotNull()
    ok = F.coalesce(F.col("n_bytes") >= min_bytes, F.lit(False))
    age = (F.lit(now.timestamp()) - F.unix_micros("modified") / 1e6) / 3600.0
    stale = F.coalesce(age > max_age_hours, F.lit(False)) if max_age_hours is not None else F.lit(False)
    return joined.select(
        "path",
        exists.alias("exists"),
        F.coalesce("n_bytes", F.lit(0)).cast("long").alias("n_bytes"),
        ok.alias("ok"),
        stale.alias("stale"),
        (F.lit(force) | ~exists | ~ok | stale).alias("fetch"),
    )
