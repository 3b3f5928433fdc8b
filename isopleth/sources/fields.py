"""Reading and writing field tables."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isopleth.operators import cleaning
from isopleth.schema import FIELD_SCHEMA, series_of

MONTHLY = ("source", "var", "level", "year", "month")
DAILY = (*MONTHLY, "day")


def _standardise(
    df: DataFrame,
    wrap: bool = True,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    out = _prune_months(cleaning.canonical_names(df), start, end)
    out = restore_series(out)
    out = cleaning.time_slice(out, start, end)  # on the raw column, so the scan can skip row groups
    return cleaning.wrap_longitudes(out) if wrap and "lon" in out.columns else out


def _prune_months(df: DataFrame, start: dt.date | None, end: dt.date | None) -> DataFrame:
    """Where a field is stored by month, let the period pick the directories."""
    if not {"year", "month"} <= set(df.columns):
        return df
    month = F.col("year") * 100 + F.col("month")
    if start is not None:
        df = df.where(month >= start.year * 100 + start.month)
    return df.where(month <= end.year * 100 + end.month) if end is not None else df


def restore_series(df: DataFrame) -> DataFrame:
    """Canonical types of the series columns, whatever was made of their directory names; level ``none`` is NULL."""
    level = F.col("level").cast("string")
    kinds = {
        "source": F.col("source").cast("string"),
        "var": F.col("var").cast("string"),
        "level": F.when(level != "none", level).cast("int"),
    }
    return df.withColumns({c: kinds[c] for c in series_of(df)})


def read_field(
    spark: SparkSession, path: str | Sequence[str], wrap: bool = True, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """One field: canonical names, wrapped longitude, optional period.  A missing path is an error.

    Several paths of one schema, none of them with directories by unit, are one scan.

    A field that ``write_field`` stored comes back with the canonical schema: its unit columns
    pick the directories of the period and are then dropped.
    """
    out = _standardise(spark.read.parquet(*([path] if isinstance(path, str) else path)), wrap, start, end)
    stored = {*FIELD_SCHEMA.names, *MONTHLY} <= set(out.columns)
    return out.select(*FIELD_SCHEMA.names, *[c for c in out.columns if c not in {*FIELD_SCHEMA.names, *DAILY}]) if stored else out


def read_fields(
    spark: SparkSession,
    paths: Sequence[str],
    wrap: bool = True,
    start: dt.date | None = None,
    end: dt.date | None = None,
    concat: bool = False,
) -> list[DataFrame] | DataFrame:
    """Several fields with one period: a list, or one table (columns a field lacks are NULL).

    One table is made of one scan for all paths of a schema, so that its plan does not grow with the
    number of files.  A field stored in directories by unit is a scan of its own, as Spark reads such
    directories below one root only.  A path that is named twice counts twice.
    """
    if not concat:
        return [read_field(spark, p, wrap, start, end) for p in paths]
    alike: dict[tuple, list[str]] = {}
    times = Counter()
    for path in paths:
        times[path] += 1
        found = spark.read.parquet(path).schema
        by_unit = found != spark.read.option("recursiveFileLookup", "true").parquet(path).schema
        alike.setdefault((found.json(), times[path], path if by_unit else None), []).append(path)
    fields = [read_field(spark, group, wrap, start, end) for group in alike.values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), fields)


def read_glob(
    spark: SparkSession,
    pattern: str,
    wrap: bool = True,
    base: str | None = None,
    start: dt.date | None = None,
    end: dt.date | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """All files that match a pattern as one field, with the file each row came from.

    ``base`` is the root of a partitioned field; with it the unit columns are kept.  ``merge_schema``
    is for files whose columns differ; it reads the footer of every file.
    """
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    raw = (reader.option("basePath", base) if base else reader).parquet(pattern)
    return _standardise(raw.select("*", F.col("_metadata.file_path").alias("file_path")), wrap, start, end)


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",", comment: str = "#"
) -> DataFrame:
    """Text file of numbers; comment lines are skipped and a bad number is an error."""
    return spark.read.schema(schema).option("sep", sep).option("comment", comment).option("mode", "FAILFAST").csv(path)


def level_text(level: Column) -> Column:
    """Partition value of a level; ``none`` for single-level variables."""
    return F.coalesce(level.cast("string"), F.lit("none"))


def write_field(df: DataFrame, path: str, units: Sequence[str] = MONTHLY) -> None:
    """Write a field by work unit; each unit present in ``df`` replaces the stored one.

    The rebalance hint brings the rows of a unit together and splits a unit that is
    too large for one task, so neither tiny files nor one huge task result.
    """
    parts = {
        "level": level_text(F.col("level")),
        "year": F.year("time"),
        "month": F.month("time"),
    }
    if "day" in units:
        parts["day"] = F.dayofmonth("time")
    (
        df.withColumns(parts)
        .hint("rebalance", *[F.col(c) for c in units])
        .sortWithinPartitions(*units, "time", "lat", "lon")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*units)
        .parquet(path)
    )


def stored_schema(columns: Sequence[str]) -> T.StructType:
    """Schema of a stored field with the given columns; names of directories are taken as they are, not guessed at."""
    kinds = {f.name: f.dataType for f in FIELD_SCHEMA.fields} | {"level": T.StringType()}
    kinds |= {c: T.IntegerType() for c in ("year", "month", "day")}
    return T.StructType([T.StructField(c, kinds[c]) for c in columns])


def read_written(spark: SparkSession, path: str, keep_units: bool = False) -> DataFrame:
    """Read what ``write_field`` stored; predicates on the unit columns prune directories.

    A source or variable made of digits keeps its leading zeros.
    """
    columns = spark.read.parquet(path).columns
    known = {*FIELD_SCHEMA.names, "year", "month", "day"}
    plain = spark.read.schema(stored_schema(columns)).parquet(path) if set(columns) <= known else spark.read.parquet(path)
    out = restore_series(plain)
    extra = [c for c in ("year", "month", "day") if c in out.columns] if keep_units else []
    return out.select(*FIELD_SCHEMA.names, *extra)
