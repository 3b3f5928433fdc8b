"""From requests to the work that is left: check, split, name, compare with the ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isopleth.operators import ledger
from isopleth.operators import requests as req
from isopleth.operators.cleaning import resolve_variables
from isopleth.sources.fields import level_text


def unit_path(source: str, var: Column, level: Column, year: Column, month: Column) -> Column:
    """Directory of a month unit, as the field sink lays it out."""
    parts = {"source": F.lit(source), "var": var, "level": level_text(level), "year": year, "month": month}
    return F.concat_ws("/", *[F.concat(F.lit(f"{k}="), v.cast("string")) for k, v in parts.items()])


def month_work(requests: DataFrame, source: str = "primary") -> DataFrame:
    """Month units (name, params, outputs) of the valid requests; a unit several requests share occurs once.

    The last day asked for in a month is a parameter, so a unit fetched for half a month
    is not taken for the whole month; of several requests the longest decides.
    """
    valid = req.validate_requests(requests).where(F.col("reason").isNull())
    months = req.month_units(resolve_variables(valid, on_unknown="reject"))
    units = months.groupBy("var", "level", "year", "month").agg(F.max("last_day").alias("last_day"))
    path = unit_path(source, F.col("var"), F.col("level"), F.col("year"), F.col("month"))
    return units.select(
        path.alias("name"),
        F.create_map(F.lit("last_day"), F.date_format("last_day", "yyyy-MM-dd")).alias("params"),
        F.array(path).alias("outputs"),
    )


def work_left(requests: DataFrame, runs: DataFrame, inventory: DataFrame, source: str = "primary") -> DataFrame:
    """Units of the requests that the ledger and the inventory do not call done."""
    return ledger.pending_units(month_work(requests, source), runs, inventory)


def append_runs(done: DataFrame, path: str) -> None:
    """Append finished units (name, params, outputs, run_at) to the ledger table; the latest row of a name counts."""
    ledger.record_runs(done).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
