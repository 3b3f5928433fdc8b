"""Which requested units still have to run?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isopleth.operators.combine import keep_latest


def params_text(params: Column) -> Column:
    """Canonical text of a map<string,string>: entries sorted by key, JSON style."""

    def quoted(c: Column) -> Column:
        c = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
        return F.concat(F.lit('"'), c, F.lit('"'))

    entries = F.sort_array(F.map_entries(params))
    pairs = F.transform(entries, lambda e: F.concat(quoted(e["key"]), F.lit(": "), quoted(e["value"])))
    return F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}"))


def params_hash(params: Column) -> Column:
    return F.md5(params_text(params).cast("binary"))


def record_runs(done: DataFrame) -> DataFrame:
    """Ledger rows (name, params_hash, outputs, n_outputs, run_at) of finished units (name, params, outputs, run_at)."""
    return done.select(
        "name",
        params_hash(F.col("params")).alias("params_hash"),
        "outputs",
        F.size("outputs").alias("n_outputs"),
        "run_at",
    )


def current_ledger(ledger: DataFrame, invalidated: DataFrame | None = None) -> DataFrame:
    """One row per name, the latest; names listed in ``invalidated`` are gone."""
    latest = keep_latest(ledger, ["name"], [F.col("run_at"), F.col("params_hash")])
    return latest if invalidated is None else latest.join(invalidated.select("name"), "name", "left_anti")


def unit_status(requested: DataFrame, ledger: DataFrame, inventory: DataFrame) -> DataFrame:
    """Each requested unit (name, params, outputs) with ``pending``.

    Done means: the ledger's latest row of that name has the same parameter hash and
    every requested output is in ``inventory`` (column path).  The units pass through
    once: the ledger is matched first, and only units that ran with these parameters
    have their outputs looked up.
    """
    keys = ["name", "params_hash"]
    units = requested.select("name", params_hash(F.col("params")).alias("params_hash"), "outputs")
    runs = current_ledger(ledger.select(*keys, "run_at")).select(*keys, F.lit(True).alias("ran"))
    have = inventory.select("path").distinct().withColumn("found", F.lit(True))
    looked_up = (
        units.join(runs, keys, "left")
        .select(*keys, "ran", F.explode_outer(F.when(F.col("ran"), F.col("outputs"))).alias("output"))
        # units without a path to look up are spread by name, not gathered under one NULL key
        .withColumn("path", F.coalesce("output", F.concat(F.lit("\x00"), F.col("name"))))
        .join(have, "path", "left")
    )
    absent = F.col("output").isNotNull() & F.col("found").isNull()
    return looked_up.groupBy(*keys).agg(F.bool_or(F.col("ran").isNull() | absent).alias("pending"))


def pending_units(requested: DataFrame, ledger: DataFrame, inventory: DataFrame) -> DataFrame:
    """Requested units that still have to run."""
    return unit_status(requested, ledger, inventory).where("pending").drop("pending")
