"""Lagged ensembles, multi-model means and skill against observations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isopleth.session import materialise



def lagged_ensemble_mean(
    df: DataFrame,
    cell: Sequence[str],
    member: Sequence[str],
    min_members: int = 8,
    valid: str = "valid",
    run: Sequence[str] = (),
) -> DataFrame:
    """Mean of runs and members that share a valid time.

    A run with fewer than ``min_members`` members is discarded; the others are averaged with
    each member counting once.  Without ``run`` columns all members are one run.  Each
    member is averaged first, so one with many rows neither outweighs the others nor
    reaches the final step unreduced, and a run leaves only its sum and its members' number.
    """
    one = df.where(F.col("value").isNotNull()).groupBy("model", valid, *cell, *run, *member).agg(F.avg("value").alias("value"))
    runs = one.groupBy("model", valid, *cell, *run).agg(F.sum("value").alias("total"), F.count(F.lit(1)).alias("n"))
    return (
        runs.where(F.col("n") >= min_members)
        .groupBy("model", valid, *cell)
        .agg(
            (F.sum("total") / F.sum("n")).alias("value"),
            F.sum("n").alias("n_members"),
            F.count(F.lit(1)).alias("n_runs"),
        )
    )


def multi_model_mean(df: DataFrame, cell: Sequence[str], min_models: int = 2, valid: str = "valid") -> DataFrame:
    """Mean over models where at least ``min_models`` have a value."""
    return (
        df.where(F.col("value").isNotNull())
        .groupBy(valid, *cell)
        .agg(F.avg("value").alias("value"), F.count_distinct("model").alias("n_models"))
        .where(F.col("n_models") >= min_models)
    )


def skill_score(
    forecast: DataFrame,
    observed: DataFrame,
    min_lead: int = 5,
    max_lead: int = 10,
) -> DataFrame:
    """1 - mean((f-o)^2) / mean(o^2) per (model, target), clipped to [-1, 1].

    ``forecast``: model, target, lead_days, value.  ``observed``: date, value, one row
    per date, which is stored first, being used twice.  The denominator is one constant
    of the observed archive, taken as a scalar subquery.
    """
    obs = materialise(
        observed.where(F.col("value").isNotNull()).select(F.col("date").alias("target"), F.col("value").alias("obs")), "observed"
    )
    base = obs.agg(F.avg(F.col("obs") * F.col("obs"))).scalar()
    err = (F.col("value") - F.col("obs")) * (F.col("value") - F.col("obs"))
    raw = F.lit(1.0) - F.col("mse") / base
    return (
        forecast.where(F.col("lead_days").between(min_lead, max_lead) & F.col("value").isNotNull())
        .join(obs, "target")
        .groupBy("model", "target")
        .agg(F.avg(err).alias("mse"), F.count(F.lit(1)).alias("n"))
        .select("model", "target", "n", F.least(F.lit(1.0), F.greatest(F.lit(-1.0), raw)).alias("skill"))
    )


