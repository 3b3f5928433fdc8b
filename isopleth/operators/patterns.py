"""Leading patterns (EOFs) of a field and the indices projected on them.

Only the bounded side of the data matrix ever becomes a square matrix: vectors of
a fixed, checked length are multiplied inside the tasks, one partial matrix leaves
each task, and Spark adds the partial matrices.  The unbounded side (cells of a
field, samples of a table) stays distributed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isopleth.functions import scalars
from isopleth.schema import key_join
from isopleth.session import materialise
from isopleth.sources.tables import literal_table

#: Vectors up to this length go by their square matrix, longer ones by subspace iteration.
SQUARE_LIMIT = 4096
#: Further directions that the iteration carries along, its rounds, and the turn at which it has settled.
EXTRA, ROUNDS, SETTLED = 8, 300, 1e-9
#: Partial sums of a matrix row that meet in the last of the two levels.
FAN_IN = 64


def gram_matrix(df: DataFrame, vector: str, dim: int) -> DataFrame:
    """X'X of the rows' vectors as (a, b, value) with 0 <= a <= b < dim.

    NULL vectors are missing and left out; a vector of another length raises.  Each task
    hands on one row for each row of the matrix, and these are added in levels: those of some tasks
    first, so that at most ``FAN_IN`` rows of a matrix row meet in the last step, however many tasks there are.
    """

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf[vector].to_numpy()).astype("float64")
                part = x.T @ x
                total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"a": np.arange(dim, dtype="int32"), "upper": [total[a, a:] for a in range(dim)]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        """Sum of the parts of a matrix row."""
        return pd.DataFrame({"a": [pdf["a"].iloc[0]], "upper": [pdf["upper"].sum()]})

    parts = vectors_of_length(df, vector, dim).mapInPandas(partial, "a int, upper array<double>")
    some = parts.groupBy("a", (F.spark_partition_id() % FAN_IN).alias("part")).applyInPandas(add, "a int, upper array<double>")
    whole = some.groupBy("a").applyInPandas(add, "a int, upper array<double>")
    return whole.select("a", F.posexplode("upper").alias("k", "value")).select("a", (F.col("a") + F.col("k")).alias("b"), "value")


def vectors_of_length(df: DataFrame, vector: str, dim: int) -> DataFrame:
    """The column ``vector`` without NULLs; a vector of another length raises when it is read."""
    own = F.col(vector).cast("array<double>")
    said = F.concat(F.lit(f"a vector has not {dim} elements but "), F.size(vector).cast("string"))
    return df.where(F.col(vector).isNotNull()).select(
        F.when(F.size(vector) == dim, own).otherwise(F.raise_error(said)).alias(vector)
    )


def leading_by_iteration(
    df: DataFrame, vector: str, dim: int, count: int, extra: int = EXTRA, rounds: int = ROUNDS
) -> tuple[np.ndarray, np.ndarray, float]:
    """What ``leading_vectors`` gives, for vectors of any length, by distributed subspace iteration.

    Only dim x (count + extra) numbers pass between tasks and driver in a round.  Raises
    RuntimeError if the vectors still turn after ``rounds`` rounds.
    """
    width = min(count + extra, dim)
    stored = vectors_of_length(df, vector, dim)

    def multiply(basis: np.ndarray) -> np.ndarray:
        def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros_like(basis)
            for pdf in batches:
                if len(pdf):
                    x = np.stack(pdf[vector].to_numpy()).astype("float64")
                    total += x.T @ (x @ basis)
            yield pd.DataFrame({"a": np.arange(dim), **{f"c{k}": total[:, k] for k in range(width)}})

        sums = [F.sum(f"c{k}").alias(f"c{k}") for k in range(width)]
        kind = ", ".join(["a long", *(f"c{k} double" for k in range(width))])
        got = stored.mapInPandas(part, kind).groupBy("a").agg(*sums).toPandas()
        out = np.zeros_like(basis)
        out[got["a"].to_numpy()] = got.drop(columns="a").to_numpy()
        return out

    square = F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x * x)
    trace = stored.agg(F.sum(square)).first()[0]
    if not trace:
        raise ValueError("no complete vector to take patterns from")
    basis, _ = np.linalg.qr(np.random.default_rng(1).normal(size=(dim, width)))
    leading = basis[:, :count]
    for _ in range(rounds):
        image = multiply(basis)
        small = basis.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(values)[::-1]
        now = (basis @ turn[:, order])[:, :count]
        turned = np.linalg.norm(now - leading @ (leading.T @ now))
        leading = now
        if turned < SETTLED:
            return values[order][:count], leading, float(trace)
        basis, _ = np.linalg.qr(image)
    raise RuntimeError(f"the leading vectors have not settled: they turned by {turned:.1e} in the last of {rounds} rounds")


def leading_vectors(gram: DataFrame, dim: int, count: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Largest eigenvalues, their vectors and the trace; the one driver-side step, on dim x dim numbers."""
    square = np.zeros((dim, dim))
    table = gram.toPandas()
    a, b = table["a"].to_numpy(), table["b"].to_numpy()
    square[a, b] = square[b, a] = table["value"].to_numpy()
    if not square.any():
        raise ValueError("no complete vector to take patterns from")
    values, vectors = np.linalg.eigh(square)
    order = np.argsort(values)[::-1][:count]
    return values[order], vectors[:, order], float(np.trace(square))


def _dot(vector: Column, weights: Sequence[float]) -> Column:
    products = F.zip_with(vector, F.lit([float(w) for w in weights]), lambda x, w: x * w)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def monthly_anomalies(df: DataFrame, cell: Sequence[str], date: str = "date") -> DataFrame:
    """Monthly means minus the mean of the same calendar month, weighted by sqrt(cos(lat))."""
    monthly = df.groupBy(*cell, F.trunc(date, "MM").alias("month")).agg(F.avg("value").alias("value"))
    # at most one row per month of the record in each (cell, calendar month)
    w = Window.partitionBy(*cell, F.month("month"))
    return monthly.withColumn(
        "value", (F.col("value") - F.avg("value").over(w)) * F.sqrt(scalars.cos_weight(F.col("lat")))
    )


def _steps_by_cell(anomalies: DataFrame, cell: Sequence[str]) -> DataFrame:
    by_month = F.array_sort(F.collect_list(F.struct("month", "value")))
    return anomalies.where(F.col("value").isNotNull()).groupBy(*cell).agg(by_month.alias("steps"))


def _months(stored: DataFrame, base: tuple[dt.date, dt.date] | None, majority: bool) -> list[dt.date]:
    """Months of the analysis, in order: those of the base period, else all that some cell has."""
    if base is not None:
        first, last = (d.year * 12 + d.month - 1 for d in base)
        return [dt.date(k // 12, k % 12 + 1, 1) for k in range(first, last + 1)]
    cells = stored.count() if majority else 0
    months = stored.select(F.explode("steps.month").alias("month")).groupBy("month").count().collect()
    return sorted(r["month"] for r in months if 2 * r["count"] >= cells)


def _of_months(stored: DataFrame, months: list) -> DataFrame:
    wanted = F.array(*[F.lit(m) for m in months]) if months else F.array().cast("array<date>")
    return stored.withColumn("steps", F.filter("steps", lambda s: F.array_contains(wanted, s["month"])))


class Patterns(NamedTuple):
    """Loadings (cell, mode, loading), deviations of the monthly indices, explained fractions, and what was left out:
    cells (cell, n_months, wanted) that lack a month, months (month, n_cells) of the data that are not analysed."""

    table: DataFrame
    stds: list[float]
    explained: list[float]
    cells_left_out: DataFrame
    months_left_out: DataFrame


def leading_patterns(
    anomalies: DataFrame,
    cell: Sequence[str],
    count: int = 1,
    base: tuple[dt.date, dt.date] | None = None,
    majority: bool = False,
) -> Patterns:
    """EOFs of monthly anomalies (cell, month, value).

    The months are those of ``base`` (first and last day), else all that occur; with ``majority``
    those that at least half of the cells have, so that a stray month costs no cell.  Cells without all
    of them cannot be projected.  Cells and months that are left out are returned beside the result;
    if no cell is left, that is an error.  A cell's months fit one row; the vectors are stored
    once for the jobs that follow.  The largest loading of each mode is positive.
    """
    stored = materialise(_steps_by_cell(anomalies, cell), "patterns")
    months = _months(stored, base, majority)
    own = _of_months(stored, months).select(*cell, F.size("steps").alias("n_months"), F.lit(len(months)).alias("wanted"))
    cells_left_out = own.where(F.col("n_months") < F.col("wanted"))
    by_month = stored.select(F.explode("steps.month").alias("month")).groupBy("month").agg(F.count(F.lit(1)).alias("n_cells"))
    months_left_out = by_month.where(~F.col("month").isin(months)) if months else by_month
    dim = len(months)
    vectors = _of_months(stored, months).where(F.size("steps") == dim).select(*cell, F.col("steps.value").alias("x"))
    gram = gram_matrix(vectors, "x", dim)
    values, u, trace = leading_vectors(gram, dim, count)
    loadings = [_dot(F.col("x"), u[:, k] / np.sqrt(values[k])) for k in range(count)]
    modes = F.array(*[F.struct(F.lit(k + 1).alias("mode"), loadings[k].alias("loading")) for k in range(count)])
    table = vectors.select(*cell, F.explode(modes).alias("m")).select(*cell, "m.mode", "m.loading")
    signs = {
        r["mode"]: (1.0 if r["top"] >= 0 else -1.0)
        for r in table.groupBy("mode").agg(F.max_by("loading", F.abs("loading")).alias("top")).collect()
    }
    sign = F.lit([signs.get(k + 1, 1.0) for k in range(count)])[F.col("mode") - 1]
    table = materialise(table.withColumn("loading", F.col("loading") * sign), "loadings")
    stds = [float(np.std(np.sqrt(values[k]) * u[:, k])) for k in range(count)]
    return Patterns(table, stds, [float(v / trace) for v in values], cells_left_out, months_left_out)


def project(
    anomalies: DataFrame, patterns: DataFrame, cell: Sequence[str], stds: Sequence[float], date: str = "date"
) -> DataFrame:
    """Daily index: sqrt(cos)-weighted anomalies times the loadings, over the monthly index' deviation.

    ``n_elements`` counts the cells of the day; with fewer than the pattern has, the index is NULL.
    """
    weighted = F.col("value") * F.sqrt(scalars.cos_weight(F.col("lat"))) * F.col("loading")
    std = F.lit([float(s) for s in stds])[F.col("mode") - 1]
    whole = patterns.where(F.col("mode") == 1).agg(F.count(F.lit(1))).scalar()
    return (
        key_join(anomalies, patterns, list(cell), "inner")
        .groupBy(date, "mode")
        .agg(F.sum(weighted).alias("raw"), F.count(weighted).alias("n_elements"))
        .select(date, "mode", "n_elements", F.when(F.col("n_elements") >= whole, F.col("raw") / std).alias("index"))
    )


def normalise_by_variable(df: DataFrame, var: str = "var") -> DataFrame:
    """Divide each variable by its own standard deviation."""
    stds = materialise(df.groupBy(var).agg(F.stddev_pop("value").alias("std")), "deviations")
    return key_join(df, stds, [var], "left").withColumn("value", F.col("value") / F.nullif("std", F.lit(0.0))).drop("std")


class Combined(NamedTuple):
    """Patterns of stacked variables (keys, e1, e2, ...), explained fractions, and the days left out (date, n_elements, wanted)."""

    table: DataFrame
    explained: list[float]
    days_left_out: DataFrame


def combined_patterns(
    df: DataFrame,
    keys: Sequence[str] = ("var", "lon"),
    date: str = "date",
    count: int = 2,
    square_limit: int = SQUARE_LIMIT,
) -> Combined:
    """Leading patterns of several stacked, normalised variables (keys, date, value).

    One row per day holds the stacked vector; its length (variables x longitudes) is the
    bounded side.  Days that lack an element are left out and returned beside the result.
    The largest loading is positive.  ``square_limit``
    chooses between two ways to the same vectors: up to it the square matrix, beyond it iteration.
    """
    stacked = F.array_sort(F.collect_list(F.struct(*keys, "value")))
    days = materialise(
        df.where(F.col("value").isNotNull()).groupBy(date).agg(stacked.alias("x")), "combined"
    )
    names = days.select(F.explode("x").alias("e")).select(*[F.col(f"e.{k}").alias(k) for k in keys]).distinct()
    ordered = names.orderBy(*keys).collect()  # one row for each element of the vector
    dim = len(ordered)
    vectors = days.where(F.size("x") == dim).select(F.col("x.value").alias("x"))
    left_out = days.where(F.size("x") < dim).select(date, F.size("x").alias("n_elements"), F.lit(dim).alias("wanted"))
    if dim <= square_limit:
        values, e, trace = leading_vectors(gram_matrix(vectors, "x", dim), dim, count)
    else:
        values, e, trace = leading_by_iteration(vectors, "x", dim, count)
    e = e * np.sign(e[np.abs(e).argmax(axis=0), np.arange(count)])
    rows = [(*key, *(float(v) for v in e[k])) for k, key in enumerate(ordered)]
    types = [f"{k} {df.schema[k].dataType.simpleString()}" for k in keys] + [f"e{m + 1} double" for m in range(count)]
    return Combined(literal_table(df.sparkSession, rows, ",".join(types)), [float(v / trace) for v in values], left_out)


def oscillation_index(df: DataFrame, patterns: DataFrame, keys: Sequence[str] = ("var", "lon"), date: str = "date") -> DataFrame:
    """Two-component index of the stacked, normalised variables.

    ``patterns``: keys, e1, e2.  Gives pc1, pc2, amplitude and the octant phase 1-8
    counted counter-clockwise from the negative pc1 axis.  ``n_elements`` counts the elements of the
    day; if one is missing, all else is NULL.
    """
    whole = patterns.agg(F.count(F.lit(1))).scalar()
    scores = key_join(df, patterns, list(keys), "inner").groupBy(date).agg(
        F.count("value").alias("n_elements"), *[F.sum(F.col("value") * F.col(f"e{k}")).alias(f"pc{k}") for k in (1, 2)]
    )
    complete = F.col("n_elements") >= whole
    scores = scores.withColumns({f"pc{k}": F.when(complete, F.col(f"pc{k}")) for k in (1, 2)})
    angle = F.pmod(F.atan2("pc2", "pc1") + F.lit(np.pi), F.lit(2 * np.pi))
    phase = F.pmod(F.floor(angle / (np.pi / 4)).cast("int"), F.lit(8)) + 1
    return scores.select(
        date, "n_elements", "pc1", "pc2", F.sqrt(F.col("pc1") * F.col("pc1") + F.col("pc2") * F.col("pc2")).alias("amplitude"), phase.alias("phase")
    )
