"""Series stay apart, nothing is capped or dropped in silence, and edges of grids and days are right."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isopleth.operators import aggregate, cleaning, combine, events, items, neighbours, patterns, timeseries
from isopleth.plans import observed
from isopleth.schema import Grid

D, TS = dt.date, dt.datetime
GRID = Grid(-20.0, 10.0, 5, 0.0, 90.0, 4)


def field(spark, days=3):
    rows = [
        ("s", v, p, TS(2024, 1, d, h), lat, lon, x)
        for v, p, x in (("z", None, 1.0), ("z", 500, 2.0), ("t", 850, 3.0))
        for d in range(1, days + 1)
        for h in (0, 12)
        for lat in GRID.lats
        for lon in GRID.lons
    ]
    return spark.createDataFrame(rows, "source string, var string, level int, time timestamp_ntz, lat double, lon double, value double")


def test_means_keep_series_apart(spark):
    df = field(spark)
    for out in (aggregate.daily_mean(df), observed.mean_field(df, D(2024, 1, 1), D(2024, 1, 3), None)):
        got = {(r["var"], r["level"]): (r["lo"], r["hi"]) for r in out.groupBy("var", "level").agg(F.min("value").alias("lo"), F.max("value").alias("hi")).collect()}
        assert got == {("z", None): (1.0, 1.0), ("z", 500): (2.0, 2.0), ("t", 850): (3.0, 3.0)}


def test_daily_anomaly_by_series(spark):
    df = field(spark)
    clim = aggregate.daily_mean(df).select("var", "level", "lat", "lon", (F.month("date") * 100 + F.dayofmonth("date")).alias("day_key"), (F.col("value") / 2).alias("clim"))
    from isopleth.functions import scalars

    clim = aggregate.daily_mean(df).select("var", "level", "lat", "lon", scalars.calendar_key(F.col("date")).alias("day_key"), (F.col("value") / 2).alias("clim"))
    out = observed.daily_anomaly(df, clim, GRID, GRID, D(2024, 1, 1), D(2024, 1, 3))
    got = {(r["var"], r["level"], r["anomaly"]) for r in out.collect()}
    assert got == {("z", None, 0.5), ("z", 500, 1.0), ("t", 850, 1.5)}


def test_squeeze_keeps_variables(spark):
    rows = [("u", 0, 850, 1.0), ("u", 1, 500, 2.0), ("v", 1, 500, 3.0)]
    df = spark.createDataFrame([(v, TS(2024, 1, 1), 0.0, 0.0, n, p, x) for v, n, p, x in rows], "var string, time timestamp_ntz, lat double, lon double, n int, level int, value double")
    assert {(r["var"], r["value"]) for r in cleaning.squeeze_level(df, "n").collect()} == {("u", 1.0), ("v", 3.0)}


def test_coarse_centres_do_not_move(spark):
    rows = [(D(2024, 1, 1), lat, lon, 1.0) for lat in (-20.0, -10.0) for lon in (90.0, 180.0)] + [(D(2024, 1, 2), -20.0, 180.0, 1.0)]
    grid = Grid(-20.0, 10.0, 5, 90.0, 90.0, 4)
    got = {(r["date"], r["lat"], r["lon"]) for r in aggregate.coarsen(spark.createDataFrame(rows, "date date, lat double, lon double, value double"), grid, 2).collect()}
    assert got == {(D(2024, 1, 1), -15.0, 135.0), (D(2024, 1, 2), -15.0, 135.0)}
    over = spark.createDataFrame([(D(2024, 1, 1), 0.0, x, 1.0) for x in (120.0, 150.0, 180.0, -150.0)], "date date, lat double, lon double, value double")
    r = aggregate.coarsen(over, Grid(0.0, 10.0, 1, 0.0, 30.0, 12), 4).collect()
    assert [(x["lat"], x["lon"]) for x in r] == [(0.0, 165.0)]


def test_gap_across_the_date_line(spark):
    circle = spark.createDataFrame([(1, x, x) for x in (-180.0, -90.0, 0.0)], "row int, lon double, value double")
    got = {r["lon"]: r["value"] for r in timeseries.fill_gaps_in_longitude(circle, ["row"], 90.0, cyclic=True).collect()}
    assert got == {-180.0: -180.0, -90.0: -90.0, 0.0: 0.0, 90.0: -90.0}


def test_long_axis(spark):
    df = spark.createDataFrame([(1, lat, lon, lon) for lat in (0.0, 10.0) for lon in (0.0, 90.0, 180.0, 270.0)], "time int, lat double, lon double, value double")
    lons = [k * 0.004 for k in range(22_000)]
    assert neighbours.regrid_bilinear(df, Grid(0.0, 10.0, 2, 0.0, 90.0, 4), [5.0], lons).count() == len(lons)


def test_wrong_length_raises(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0],)], "v array<double>")
    with pytest.raises(Exception, match="not 2 elements"):
        patterns.gram_matrix(df, "v", 2).collect()


def test_iteration_matches_numpy_on_long_vectors(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(30, 3)) @ (rng.normal(size=(3, 4500)) * np.array([[9.0], [5.0], [2.0]])) + 0.01 * rng.normal(size=(30, 4500))
    df = spark.createDataFrame([(list(map(float, r)),) for r in x], "x array<double>").repartition(3)
    values, vectors, trace = patterns.leading_by_iteration(df, "x", 4500, 2)
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    assert values == pytest.approx(s[:2] ** 2) and trace == pytest.approx((s**2).sum())
    assert np.abs(np.sum(vectors.T * vt[:2], axis=1)) == pytest.approx([1.0, 1.0], abs=1e-9)


def test_either_way_gives_the_same_combined_patterns(spark):
    rng = np.random.default_rng(2)
    x = np.outer(rng.normal(size=40) * 4, rng.normal(size=6)) + rng.normal(size=(40, 6))
    rows = [("ab"[k % 2], float(k), t, float(x[t, k])) for t in range(40) for k in range(6)]
    df = spark.createDataFrame(rows, "var string, lon double, date int, value double")
    one, two = (patterns.combined_patterns(df, square_limit=n)[0].orderBy("var", "lon").collect() for n in (10, 3))
    assert [r["e1"] for r in one] == pytest.approx([r["e1"] for r in two], abs=1e-6)


def test_iteration_on_a_slowly_decaying_spectrum(spark):
    rng = np.random.default_rng(6)
    left, right = (np.linalg.qr(rng.normal(size=(60, 40)))[0] for _ in range(2))
    x = left @ np.diag(10 * 0.97 ** np.arange(40)) @ right.T
    df = spark.createDataFrame([(list(map(float, r)),) for r in x], "x array<double>").coalesce(1)
    values, vectors, trace = patterns.leading_by_iteration(df, "x", 60, 2)
    want, square, whole = patterns.leading_vectors(patterns.gram_matrix(df, "x", 60), 60, 2)
    assert values == pytest.approx(want) and trace == pytest.approx(whole)
    assert np.abs(np.sum(vectors * square, axis=0)) == pytest.approx([1.0, 1.0], abs=1e-9)
    with pytest.raises(RuntimeError, match="not settled"):
        patterns.leading_by_iteration(df, "x", 60, 2, rounds=4)


def test_months_and_cells_left_out_are_returned(spark):
    rng = np.random.default_rng(3)
    rows = [(float(c), D(2024, m, 1), float(rng.normal())) for c in range(4) for m in range(1, 7)] + [(0.0, D(2025, 1, 1), 9.0)]
    rows = [r for r in rows if r[:2] != (3.0, D(2024, 2, 1))]
    df = spark.createDataFrame(rows, "lat double, month date, value double")
    for how in ({"base": (D(2024, 1, 1), D(2024, 6, 30))}, {"majority": True}):
        found = patterns.leading_patterns(df, ["lat"], **how)
        assert {r["lat"] for r in found.table.collect()} == {0.0, 1.0, 2.0}
        assert [tuple(r) for r in found.cells_left_out.collect()] == [(3.0, 5, 6)]
        assert [tuple(r) for r in found.months_left_out.collect()] == [(D(2025, 1, 1), 1)]
    # every month that occurs is wanted unless something else is said
    every = patterns.leading_patterns(df.where("lat < 1 or month < date'2025-01-01'"), ["lat"])
    assert {r["lat"] for r in every.table.collect()} == {0.0} and every.cells_left_out.count() == 3
    with pytest.raises(ValueError, match="no complete vector"):
        patterns.leading_patterns(df, ["lat"], base=(D(2023, 1, 1), D(2023, 3, 31)))


def test_incomplete_days_have_no_index(spark):
    pattern = spark.createDataFrame([("a", 1.0, 0.0), ("b", 0.0, 1.0)], "var string, e1 double, e2 double")
    df = spark.createDataFrame([(1, "a", 1.0), (1, "b", 1.0), (2, "a", 1.0)], "date int, var string, value double")
    got = {r["date"]: (r["n_elements"], r["pc1"], r["phase"]) for r in patterns.oscillation_index(df, pattern, ["var"]).collect()}
    assert got[1][:2] == (2, 1.0) and got[2] == (1, None, None)


def test_events_keep_their_instant(spark):
    at = [TS(2024, 1, 1, 6, 30), TS(2024, 1, 2, 6, 29), TS(2024, 1, 2, 6, 30)]
    df = spark.createDataFrame([("p", t) for t in at], "place string, time timestamp_ntz")
    assert sorted(r["time"] for r in events.thin_by_refractory(df, ["place"], 24).collect()) == [at[0], at[2]]


def test_a_result_of_the_wrong_type_is_one_failure(spark):
    df = spark.createDataFrame([(k,) for k in range(4)], "k int").coalesce(1)
    out = items.map_items(df, lambda r: {"x": "no number" if r["k"] == 2 else r["k"]}, "k", T.StructType([T.StructField("x", T.LongType())]))
    assert [(r["k"], r["ok"], r["x"]) for r in out.orderBy("k").collect()] == [(0, True, 0), (1, True, 1), (2, False, None), (3, True, 3)]


def test_stated_last_days(spark):
    def src(name, days):
        rows = [(name, v, TS(2024, 1, d)) for v in ("a", "b", "c") for d in days]
        return spark.createDataFrame(rows, "source string, var string, time timestamp_ntz")

    last = spark.createDataFrame([("a", None), ("b", D(2024, 1, 3))], "var string, last_day date")
    out = combine.splice_sources(src("p", range(1, 9)), src("s", range(1, 9)), D(2024, 1, 1), D(2024, 1, 8), D(2024, 1, 13), ["var"], last_days=last)
    got = {v: "".join(r["source"] for r in out.where(F.col("var") == v).orderBy("time").collect()) for v in "abc"}
    assert got == {"a": "pppppsss", "b": "pppsssss", "c": "ssssssss"}
