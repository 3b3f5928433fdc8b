import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from isopleth.operators import aggregate, cleaning, neighbours, patterns, quality, tiles
from isopleth.schema import Grid, with_cell_index
from isopleth.session import materialise, new_dir
from isopleth.sources import tables

GRID = Grid(-20.0, 10.0, 5, 0.0, 30.0, 12)


def random_field(spark, grid, seed=1, steps=2, name="value"):
    rng = np.random.default_rng(seed)
    data = [
        (t, grid.lat0 + grid.dlat * j, grid.lon0 + grid.dlon * i, float(rng.normal()))
        for t in range(steps)
        for j in range(grid.nlat)
        for i in range(grid.nlon)
    ]
    return spark.createDataFrame(pd.DataFrame(data, columns=["time", "lat", "lon", name]))


def cube(df, grid, name="value"):
    pdf = df.toPandas()
    out = np.full((int(pdf.time.max()) + 1, grid.nlat, grid.nlon), np.nan)
    for r in pdf.itertuples():
        i = int(round((r.lon - grid.lon0) / grid.dlon)) % grid.nlon
        out[r.time, int(round((r.lat - grid.lat0) / grid.dlat)), i] = getattr(r, name)
    return out


def test_cell_index_wraps(spark):
    df = spark.createDataFrame([(-20.0, 0.0), (20.0, 330.0), (0.0, -30.0), (0.0, 360.0)], "lat double, lon double")
    assert [(r["i"], r["j"]) for r in with_cell_index(df, GRID).collect()] == [(0, 0), (11, 4), (11, 2), (0, 2)]


def test_regrid_onto_itself_is_identity(spark):
    df = random_field(spark, GRID)
    lats = [GRID.lat0 + GRID.dlat * j for j in range(GRID.nlat)]
    lons = [GRID.lon0 + GRID.dlon * i for i in range(GRID.nlon)]
    back = neighbours.regrid_bilinear(df, GRID, lats, lons)
    assert np.allclose(cube(back, GRID), cube(df, GRID))


def test_regrid_matches_numpy_and_closes_the_circle(spark):
    df = random_field(spark, GRID)
    c = cube(df, GRID)
    closed = np.concatenate([c, c[:, :, :1]], axis=2)
    lats, lons = [-25.0, -17.0, 3.0, 20.0, 21.0], [0.0, 44.0, 331.0, 359.0, -1.0]
    got = {(r["time"], r["lat"], r["lon"]): r["value"] for r in neighbours.regrid_bilinear(df, GRID, lats, lons).collect()}
    assert {k[1] for k in got} == {-17.0, 3.0, 20.0}
    for (t, y, x), v in got.items():
        row = [np.interp(x % 360, np.arange(13) * 30.0, closed[t, j]) for j in range(5)]
        assert v == pytest.approx(np.interp(y, np.arange(5) * 10.0 - 20, row))


def test_regrid_with_a_missing_corner_gives_nothing(spark):
    df = random_field(spark, GRID, steps=1).withColumn("value", F.when((F.col("lat") != 0) | (F.col("lon") != 30), F.col("value")))
    got = {(r["lat"], r["lon"]) for r in neighbours.regrid_bilinear(df, GRID, [-5.0, 5.0, 15.0], [15.0, 45.0, 75.0]).collect()}
    assert got == {(-5.0, 75.0), (5.0, 75.0), (15.0, 15.0), (15.0, 45.0), (15.0, 75.0)}


def test_coarse_target_matches_numpy(spark):
    grid = Grid(-60.0, 2.0, 61, 0.0, 10.0, 36)
    df = random_field(spark, grid, steps=2)
    c = cube(df, grid)
    lats, lons = [-59.5, 3.0, 60.0], [5.0, 355.0]
    out = neighbours.regrid_bilinear(df, grid, lats, lons)
    assert "REPARTITION" not in out._jdf.queryExecution().executedPlan().toString()
    closed = np.concatenate([c, c[:, :, :1]], axis=2)
    got = out.collect()
    assert len(got) == 12
    for r in got:
        row = [np.interp(r["lon"], np.arange(37) * 10.0, closed[r["time"], j]) for j in range(61)]
        assert r["value"] == pytest.approx(np.interp(r["lat"], np.arange(61) * 2.0 - 60, row))


def test_small_sides_leave_the_field_in_place(spark):
    path = new_dir(spark, "field")
    random_field(spark, GRID).write.parquet(path)
    stored = spark.read.parquet(path)
    frames = [
        aggregate.remove_global_mean(stored, ["time"]),
        quality.repair_units_by_slice(stored, 50.0),
        neighbours.despike(stored, GRID, ("time",), 1.0, 1.5),
    ]
    for df in frames:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_points_agree_with_the_grid_version(spark, rows):
    df = random_field(spark, GRID)
    lats, lons = [-20.0, -17.0, 3.0, 20.0, 21.0], [0.0, 44.0, 331.0, 359.0, -1.0, 360.0]
    points = spark.createDataFrame([(k, y, x) for k, (y, x) in enumerate((y, x) for y in lats for x in lons)], "p int, lat double, lon double")
    by_point = rows(neighbours.interpolate_at_points(df, GRID, points, "p"), "time", "lat", "lon", "value")
    by_grid = rows(neighbours.regrid_bilinear(df, GRID, lats, lons), "time", "lat", "lon", "value")
    assert len(by_point) == 2 * 4 * 6 and [r[:3] for r in by_point] == [r[:3] for r in by_grid]
    assert [r[3] for r in by_point] == pytest.approx([r[3] for r in by_grid])


def test_regional_grid_does_not_wrap(spark, rows):
    grid = Grid(0.0, 1.0, 2, 10.0, 1.0, 3)
    df = random_field(spark, grid, steps=1)
    lons = [9.5, 10.0, 11.5, 12.0, 12.5]
    got = {r["lon"] for r in neighbours.regrid_bilinear(df, grid, [0.5], lons).collect()}
    points = spark.createDataFrame([(k, 0.5, x) for k, x in enumerate(lons)], "p int, lat double, lon double")
    assert got == {r["lon"] for r in neighbours.interpolate_at_points(df, grid, points, "p").collect()} == {10.0, 11.5, 12.0}


def test_spike_is_replaced_and_rain_is_not(spark):
    grid = Grid(0.0, 1.0, 9, 0.0, 1.0, 9)
    values = {(j, i): 0.0 for j in range(9) for i in range(9)}
    values[(4, 4)] = 675.0
    for j in range(3):
        for i in range(3):
            values[(j, i)] = 200.0
    values[(8, 8)] = 149.0
    df = spark.createDataFrame([(1, float(j), float(i), v) for (j, i), v in values.items()], "date int, lat double, lon double, value double")
    out = {(r["lat"], r["lon"]): (r["value"], r["corrected"]) for r in neighbours.despike(df, grid).collect()}
    assert len(out) == 81
    assert out[(4.0, 4.0)] == (0.0, True)
    assert out[(0.0, 0.0)] == (200.0, False) and out[(8.0, 8.0)] == (149.0, False)
    assert [k for k, v in out.items() if v[1]] == [k for k in out if k == (4.0, 4.0) or (values[(int(k[0]), int(k[1]))] == 200 and v_median(values, k) * 4 < 200)]


def v_median(values, k):
    j, i = int(k[0]), int(k[1])
    return float(np.median([values[(b, a)] for b in range(j - 2, j + 3) for a in range(i - 2, i + 3) if (b, a) in values]))


def test_divergence_and_vorticity_match_numpy(spark):
    u, v = random_field(spark, GRID, 3, name="u"), random_field(spark, GRID, 4, name="v")
    df = u.join(v, ["time", "lat", "lon"])
    cu, cv = cube(u, GRID, "u"), cube(v, GRID, "v")
    lat = np.radians(np.arange(5) * 10.0 - 20)
    c = np.cos(lat)[None, :, None]
    r, dlon, dlat = 6.371e6, math.radians(30), math.radians(10)
    ddx = lambda f: (np.roll(f, -1, 2) - np.roll(f, 1, 2)) / (2 * dlon)
    ddy = lambda f: (f[:, 2:] - f[:, :-2]) / (2 * dlat)
    div = (ddx(cu)[:, 1:-1] + ddy(cv * c)) / (r * c[:, 1:-1])
    vort = (ddx(cv)[:, 1:-1] - ddy(cu * c)) / (r * c[:, 1:-1])
    out = neighbours.divergence_vorticity(df, GRID)
    assert np.allclose(cube(out, GRID, "divergence").astype(float)[:, 1:-1], div, atol=1e-15)
    assert np.allclose(cube(out, GRID, "vorticity").astype(float)[:, 1:-1], vort, atol=1e-15)
    assert out.where("abs(lat) = 20 and divergence is not null").count() == 0


def test_solid_rotation_has_no_divergence(spark):
    grid = Grid(-60.0, 2.0, 61, 0.0, 10.0, 36)
    df = random_field(spark, grid, steps=1).select("time", "lat", "lon", (10 * F.cos(F.radians("lat"))).alias("u"), F.lit(0.0).alias("v"))
    out = neighbours.divergence_vorticity(df, grid).where("divergence is not null")
    worst = out.select(F.max(F.abs("divergence")), F.max(F.abs(F.col("vorticity") - 20 * F.sin(F.radians("lat")) / 6.371e6))).first()
    assert worst[0] == 0.0 and worst[1] < 1e-8


def test_boxes_ignore_missing_cells_and_cross_the_date_line(spark):
    df = spark.createDataFrame(
        [(1, 0.0, -170.0, 1.0), (1, 5.0, -150.0, 3.0), (1, 5.0, -120.0, None), (1, 0.0, 170.0, 9.0), (1, 6.0, -150.0, 99.0)],
        "date int, lat double, lon double, value double",
    )
    out = {r["box"]: r["value"] for r in aggregate.box_means(df, tables.INDEX_BOXES).collect()}
    w = math.cos(math.radians(5))
    assert out["nino34"] == pytest.approx((1 + 3 * w) / (1 + w))
    assert out["nino4"] == pytest.approx((1 + 3 * w + 9) / (2 + w))
    assert set(out) == {"nino3", "nino34", "nino4"}


def test_global_mean_vanishes(spark):
    out = aggregate.remove_global_mean(random_field(spark, GRID), ["time"])
    w = F.cos(F.radians("lat"))
    for r in out.groupBy("time").agg(F.sum(w * F.col("value")).alias("s")).collect():
        assert r["s"] == pytest.approx(0.0, abs=1e-9)


def test_coarsen(spark):
    grid = Grid(0.0, 1.0, 3, 0.0, 1.0, 4)
    df = random_field(spark, grid, steps=1)
    c = cube(df, grid)[0]
    got = {(r["bj"], r["bi"]): r["value"] for r in aggregate.coarsen(df, grid, 2, ["time"]).collect()}
    assert got[(0, 0)] == pytest.approx(c[:2, :2].mean()) and got[(1, 1)] == pytest.approx(c[2:, 2:].mean())


def test_period_mean_skips_missing(spark):
    df = cleaning.null_missing(spark.createDataFrame([(0.0, 0.0, 1.0), (0.0, 0.0, float("nan"))], "lat double, lon double, value double"))
    r = aggregate.hovmoller(df.withColumn("date", F.lit(1)), -5, 5).first()
    assert r["value"] == 1.0


@pytest.mark.parametrize("parts", [1, 7, 150])
def test_gram_matrix_adds_partitions(spark, parts):
    x = np.random.default_rng(5).normal(size=(200, 6))
    df = spark.createDataFrame([(row.tolist(),) for row in x], "v array<double>").repartition(parts)
    got = {(r["a"], r["b"]): r["value"] for r in patterns.gram_matrix(df, "v", 6).collect()}
    want = x.T @ x
    assert len(got) == 21
    assert all(got[(a, b)] == pytest.approx(want[a, b]) for a, b in got)


def test_leading_pattern_matches_a_full_decomposition(spark):
    rng = np.random.default_rng(11)
    months = pd.period_range("1991-01", periods=36, freq="M")
    cells = [(-20.0 - 10 * j, 30.0 * i) for j in range(4) for i in range(5)]
    shape = rng.normal(size=len(cells))
    base = rng.normal(size=36)[:, None] * shape[None, :] * 3 + rng.normal(size=(36, len(cells)))
    rows = [(lat, lon, m.to_timestamp().date(), float(base[t, c])) for t, m in enumerate(months) for c, (lat, lon) in enumerate(cells)]
    df = spark.createDataFrame(rows, "lat double, lon double, date date, value double")
    anomalies = patterns.monthly_anomalies(df, ["lat", "lon"])
    table, stds, explained, *_ = patterns.leading_patterns(anomalies, ["lat", "lon"], 2)
    grouped = base.reshape(3, 12, -1)
    x = (grouped - grouped.mean(axis=0)).reshape(36, -1) * np.sqrt(np.cos(np.radians([c[0] for c in cells])))
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    assert explained == pytest.approx(list(s[:2] ** 2 / (s**2).sum()))
    for mode in (1, 2):
        want = vt[mode - 1] * np.sign(vt[mode - 1][np.abs(vt[mode - 1]).argmax()])
        got = {(r["lat"], r["lon"]): r["loading"] for r in table.where(F.col("mode") == mode).collect()}
        assert [got[c] for c in cells] == pytest.approx(list(want), abs=1e-8)
        assert stds[mode - 1] == pytest.approx(np.std(x @ want))
    raw = anomalies.withColumn("value", F.col("value") / F.sqrt(F.cos(F.radians("lat")))).withColumnRenamed("month", "date")
    index = patterns.project(raw, table, ["lat", "lon"], stds).where("mode = 1").select(F.stddev_pop("index")).first()[0]
    assert index == pytest.approx(1.0)


def test_mean_of_indices_is_index_of_the_mean(spark):
    table = spark.createDataFrame([(0.0, 0.0, 1, 0.6), (0.0, 1.0, 1, 0.8)], "lat double, lon double, mode int, loading double")
    members = spark.createDataFrame([(m, 1, 0.0, float(x), 3.0 * m + x) for m in (1, 2) for x in (0, 1)], "m int, date int, lat double, lon double, value double")
    per = [patterns.project(members.where(F.col("m") == m), table, ["lat", "lon"], [2.0]).first()["index"] for m in (1, 2)]
    mean = members.groupBy("date", "lat", "lon").agg(F.avg("value").alias("value"))
    assert patterns.project(mean, table, ["lat", "lon"], [2.0]).first()["index"] == pytest.approx(sum(per) / 2)


def test_octants(spark):
    angles = [-170, -100, -80, -10, 10, 80, 100, 170]
    rows = [(k, "v", 1, math.cos(math.radians(a)), math.sin(math.radians(a))) for k, a in enumerate(angles)]
    df = spark.createDataFrame([(r[0], "a", r[3]) for r in rows] + [(r[0], "b", r[4]) for r in rows], "date int, var string, value double")
    pattern = spark.createDataFrame([("a", 1.0, 0.0), ("b", 0.0, 1.0)], "var string, e1 double, e2 double")
    out = patterns.oscillation_index(df, pattern, ["var"]).orderBy("date").collect()
    assert [r["phase"] for r in out] == [1, 2, 3, 4, 5, 6, 7, 8]
    assert all(r["amplitude"] == pytest.approx(1.0) for r in out)


def test_normalised_variables_have_unit_deviation(spark):
    df = spark.createDataFrame([("a", float(v)) for v in range(5)] + [("b", 100.0 * v) for v in range(5)], "var string, value double")
    for r in patterns.normalise_by_variable(df).groupBy("var").agg(F.stddev_pop("value").alias("s")).collect():
        assert r["s"] == pytest.approx(1.0)


def test_combined_patterns_match_numpy(spark):
    rng = np.random.default_rng(2)
    keys = [(v, x) for v in ("a", "b") for x in (0.0, 90.0, 180.0)]
    x = np.outer(rng.normal(size=50) * 4, rng.normal(size=6)) + rng.normal(size=(50, 6))
    rows = [(v, lon, t, float(x[t, k])) for t in range(50) for k, (v, lon) in enumerate(keys)] + [("a", 0.0, 99, 1e6)]
    df = spark.createDataFrame(rows, "var string, lon double, date int, value double")
    table, explained, left_out = patterns.combined_patterns(df)
    assert [tuple(r) for r in left_out.collect()] == [(99, 1, 6)]
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    assert explained == pytest.approx(list(s[:2] ** 2 / (s**2).sum()))
    got = {(r["var"], r["lon"]): (r["e1"], r["e2"]) for r in table.collect()}
    for m in range(2):
        want = vt[m] * np.sign(vt[m][np.abs(vt[m]).argmax()])
        assert [got[k][m] for k in keys] == pytest.approx(list(want), abs=1e-8)


def test_tiles_find_the_same_spikes(spark, rows):
    for grid, side in ((GRID, 3), (GRID, 64), (Grid(0.0, 1.0, 7, 0.0, 1.0, 9), 4), (Grid(0.0, 1.0, 4, 0.0, 90.0, 4), 2)):
        df = random_field(spark, grid).withColumn("value", F.when(F.rand(3) > 0.1, F.abs("value")))
        df = materialise(df, "field")
        for threshold, ratio in ((0.0, 1.1), (1.0, 1.5)):
            want = neighbours.despike(df, grid, ("time",), threshold, ratio)
            got = tiles.despike_by_tiles(df, grid, ("time",), threshold, ratio, side=side)
            keys = ("time", "lat", "lon", "corrected")
            assert rows(got, *keys) == rows(want, *keys)
            assert got.agg(F.sum("value")).first()[0] == pytest.approx(want.agg(F.sum("value")).first()[0])
            assert got.where("corrected").count() > 0
