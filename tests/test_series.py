import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from isopleth.operators import climatology, ensemble, events, precipitation, quality, timeseries
from isopleth.plans import observed
from isopleth.plans.catalog import QUERIES

D, T = dt.date, dt.datetime


def series(spark, values, start=D(2024, 1, 1), cell="a"):
    data = [(cell, start + dt.timedelta(days=k), None if v is None else float(v)) for k, v in enumerate(values)]
    return spark.createDataFrame(data, "cell string, date date, value double")


def values(df, value="value"):
    return {r["date"]: r[value] for r in df.collect()}


def test_moving_mean_needs_all_days(spark):
    got = values(timeseries.moving_mean(series(spark, [1, 2, 3, 4, 5, None, 7]), ["cell"], 5))
    assert got == {D(2024, 1, 1): 3.0}
    gap = series(spark, range(8)).where("date <> '2024-01-03'")
    assert values(timeseries.moving_mean(gap, ["cell"], 5)) == {D(2024, 1, 4): 5.0}


def test_blocks(spark):
    df = series(spark, range(12))
    five = values(timeseries.block_means(df, ["cell"], D(2024, 1, 1), [5]).withColumnRenamed("block_start", "date"))
    assert five == {D(2024, 1, 2): 3.0, D(2024, 1, 7): 8.0}
    four_days = df.where("date <> '2024-01-03'")
    assert len(values(timeseries.block_means(four_days, ["cell"], D(2024, 1, 1), [5]).withColumnRenamed("block_start", "date"))) == 2
    assert timeseries.block_means(four_days, ["cell"], D(2024, 1, 1), [3]).count() == 2


def test_preceding_mean_leaves_the_day_out(spark):
    got = values(timeseries.remove_preceding_mean(series(spark, [1, 2, 3, 10]), ["cell"], 3))
    assert got == {D(2024, 1, 4): 8.0}


def test_lanczos_matches_numpy_with_repeated_edges(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=90).cumsum()
    w = np.array(timeseries.lanczos_weights(20, 5, 15))
    padded = np.pad(x, 20, mode="edge")
    want = [float(np.dot(w, padded[k : k + 41])) for k in range(90)]
    got = values(timeseries.lanczos_band_pass(series(spark, x), ["cell"], 20, 5, 15))
    assert [got[D(2024, 1, 1) + dt.timedelta(days=k)] for k in range(90)] == pytest.approx(want, abs=1e-9)


def test_lanczos_over_blocks_gaps_and_odd_values(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=1000).cumsum()
    x[700] = np.nan
    days = [k for k in range(1000) if k != 300]
    w = np.array(timeseries.lanczos_weights(20, 5, 15))
    padded = np.pad(x, 20, mode="edge")
    rows = [("a", None, D(1969, 6, 1) + dt.timedelta(days=k), float(x[k])) for k in days]
    rows += [("a", 500, D(1969, 6, 1) + dt.timedelta(days=k), 2.0 * k) for k in range(5)] + [("b", 500, D(2024, 1, 1), None)]
    rows += [("c", 500, D(2024, 1, k), 1.0) for k in (1, 1, 2)]  # a day that stands twice
    df = spark.createDataFrame(rows, "var string, level int, date date, value double").repartition(5)
    out = timeseries.lanczos_band_pass(df, ["var", "level"], 20, 5, 15)
    assert [f.dataType.simpleString() for f in out.schema] == ["string", "int", "date", "double"]
    assert out.where("level = 500").select("var").distinct().collect() == [("a",)] and out.where("level = 500").count() == 5
    got = {(r["date"] - D(1969, 6, 1)).days: r["value"] for r in out.where("level is null").collect()}
    assert sorted(got) == [k for k in range(1000) if abs(k - 300) > 20]
    want = [float(np.dot(w, padded[k : k + 41])) for k in sorted(got)]
    assert [got[k] for k in sorted(got)] == pytest.approx(want, abs=1e-9, nan_ok=True)
    assert sum(math.isnan(v) for v in got.values()) == 41


def test_lanczos_short_series(spark):
    w = np.array(timeseries.lanczos_weights(20, 5, 15))
    for x in ([3.0], [1.0, 5.0, 2.0]):
        padded = np.pad(np.array(x), 20, mode="edge")
        want = [float(np.dot(w, padded[k : k + 41])) for k in range(len(x))]
        got = values(timeseries.lanczos_band_pass(series(spark, x), ["cell"], 20, 5, 15))
        assert [got[k] for k in sorted(got)] == pytest.approx(want, abs=1e-9)


def test_lanczos_keeps_the_band(spark):
    t = np.arange(600)
    slow, inside = np.sin(2 * np.pi * t / 300), np.sin(2 * np.pi * t / 40)
    got = values(timeseries.lanczos_band_pass(series(spark, slow + inside), ["cell"]))
    middle = np.array([got[D(2024, 1, 1) + dt.timedelta(days=int(k))] for k in range(200, 400)])
    assert np.abs(middle - inside[200:400]).max() < 0.2


def test_fill_gaps(spark):
    got = timeseries.fill_gaps_in_time(series(spark, [None, 1, None, None, 4, None]), ["cell"])
    assert values(got) == {D(2024, 1, k): float(v) for k, v in ((2, 1), (3, 2), (4, 3), (5, 4))}
    assert {r["date"].day for r in got.where("filled").collect()} == {3, 4}
    circle = spark.createDataFrame([(1, 0.0, 1.0), (1, 30.0, None), (1, 90.0, 4.0)], "row int, lon double, value double")
    out = {r["lon"]: r["value"] for r in timeseries.fill_gaps_in_longitude(circle, ["row"], 30.0).collect()}
    assert out == {0.0: 1.0, 30.0: 2.0, 60.0: 3.0, 90.0: 4.0}


def test_leap_day_shares_the_28th(spark):
    df = spark.createDataFrame(
        [("a", D(2023, 2, 28), 1.0), ("a", D(2024, 2, 28), 3.0), ("a", D(2024, 2, 29), 5.0)], "cell string, date date, value double"
    )
    clim = climatology.daily_climatology(df, D(2023, 1, 1), D(2024, 12, 31), ["cell"])
    assert [tuple(r) for r in clim.collect()] == [("a", 228, 3.0, 3)]
    out = climatology.anomaly(df, clim, ["cell"])
    assert values(out, "anomaly")[D(2024, 2, 29)] == 2.0


def test_anomaly_keeps_unmatched_rows(spark):
    df = series(spark, [1.0, 2.0])
    clim = spark.createDataFrame([("a", 101, 0.5)], "cell string, day_key int, clim double")
    assert values(climatology.anomaly(df, clim, ["cell"]), "anomaly") == {D(2024, 1, 1): 0.5, D(2024, 1, 2): None}


def test_period_climatology_is_the_mean_of_the_days(spark):
    clim = spark.createDataFrame([("a", m * 100 + d, float(m * d)) for m in range(1, 13) for d in range(1, 32)], "cell string, day_key int, clim double")
    start, end = D(2023, 12, 15), D(2025, 3, 3)
    days = [start + dt.timedelta(days=k) for k in range((end - start).days + 1)]
    want = np.mean([d.month * (28 if (d.month, d.day) == (2, 29) else d.day) for d in days])
    out = climatology.period_climatology(clim, start, end, ["cell"]).first()
    assert out["clim"] == pytest.approx(want) and out["n_days"] == len(days)


def test_total_of_a_period_is_not_a_mean(spark):
    df = series(spark, [10.0] * 10)
    total = precipitation.running_total(df, ["cell"], "date")
    assert precipitation.period_total(total, ["cell"], "date").first()["total"] == 100.0
    back = precipitation.de_accumulate(total.select("cell", "date", "total"), ["cell"], "date")
    assert [r["increment"] for r in back.collect()] == [10.0] * 10


def test_bucket_sum_needs_all_four(spark):
    df = spark.createDataFrame(
        [(T(2024, 1, 1, h), 1.0) for h in (0, 6, 12, 18)] + [(T(2024, 1, 2, h), 1.0) for h in (0, 6, 12)] + [(T(2024, 1, 2, 18), None)],
        "time timestamp_ntz, value double",
    )
    assert [tuple(r) for r in precipitation.daily_sum_of_buckets(df, []).collect()] == [(D(2024, 1, 1), 4.0)]
    twice = spark.createDataFrame([(T(2024, 1, 1, h), 1.0) for h in (0, 0, 6, 12)], "time timestamp_ntz, value double")
    assert precipitation.daily_sum_of_buckets(twice, []).count() == 0
    ends = spark.createDataFrame([(T(2024, 1, 1, h), 1.0) for h in (0, 6, 12, 18)] + [(T(2024, 1, 2, 0), 5.0)], "time timestamp_ntz, value double")
    assert [tuple(r) for r in precipitation.daily_sum_of_buckets(ends, [], label_lag_hours=6).collect()] == [(D(2024, 1, 1), 8.0)]


def test_precipitation_types(spark):
    df = spark.createDataFrame([(1, s, c, 2.0) for s, c in enumerate([1, 3, 8, 7, 5, 6, 12, 1])], "run int, step int, code int, increment double")
    out = precipitation.split_by_type(df, ["run"], "step").orderBy("step").collect()
    assert [r["kind"] for r in out] == ["rain", "ice", "ice", "mixed", "snow", "snow", None, "rain"]
    last = out[-1]
    assert (last["rain_total"], last["ice_total"], last["mixed_total"], last["snow_total"], last["snow_cm_total"]) == (4, 4, 2, 4, 4)
    flags = spark.createDataFrame([(0, 0), (1, 0), (0, 1), (1, 1), (None, 1)], "a int, b int")
    kinds = [r["kind"] for r in precipitation.type_from_flags(flags, [("a", "rain"), ("b", "snow")]).collect()]
    assert kinds == ["dry", "rain", "snow", "mixed", "snow"]


def test_ensembles(spark, rows):
    data = [("A", 1, m, float(m)) for m in range(8)] + [("A", 1, 0, 0.0), ("B", 1, 0, 9.0), ("A", 2, 0, 1.0)]
    df = spark.createDataFrame(data, "model string, valid int, member int, value double")
    assert rows(ensemble.lagged_ensemble_mean(df, [], ["member"], 8)) == [("A", 1, 3.5, 8, 1)]
    runs = [("A", 1, run, m, float(m)) for run, n in ((0, 3), (1, 3), (2, 9)) for m in range(n)]
    several = spark.createDataFrame(runs, "model string, valid int, run int, member int, value double")
    assert rows(ensemble.lagged_ensemble_mean(several, [], ["member"], 8, run=["run"])) == [("A", 1, 4.0, 9, 1)]
    means = spark.createDataFrame([("A", 1, 2.0), ("B", 1, 4.0), ("A", 2, 9.0)], "model string, valid int, value double")
    assert rows(ensemble.multi_model_mean(means, [])) == [(1, 3.0, 2)]


def test_skill(spark):
    days = [D(2024, 1, d) for d in (1, 2, 3)]
    obs = spark.createDataFrame([(d, v) for d, v in zip(days, (1.0, -1.0, 2.0))], "date date, value double")
    fc = spark.createDataFrame(
        [("A", days[0], 5, 1.0), ("A", days[0], 10, 2.0), ("A", days[0], 4, 50.0), ("A", days[2], 7, 90.0), ("B", days[1], 3, 0.0)],
        "model string, target date, lead_days int, value double",
    )
    got = {(r["model"], r["target"].day): r["skill"] for r in ensemble.skill_score(fc, obs).collect()}
    assert got == {("A", 1): pytest.approx(1 - 0.5 / 2.0), ("A", 3): -1.0}


def test_degenerate_days(spark):
    data = [("v", d, float(v)) for d in range(1, 6) for v in ([-1, 1, -2, 2] if d < 5 else [1, 1, 1, 1])]
    df = spark.createDataFrame(data, "var string, date int, value double")
    assert {r["date"] for r in quality.degenerate_days(df).where("degenerate").collect()} == {5}
    assert quality.drop_degenerate_days(df).count() == 16
    partial = spark.createDataFrame(
        [("v", d, float(v)) for d in range(1, 6) for v in ([-1] * 5 + [1] * 5 if d < 5 else [-1] + [1] * 9)], "var string, date int, value double"
    )
    assert {r["date"] for r in quality.degenerate_days(partial).where("degenerate").collect()} == {5}
    with pytest.raises(Exception, match="every day"):
        quality.drop_degenerate_days(df.where("date = 5")).collect()


def test_series_without_sound_day(spark, tmp_path):
    data = [(n, d, float(v)) for n in ("a", "b") for d in (1, 2) for v in ([-1, 1] if n == "a" else [1, 1])]
    df = spark.createDataFrame(data, "var string, date int, value double")
    assert [tuple(r) for r in quality.drop_degenerate_days(df, require_sound=False).groupBy("var").count().collect()] == [("a", 4)]

    # the north is above 480 in every cell, the south is not
    cells = [(h, u, kind) for h in (0, 6, 12, 18) for u in range(12) for kind in ("error", "view")]
    events = [(h, u, kind, 90.0 if kind == "view" or u % 2 else 1.0) for h, u, kind in cells]
    made = spark.createDataFrame(events, "h int, user_id long, event_type string, value double")
    made.selectExpr("timestamp_ntz'2024-01-01' + make_dt_interval(0, h) as ts", "user_id", "event_type", "value").write.parquet(f"{tmp_path}/events.parquet")
    got = QUERIES["drop_degenerate_days"](spark, str(tmp_path))
    assert [tuple(r) for r in got.groupBy("var").count().collect()] == [("south", 12)]


def test_units_are_judged_per_slice(spark, rows):
    df = spark.createDataFrame([(d, v * (9.80665 if d < 4 else 1.0)) for d in range(1, 5) for v in (10000.0, 10400.0)], "time int, value double")
    out = quality.repair_units_by_slice(df, 50000.0)
    assert {round(r["value"]) for r in out.collect()} == {10000, 10400}
    assert out.where("was_geopotential").count() == 6


def test_masks(spark):
    df = spark.createDataFrame([(0.0, -1.0, 30.0, 0.0), (0.0, 1.0, 3.0, 0.0), (50.0, -1.0, 20.0, 15.0), (80.0, -1.0, 1.0, 1.0)], "lat double, c double, u double, v double")
    kept = [r["u"] for r in quality.keep_where_negative(df, "c", ["u", "v"]).collect()]
    assert kept == [30.0, None, None, None]
    assert [r["speed"] for r in quality.mask_weak_wind(df).collect()] == [30.0, None, 25.0, None]
    assert [r["u"] for r in quality.mask_latitudes(df, "u").collect()] == [None, None, 20.0, None]


def test_refractory_fold(spark):
    base = T(2024, 1, 1)
    df = spark.createDataFrame([("p", base + dt.timedelta(hours=h)) for h in (0, 10, 20, 30, 55, 60, 90)], "place string, time timestamp_ntz")
    got = sorted(int((r["time"] - base).total_seconds() // 3600) for r in events.thin_by_refractory(df, ["place"], 24).collect())
    assert got == [0, 30, 55, 90]


def test_refractory_fold_matches_a_loop(spark):
    rng = np.random.default_rng(3)
    base = T(2024, 1, 1)
    data, want = [], set()
    for place in range(5):
        hours = sorted({int(h) for h in rng.integers(0, 1500, 120)})
        last = None
        for h in hours:
            data.append((place, base + dt.timedelta(hours=h)))
            if last is None or h - last >= 24:
                want.add((place, h))
                last = h
    df = spark.createDataFrame(data, "place int, time timestamp_ntz")
    got = {(r["place"], int((r["time"] - base).total_seconds() // 3600)) for r in events.thin_by_refractory(df, ["place"], 24).collect()}
    assert got == want


def test_front_needs_turn_and_fall(spark):
    def steps(temp2, v, skip=()):
        times = [T(2024, 1, d, h) for d in (1, 2) for h in (0, 6, 12, 18)]
        return [("p", t, vv, 20.0 if t.day == 1 else temp2) for k, (t, vv) in enumerate(zip(times, v)) if k not in skip]

    turn = [-5, -5, -5, -5, -5, 5, 5, 5]
    schema = "place string, time timestamp_ntz, v double, temp double"
    run = lambda data: events.front_passages(spark.createDataFrame([(a, b, float(c), d) for a, b, c, d in data], schema), ["place"], 3.0, 2.0).collect()
    assert [r["time"] for r in run(steps(10.0, turn))] == [T(2024, 1, 2, 6)]
    assert run(steps(19.0, turn)) == []
    assert run(steps(10.0, [-1] * 5 + [1] * 3)) == []
    assert run(steps(10.0, turn, skip=(4,))) == []
    assert events.passages_per_place(events.front_passages(spark.createDataFrame([(a, b, float(c), d) for a, b, c, d in steps(10.0, turn)], schema), ["place"], 3.0, 2.0), ["place"]).first()["n_events"] == 1


def test_null_is_not_a_value(spark):
    df = series(spark, [1.0, None, 3.0])
    assert df.select(F.avg("value")).first()[0] == 2.0


def test_oscillation_departures(spark):
    rng = np.random.default_rng(4)
    days = [D(2023, 1, 1) + dt.timedelta(days=k) for k in range(400)]
    x = rng.normal(size=(2, 2, 400))
    data = [(v, 90.0 * i, d, lat, float(x[k, i, t] + off)) for k, v in enumerate("ab") for i in range(2) for t, d in enumerate(days) for lat, off in ((-10.0, -1.0), (10.0, 1.0), (40.0, 99.0))]
    df = spark.createDataFrame(data, "var string, lon double, date date, lat double, value double")
    out = observed.oscillation_departures(df, D(2023, 1, 1), D(2024, 12, 31), days=30)
    key = [d.month * 100 + d.day for d in days]
    clim = {}
    for t, k in enumerate(key):
        clim.setdefault(k, []).append(t)
    anom = np.stack([x[:, :, t] - x[:, :, clim[key[t]]].mean(axis=2) for t in range(400)], axis=2)
    dep = np.stack([anom[:, :, t] - anom[:, :, t - 30 : t].mean(axis=2) for t in range(30, 400)], axis=2)
    dep /= dep.std(axis=(1, 2), keepdims=True)
    got = {(r["var"], r["lon"], r["date"]): r["value"] for r in out.collect()}
    assert len(got) == dep.size
    for (v, lon, d), value in got.items():
        assert value == pytest.approx(dep["ab".index(v), int(lon // 90), days.index(d) - 30], abs=1e-9)
