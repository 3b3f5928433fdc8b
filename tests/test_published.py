"""Published units, archives merged by batch, groups with captured errors, linear filters, plain sessions."""

import datetime as dt
import os
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isopleth.operators import combine, coverage, events, items, neighbours, timeseries
from isopleth.schema import FIELD_SCHEMA, Grid
from isopleth.session import new_dir, path_exists, scratch
from isopleth.sources import fields, published

D = dt.date
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def field(spark, days, value=1.0, source="007", var="a b/c=d%é"):
    rows = [(source, var, level, dt.datetime(2024, m, d, 6), 0.0, 30.0, value) for level in (None, 500) for m, d in days]
    return spark.createDataFrame(rows, FIELD_SCHEMA)


def values(df):
    return sorted((r["time"].month, r["time"].day, -1 if r["level"] is None else r["level"], r["value"]) for r in df.collect())


def test_readers_see_the_old_unit_until_the_new_one_is_published(spark):
    root = new_dir(spark, "published")
    with pytest.raises(FileNotFoundError):
        published.pointers(spark, root)
    published.publish(published.stage(field(spark, [(1, 1), (1, 2), (2, 1)]), root))
    before = values(published.read_published_field(spark, root))
    assert len(before) == 6
    staged = published.stage(field(spark, [(2, 1), (2, 2)], 5.0), root)
    with pytest.raises(ValueError, match="falls short"):
        published.publish(staged, published.require_units(1, days_expected=3))
    assert values(published.read_published_field(spark, root)) == before
    published.publish(staged)
    after = published.read_published_field(spark, root)
    assert values(after) == [x for x in before if x[0] == 1] + [(2, d, p, 5.0) for d in (1, 2) for p in (-1, 500)]
    assert {(r["source"], r["var"]) for r in after.collect()} == {("007", "a b/c=d%é")}
    assert after.where("month = 2").count() == 0 if "month" in after.columns else True
    only = published.read_published_field(spark, root, F.col("month") == 2)
    assert values(only) == [(2, d, p, 5.0) for d in (1, 2) for p in (-1, 500)]
    published.stage(field(spark, [(3, 1)]), root)  # written and forgotten
    gone = published.remove_superseded(spark, root)
    assert len(gone) == 1 and values(published.read_published_field(spark, root)) == values(after)
    published.publish(published.stage(field(spark, []), root))  # nothing at all
    assert published.read_published_field(spark, root).count() == 8


def test_coverage_comes_from_the_ledger(spark):
    root = new_dir(spark, "published")
    rows = field(spark, [(1, 1), (1, 3), (2, 1)])
    published.publish(published.stage(rows, root))
    units = published.pointers(spark, root).withColumn("level", F.when(F.col("level") != "none", F.col("level")).cast("int"))
    period = (D(2024, 1, 1), D(2024, 2, 1), ["source", "var", "level"])
    days = published.unit_days(units)
    for f in (coverage.coverage_report, coverage.missing_days):
        assert sorted(map(str, f(days, *period).collect())) == sorted(map(str, f(rows, *period).collect()))
    assert all("/ledger/" in p for p in coverage.coverage_report(days, *period).inputFiles())


def test_batches_equal_one_run_and_leave_other_units_alone(spark):
    root = new_dir(spark, "archive")
    kind = "model string, init date, target date, value double, loaded_at long"
    first = [("M", D(2024, 1, 1), D(2024, m, 5), float(m), m) for m in range(1, 5)]
    second = [("M", D(2024, 1, 1), D(2024, 2, 5), 9.0, 50), ("M", D(2024, 1, 1), D(2024, 3, 5), 8.0, 0), ("N", D(2024, 2, 1), D(2024, 2, 9), 7.0, 3)]
    a, b = (spark.createDataFrame(x, kind) for x in (first, second))
    run = lambda batch, name, keep=combine.latest_forecasts: published.merge_batch(spark, root, batch, keep, ["year", "month"], "target", name)
    files = lambda: {f for f in published.read_published(spark, root).inputFiles() if "month=1" in f or "month=4" in f}

    def fails(rows):
        raise RuntimeError("lost")

    assert run(a, "a")
    kept = files()
    with pytest.raises(RuntimeError, match="lost"):
        run(b, "b", fails)
    assert run(b, "b") and not run(b, "b")
    assert files() == kept and len(kept) == 2
    got = combine.upsert_forecasts(published.read_published(spark, root).drop("year", "month"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, combine.upsert_forecasts(a.union(b)).collect()))


def test_stored_names_keep_leading_zeros(spark):
    path = new_dir(spark, "sink")
    fields.write_field(field(spark, [(1, 1)], var="12"), path)
    assert {(r["source"], r["var"]) for r in fields.read_written(spark, path).collect()} == {("007", "12")}


def test_groups_fail_alone_and_stream(spark):
    rows = spark.range(50_000).select(F.when(F.col("id") % 5 < 4, F.col("id") % 5).alias("k"), F.col("id").alias("x"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")

    def work(key, batches):
        if key[0] == 1:
            raise KeyError("one")
        if key[0] == 2:
            return
        if key[0] == 3:
            yield {"n": 1}
            yield {"n": "no number"}
        n = parts = 0
        for batch in batches:
            assert isinstance(batch, pa.RecordBatch) and batch.num_rows <= 1000
            n, parts = n + batch.num_rows, parts + 1
        yield {"n": n, "parts": parts}

    try:
        result = T.StructType([T.StructField("n", T.LongType()), T.StructField("parts", T.LongType())])
        got = {r["k"]: r for r in items.map_groups(rows, work, ["k"], result).collect()}
        assert items.map_groups(rows.limit(0), work, ["k"], result).count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert (got[0]["n"], got[None]["n"], got[0]["ok"]) == (10_000, 10_000, True) and got[0]["parts"] >= 10
    assert got[1]["error_type"] == "KeyError" and not got[1]["ok"] and "one" in got[1]["traceback"]
    assert got[2]["ok"] and got[2]["n"] is None
    assert not got[3]["ok"] and got[3]["error_type"]


def test_refractory_pass_is_linear_in_a_run(spark):
    start = dt.datetime(2000, 1, 1)
    hours = list(range(0, 100_000, 1))
    run = spark.range(len(hours)).select(F.lit("p").alias("place"), F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit(start.isoformat()).cast("timestamp_ntz")).alias("time"))
    few = spark.createDataFrame([(p, start + dt.timedelta(hours=h)) for p in ("q", None) for h in (0, 10, 20, 30, 55, 60, 90, 90)], "place string, time timestamp_ntz")
    out = events.thin_by_refractory(run.union(few), ["place"], 24)
    assert "collect_list" not in out._jdf.queryExecution().toString()
    got = {}
    for r in out.collect():
        got.setdefault(r["place"], []).append(int((r["time"] - start).total_seconds() // 3600))
    assert sorted(got["p"]) == list(range(0, 100_000, 24))
    assert sorted(got["q"]) == sorted(got[None]) == [0, 30, 55, 90]


def test_preceding_mean_equals_the_window(spark):
    rng = np.random.default_rng(4)
    days = [d for d in range(400) if d % 37]
    rows = [(c, D(2020, 1, 1) + dt.timedelta(days=d), None if d % 41 == 0 else float("nan") if d % 43 == 0 else 3e5 + float(rng.normal())) for c in "ab" for d in days]
    df = spark.createDataFrame(rows, "cell string, date date, value double")
    known = {(c, d): v for c, d, v in rows if v is not None and v == v}
    got = {(r["cell"], r["date"]): r["value"] for r in timeseries.remove_preceding_mean(df, ["cell"], 30, min_days=20).collect()}
    want = {}
    for (c, d), v in known.items():
        past = [known[c, d - dt.timedelta(days=k)] for k in range(1, 31) if (c, d - dt.timedelta(days=k)) in known]
        if len(past) >= 20:
            want[c, d] = v - sum(past) / len(past)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-8 for k in want)


def test_points_meet_the_corner_table_in_one_join(spark):
    grid = Grid(0.0, 1.0, 4, 0.0, 90.0, 4)
    rows = [(v, t, lat, lon, lat + lon + k) for k, v in enumerate("ab") for t in (1, 2) for lat in grid.lats for lon in grid.lons]
    df = spark.createDataFrame(rows, "var string, time int, lat double, lon double, value double")
    points = spark.createDataFrame([(1, 0.5, 45.0), (2, 3.0, 300.0), (3, 3.1, 0.0)], "p int, lat double, lon double")
    out = neighbours.interpolate_at_points(df, grid, points, "p")
    got = {(r["var"], r["time"], r["p"]): r["value"] for r in out.collect()}
    assert got == pytest.approx({(v, t, p): x + k for k, v in enumerate("ab") for t in (1, 2) for p, x in ((1, 45.5), (2, 183.0))})
    plan = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    join = next(k for k, line in enumerate(plan) if "Join" in line)
    assert not any("Aggregate" in line or "Repartition" in line for line in plan[:join])


def test_missing_columns_of_wrapped_longitudes(spark):
    grid = Grid(0.0, 1.0, 1, -180.0, 1.0, 360)
    rows = [("z", 0.0, -180.0, None), ("z", 0.0, -179.0, None), ("z", 0.0, 176.0, 1.0), ("t", 0.0, 175.0, None)]
    df = spark.createDataFrame(rows, "var string, lat double, lon double, value double")
    assert {(r["var"], r["lon"]) for r in coverage.missing_longitudes(df).collect()} == {("z", -180.0), ("z", -179.0), ("t", 175.0)}
    found = {(r["var"], r["lon"]): r["n_rows"] for r in coverage.missing_longitudes(df, grid=grid).collect()}
    assert found["z", 177.0] == 0 and found["z", -180.0] == 1 and ("z", 176.0) not in found and found["t", 176.0] == 0


def test_scratch_is_removed(spark):
    with scratch(spark):
        path = new_dir(spark, "kept")
        spark.range(3).write.parquet(path)
    assert not path_exists(spark, path)


def test_runs_in_a_plain_session_from_another_folder(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as entry
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
print("rows", entry.queries()["map_items"](spark, "/root/testdata/sf0.001").count(), entry.queries()["upsert_forecasts"](spark, "/root/testdata/sf0.001").count() > 0)
from isopleth.session import materialise
print("stored", materialise(spark.range(5), "x").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"SPARK_CONF_DIR": str(tmp_path)}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "stored 5" in out.stdout and "rows " in out.stdout, out.stderr[-2000:]
