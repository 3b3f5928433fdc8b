"""Stored fields read back canonically, units from sink to ledger, areas, incoming fields, front plan."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from isopleth.operators import combine, events
from isopleth.plans import observed, work
from isopleth.schema import FIELD_SCHEMA
from isopleth.session import new_dir
from isopleth.sources import fields, inventory, tables

TS = dt.datetime


def field(spark, source="primary", levels=(500, None), days=(1, 2), var="hgt"):
    rows = [(source, var, lv, TS(2024, 1, d, h), lat, lon, d + h + lat + lon) for lv in levels for d in days for h in (0, 12) for lat in (0.0, 10.0) for lon in (0.0, 190.0)]
    return spark.createDataFrame(rows, FIELD_SCHEMA)


@pytest.mark.parametrize("levels", [(500, None), (None,), (500,)])
def test_field_scan_restores_the_schema(spark, rows, levels):
    path = new_dir(spark, "t")
    df = field(spark, levels=levels)
    fields.write_field(df, path, fields.DAILY)
    back = fields.read_field(spark, path, wrap=False)
    assert back.dtypes == df.dtypes
    assert rows(back) == rows(df)


def test_stored_fields_of_other_levels_go_together(spark):
    a, b = new_dir(spark, "t"), new_dir(spark, "t")
    fields.write_field(field(spark, levels=(None, 850)), a)
    fields.write_field(field(spark, "secondary", levels=(500,), days=(2, 3)), b)
    both = fields.read_fields(spark, [a, b], concat=True)
    assert {r["level"] for r in both.collect()} == {None, 500, 850}
    d = dt.date
    spliced = combine.splice_sources(fields.read_field(spark, a), field(spark, "secondary", (850,), (2, 3)), d(2024, 1, 1), d(2024, 1, 3), d(2024, 1, 9))
    assert spliced.where("source = 'secondary'").agg(F.min(F.dayofmonth("time"))).first()[0] == 3


def test_glob_with_a_period_and_other_columns(spark):
    path = new_dir(spark, "t")
    fields.write_field(field(spark), path, fields.DAILY)
    found = fields.read_glob(spark, path + "/source=*/var=*/level=500/year=*/month=*/day=*", base=path, start=dt.date(2024, 1, 2))
    assert found.count() == 8 and {r["level"] for r in found.collect()} == {500}
    mixed = new_dir(spark, "t")
    field(spark, days=(1,)).write.parquet(f"{mixed}/a")
    field(spark, days=(2,)).withColumn("more", F.lit(1)).write.parquet(f"{mixed}/b")
    assert "more" in fields.read_glob(spark, f"{mixed}/*", merge_schema=True).columns


def test_from_requests_through_the_sink_to_nothing_left(spark):
    d = dt.date
    wanted = [("geopotencial", 500, d(2024, 1, 1), d(2024, 1, 2)), ("temperatura_2m", None, d(2024, 1, 1), d(2024, 1, 2))]
    requests = spark.createDataFrame(wanted, "var_key string, level int, start_date date, end_date date")
    root, runs = new_dir(spark, "sink"), new_dir(spark, "ledger")
    fields.write_field(field(spark, levels=(500,)), root)
    units = inventory.list_units(spark, root)
    work.append_runs(work.month_work(requests).withColumn("run_at", F.lit(1)), runs)
    left = work.work_left(requests, work.read_runs(spark, runs), units)
    assert [r["name"] for r in left.collect()] == ["source=primary/var=t2m/level=none/year=2024/month=1"]
    fields.write_field(field(spark, levels=(None,), var="t2m"), root)
    units = inventory.list_units(spark, "file:" + root + "/")
    assert work.work_left(requests, work.read_runs(spark, runs), units).count() == 0
    assert all(r["n_files"] >= 1 and r["n_bytes"] > 0 and r["oldest"] <= r["modified"] for r in units.collect())


def test_units_of_days_are_gathered_by_month(spark):
    root = new_dir(spark, "region=x")
    fields.write_field(field(spark, levels=(500,)), root, fields.DAILY)
    assert [r["path"] for r in inventory.list_units(spark, root).collect()] == ["source=primary/var=hgt/level=500/year=2024/month=1"]
    days = inventory.list_units(spark, root, fields.DAILY)
    assert {r["path"].rsplit("/", 1)[1] for r in days.collect()} == {"day=1", "day=2"}


def test_paths_match_however_spelt(spark):
    have = spark.createDataFrame([("file:/a/b", TS(2024, 1, 1), 20_000)], "path string, modified timestamp, n_bytes long")
    wanted = spark.createDataFrame([("/a/b",), ("file:///a/b/",), ("/a/c",), ("s3a://a/b",)], "path string")
    got = {r["path"]: r["exists"] for r in inventory.check_files(wanted, have, TS(2024, 1, 2, tzinfo=dt.timezone.utc)).collect()}
    assert got == {"/a/b": True, "file:///a/b/": True, "/a/c": False, "s3a://a/b": False}


def test_areas_in_one_pass_equal_one_by_one(spark, rows):
    df = field(spark)
    start, end = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    areas = [("all", 90, -180, -90, 180), ("line", 20, 160, 5, -160), ("none", 90, 20, 80, 30)]
    got = observed.mean_fields(df, start, end, areas)
    cols = [c for c in got.columns if c != "area"]
    for name, *area in areas:
        assert rows(got.where(F.col("area") == name), *cols) == rows(observed.mean_field(df, start, end, tuple(area)), *cols)


def test_normalise(spark):
    raw = spark.createDataFrame(
        [(TS(2024, 1, 1), 0.0, 190.0, lv, v) for lv, v in [(500, 1.0), (850, 2.0)]] + [(TS(2024, 1, 1), 0.0, 0.0, 500, -9999.0)],
        "valid_time timestamp_ntz, Latitude double, longitude double, level int, z double",
    )
    out = observed.normalise(raw, "geopotencial", fills=[-9999.0])
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in FIELD_SCHEMA]
    got = {(r["var"], r["lon"]): r["value"] for r in out.collect()}
    assert got == {("hgt", -170.0): pytest.approx(tables.get_variable("geopotencial")["factor"]), ("hgt", 0.0): None}
    with pytest.raises(ValueError, match="known"):
        observed.normalise(raw, "no such thing")


def test_forecast_without_observations_stays(spark):
    observed_days = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1.0)], "s string, date date, value double")
    ahead = spark.createDataFrame([(s, dt.date(2024, 1, d), d - 1, float(d)) for s in "ab" for d in (1, 2)], "s string, date date, lead_days int, value double")
    got = sorted((r["s"], r["date"].day, r["is_forecast"]) for r in combine.splice_forecast(observed_days, ahead, ["s"]).collect())
    assert got == [("a", 1, False), ("a", 2, True), ("b", 2, True)]


def test_appended_series_may_share_cells(spark):
    parts = [field(spark, levels=(500,)), field(spark, levels=(850,))]
    out = combine.concat_steps(parts)
    assert out.count() == 32
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    with pytest.raises(Exception, match="twice"):
        combine.concat_steps([parts[0], parts[0]]).collect()


def test_fronts_are_placed_once(spark):
    df = spark.createDataFrame([("x", TS(2024, 1, 1), 1.0, 2.0)], "place string, time timestamp_ntz, v double, temp double")
    plan = events.front_passages(df, ["place"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(place") == 1 and "Join" not in plan
