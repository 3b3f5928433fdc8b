import datetime as dt
import hashlib
import json
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isopleth.functions import scalars
from isopleth.operators import items, ledger, messages, precipitation
from isopleth.plans import views, work
from isopleth.schema import FIELD_SCHEMA
from isopleth.session import new_dir, shared_dir
from isopleth.sources import fields, inventory, tables

TS = dt.datetime


# --- items ----------------------------------------------------------------------

RESULT = T.StructType([T.StructField("half", T.LongType())])


@pytest.fixture
def halve():
    def halve(item):
        if item["n"] == 3:
            raise ValueError("three")
        return None if item["n"] == 4 else {"half": item["n"] // 2}

    return halve


def test_items_capture_errors_and_keep_order(spark, halve):
    df = spark.createDataFrame([(k, k) for k in range(6)], "k int, n int").repartition(3)
    out = items.map_items(df, halve, "k", RESULT).orderBy("k").collect()
    assert [r["ok"] for r in out] == [True, True, True, False, True, True]
    assert out[3]["error_type"] == "ValueError" and out[3]["error_msg"] == "three" and "halve" in out[3]["traceback"]
    assert [r["half"] for r in out] == [0, 0, 1, None, None, 2]
    summary = items.outcome_summary(items.map_items(df, halve, "k", RESULT)).first()
    assert tuple(summary) == (5, 1, 6)
    assert items.map_items(df.limit(0), halve, "k", RESULT).count() == 0


def test_strict_items_drop_none_and_abort(spark, halve):
    df = spark.createDataFrame([(k, k) for k in range(6)], "k int, n int")
    ok = items.map_items_strict(df.where("n <> 3"), halve, "k", RESULT)
    assert [r["k"] for r in ok.orderBy("k").collect()] == [0, 1, 2, 5]
    with pytest.raises(Exception, match="three"):
        items.map_items_strict(df, halve, "k", RESULT).collect()


# --- ledger ---------------------------------------------------------------------

UNITS = "name string, params map<string,string>, outputs array<string>"


def pending(spark, requested, done, files):
    req = spark.createDataFrame(requested, UNITS)
    runs = ledger.record_runs(spark.createDataFrame(done, UNITS + ", run_at int"))
    have = spark.createDataFrame([(f,) for f in files], "path string")
    return sorted(r["name"] for r in ledger.pending_units(req, runs, have).collect())


def test_pending_scenarios(spark):
    p, q = {"a": "1", "b": "2"}, {"b": "2", "a": "1"}
    unit = ("s01", p, ["x", "y"])
    assert pending(spark, [unit], [], ["x", "y"]) == ["s01"]  # never ran
    assert pending(spark, [unit], [("s01", q, ["x", "y"], 1)], ["x", "y"]) == []  # done, key order is immaterial
    assert pending(spark, [unit], [("s01", {"a": "9"}, ["x"], 1)], ["x", "y"]) == ["s01"]  # other parameters
    assert pending(spark, [unit], [("s01", p, ["x", "y"], 1)], ["x"]) == ["s01"]  # output absent
    assert pending(spark, [("s01", p, ["x"])], [("s01", p, ["x", "y"], 1)], ["x"]) == []  # only requested outputs count
    latest = [("s01", p, ["x"], 1), ("s01", {"a": "9"}, ["x"], 2)]
    assert pending(spark, [("s01", p, ["x"])], latest, ["x"]) == ["s01"]  # the latest run counts
    assert pending(spark, [("s02", p, ["x"])], latest, ["x"]) == ["s02"]  # other name
    assert pending(spark, [("s01", p, [])], [("s01", p, [], 1)], []) == []  # no outputs asked


def test_ledger_keeps_the_latest_and_forgets_invalidated(spark):
    runs = ledger.record_runs(
        spark.createDataFrame([("a", {"k": "1"}, ["x"], 1), ("a", {"k": "2"}, ["x", "y"], 2), ("b", {"k": "1"}, [], 1)], UNITS + ", run_at int")
    )
    now = {r["name"]: r["n_outputs"] for r in ledger.current_ledger(runs).collect()}
    assert now == {"a": 2, "b": 0}
    gone = spark.createDataFrame([("a",)], "name string")
    assert [r["name"] for r in ledger.current_ledger(runs, gone).collect()] == ["b"]
    req = spark.createDataFrame([("a", {"k": "2"}, ["x"]), ("b", {"k": "2"}, [])], UNITS)
    have = spark.createDataFrame([("x",)], "path string")
    assert {r["name"]: r["pending"] for r in ledger.unit_status(req, runs, have).collect()} == {"a": False, "b": True}


def test_hash_is_that_of_sorted_json(spark):
    params = {"z": 'quote " and \\ slash', "DATA_INICIAL": "2025-10-08", "areas": "brasil"}
    df = spark.createDataFrame([(params,)], "p map<string,string>")
    assert df.select(ledger.params_hash(F.col("p"))).first()[0] == hashlib.md5(json.dumps(params, sort_keys=True).encode()).hexdigest()


def test_month_work_to_ledger_and_back(spark):
    d = dt.date
    wanted = [("geopotencial", 500, d(2024, 1, 10), d(2024, 2, 10)), ("geopotencial", 500, d(2024, 2, 1), d(2024, 2, 20)), ("temperatura_2m", 500, d(2024, 1, 1), d(2024, 1, 2)), ("temperatura_2m", None, d(2024, 1, 1), d(2024, 1, 2))]
    requests = spark.createDataFrame(wanted, "var_key string, level int, start_date date, end_date date")
    units = work.month_work(requests)
    got = {r["name"]: r["params"]["last_day"] for r in units.collect()}
    feb = "source=primary/var=hgt/level=500/year=2024/month=2"
    assert got == {
        "source=primary/var=hgt/level=500/year=2024/month=1": "2024-01-31",
        feb: "2024-02-20",
        "source=primary/var=t2m/level=none/year=2024/month=1": "2024-01-02",
    }
    path = new_dir(spark, "ledger")
    work.append_runs(units.withColumn("run_at", F.lit(1)), path)
    runs, files = work.read_runs(spark, path), units.select(F.explode("outputs").alias("path"))
    assert work.work_left(requests, runs, files).count() == 0
    assert [r["name"] for r in work.work_left(requests, runs, files.where(~F.col("path").endswith("month=2"))).collect()] == [feb]
    longer = requests.unionByName(requests.limit(1).withColumn("end_date", F.lit("2024-02-29").cast("date")))
    assert [r["name"] for r in work.work_left(longer, runs, files).collect()] == [feb]
    work.append_runs(work.month_work(longer).withColumn("run_at", F.lit(2)), path)
    assert work.work_left(longer, work.read_runs(spark, path), files).count() == 0


# --- error rules ----------------------------------------------------------------


def test_first_rule_wins_and_ancestors_match(spark):
    cases = [
        ("RuntimeError", "x corrompido mesmo apos re-download", "support file corrupt here and on the server"),
        ("RuntimeError", "x corrompido", "support file corrupt"),
        ("OSError", "x corrompido", None),
        ("ConnectionRefusedError", "Falha na conexao SFTP", "SFTP connection failed"),
        ("ConnectionRefusedError", "", "SSH connection refused"),
        ("ConnectionError", "", None),
        ("FileNotFoundError", "No such file or directory", "remote file not found"),
        ("ValueError", "No such file or directory", "SSH key not found"),
        ("TimeoutError", "Unknown file format", "SSH connection timed out"),
        ("FileNotFoundError", "Unknown file format", "file corrupt or of another format"),
        ("ModuleNotFoundError", "jinja2", "dependency jinja2 missing"),
        ("ModuleNotFoundError", "numpy", "Python module missing"),
        ("ValueError", "key_cds", None),
    ]
    df = spark.createDataFrame([c[:2] for c in cases], "error_type string, message string")
    assert [r["hint"] for r in messages.classify_messages(df).collect()] == [c[2] for c in cases]
    assert len(tables.ERROR_RULES) == 17


# --- files ----------------------------------------------------------------------


def sample(spark, days=(1, 2), value=1.0, level=500):
    rows = [("p", "v", level, TS(2024, 1, d, h), 0.0, lon, value) for d in days for h in (0, 12) for lon in (0.0, 190.0)]
    return spark.createDataFrame(rows, FIELD_SCHEMA)


def test_write_replaces_only_its_units(spark):
    path = new_dir(spark, "t")
    fields.write_field(sample(spark, (1, 2)), path, fields.DAILY)
    fields.write_field(sample(spark, (2,), 5.0), path, fields.DAILY)
    got = {(r["time"].day, r["value"]) for r in fields.read_written(spark, path).collect()}
    assert got == {(1, 1.0), (2, 5.0)}
    assert os.path.isdir(f"{path}/source=p/var=v/level=500/year=2024/month=1/day=2")


def test_null_level_survives(spark):
    path = new_dir(spark, "t")
    fields.write_field(sample(spark, level=None).unionByName(sample(spark, level=850)), path)
    back = fields.read_written(spark, path)
    assert back.schema.fieldNames() == FIELD_SCHEMA.fieldNames()
    assert {r["level"] for r in back.collect()} == {None, 850}
    only_null = new_dir(spark, "t")
    fields.write_field(sample(spark, level=None), only_null)
    assert {r["level"] for r in fields.read_written(spark, only_null).collect()} == {None}


def test_reads(spark):
    path, other = new_dir(spark, "t"), new_dir(spark, "t")
    fields.write_field(sample(spark), path)
    sample(spark, (3,)).select("time", "value").write.parquet(other)
    assert {r["lon"] for r in fields.read_field(spark, path).collect()} == {0.0, -170.0}
    assert {r["lon"] for r in fields.read_field(spark, path, wrap=False).collect()} == {0.0, 190.0}
    assert fields.read_field(spark, path, start=dt.date(2024, 1, 2), end=dt.date(2024, 1, 2)).count() == 4
    assert fields.read_field(spark, path, start=dt.date(2024, 2, 1)).count() == 0
    assert [f.count() for f in fields.read_fields(spark, [path, other])] == [8, 4]
    both = fields.read_fields(spark, [path, other], concat=True)
    assert both.count() == 12 and both.where("lat is null").count() == 4
    plan = fields.read_field(spark, path, start=dt.date(2024, 1, 2))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(time" in plan
    globbed = fields.read_glob(spark, path + "/source=*/var=*/level=*/year=2024/month=1", base=path)
    assert globbed.count() == 8 and globbed.first()["source"] == "p" and globbed.first()["file_path"].endswith(".parquet")
    with pytest.raises(Exception, match="PATH_NOT_FOUND|not exist"):
        fields.read_field(spark, path + "-absent").collect()


def test_one_scan_for_each_schema(spark):
    paths, other, units = [new_dir(spark, "t") for _ in range(6)], new_dir(spark, "t"), new_dir(spark, "t")
    for k, path in enumerate(paths):
        sample(spark, (k + 1,)).write.parquet(path)
    sample(spark, (9,)).select("time", "value").write.parquet(other)
    fields.write_field(sample(spark, (8,)), units)
    n = sample(spark, (1,)).count()
    both = fields.read_fields(spark, [*paths, other, units, paths[0]], concat=True)
    assert both.count() == 9 * n
    assert both._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 4
    by_day = {r["d"]: r["count"] for r in both.selectExpr("day(time) AS d").groupBy("d").count().collect()}
    assert by_day == {1: 2 * n, **{k: n for k in (2, 3, 4, 5, 6, 8, 9)}}


def test_delimited(spark):
    path = new_dir(spark, "t")
    spark.createDataFrame([("# head",), ("1;2.5",), ("3;-4e2",)], "value string").coalesce(1).write.text(path)
    assert sorted(map(tuple, fields.read_delimited(spark, path, "a int, b double", sep=";").collect())) == [(1, 2.5), (3, -400.0)]
    bad = new_dir(spark, "t")
    spark.createDataFrame([("1;oops",)], "value string").write.text(bad)
    with pytest.raises(Exception):
        fields.read_delimited(spark, bad, "a int, b double", sep=";").collect()


def test_inventory_boundaries(spark):
    now = TS(2024, 6, 1, 12, tzinfo=dt.timezone.utc)
    have = spark.createDataFrame(
        [("fresh", TS(2024, 6, 1, 0), 10_000), ("old", TS(2024, 5, 31, 23, 59, 59), 20_000), ("small", TS(2024, 6, 1, 11), 9_999)],
        "path string, modified timestamp_ntz, n_bytes long",
    ).withColumn("modified", F.col("modified").cast("timestamp"))
    wanted = spark.createDataFrame([("fresh",), ("old",), ("small",), ("none",)], "path string")
    got = {r["path"]: (r["exists"], r["ok"], r["stale"], r["fetch"]) for r in inventory.check_files(wanted, have, now, max_age_hours=12).collect()}
    assert got == {
        "fresh": (True, True, False, False),
        "old": (True, True, True, True),
        "small": (True, False, False, True),
        "none": (False, False, False, True),
    }
    forced = inventory.check_files(wanted, have, now, force=True)
    assert forced.where("not fetch").count() == 0 and forced.where("stale").count() == 0


def test_listing(spark):
    path = new_dir(spark, "t")
    fields.write_field(sample(spark), path)
    files = inventory.list_files(spark, path, "*.parquet").collect()
    assert files and all(f["n_bytes"] > 0 and f["modified"].year >= 2024 for f in files)


def test_shared_dir_is_stable(spark):
    assert shared_dir(spark) == shared_dir(spark) and new_dir(spark, "x") != new_dir(spark, "x")


def test_literal_table(spark):
    rows = [("it's", 1.5, None, True), ("b\\c", -2.0, 3, False)]
    out = tables.literal_table(spark, rows, "a string, b double, c int, d boolean")
    assert [tuple(r) for r in out.collect()] == rows
    assert tables.variable_registry(spark).count() == len(tables.VARIABLES)


# --- properties -----------------------------------------------------------------

QUICK = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@QUICK
@given(st.lists(st.floats(-720, 720), min_size=1, max_size=20))
def test_wrap_is_idempotent_and_bounded(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    once = scalars.wrap_longitude(F.col("x"))
    for a, b in df.select(once, scalars.wrap_longitude(once)).collect():
        assert -180 <= a < 180 and abs(a - b) < 1e-9


@QUICK
@given(st.lists(st.integers(0, 1000), min_size=1, max_size=12))
def test_de_accumulate_undoes_accumulate(spark, xs):
    df = spark.createDataFrame([(1, k, float(x)) for k, x in enumerate(xs)], "run int, step int, value double")
    totals = precipitation.running_total(df, ["run"], "step").select("run", "step", "total")
    back = precipitation.de_accumulate(totals, ["run"], "step").orderBy("step").collect()
    assert [r["increment"] for r in back] == [float(x) for x in xs]


def test_views_have_unique_cells(spark):
    sf = "/root/testdata/sf0.001"
    for view in (views.grid_obs, views.grid_alt):
        df = view(spark, sf)
        assert df.count() == df.select("time", "lat", "lon").distinct().count()
