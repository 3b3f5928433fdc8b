import datetime as dt

import pytest
from pyspark.sql import functions as F

from isopleth.operators import combine, coverage

D, T = dt.date, dt.datetime
FIELD = "source string, var string, level int, time timestamp_ntz, lat double, lon double, value double"


def field(spark, source, var, level, days, value=1.0):
    return spark.createDataFrame([(source, var, level, T(2024, 1, d, 6), 0.0, 0.0, value) for d in days], FIELD)


def test_coverage_with_null_level(spark, rows):
    df = field(spark, "a", "t2m", None, [3, 1, 2, 2, 5]).unionByName(field(spark, "a", "hgt", 500, range(1, 6)))
    keys = ["var", "level"]
    report = {r["var"]: r for r in coverage.coverage_report(df, D(2024, 1, 1), D(2024, 1, 5), keys).collect()}
    assert report["t2m"]["status"] == "gaps" and report["t2m"]["days_present"] == 4
    assert report["hgt"]["status"] == "ok"
    out = {r["var"]: r["status"] for r in coverage.coverage_report(df, D(2023, 12, 31), D(2024, 1, 5), keys).collect()}
    assert set(out.values()) == {"out_of_range"}
    assert rows(coverage.missing_days(df, D(2024, 1, 1), D(2024, 1, 6), keys), "var", "level", "day") == [
        ("hgt", 500, D(2024, 1, 6)),
        ("t2m", None, D(2024, 1, 4)),
        ("t2m", None, D(2024, 1, 6)),
    ]
    wanted = spark.createDataFrame(
        [("t2m", None, D(2024, 1, 1), D(2024, 1, 5)), ("t2m", None, D(2024, 1, 1), D(2024, 1, 6)), ("rh", 500, D(2024, 1, 1), D(2024, 1, 1))],
        "var string, level int, start_date date, end_date date",
    )
    assert [r[2] for r in rows(coverage.covers_wanted(df, wanted, keys), "var", "end_date", "covers")] == [False, True, False]
    coverage.require_coverage(df.where("var = 'hgt'"), D(2024, 1, 1), D(2024, 1, 5), keys)
    with pytest.raises(RuntimeError, match="gaps.*2024-01-01 to 2024-01-05"):
        coverage.require_coverage(df, D(2024, 1, 1), D(2024, 1, 5), keys)


def test_sub_daily_steps_do_not_hide_gaps(spark):
    rows = [("a", "t", 1, T(2024, 1, d, h), 0.0, 0.0, 1.0) for d in (1, 3) for h in (0, 6, 12, 18)]
    df = spark.createDataFrame(rows, FIELD)
    assert coverage.coverage_report(df, D(2024, 1, 1), D(2024, 1, 3), ["var"]).first()["status"] == "gaps"


def splice(spark, primary, start, end, today=D(2024, 1, 20)):
    secondary = field(spark, "s", "t2m", None, range(1, 31))
    out = combine.splice_sources(primary, secondary, start, end, today)
    got = [(r["time"].day, r["source"]) for r in out.collect()]
    assert len({d for d, _ in got}) == len(got)
    return sorted(got)


def test_splice_known_last_day_keeps_inner_gaps(spark):
    got = splice(spark, field(spark, "p", "t2m", None, [1, 2, 4]), D(2024, 1, 2), D(2024, 1, 6))
    assert got == [(2, "p"), (4, "p"), (5, "s"), (6, "s")]


def test_splice_unknown_last_day(spark):
    got = splice(spark, field(spark, "p", "other", 1, [1]), D(2024, 1, 10), D(2024, 1, 14))
    assert got == [(d, "s") for d in (10, 11, 12, 13, 14)]  # the primary source does not have the series


def test_splice_fully_covered(spark):
    got = splice(spark, field(spark, "p", "t2m", None, range(1, 31)), D(2024, 1, 10), D(2024, 1, 12))
    assert got == [(10, "p"), (11, "p"), (12, "p")]


def test_splice_last_day_before_start(spark):
    got = splice(spark, field(spark, "p", "t2m", None, [1, 2]), D(2024, 1, 10), D(2024, 1, 11))
    assert got == [(10, "s"), (11, "s")]


def test_concat_rejects_a_repeated_cell(spark):
    a, b = (field(spark, "p", "t", 1, [d]) for d in (1, 2))
    assert combine.concat_steps([a, b]).count() == 2
    with pytest.raises(Exception, match="twice"):
        combine.concat_steps([a, a]).collect()


def test_mosaic_fills_null_and_absent(spark, rows):
    p = spark.createDataFrame([(1, 1.0), (2, None)], "k int, value double")
    s = spark.createDataFrame([(1, 9.0), (2, 8.0), (3, 7.0), (4, None)], "k int, value double")
    assert rows(combine.mosaic(p, s, ["k"])) == [(1, 1.0, "primary"), (2, 8.0, "secondary"), (3, 7.0, "secondary")]


def test_splice_forecast_drops_lead_zero_and_overlap(spark, rows):
    obs = spark.createDataFrame([("m", D(2024, 1, d), 1.0) for d in (1, 2, 3)], "model string, date date, value double")
    fc = spark.createDataFrame(
        [("m", D(2024, 1, d), lead, 2.0) for d, lead in ((3, 1), (4, 0), (4, 2), (5, 3))], "model string, date date, lead_days int, value double"
    )
    got = rows(combine.splice_forecast(obs, fc, ["model"]), "date", "is_forecast")
    assert [(d.day, f) for d, f in got] == [(1, False), (2, False), (3, False), (4, True), (5, True)]


def test_upserts(spark, rows):
    d = D(2024, 1, 5)
    fc = spark.createDataFrame(
        [("m", D(2024, 1, 1), d, 1.0, 10), ("m", D(2024, 1, 1), d, 2.0, 11), ("m", D(2024, 1, 2), d, 3.0, 1)],
        "model string, init date, target date, value double, loaded_at long",
    )
    assert rows(combine.upsert_forecasts(fc), "lead_days", "value") == [(3, 3.0), (4, 2.0)]
    obs = spark.createDataFrame(
        [(d, "primary", 1.0, 1), (d, "secondary", 2.0, 9), (d, "primary", 3.0, 2)], "date date, source string, value double, loaded_at long"
    )
    assert combine.upsert_observed(obs).first()["value"] == 3.0


def test_align(spark, rows):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, value double")
    b = spark.createDataFrame([(2, 5.0), (3, 6.0)], "k int, value double")
    assert rows(combine.align_fields(a, b, ["k"])) == [(2, 2.0, 5.0)]
    assert a.select(F.max("k")).first()[0] == 2
