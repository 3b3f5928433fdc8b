import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from isopleth.functions import scalars
from isopleth.operators import cleaning
from isopleth.operators import requests as req
from isopleth.sources import tables

T = dt.datetime


def test_wrap_longitude_matches_floor_modulo(spark, rows):
    xs = [0.0, 180.0, 190.0, 359.75, -180.0, -190.0, 540.0, -0.25, 179.99]
    df = spark.createDataFrame([(x,) for x in xs], "lon double")
    got = dict(df.select("lon", scalars.wrap_longitude(F.col("lon"))).collect())
    for x in xs:
        assert got[x] == pytest.approx((x + 180) % 360 - 180)
        assert -180 <= got[x] < 180
    twice = df.select(scalars.wrap_longitude(scalars.wrap_longitude(F.col("lon"))).alias("b"), scalars.wrap_longitude(F.col("lon")).alias("a"))
    assert twice.where("a <> b").count() == 0


def test_canonical_names(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "Latitude double, LONGITUDE double, z double")
    out = cleaning.canonical_names(df, scalar_time=T(2024, 1, 1))
    assert set(out.columns) == {"lat", "lon", "z", "time"}
    assert out.first()["time"] == T(2024, 1, 1)
    with pytest.raises(ValueError):
        cleaning.canonical_names(df)
    both = spark.createDataFrame([(1.0, 2.0, T(2024, 1, 1), T(2024, 1, 2))], "lat double, latitude double, time timestamp_ntz, valid_time timestamp_ntz")
    kept = cleaning.canonical_names(both)
    assert set(kept.columns) == {"lat", "latitude", "time", "valid_time"}
    assert kept.first()["lat"] == 1.0


def test_pick_variable(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0, "1", 4.0, 5.0)], "number int, lat double, lon double, expver string, z double, q double")
    out = cleaning.pick_variable(df)
    assert out.columns == ["lat", "lon", "value"] and out.first()["value"] == 4.0
    with pytest.raises(KeyError):
        cleaning.pick_variable(df.select("lat", "lon", "number", "expver"))


def test_squeeze_level_takes_first_of_each_cell(spark, rows):
    df = spark.createDataFrame(
        [(1.0, 850, 0, 5.0), (1.0, 500, 1, 6.0), (2.0, 500, 1, 7.0)], "lat double, level int, n int, value double"
    )
    assert rows(cleaning.squeeze_level(df, "n", keys=["lat"]), "lat", "value") == [(1.0, 5.0), (2.0, 7.0)]


def test_time_slice_ends(spark):
    df = spark.createDataFrame([(T(2024, 1, d, h),) for d in (1, 2, 3) for h in (0, 18)], "time timestamp_ntz")
    assert cleaning.time_slice(df, dt.date(2024, 1, 2), dt.date(2024, 1, 2)).count() == 2
    assert cleaning.time_slice(df, None, dt.date(2024, 1, 2)).count() == 4
    assert cleaning.time_slice(df, T(2024, 1, 2, 18), T(2024, 1, 3, 0)).count() == 2
    assert cleaning.time_slice(df).count() == 6
    days = df.select(F.to_date("time").alias("date"))
    assert cleaning.time_slice(days, dt.date(2024, 1, 2), dt.date(2024, 1, 2), "date").count() == 2
    assert cleaning.time_slice(days, T(2024, 1, 2, 1), None, "date").count() == 2


def test_box_across_the_antimeridian(spark, rows):
    df = spark.createDataFrame([(0.0, x) for x in (-180.0, -150.0, 0.0, 149.0, 150.0)], "lat double, lon double")
    assert [r[1] for r in rows(cleaning.bounding_box(df, (5, 150, -5, -150)))] == [-180.0, -150.0, 150.0]
    assert cleaning.bounding_box(df, None).count() == 5


def test_hours(spark):
    assert cleaning.normalise_hours(None) == [0, 6, 12, 18]
    assert cleaning.normalise_hours([12, 0, 12]) == [0, 12]
    for bad in ([], [24], [-1]):
        with pytest.raises(ValueError):
            cleaning.normalise_hours(bad)
    df = spark.createDataFrame([(T(2024, 1, 1, 6, 0),), (T(2024, 1, 1, 6, 1),), (T(2024, 1, 1, 7),)], "time timestamp_ntz")
    assert cleaning.at_hours(df).count() == 1


def test_missing_marks(spark):
    df = spark.createDataFrame([(float("nan"),), (-9999.0,), (1e20,), (3.0,), (None,)], "value double")
    out = [r[0] for r in cleaning.null_missing(df, [-9999.0], 1e10).collect()]
    assert out == [None, None, None, 3.0, None]


def test_unit_factor_is_for_the_primary_source_only(spark, rows):
    df = spark.createDataFrame(
        [("primary", "geopotencial", 98.0665), ("secondary", "geopotencial", 98.0665), ("primary", "temperatura", 5.0)],
        "source string, var_key string, value double",
    )
    out = rows(cleaning.convert_units(cleaning.resolve_variables(df)), "source", "var", "value")
    assert out == [("primary", "hgt", pytest.approx(10.0)), ("primary", "tmp", 5.0), ("secondary", "hgt", 98.0665)]


def test_unknown_variable(spark):
    df = spark.createDataFrame([("ozonio",)], "var_key string")
    with pytest.raises(Exception, match="ozonio.*agua_precipitavel, geopotencial"):
        cleaning.resolve_variables(df).select("var").collect()
    assert "known:" in cleaning.resolve_variables(df, "reject").first()["reject"]
    with pytest.raises(ValueError, match="agua_precipitavel"):
        tables.get_variable("ozonio")
    assert tables.get_variable("geopotencial")["var"] == "hgt"
    for row in tables.VARIABLES:
        assert ("{nivel}" in row[5]) == row[4]


def test_sort(spark):
    df = spark.createDataFrame([(2, 1.0, 0.0), (1, 1.0, 5.0), (1, 1.0, -5.0)], "time int, lat double, lon double")
    assert [tuple(r) for r in cleaning.sort_field(df).collect()] == [(1, 1.0, -5.0), (1, 1.0, 5.0), (2, 1.0, 0.0)]


def test_wind(spark):
    df = spark.createDataFrame([(5.0, 5.0), (0.0, 0.0), (-1.0, 0.0), (0.0, -2.0)], "u double, v double")
    got = df.select(scalars.wind_speed(F.col("u"), F.col("v")), scalars.wind_direction(F.col("u"), F.col("v"))).collect()
    assert got[0][0] == pytest.approx(math.sqrt(50)) and got[0][1] == pytest.approx(225.0)
    assert tuple(got[1]) == (0.0, None)
    assert got[2][1] == pytest.approx(90.0) and got[3][1] == pytest.approx(0.0)


def test_clock(spark):
    df = spark.createDataFrame([(T(2024, 3, 1, 0),)], "t timestamp_ntz")
    assert df.select(scalars.local_clock(F.col("t"))).first()[0] == T(2024, 2, 29, 21)


@pytest.mark.parametrize("name", ["hemisferio_sul", "zcit_3d_sul", "ENSO_x9y", "o'higgins_brasil", "a-b_c.d", "smas"])
def test_area_names(spark, name):
    want = " ".join(w.upper() if w.lower() in tables.ACRONYMS else w.title() for w in name.split("_"))
    df = spark.createDataFrame([(name,)], "a string")
    assert df.select(scalars.area_display_name(F.col("a"))).first()[0] == want


def test_source_messages(spark):
    texts = {
        "x Latest Date Available for this:\n 2024-03-17 18:00": (True, dt.date(2024, 3, 17)),
        "latest date available: 2024-13-01 00:00": (True, None),
        "NO MATCHING DATA": (True, None),
        "connection reset": (False, None),
    }
    df = spark.createDataFrame([(t,) for t in texts], "m string")
    for m, no_data, latest in df.select("m", scalars.says_no_data_yet(F.col("m")), scalars.latest_date_in(F.col("m"))).collect():
        assert (no_data, latest) == texts[m]


def test_ftp_urls(spark):
    urls = {
        "https://downloads.psl.noaa.gov/Datasets/file.nc": "ftp://ftp.cdc.noaa.gov/Datasets/file.nc",
        "https://psl.noaa.gov/thredds/fileServer/Datasets/a/tmax.2021.nc?x=1#f": "ftp://ftp.cdc.noaa.gov/Datasets/a/tmax.2021.nc",
        "http://www.cdc.noaa.gov": "ftp://ftp.cdc.noaa.gov",
        "https://example.org/psl.noaa.gov/x": "https://example.org/psl.noaa.gov/x",
    }
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    for u, f in df.select("u", scalars.to_ftp_url(F.col("u"))).collect():
        assert f == urls[u]


def test_request_checks_and_units(spark, rows):
    d = dt.date
    df = spark.createDataFrame(
        [
            (1, "geopotencial", 500, d(2023, 11, 20), d(2024, 2, 10)),
            (2, "geopotencial", None, d(2024, 1, 1), d(2024, 1, 2)),
            (3, "temperatura_2m", 500, d(2024, 1, 1), d(2024, 1, 2)),
            (4, "temperatura_2m", None, d(2024, 1, 2), d(2024, 1, 1)),
            (5, "temperatura_2m", None, d(2024, 1, 2), d(2024, 1, 2)),
        ],
        "id int, var_key string, level int, start_date date, end_date date",
    )
    assert [r[1] for r in rows(req.validate_requests(df), "id", "reason")] == [
        None, "level required", "level not accepted", "end before start", None,
    ]
    months = rows(req.month_units(df.where("id = 1")), "year", "month", "first_day", "last_day")
    assert months == [
        (2023, 11, d(2023, 11, 1), d(2023, 11, 30)),
        (2023, 12, d(2023, 12, 1), d(2023, 12, 31)),
        (2024, 1, d(2024, 1, 1), d(2024, 1, 31)),
        (2024, 2, d(2024, 2, 1), d(2024, 2, 10)),
    ]
    assert req.day_units(df.where("id in (4, 5)")).count() == 1


def test_request_url(spark):
    df = spark.createDataFrame(
        [("agua_precipitavel", None, dt.date(2024, 3, 5), None, None, None, None), ("geopotencial", 850, dt.date(2024, 3, 5), 10.0, -80.0, -40.0, 15.0)],
        "var_key string, level int, day date, north double, west double, south double, east double",
    )
    got = {r["var_key"]: r["url"] for r in req.request_urls(df, [6]).collect()}
    base = tables.FILTER_URL + "?file=gdas.t06z.pgrb2.0p25.f000&"
    assert got["agua_precipitavel"] == base + (
        "lev_entire_atmosphere_%28considered_as_a_single_layer%29=on&var_PWAT=on&dir=%2Fgdas.20240305%2F06%2Fatmos"
    )
    assert got["geopotencial"] == base + (
        "lev_850_mb=on&var_HGT=on&dir=%2Fgdas.20240305%2F06%2Fatmos&subregion=on&toplat=10.0&leftlon=-80.0&bottomlat=-40.0&rightlon=15.0"
    )
