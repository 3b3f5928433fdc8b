"""Registered queries: scans, cleaning, planning, coverage, combination, means, regridding, items."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isopleth.functions import scalars
from isopleth.operators import (
    aggregate,
    cleaning,
    climatology,
    combine,
    coverage,
    items,
    ledger,
    messages,
    neighbours,
)
from isopleth.operators import requests as req
from isopleth.plans import observed, views, work
from isopleth.plans.registry import big, day, instant, query, r
from isopleth.plans.views import with_views
from isopleth.session import materialise, new_dir
from isopleth.sources.tables import literal_table
from isopleth.sources import fields, inventory, published, tables

D = dt.date
WRAP = "((lon + 180) % 360 + 360) % 360 - 180"
_landed: dict[tuple[str, str, str], str] = {}


def _land(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Write a view as a field below the shared folder, once per session and data set."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _landed:
        path = new_dir(spark, name)
        fields.write_field(getattr(views, name)(spark, sf_dir), path)
        _landed[key] = path
    return _landed[key]


# --- sources and sinks ----------------------------------------------------------


@query(
    "field_scan",
    with_views(
        "grid_obs",
        f"""SELECT source, var, {big('level')} AS level, {instant('time')} AS time, lat, {r(WRAP)} AS lon, {r('value')} AS value FROM grid_obs
        WHERE time >= DATE '2024-01-05' AND time < DATE '2024-01-21'""",
    ),
)
def field_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fields.read_field(spark, _land(spark, sf_dir, "grid_obs"), start=D(2024, 1, 5), end=D(2024, 1, 20))
    return rows.select("source", "var", "level", "time", "lat", "lon", "value")


@query(
    "multi_field_scan",
    with_views(
        "grid_obs grid_alt",
        f"""SELECT source, {instant('time')} AS time, lat, {r(WRAP)} AS lon, {r('value')} AS value
        FROM (FROM grid_obs UNION ALL FROM grid_alt) WHERE time < DATE '2024-01-16'""",
    ),
)
def multi_field_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [_land(spark, sf_dir, "grid_obs"), _land(spark, sf_dir, "grid_alt")]
    rows = fields.read_fields(spark, paths, end=D(2024, 1, 15), concat=True)
    return rows.select("source", "time", "lat", "lon", "value")


@query(
    "glob_scan",
    with_views(
        "grid_obs",
        f"""SELECT {instant('time')} AS time, lat, {r(WRAP)} AS lon, {r('value')} AS value, true AS has_file FROM grid_obs""",
    ),
)
def glob_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fields.read_glob(spark, _land(spark, sf_dir, "grid_obs") + "/source=*/var=*/level=*/year=*/month=*")
    return rows.select("time", "lat", "lon", "value", F.col("file_path").contains(".parquet").alias("has_file"))


@query(
    "delimited_scan",
    with_views("grid_obs", f"SELECT {big('day(time) * 24 + hour(time)')} AS hour_no, lat, lon, {r('value')} AS value FROM grid_obs"),
)
def delimited_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_dir(spark, "delimited")
    obs = views.grid_obs(spark, sf_dir)
    line = F.concat_ws(";", F.dayofmonth("time") * 24 + F.hour("time"), "lat", "lon", "value")
    remark = F.concat(F.lit("# step of "), F.col("time").cast("string"))
    # every number is preceded by a comment line
    obs.select(F.explode(F.array(remark, line)).alias("value")).write.text(path)
    return fields.read_delimited(spark, path, "hour_no bigint, lat double, lon double, value double", sep=";")


@query(
    "partitioned_sink",
    with_views(
        "grid_obs",
        f"""SELECT source, var, {big('level')} AS level, {instant('time')} AS time, lat, lon,
        {r("CASE WHEN time < DATE '2024-01-11' THEN value * 2 ELSE value END")} AS value FROM grid_obs""",
    ),
)
def partitioned_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write day units, replace the first ten days, read back."""
    path = new_dir(spark, "sink")
    obs = views.grid_obs(spark, sf_dir)
    fields.write_field(obs, path, fields.DAILY)
    redone = cleaning.time_slice(obs, None, D(2024, 1, 10)).withColumn("value", F.col("value") * 2)
    fields.write_field(redone, path, fields.DAILY)
    return fields.read_written(spark, path)


_PUBLISHED_VAR_SQL = "CASE WHEN lat < 0 THEN 'south' WHEN lat > 0 THEN 'north' ELSE 'line' END"


def _publish_twice(spark: SparkSession, sf_dir: str) -> str:
    """Publish a field of three variables by day, replace its first ten days, and stage a third version that fails its check."""
    root = new_dir(spark, "published")
    lat = F.col("lat")
    obs = views.grid_obs(spark, sf_dir).withColumn("var", F.when(lat < 0, "south").when(lat > 0, "north").otherwise("line"))
    published.publish(published.stage(obs, root, fields.DAILY), published.require_units(1))
    redone = cleaning.time_slice(obs, None, D(2024, 1, 10)).withColumn("value", F.col("value") * 2)
    published.publish(published.stage(redone, root, fields.DAILY))
    try:
        late = published.stage(obs.withColumn("value", F.col("value") * 100), root, fields.DAILY)
        published.publish(late, published.require_units(10**12))
    except ValueError:
        return root
    raise AssertionError("a version that falls short was published")


@query(
    "published_units",
    with_views(
        "grid_obs",
        f"""SELECT source, {_PUBLISHED_VAR_SQL} AS var, {big('level')} AS level, {instant('time')} AS time, lat, lon,
        {r("CASE WHEN time < DATE '2024-01-11' THEN value * 2 ELSE value END")} AS value FROM grid_obs""",
    ),
)
def published_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers see after two publications and a failed one."""
    return published.read_published_field(spark, _publish_twice(spark, sf_dir)).select(*fields.FIELD_SCHEMA.names)


@query(
    "published_coverage",
    with_views(
        "grid_obs",
        f"""WITH d AS (SELECT DISTINCT source, {_PUBLISHED_VAR_SQL} AS var, CAST(time AS DATE) AS d FROM grid_obs),
        a AS (SELECT source, var, min(d) AS first_day, max(d) AS last_day, count(*) FILTER (d BETWEEN DATE '2024-01-02' AND DATE '2024-02-02') AS n FROM d GROUP BY ALL)
        SELECT source, var, {day('first_day')} AS first_day, {day('last_day')} AS last_day, n AS days_present, {big('32')} AS days_expected,
        CASE WHEN first_day > DATE '2024-01-02' OR last_day < DATE '2024-02-02' THEN 'out_of_range' WHEN n < 32 THEN 'gaps' ELSE 'ok' END AS status,
        32 - n AS n_missing FROM a""",
    ),
)
def published_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage of the published field from the statistics of its units; no field is read."""
    days = published.unit_days(published.pointers(spark, _publish_twice(spark, sf_dir)), ["source", "var"])
    period = (D(2024, 1, 2), D(2024, 2, 2), ["source", "var"])
    report = coverage.coverage_report(days, *period)
    missing = coverage.missing_days(days, *period).groupBy("source", "var").agg(F.count(F.lit(1)).alias("n_missing"))
    return report.join(missing, ["source", "var"], "left").withColumn("n_missing", F.coalesce("n_missing", F.lit(0).cast("long")))


@query(
    "file_inventory",
    with_views(
        "grid_obs",
        """SELECT rule, true AS exists, ok, stale, NOT ok OR stale AS fetch, (SELECT count(*) FROM grid_obs) AS n_rows
        FROM (VALUES ('fresh', true, false), ('late', true, true), ('small', false, false)) v(rule, ok, stale)
        UNION ALL SELECT rule, false, false, false, true, 0 FROM (VALUES ('fresh'), ('late'), ('small')) v(rule)""",
    ),
)
def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of the landed field files and of one absent file under three rules, with the rows they hold."""
    path = _land(spark, sf_dir, "grid_obs")
    have = inventory.list_files(spark, path, "*.parquet")
    plain = inventory.plain_path(F.col("path"))
    wanted = have.select(plain.alias("path")).union(have.agg(F.concat(F.min(plain), F.lit(".absent")).alias("path")))
    early, late = (dt.datetime(year, 6, 1, tzinfo=dt.timezone.utc) for year in (2024, 2200))
    rules = {"fresh": (early, 1000), "late": (late, 1000), "small": (early, 1 << 40)}
    checks = [
        inventory.check_files(wanted, have, now, min_bytes=size, max_age_hours=24.0).withColumn("rule", F.lit(rule))
        for rule, (now, size) in rules.items()
    ]
    held = fields.read_glob(spark, path).groupBy(inventory.plain_path(F.col("file_path")).alias("path")).agg(F.count(F.lit(1)).alias("n"))
    return (
        reduce(DataFrame.unionByName, checks)
        .join(held, "path", "left")
        .groupBy("rule", "exists", "ok", "stale", "fetch")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))
    )


@query(
    "stored_units",
    with_views(
        "grid_obs",
        """SELECT DISTINCT concat('source=', source, '/var=', var, '/level=', level, '/year=', year(time), '/month=', month(time)) AS path,
        true AS has_rows, false AS pending FROM grid_obs""",
    ),
)
def stored_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The units of a stored field, as the listing names them; recorded in a ledger, none is pending."""
    path = _land(spark, sf_dir, "grid_obs")
    stored = inventory.list_units(spark, path)
    obs = views.grid_obs(spark, sf_dir)
    name = work.unit_path("primary", F.col("var"), F.col("level"), F.year("time"), F.month("time"))
    asked = obs.select(name.alias("name")).distinct().select(
        "name", F.create_map(F.lit("last_day"), F.lit("all")).alias("params"), F.array("name").alias("outputs")
    )
    status = ledger.unit_status(asked, ledger.record_runs(asked.withColumn("run_at", F.lit(1))), stored)
    return stored.join(status, F.col("path") == F.col("name")).select("path", (F.col("n_bytes") > 0).alias("has_rows"), "pending")


# --- projections, filters, predicates -------------------------------------------


@query(
    "wrap_longitude",
    with_views("grid_obs", f"SELECT {instant('time')} AS time, lat, lon AS lon_in, {r(WRAP)} AS lon, {r('value')} AS value FROM grid_obs"),
)
def wrap_longitude(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = views.grid_obs(spark, sf_dir).withColumn("lon_in", F.col("lon"))
    return cleaning.wrap_longitudes(obs).select("time", "lat", "lon_in", "lon", "value")


@query("canonical_names", with_views("grid_obs", f"SELECT {instant('time')} AS time, lat, lon, {r('value')} AS value FROM grid_obs"))
def canonical_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = views.grid_obs(spark, sf_dir).select(
        F.col("time").alias("valid_time"), F.col("lat").alias("Latitude"), F.col("lon").alias("LONGITUDE"), "value"
    )
    return cleaning.canonical_names(raw)


@query("pick_variable", with_views("grid_obs", f"SELECT {instant('time')} AS time, lat, lon, {r('value')} AS value FROM grid_obs"))
def pick_variable(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = views.grid_obs(spark, sf_dir).select(
        "time", F.lit(0).alias("number"), "lat", "lon", F.lit("0001").alias("expver"), F.col("value").alias("z"), F.lit(1.0).alias("other")
    )
    return cleaning.pick_variable(wide)


@query(
    "squeeze_level",
    with_views(
        "multi_level",
        f"""SELECT s.var, {instant('time')} AS time, lat, lon, {r('arg_min(value * s.f, level_order)')} AS value
        FROM multi_level, (VALUES ('u', 1.0::DOUBLE), ('v', 2.0::DOUBLE)) s(var, f) GROUP BY s.var, multi_level.time, lat, lon""",
    ),
)
def squeeze_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two variables on three levels each."""
    names = F.array(*[F.struct(F.lit(v).alias("var"), F.lit(f).alias("f")) for v, f in (("u", 1.0), ("v", 2.0))])
    df = views.multi_level(spark, sf_dir).withColumn("s", F.explode(names))
    df = df.withColumns({"var": F.col("s.var"), "value": F.col("value") * F.col("s.f")}).drop("s")
    return cleaning.squeeze_level(df, "level_order").select("var", "time", "lat", "lon", "value")


@query(
    "time_slice",
    with_views(
        "grid_obs",
        f"""SELECT {instant('time')} AS time, lat, lon, {r('value')} AS value FROM grid_obs
        WHERE CAST(time AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'""",
    ),
)
def time_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaning.time_slice(views.grid_obs(spark, sf_dir), D(2024, 1, 10), D(2024, 1, 12))
    return rows.select("time", "lat", "lon", "value")


@query(
    "bounding_box",
    with_views(
        "grid_obs",
        f"""WITH w AS (SELECT * REPLACE ({WRAP} AS lon) FROM grid_obs)
        SELECT 'sample' AS area, {instant('time')} AS time, lat, {r('lon')} AS lon, {r('value')} AS value FROM w
        WHERE lat BETWEEN -40 AND 10 AND lon BETWEEN -80 AND 15
        UNION ALL
        SELECT 'pacific', {instant('time')}, lat, {r('lon')}, {r('value')} FROM w
        WHERE lat BETWEEN -10 AND 10 AND (lon >= 150 OR lon <= -120)""",
    ),
)
def bounding_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaning.wrap_longitudes(views.grid_obs(spark, sf_dir))
    parts = {"sample": tables.SAMPLE_AREA, "pacific": (10.0, 150.0, -10.0, -120.0)}
    out = [
        cleaning.bounding_box(rows, area).select(F.lit(name).alias("area"), "time", "lat", "lon", "value")
        for name, area in parts.items()
    ]
    return out[0].unionByName(out[1])


@query(
    "synoptic_hours",
    f"""SELECT event_id, {instant('ts')} AS ts, {r('value')} AS value FROM events
    WHERE hour(ts) IN (0, 6, 12, 18) AND minute(ts) = 0""",
)
def synoptic_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events").select("event_id", "ts", "value")
    return cleaning.at_hours(events, [18, 6, 0, 12, 6], col="ts")


@query(
    "null_missing",
    with_views(
        "grid_missing",
        f"""SELECT {instant('time')} AS time, lat, lon,
        {r('CASE WHEN isnan(value) OR value = -9999 OR abs(value) > 5000 THEN NULL ELSE value END')} AS value FROM grid_missing""",
    ),
)
def null_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaning.null_missing(views.grid_missing(spark, sf_dir), fills=[-9999.0], limit=5000.0)
    return rows.select("time", "lat", "lon", "value")


@query(
    "convert_units",
    with_views(
        "raw_fields registry",
        f"""SELECT source, var, unit, record, {instant('time')} AS time,
        {r("CASE WHEN source = 'primary' THEN value * factor ELSE value END")} AS value FROM raw_fields JOIN registry USING (var_key)""",
    ),
)
def convert_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaning.convert_units(cleaning.resolve_variables(views.raw_fields(spark, sf_dir)))
    return rows.select("source", "var", "unit", "record", "time", "value")


@query(
    "sort_field",
    with_views("grid_obs", f"SELECT {instant('time')} AS time, lat, {r(WRAP)} AS lon, {r('value')} AS value FROM grid_obs ORDER BY 1, 2, 3"),
)
def sort_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaning.wrap_longitudes(views.grid_obs(spark, sf_dir)).select("time", "lat", "lon", "value")
    return cleaning.sort_field(rows)


# --- scalar functions -----------------------------------------------------------


@query(
    "wind_speed_direction",
    with_views(
        "wind_uv",
        f"""SELECT {instant('time')} AS time, lat, lon, {r('sqrt(u * u + v * v)')} AS speed,
        {r('CASE WHEN u = 0 AND v = 0 THEN NULL ELSE ((degrees(atan2(u, v)) + 180) % 360 + 360) % 360 END')} AS direction FROM wind_uv""",
    ),
)
def wind_speed_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    u, v = F.col("u"), F.col("v")
    return views.wind_uv(spark, sf_dir).select(
        "time", "lat", "lon", scalars.wind_speed(u, v).alias("speed"), scalars.wind_direction(u, v).alias("direction")
    )


@query(
    "pressure_and_clock",
    f"""SELECT event_id, {r('value / 100')} AS hpa, {instant('ts - INTERVAL 3 HOUR')} AS local_time FROM events""",
)
def pressure_and_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "events").select(
        "event_id", scalars.pa_to_hpa(F.col("value")).alias("hpa"), scalars.local_clock(F.col("ts")).alias("local_time")
    )


_AREA_SQL = """lower(p_type) || '_' || replace(p_name, ' ', '_') || '_3d_' || ['zcit', 'nao', 'o''higgins', 'x9y', 'MJO'][1 + p_partkey % 5]"""


@query(
    "area_names",
    f"""WITH a AS (SELECT p_partkey, {_AREA_SQL} AS area FROM part)
    SELECT p_partkey, area, list_aggregate(list_transform(string_split(area, '_'), lambda w:
      CASE WHEN lower(w) IN ({', '.join(f"'{a}'" for a in tables.ACRONYMS)}) THEN upper(w)
      ELSE list_aggregate(list_transform(string_split(w, ''), lambda c, i:
        CASE WHEN i > 1 AND regexp_matches(w[i - 1], '[a-zA-Z]') THEN lower(c) ELSE upper(c) END), 'string_agg', '') END),
      'string_agg', ' ') AS display_name FROM a""",
)
def area_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    tail = views.choose(F.col("p_partkey") % 5, ("zcit", "nao", "o'higgins", "x9y", "MJO"))
    area = F.concat_ws("_", F.lower("p_type"), F.translate("p_name", " ", "_"), F.lit("3d"), tail)
    return views.table(spark, sf_dir, "part").select(
        "p_partkey", area.alias("area"), scalars.area_display_name(area).alias("display_name")
    )


_NO_DATA_SQL = " OR ".join(f"contains(lower(message), '{t}')" for t in tables.NO_DATA_TEXTS)


@query(
    "source_messages",
    with_views(
        "messages",
        f"""SELECT event_id, ({_NO_DATA_SQL}) AS no_data_yet,
        {day(f"try_cast(nullif(regexp_extract(message, '{tables.LATEST_DATE_PATTERN}', 1), '') AS DATE)")} AS latest_date FROM messages""",
    ),
)
def source_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("message")
    return views.messages(spark, sf_dir).select(
        "event_id", scalars.says_no_data_yet(m).alias("no_data_yet"), scalars.latest_date_in(m).alias("latest_date")
    )


@query(
    "variable_lookup",
    with_views(
        "requests registry",
        f"""SELECT request, var_key, r.var, r.unit, CASE WHEN r.var IS NULL THEN 'unknown variable ''' || var_key || '''; known: ' ||
        (SELECT string_agg(var_key, ', ' ORDER BY var_key) FROM registry) END AS reject
        FROM requests q LEFT JOIN registry r USING (var_key)""",
    ),
)
def variable_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaning.resolve_variables(views.requests(spark, sf_dir), on_unknown="reject")
    return rows.select("request", "var_key", "var", "unit", "reject")


def _url_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    area = F.col("request") % 2 == 0
    return views.requests(spark, sf_dir).select(
        "request",
        "var_key",
        "level",
        F.col("start_date").alias("day"),
        *[F.when(area, F.lit(x)).alias(n) for n, x in zip(("north", "west", "south", "east"), tables.SAMPLE_AREA)],
    )


@query(
    "request_urls",
    with_views(
        "requests registry",
        f"""SELECT request, {big('h.hour')} AS hour, '{tables.FILTER_URL}?file=gdas.t' || lpad(h.hour::VARCHAR, 2, '0') || 'z.pgrb2.0p25.f000&' ||
        replace(replace(CASE WHEN needs_level THEN replace(level_key, '{{nivel}}', level::VARCHAR) ELSE level_key END, '(', '%28'), ')', '%29') || '=on&var_' || secondary_code || '=on&dir=%2Fgdas.' || strftime(start_date, '%Y%m%d') || '%2F' ||
        lpad(h.hour::VARCHAR, 2, '0') || '%2Fatmos' ||
        CASE WHEN request % 2 = 0 THEN '&subregion=on&toplat=10.0&leftlon=-80.0&bottomlat=-40.0&rightlon=15.0' ELSE '' END AS url,
        CASE WHEN r.var IS NULL THEN 'unknown variable' WHEN needs_level AND level IS NULL THEN 'no level' END AS reject
        FROM requests q LEFT JOIN registry r USING (var_key), (VALUES (0), (6), (12), (18)) h(hour)""",
    ),
)
def request_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request; those without an address say why."""
    return req.request_urls(_url_requests(spark, sf_dir), on_unknown="reject").select("request", "hour", "url", "reject")


_PAGE_URL_SQL = "replace(url, '/en/', '/thredds/fileServer/en/')"


@query(
    "ftp_urls",
    rf"""WITH p AS (SELECT page_id, {_PAGE_URL_SQL} AS url FROM pages),
    q AS (SELECT *, split_part(regexp_replace(url, '^[a-z]+://', ''), '/', 1) AS host,
      regexp_replace(regexp_replace(url, '^[a-z]+://[^/?#]*', ''), '[?#].*$', '') AS path FROM p)
    SELECT page_id, url, CASE WHEN contains(host, 'example.org') OR contains(host, 'example.net')
      THEN 'ftp://ftp.example.org' || replace(path, '/thredds/fileServer/', '/') ELSE url END AS ftp_url FROM q""",
)
def ftp_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.replace(F.col("url"), F.lit("/en/"), F.lit("/thredds/fileServer/en/"))
    ftp = scalars.to_ftp_url(F.col("url"), hosts=("example.org", "example.net"), ftp_host="ftp.example.org")
    pages = views.table(spark, sf_dir, "pages").select("page_id", url.alias("url"))
    return pages.select("page_id", "url", ftp.alias("ftp_url"))


# --- joins ----------------------------------------------------------------------


@query(
    "pending_units",
    """WITH u AS (SELECT 'u' || o_orderkey AS name, md5('{"priority": "' || o_orderpriority || '", "status": "' || o_orderstatus || '"}') AS params_hash,
      o_custkey, o_orderkey, o_orderstatus, o_orderpriority FROM orders),
    runs AS (SELECT name, CASE WHEN o_custkey % 5 = 0 THEN md5('{"priority": "changed", "status": "' || o_orderstatus || '"}') ELSE params_hash END AS h
      FROM u WHERE o_orderstatus <> 'P'),
    inv AS (SELECT 'out/c' || c_custkey || '/' || k AS path FROM customer, (VALUES (1), (2), (3)) t(k) WHERE NOT (k = 3 AND c_acctbal < 0)),
    outs AS (SELECT name, 'out/c' || o_custkey || '/' || k AS path FROM u, (VALUES (1), (2), (3)) t(k) WHERE k <= 1 + o_orderkey % 3)
    SELECT name, params_hash FROM u WHERE NOT (
      EXISTS (SELECT 1 FROM runs WHERE runs.name = u.name AND runs.h = u.params_hash)
      AND NOT EXISTS (SELECT 1 FROM outs WHERE outs.name = u.name AND outs.path NOT IN (SELECT path FROM inv)))""",
)
def pending_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = views.table(spark, sf_dir, "orders")
    name = F.concat(F.lit("u"), F.col("o_orderkey"))
    stem = F.concat(F.lit("out/c"), F.col("o_custkey"), F.lit("/"))

    def params(priority: Column, status: Column | None = None) -> Column:
        return F.create_map(F.lit("status"), F.col("o_orderstatus") if status is None else status, F.lit("priority"), priority)

    priority = F.col("o_orderpriority")
    outputs = F.transform(F.sequence(F.lit(1), 1 + F.col("o_orderkey") % 3), lambda k: F.concat(stem, k))
    requested = orders.select(name.alias("name"), params(priority).alias("params"), outputs.alias("outputs"))
    ran = orders.where(F.col("o_orderstatus") != "P")
    last = ran.select(
        name.alias("name"),
        params(F.when(F.col("o_custkey") % 5 == 0, F.lit("changed")).otherwise(priority)).alias("params"),
        outputs.alias("outputs"),
        F.col("o_orderdate").alias("run_at"),
    )
    old = F.lit("old")
    older = last.withColumns({"params": params(old, old), "run_at": F.col("run_at") - F.expr("interval 10 days")})
    runs = ledger.record_runs(last.unionByName(older))
    customer = views.table(spark, sf_dir, "customer")
    paths = customer.select(F.explode(F.sequence(F.lit(1), F.lit(3))).alias("k"), "c_custkey", "c_acctbal").where(
        ~((F.col("k") == 3) & (F.col("c_acctbal") < 0))
    )
    have = paths.select(F.concat(F.lit("out/c"), F.col("c_custkey"), F.lit("/"), F.col("k")).alias("path"))
    return ledger.pending_units(requested, runs, have)


@query(
    "request_validation",
    with_views(
        "requests registry",
        """SELECT request, CASE WHEN r.var IS NULL THEN 'unknown variable' WHEN r.needs_level AND level IS NULL THEN 'level required'
        WHEN NOT r.needs_level AND level IS NOT NULL THEN 'level not accepted' WHEN end_date < start_date THEN 'end before start' END AS reason
        FROM requests LEFT JOIN registry r USING (var_key)""",
    ),
)
def request_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return req.validate_requests(views.requests(spark, sf_dir)).select("request", "reason")


def _rules_sql() -> str:
    rows = ", ".join(
        f"({k}, '{cls}', {'NULL' if part is None else repr(part)}, '{hint}')"
        for k, (cls, part, hint) in enumerate(tables.ERROR_RULES)
    )
    tree = ", ".join(f"('{child}', '{parent}')" for child, parent in tables.CLASS_PARENTS.items())
    return f"""WITH RECURSIVE rules(no, cls, part, hint) AS (VALUES {rows}), parent(child, cls) AS (VALUES {tree}),
    up(name, cls) AS (SELECT DISTINCT error_type, unnest([error_type, 'Exception']) FROM messages
      UNION SELECT u.name, p.cls FROM up u JOIN parent p ON p.child = u.cls)
    SELECT m.event_id, m.error_type, arg_min(r.hint, r.no) AS hint FROM messages m
    LEFT JOIN (up u JOIN rules r ON r.cls = u.cls) ON u.name = m.error_type AND (r.part IS NULL OR contains(m.error_text, r.part))
    GROUP BY m.event_id, m.error_type"""


@query("error_hints", with_views("messages", _rules_sql()))
def error_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = messages.classify_messages(views.messages(spark, sf_dir), message="error_text")
    return rows.select("event_id", "error_type", "hint")


# --- aggregations ---------------------------------------------------------------


@query(
    "covers_period",
    with_views(
        "grid_obs",
        """SELECT lat, lon, CAST(min(time) AS DATE) <= DATE '2024-01-01' AND CAST(max(time) AS DATE) >= DATE '2024-01-29' AS covers FROM grid_obs GROUP BY lat, lon""",
    ),
)
def covers_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.covers_period(views.grid_obs(spark, sf_dir), D(2024, 1, 1), D(2024, 1, 29), ["lat", "lon"])


@query(
    "coverage_report",
    with_views(
        "grid_obs",
        f"""WITH d AS (SELECT DISTINCT lat, lon, CAST(time AS DATE) AS d FROM grid_obs),
        a AS (SELECT lat, lon, min(d) AS first_day, max(d) AS last_day, count(*) FILTER (d BETWEEN DATE '2024-01-02' AND DATE '2024-01-29') AS n FROM d GROUP BY ALL)
        SELECT lat, lon, {day('first_day')} AS first_day, {day('last_day')} AS last_day, n AS days_present, {big('28')} AS days_expected,
        CASE WHEN first_day > DATE '2024-01-02' OR last_day < DATE '2024-01-29' THEN 'out_of_range' WHEN n < 28 THEN 'gaps' ELSE 'ok' END AS status FROM a""",
    ),
)
def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.coverage_report(views.grid_obs(spark, sf_dir), D(2024, 1, 2), D(2024, 1, 29), ["lat", "lon"])


@query(
    "missing_days",
    with_views(
        "grid_obs",
        f"""SELECT lat, lon, {day('d')} AS day FROM (SELECT DISTINCT lat, lon FROM grid_obs), (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-02-03', INTERVAL 1 DAY)) AS DATE) AS d)
        WHERE (lat, lon, d) NOT IN (SELECT (lat, lon, CAST(time AS DATE)) FROM grid_obs)""",
    ),
)
def missing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage.missing_days(views.grid_obs(spark, sf_dir), D(2024, 1, 1), D(2024, 2, 3), ["lat", "lon"])


#: Two variables, one of them without a level beside one with, on together three levels.
_SERIES = (("z", None, 0.0), ("z", 500, 1.0), ("t", 500, 2.0), ("t", 850, 4.0))
_SERIES_SQL = "(VALUES ('z', NULL, 0.0::DOUBLE), ('z', 500, 1.0::DOUBLE), ('t', 500, 2.0::DOUBLE), ('t', 850, 4.0::DOUBLE)) s(var, level, shift)"


def _many_series(df: DataFrame) -> DataFrame:
    """The field as four series that differ in their values."""
    series = [F.struct(F.lit(v).alias("var"), F.lit(p).cast("int").alias("level"), F.lit(x).alias("shift")) for v, p, x in _SERIES]
    wide = df.drop("var", "level").withColumn("s", F.explode(F.array(*series)))
    return wide.withColumns({"var": F.col("s.var"), "level": F.col("s.level"), "value": F.col("value") + F.col("s.shift")}).drop("s")


@query(
    "daily_mean",
    with_views(
        "grid_obs",
        f"""SELECT source, s.var, {big('s.level')} AS level, lat, lon, {day('time')} AS date, {r('avg(value + s.shift)')} AS value, count(value) AS n_steps
        FROM grid_obs, {_SERIES_SQL} GROUP BY source, s.var, s.level, lat, lon, {day('time')}""",
    ),
)
def daily_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.daily_mean(_many_series(views.grid_obs(spark, sf_dir)))


@query(
    "period_mean",
    with_views(
        "grid_obs",
        f"""SELECT lat, lon, {r('avg(value)')} AS value, count(value) AS n_steps FROM grid_obs
        WHERE time >= DATE '2024-01-04' AND time < DATE '2024-01-26' GROUP BY lat, lon""",
    ),
)
def period_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.period_mean(views.grid_obs(spark, sf_dir), D(2024, 1, 4), D(2024, 1, 25), ["lat", "lon"])


@query(
    "missing_longitudes",
    with_views(
        "grid_missing",
        f"""WITH g AS (SELECT source, s.var, s.level, lon, isnan(value) OR value = -9999 AS gap FROM grid_missing, {_SERIES_SQL} WHERE lon <> 240),
        n AS (SELECT source, var, level, lon, count(*) FILTER (gap) AS n_missing, count(*) AS n_rows FROM g GROUP BY ALL),
        c AS (SELECT DISTINCT source, var, level, unnest([150, 180, 210, 240])::DOUBLE AS lon FROM g)
        SELECT c.source, c.var, {big('c.level')} AS level, {r('((c.lon + 180) % 360) - 180')} AS lon, {big('coalesce(n_missing, 0)')} AS n_missing,
        {big('coalesce(n_rows, 0)')} AS n_rows FROM c LEFT JOIN n ON n.source = c.source AND n.var = c.var AND n.level IS NOT DISTINCT FROM c.level AND n.lon = c.lon
        WHERE n_rows IS NULL OR n_missing > 0""",
    ),
)
def missing_longitudes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four series in canonical longitudes, with a window over the date line and one column that is not there at all."""
    rows = cleaning.null_missing(views.grid_missing(spark, sf_dir).where("lon <> 240"), fills=[-9999.0])
    found = coverage.missing_longitudes(cleaning.wrap_longitudes(_many_series(rows)), 150.0, 240.0, views.GRID)
    return found.withColumn("lon", scalars.wrap_longitude(F.col("lon")))


# --- set operations and source combination --------------------------------------


@query(
    "concat_steps",
    with_views("grid_obs", f"SELECT {instant('time')} AS time, lat, lon, {r('value')} AS value FROM grid_obs"),
)
def concat_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = views.grid_obs(spark, sf_dir).select("time", "lat", "lon", "value")
    parts = [cleaning.at_hours(obs, [h]) for h in tables.DEFAULT_HOURS]
    return cleaning.sort_field(combine.concat_steps(parts))


# three variables by latitude; the primary source ends at a different day in each
_SPLICE_VAR_SQL = "CASE WHEN lat < 0 THEN 'hgt' WHEN lat > 0 THEN 'tmp' ELSE 'rh' END"


def _splice_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lat = F.col("lat")
    var = F.when(lat < 0, "hgt").when(lat > 0, "tmp").otherwise("rh")
    primary = views.grid_obs(spark, sf_dir).withColumn("var", var)
    ends = F.when(F.col("var") == "hgt", "2024-01-21").when(F.col("var") == "tmp", "2024-01-15").otherwise("2000-01-01")
    primary = primary.where(F.col("time") < ends.cast("timestamp_ntz"))
    return primary, views.grid_alt(spark, sf_dir).withColumn("var", var)


@query(
    "splice_sources",
    with_views(
        "grid_obs grid_alt",
        f"""WITH a AS (SELECT * REPLACE ({_SPLICE_VAR_SQL} AS var) FROM grid_obs), b AS (SELECT * REPLACE ({_SPLICE_VAR_SQL} AS var) FROM grid_alt),
        p AS (SELECT * FROM a WHERE (var = 'hgt' AND time < DATE '2024-01-21') OR (var = 'tmp' AND time < DATE '2024-01-15')),
        c AS (SELECT v.var, v.last_day FROM (VALUES ('hgt', DATE '2024-01-22'), ('tmp', DATE '2024-01-14'), ('rh', DATE '1900-01-01')) v(var, last_day))
        SELECT source, var, {instant('time')} AS time, lat, lon, {r('value')} AS value FROM p WHERE time >= DATE '2024-01-03'
        UNION ALL SELECT source, b.var, {instant('time')}, lat, lon, {r('value')} FROM b JOIN c USING (var)
        WHERE CAST(time AS DATE) > c.last_day AND time >= DATE '2024-01-03' AND time < DATE '2024-01-28'""",
    ),
)
def splice_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    primary, secondary = _splice_inputs(spark, sf_dir)
    # hgt: last day unknown, so today - 8; tmp: known; rh: the primary source does not have it
    last = literal_table(spark, [("hgt", None), ("tmp", "2024-01-14")], "var string, last_day string")
    last = last.withColumn("last_day", F.col("last_day").cast("date"))
    rows = combine.splice_sources(primary, secondary, D(2024, 1, 3), D(2024, 1, 27), D(2024, 1, 30), ["var"], last_days=last)
    return rows.select("source", "var", "time", "lat", "lon", "value")


@query(
    "observed_period",
    with_views(
        "grid_obs grid_alt",
        f"""WITH a AS (SELECT * REPLACE ({_SPLICE_VAR_SQL} AS var) FROM grid_obs), b AS (SELECT * REPLACE ({_SPLICE_VAR_SQL} AS var) FROM grid_alt),
        p AS (SELECT * FROM a WHERE (var = 'hgt' AND time < DATE '2024-01-21') OR (var = 'tmp' AND time < DATE '2024-01-15')),
        c AS (SELECT v.var, coalesce(max(CAST(p.time AS DATE)), DATE '1900-01-01') AS last_day FROM (VALUES ('hgt'), ('tmp'), ('rh')) v(var) LEFT JOIN p USING (var) GROUP BY v.var),
        u AS (SELECT source, var, time, lat, lon, value FROM p WHERE time >= DATE '2024-01-10'
          UNION ALL SELECT source, b.var, time, lat, lon, value FROM b JOIN c USING (var) WHERE CAST(time AS DATE) > c.last_day AND time >= DATE '2024-01-10' AND time < DATE '2024-01-30'),
        w AS (SELECT * REPLACE ({WRAP} AS lon) FROM u WHERE hour(time) IN (0, 12))
        SELECT source, var, {instant('time')} AS time, lat, {r('lon')} AS lon, {r('value')} AS value FROM w WHERE lat BETWEEN -40 AND 10 AND lon BETWEEN -80 AND 15""",
    ),
)
def observed_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    primary, secondary = _splice_inputs(spark, sf_dir)
    rows = observed.observed_period(
        primary, secondary, D(2024, 1, 10), D(2024, 1, 29), D(2024, 1, 30), hours=[0, 12], area=tables.SAMPLE_AREA
    )
    return rows.select("source", "var", "time", "lat", "lon", "value")


# --- calendar planning, grid and anomaly ----------------------------------------


@query(
    "month_units",
    with_views(
        "requests",
        f"""WITH m AS (SELECT request, end_date, CAST(unnest(generate_series(date_trunc('month', start_date), end_date, INTERVAL 1 MONTH)) AS DATE) AS f
        FROM requests WHERE end_date >= start_date)
        SELECT request, {day('f')} AS first_day, {day('least(last_day(f), end_date)')} AS last_day, {big('year(f)')} AS year, {big('month(f)')} AS month FROM m""",
    ),
)
def month_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return req.month_units(views.requests(spark, sf_dir)).select("request", "first_day", "last_day", "year", "month")


@query(
    "day_units",
    with_views(
        "requests",
        f"""SELECT request, {day('d')} AS day FROM (SELECT request, unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS d
        FROM requests WHERE end_date >= start_date)""",
    ),
)
def day_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return req.day_units(views.requests(spark, sf_dir)).select("request", "day")


TARGET_LATS = [-25.0, -20.0, -12.5, -3.0, 0.0, 4.0, 17.5, 20.0]
TARGET_LONS = [x * 12.5 for x in range(29)]


@query(
    "regrid_bilinear",
    with_views(
        "grid_obs",
        f"""WITH t AS (SELECT y, x, least(CAST(floor((y + 20) / 10) AS INTEGER), 3) AS j0, CAST(floor(x / 30) AS INTEGER) % 12 AS i0
          FROM (SELECT unnest([{', '.join(f'{v}::DOUBLE' for v in TARGET_LATS)}]) AS y), (SELECT unnest([{', '.join(f'{v}::DOUBLE' for v in TARGET_LONS)}]) AS x)
          WHERE y BETWEEN -20 AND 20),
        w AS (SELECT *, (y + 20) / 10 - j0 AS fy, x / 30 - i0 AS fx FROM t),
        g AS (SELECT time, CAST((lat + 20) / 10 AS INTEGER) AS j, CAST(lon / 30 AS INTEGER) AS i, value FROM grid_obs)
        SELECT {instant('a.time')} AS time, y AS lat, x AS lon,
        {r('(1 - fy) * ((1 - fx) * a.value + fx * b.value) + fy * ((1 - fx) * c.value + fx * d.value)')} AS value
        FROM w JOIN g a ON a.j = j0 AND a.i = i0
        JOIN g b ON b.time = a.time AND b.j = j0 AND b.i = (i0 + 1) % 12
        JOIN g c ON c.time = a.time AND c.j = j0 + 1 AND c.i = i0
        JOIN g d ON d.time = a.time AND d.j = j0 + 1 AND d.i = (i0 + 1) % 12""",
    ),
)
def regrid_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.regrid_bilinear(views.grid_obs(spark, sf_dir), views.GRID, TARGET_LATS, TARGET_LONS, ["time"])


@query(
    "interpolate_at_points",
    with_views(
        "grid_daily",
        f"""WITH p AS (SELECT c_custkey, c_acctbal / 9.80665::DOUBLE AS x, (c_custkey % 401) / 9.0::DOUBLE - 21 AS y FROM customer),
        t AS (SELECT *, (x / 30 % 12 + 12) % 12 AS px, (y + 20) / 10 AS py FROM p WHERE y BETWEEN -20 AND 20),
        w AS (SELECT *, CAST(floor(px) AS INTEGER) AS i0, least(CAST(floor(py) AS INTEGER), 3) AS j0 FROM t),
        g AS (SELECT date, CAST((lat + 20) / 10 AS INTEGER) AS j, CAST(lon / 30 AS INTEGER) AS i, value FROM grid_daily)
        SELECT c_custkey, {day('a.date')} AS date, {r('y')} AS lat, {r('x')} AS lon,
        {r('(1 - (py - j0)) * ((1 - (px - i0)) * a.value + (px - i0) * b.value) + (py - j0) * ((1 - (px - i0)) * c.value + (px - i0) * d.value)')} AS value
        FROM w JOIN g a ON a.j = j0 AND a.i = i0 JOIN g b ON b.date = a.date AND b.j = j0 AND b.i = (i0 + 1) % 12
        JOIN g c ON c.date = a.date AND c.j = j0 + 1 AND c.i = i0 JOIN g d ON d.date = a.date AND d.j = j0 + 1 AND d.i = (i0 + 1) % 12""",
    ),
)
def interpolate_at_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily field at one point per customer."""
    points = views.table(spark, sf_dir, "customer").select(
        "c_custkey",
        ((F.col("c_custkey") % 401) / F.lit(9.0) - 21.0).alias("lat"),
        (F.col("c_acctbal") / views.G).alias("lon"),
    )
    return neighbours.interpolate_at_points(views.grid_daily(spark, sf_dir), views.GRID, points, "c_custkey", ("date",))


_KEY_SQL = "CASE WHEN month(date) = 2 AND day(date) = 29 THEN 228 ELSE month(date) * 100 + day(date) END"


@query(
    "anomaly",
    with_views(
        "daily_series",
        f"""WITH c AS (SELECT var, {_KEY_SQL} AS k, avg(value) AS clim FROM daily_series WHERE date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' GROUP BY ALL)
        SELECT s.var, {day('s.date')} AS date, {r('s.value')} AS value, {r('c.clim')} AS clim, {r('s.value - c.clim')} AS anomaly
        FROM daily_series s LEFT JOIN c ON c.var = s.var AND c.k = {_KEY_SQL.replace('date', 's.date')}""",
    ),
)
def anomaly(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = views.daily_series(spark, sf_dir)
    clim = climatology.daily_climatology(series, D(1996, 1, 1), D(1999, 12, 31), ["var"])
    return climatology.anomaly(series, materialise(clim, "climatology"), ["var"])


# --- items ----------------------------------------------------------------------


def _user_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    bought = F.col("event_type") == "purchase"
    return (
        views.table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(
            (F.sum(F.round(F.col("value") * 100).cast("bigint")) / 981.0).alias("total"),
            F.count_if(bought & (F.col("value") > 60)).alias("n_large"),
        )
    )


def _ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total per large purchase; users without one make the user function fail."""

    def per_large(item: dict) -> dict:  # local, so it travels to the workers by value
        return {"ratio": item["total"] / item["n_large"] if item["n_large"] else 1 // 0}

    result = T.StructType([T.StructField("ratio", T.DoubleType())])
    return items.map_items(_user_items(spark, sf_dir), per_large, "user_id", result)


_ITEM_SQL = """u AS (SELECT user_id, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / 981.0::DOUBLE AS total,
  count(*) FILTER (event_type = 'purchase' AND value > 60) AS n FROM events GROUP BY user_id)"""


@query(
    "map_items",
    f"""WITH {_ITEM_SQL} SELECT user_id, {r('CASE WHEN n > 0 THEN total / n END')} AS ratio, n > 0 AS ok,
    CASE WHEN n = 0 THEN 'ZeroDivisionError' END AS error_type, n = 0 AS has_traceback FROM u""",
)
def map_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ratios(spark, sf_dir).select(
        "user_id", "ratio", "ok", "error_type", F.coalesce(F.contains("traceback", F.lit("ZeroDivisionError")), F.lit(False)).alias("has_traceback")
    )


@query(
    "map_groups",
    f"""WITH u AS (SELECT user_id, count(*) AS n, max(value) AS peak, sum(CAST(round(value * 100) AS BIGINT)) AS cents,
      count(*) FILTER (event_type = 'error' AND value > 95) AS n_bad FROM events GROUP BY user_id)
    SELECT user_id, CASE WHEN n_bad = 0 THEN n END AS n_events, {r('CASE WHEN n_bad = 0 THEN peak END')} AS peak,
    {big('CASE WHEN n_bad = 0 THEN cents END')} AS cents, n_bad = 0 AS ok, CASE WHEN n_bad > 0 THEN 'ValueError' END AS error_type FROM u""",
)
def map_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of each user's events, batch by batch; users with a large error fail, the others go on."""

    def totals(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        n, peak, cents = 0, None, 0
        for batch in batches:
            value, kind = batch.column("value"), batch.column("event_type")
            if pc.any(pc.and_(pc.equal(kind, "error"), pc.greater(value, 95.0))).as_py():
                raise ValueError(f"user {key[0]}: error out of range")
            n += batch.num_rows
            top = pc.max(value).as_py()
            peak = top if peak is None else max(peak, top)
            cents += pc.sum(pc.cast(pc.round(pc.multiply(value, 100.0)), pa.int64())).as_py()
        yield {"n_events": n, "peak": peak, "cents": cents}

    result = T.StructType([T.StructField(c, k) for c, k in (("n_events", T.LongType()), ("peak", T.DoubleType()), ("cents", T.LongType()))])
    rows = views.table(spark, sf_dir, "events").select("user_id", "event_type", "value")
    return items.map_groups(rows, totals, ["user_id"], result).drop("error_msg", "traceback")


@query(
    "outcome_summary",
    f"""WITH {_ITEM_SQL} SELECT count(*) FILTER (n > 0) AS n_ok, count(*) FILTER (n = 0) AS n_failed, count(*) AS n_total FROM u""",
)
def outcome_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items.outcome_summary(_ratios(spark, sf_dir))


@query(
    "map_items_strict",
    with_views(
        "grid_obs",
        f"""SELECT {big('dayofyear(time) * 1000 + lon')} AS job, {big('count(DISTINCT hour(time))')} AS n_steps,
        CAST(max(hour(time)) - min(hour(time)) AS DOUBLE) AS span FROM grid_obs GROUP BY 1 HAVING count(DISTINCT hour(time)) > 1""",
    ),
)
def map_items_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One job per day and longitude with its list of hours (24 at most)."""

    def day_span(job: dict) -> dict | None:
        steps = sorted(job["steps"])
        return {"n_steps": len(steps), "span": float(steps[-1] - steps[0])} if len(steps) > 1 else None

    jobs = (
        views.grid_obs(spark, sf_dir)
        .groupBy((F.dayofyear("time") * 1000 + F.col("lon")).cast("bigint").alias("job"))
        .agg(F.collect_set(F.hour("time")).alias("steps"))
    )
    result = T.StructType([T.StructField("n_steps", T.LongType()), T.StructField("span", T.DoubleType())])
    return items.map_items_strict(jobs, day_span, "job", result)


# --- the flows ------------------------------------------------------------------


@query(
    "mean_field_of_period",
    with_views(
        "grid_missing",
        f"""WITH c AS (SELECT CAST(time AS DATE) AS date, lat, {WRAP} AS lon, CASE WHEN isnan(value) OR value = -9999 THEN NULL ELSE value END AS value
          FROM grid_missing WHERE time >= DATE '2024-01-05' AND time < DATE '2024-01-25'),
        d AS (SELECT date, lat, lon, avg(value) AS value FROM c WHERE lat BETWEEN -40 AND 10 AND lon BETWEEN -80 AND 15 GROUP BY ALL)
        SELECT lat, {r('lon')} AS lon, {r('avg(value)')} AS value, count(value) AS n_steps FROM d GROUP BY d.lat, d.lon""",
    ),
)
def mean_field_of_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observed.mean_field(
        views.grid_missing(spark, sf_dir), D(2024, 1, 5), D(2024, 1, 24), tables.SAMPLE_AREA, fills=[-9999.0], cell=["lat", "lon"]
    )


@query(
    "mean_fields_of_areas",
    with_views(
        "grid_missing",
        f"""WITH c AS (SELECT CAST(time AS DATE) AS date, lat, {WRAP} AS lon, CASE WHEN isnan(value) OR value = -9999 THEN NULL ELSE value END AS value
          FROM grid_missing WHERE time >= DATE '2024-01-05' AND time < DATE '2024-01-25'),
        d AS (SELECT date, lat, lon, avg(value) AS value FROM c GROUP BY ALL),
        p AS (SELECT lat, lon, avg(value) AS value, count(value) AS n_steps FROM d GROUP BY lat, lon)
        SELECT 'west' AS area, lat, {r('lon')} AS lon, {r('value')} AS value, n_steps FROM p WHERE lat BETWEEN -40 AND 10 AND lon BETWEEN -80 AND 15
        UNION ALL SELECT 'date line', lat, {r('lon')}, {r('value')}, n_steps FROM p WHERE lat BETWEEN -10 AND 20 AND (lon >= 150 OR lon <= -120)
        UNION ALL SELECT 'tropics', lat, {r('lon')}, {r('value')}, n_steps FROM p WHERE lat BETWEEN -10 AND 10""",
    ),
)
def mean_fields_of_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping areas, one of them across the date line, in one pass."""
    areas = [("west", *tables.SAMPLE_AREA), ("date line", 20, 150, -10, -120), ("tropics", 10, -180, -10, 180)]
    rows = views.grid_missing(spark, sf_dir)
    return observed.mean_fields(rows, D(2024, 1, 5), D(2024, 1, 24), areas, fills=[-9999.0], cell=["lat", "lon"])


@query(
    "daily_anomaly_flow",
    with_views(
        "grid_obs grid_alt",
        f"""WITH ad AS (SELECT s.var, coalesce(s.level, -1) AS level, CAST(time AS DATE) AS date, lat, lon, avg(value + s.shift) AS value FROM grid_alt, {_SERIES_SQL} GROUP BY ALL),
        c AS (SELECT var, level, {_KEY_SQL} AS k, CAST((lat + 20) / 10 AS INTEGER) AS j, CAST(lon / 30 AS INTEGER) AS i, avg(value) AS clim FROM ad GROUP BY ALL),
        d AS (SELECT source, s.var, coalesce(s.level, -1) AS level, CAST(time AS DATE) AS date, lat, lon, avg(value + s.shift) AS value, count(value) AS n_steps FROM grid_obs, {_SERIES_SQL}
          WHERE time >= DATE '2024-01-03' AND time < DATE '2024-01-29' GROUP BY ALL),
        x AS (SELECT d.*, {_KEY_SQL} AS k, CAST((lat + 20) / 10 AS INTEGER) AS j, CAST(lon / 30 AS INTEGER) AS i FROM d),
        q AS (SELECT x.*, (SELECT count(*) FROM c WHERE c.var = x.var AND c.level = x.level AND c.k = x.k AND c.j IN (least(x.j, 3), least(x.j, 3) + 1) AND c.i IN (x.i, (x.i + 1) % 12)) AS corners,
          (SELECT any_value(clim) FROM c WHERE c.var = x.var AND c.level = x.level AND c.k = x.k AND c.j = x.j AND c.i = x.i) AS own FROM x)
        SELECT source, var, {big('nullif(level, -1)')} AS level, {day('date')} AS date, lat, lon, {r('value')} AS value, n_steps, {r('CASE WHEN corners = 4 THEN own END')} AS clim,
        {r('CASE WHEN corners = 4 THEN value - own END')} AS anomaly FROM q""",
    ),
)
def daily_anomaly_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage check, daily means, climatology of the other source on the same grid, difference; four series."""
    other = aggregate.daily_mean(_many_series(views.grid_alt(spark, sf_dir)))
    clim = climatology.daily_climatology(other, D(2024, 1, 1), D(2024, 12, 31), ["var", "level", "lat", "lon"])
    return observed.daily_anomaly(
        _many_series(views.grid_obs(spark, sf_dir)), clim, views.GRID, views.GRID, D(2024, 1, 3), D(2024, 1, 28)
    )


@query(
    "month_work",
    with_views(
        "requests registry",
        f"""WITH v AS (SELECT r.var, level, start_date, end_date FROM requests JOIN registry r USING (var_key)
          WHERE r.needs_level = (level IS NOT NULL) AND end_date >= start_date),
        m AS (SELECT var, level, end_date, CAST(unnest(generate_series(date_trunc('month', start_date), end_date, INTERVAL 1 MONTH)) AS DATE) AS f FROM v),
        u AS (SELECT 'source=primary/var=' || var || '/level=' || coalesce(level::VARCHAR, 'none') || '/year=' || year(f) || '/month=' || month(f) AS name,
          least(last_day(f), end_date) AS last_day FROM m)
        SELECT name, strftime(max(last_day), '%Y-%m-%d') AS last_day, name AS output FROM u GROUP BY name""",
    ),
)
def month_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = work.month_work(views.requests(spark, sf_dir))
    return units.select("name", F.col("params")["last_day"].alias("last_day"), F.col("outputs")[0].alias("output"))
