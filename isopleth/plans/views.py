"""Field views over the star-schema tables, in Spark and as SQL for the cross-check.

Means are formed from exact integer cents, so both engines start from the same
doubles; dividing by gravity keeps results off rounding ties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isopleth.functions import scalars
from isopleth.schema import Grid
from isopleth.sources import tables

GRID = Grid(lat0=-20.0, dlat=10.0, nlat=5, lon0=0.0, dlon=30.0, nlon=12)
G = tables.STANDARD_GRAVITY

LATS = {"click": -20.0, "error": -10.0, "purchase": 0.0, "signup": 10.0, "view": 20.0}

MESSAGES = (
    "Request failed: latest date available for this dataset is: 2024-03-17 18:00",
    "None of the data you have requested is available yet, please revise the period",
    "LATEST DATE AVAILABLE (UTC):\n 2024-02-29 00:00 and not later",
    "latest date available: 2024-13-45 06:00",
    "MultiAdapterNoDataError raised by the adaptor",
    "Connection reset by peer",
    "the latest date available is unknown",
)
ERROR_CLASSES = (
    "FileNotFoundError",
    "ConnectionError",
    "ConnectionRefusedError",
    "TimeoutError",
    "RuntimeError",
    "OSError",
    "ModuleNotFoundError",
    "ImportError",
    "ValueError",
)
ERROR_TEXTS = (
    "[Errno 2] No such file: a.nc",
    "No such file or directory: key.pem",
    "Arquivo obrigatorio ausente",
    "Falha na conexao SFTP 10.0.0.1",
    "HTTP 403 for KEY_CDS",
    "arquivo corrompido mesmo apos re-download",
    "arquivo corrompido",
    "Re-download falhou",
    "NetCDF: Unknown file format",
    "No module named jinja2",
    "Max retries exceeded with url",
    "something else",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cents(col: str) -> Column:
    return F.sum(F.round(F.col(col) * 100).cast("bigint")).cast("double")


def choose(index: Column, texts: tuple[str, ...]) -> Column:
    return F.lit(list(texts))[index.cast("int")]


def _lat() -> Column:
    case = None
    for name, lat in LATS.items():
        cond = F.col("event_type") == name
        case = F.when(cond, F.lit(lat)) if case is None else case.when(cond, F.lit(lat))
    return case


def _grid(events: DataFrame, source: str, lon_key: str, factor: float) -> DataFrame:
    return (
        events.select(
            scalars.floor_hours(F.col("ts"), 6).alias("time"),
            _lat().alias("lat"),
            ((F.col(lon_key) % 12) * 30.0).alias("lon"),
            "value",
        )
        .groupBy("time", "lat", "lon")
        .agg((_cents("value") * factor / (F.count(F.lit(1)) * F.lit(G))).alias("value"))
        .select(
            F.lit(source).alias("source"),
            F.lit("hgt").alias("var"),
            F.lit(500).alias("level"),
            "time",
            "lat",
            "lon",
            "value",
        )
    )


def grid_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Primary field: 6-hourly means on a 5 x 12 grid, longitudes 0-330."""
    return _grid(table(spark, sf_dir, "events"), "primary", "user_id", 1.0)


def grid_alt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secondary field: the same events placed by event number, ten per cent higher."""
    return _grid(table(spark, sf_dir, "events"), "secondary", "event_id", 1.1)


def grid_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        grid_obs(spark, sf_dir)
        .groupBy(F.to_date("time").alias("date"), "lat", "lon")
        .agg(F.avg("value").alias("value"))
    )


def grid_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Primary field with NaN and -9999 marks strewn in."""
    k = F.dayofmonth("time") * 4 + F.floor(F.hour("time") / 6) + (F.col("lon") / 30).cast("int")
    value = (
        F.when(k % 17 == 0, F.lit(float("nan"))).when(k % 19 == 0, F.lit(-9999.0)).otherwise(F.col("value"))
    )
    return grid_obs(spark, sf_dir).withColumn("value", value)


def multi_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Primary field repeated at three levels with their order of storage."""
    levels = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(p).alias("p")) for n, p in enumerate((850, 500, 250))])
    return (
        grid_obs(spark, sf_dir)
        .select("time", "lat", "lon", "value", F.explode(levels).alias("l"))
        .select(
            "time",
            "lat",
            "lon",
            F.col("l.n").alias("level_order"),
            F.col("l.p").alias("pressure_level"),
            (F.col("value") + F.col("l.p") / 1000.0).alias("value"),
        )
    )


def wind_uv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """u from the cell itself, v from its eastern neighbour, temperature from the raw value."""
    obs = grid_obs(spark, sf_dir).select("time", "lat", "lon", "value", GRID.i().alias("i"))
    east = obs.select("time", "lat", F.pmod(F.col("i") - 1, F.lit(12)).alias("i"), F.col("value").alias("e"))
    return obs.join(east, ["time", "lat", "i"]).select(
        "time",
        "lat",
        "lon",
        ((F.col("value") - 510.0) / 20.0).alias("u"),
        ((F.col("e") - 510.0) / 20.0).alias("v"),
        (F.col("value") / 10.0).alias("temp"),
    )


def raw_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw record per line item under one of the ten variable keys."""
    keys = tuple(r[0] for r in tables.VARIABLES)
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") % 2 == 0, "secondary").otherwise("primary").alias("source"),
        choose(F.col("l_partkey") % 10, keys).alias("var_key"),
        F.col("l_shipdate").alias("time"),
        F.col("l_orderkey").alias("record"),
        F.col("l_extendedprice").alias("value"),
    )


def mixed_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even days as geopotential, odd days as height."""
    even = F.dayofmonth("time") % 2 == 0
    value = F.when(even, F.col("value") * 20.0 * G).otherwise(F.col("value") * 20.0)
    return grid_obs(spark, sf_dir).select("time", "lat", "lon", value.alias("value"))


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One value per return flag and ship day."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_returnflag").alias("var"), F.to_date("l_shipdate").alias("date"))
        .agg((_cents("l_extendedprice") / (F.count(F.lit(1)) * F.lit(100.0 * G))).alias("value"))
    )


def anomaly_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily field minus 480, so that both signs occur; two series by hemisphere."""
    return grid_daily(spark, sf_dir).select(
        F.when(F.col("lat") < 0, "south").otherwise("north").alias("var"), "date", "lat", "lon", (F.col("value") - 480.0).alias("value")
    )


def long_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily field of several years on 4 x 3 southern cells, from line items."""
    return (
        table(spark, sf_dir, "lineitem")
        .select(
            F.to_date("l_shipdate").alias("date"),
            ((F.col("l_suppkey") % 4) * -15.0 - 25.0).alias("lat"),
            ((F.col("l_partkey") % 3) * 120.0 - 180.0).alias("lon"),
            "l_extendedprice",
        )
        .groupBy("date", "lat", "lon")
        .agg((_cents("l_extendedprice") / (F.count(F.lit(1)) * F.lit(100.0 * G))).alias("value"))
    )


def precip_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast runs: increments, code and flags per step, with totals since the start."""
    steps = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("run"), F.col("l_linenumber").alias("step"))
        .agg(
            F.sum("l_quantity").alias("increment"),
            F.min("l_partkey").alias("p"),
            F.min("l_suppkey").alias("s"),
        )
    )
    return steps.select(
        "run",
        "step",
        "increment",
        (1 + F.col("p") % 8).cast("int").alias("code"),
        *[(F.shiftright("s", b) % 2).cast("int").alias(n) for b, n in enumerate(("is_rain", "is_ice", "is_mixed", "is_snow"))],
    )


def fcst(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast archive with repeated records."""
    target = F.to_date("l_shipdate")
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("M"), (F.col("l_suppkey") % 3).cast("string")).alias("model"),
        F.date_sub(target, (F.col("l_orderkey") % 16).cast("int")).alias("init"),
        target.alias("target"),
        (F.col("l_extendedprice") / G).alias("value"),
        F.col("l_orderkey").alias("loaded_at"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests valid and invalid, one per order."""
    keys = tuple(r[0] for r in tables.VARIABLES) + ("ozonio",)
    start = F.to_date("o_orderdate")
    level = F.when(F.col("o_orderkey") % 4 < 2, F.lit(500)).when(F.col("o_orderkey") % 4 == 2, F.lit(850))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("request"),
        choose(F.col("o_custkey") % 11, keys).alias("var_key"),
        level.cast("int").alias("level"),
        start.alias("start_date"),
        F.date_add(start, (F.col("o_orderkey") % 70 - 5).cast("int")).alias("end_date"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        choose(F.col("event_id") % 7, MESSAGES).alias("message"),
        choose(F.col("event_id") % 9, ERROR_CLASSES).alias("error_type"),
        choose(F.floor(F.col("event_id") / 9) % 12, ERROR_TEXTS).alias("error_text"),
    )


# --- the same views for DuckDB -------------------------------------------------


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_list(texts: tuple[str, ...]) -> str:
    return "[" + ", ".join(_quote(t) for t in texts) + "]"


_LAT_SQL = "CAST(CASE event_type " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in LATS.items()) + " END AS DOUBLE)"
_TIME_SQL = "date_trunc('day', ts) + to_hours(CAST((hour(ts) // 6) * 6 AS BIGINT))"


def _grid_sql(source: str, lon_key: str, factor: float) -> str:
    return f"""SELECT '{source}' AS source, 'hgt' AS var, 500 AS level, {_TIME_SQL} AS time, {_LAT_SQL} AS lat,
  CAST(({lon_key} % 12) * 30 AS DOUBLE) AS lon,
  CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) * CAST({factor} AS DOUBLE) / (CAST(count(*) AS DOUBLE) * CAST({G} AS DOUBLE)) AS value
  FROM events GROUP BY ALL"""


_K_SQL = "(day(time) * 4 + hour(time) // 6 + CAST(lon / 30 AS INTEGER))"
_SERIES_SQL = "CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / (CAST(count(*) AS DOUBLE) * CAST({} AS DOUBLE)) AS value".format(
    100.0 * G
)
_KEYS_SQL = sql_list(tuple(r[0] for r in tables.VARIABLES))

VIEW_SQL: dict[str, str] = {
    "grid_obs": _grid_sql("primary", "user_id", 1.0),
    "grid_alt": _grid_sql("secondary", "event_id", 1.1),
    "grid_daily": "SELECT CAST(time AS DATE) AS date, lat, lon, avg(value) AS value FROM grid_obs GROUP BY ALL",
    "grid_missing": f"""SELECT * REPLACE (CASE WHEN {_K_SQL} % 17 = 0 THEN 'nan'::DOUBLE WHEN {_K_SQL} % 19 = 0 THEN -9999.0::DOUBLE
  ELSE value END AS value) FROM grid_obs""",
    "multi_level": """SELECT time, lat, lon, n AS level_order, p AS pressure_level, value + p / 1000.0::DOUBLE AS value
  FROM grid_obs, (VALUES (0, 850), (1, 500), (2, 250)) l(n, p)""",
    "wind_uv": """SELECT a.time, a.lat, a.lon, (a.value - 510.0::DOUBLE) / 20.0::DOUBLE AS u, (b.value - 510.0::DOUBLE) / 20.0::DOUBLE AS v,
  a.value / 10.0::DOUBLE AS temp
  FROM grid_obs a JOIN grid_obs b ON a.time = b.time AND a.lat = b.lat AND CAST(b.lon AS INTEGER) = (CAST(a.lon AS INTEGER) + 30) % 360""",
    "raw_fields": f"""SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'secondary' ELSE 'primary' END AS source,
  {_KEYS_SQL}[1 + l_partkey % 10] AS var_key, l_shipdate AS time, l_orderkey AS record, l_extendedprice AS value FROM lineitem""",
    "mixed_units": f"""SELECT time, lat, lon, CASE WHEN day(time) % 2 = 0 THEN value * 20.0::DOUBLE * {G}::DOUBLE ELSE value * 20.0::DOUBLE END AS value
  FROM grid_obs""",
    "daily_series": f"SELECT l_returnflag AS var, CAST(l_shipdate AS DATE) AS date, {_SERIES_SQL} FROM lineitem GROUP BY ALL",
    "anomaly_grid": "SELECT CASE WHEN lat < 0 THEN 'south' ELSE 'north' END AS var, date, lat, lon, value - 480.0::DOUBLE AS value FROM grid_daily",
    "long_grid": f"""SELECT CAST(l_shipdate AS DATE) AS date, CAST((l_suppkey % 4) * -15 - 25 AS DOUBLE) AS lat,
  CAST((l_partkey % 3) * 120 - 180 AS DOUBLE) AS lon, {_SERIES_SQL} FROM lineitem GROUP BY ALL""",
    "precip_steps": """SELECT l_orderkey AS run, l_linenumber AS step, sum(l_quantity) AS increment, 1 + min(l_partkey) % 8 AS code,
  min(l_suppkey) % 2 AS is_rain, (min(l_suppkey) // 2) % 2 AS is_ice, (min(l_suppkey) // 4) % 2 AS is_mixed,
  (min(l_suppkey) // 8) % 2 AS is_snow FROM lineitem GROUP BY ALL""",
    "fcst": f"""SELECT 'M' || (l_suppkey % 3) AS model, CAST(l_shipdate AS DATE) - CAST(l_orderkey % 16 AS INTEGER) AS init,
  CAST(l_shipdate AS DATE) AS target, l_extendedprice / {G}::DOUBLE AS value, l_orderkey AS loaded_at FROM lineitem""",
    "requests": f"""SELECT o_orderkey AS request, {sql_list(tuple(r[0] for r in tables.VARIABLES) + ("ozonio",))}[1 + o_custkey % 11] AS var_key,
  CASE WHEN o_orderkey % 4 < 2 THEN 500 WHEN o_orderkey % 4 = 2 THEN 850 END AS level, CAST(o_orderdate AS DATE) AS start_date,
  CAST(o_orderdate AS DATE) + CAST(o_orderkey % 70 - 5 AS INTEGER) AS end_date FROM orders""",
    "messages": f"""SELECT event_id, {sql_list(MESSAGES)}[1 + event_id % 7] AS message, {sql_list(ERROR_CLASSES)}[1 + event_id % 9] AS error_type,
  {sql_list(ERROR_TEXTS)}[1 + (event_id // 9) % 12] AS error_text FROM events""",
    "registry": "SELECT * FROM (VALUES "
    + ", ".join(
        "("
        + ", ".join(
            ("true" if v else "false") if isinstance(v, bool) else _quote(v) if isinstance(v, str) else f"{v!r}::DOUBLE"
            for v in r
        )
        + ")"
        for r in tables.VARIABLES
    )
    + ") t(var_key, primary_name, factor, secondary_code, needs_level, level_key, var, unit, long_name)",
}
_NEEDS = {
    "grid_daily": ("grid_obs",),
    "grid_missing": ("grid_obs",),
    "multi_level": ("grid_obs",),
    "wind_uv": ("grid_obs",),
    "mixed_units": ("grid_obs",),
    "anomaly_grid": ("grid_daily",),
}


def with_views(names: str, body: str) -> str:
    """Put the named views (space-separated) in front of ``body`` as CTEs."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, ()):
            add(need)
        if name not in order:
            order.append(name)

    for name in names.split():
        add(name)
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({VIEW_SQL[n]})" for n in order)
    body = body.strip()
    if body[:5].upper() == "WITH ":
        rest = body[5:]
        if rest[:10].upper() == "RECURSIVE ":
            return f"WITH RECURSIVE {ctes},\n{rest[10:]}"
        return f"WITH {ctes},\n{rest}"
    return f"WITH {ctes}\n{body}"


