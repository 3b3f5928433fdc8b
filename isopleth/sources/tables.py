"""Small fixed tables: variable registry, rules, named boxes, word lists.

Everything here is a literal of known length, so it may be broadcast or folded
into an expression without a size check.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

STANDARD_GRAVITY = 9.80665
MIN_FILE_BYTES = 10_000
DEFAULT_HOURS = (0, 6, 12, 18)
UNKNOWN_LAST_DAY_MARGIN = 8

# Variable registry.
# key, primary name, factor on the primary source, secondary code, needs a level,
# level key (template or fixed), output name, unit, description
VARIABLES = (
    ("geopotencial", "geopotential", 1 / STANDARD_GRAVITY, "HGT", True, "lev_{nivel}_mb", "hgt", "m", "Altura geopotencial"),
    ("temperatura", "temperature", 1.0, "TMP", True, "lev_{nivel}_mb", "tmp", "K", "Temperatura do ar (nivel de pressao)"),
    ("vento_zonal", "u_component_of_wind", 1.0, "UGRD", True, "lev_{nivel}_mb", "uwnd", "m/s", "Componente zonal (u) do vento"),
    ("vento_meridional", "v_component_of_wind", 1.0, "VGRD", True, "lev_{nivel}_mb", "vwnd", "m/s", "Componente meridional (v) do vento"),
    ("umidade_relativa", "relative_humidity", 1.0, "RH", True, "lev_{nivel}_mb", "rh", "%", "Umidade relativa (nivel de pressao)"),
    ("pressao_nivel_mar", "mean_sea_level_pressure", 1.0, "PRMSL", False, "lev_mean_sea_level", "msl", "Pa", "Pressao ao nivel medio do mar (MSLP)"),
    ("temperatura_2m", "2m_temperature", 1.0, "TMP", False, "lev_2_m_above_ground", "t2m", "K", "Temperatura a 2 metros"),
    ("vento_zonal_10m", "10m_u_component_of_wind", 1.0, "UGRD", False, "lev_10_m_above_ground", "u10", "m/s", "Componente zonal (u) do vento a 10 metros"),
    ("vento_meridional_10m", "10m_v_component_of_wind", 1.0, "VGRD", False, "lev_10_m_above_ground", "v10", "m/s", "Componente meridional (v) do vento a 10 metros"),
    ("agua_precipitavel", "total_column_water_vapour", 1.0, "PWAT", False, "lev_entire_atmosphere_(considered_as_a_single_layer)", "pwat", "kg/m2", "Agua precipitavel (coluna atmosferica inteira)"),
)
VARIABLE_COLUMNS = (
    "var_key string, primary_name string, factor double, secondary_code string, needs_level boolean, "
    "level_key string, var string, unit string, long_name string"
)

# Request address of the secondary source.
FILTER_URL = "https://nomads.ncep.noaa.gov/cgi-bin/filter_gdas_0p25.pl"

# Texts by which a source says that a period is not published yet.
NO_DATA_TEXTS = (
    "none of the data you have requested is available yet",
    "multiadapternodataerror",
    "no matching data",
    "requested data is not available",
    "latest date available",
)
LATEST_DATE_PATTERN = r"(?is)latest date available.*?:\s*(\d{4}-\d{2}-\d{2})\s+(\d{2}):(\d{2})"

# Area words written in capitals.
ACRONYMS = ("amo", "tsa", "tna", "pdo", "iod", "sad", "mjo", "psa", "enso", "zcit", "nao", "mdr", "smas")

# Hosts mirrored on the FTP server and the path prefix dropped there.
FTP_MIRRORED_HOSTS = ("psl.noaa.gov", "cdc.noaa.gov")
FTP_HOST = "ftp.cdc.noaa.gov"
FTP_DROPPED_PREFIX = "/thredds/fileServer/"

# Names of auxiliary columns and of level dimensions in incoming files.
AUXILIARY_COLUMNS = ("number", "expver")
LEVEL_COLUMNS = ("isobaricInhPa", "level", "pressure_level", "heightAboveGround", "meanSea")

# Ordered error rules (class, substring or None); hints are worded here.
ERROR_RULES = (
    ("FileNotFoundError", "No such file", "remote file not found"),
    ("FileNotFoundError", "Arquivo obrigatorio", "required file missing"),
    ("ConnectionError", "Falha na conexao SFTP", "SFTP connection failed"),
    ("ConnectionRefusedError", None, "SSH connection refused"),
    ("TimeoutError", None, "SSH connection timed out"),
    ("Exception", "Authentication failed", "SSH authentication failed"),
    ("Exception", "No such file or directory", "SSH key not found"),
    ("Exception", "KEY_CDS", "API key not configured"),
    ("Exception", "403", "API access denied"),
    ("Exception", "UNEXPECTED_EOF_WHILE_READING", "server closed the TLS connection"),
    ("Exception", "Max retries exceeded", "server unreachable after retries"),
    ("RuntimeError", "corrompido mesmo apos re-download", "support file corrupt here and on the server"),
    ("RuntimeError", "corrompido", "support file corrupt"),
    ("RuntimeError", "Re-download falhou", "second download failed"),
    ("OSError", "Unknown file format", "file corrupt or of another format"),
    ("ImportError", "jinja2", "dependency jinja2 missing"),
    ("ModuleNotFoundError", None, "Python module missing"),
)
CLASS_PARENTS = {
    "FileNotFoundError": "OSError",
    "ConnectionError": "OSError",
    "ConnectionRefusedError": "ConnectionError",
    "TimeoutError": "OSError",
    "OSError": "Exception",
    "RuntimeError": "Exception",
    "ModuleNotFoundError": "ImportError",
    "ImportError": "Exception",
}

# Area used as the sample box (north, west, south, east).
SAMPLE_AREA = (10.0, -80.0, -40.0, 15.0)

# Named index boxes (name, north, west, south, east), public definitions.
INDEX_BOXES = (
    ("nino12", 0.0, -90.0, -10.0, -80.0),
    ("nino3", 5.0, -150.0, -5.0, -90.0),
    ("nino34", 5.0, -170.0, -5.0, -120.0),
    ("nino4", 5.0, 160.0, -5.0, -150.0),
    ("iod_west", 10.0, 50.0, -10.0, 70.0),
    ("iod_east", 0.0, 90.0, -10.0, 110.0),
    ("tna", 23.5, -57.5, 5.5, -15.0),
    ("tsa", 0.0, -30.0, -20.0, 10.0),
    ("atl3", 3.0, -20.0, -3.0, 0.0),
)

# Precipitation type codes.
RAIN_CODES = (1,)
ICE_CODES = (3, 8)
MIXED_CODES = (7,)
SNOW_CODES = (5, 6)
SNOW_RATIO = 10.0


def literal_table(spark: SparkSession, rows: Sequence[tuple], columns: str) -> DataFrame:
    """Fixed rows as a local relation, whose exact size the optimiser knows."""

    def literal(v: object) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return str(v).lower()
        if isinstance(v, str):
            return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return f"{v!r}D" if isinstance(v, float) else repr(v)

    names, types = zip(*(c.split() for c in columns.split(",")))
    values = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    casts = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in zip(names, types))
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({', '.join(names)})")


def variable_registry(spark: SparkSession) -> DataFrame:
    """The ten known variables as a dimension table."""
    return literal_table(spark, VARIABLES, VARIABLE_COLUMNS)


def get_variable(key: str) -> dict:
    """One registry entry; an unknown key is an error that lists the known ones."""
    names = [c.split()[0] for c in VARIABLE_COLUMNS.split(", ")]
    for row in VARIABLES:
        if row[0] == key:
            return dict(zip(names, row))
    raise ValueError(f"unknown variable {key!r}; known: {', '.join(sorted(r[0] for r in VARIABLES))}")


def subclasses_of(name: str) -> list[str]:
    """The class itself and every class below it."""
    out = [name]
    for child in CLASS_PARENTS:
        cls = child
        while cls in CLASS_PARENTS:
            cls = CLASS_PARENTS[cls]
            if cls == name:
                out.append(child)
                break
    return out
