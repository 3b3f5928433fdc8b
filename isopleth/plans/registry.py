"""Named queries, each with its Spark plan and, where SQL can say it, its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
DECIMALS = 6


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; its result is put in comparable form by ``present``."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: present(fn(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def present(df: DataFrame) -> DataFrame:
    """Round doubles, widen integers and write dates as text, so two engines can be compared."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), DECIMALS)
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# SQL spellings of the same presentation
def r(expr: str) -> str:
    return f"(round({expr}, {DECIMALS}) + 0.0::DOUBLE)"


def day(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def instant(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"
