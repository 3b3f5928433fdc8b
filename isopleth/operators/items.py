"""Apply a user's Python function to every item of a table.

An item is one row.  Work is spread by partitions and not by key, so a frequent
key cannot fill one task; a group is turned into an item by aggregating first.
"""

from __future__ import annotations

import traceback
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

OUTCOME = T.StructType(
    [
        T.StructField("ok", T.BooleanType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("error_msg", T.StringType()),
        T.StructField("traceback", T.StringType()),
    ]
)


def map_items(df: DataFrame, func: Callable[[dict], dict | None], key: str, result: T.StructType) -> DataFrame:
    """Run ``func(row) -> dict`` per item; an exception becomes a row, the others go on.

    ``key`` carries the input order to the output.
    """
    schema = T.StructType([df.schema[key], *result.fields, *OUTCOME.fields])
    arrow, names = to_arrow_schema(schema), result.fieldNames()

    def failure(item: dict, exc: Exception) -> dict[str, Any]:
        return {
            key: item[key],
            "ok": False,
            "error_type": type(exc).__name__,
            "error_msg": str(exc),
            "traceback": traceback.format_exc(),
        }

    def one(item: dict) -> dict[str, Any]:
        try:
            out = func(item) or {}
            return {key: item[key], **{n: out.get(n) for n in names}, "ok": True}
        except Exception as exc:  # noqa: BLE001 - every failure is data here
            return failure(item, exc)

    def fitting(item: dict, row: dict[str, Any]) -> dict[str, Any]:
        try:
            pa.RecordBatch.from_pylist([row], schema=arrow)
            return row
        except Exception as exc:  # noqa: BLE001 - a result of the wrong type is a failure of its item
            return failure(item, exc)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = batch.to_pylist()
            done = [one(item) for item in items]
            try:
                yield pa.RecordBatch.from_pylist(done, schema=arrow)
            except (pa.ArrowException, TypeError, ValueError, OverflowError):
                # some result does not fit its type: find it item by item
                yield pa.RecordBatch.from_pylist([fitting(item, row) for item, row in zip(items, done)], schema=arrow)

    return df.mapInArrow(run, schema)


def map_items_strict(df: DataFrame, func: Callable[[dict], dict | None], key: str, result: T.StructType) -> DataFrame:
    """The same, but the first exception fails the job and an item that returns None is dropped."""
    schema = T.StructType([df.schema[key], *result.fields])
    arrow, names = to_arrow_schema(schema), result.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [(item[key], func(item)) for item in batch.to_pylist()]
            rows = [{key: k, **{n: out.get(n) for n in names}} for k, out in done if out is not None]
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return df.mapInArrow(run, schema)


def map_groups(
    df: DataFrame,
    func: Callable[[Any, Iterator[pa.RecordBatch]], Iterator[dict]],
    keys: list[str],
    result: T.StructType,
) -> DataFrame:
    """Run ``func(key, batches) -> rows`` per group; an exception becomes one row of its group, the others go on.

    ``func`` gets the key values as a tuple and the group's rows as Arrow batches one after the other, so
    a group need not fit in memory (a group is still one task's work; use ``map_items`` where rows stand
    alone).  It yields result rows as dicts.  Rows that a group yields are passed on as they come, those
    yielded before an exception too; the failure row follows them, with NULL results.  A result that
    does not fit its type is a failure.  Groups without result rows leave one row with ``ok`` and
    NULL results, so every group is accounted for.  No rows give no rows; NULL keys are a group.
    """
    schema = T.StructType([*[df.schema[k] for k in keys], *result.fields, *OUTCOME.fields])
    arrow, names = to_arrow_schema(schema), result.fieldNames()
    chunk = 1000

    def failure(exc: Exception) -> dict[str, Any]:
        return {"ok": False, "error_type": type(exc).__name__, "error_msg": str(exc), "traceback": traceback.format_exc()}

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = tuple(k.as_py() for k in key)
        fixed, held, sent = dict(zip(keys, values)), [], 0
        try:
            for out in func(values, batches):
                held.append({**fixed, **{n: out.get(n) for n in names}, "ok": True})
                if len(held) >= chunk:
                    ready = pa.RecordBatch.from_pylist(held, schema=arrow)
                    sent, held = sent + len(held), []
                    yield ready
            ready = pa.RecordBatch.from_pylist(held or ([] if sent else [{**fixed, "ok": True}]), schema=arrow)
            held = []
            yield ready
        except Exception as exc:  # noqa: BLE001 - every failure is data here
            error = failure(exc)
            try:
                before = pa.RecordBatch.from_pylist(held, schema=arrow)
            except (pa.ArrowException, TypeError, ValueError, OverflowError) as bad:
                error, before = failure(bad), None
            if before is not None and len(held):
                yield before
            yield pa.RecordBatch.from_pylist([{**fixed, **error}], schema=arrow)
        finally:
            for _ in batches:  # what the function left unread
                pass

    return df.groupBy(*keys).applyInArrow(run, schema)


def outcome_summary(outcomes: DataFrame) -> DataFrame:
    """Counts of good and failed items and their total."""
    return outcomes.agg(
        F.count_if(F.col("ok")).alias("n_ok"),
        F.count_if(~F.col("ok")).alias("n_failed"),
        F.count(F.lit(1)).alias("n_total"),
    )
