"""Explain error messages by an ordered rule list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isopleth.sources import tables


def hint_for(
    error_class: Column,
    message: Column,
    rules: Sequence[tuple[str, str | None, str]] = tables.ERROR_RULES,
) -> Column:
    """Hint of the first rule whose class is the error's class or an ancestor and whose text occurs.

    The rules are a short ordered list, so they fold into one CASE expression; there
    is nothing to join and the order needs no tie-break.
    """
    case = None
    for cls, part, hint in rules:
        cond = F.lit(True) if cls == "Exception" else error_class.isin(tables.subclasses_of(cls))
        if part is not None:
            cond = cond & F.contains(message, F.lit(part))
        case = F.when(cond, F.lit(hint)) if case is None else case.when(cond, F.lit(hint))
    return F.lit(None).cast("string") if case is None else case


def classify_messages(
    df: DataFrame,
    error_class: str = "error_type",
    message: str = "message",
    rules: Sequence[tuple[str, str | None, str]] = tables.ERROR_RULES,
) -> DataFrame:
    return df.withColumn("hint", hint_for(F.col(error_class), F.col(message), rules))
