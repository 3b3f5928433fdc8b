"""Column and key helpers that the text operators share."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isopleth.session import materialise, remove_dir

#: The six ASCII blanks that separate words, as a character class body (Java and Python).
BLANK = r"\x20\x09-\x0D"
#: Records whose texts one Python step handles at once; keeps its arrays small.
STEP_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that no column of ``df`` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    name, n = f"__{base}", 0
    while name.lower() in taken:
        n += 1
        name = f"__{base}{n}"
    return name


def same(a: Column, b: Column) -> Column:
    """Equality under which NULL matches NULL; still an equi-join key."""
    return a.eqNullSafe(b)


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """64-bit name of a row by id and whole text; used beside the id, never alone, to tell rows apart."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def crc_bucket(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; NULL ids count as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % n


def words(text: str | None) -> list[bytes]:
    """UTF-8 words between the six ASCII blanks (``bytes.split`` knows exactly these)."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def bounded(texts: pd.Series, limit: int = STEP_BYTES) -> Iterator[pd.Series]:
    """Cut a batch into runs of about ``limit`` characters, so that very long texts stay apart."""
    start = total = 0
    for k, n in enumerate(texts.str.len().fillna(0).to_numpy()):
        if total and total + n > limit:
            yield texts.iloc[start:k]
            start, total = k, 0
        total += int(n)
    if start < len(texts):
        yield texts.iloc[start:]


def unit_from_hash(*cols: Column | str) -> Column:
    """Deterministic number in [0, 1) from the columns."""
    return (F.shiftrightunsigned(F.xxhash64(*cols), 11)).cast("double") / float(1 << 53)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finishing step of splitmix64: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


LETTER = re.compile(r"[^\W\d_]")


def hashed_sample(df: DataFrame, rows: int, *by: str, seed: int = 0) -> DataFrame:
    """At most ``rows`` rows, those with the smallest hash of the columns ``by``.

    Only about four times as many rows as wanted are sorted, whatever the size of the table: a
    top-k alone would send ``rows`` rows from every task to the driver.
    """
    order = F.pmod(F.xxhash64(F.lit(seed), *by), F.lit(1 << 40))
    share = min(1.0, 4.0 * rows / max(1, df.count()))
    return df.filter(order < int(share * (1 << 40))).orderBy(order, *by).limit(rows)


def store(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder, read back, and let go of the shuffle files behind it.

    What comes after reads the written table, so the shuffles that made it are not needed
    again; Spark drops them at the end of the write instead of when the driver next
    collects its garbage.
    """
    spark, setting = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        return materialise(df, label)
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def discard(stored: DataFrame) -> None:
    """Delete what ``store`` wrote for this frame; nothing may read it any more."""
    for path in {f.rsplit("/", 1)[0] for f in stored.inputFiles()}:
        remove_dir(stored.sparkSession, path)
