"""Removal of repeated passages by seed and extend.

Seed: every document is winnowed.  Of each run of consecutive 18-word hashes the smallest
is an anchor, so any 35 words that stand in two places hold an anchor that stands in both, and
nine words more on one side of it at least.  Anchors are looked up with those nine words, once for
each side; those that occur only once are dropped.

Extend: each shared anchor is extended both ways to the 35-word windows around it, as far
as a match can reach, and a window counts if its words stand elsewhere too.  Overlapping
windows that count form the maximal repeats, and their words are removed.  Windows are
compared by two independent 64-bit hashes; groups of any size are counted, never paired.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isopleth.llm.common import bounded, mix64, row_key, store, words

WINDOW = 35
ANCHOR = 18
#: Words by which an anchor is widened to either side before it is looked up elsewhere.
FLANK = (WINDOW - ANCHOR + 1) // 2
#: Odd multipliers of the rolling hashes and their inverses modulo 2^64.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
INVERSES = tuple(pow(b, -1, 1 << 64) for b in BASES)


def _made_powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


#: Powers that a worker keeps; longer texts get their own.
KEPT_POWERS = 1 << 17
_kept = cache(lambda base: _made_powers(base, KEPT_POWERS))


def _powers(base: int, n: int) -> np.ndarray:
    return _kept(base)[:n] if n <= KEPT_POWERS else _made_powers(base, n)


class Roller:
    """Rolling hashes over the words of one document, for any window length.

    The words are hashed once.  ``other`` rolls another mix of the same word hashes by another base.
    """

    def __init__(self, tokens: list[bytes]) -> None:
        self.tokens = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
        self._roll(self.tokens, 0)

    def _roll(self, h: np.ndarray, which: int) -> None:
        self.sums = np.zeros(len(h) + 1, np.uint64)
        np.add.accumulate(h * _powers(INVERSES[which], len(h)), out=self.sums[1:])
        self.powers = _powers(BASES[which], len(h))

    def other(self) -> Roller:
        out = object.__new__(Roller)
        out.tokens = mix64(self.tokens ^ np.uint64(BASES[1]))
        out._roll(out.tokens, 1)
        return out

    def hashes(self, size: int, at: np.ndarray | None = None) -> np.ndarray:
        """Hashes of the windows of ``size`` words that start at ``at`` (default: all)."""
        if at is None:
            n = max(0, len(self.sums) - size)
            return mix64((self.sums[size : size + n] - self.sums[:n]) * self.powers[:n])
        return mix64((self.sums[at + size] - self.sums[at]) * self.powers[at])


def smallest(h: np.ndarray, run: int) -> np.ndarray:
    """Places of the rightmost smallest value of each run of ``run`` values, ascending.

    Runs of twice the length are made of two shorter ones, the last ones of two that overlap.
    """
    at, size = np.arange(len(h)), 1
    while size < run:
        step = min(size, run - size)
        left, right = at[:-step], at[step:]
        at, size = np.where(h[right] <= h[left], right, left), size + step
    return at[np.flatnonzero(np.diff(at, prepend=-1))]


def anchors(roller: Roller, window: int = WINDOW, size: int = ANCHOR) -> np.ndarray:
    """Starts of the winnowed anchors: the rightmost smallest hash of each run."""
    if len(roller.tokens) < window:
        return np.zeros(0, np.int64)
    return smallest(roller.hashes(size), window - size + 1)


def flanks(roller: Roller) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of the anchors with ``FLANK`` more words to the left, and to the right.

    A 35-word window around an anchor reaches nine words beyond it on one side at least, so it holds
    one of the two, and a window that stands twice holds one that stands twice.
    """
    at = anchors(roller)
    at = np.unique(np.concatenate([at - FLANK, at]))
    at = at[(at >= 0) & (at + ANCHOR + FLANK <= len(roller.tokens))]
    return at, roller.hashes(ANCHOR + FLANK, at) if len(at) else np.zeros(0, np.uint64)


@F.pandas_udf(T.ArrayType(T.LongType()))
def flank_hashes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Hashes of the widened anchors of every text, repeats included."""
    for texts in batches:
        yield pd.Series([flanks(Roller(words(t)))[1].view(np.int64) for part in bounded(texts) for t in part])


def window_starts(roller: Roller, seeds: np.ndarray) -> np.ndarray:
    """Starts of the windows that hold a widened anchor whose hash is among ``seeds``."""
    at, h = flanks(roller)
    at = at[np.isin(h.view(np.int64), seeds)]
    cover = np.zeros(max(0, len(roller.tokens) - WINDOW + 1) + 1, np.int64)  # 1 where a run of starts begins, -1 after it
    np.add.at(cover, np.minimum(np.maximum(at - (WINDOW - ANCHOR - FLANK), 0), len(cover) - 1), 1)
    np.add.at(cover, np.minimum(at + 1, len(cover) - 1), -1)
    return np.flatnonzero(np.cumsum(cover)[:-1])


#: Windows after which the extension hands on what it has made.
BATCH_WINDOWS = 1 << 17


def _extend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Both hashes of the windows around the shared anchors (column ``seeds``) of every text; short texts share a batch."""
    for pdf in batches:
        made, owners, size = [], [], 0
        for text, rk, doc, seeds, copies in zip(pdf["text"], pdf["rk"], pdf["id"], pdf["seeds"], pdf["copies"]):
            roller = Roller(words(text))
            at = window_starts(roller, np.asarray(seeds, np.int64))
            if len(at):
                made.append((roller.hashes(WINDOW, at), roller.other().hashes(WINDOW, at), at))
                owners.append((rk, None if pd.isna(doc) else int(doc), copies, len(at)))
                size += len(at)
            if size >= BATCH_WINDOWS:
                yield _window_rows(made, owners)
                made, owners, size = [], [], 0
        if made:
            yield _window_rows(made, owners)


def _window_rows(made: list[tuple[np.ndarray, ...]], owners: list[tuple]) -> pd.DataFrame:
    a, b, at = (np.concatenate(x) for x in zip(*made))
    rk, doc, copies, n = zip(*owners)
    own = {"rk": np.repeat(np.array(rk, np.int64), n), "id": pd.array(doc, "Int64").repeat(n)}
    return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64), **own, "at": at.astype(np.int32), "copies": np.repeat(copies, n)})


def remaining_words(text: str | None, starts: list[int] | None, copies: int) -> tuple[int, list[bytes]]:
    """(words of the text, words left) after the windows at ``starts`` are cut out."""
    tokens = words(text)
    n = len(tokens)
    if copies > 1 and n >= WINDOW:
        return n, []
    if starts is None or not len(starts):
        return n, tokens
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, np.asarray(starts), 1)
    np.add.at(edge, np.asarray(starts) + WINDOW, -1)
    return n, [w for w, covered in zip(tokens, np.cumsum(edge)[:-1]) if not covered]


def _cutter(want_text: bool):
    kind = "n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * want_text

    @F.pandas_udf(kind)
    def cut(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, starts, copies in batches:
            rows = []
            for text, s, c in zip(texts, starts, copies):
                n, left = remaining_words(text, s, int(c))
                joined = b" ".join(left)
                rows.append((n, n - len(left), hashlib.sha256(joined).hexdigest()))
                if want_text:
                    rows[-1] += (joined.decode("utf-8", "surrogatepass"),)
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in kind.split(", ")])

    return cut


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", texts: bool = False) -> DataFrame:
    """Every document without the words that a repeated 35-word window covers.

    One row per input row: doc_id, n_words, n_removed, kept_sha256 and, with ``texts``,
    kept_text (the words left, joined by one space).

    NULL, empty and blank texts have no words; texts of fewer than 35 words lose none.
    Repeated rows are repeats of each other and lose all words.  Further columns are ignored.

    Copies are handled once: of equal texts one stands for all in the search, counted as
    often as it occurs.  The texts are shuffled twice, for the extension and for the cut.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    row = F.struct(row_key().alias("rk"), F.col("doc_id").alias("id"))
    seeded = own.select(
        row.alias("row"),
        F.xxhash64(F.lit(1), "text").alias("d1"),  # d1 and d2 name the text by 124 bits
        F.conv(F.substring(F.md5(F.col("text").cast("binary")), 1, 15), 16, 10).cast("long").alias("d2"),
        flank_hashes("text").alias("anchors"),
    )
    seeded = store(seeded.filter(F.size("anchors") > 0), "anchors")
    copies = seeded.groupBy("d1", "d2").agg(F.count("*").alias("copies"), F.min("row").alias("one"))
    copies = store(copies.filter("copies > 1"), "copies")
    counted = seeded.join(copies, ["d1", "d2"], "left").withColumn("copies", F.coalesce("copies", F.lit(1).cast("long")))

    # of equal texts only the one row that stands for them takes part in the search, once if it is repeated
    ones = counted.filter("copies > 1 and row = one").dropDuplicates(["row"])
    active = counted.filter("copies = 1").union(ones)
    hits = active.select(F.col("row.rk").alias("rk"), "copies", F.explode("anchors").alias("h"))
    # stored: beside a stored table Spark can split a hot hash of the other side of a join
    twice = hits.groupBy("h").agg(F.sum("copies").alias("n")).filter("n > 1").select("h")
    twice = store(twice, "shared_anchors")
    seeds = hits.select("rk", "h").join(twice, "h", "left_semi").groupBy("rk").agg(F.collect_set("h").alias("seeds"))
    search = active.select("row", "copies", F.col("row.rk").alias("rk")).join(seeds, "rk")
    search = store(search.select("row", "copies", "seeds"), "seeds")

    placed = own.withColumn("row", row)
    # only rows with copies can be repeated; sorting all the others to find none out would cost far more
    around = placed.join(search.filter("copies = 1"), "row")
    around = around.union(placed.join(search.filter("copies > 1"), "row").dropDuplicates(["row"]))
    around = around.select("text", "row.rk", "row.id", "seeds", "copies")
    windows = store(around.mapInPandas(_extend, "a long, b long, rk long, id long, at int, copies long"), "windows")
    repeated = windows.groupBy("a", "b").agg(F.sum("copies").alias("n")).filter("n > 1").select("a", "b")
    repeated = store(repeated, "repeated_windows")
    found = windows.join(repeated, ["a", "b"], "left_semi").groupBy(F.struct("rk", "id").alias("row"))
    found = found.agg(F.collect_set("at").alias("starts")).select("row", "starts", F.lit(1).cast("long").alias("copies"))
    copied = counted.filter("copies > 1").select("row", F.lit(None).cast("array<int>").alias("starts"), "copies")
    verdict = found.union(copied).groupBy("row").agg(F.max("copies").alias("copies"), F.max("starts").alias("starts"))
    verdict = store(verdict, "repeats")

    cut = _cutter(texts)("text", "starts", F.coalesce("copies", F.lit(1)))
    return placed.join(verdict, "row", "left").select("doc_id", cut.alias("c")).select("doc_id", "c.*")
