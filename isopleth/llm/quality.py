"""Quality rules as a short-circuit cascade.

Every rule accepts or rejects a text, and a text is kept if all accept it.  The order
doesn't change that verdict, only its cost: on a sample, the cost and the rejection
rate of each rule are estimated, and the rules run by falling rejection per cost, each
on the survivors of those before it.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isopleth.llm.common import hashed_sample

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
#: Largest share (in %) of words in repeated 3-word windows.
MAX_REPEAT_PERCENT = 50
#: Texts in the sample that the order is estimated on, and characters of them at most.
SAMPLE_ROWS = 400
SAMPLE_CHARS = 4_000_000


class Text:
    """A text with its counts, each worked out when first asked for."""

    def __init__(self, text: str | None) -> None:
        self.text = text or ""

    def __getattr__(self, name: str) -> object:
        value = getattr(self, f"_{name}")()
        setattr(self, name, value)
        return value

    def _words(self) -> list[bytes]:
        return self.text.encode("utf-8", "surrogatepass").split()

    def _n_words(self) -> int:
        return len(self.words)

    def _word_chars(self) -> int:
        return len(self.text) - sum(self.text.count(c) for c in BLANKS)

    def _n_symbols(self) -> int:
        return sum(self.text.count(c) for c in SYMBOLS)

    def _lines(self) -> list[str]:
        return [x for x in self.text.split("\n") if x.strip(BLANKS)]

    def _n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    def _n_repeat_words(self) -> int:
        w = self.words
        windows = list(zip(w, w[1:], w[2:]))
        if len(set(windows)) == len(windows):
            return 0
        count = Counter(windows)
        covered = end = 0
        for k, x in enumerate(windows):
            if count[x] > 1:
                covered += k + 3 - max(k, end)
                end = k + 3
        return covered

    def _n_ended_lines(self) -> int:
        return sum(x.rstrip(BLANKS)[-1] in ".!?…\"'»”" for x in self.lines)


@dataclass(frozen=True)
class Rule:
    name: str
    accepts: Callable[[Text], bool]


#: The rules of the method besides the two base rules; counts compare without rounding.
RULES = (
    Rule("enough_words", lambda t: t.n_words >= MIN_WORDS),
    Rule("few_repeats", lambda t: 100 * t.n_repeat_words <= MAX_REPEAT_PERCENT * t.n_words),
    Rule("few_symbols", lambda t: 10 * t.n_symbols <= t.n_words),
    Rule("few_duplicate_lines", lambda t: 100 * t.n_dup_lines <= 30 * len(t.lines)),
    Rule("usual_word_length", lambda t: 2 * t.n_words <= t.word_chars <= 15 * t.n_words),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Estimate:
    """Seconds a text and rejected share of a rule on the sample."""

    rule: Rule
    cost: float
    rejects: float


def estimate(sample: list[str | None], rules: tuple[Rule, ...] = RULES) -> list[Estimate]:
    """Cost and selectivity of every rule, each on fresh texts, so that no rule uses another's counts."""
    out = []
    for rule in rules:
        texts = [Text(t) for t in sample]
        start = time.perf_counter()
        rejected = sum(not rule.accepts(t) for t in texts)
        cost = (time.perf_counter() - start) / max(1, len(texts))
        out.append(Estimate(rule, cost, rejected / max(1, len(texts))))
    return out


def cascade_order(estimates: list[Estimate]) -> list[Rule]:
    """Rules by falling rejection per cost; ties keep their order."""
    return [e.rule for e in sorted(estimates, key=lambda e: -e.rejects / max(e.cost, 1e-9))]


def sample_texts(docs: DataFrame, text: str = "text", rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> list:
    """Whole texts for the estimates: ``rows`` rows by hash, at most ``chars`` characters together."""
    picked = docs.select(F.col(text).alias("t")).filter(F.length("t") <= chars // 20)
    taken = hashed_sample(picked, rows, "t").collect()
    out, left = [], chars
    for r in taken:
        left -= len(r.t)
        if left < 0:
            break
        out.append(r.t)
    return out


def quality_cascade(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    doc_id: str = "doc_id",
    text: str = "text",
    counts: bool = True,
) -> DataFrame:
    """Verdict of the cascade for every whole text.

    One row per input row: doc_id, with ``counts`` the five counts and base_failed, and
    kept.  Without ``counts`` a rejected text costs no more than the rules up to the one
    that rejects it.

    NULL and empty texts have no words and fail.  Repeated rows give repeated results, an
    empty table an empty result; further columns are ignored.  Only the order of the rules
    depends on the sample, never the verdict.  Nothing but the sample is shuffled.
    """
    order = cascade_order(estimate(sample_texts(docs, text), rules))
    kind = "kept boolean"
    if counts:
        kind = ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, " + kind

    @F.pandas_udf(kind)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for t in map(Text, texts):
                kept = all(rule.accepts(t) for rule in order)
                if counts:
                    failed = t.n_words < MIN_WORDS or 100 * t.n_repeat_words > MAX_REPEAT_PERCENT * t.n_words
                    rows.append((*(getattr(t, c) for c in COUNTS), failed, kept and not failed))
                else:
                    rows.append((kept,))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in kind.split(", ")])

    return docs.select(F.col(doc_id).alias("doc_id"), judge(F.col(text)).alias("q")).select("doc_id", "q.*")
