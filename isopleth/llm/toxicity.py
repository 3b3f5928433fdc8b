"""Toxicity by multiple-instance learning: sentences are instances, documents are bags.

A sentence scores p = sigmoid(w . x + b) over its terms, and a document the noisy-or of its
sentences, 1 - prod(1 - p).  Only document labels are given; the gradient of their
likelihood finds the sentences that explain them, and the sentence scores locate offence.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isopleth.llm.common import crc_bucket

# Bounds of the training sample: documents of each label, and characters of a document.
DOCS_PER_LABEL = 2000
DOC_CHARS = 20_000
#: Terms that the model may use: those that set toxic documents apart most.
MOST_TERMS = 3000
#: Characters of the word beginnings that are terms beside whole words.
PREFIXES = (5, 6, 7)
#: Log odds of a sentence without any term; low, as long texts have thousands of sentences.
BIAS = -11.0
STEPS = 300
RATE = 0.05
DECAY = 0.002
CUT = 0.3
SEED = 13

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W_]+")


def terms_of(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) >= n)]


def _bag(text: str) -> list[set[str]]:
    """Terms of each sentence."""
    out = []
    for m in SENTENCE.finditer(text.lower()):
        found = {t for w in set(WORD.findall(m[0])) for t in terms_of(w)}
        if found:
            out.append(found)
    return out


@dataclass
class Model:
    """Weights by term; a sentence's log odds are ``bias`` and those of its terms."""

    weights: dict[str, float]
    bias: float = BIAS
    _seen: dict[str, float] = field(default_factory=dict, repr=False)

    def word_score(self, word: str) -> float:
        """Sum of a word's term weights, remembered for a bounded number of words."""
        if (s := self._seen.get(word)) is None:
            if len(self._seen) >= 500_000:
                self._seen.clear()
            s = self._seen[word] = sum(self.weights.get(t, 0.0) for t in terms_of(word))
        return s

    def sentences(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, probability) of every sentence, in code points."""
        out = []
        low = text.lower()
        source = low if len(low) == len(text) else text  # positions hold only if lower-casing kept the length
        for m in SENTENCE.finditer(source):
            z = self.bias + sum(map(self.word_score, set(WORD.findall(m[0].lower()))))
            out.append((m.start(), m.end(), 1 / (1 + float(np.exp(-np.clip(z, -50, 50))))))
        return out

    def score(self, text: str | None) -> float:
        """Noisy-or of the sentences; one sentence without words stands for an empty text."""
        low = (text or "").lower()
        floor = float(np.log1p(-1 / (1 + np.exp(-self.bias))))
        if not self.weights:
            return 0.0
        logs, telling = 0.0, False
        seen, score = self._seen, self.word_score
        parts = SENTENCE.findall(low)
        for part in parts:
            z = 0.0
            for w in set(WORD.findall(part)):
                x = seen.get(w)
                z += score(w) if x is None else x
            if z:
                telling = True
                logs -= float(np.logaddexp(0, np.clip(self.bias + z, -50, 50)))
            else:
                logs += floor
        return 1 - float(np.exp(logs)) if telling or parts else 1 - float(np.exp(floor))


def train(texts: list[str], labels: list[int], prior: float | None = None) -> Model:
    """Fit sentence weights to document labels; ``prior`` is the share of label 1 outside the sample."""
    y = np.asarray(labels, float)
    if not len(y) or y.min() == y.max():
        return Model({})
    bags = [_bag(t) for t in texts]
    in_one, in_zero = Counter(), Counter()
    for bag, label in zip(bags, y):
        (in_one if label else in_zero).update(set().union(*bag) if bag else ())
    n1, n0 = y.sum(), len(y) - y.sum()
    odds = {t: np.log((c + 0.5) / n1) - np.log((in_zero[t] + 0.5) / n0) for t, c in in_one.items() if c >= 3}
    telling = sorted((t for t, x in odds.items() if x > 1), key=lambda t: (-odds[t] * in_one[t], t))[:MOST_TERMS]
    index = {t: k for k, t in enumerate(telling)}

    rows, cols, owner, n = [], [], [], 0
    plain = np.zeros(len(y))  # sentences without any of the terms
    for d, bag in enumerate(bags):
        for sentence in bag:
            own = [index[t] for t in sentence if t in index]
            if own:
                rows += [n] * len(own)
                cols += own
                owner.append(d)
                n += 1
            else:
                plain[d] += 1
    rows, cols, owner = np.array(rows, np.int64), np.array(cols, np.int64), np.array(owner, np.int64)
    prior = n1 / len(y) if prior is None else prior
    weight = np.where(y == 1, prior / (n1 / len(y)), (1 - prior) / (n0 / len(y))) / len(y)
    floor = np.log1p(-1 / (1 + np.exp(-BIAS)))
    w = np.full(len(telling), 0.5)
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        z = np.clip(BIAS + np.bincount(rows, w[cols], n), -50, 50)
        p = 1 / (1 + np.exp(-z))
        none = np.bincount(owner, -np.logaddexp(0, z), len(y)) + plain * floor  # log of the chance that no sentence offends
        some = np.maximum(-np.expm1(none), 1e-12)
        pull = np.where(y == 1, -np.exp(none) / some, 1.0) * weight
        g = np.bincount(cols, (pull[owner] * p)[rows], len(w)) * len(y) / 10 + DECAY * w
        mean += 0.1 * (g - mean)
        square += 0.01 * (g * g - square)
        w -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        np.maximum(w, 0, out=w)
    return Model({t: float(x) for t, x in zip(telling, w) if x > 1e-3})


def training_sample(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", per_label: int = DOCS_PER_LABEL
) -> tuple[list[str], list[int], float | None]:
    """Texts, labels and the share of label 1 among all training labels.

    At most ``per_label`` documents of each label, chosen by hash among labelled documents
    outside the held-out quarter with at most ``DOC_CHARS`` characters.  An id with several
    labels counts as toxic if one of them says so.
    """
    own = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    own = own.filter(F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & (crc_bucket("id", 4) != 2))
    own = own.groupBy("id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in own.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return [], [], None
    picked = None
    for label in (0, 1):
        # twice as many ids as wanted: some belong to no document, or to a long one
        part = own.filter(F.col("toxic") == label).orderBy(F.xxhash64(F.lit(SEED), "id"), "id").limit(2 * per_label)
        picked = part if picked is None else picked.union(part)
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    texts = texts.filter(F.length("text") <= DOC_CHARS)
    joined = texts.join(F.broadcast(picked), F.col("doc_id") == F.col("id"))  # at most 4 * per_label rows
    rows = []
    for label in (0, 1):
        own = joined.filter(F.col("toxic") == label).orderBy(F.xxhash64(F.lit(SEED), "id"), "id", "text")
        rows += own.select("text", "toxic").limit(per_label).collect()
    return [r["text"] for r in rows], [r["toxic"] for r in rows], counts[1] / (counts[0] + counts[1])


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    model: Model | None = None,
    sentences: bool = False,
) -> DataFrame:
    """Toxicity of every whole text: doc_id, held_out, score, predicted (one row per input row).

    ``predicted`` is 1 from score 0.3 on.  With ``sentences`` a column ``offending`` lists (start, end,
    score) of the sentences that alone reach that.

    NULL and empty texts score as one sentence without words, near 0.  If no labels of both
    kinds are there, all scores are 0.  Repeated rows give repeated results; further columns are
    ignored.  Nothing but labels and the sample is shuffled.
    """
    model = model or train(*training_sample(docs, labels, doc_id, text))
    kind = "score double" + ", offending array<struct<start: int, end: int, score: double>>" * sentences

    @F.pandas_udf(kind)
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = pd.DataFrame({"score": np.array([model.score(t) for t in texts], float)})
            if sentences:  # a noisy-or is no less than its largest term, so others have none
                found = [[x for x in model.sentences(t or "") if x[2] >= CUT] if s >= CUT else [] for t, s in zip(texts, out["score"])]
                out["offending"] = [[dict(zip(("start", "end", "score"), x)) for x in f] for f in found]
            yield out

    out = docs.select(F.col(doc_id).alias("doc_id"), judge(F.col(text)).alias("j"))
    more = ["j.offending"] if sentences else []
    return out.select(
        "doc_id",
        (crc_bucket("doc_id", 4) == 2).alias("held_out"),
        "j.score",
        (F.col("j.score") >= CUT).cast("int").alias("predicted"),
        *more,
    )
