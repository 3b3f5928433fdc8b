"""Language identification by a bidirectional gated recurrent network over bytes.

Two gated recurrent units read a text's UTF-8 bytes, one forwards and one backwards.  Their states
at a byte give its probabilities by language: every position is labelled, and a
document's probabilities are the mean over all its positions.  Training is numpy, by
backpropagation through time, on a bounded sample of labelled spans.

Long texts are cut into spans of ``SPAN`` bytes that are read side by side; all bytes count.
The squashing function is x / (1 + |x|), for gates moved to 0..1, as it costs far less than
exponentials.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isopleth.llm.common import LETTER, bounded, crc_bucket

UNKNOWN = "und"
HIDDEN = 8
SPAN = 128
#: Spans that are read side by side.
BATCH = 4096
# Bounds of the training sample: documents of a language, languages with that many (of more
# languages each has fewer documents), characters of a document.
FULL_LANGS = 64
DOCS_PER_LANG = 400
DOC_BYTES = 2048
TRAIN_SPAN = 64
TRAIN_BATCH = 128
TRAIN_STEPS = 260
RATE = 0.02
SEED = 11


def _squash(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


@dataclass
class Network:
    """Parameters by name; column layout, so that arrays run along the spans of a batch.

    For d in f(orwards), b(ackwards): x_d (3H, 256) input by byte, u_d (3H, H) recurrent;
    rows are update gate, reset gate, candidate.  v (K, 2H) and c (K, 1) give the labels.
    """

    langs: list[str]
    p: dict[str, np.ndarray]

    @staticmethod
    def fresh(langs: list[str], hidden: int = HIDDEN, seed: int = SEED) -> Network:
        rng = np.random.default_rng(seed)
        p = {}
        for d in "fb":
            p[f"x_{d}"] = rng.normal(0, 0.3, (3 * hidden, 256))
            p[f"u_{d}"] = rng.normal(0, 1 / np.sqrt(hidden), (3 * hidden, hidden))
        p["v"] = rng.normal(0, 0.3, (len(langs), 2 * hidden))
        p["c"] = np.zeros((len(langs), 1))
        return Network(langs, {k: a.astype(np.float32) for k, a in p.items()})

    def _step(self, d: str, byte: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        n = len(h)
        x = np.take(self.p[f"x_{d}"], byte, axis=1)
        a = self.p[f"u_{d}"] @ h
        s = x[: 2 * n] + a[: 2 * n]
        gate = np.abs(s)
        gate += 1
        np.divide(s, gate, out=gate)
        gate *= 0.5
        gate += 0.5
        z, r = gate[:n], gate[n:]
        y = r * a[2 * n :]
        y += x[2 * n :]
        cand = np.abs(y)
        cand += 1
        np.divide(y, cand, out=cand)
        new = h - cand
        new *= z
        new += cand
        return new, z, r, cand, a[2 * n :]

    def probabilities(self, spans: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """(K, n) sums over the positions of each span of the label probabilities."""
        n, length = spans.shape
        hidden = self.p["u_f"].shape[1]
        spans = np.ascontiguousarray(spans.T)
        back = np.empty((length, hidden, n), np.float32)
        h = np.zeros((hidden, n), np.float32)
        padded = lengths < length
        for t in range(length - 1, -1, -1):
            h = self._step("b", spans[t], h)[0]
            if padded.any():
                h[:, lengths <= t] = 0
            back[t] = h
        vf, vb = self.p["v"][:, :hidden], self.p["v"][:, hidden:]
        total = np.zeros((len(self.langs), n), np.float32)
        h = np.zeros((hidden, n), np.float32)
        for t in range(length):
            h = self._step("f", spans[t], h)[0]
            y = vf @ h
            y += vb @ back[t]
            y += self.p["c"]
            np.minimum(y, 60, out=y)
            np.exp(y, out=y)
            y /= y.sum(axis=0)
            if padded.any():
                y[:, lengths <= t] = 0
            total += y
        return total

    def document_probabilities(self, texts: list[str]) -> np.ndarray:
        """(documents, K) mean probabilities over all bytes; zeros for empty texts."""
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        sizes = np.array([len(b) for b in raw], np.int64)
        counts = -(-sizes // SPAN)
        flat = np.zeros(int(counts.sum()) * SPAN, np.uint8)
        begin = np.concatenate([[0], np.cumsum(counts)]) * SPAN
        for b, at in zip(raw, begin):
            flat[at : at + len(b)] = np.frombuffer(b, np.uint8)
        spans = flat.reshape(-1, SPAN)
        owner = np.repeat(np.arange(len(raw)), counts)
        first = np.repeat(begin[:-1] // SPAN, counts)
        lengths = np.minimum(SPAN, sizes[owner] - (np.arange(len(owner)) - first) * SPAN)
        out = np.zeros((len(raw), len(self.langs)))
        for k in range(0, len(spans), BATCH):
            part = self.probabilities(spans[k : k + BATCH], lengths[k : k + BATCH])
            np.add.at(out, owner[k : k + BATCH], part.T)
        return out / np.maximum(sizes, 1)[:, None]

    def gradients(self, spans: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over all positions and its gradients, by backpropagation through time."""
        n, length = spans.shape
        hidden = self.p["u_f"].shape[1]
        spans = spans.T
        states: dict[str, list] = {}
        for d, order in (("f", range(length)), ("b", range(length - 1, -1, -1))):
            h = np.zeros((hidden, n), np.float32)
            states[d] = [None] * length
            for t in order:
                new, z, r, cand, rec = self._step(d, spans[t], h)
                states[d][t] = (h, new, z, r, cand, rec)
                h = new
        g = {k: np.zeros_like(a) for k, a in self.p.items()}
        want = np.zeros((len(self.langs), n), np.float32)
        want[labels, np.arange(n)] = 1
        loss, out = 0.0, [None] * length
        for t in range(length):
            both = np.concatenate([states["f"][t][1], states["b"][t][1]])
            y = self.p["v"] @ both + self.p["c"]
            y = np.exp(y - y.max(axis=0))
            y /= y.sum(axis=0)
            loss -= float(np.log(np.maximum(y[labels, np.arange(n)], 1e-9)).mean()) / length
            dy = (y - want) / (n * length)
            g["v"] += dy @ both.T
            g["c"] += dy.sum(axis=1, keepdims=True)
            out[t] = self.p["v"].T @ dy
        for d, order, rows in (("f", range(length - 1, -1, -1), slice(0, hidden)), ("b", range(length), slice(hidden, None))):
            dh = np.zeros((hidden, n), np.float32)
            u = self.p[f"u_{d}"]
            for t in order:
                h, _, z, r, cand, rec = states[d][t]
                dh = dh + out[t][rows]
                dcand = dh * (1 - z) * (1 - np.abs(cand)) ** 2
                dz = dh * (h - cand) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
                dr = dcand * rec * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
                da = np.concatenate([dz, dr, dcand])
                drec = np.concatenate([dz, dr, dcand * r])
                np.add.at(g[f"x_{d}"].T, spans[t], da.T)
                g[f"u_{d}"] += drec @ h.T
                dh = dh * z + u.T @ drec
        return loss, g


def train(texts: list[str], labels: list[str], steps: int = TRAIN_STEPS, seed: int = SEED) -> Network:
    """Network for the languages of ``labels``; all languages weigh the same."""
    langs = sorted(set(labels))
    net = Network.fresh(langs, seed=seed)
    if len(langs) < 2:
        return net
    rng = np.random.default_rng(seed)
    own = [[t.encode("utf-8", "surrogatepass") for t, x in zip(texts, labels) if x == lang] for lang in langs]
    mean = {k: np.zeros_like(a) for k, a in net.p.items()}
    square = {k: np.zeros_like(a) for k, a in net.p.items()}
    for step in range(1, steps + 1):
        y = rng.integers(0, len(langs), TRAIN_BATCH)
        x = np.full((TRAIN_BATCH, TRAIN_SPAN), 32, np.uint8)
        for k, lang in enumerate(y):
            raw = own[lang][rng.integers(len(own[lang]))]
            at = rng.integers(0, max(1, len(raw) - TRAIN_SPAN + 1))
            part = np.frombuffer(raw[at : at + TRAIN_SPAN], np.uint8)
            x[k, : len(part)] = part
        _, g = net.gradients(x, y)
        norm = np.sqrt(sum(float((a * a).sum()) for a in g.values()))
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, a in g.items():
            a *= min(1.0, 1.0 / max(norm, 1e-9))
            mean[k] += 0.1 * (a - mean[k])
            square[k] += 0.01 * (a * a - square[k])
            net.p[k] -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
    return net


def training_sample(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_lang: int = DOCS_PER_LANG
) -> tuple[list[str], list[str]]:
    """Spans and languages of labelled documents outside the held-out third.

    At most ``per_lang`` distinct texts of each language and at least one, chosen by a hash of the
    text, and of each at most ``DOC_BYTES`` characters from a hashed place.  Copies count once.
    With more than ``FULL_LANGS`` languages each has so many fewer that the sample grows no further.
    """
    known = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    known = known.filter(F.col("lang").isNotNull() & (crc_bucket("doc_id", 3) != 1))
    known = known.filter(F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}"))
    place = F.xxhash64(F.lit(SEED), "text")
    unit = F.pmod(place, F.lit(1 << 30)) / float(1 << 30)
    distinct = known.select("lang", place.alias("h"), unit.alias("unit")).distinct()
    counts = distinct.groupBy("lang").agg(F.count("*").alias("n"), F.min("unit").alias("least")).collect()
    if not counts:
        return [], []
    per_lang = max(1, min(per_lang, per_lang * FULL_LANGS // len(counts)))
    # thin out to a few more than wanted; the text of the least hash always stays
    limit = {r["lang"]: max(r["least"], min(1.0, 1.3 * per_lang / r["n"])) for r in counts}
    share = F.create_map(*[F.lit(x) for item in limit.items() for x in item])
    picked = known.filter(unit <= share[F.col("lang")])
    start = F.pmod(F.xxhash64(F.lit(SEED + 1), "text"), F.greatest(F.length("text") - DOC_BYTES, F.lit(1))).cast("int") + 1
    rows = picked.select(F.substring("text", start, F.lit(DOC_BYTES)).alias("text"), "lang", place.alias("h"))
    rows = rows.groupBy("lang", "h").agg(F.min("text").alias("text"))
    # after thinning a language has little more than per_lang rows
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    rows = rows.withColumn("rank", rank).filter(F.col("rank") <= per_lang).orderBy("h", "lang").collect()
    return [r["text"] for r in rows], [r["lang"] for r in rows]


def _labeller(net: Network):
    @F.pandas_udf("lang_pred string, score double")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            parts = []
            for part in bounded(texts):
                own = [t if t and LETTER.search(t) else "" for t in part]
                p = net.document_probabilities(own) if net.langs else np.zeros((len(own), 1))
                best = p.argmax(axis=1)
                known = [bool(t) and bool(net.langs) for t in own]
                parts.append(
                    pd.DataFrame(
                        {
                            "lang_pred": [net.langs[b] if k else UNKNOWN for b, k in zip(best, known)],
                            "score": np.where(known, np.clip(p.max(axis=1), 0, 1), 0.0),
                        }
                    )
                )
            yield pd.concat(parts, ignore_index=True) if parts else pd.DataFrame({"lang_pred": [], "score": []}).astype({"lang_pred": str})

    return label


def identify_languages(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", net: Network | None = None
) -> DataFrame:
    """Language of every whole text: doc_id, held_out, lang_pred, score (one row per input row).

    ``held_out`` marks the third of the documents (by crc32 of the id) that training never
    sees; lang is used in training only.  ``und`` with score 0 if the text is NULL or has no
    letter, or nothing could be learned.  Repeated rows give repeated results; further
    columns are ignored; an empty table gives no rows.  Nothing but the sample is shuffled.
    """
    net = net or train(*training_sample(docs, doc_id, text, lang))
    out = docs.select(F.col(doc_id).alias("doc_id"), _labeller(net)(F.col(text)).alias("p"))
    return out.select("doc_id", (crc_bucket("doc_id", 3) == 1).alias("held_out"), "p.*")


def keep_known_languages(
    docs: DataFrame,
    min_score: float = 0.3,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    net: Network | None = None,
) -> DataFrame:
    """Rows of ``docs`` whose language is known with at least ``min_score``, the pooled probability."""
    net = net or train(*training_sample(docs, doc_id, text, lang))
    verdict = _labeller(net)(F.col(text))
    return docs.filter((verdict["lang_pred"] != UNKNOWN) & (verdict["score"] >= min_score))
