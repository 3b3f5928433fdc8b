"""Benchmark decontamination by latent semantic retrieval.

All passages of the benchmark and of every document form a TF-IDF matrix, in which both sides
have the same total weight.  Its leading right singular vectors come from a distributed randomised
SVD: a random sketch is multiplied by A'A, partition by partition, and only matrices of (terms of
a benchmark block) x (rank) reach the driver.  Every window of every document is projected, and
windows whose cosine with a passage is high are candidates.  A candidate counts if the longest common
subsequence covers most of the passage and its answer words are there; so copies with
changed, added or lost words are found too.

The benchmark is a stated query set: it is taken in blocks of bounded size, each of
which passes over all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isopleth.llm.common import BLANK, discard, store

#: Words of the benchmark that one pass over the documents handles, about.
BLOCK_WORDS = 60_000
#: Longest passage; longer items are cut into several.
PASSAGE = 64
#: Window lengths, each twice the last; a passage uses the first that holds it.
SCALES = (16, 32, 64)
RANK = 128
OVERSAMPLE = 12
POWER = 1
#: Passages that one product of the SVD takes, and words whose windows are projected at once, about.
STEP_PASSAGES = 64
STEP_WORDS = 1 << 15
#: Bytes of text that become term numbers at once, about, and half windows whose vectors are summed at once.
STEP_TEXT = 1 << 20
STEP_HALVES = 1 << 9
#: Terms whose sums go from task to task in one piece.
STEP_TERMS = 64
MIN_COSINE = 0.4
MIN_COMMON = 0.65
#: Share of a passage's words, rarest first, that count as its answer, and share of them that must be there.
ANSWER_SHARE = 0.25
MIN_ANSWER = 0.5
SEED = 17


def tokens(text: str | None) -> list[str]:
    """Lower-cased words without punctuation at their ends."""
    return [w for w in (x.strip(PUNCTUATION) for x in text.lower().split()) if w] if text else []


PUNCTUATION = ".,;:!?\"'()[]{}*#$%&|<>-_"


def passages(words: list[str]) -> list[list[str]]:
    """An item's words in passages of at most ``PASSAGE`` words and about equal length."""
    n = -(-len(words) // PASSAGE)
    return [words[len(words) * k // n : len(words) * (k + 1) // n] for k in range(n)]


def common_length(a: list, b: list) -> int:
    """Length of the longest common subsequence, by one bit row over ``a`` for each word of ``b``."""
    masks: dict = {}
    for k, w in enumerate(a):
        masks[w] = masks.get(w, 0) | 1 << k
    full = row = (1 << len(a)) - 1
    for w in b:
        if m := masks.get(w):
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


@dataclass
class Index:
    """A benchmark block in latent space; words are term numbers."""

    vocabulary: dict[str, int]
    vectors: np.ndarray  # (terms + 1, rank): idf times the singular vectors, last row zero
    items: list  # item id by passage
    texts: list[list[int]]
    latent: np.ndarray  # (passages, rank), unit length
    answers: list[set[int]]
    telling: np.ndarray  # by term: whether it is an answer word of a passage


def runs(sizes: np.ndarray, limit: int) -> Iterator[slice]:
    """Runs of rows whose sizes add up to about ``limit``, so that a batch is never handled as a whole."""
    ends = np.cumsum(sizes, dtype=np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(ends // limit)) + 1).tolist(), len(ends)]
    return (slice(a, b) for a, b in zip(cuts, cuts[1:]) if a < b)


def lengths(texts: pa.Array) -> np.ndarray:
    """Bytes of texts or items of lists; NULL has none."""
    count = pc.list_value_length if pa.types.is_nested(texts.type) else pc.binary_length
    return pc.fill_null(count(texts), 0).to_numpy(zero_copy_only=False)


def term_lists(texts: pa.Array, vocabulary: pa.Array) -> pa.Array:
    """Term number of each of the ``tokens`` of every text; words outside the vocabulary have the number after the last."""
    lower = pa.array([t.lower() if t else "" for t in texts.to_pylist()], pa.string())
    words = pc.utf8_split_whitespace(lower)
    bare = pc.ascii_trim(words.flatten(), PUNCTUATION)
    there = lengths(bare) > 0
    terms = pc.fill_null(pc.index_in(bare, vocabulary), len(vocabulary)).to_numpy()[there]
    ends = np.append(0, np.cumsum(there))[words.offsets.to_numpy()]
    return pa.ListArray.from_arrays(ends.astype(np.int32), terms)


def term_arrays(lists: pa.Array) -> list[np.ndarray]:
    """The lists one by one; NULL is empty."""
    flat, size = lists.flatten().to_numpy(), lengths(lists)
    ends = np.cumsum(size)
    return [flat[a:b] for a, b in zip(ends - size, ends)]


def terms_of(text: str | None, vocabulary: dict[str, int]) -> np.ndarray:
    """``term_lists`` of one text."""
    return term_arrays(term_lists(pa.array([text], pa.string()), pa.array(list(vocabulary), pa.string())))[0]


def _coder(vocabulary: dict[str, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Term numbers in place of the texts in the last column, ``STEP_TEXT`` bytes of text after the other."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = pa.array(list(vocabulary), pa.string())
        for batch in batches:
            *rest, texts = batch.columns
            for step in runs(lengths(texts), STEP_TEXT):
                own = [*[c[step] for c in rest], term_lists(texts[step], words)]
                yield pa.RecordBatch.from_arrays(own, [*batch.schema.names[:-1], "terms"])

    return code


def with_terms(docs: DataFrame, text: str, vocabulary: dict[str, int]) -> DataFrame:
    """The documents with ``terms``, the term numbers of all their words in order, in place of the text."""
    others = [c for c in docs.columns if c != text]
    kinds = T.StructType([*[docs.schema[c] for c in others], T.StructField("terms", T.ArrayType(T.IntegerType()))])
    return docs.select(*others, F.col(text).cast("string")).mapInArrow(_coder(vocabulary), kinds)


def document_frequencies(docs: DataFrame, terms: int) -> tuple[np.ndarray, int]:
    """Number of documents, over all of them, that hold each term, and number of their passages."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(terms + 1, np.int64)
        for pdf in batches:
            for t in pdf["terms"]:
                total[:terms] += np.bincount(t, minlength=terms + 1)[:terms] > 0
                total[terms] += -(-len(t) // PASSAGE)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"term": at, "n": total[at]})

    counted = docs.select("terms").mapInPandas(count, "term long, n long")
    out = np.zeros(terms + 1, np.int64)
    for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect():  # at most one row a term of the block
        out[r["term"]] = r["n"]
    return out[:terms], int(out[terms])


def _matrix(rows: np.ndarray, ids: np.ndarray, weights: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Terms that occur, and the dense (n, terms that occur) matrix of the summed entries."""
    at = np.bincount(ids) > 0
    cols, place = np.flatnonzero(at), np.cumsum(at) - 1
    x = np.bincount(rows * len(cols) + place[ids], weights, n * len(cols))
    return cols, x.reshape(n, len(cols))


def given_rows(pdf: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows as they are: ids array<int>, weights array<double>."""
    for k in range(0, len(pdf), STEP_PASSAGES):
        part = pdf.iloc[k : k + STEP_PASSAGES]
        rows = np.repeat(np.arange(len(part)), part["ids"].str.len())
        if len(rows):
            yield _matrix(rows, np.concatenate(list(part["ids"])), np.concatenate(list(part["weights"])), len(part))


def passage_rows(idf: np.ndarray) -> Callable[[pd.DataFrame], Iterator[tuple[np.ndarray, np.ndarray]]]:
    """TF-IDF, of length ``weight``, of every passage of the texts: terms array<int>, weight double."""

    def rows_of(pdf: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        size = pdf["terms"].str.len().to_numpy(np.int64)
        if not size.sum():
            return
        ids = np.concatenate(list(pdf["terms"]))
        n = -(-size // PASSAGE)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        doc = np.repeat(np.arange(len(size)), n)
        start = (np.cumsum(size) - size)[doc] + size[doc] * k // n[doc]  # as ``passages`` cuts
        ends = np.append(start[1:], len(ids))
        weight = pdf["weight"].to_numpy()[doc]
        for a in range(0, len(start), STEP_PASSAGES):
            b = min(a + STEP_PASSAGES, len(start))
            own = ids[start[a] : ends[b - 1]]
            known = own < len(idf)
            if known.any():
                row, own = np.repeat(np.arange(b - a), ends[a:b] - start[a:b])[known], own[known]
                cols, x = _matrix(row, own, idf[own], b - a)
                norm = np.sqrt((x * x).sum(axis=1))
                yield cols, (x * (weight[a:b] / np.where(norm > 0, norm, 1))[:, None]).astype(np.float32)

    return rows_of


def randomised_svd(
    rows: DataFrame,
    terms: int,
    rank: int = RANK,
    power: int = POWER,
    seed: int = SEED,
    matrices: Callable[[pd.DataFrame], Iterator[tuple[np.ndarray, np.ndarray]]] = given_rows,
) -> np.ndarray:
    """Leading right singular vectors (terms, rank) of the sparse rows.

    ``matrices`` turns a batch of the frame into dense pieces: terms that occur, and rows over them.
    """
    width = min(rank + OVERSAMPLE, terms)
    basis = np.random.default_rng(seed).normal(size=(terms, width))

    def multiply(basis: np.ndarray) -> np.ndarray:
        """A'A times the basis."""

        def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            out = np.zeros_like(basis)
            for pdf in batches:
                own = now = None  # in the precision of the pieces, for one batch
                for cols, x in matrices(pdf):
                    if own is None:
                        own, now = np.zeros(basis.shape, x.dtype), basis.astype(x.dtype)
                    own[cols] += x.T @ (x @ now[cols])
                if own is not None:
                    out += own
            yield pd.DataFrame([(k, out[at : at + STEP_TERMS].tobytes()) for k, at in enumerate(range(0, terms, STEP_TERMS))], columns=["block", "sums"])

        def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total: dict[int, np.ndarray] = {}
            for pdf in batches:
                for k, raw in zip(pdf["block"], pdf["sums"]):
                    total[k] = total.get(k, 0) + np.frombuffer(raw)
            yield pd.DataFrame([(k, x.tobytes()) for k, x in total.items()], columns=["block", "sums"])

        # all sums of a block of terms meet in one partition, which adds them up as they come
        sums = rows.mapInPandas(part, "block long, sums binary").repartition("block").mapInPandas(add, "block long, sums binary")
        found = sorted((r["block"], bytes(r["sums"])) for r in sums.collect())
        return np.frombuffer(b"".join(x for _, x in found)).reshape(basis.shape)

    for _ in range(power + 1):
        basis, _ = np.linalg.qr(multiply(basis))
    small = basis.T @ multiply(basis)
    values, turns = np.linalg.eigh((small + small.T) / 2)
    return basis @ turns[:, np.argsort(-values)[:rank]]


def build_index(docs: DataFrame, items: list[tuple[object, str]], text: str = "text") -> tuple[Index, DataFrame] | None:
    """Latent index of one benchmark block and the stored ``with_terms`` of all documents; None if it has no words."""
    spark = docs.sparkSession
    cut = [(item, p) for item, t in items for p in passages(tokens(t))]
    if not cut:
        return None
    vocabulary = {w: k for k, w in enumerate(sorted({w for _, p in cut for w in p}))}
    texts = [[vocabulary[w] for w in p] for _, p in cut]
    coded = store(with_terms(docs, text, vocabulary), "terms")
    found, n_passages = document_frequencies(coded, len(vocabulary))
    n = max(int(found.max()), 1)
    idf = np.log((n + 1) / (found + 0.5)) + 0.1

    # each document passage weighs so much that all of them together weigh as much as the benchmark
    share = math.sqrt(len(texts) / max(n_passages, 1))
    own = store(spark.createDataFrame([(t, 1.0) for t in texts], "terms array<int>, weight double"), "passages")
    rank = min(RANK, len(vocabulary))
    rows = coded.select("terms", F.lit(share).alias("weight")).union(own)
    right = randomised_svd(rows, len(vocabulary), rank, matrices=passage_rows(idf))
    discard(own)

    vectors = np.zeros((len(vocabulary) + 1, rank), np.float32)
    vectors[:-1] = right * idf[:, None]
    latent = np.array([vectors[t].sum(axis=0) for t in texts])
    latent /= np.maximum(np.linalg.norm(latent, axis=1), 1e-9)[:, None]
    answers = [answer_words(t, idf) for t in texts]
    telling = np.zeros(len(vocabulary) + 1, bool)
    telling[list(set().union(*answers))] = True
    return Index(vocabulary, vectors, [i for i, _ in cut], texts, latent, answers, telling), coded


def answer_words(terms: list[int], idf: np.ndarray) -> set[int]:
    """The rarest words of a passage: what a question asks for is seldom a common word."""
    own = sorted(set(terms), key=lambda t: (-idf[t], t))  # terms are numbered in the order of their words
    return set(own[: max(1, round(ANSWER_SHARE * len(own)))])


def needed_answers(answer: set[int]) -> int:
    return math.ceil(MIN_ANSWER * len(answer))


def _scales(index: Index) -> list[tuple[int, np.ndarray]]:
    """(window length, passages that use it)."""
    sizes = np.array([len(p) for p in index.texts])
    out = []
    for k, scale in enumerate(SCALES):
        low = SCALES[k - 1] if k else 0
        high = scale if scale < SCALES[-1] else PASSAGE
        own = np.flatnonzero((sizes > low) & (sizes <= high))
        if len(own):
            out.append((scale, own))
    return out


def candidates(texts: list[np.ndarray], index: Index, scales: list[tuple[int, np.ndarray]]) -> Iterator[tuple[int, int, int, float]]:
    """(text, passage, window start, cosine) for all windows at or above ``MIN_COSINE``.

    Windows with fewer answer words than any passage of their scale demands can't pass the
    answer check, so they are not projected, nor met with passages that demand more than they have.
    The texts lie one after the other, each on a multiple of the longest window and with more
    blanks behind it than any window or its region reaches.
    """
    longest, none = SCALES[-1], len(index.vocabulary)
    size = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(-(-(size + 2 * longest) // longest) * longest)
    begin = np.append(0, ends[:-1])
    ids = np.full(ends[-1], none, np.int32)
    for at, t in zip(begin, texts):
        ids[at : at + len(t)] = t
    count = np.append(0, np.cumsum(index.telling[ids]))
    demands = {scale: np.array([needed_answers(index.answers[p]) for p in own]) for scale, own in scales}
    windows, wanted = {}, np.zeros(len(ids) // (SCALES[0] // 2), bool)
    for scale, _ in scales:
        half, parts = scale // 2, scale // SCALES[0]  # smallest half windows in a half window
        n = np.where(size > 0, np.maximum(1, -(-(size - half) // half)), 0)
        text = np.repeat(np.arange(len(texts)), n)
        starts = begin[text] + half * (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n))
        first, last = np.maximum(starts - half, 0), np.minimum(starts + scale + half, len(ids))
        told = count[last] - count[first]
        enough = told >= demands[scale].min()
        windows[scale] = text[enough], starts[enough], told[enough]
        for k in (0, 1):
            wanted.reshape(-1, parts)[starts[enough] // half + k] = True
    sums = np.zeros((len(wanted), index.vectors.shape[1]), np.float32)
    halves, at = ids.reshape(len(wanted), -1), np.flatnonzero(wanted)
    for k in range(0, len(at), STEP_HALVES):
        part = at[k : k + STEP_HALVES]
        sums[part] = index.vectors[halves[part]].sum(axis=1)
    own_of = dict(scales)
    for scale in SCALES:
        half = scale // 2
        if scale > SCALES[0]:
            sums = sums[::2] + sums[1::2]  # of half a window each
        if scale not in own_of:
            continue
        own, (text, starts, told) = own_of[scale], windows[scale]
        for k in range(0, len(starts), 1024):
            part = starts[k : k + 1024]
            rows = sums[part // half] + sums[part // half + 1]
            cosine = rows @ index.latent[own].T / np.maximum(np.linalg.norm(rows, axis=1), 1e-3)[:, None]
            for a, b in np.argwhere((cosine >= MIN_COSINE) & (told[k : k + 1024, None] >= demands[scale])):
                which = int(text[k + a])
                yield which, int(own[b]), int(part[a] - begin[which]), float(cosine[a, b])


def verify(words: np.ndarray, passage: list[int], answer: set[int], start: int, scale: int) -> float | None:
    """Share of the passage that its longest common subsequence with the region covers, if it counts."""
    region = words[max(0, start - scale // 2) : start + scale + scale // 2].tolist()
    if len(answer.intersection(region)) < needed_answers(answer):
        return None
    need = MIN_COMMON * len(passage)
    there = Counter(region)
    if sum(min(c, there[w]) for w, c in Counter(passage).items()) < need:
        return None  # the words in any order are no fewer than in the same order
    # a copy is about as long as the passage: look at spans of its length, half a length apart
    span = len(passage) + len(passage) // 2
    best = 0
    for at in range(0, max(1, len(region) - span + len(passage) // 4 + 1), max(1, len(passage) // 4)):
        best = max(best, common_length(passage, region[at : at + span]))
    return best / len(passage) if best >= need else None


def search(texts: list[np.ndarray], index: Index, scales: list[tuple[int, np.ndarray]]) -> list[dict[object, tuple[float, float, int]]]:
    """Best (common share, cosine, window start) by item, for each text, of the items that it holds."""
    scale_of = {int(p): s for s, own in scales for p in own}
    out: list[dict[object, tuple[float, float, int]]] = [{} for _ in texts]
    for which, p, start, cosine in candidates(texts, index, scales):
        share = verify(texts[which], index.texts[p], index.answers[p], start, scale_of[p])
        if share is not None:
            item = index.items[p]
            out[which][item] = max(out[which].get(item, (0.0, 0.0, 0)), (share, cosine, start))
    return out


#: Items that a text holds, as Spark and as Arrow name it.
HITS = "array<struct<item_id: long, common: double, cosine: double, word: int>>"
HITS_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("common", pa.float64()), ("cosine", pa.float64()), ("word", pa.int32())]))


def _searcher(index: Index, coded: bool = False):
    """Items that texts hold, or the terms of texts if ``coded``."""

    @F.arrow_udf(HITS)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scales, words = _scales(index), pa.array(list(index.vocabulary), pa.string())
        for batch in batches:
            out = []
            for step in runs(lengths(batch), STEP_WORDS if coded else STEP_TEXT):
                lists = batch[step] if coded else term_lists(batch[step], words)
                for part in runs(lengths(lists), STEP_WORDS):
                    for hits in search(term_arrays(lists[part]), index, scales):
                        found = sorted(hits.items(), key=lambda kv: (kv[0] is None, kv[0]))
                        out.append([{"item_id": i, "common": x[0], "cosine": x[1], "word": x[2]} for i, x in found])
            yield pa.array(out, HITS_ARROW)

    return find


def indexes(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> Iterator[tuple[Index, DataFrame]]:
    """Latent indexes of the benchmark's blocks, one after the other, each with the documents' terms until the next."""
    own = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    own = own.filter(F.col("text").isNotNull()).distinct()
    words = own.agg(F.sum(F.regexp_count("text", F.lit(f"[^{BLANK}]++")))).first()[0] or 0
    blocks = max(1, -(-int(words) // BLOCK_WORDS))
    if words == 0 or docs.isEmpty():
        return
    for k in range(blocks):
        block = own.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        items = sorted(((r["item_id"], r["text"]) for r in block.collect()), key=lambda x: (x[0] is None, x))
        built = build_index(docs, items, text)
        if built:
            yield built
            discard(built[1])


def find_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Benchmark items in documents: doc_id, item_id, common, cosine, word (first of the window).

    One row for each document row and item found in it; clean documents have none.
    NULL and empty texts hold nothing, NULL benchmark texts are not looked for, equal items
    of other ids are all reported, repeated rows give repeated results.  Further columns are
    ignored.  The documents are never shuffled.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    out = None
    for index, coded in indexes(own, benchmark):
        hits = coded.select("doc_id", F.explode(_searcher(index, coded=True)("terms")).alias("hit")).select("doc_id", "hit.*")
        hits = store(hits, "leaks")
        out = hits if out is None else out.union(hits)
    if out is None:
        out = own.select("doc_id", F.explode(F.lit(None).cast(HITS)).alias("hit")).select("doc_id", "hit.*")
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """Rows of ``docs`` that hold no benchmark item; all columns stay."""
    own = docs.select(F.col(text).alias("text"))
    out = docs
    for index, _ in indexes(own, benchmark):
        out = out.filter(F.size(_searcher(index)(F.col(text))) == 0)
    return out
