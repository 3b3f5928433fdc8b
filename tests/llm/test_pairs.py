"""Fuzzy hashing, components, near duplicates and repeated passages against plain versions."""

import hashlib
import os
import random
import sys
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from isopleth.llm import golay, simhash, substring
from isopleth.llm.common import table
from isopleth.llm.components import components
from isopleth.llm.queries import QUERIES

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_code_is_perfect_and_near_words_share_a_key():
    words = np.random.default_rng(1).integers(0, 1 << 23, 2000)
    idx, real = golay.keys(words)
    assert real.any(axis=1).all() and real.sum(axis=1).max() <= 6
    for bit in range(23):
        other, there = golay.keys(words ^ (1 << bit))
        for k in range(0, 2000, 50):
            assert set(idx[k][real[k]]) & set(other[k][there[k]])


@given(st.integers(0, 2**64 - 1), st.integers(0, 63), st.integers(0, 63))
@settings(max_examples=150, deadline=None)
def test_prints_within_two_bits_share_a_bucket(fp, a, b):
    rows, keys = simhash.bucket_keys(np.array([fp, fp ^ (1 << a) ^ (0 if a == b else 1 << b)], np.uint64))
    assert set(keys[rows == 0]) & set(keys[rows == 1])


def roots(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root}


def test_components(spark):
    rng = random.Random(3)
    pairs = [(k, k + 1) for k in range(60)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(200)]
    pairs += [(500, k) for k in range(501, 560)]
    pairs = [p for p in pairs if p[0] != p[1]]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == roots(pairs)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("pairwise", [2, 64])
def test_links_join_the_same_prints_either_way(spark, pairwise):
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(50)}
    for p in list(prints)[:12]:
        for _ in range(20):
            q = p
            for _ in range(rng.randrange(4)):
                q ^= 1 << rng.randrange(64)
            prints.add(q)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    near = [(signed[i], signed[j]) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    links = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), pairwise)
    assert roots([tuple(r) for r in links.collect()]) == roots(near)


def plain_print(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    count = Counter(b for s in parts for h in [xxhash.xxh64_intdigest(s, 42)] for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * count[b] > len(parts))


def test_simhash_query_against_plain(spark):
    prints = {r.doc_id: plain_print(r.text) for r in table(spark, SF, "documents").collect()}
    want = roots([(a, b) for a in prints for b in prints if (prints[a] ^ prints[b]).bit_count() <= 2])
    for r in QUERIES["op3_simhash"](spark, SF).collect():
        assert (int(r.fingerprint, 16), r.component_id) == (prints[r.doc_id], want[r.doc_id])


def test_near_duplicate_edges(awkward, nothing):
    rows = simhash.near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    assert all(r.component_id == 0 for r in rows if r.doc_id in (0, 1, 2))  # no words: fingerprint zero
    kept = simhash.drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({r.component_id for r in rows if r.component_id is not None})
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.drop_near_duplicates(nothing).count() == 0


def near_texts(seed, texts=60, copies=8):
    """Texts and copies of them in which a few words are changed, one to three groups a text."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(4))
    out = ["", None, "one two", "One  two", "one two three"]
    for k in range(texts):
        base = [word() for _ in range(rng.randrange(6, 400))]
        out.append(" ".join(base))
        for _ in range(copies if k % 3 else 1):
            w = list(base)
            for _ in range(rng.randrange(1 + len(w) // 25)):
                w[rng.randrange(len(w))] = word()
            out.append(" ".join(w))
    return out


def plain_sets(texts):
    words = [(t or "").lower().split() for t in texts]
    return [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for w in words]


def alike(sets):
    """All pairs of similarity 0.8 or more; texts without words are alike."""
    return [(i, j) for j in range(len(sets)) for i in range(j) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]


def test_set_keys_have_the_recall_of_all_pairs():
    texts = near_texts(1, 150)
    sets = plain_sets(texts)
    keys, real, sketch = simhash.set_keys(np.stack([simhash.minimum_hashes(simhash.shingle_set(t, 5)) for t in texts]))
    own = [set(k[r].tolist()) for k, r in zip(keys, real)]
    bits = lambda i, j: int(np.bitwise_count(sketch[i] ^ sketch[j]).sum())
    pairs = [(i, j) for i, j in alike(sets) if sets[i] != sets[j]]
    found = [(i, j) for i, j in pairs if own[i] & own[j] and bits(i, j) <= simhash.most_bits(0.8)]
    assert len(pairs) > 300 and len(found) >= 0.995 * len(pairs)


def test_similar_texts_are_grouped_as_by_all_pairs(spark):
    texts = near_texts(2)
    sets = plain_sets(texts)
    want = roots(alike(sets))
    docs = spark.createDataFrame(list(enumerate(texts)) + [(7, texts[7])], "doc_id long, text string").repartition(4)
    rows = simhash.near_duplicates(docs, size=5, similarity=0.8).collect()
    assert len(rows) == len(texts) + 1
    assert {r.doc_id: r.component_id for r in rows} == {k: want.get(k, k) for k in range(len(texts))}
    kept = simhash.drop_near_duplicates(docs, size=5, similarity=0.8)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({want.get(k, k) for k in range(len(texts))})


def _changed(rng, base, n, vocabulary=5000):
    out = list(base)
    for k in rng.sample(range(len(base)), n):
        out[k] = f"w{rng.randrange(vocabulary)}"
    return " ".join(out)


def test_large_groups_give_candidates_in_proportion(spark):
    """Texts that differ a little too much: their buckets are large, no pair passes, and still no square of them meets."""
    rng = random.Random(8)
    base = [f"b{k}" for k in range(200)]
    counts = {}
    for m in (800, 1600):
        docs = spark.createDataFrame([(k, _changed(rng, base, 7)) for k in range(m)], "doc_id long, text string")
        s = docs.select("doc_id", simhash._sketches(5)("text").alias("s")).select("doc_id", F.col("s.node").alias("node"), "s.keys", "s.heads")
        first, later = simhash.candidates(simhash.store(s, "nodes"))
        counts[m] = first.count() + later.count()
    assert counts[1600] <= 2.6 * counts[800] and counts[1600] < 0.15 * 1600 * 1599 / 2


def test_pairs_in_large_buckets_are_found(spark):
    """Pairs of near copies that stand among many texts with much of the same wording."""
    rng = random.Random(9)
    base = [f"b{k}" for k in range(200)]
    texts = []
    for _ in range(150):
        one = _changed(rng, base, 16).split()
        texts += [" ".join(one), " ".join([*one[:100], "changed", *one[101:]])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs, size=5, similarity=0.8).collect()}
    found = sum(got[2 * k] == got[2 * k + 1] for k in range(150))
    assert found >= 0.95 * 150


def test_large_groups_are_joined_through_few_pairs(spark, monkeypatch):
    """Texts about as alike as the similarity asks: the joins of all pairs but one in a hundred, from pairs in proportion."""
    rng = random.Random(10)
    base = [f"b{k}" for k in range(200)]
    texts = [_changed(rng, base, rng.choice((1, 2, 4, 5, 6, 7))) for _ in range(800)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = []

    def counted(df, label, real=simhash.store):
        out = real(df, label)
        if label == "pairs":
            made.append(out.count())
        return out

    monkeypatch.setattr(simhash, "store", counted)
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs, size=5, similarity=0.8).collect()}
    want = roots(alike(plain_sets(texts)))
    want = {k: want.get(k, k) for k in range(len(texts))}
    assert all(want[k] == want[c] for k, c in got.items())
    groups, joined = len(set(want.values())), len(texts) - len(set(want.values()))
    assert len(set(got.values())) - groups <= 0.01 * joined
    assert sum(made[:2]) <= 55 * len(texts)


def _block(*members):
    return pd.DataFrame({"members": [np.array(members, np.int64).ravel()]})


def _meet(most, *members):
    (found,) = simhash._meeting(most, len(members[0]))(iter([_block(*members)]))
    return [tuple(r) for r in found.itertuples(index=False)]


def test_members_of_a_block_meet_their_nearest():
    few = [(7, 7, 0b0), (3, 3, 0b1), (5, 5, 0b111)]
    assert _meet(2, *few) == [(3, 5), (3, 7)]  # up to SMALL: all pairs near enough
    assert _meet(2, *[(n, 3, w) for n, _, w in few]) == []  # joined already
    many = [(n, n, (1 << n) - 1) for n in range(simhash.SMALL + 3)]
    assert _meet(1, *many) == [(n, n + 1) for n in range(len(many) - 2)] + [(len(many) - 2, len(many) - 1)]
    assert _meet(0, *many) == []
    same = [(n, n, 5) for n in range(-4, 5)]
    assert _meet(0, *same) == [(-4, n) for n in range(-3, 5)]  # copies meet one of them, not each other
    assert _meet(3, *[(n, min(n, 0), w) for n, _, w in same]) == [(-4, n) for n in range(-3, 5)]


def test_pairs_of_large_buckets_are_bound_by_their_entries(spark):
    """A member of a large block gives one pair at most, however many it stands with."""
    rng = random.Random(11)
    base = [f"b{k}" for k in range(200)]
    docs = spark.createDataFrame([(k, _changed(rng, base, 7)) for k in range(1600)], "doc_id long, text string")
    nodes = simhash.store(docs.select(simhash._sketches(5)("text").alias("s")).select("s.*"), "nodes")
    first, members = simhash.candidates(nodes, simhash.most_bits(0.8))
    none = spark.createDataFrame([], "node long, root long")
    later = simhash.later_candidates(members, none, simhash.most_bits(0.8))
    entries = nodes.agg(F.sum(F.size("keys"))).first()[0]
    assert members.count() <= entries and first.count() <= entries and later.count() <= (1 + simhash.REFINING) * entries
    assert first.count() + later.count() < 0.1 * 1600 * 1599 / 2


def test_similar_edges(awkward, nothing):
    rows = simhash.near_duplicates(awkward, size=5, similarity=0.8).collect()
    assert len(rows) == awkward.count() and all(r.component_id == 0 for r in rows if r.doc_id in (0, 1, 2))
    kept = simhash.drop_near_duplicates(awkward, size=5, similarity=0.8)
    assert kept.columns == awkward.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([0, 4, 5, 7, 8, None], key=str)
    assert simhash.drop_near_duplicates(nothing, size=5, similarity=0.8).count() == 0


def test_pipeline_stage_drops_near_copies(spark):
    texts = near_texts(3, 20)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()}
    want = roots(alike(plain_sets(texts)))
    assert kept == {want.get(k, k) for k in range(len(texts))}


# -- repeated passages ------------------------------------------------------------------


def plain_repeats(texts):
    words = [(t or "").encode().split() for t in texts]
    n = Counter(tuple(w[k : k + 35]) for w in words for k in range(len(w) - 34))
    out = []
    for w in words:
        gone = {k + d for k in range(len(w) - 34) if n[tuple(w[k : k + 35])] > 1 for d in range(35)}
        left = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((len(w), len(gone), hashlib.sha256(left).hexdigest()))
    return out


def test_repeats_against_plain(spark):
    rng = random.Random(9)
    word = lambda: rng.choice("abcdefgh") * rng.randrange(1, 4)
    shared = [word() for _ in range(60)]
    texts = []
    for k in range(40):
        own = [word() for _ in range(rng.randrange(0, 120))]
        cut = rng.randrange(0, 30)
        texts.append(" ".join(own[:50] + shared[cut : cut + rng.randrange(30, 45)] + own[50:]))
    texts += [" ".join(shared), " ".join(shared), " ".join(shared[:34]), "x " * 80, None, "", " ".join(shared[:35]) + " tail"]
    rows = list(enumerate(texts))
    rows[3] = (None, texts[3])
    got = substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    want = plain_repeats(texts)
    assert Counter(tuple(r) for r in got) == Counter((i, *w) for (i, _), w in zip(rows, want))


def test_repeats_edges(awkward, nothing):
    rows = substring.remove_repeats(awkward, texts=True).collect()
    assert len(rows) == awkward.count()
    assert {r.n_removed for r in rows if r.doc_id == 5} == {60}
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in rows)
    assert substring.remove_repeats(nothing).count() == 0


def test_repeated_rows_are_extended_once(spark, monkeypatch):
    sizes = {}

    def noted(df, label, keep=substring.store):
        out = keep(df, label)
        sizes[label] = out.count()
        return out

    monkeypatch.setattr(substring, "store", noted)
    text = " ".join(f"w{k}" for k in range(50))
    rows = [(1, text)] * 5 + [(None, text + " end")] * 4
    got = substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed) for r in got) == {(1, 50, 50): 5, (None, 51, 51): 4}
    assert sizes["seeds"] == 2 and sizes["windows"] <= 16 + 17
