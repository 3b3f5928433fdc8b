"""Language identification, toxicity and decontamination: gradients, held-out accuracy, planted cases."""

import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from isopleth.llm import decontam, langid, toxicity
from isopleth.llm.common import table
from isopleth.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_gradients_agree_with_differences():
    net = langid.Network.fresh(["a", "b", "c"], hidden=3)
    net.p = {k: a.astype(np.float64) for k, a in net.p.items()}
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 256, (4, 6)).astype(np.uint8), np.array([0, 1, 2, 1])
    _, g = net.gradients(x, y)
    for name, a in net.p.items():
        at = (rng.integers(a.shape[0]), int(x[0, 0]) if name.startswith("x") else rng.integers(a.shape[1]))
        kept = a[at]
        a[at] = kept + 1e-5
        up, _ = net.gradients(x, y)
        a[at] = kept - 1e-5
        down, _ = net.gradients(x, y)
        a[at] = kept
        assert g[name][at] == pytest.approx((up - down) / 2e-5, rel=0.03, abs=2e-6), name


def test_batching_changes_no_probability():
    net = langid.Network.fresh(["a", "b"])
    texts = ["", "abc", "x" * 1000, "é" * 77, "q" * 128]
    together = net.document_probabilities(texts)
    alone = np.concatenate([net.document_probabilities([t]) for t in texts])
    assert np.allclose(together, alone, atol=1e-5)
    assert np.allclose(together[1:].sum(axis=1), 1, atol=1e-4) and not together[0].any()


def test_language_query(spark):
    lang = {r.doc_id: r.lang for r in table(spark, SF, "documents").collect()}
    rows = QUERIES["op2_language_id"](spark, SF).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(lang) and 0.2 < len(held) / len(rows) < 0.5
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_copies_count_once_and_every_language_is_drawn(spark):
    rows = [(3 * k, f"text number {'x' * (k % 50)} {k} of the first", "aa") for k in range(300)]
    rows += [(3 * k, f"copied words {'y' * (k % 2)}", "bb") for k in range(300, 1500)]
    rows += [(3 * k, f"a rare language {k}", f"l{k % 140:03d}") for k in range(2000, 2280)]
    docs = spark.createDataFrame([(i, t, x) for i, t, x in rows], "doc_id long, text string, lang string").repartition(3)
    docs = docs.filter(langid.crc_bucket("doc_id", 3) != 1)
    want = {x: len({t for _, t, y in docs.collect() if y == x}) for x in {r.lang for r in docs.collect()}}
    texts, langs = langid.training_sample(docs, per_lang=100)
    got = {x: len([y for y in langs if y == x]) for x in want}
    assert len(want) > 64 and len(set(zip(texts, langs))) == len(texts)
    assert got == {x: min(n, 100 * 64 // len(want)) for x, n in want.items()}


def test_language_edges(spark, awkward, nothing):
    net = langid.Network.fresh(["aa", "bb"])
    rows = langid.identify_languages(awkward, net=net).collect()
    assert len(rows) == awkward.count()
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in rows if r.doc_id in (0, 1, 2))
    assert langid.identify_languages(nothing).count() == 0
    unlabelled = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert langid.identify_languages(unlabelled).first().lang_pred == "und"
    kept = langid.keep_known_languages(awkward, net=net)
    assert kept.columns == awkward.columns and {0, 1, 2}.isdisjoint({r.doc_id for r in kept.collect()})


# -- toxicity ---------------------------------------------------------------------------


def test_instances_are_found_from_bag_labels():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    texts, labels = [], []
    for k in range(300):
        s = [" ".join(word() for _ in range(6)) for _ in range(8)]
        if k % 3 == 0:
            s[rng.randrange(8)] += " villain " + word()
        texts.append(". ".join(s))
        labels.append(int(k % 3 == 0))
    model = toxicity.train(texts, labels)
    assert all((model.score(t) >= 0.3) == bool(y) for t, y in zip(texts, labels))
    found = [s for s in model.sentences("all is well. you villain you! fine") if s[2] >= 0.3]
    assert [s[:2] for s in found] == [(12, 28)]


def test_toxicity_query(spark):
    toxic = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
    rows = [r for r in QUERIES["op6_toxicity"](spark, SF).collect()]
    assert len(rows) == table(spark, SF, "documents").count()
    own = [r for r in rows if r.doc_id in toxic and r.held_out]
    hit = sum(r.predicted and toxic[r.doc_id] for r in own)
    assert hit >= 0.6 * sum(toxic[r.doc_id] for r in own)
    assert sum(r.predicted for r in own if not toxic[r.doc_id]) <= 0.05 * len(own)
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)


def test_toxicity_edges(spark, awkward, nothing):
    model = toxicity.Model({"word": 20.0})
    rows = toxicity.score_toxicity(awkward, model=model, sentences=True).collect()
    assert len(rows) == awkward.count()
    assert all(r.score < 0.01 for r in rows if r.doc_id in (0, 1, 2))
    assert [r.predicted for r in rows if r.doc_id is None] == [1]
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    assert {r.score for r in toxicity.score_toxicity(awkward, none).collect()} == {0.0}
    assert toxicity.score_toxicity(nothing, none).count() == 0


# -- decontamination --------------------------------------------------------------------


def plain_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


def test_common_subsequence():
    rng = random.Random(6)
    for _ in range(200):
        a, b = ([rng.choice("abcde") for _ in range(rng.randrange(1, 70))] for _ in range(2))
        assert decontam.common_length(a, b) == plain_common(a, b)


def test_svd_spans_the_leading_directions(spark):
    rng = np.random.default_rng(8)
    a = rng.normal(size=(200, 3)) @ rng.normal(size=(3, 30))
    rows = [(list(range(30)), list(map(float, r))) for r in a]
    v = decontam.randomised_svd(spark.createDataFrame(rows, "ids array<int>, weights array<double>").repartition(3), 30, 3)
    assert np.allclose(a, a @ v @ v.T, atol=1e-6)


def plain_tfidf(cut, idf):
    out = np.zeros((len(cut), len(idf)))
    for row, ids in zip(out, cut):
        for t in ids:
            if t < len(idf):
                row[t] += idf[t]
    return out / np.maximum(np.linalg.norm(out, axis=1), 1e-9)[:, None]


def test_passage_rows_are_those_of_all_passages():
    rng = np.random.default_rng(3)
    texts = [rng.integers(0, 31, n).astype(np.int32) for n in (0, 1, 64, 65, 700, 0, 5000)]
    idf = rng.uniform(0.5, 2, 30)  # term 30 stands for all other words
    cut = [p for t in texts for p in decontam.passages(t.tolist())]
    got = np.zeros((len(cut), 30))
    at = 0
    for cols, x in decontam.passage_rows(idf)(pd.DataFrame({"terms": texts, "weight": 1.0})):
        got[at : at + len(x), cols] = x
        at += len(x)
    assert at == len(cut) and np.allclose(got, plain_tfidf(cut, idf), atol=1e-6)


def test_singular_vectors_come_from_every_document(spark):
    """Sixty of 2500 documents each have a pair of words, near their end, that no other text has together."""
    names = [f"w{k}" for k in range(300)]
    items = [(k, " ".join(names[k * 30 : k * 30 + 30])) for k in range(10)]
    pairs = {40 * k: [names[k], names[100 + k]] * 20 for k in range(60)}
    docs = [(k, ("x " * 450) + " ".join([*pairs.get(k, []), f"y{k}"])) for k in range(2500)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    index, coded = decontam.build_index(frame, items)
    assert coded.count() == 2500
    rows = [decontam.terms_of(t, index.vocabulary).tolist() for _, t in docs]
    assert [list(r.terms) for r in coded.orderBy("doc_id").collect()] == rows
    cut = [p for t in rows for p in decontam.passages(t)]
    found = np.bincount([t for r in rows for t in set(r) if t < 300], minlength=300)
    idf = np.log((found.max() + 1) / (found + 0.5)) + 0.1
    a = np.concatenate([plain_tfidf(index.texts, idf), plain_tfidf(cut, idf) * np.sqrt(len(items) / len(cut))])
    right = index.vectors[:-1] / idf[:, None]
    assert np.allclose(np.linalg.norm(a @ right) ** 2, np.linalg.norm(a) ** 2, rtol=1e-4)  # its rank is far below RANK
    assert np.linalg.norm(a[10:] @ right) ** 2 > 0.99 * np.linalg.norm(a[10:]) ** 2 > 0


def test_term_lists_are_the_numbers_of_the_tokens():
    vocabulary = {w: k for k, w in enumerate(["alpha", "a.b", "ὀδυσσεύς", "i\u0307", "é", "x"])}
    texts = [None, "", " \n", "--- .", "Alpha, (A.B) x\u2003x\x1fx other \"é\"", "ὈΔΥΣΣΕΎΣ ὈΔΥΣΣΕΎΣx İ", "..x..", "x " * 3000, None]
    want = [[vocabulary.get(w, 6) for w in decontam.tokens(t)] for t in texts]
    words = pa.array(list(vocabulary))
    assert decontam.term_lists(pa.array(texts), words).to_pylist() == want
    assert decontam.term_lists(pa.array(texts)[3:6], words).to_pylist() == want[3:6]
    assert [t.tolist() for t in decontam.term_arrays(decontam.term_lists(pa.array(texts), words)[4:])] == want[4:]


def test_a_batch_is_coded_in_steps():
    """The term numbers of about ``STEP_TEXT`` bytes of text leave the task before the next texts are coded."""
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(6000)), "text": ["word other " * 100] * 5999 + [None]})
    coded = list(decontam._coder({"word": 0})(iter([batch])))
    assert max(b.num_rows for b in coded) <= decontam.STEP_TEXT // 1100 + 2
    assert [i for b in coded for i in b["doc_id"].to_pylist()] == list(range(6000))
    assert [t for b in coded for t in b["terms"].to_pylist()] == [[0, 1] * 100] * 5999 + [[]]


def test_runs_cover_all_rows_within_the_limit():
    rng = np.random.default_rng(9)
    for sizes in ([], [0], [5000], [0, 0, 5000, 0, 7, 993, 1], rng.integers(0, 400, 1000)):
        found = list(decontam.runs(np.array(sizes, np.int64), 1000))
        assert [k for r in found for k in range(r.start, r.stop)] == list(range(len(sizes)))
        assert all(sum(sizes[r]) - max(sizes[r]) <= 1000 for r in found)  # but for one long row


def test_only_windows_with_enough_answer_words_are_met():
    """Words around few answer words are as near to the passage, but cannot pass."""
    passage = list(range(12))
    vectors = np.ones((21, 2), np.float32)
    vectors[-1] = 0
    telling = np.zeros(21, bool)
    telling[:4] = True
    other = list(range(12, 20)) + [0] * 4  # a passage that one answer word is enough for
    index = decontam.Index(
        {f"w{k}": k for k in range(20)}, vectors, [7, 8], [passage, other], np.full((2, 2), 0.5**0.5), [{0, 1, 2, 3}, {0}], telling
    )
    scales = decontam._scales(index)
    texts = [np.array(t, np.int32) for t in ([0, *range(5, 16)], passage, [20] * 300 + other, [*range(5, 16)])]
    met = {(which, p) for which, p, _, _ in decontam.candidates(texts, index, scales)}
    assert met == {(0, 1), (1, 0), (1, 1), (2, 0), (2, 1)}
    assert [sorted(h) for h in decontam.search(texts, index, scales)] == [[], [7], [8], []]


def changed(words, rng):
    """About one word in eight replaced, dropped or followed by another."""
    out = []
    for w in words:
        x = rng.random()
        out += ["zzz"] if x < 0.04 else [] if x < 0.08 else [w, "yyy"] if x < 0.12 else [w]
    return out


def test_planted_passages_and_recall_against_brute_force(spark):
    rng = random.Random(7)
    bench = {r.item_id: r.text for r in table(spark, SF, "benchmark").collect()}
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").limit(300).collect()]
    clean = [(i, t) for i, t in docs if not any(p in t for p in bench.values())]
    planted = []
    for k, (item, text) in enumerate(bench.items()):
        host = clean[k % len(clean)][1].split()
        at = rng.randrange(len(host) + 1)
        planted.append((10_000 + item, " ".join(host[:at] + changed(text.split(), rng) + host[at:])))
    both = spark.createDataFrame(clean + planted, "doc_id long, text string").repartition(4)
    got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(both, table(spark, SF, "benchmark")).collect()}
    want = {(10_000 + i, i) for i in bench}
    assert len(want & got) >= 0.9 * len(want)
    assert not {d for d, _ in got} & {i for i, _ in clean}


def test_decontamination_edges(spark, awkward, nothing):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta alpha beta gamma delta"), (2, None), (3, ""), (None, "word")], "item_id long, text string")
    rows = decontam.find_leaks(awkward, bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} >= {(8, 1), (None, None)}
    kept = decontam.drop_leaks(awkward, bench)
    assert kept.columns == awkward.columns and 8 not in {r.doc_id for r in kept.collect()}
    assert decontam.find_leaks(nothing, bench).count() == 0
    assert decontam.find_leaks(awkward, bench.limit(0)).count() == 0
