"""Prefix trie, bit planes and token alignment against plain versions."""

import hashlib
import io
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from isopleth.llm import align, planes, trie
from isopleth.llm.common import table, words
from isopleth.llm.queries import QUERIES
from isopleth.session import new_dir

SF = "/root/testdata/sf0.001"

# -- prefix trie ------------------------------------------------------------------------


def plain_trie(rows, share=True):
    """Nodes of (conv_id, turn, role, text) by walking every prefix."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    seq = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    if share:
        opening = {c: zlib.crc32(str(c).encode()) % 4 for c in seq}
        seq = {c: seq.get(c - c % 20, [])[: opening[c]] + s[opening[c] :] for c, s in seq.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, s in seq.items():
        ends[tuple(s)].append(c)
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    kids, leaves, saved = Counter(), Counter(), Counter()
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, m in members.items():
        cost = (len(m) - 1) * len(words(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += cost
    return sorted(
        (
            min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), kids[p], leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def found_trie(df):
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in map(tuple, df.collect()))


KIND = "conv_id long, turn long, role string, text string, id long, ids string"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], KIND).repartition(3)


def test_trie_equals_plain_version(spark, monkeypatch):
    monkeypatch.setattr(trie, "SHARD_TURNS", 25)  # many shards, many boundary nodes
    rng = random.Random(5)
    rows = []
    for c in range(90):
        shape = [rng.choice("ab") for _ in range(rng.randrange(1, 7))]
        if c % 3 == 0:  # a third are copies of one conversation
            shape = list("abba")
        if c == 41:
            shape = [rng.choice("ab") for _ in range(300)]
        rows += [(c, k, "user" if k % 2 else None, f"{x} word {x}") for k, x in enumerate(shape)]
    convs = conversations(spark, rows)
    coded = trie.encode_turns(convs)
    assert found_trie(trie.prefix_trie(coded)) == plain_trie(rows, share=False)
    assert found_trie(trie.prefix_trie(trie.share_openings(coded))) == plain_trie(rows)


def test_trie_defined_cases(spark):
    rows = [
        (None, 1, "user", "left out"), (1, None, "user", "first"), (1, 2, None, None), (1, 2, None, None), (2, 5, "", ""),
        (3, 1, "u", " \n\t "), (4, 1, "u", "w " * 20_000), (4, 2, "u", "\U0001f600 ü"), (5, 1, "a", "x"), (-7, 1, "a", "x"), (24, 1, "user", "q"),
    ]
    got = found_trie(trie.prefix_trie(trie.share_openings(trie.encode_turns(conversations(spark, rows)))))
    assert got == plain_trie(rows)
    none = conversations(spark, rows).limit(0)
    assert trie.prefix_trie(trie.share_openings(trie.encode_turns(none))).count() == 0


def test_median_insertion_balances_the_children():
    rows = [([k], [1], 1, k) for k in range(1000)]
    tree = trie.build(rows)
    height, stack = 0, [(tree.eq[0], 1)]
    while stack:
        now, h = stack.pop()
        if now != trie.NONE:
            height = max(height, h)
            stack += [(tree.lo[now], h + 1), (tree.hi[now], h + 1)]
    assert height == 10 and sorted(trie.median_order(7)) == list(range(7))


# -- bit planes -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def word_tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


TEXT = st.text(st.one_of(st.sampled_from(" \n\t'aAéÉ́  ᠎​　ﬁΣςß漢1٣<|>_"), st.characters(codec="utf-8")), max_size=60)


@given(TEXT)
@settings(max_examples=300, deadline=None)
def test_words_encode_like_the_whole_text(word_tokenizer, text):
    ids = planes.encoder(public_tokenizers.path("word_bpe_49k.json"))
    whole = word_tokenizer.encode(text, add_special_tokens=False).ids
    assert np.concatenate(list(planes.encode(text, ids))).tolist() == whole


def test_special_strings_and_parts(word_tokenizer, monkeypatch):
    monkeypatch.setattr(planes, "STEP_CHARS", 50)
    ids = planes.encoder(public_tokenizers.path("word_bpe_49k.json"))
    for text in ("a<|endoftext|>b <|startoftext|>", "it's " * 100, "x" * 500 + " y", "no\nblank" * 40):
        assert "".join(planes.pieces(text, 50)) == text
        assert np.concatenate(list(planes.encode(text, ids))).tolist() == word_tokenizer.encode(text, add_special_tokens=False).ids


@given(st.lists(st.integers(0, 2**32 - 1), max_size=40), st.sampled_from([1, 8]))
@settings(max_examples=200, deadline=None)
def test_planes_round_trip(ids, plane):
    ids = np.array(ids, np.uint32)
    assert planes.from_planes(planes.to_planes(ids, plane), len(ids), plane).tolist() == ids.tolist()


@pytest.mark.parametrize("plane", [1, 8])
def test_ranges_of_a_file(monkeypatch, plane):
    monkeypatch.setattr(planes, "BLOCK", 64)
    monkeypatch.setattr(planes, "TABLE_DOCS", 3)
    rng = np.random.default_rng(4)
    out, docs, whole = io.BytesIO(), [], []
    out.close = lambda: None
    writer = planes.PlaneWriter(out, plane)
    for k in range(11):
        ids = rng.integers(0, 50_000, rng.integers(1, 200)).astype(np.uint32)
        writer.document(None if k == 4 else k - 5, writer.add(ids))
        docs.append((None if k == 4 else k - 5, len(ids)))
        whole += ids.tolist()
    writer.close()

    class File(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    reader = planes.PlaneReader(File(out.getvalue()))
    assert list(reader.documents()) == docs
    for start, n in ((0, len(whole)), (63, 2), (64, 64), (100, 333), (len(whole) - 1, 5), (len(whole), 3), (5, 0)):
        assert reader.ids(start, n).tolist() == whole[start : start + n]
    data = bytearray(out.getvalue())
    with pytest.raises(ValueError):
        planes.PlaneReader(File(bytes(data[:-3])))
    data[reader.index["blocks"][0][0] + 12] ^= 255
    with pytest.raises(Exception):
        planes.PlaneReader(File(bytes(data))).block(0)


def plain_ids(tokenizer, docs):
    out, at = [], 0
    for d, t in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_token_planes_query(spark, word_tokenizer):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    got = sorted(tuple(r) for r in QUERIES["op12_token_planes"](spark, SF).collect())
    assert got == plain_ids(word_tokenizer, docs)


def test_token_planes_defined_cases(spark, awkward, nothing, word_tokenizer):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    got = planes.round_trip(awkward).collect()
    plain = plain_ids(word_tokenizer, rows)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((d, n, c) for d, _, n, c in plain)
    in_order = sorted(got, key=lambda r: r.start)
    assert [r.start for r in in_order] == np.cumsum([0] + [r.n_tokens for r in in_order])[:-1].tolist()
    assert [r.doc_id for r in in_order] == [d for d, *_ in plain]
    assert planes.round_trip(nothing).count() == 0


def test_files_roll_and_are_read_by_range(spark, word_tokenizer):
    docs = table(spark, SF, "documents")
    folder = new_dir(spark, "planes")
    files = planes.write_ids(docs, folder, file_ids=5000, plane=8).orderBy("start").collect()
    assert len(files) > 4 and [f.start for f in files] == np.cumsum([0] + [f.ids for f in files])[:-1].tolist()
    whole = [i for r in docs.orderBy("doc_id").collect() for i in [*word_tokenizer.encode(r.text, add_special_tokens=False).ids, 2]]
    f = files[2]
    assert planes.read_ids(f.path, 100, 50).tolist() == whole[f.start + 100 : f.start + 150]


# -- alignment --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def both():
    return align.Tokenizers(public_tokenizers.path(align.LEFT), public_tokenizers.path(align.RIGHT))


def plain_sides(both, text):
    """Tokens of the whole text without any cut, or None."""
    if not text:
        return None
    a = both.left.encode(" " + text, add_special_tokens=False).ids
    b = both.right.encode(text)
    sides = [[(i, len(x[i])) for i in ids] for ids, x in ((a, both.left_bytes), (b, both.right_bytes))]
    raw = (" " + text).encode()
    spelt = b"".join(both.left_bytes[i] for i in a) == raw and b"".join(both.right_bytes[i] for i in b) == raw
    return sides if spelt else None


def group_text(group):
    return ",".join(map(str, group[0])) + "|" + ",".join(map(str, group[1]))


def plain_groups(a, b):
    ends = [np.cumsum([n for _, n in side]).tolist() for side in (a, b)]
    out, i, j = [], 0, 0
    for c in sorted(set(ends[0]) & set(ends[1])):
        x, y = ends[0].index(c) + 1, ends[1].index(c) + 1
        out.append((tuple(t for t, _ in a[i:x]), tuple(t for t, _ in b[j:y])))
        i, j = x, y
    return out


def plain_links(a, b):
    spans = []
    for side in (a, b):
        at, own = 0, []
        for t, n in side:
            own.append((t, at, at + n))
            at += n
        spans.append(own)
    return [(x[0], y[0]) for x in spans[0] for y in spans[1] if x[1] < y[2] and y[1] < x[2]]


def plain_alignment(both, docs):
    linked, counts = {}, Counter()
    for k, (_, text) in enumerate(docs):
        sides = plain_sides(both, text)
        linked[k] = sides and (*map(len, sides), plain_groups(*sides), plain_links(*sides))
        counts.update(linked[k][3] if sides else [])
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for k, (d, _) in enumerate(docs):
        if linked[k] is None:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = linked[k]
        sha = hashlib.sha256(";".join(map(group_text, groups)).encode()).hexdigest()
        best = sum(counts[x] == most[x[1]] for x in links)
        out.append((d, n_a, n_b, len(groups), len(links), best, sum(counts[x] for x in links), sha))
    return out


def arrays(*sides):
    return [np.array([t for t, _ in s], np.int64) for s in sides] + [np.array([n for _, n in s], np.int64) for s in sides]


def codes_of(pairs):
    return np.array([(a << 32) | b for a, b in pairs], np.int64).tobytes()


@given(TEXT)
@settings(max_examples=400, deadline=None)
def test_units_have_the_tokens_of_the_whole_text(both, text):
    if not text:
        return
    assert "".join(align.units_of(" " + text)) == " " + text
    found, whole = both.encode(" " + text), plain_sides(both, text)
    assert (found is None) == (whole is None)
    if whole is not None:
        assert [x.tolist() for x in found] == [[t for t, _ in side] for side in whole]
        closed = align.fragment(*arrays(*whole), whole=True).closed
        groups = plain_groups(*whole)
        assert closed == align.Closed(";".join(map(group_text, groups)), len(groups), codes_of(plain_links(*whole)))


@given(st.lists(st.integers(1, 4), min_size=1, max_size=12), st.lists(st.integers(1, 4), max_size=12), st.lists(st.integers(0, 40), max_size=5))
@settings(max_examples=300, deadline=None)
def test_fragments_are_a_monoid(a, b, cuts):
    total = max(sum(a), sum(b))
    a, b = [*a, *[1] * (total - sum(a))], [*b, *[1] * (total - sum(b))]
    sides = [[(100 * k + i, n) for i, n in enumerate(side)] for k, side in enumerate((a, b))]
    ends = [np.cumsum(x) for x in (a, b)]
    edges = sorted({0, total, *[c for c in cuts if c < total]})
    parts = []
    for lo, hi in zip(edges, edges[1:]):
        at = [np.searchsorted(e, [lo, hi], "right") for e in ends]
        begins = [int(e[x[0] - 1]) if x[0] else 0 for e, x in zip(ends, at)]
        parts.append(align.fragment(*arrays(*[side[x[0] : x[1]] for side, x in zip(sides, at)]), *begins))
    left = right = align.EMPTY
    for p in parts:
        left = left + p
    for p in reversed(parts):
        right = p + right
    whole = align.fragment(*arrays(*sides))
    assert left == right == whole == whole + align.EMPTY and whole.suffix == ((), ())
    groups = plain_groups(*sides)
    every = align.joined(align.one_group(whole.prefix), whole.closed)
    assert every == align.fragment(*arrays(*sides), whole=True).closed
    assert every == align.Closed(";".join(map(group_text, groups)), len(groups), codes_of(plain_links(*sides)))
    made, at, closed = align.compose([(p, k) for k, p in enumerate(parts)])
    inner = [(k, 1, p.closed) for k, p in enumerate(parts)] + [(k, 0, g) for k, g in closed] + [(at, 0, align.one_group(made.prefix))]
    assert align.joined(*[g for *_, g in sorted(inner, key=lambda x: x[:2])]) == every


@given(st.text(st.sampled_from("ab  \nü,"), min_size=1, max_size=200), st.integers(3, 40), st.integers(0, 12))
@settings(max_examples=200, deadline=None)
def test_ranges_cover_the_text(both, text, limit, context):
    whole = plain_sides(both, text)
    text = " " + text
    parts = list(align.text_parts(text, limit, context))
    assert b"".join(w.encode()[s : s + t] for w, s, t in parts) == text.encode()
    made = [align.range_fragment(both, *p) for p in parts]
    assert [sum(m[k] for m in made) for k in (1, 2)] == list(map(len, whole))
    folded = align.EMPTY
    for f, *_ in made:
        folded = folded + f
    assert folded == align.fragment(*arrays(*whole))


@pytest.mark.parametrize("limit", [align.PART_CHARS, 300])
def test_alignment_query(spark, both, limit, monkeypatch):
    monkeypatch.setattr(align, "FAN_IN", 3)
    docs = table(spark, SF, "documents").limit(60)
    want = plain_alignment(both, [(r.doc_id, r.text) for r in docs.collect()])
    got = [tuple(r) for r in align.align_documents(docs, part_chars=limit).collect()]
    assert sorted(got) == sorted(want)
    if limit == align.PART_CHARS:
        whole = QUERIES["op13_token_alignment"](spark, SF)
        assert whole.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("limit", [align.PART_CHARS, 100])
def test_alignment_defined_cases(spark, both, awkward, nothing, limit):
    extra = spark.createDataFrame([(70, "a▁b " * 90), (71, "<|endoftext|> <s> \r\n x  \t y \n\n"), (72, "x" * 700)], "doc_id long, text string")
    docs = awkward.select("doc_id", "text", "rk", "n_chars").unionByName(extra, allowMissingColumns=True)
    rows = [(r.doc_id, r.text if r.text is None or len(r.text) < 9000 else r.text) for r in docs.collect()]
    short = [(d, t) for d, t in rows if t is None or len(t) < 9000]
    want = Counter(plain_alignment(both, short))
    kept = docs.filter("text is null or length(text) < 9000")
    assert Counter(tuple(r) for r in align.align_documents(kept, part_chars=limit).collect()) == want
    assert align.align_documents(docs, part_chars=limit).count() == len(rows)
    assert align.align_documents(nothing, part_chars=limit).count() == 0
