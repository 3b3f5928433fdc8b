"""Mixing, archives, the pipeline, and the queries' SQL twins."""

import io
import os
import re
import sys
import zipfile
from collections import Counter, defaultdict

import pytest
from crosscheck import compare, connect
from pyarrow import fs
from pyspark.sql import functions as F

from isopleth.llm import mixing, pii, simhash, warc
from isopleth.llm.common import table
from isopleth.llm.queries import ORACLES, QUERIES

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_twin(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None


# -- mixing -----------------------------------------------------------------------------


def plain_targets(sizes):
    """Share by weight, stop the full sources, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    full, left = {}, sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        level = left / sum(weight[s] for s in open_) if open_ else 0
        over = [s for s in open_ if weight[s] * level > 3 * sizes[s]]
        if not over:
            return {**full, **{s: weight[s] * level for s in open_}}
        for s in over:
            full[s] = 3 * sizes[s]
            left -= full[s]


def check_mix(rows, sources):
    sizes, taken = Counter(), Counter()
    for r in rows:
        sizes[sources[r.doc_id]] += r.size
        taken[sources[r.doc_id]] += r.taken
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
    want = plain_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[sources[r.doc_id]] and r.target == pytest.approx(want[sources[r.doc_id]])
    return sizes, taken, want


def test_mix_query(spark):
    docs = {r.doc_id: r for r in table(spark, SF, "documents").collect()}
    rows = QUERIES["op7_mixing"](spark, SF).collect()
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((i, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for i, r in docs.items())
    sizes, taken, want = check_mix(rows, {i: r.source for i, r in docs.items()})
    largest = {s: max(r.size for r in rows if docs[r.doc_id].source == s) for s in sizes}  # ten documents a source here
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 for s in sizes)


def test_uneven_sources_and_a_second_run(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.expr("repeat(concat('w', id, ' '), cast(1 + id % 37 as int))").alias("text"),
        F.expr("case when id % 3 = 0 then 'big' when id % 50 = 1 then null when id < 40 then 'tiny' else concat('s', id % 5) end").alias("source"),
    )
    src = {r.doc_id: r.source for r in docs.collect()}
    one = mixing.mix_amounts(docs.repartition(7)).collect()
    two = mixing.mix_amounts(docs.repartition(2, "source")).collect()
    assert Counter(map(tuple, one)) == Counter(map(tuple, two))
    sizes, taken, want = check_mix(one, src)
    assert all(abs(taken[s] - want[s]) <= 18 for s in sizes)  # half a document
    mixed = mixing.mix(docs, shards=8)
    size = {r.doc_id: r.size for r in one}
    amounts = Counter()
    for r in mixed.select("doc_id", "shard", "copy").collect():
        assert 0 <= r.shard < 8
        amounts[r.doc_id] += size[r.doc_id]
    assert all(amounts[r.doc_id] == r.taken for r in one)


def test_tree_adds_up(spark):
    tickets = spark.range(1001).select((F.col("id") % 3).cast("int").alias("s"), F.col("id").alias("ticket"))
    quotas = mixing.splitting_tree(tickets, 16).collect()
    by_shard, by_source = Counter(), Counter()
    for r in quotas:
        by_shard[r.shard] += r.quota
        by_source[r.s] += r.quota
    assert by_source == Counter({0: 334, 1: 334, 2: 333})
    assert len(by_shard) == 16 and max(by_shard.values()) - min(by_shard.values()) <= 2
    with pytest.raises(ValueError):
        mixing.splitting_tree(tickets, 12)


def test_shards_grow_with_the_words():
    per = mixing.SHARD_WORDS
    assert [mixing.shards_for(n) for n in (0, 1, 64 * per, 64 * per + 1, 1000 * per)] == [64, 64, 64, 128, 1024]


def test_mix_edges(awkward, nothing):
    rows = mixing.mix_amounts(awkward).collect()
    assert len(rows) == awkward.count() and all(r.taken == 0 for r in rows if r.size == 0)
    assert mixing.mix_amounts(nothing).count() == 0 and mixing.mix(nothing).count() == 0
    assert mixing.mix(awkward).columns == [*awkward.columns, "shard", "copy"]
    with pytest.raises(ValueError):
        mixing.mix(awkward.withColumn("Shard", F.lit(1)))


# -- archives ---------------------------------------------------------------------------


def package(zip64, payloads=(b"one", b"two" * 500)):
    class Sink(io.BytesIO):
        def close(self):
            pass

    out = Sink()
    w = warc.PackageWriter(out, zip64)
    w.begin(warc.ARCHIVE)
    for p in payloads:
        w.add(p)
    w.end_member()
    w.begin(warc.INDEX)
    w.add(b"{}\n")
    w.end_member()
    w.close()
    return out.getvalue()


@pytest.mark.parametrize("zip64", [False, True])
def test_packages_are_zip_files(zip64):
    data = package(zip64)
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert z.read(warc.ARCHIVE) == b"one" + b"two" * 500 and z.testzip() is None
    found = {m.name: m for m in warc.members(io.BytesIO(data), len(data))}
    m = found[warc.ARCHIVE]
    assert data[m.start : m.start + m.size] == b"one" + b"two" * 500


def test_foreign_packages_and_comments():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr("a", b"stored")
        z.writestr("b", b"packed" * 99, zipfile.ZIP_DEFLATED)
        z.comment = b"a comment with PK\5\6 in it, long enough for a false end record"
    data = out.getvalue()
    assert [(m.name, data[m.start : m.start + m.size]) for m in warc.members(io.BytesIO(data), len(data))] == [("a", b"stored")]
    with pytest.raises(ValueError):
        warc.members(io.BytesIO(data[:40]), 40)


def test_round_trip(spark):
    long_one, other = "x" * 1200, "é" * 600
    rows = [(1, "u", long_one), (9, None, long_one), (4, "v\r\nX-Bad: 1", long_one), (2, "w", "short"), (3, "w", "short"), (5, "n", None), (None, "z", other), (7, "z", other)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    for zip64 in (False, True):
        folder = warc.new_dir(spark, "t")
        packages = warc.write_packages(pages, folder, package_bytes=1500, zip64=zip64)
        got = warc.read_packages(packages).collect()
        kinds = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes) for r in got}
        assert kinds == {
            1: ("revisit", 9, 1200), 9: ("response", None, 1200), 4: ("revisit", 9, 1200), 2: ("response", None, 5),
            3: ("response", None, 5), 5: ("response", None, 0), None: ("revisit", 7, 1200), 7: ("response", None, 1200),
        }
        assert {r.page_id: bytes(r.payload) for r in got}[9] == long_one.encode()
    path = packages.first().path
    files, inner = warc.open_store(path)
    assert isinstance(files, fs.LocalFileSystem) and os.path.exists(inner)
    assert warc.round_trip(pages.limit(0)).count() == 0


# -- pipeline ---------------------------------------------------------------------------


def plain_groups(texts):
    """Smallest id of each group of texts whose sets of five-word shingles are at least 0.8 alike, by all pairs."""
    sets = {i: set(simhash.shingles(t, 5)) for i, t in texts.items()}
    low = {i: i for i in texts}

    def find(i):
        while low[i] != i:
            i = low[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and (len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])):
                x, y = find(i), find(j)
                low[max(x, y)] = min(x, y)
    return {i: find(i) for i in texts}


def test_pipeline_stage_by_stage(spark):
    docs = table(spark, SF, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_duplicates", "decontamination", "personal_data", "mixture"]
    now, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.store(stage(spark, now, SF), name)
        seen[name] = out
        if name != "mixture":
            assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        before = {r.doc_id: r.text for r in now.collect()}
        after = defaultdict(list)
        for r in out.collect():
            after[r.doc_id].append(r.text)
        assert set(after) <= set(before)
        if name == "language_id":
            assert len(after) >= 0.97 * len(before)
        if name == "near_duplicates":
            assert set(after) == set(plain_groups(before).values())
        if name == "decontamination":
            bench = [r.text for r in table(spark, SF, "benchmark").collect()]
            hit = {i for i, t in before.items() if any(b in t for b in bench)}
            assert hit.isdisjoint(after) and len(before) - len(after) <= len(hit) + 2
        if name == "personal_data":
            assert set(after) == set(before)
            assert all(r.b == "" for r in pii.find_pii(out).select(pii.span_text("base").alias("b")).collect())
            assert all(r.n_chars == len(r.text) for r in out.collect())
        now = out
    sources = {r.doc_id: r.source for r in seen["personal_data"].collect()}
    words = Counter()
    for r in now.collect():
        words[sources[r.doc_id]] += len(r.text.encode().split())
    sizes = Counter()
    for r in seen["personal_data"].collect():
        sizes[r.source] += len(r.text.encode().split())
    want = plain_targets(sizes)
    assert all(abs(words[s] - want[s]) <= sizes[s] / 2 for s in sizes)  # a few documents a source here


def test_run_names_and_rows(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns[-2:] == ["shard", "copy"] and out.count() > 0
