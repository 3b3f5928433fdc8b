"""License scan, quality cascade and personal data against plain versions."""

import hashlib
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from isopleth.llm import licenses, pii, quality
from isopleth.llm.common import table
from isopleth.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# -- licenses ---------------------------------------------------------------------------


def test_automaton_regions():
    a = licenses.compile_template("x", "one <<beginOptional>> two <<beginOptional>> three <<endOptional>> <<endOptional>> four <<var;name=n;match=1,2>> five")
    ok = lambda s: a.run(s.split(), 0)[0]
    assert ok("one four w five") == 4
    assert ok("one two four w w five more") == 6
    assert ok("one two three four w five") == 6
    assert ok("one three four w five") == -1
    assert ok("one four five") == -1
    assert ok("one four w w w five") == -1
    assert a.run("one two four".split(), 0)[1] == 2


@pytest.mark.parametrize("bad", ["a <<beginOptional>> b", "a <<endOptional>>", "a <<var;name=x>>", "<<var;match=1,1>>", "a <<var;match=3,1>>"])
def test_bad_markup(bad):
    with pytest.raises(ValueError):
        licenses.compile_template("x", bad)


def plain_licenses(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at = [(k, label) for p, label in licenses.PHRASES.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
    return len(words), len(at), min(at)[0] if at else None, max(k for k, _ in at) if at else None, ",".join(sorted({x for _, x in at}))


def test_license_query_against_plain(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    got = QUERIES["op9_license_scan"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_licenses(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1


def test_license_edges(spark, awkward, nothing):
    assert licenses.scan_licenses(awkward).count() == awkward.count()
    assert licenses.scan_licenses(nothing).count() == 0
    d = spark.createDataFrame([(1, "CC BY CC-by; MIT\nLicense"), (2, None), (3, "Released under the MIT License.")], "doc_id long, text string")
    a, b, c = licenses.scan_licenses(d).orderBy("doc_id").collect()
    assert (a.n_base, a.first_word, a.last_word, a.base_labels) == (3, 0, 4, "cc-by,mit")
    assert (b.n_words, b.n_base, b.first_word, b.labels, b.score) == (0, 0, None, "", 0.0)
    assert c.labels == "mit,notice-mit" and c.score == 1.0


def test_many_places_of_one_text():
    text = "mit license x cc by " * 3000 + "apache license"
    got = licenses._scan(text, [], [])
    assert got[:5] == plain_licenses(text)


def test_score_counts_what_matches_before_a_missing_word(spark):
    text = licenses.TEMPLATES["text-mit"].replace("documentation", "").split("<<")[0]
    d = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = licenses.scan_licenses(d, {"text-mit": licenses.TEMPLATES["text-mit"]}).first()
    words = licenses.TEMPLATES["text-mit"].split()
    total = licenses.compile_template("x", licenses.TEMPLATES["text-mit"]).depth[-1]
    assert got.labels == "" and got.score == pytest.approx(words.index("documentation") / total)


# -- quality ----------------------------------------------------------------------------


def plain_repeats(words):
    tri = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    n = Counter(tri)
    return len({k + d for k, t in enumerate(tri) if n[t] > 1 for d in range(3)})


@given(st.lists(st.sampled_from("abc"), max_size=40))
@settings(max_examples=80, deadline=None)
def test_repeat_words(words):
    assert quality.Text(" ".join(words)).n_repeat_words == plain_repeats(words)


def test_order_is_rejection_per_cost_and_keeps_the_verdict(awkward):
    a, b, c = (quality.Rule(x, lambda t: True) for x in "abc")
    order = quality.cascade_order([quality.Estimate(a, 1.0, 0.5), quality.Estimate(b, 0.1, 0.2), quality.Estimate(c, 2.0, 0.0)])
    assert [r.name for r in order] == ["b", "a", "c"]
    full = quality.quality_cascade(awkward).select("doc_id", "kept").collect()
    back = quality.quality_cascade(awkward, rules=quality.RULES[::-1], counts=False).collect()
    assert Counter(map(tuple, full)) == Counter(map(tuple, back))


def test_quality_edges(awkward, nothing):
    rows = quality.quality_cascade(awkward).collect()
    assert len(rows) == awkward.count()
    assert all(r.base_failed and not r.kept for r in rows if r.n_words < 50)
    assert quality.quality_cascade(nothing).count() == 0


# -- personal data ----------------------------------------------------------------------


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def plain_pii(t):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    find = lambda p: re.finditer(p, t or "")
    out = [(m.start(), 0, m.end(), "email") for m in find(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")]
    out += [(m.start(), 1, m.end(), "ip") for m in find(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)") if all(int(x) < 256 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end(), "card") for m in find(r"[0-9]([\x20-]?[0-9])+") if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), 3, m.end(), "phone") for m in find(r"\+[0-9][\x20().0-9-]+[0-9]") if 10 <= len(digits(m)) <= 15]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


TRICKY = [
    "a@b.c_d@e.f x@y@z.com \U0001f600 a.b@c.d.e. tail@",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.000 1.2.3 9.9.9.9",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 +4 1111111111 ",
    "+49 (30) 123 456 78. +1-2 ++12345678901 +123456789012345678",
    "é4111111111111111@x.y " * 300,
    "1.2.3.4 " * 700,
]


def test_base_spans_against_plain(spark, awkward):
    own = spark.createDataFrame([(k, t) for k, t in enumerate(TRICKY)], "doc_id long, text string")
    texts = dict(enumerate(TRICKY))
    for r in pii.find_pii(own).select("doc_id", pii.span_text("base").alias("b")).collect():
        assert r.b == plain_pii(texts[r.doc_id]), r.doc_id
    assert pii.find_pii(awkward).count() == awkward.count()
    assert pii.find_pii(awkward.limit(0)).count() == 0


def test_pii_query_against_plain(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    for r in QUERIES["op1_pii"](spark, SF).collect():
        assert r.base_sha256 == hashlib.sha256(plain_pii(texts[r.doc_id]).encode()).hexdigest()


def test_contexts_find_what_no_base_pattern_does(spark):
    rows = [(k, f"please write to contact: user{k}@mail.example soon") for k in range(8)]
    rows += [(100, "please write to contact: someone7(at)mail.example soon"), (101, "please write 7 lines")]
    rows += [(102, "please write to contact: x5@mail.example or the address: user1@mail.example now")]
    got = {r.doc_id: r.s for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", pii.span_text("spans").alias("s")).collect()}
    assert got[100] == "context_email:25:49"
    assert got[101] == ""
    assert got[3] == plain_pii(rows[3][1])


def test_contexts_of_found_instances_find_more(spark):
    rows = [(k, f"contact: user{k}@mail.example a{'x' * k}") for k in range(100)]
    rows += [(200 + k, f"contact: name{k}(at)mail.example b{'x' * k}") for k in range(15)]
    rows += [(300 + k, f"reach name{k}(at)mail.example c{'x' * k}") for k in range(14)]
    rows += [(400, "reach hidden7(at)other.example dd"), (401, "ping name1(at)mail.example ee"), (402, "ping alone7 ff")]
    found = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: r.s for r in found.select("doc_id", pii.span_text("spans").alias("s")).collect()}
    assert got[200] == "context_email:9:30"
    assert got[400] == "context_email:6:30"  # its context holds no seed, only found instances
    assert got[402] == ""  # one found instance is too little


def test_written_with_blanks_seeds_too(spark):
    rows = [(k, f"card number: 4111 1111 1111 1111 ref{'x' * k}") for k in range(3)]
    rows += [(10 + k, f"card number: 5500 0000 0000 {n} paid{'y' * k}") for k, n in enumerate(("0004", "0012", "0020"))]
    rows += [(20 + k, f"call phone: +49 30 1234 56{k}0 z{'z' * k}") for k in range(9)]
    rows += [(40, "call phone: 0049-30-987654 tomorrow"), (41, "call at 7 or 8"), (42, "see table(4) and fig(2)")]
    found = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: r for r in found.select("doc_id", pii.span_text("base").alias("b"), pii.span_text("spans").alias("s")).collect()}
    for k, text in rows:
        assert got[k].b == plain_pii(text)
        assert got[k].s == ("context_phone:12:26" if k == 40 else got[k].b)  # found, and nothing else is


def test_masking(spark):
    d = spark.createDataFrame([(1, "a me@x.org b 1.2.3.4", 20, "k"), (2, None, 0, "k"), (3, "+1 2345678901 4111 1111 1111 1111", 9, "k")], "doc_id long, text string, n_chars long, spans string")
    a, b, c = pii.mask_pii(d, n_chars="n_chars").orderBy("doc_id").collect()
    assert a.text == "a [EMAIL] b [IP]" and a.n_chars == len(a.text) and a.spans == "k"
    assert b.text is None
    assert plain_pii(c.text) == ""
    clash = d.select("doc_id", "text", "n_chars", *[F.lit(1).alias(x) for x in ("key", "added", "row", "found", "masked", "email")])
    again = pii.mask_pii(clash.union(clash), n_chars="n_chars")
    assert again.columns == clash.columns
    assert Counter(r.text for r in again.collect()) == Counter(2 * [x.text for x in (a, b, c)])
