"""Personal data: base patterns, and bootstrapped contextual extraction on top of them.

Base: leftmost non-overlapping matches of four patterns with their checks.

Bootstrapping: the checked base entities, written with blanks or without, are seeds.  Each other
token that holds a digit, "@" or an opening bracket after a letter is an instance too.  Its patterns are
the word before it, the two words before it, the word after it, both neighbours, and the word
before it together with its shape (runs of letters, each digit, the signs).  Patterns and
instances form a graph.  Round by round, a pattern scores the share of its distinct
instances that are believed to be of a kind (with ``DOUBT`` disbelieved ones added), and an
instance the best score of its patterns.  A pattern needs the support of enough distinct
instances: seeds in the first round, from the second on also those that the round before
believed.  So contexts of found instances find further ones, as many steps away as there
are rounds after the first.  Patterns with a high score and enough support then mark the tokens that no base
pattern has found.

All of it is DataFrame expressions.  Positions count code points.  They follow from the lengths of the
matches and of the pieces between them, which the same pattern splits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isopleth.llm.common import BLANK, row_key, store

KINDS = ("email", "ip", "card", "phone")
#: Kind of a span that the contexts found.
FOUND = "context_{}"

# The contract's patterns.  Possessive, and begun only where a run of their first characters
# begins or the last match ends: the same matches, in time linear in the text.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold before the pattern is tried.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: What a token must hold to be an instance, and such a token.
TELLING = r"[0-9@]|[A-Za-z][(\[{<]"
TOKEN = rf"(?<![^{BLANK}])(?=[^{BLANK}]*(?:{TELLING}))[^{BLANK}]++"
#: Tokens in a base form that are no seeds: their check has failed, so contexts don't add them.
REJECTED = r"^(?:[0-9](?:-?[0-9]){13,18}|[0-9]++(?:\.[0-9]++){3}|\+[0-9][().0-9-]+[0-9])$"
#: Matches whose lengths one step adds up, see ``_starts``.
RUN = 256

ROUNDS = 3
DOUBT = 1.0
MIN_SCORE = 0.8
#: Distinct instances, seeds or believed, that support a pattern at least.
MIN_SEEDS = 3
#: Characters that context words are looked for in.
CONTEXT = 64
#: Fields of a span.
SPAN = "start: int, ord: int, end: int, kind: string"


def _valid(kind: str, match: str) -> str:
    """SQL condition under which a match of a kind counts."""
    digits = f"regexp_replace({match}, '[^0-9]', '')"
    return {
        "email": "true",
        "ip": rf"{match} rlike r'^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|(?<=0))(?:\.|$)){{4}}$'",
        "card": f"char_length({digits}) between 14 and 19 and luhn_check({digits})",
        "phone": f"char_length({digits}) between 10 and 15",
    }[kind]


def _sql(pattern: str) -> str:
    return "r'" + pattern + "'"


def _matches(df: DataFrame, name: str, pattern: str, text: str, needs: str | None) -> DataFrame:
    """Add ``name``, the matches of a pattern as (start, end, text, left, right), left and right the pieces around."""
    m, g, n, p = (f"{name}_{x}" for x in "mgnp")
    if needs:
        test = f"contains({text}, '{needs}')" + (" and has_digit" if needs == "." else "")
    else:
        test = "has_digit" if name == "card" else f"{text} rlike {_sql(TELLING)}"
    df = df.withColumn(m, F.expr(f"case when {test} then regexp_extract_all({text}, {_sql(pattern)}, 0) end"))
    df = df.withColumn(g, F.expr(f"case when size({m}) > 0 then split({text}, {_sql(pattern)}, -1) end"))
    df = df.withColumn(n, F.expr(f"transform({m}, (x, i) -> char_length(x) + char_length({g}[i]))"))
    # sums of whole runs first, so that long lists cost little more than short ones
    runs = f"transform(sequence(0, (size({n}) - 1) div {RUN}), k -> aggregate(slice({n}, 1, k * {RUN}), 0, (a, x) -> a + x))"
    df = df.withColumn(p, F.expr(f"case when size({n}) > 0 then {runs} end"))
    start = (
        f"{p}[i div {RUN}] + aggregate(slice({n}, i - i % {RUN} + 1, i % {RUN}), 0, (a, y) -> a + y) + char_length({g}[i])"
    )
    spans = f"transform({m}, (x, i) -> named_struct('start', {start}, 'text', x, 'left', {g}[i], 'right', {g}[i + 1]))"
    return df.withColumn(name, F.expr(spans)).drop(m, g, n, p)


def _base(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows (row, doc_id, text, rk, has_digit, found): whole rows with their base entities and the pieces around these."""
    now = docs.select(
        F.struct("*").alias("row"),
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        row_key(doc_id, text).alias("rk"),
    ).withColumn("has_digit", F.expr("text rlike '[0-9]'"))
    for k, kind in enumerate(KINDS):
        now = _matches(now, kind, PATTERNS[kind], "text", NEEDS[kind])
        entity = (
            f"named_struct('start', m.start, 'ord', {k}, 'end', m.start + char_length(m.text), 'kind', '{kind}', "
            f"'text', m.text, 'left', right(m.left, {CONTEXT}), 'right', left(m.right, {CONTEXT}))"
        )
        now = now.withColumn(kind, F.expr(f"transform(filter({kind}, m -> {_valid(kind, 'm.text')}), m -> {entity})"))
    empty = f"cast(array() as array<struct<{SPAN}, text: string, left: string, right: string>>)"
    found = F.expr(f"concat({', '.join(f'coalesce({k}, {empty})' for k in KINDS)})")
    return now.select("row", "doc_id", "text", "rk", "has_digit", found.alias("found"))


#: All base entities of a row without what is around them.
BASE_SPANS = "array_sort(transform(found, m -> named_struct('start', m.start, 'ord', m.ord, 'end', m.end, 'kind', m.kind)))"


def _entities(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows (doc_id, rk, spans, seeds, tokens): base spans of all kinds, and seeds and tokens with the words around them.

    ``glued`` is how many characters of a seed's first token stand before it.
    """
    now = _matches(_base(docs, doc_id, text), "token", TOKEN, "text", None)
    words = lambda piece: rf"trim(regexp_replace(lower({piece}), r'[^\p{{L}}\p{{N}}]+', ' '))"
    before, after = (words(x) for x in (f"right(m.left, {CONTEXT})", f"left(m.right, {CONTEXT})"))
    around = f"'two', substring_index({before}, ' ', -2), 'after', substring_index({after}, ' ', 1)"
    glued = f"char_length(regexp_extract(m.left, r'[^{BLANK}]*$', 0))"
    seeds = f"transform(found, m -> named_struct('start', m.start, 'text', m.text, {around}, 'kind', m.kind, 'end', m.end, 'glued', {glued}))"
    tokens = f"transform(token, m -> named_struct('start', m.start, 'text', m.text, {around}))"
    return now.select("doc_id", "rk", F.expr(BASE_SPANS).alias("spans"), F.expr(seeds).alias("seeds"), F.expr(tokens).alias("tokens"))


@dataclass(frozen=True)
class Bootstrap:
    """Occurrences of instances, and scored patterns (pattern, kind, score, seeds: supporting instances)."""

    occurrences: DataFrame
    patterns: DataFrame


def bootstrap(entities: DataFrame, rounds: int = ROUNDS, doubt: float = DOUBT) -> Bootstrap:
    """Score the pattern-instance graph of the seeds and tokens of ``entities``.

    Tokens that a seed covers, wholly or in part, are no instances of their own.
    """
    listed = lambda name: entities.select("doc_id", "rk", F.explode(name).alias("t")).select("doc_id", "rk", "t.*")
    place = F.struct("rk", "doc_id", "start").alias("place")
    seeds = listed("seeds")
    covered = seeds.select("rk", "doc_id", F.explode(F.sequence(F.col("start") - F.col("glued"), F.col("end") - 1)).alias("start"))
    covered = store(covered.select(place), "covered")
    tokens = listed("tokens").withColumn("place", place).join(covered, "place", "left_anti").drop("place")
    one = seeds.drop("end", "glued").unionByName(tokens, allowMissingColumns=True)

    core = F.regexp_replace(F.regexp_replace(F.lower("text"), rf"[{BLANK}]+", " "), r"^[^a-z0-9@+]+|[^a-z0-9]+$", "")
    shape = F.regexp_replace(F.regexp_replace("instance", "[a-z]+", "a"), "[0-9]", "9")
    one = one.withColumns({"instance": core, "before": F.substring_index("two", " ", -1)}).withColumn("shape", shape)
    patterns = (
        "array(if(before <> '', '<' || before, null), if(contains(two, ' '), '<' || two, null), if(after <> '', '>' || after, null), "
        "if(before <> '' and after <> '', before || ' _ ' || after, null), if(before <> '', before || ' = ' || shape, null))"
    )
    one = one.withColumn("patterns", F.array_compact(F.expr(patterns)))
    one = store(one.drop("before", "two", "after", "shape"), "occurrences")
    edges = one.select("instance", "kind", F.explode("patterns").alias("pattern")).groupBy("pattern", "instance")
    edges = store(edges.agg(F.max("kind").alias("seed")), "edges")

    kinds = edges.filter("seed is not null").select("instance", F.col("seed").alias("kind")).distinct()
    scored = store(kinds.withColumn("score", F.lit(1.0)), "instances")
    total = edges.groupBy("pattern").agg(F.count("*").alias("n"))
    patterns = None
    for k in range(rounds):
        believed = edges.join(scored, "instance").groupBy("pattern", "kind")
        support = F.col("seed") == F.col("kind")
        if k:  # the seed column is NULL for instances without a seed
            support = F.coalesce(support, F.lit(False)) | (F.col("score") >= MIN_SCORE)
        seeds = F.count_if(support).alias("seeds")
        patterns = believed.agg(F.sum("score").alias("mass"), seeds).join(total, "pattern")
        patterns = patterns.select("pattern", "kind", (F.col("mass") / (F.col("n") + doubt)).alias("score"), "seeds")
        patterns = store(patterns.filter(F.col("seeds") >= MIN_SEEDS), "patterns")
        if k < rounds - 1:
            reached = edges.join(patterns, "pattern").groupBy("instance", "kind").agg(F.max("score").alias("score"))
            scored = kinds.withColumn("score", F.lit(1.0)).union(reached).groupBy("instance", "kind")
            scored = store(scored.agg(F.max("score").alias("score")), "instances")
    return Bootstrap(one, patterns)


def _discovered(found: Bootstrap, min_score: float) -> DataFrame:
    """Spans (doc_id, rk, added) of tokens that good patterns mark and that are no seeds."""
    good = found.patterns.filter(F.col("score") >= min_score)
    best = F.max(F.struct("score", "kind")).alias("best")
    marked = found.occurrences.filter("kind is null and instance <> ''").filter(~F.col("instance").rlike(REJECTED)).drop("kind")
    marked = marked.withColumn("pattern", F.explode("patterns")).join(good, "pattern")
    marked = marked.groupBy("doc_id", "rk", "start", "text").agg(best)
    names = F.create_map(*[F.lit(x) for k in KINDS for x in (k, FOUND.format(k))])
    ranks = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, len(KINDS) + i)])
    span = F.struct(
        "start",
        ranks[F.col("best.kind")].alias("ord"),
        (F.col("start") + F.char_length("text")).alias("end"),
        names[F.col("best.kind")].alias("kind"),
    )
    return marked.groupBy("doc_id", "rk").agg(F.collect_set(span).alias("added"))


def _added(entities: DataFrame, min_score: float) -> DataFrame:
    """Stored rows (key, added) of the documents in which contexts found spans; key is (rk, doc_id)."""
    added = store(_discovered(bootstrap(entities), min_score), "added")
    return added.select(F.struct("rk", "doc_id").alias("key"), "added")


#: Base spans and the added ones that overlap none of them.
WITH_ADDED = (
    "case when added is null then spans else array_sort(concat(spans, "
    "filter(added, a -> not exists(spans, s -> s.start < a.end and a.start < s.end)))) end"
)


def find_pii(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """Spans of personal data in every whole text.

    One row per input row: doc_id, rk, base and spans, both arrays of (start, ord, end,
    kind) in order of start, then kind.  ``spans`` adds to the base those that the contexts
    found; none of these overlaps a base span.

    NULL and empty texts have no spans.  Repeated rows get the same spans; they count once
    in the graph.  Of a table without seeds only the base spans are found.  The texts
    are read once and never shuffled.
    """
    entities = store(_entities(docs, doc_id, text), "entities")
    rows = entities.select("doc_id", "rk", "spans", F.struct("rk", "doc_id").alias("key"))
    rows = rows.join(_added(entities, min_score), "key", "left")
    return rows.select("doc_id", "rk", F.col("spans").alias("base"), F.expr(WITH_ADDED).alias("spans"))


def span_text(spans: str) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.expr(f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')")


def mask_pii(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str | None = None) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans become one.

    All rows and columns stay, repeated rows too; ``n_chars`` names a column to hold the new length.  NULL
    and empty texts stay as they are.  Base spans are masked where the row is read.  Only the spans that
    contexts added are looked up, in a stored table: it is broadcast if small, else the rows are shuffled once.
    """
    added = _added(store(_entities(docs, doc_id, text), "entities"), MIN_SCORE)
    rows = _base(docs, doc_id, text).select("row", F.struct("rk", "doc_id").alias("key"), F.expr(BASE_SPANS).alias("spans"))
    rows = rows.join(added, "key", "left").withColumn("spans", F.expr(WITH_ADDED))
    merged = F.expr(
        "aggregate(spans, cast(array() as array<struct<start: int, end: int, kind: string>>), (a, s) -> "
        "case when size(a) > 0 and element_at(a, -1).end > s.start then concat(slice(a, 1, size(a) - 1), "
        "array(named_struct('start', element_at(a, -1).start, 'end', greatest(element_at(a, -1).end, s.end), "
        "'kind', element_at(a, -1).kind))) else concat(a, array(named_struct('start', s.start, 'end', s.end, "
        "'kind', s.kind))) end)"
    )
    own = f"row.`{text}`"
    rows = rows.withColumn("spans", merged)
    pieces = (
        f"concat(array_join(transform(spans, (s, i) -> concat(substring({own}, case when i = 0 then 1 else "
        f"spans[i - 1].end + 1 end, s.start - case when i = 0 then 0 else spans[i - 1].end end), "
        f"'[', upper(s.kind), ']')), ''), substring({own}, element_at(spans, -1).end + 1))"
    )
    rows = rows.withColumn("masked", F.expr(f"case when size(spans) > 0 then {pieces} else {own} end"))
    new = {text.lower(): F.col("masked")}
    if n_chars:
        length = F.char_length("masked").cast("long")
        changed = F.when(F.size("spans") > 0, length).otherwise(F.col(f"row.`{n_chars}`")) if n_chars in docs.columns else length
        new[n_chars.lower()] = changed
    out = [new.pop(c.lower(), F.col(f"row.`{c}`")).alias(c) for c in docs.columns]
    return rows.select(*out, *[c.alias(n_chars) for c in new.values()])
