"""Mixing of sources to target weights by a multivariate-hypergeometric splitting tree.

Targets are words by source.  Every source is cut into blocks of about ``BLOCK_DOCS``
documents in hash order.  A source whose target is f times its size gives floor(f) passes
over all its blocks and one over as many blocks as the rest needs; in the block where
that pass ends, single documents are fitted to what is left.

The block passes are tickets.  A binary tree halves the tickets again and again until there is one
lot for each output shard: at each node the half is drawn without replacement, so the
numbers by source follow the multivariate hypergeometric law and add up exactly.  The lots
become quotas of (shard, source), and each shard draws its quota from the source's permuted
blocks; no block pass is drawn twice.  Documents are shuffled within their shard.

Everything is DataFrame operations; only the documents' sizes are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isopleth.llm.common import BLANK, fresh, row_key, same, store

#: A target stops at this many times the size of its source.
MOST_REPEATS = 3
#: Weights of the sources in code-point order, repeated over and over.
WEIGHTS = (1, 2, 3)
BLOCK_DOCS = 256
#: Blocks of all sources together, besides one for each source; bounds tickets and tree.
MOST_BLOCKS = 1 << 20
#: Fewest shards, and the words of all documents for each; there are as many shards as the words need.
SHARDS = 64
SHARD_WORDS = 1 << 26
SEED = 7
FIT_ROUNDS = 4


def word_count(text: str = "text") -> Column:
    """Words between the six ASCII blanks; NULL has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(f"[^{BLANK}]++")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Table (s, source, docs, source_size, target) from rows (source, size).

    Sources share the total by weight; a target stops at ``most`` times its source, and the
    excess is shared again by weight.  That is a water level: sorted by the level at which
    they are full, the full sources come first, and the level follows from running sums.
    The table has one row a source, and its windows run over that alone.
    """
    own = sizes.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    named = Window.orderBy(F.asc_nulls_last("source"))
    own = own.withColumn("s", F.row_number().over(named))
    own = own.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.col("s") - 1) % len(weights) + 1))
    own = own.withColumn("full_at", F.col("source_size") * most / F.col("w"))
    order = Window.orderBy("full_at", "s")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum(F.col("source_size") * most).over(before), F.lit(0))
    own = own.withColumn("level_here", left / F.sum("w").over(after))
    level = F.max(F.when(F.col("level_here") <= F.col("full_at"), -F.col("full_at"))).over(every)
    own = own.withColumn("first_open", -level)
    level = F.max(F.when(F.col("full_at") == F.col("first_open"), F.col("level_here"))).over(every)
    target = F.least(F.col("w") * level, F.col("source_size").cast("double") * most)
    return own.select("s", "source", "docs", "source_size", F.coalesce(target, F.col("source_size") * most * 1.0).alias("target"))


def _block(rk: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(SEED), rk), blocks).cast("int")


def _fit(boundary: DataFrame) -> DataFrame:
    """Documents of the boundary blocks (s, rk, doc_id, size, rest) that the last pass takes.

    Round by round, documents in hash order are taken while they fit into the rest; at
    last the one that brings the source nearer its target than without it.
    """
    order = Window.partitionBy("s").orderBy(F.xxhash64(F.lit(SEED + 1), "rk"), "rk", "doc_id")
    all_of = Window.partitionBy("s")
    now = boundary.withColumn("in", F.lit(False))
    for _ in range(FIT_ROUNDS):
        now = now.withColumn("may", ~F.col("in") & (F.col("size") <= F.col("rest")))
        now = now.withColumn("sum", F.sum(F.when(F.col("may"), F.col("size")).otherwise(0)).over(order))
        now = now.withColumn("new", F.col("may") & (F.col("sum") <= F.col("rest")))
        taken = F.sum(F.when(F.col("new"), F.col("size")).otherwise(0)).over(all_of)
        now = now.withColumns({"rest": F.col("rest") - taken, "in": F.col("in") | F.col("new")})
    gain = F.col("rest") - F.abs(F.col("size") - F.col("rest"))
    now = now.withColumn("last", F.when(~F.col("in") & (gain > 0), F.struct(-gain, "rk", "doc_id")))
    now = now.withColumn("best", F.min("last").over(all_of))
    return now.filter(F.col("in") | (F.col("last") == F.col("best"))).select("s", "rk", "doc_id")


def splitting_tree(tickets: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """Quotas (shard, s, quota): ``tickets`` (s, ticket) halved again and again at random."""
    if shards < 1 or shards & (shards - 1):
        raise ValueError("the number of shards must be a power of two")
    now = tickets.withColumn("shard", F.lit(0))
    for level in range(shards.bit_length() - 1):
        node = Window.partitionBy("shard")
        drawn = node.orderBy(F.xxhash64(F.lit(seed), F.lit(level), "s", "ticket"), "s", "ticket")
        now = now.withColumns({"rank": F.row_number().over(drawn), "n": F.count("*").over(node)})
        # the odd ticket goes left or right by a coin of the node
        half = F.floor((F.col("n") + F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "shard"), F.lit(2))) / 2)
        now = now.select("s", "ticket", (F.col("shard") * 2 + (F.col("rank") > half).cast("int")).alias("shard"))
    return now.groupBy("shard", "s").agg(F.count("*").alias("quota"))


def _draws(passes: DataFrame, quotas: DataFrame) -> DataFrame:
    """(s, block, pass, shard): each shard's quota from the source's permuted block passes."""
    permuted = Window.partitionBy("s").orderBy(F.xxhash64(F.lit(SEED + 2), "s", "block", "pass"), "block", "pass")
    ranked = passes.withColumn("place", F.row_number().over(permuted))
    upto = F.sum("quota").over(Window.partitionBy("s").orderBy("shard"))
    lots = quotas.withColumn("upto", upto)
    lots = lots.select("s", "shard", F.explode(F.sequence(F.col("upto") - F.col("quota") + 1, F.col("upto"))).alias("place"))
    return ranked.join(lots, ["s", "place"]).select("s", "block", "pass", "shard")


def shards_for(words: int) -> int:
    """Power of two, at least ``SHARDS``, at which a shard has at most ``SHARD_WORDS`` words on average."""
    return max(SHARDS, 1 << (max(1, -(-words // SHARD_WORDS)) - 1).bit_length())


class Mix:
    """Stored plan of a mixture: ``sizes`` by row, ``sources`` by source, ``draws`` by block, ``fitted`` rows.

    Without ``shards`` their number grows with the words, so that a shard stays of one size.
    """

    def __init__(
        self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", shards: int | None = None
    ):
        own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(source).alias("source"))
        self.sizes = store(own.select("doc_id", row_key().alias("rk"), "source", word_count().alias("size")), "sizes")
        targets = source_targets(self.sizes)
        share = F.ceil(F.col("docs") * float(MOST_BLOCKS) / F.sum("docs").over(Window.partitionBy()))
        blocks = F.greatest(F.lit(1), F.least(F.ceil(F.col("docs") / BLOCK_DOCS), share)).cast("int")
        passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
        targets = targets.withColumns({"blocks": blocks, "passes": passes.cast("int")})
        rest = F.col("target") - F.col("passes") * F.col("source_size")
        self.sources = store(targets.withColumn("rest", rest), "sources")
        if shards is None:
            shards = shards_for(self.sources.agg(F.sum("source_size")).first()[0] or 0)
        self.shards = shards

        rows = self.placed(self.sizes)
        # rows of one id and text are taken together
        units = rows.groupBy("s", "block", "rk", "doc_id").agg(F.sum("size").alias("size"))
        sums = units.groupBy("s", "block").agg(F.sum("size").alias("size"))
        sums = sums.withColumn("upto", F.sum("size").over(Window.partitionBy("s").orderBy("block")))
        facts = self.sources.select("s", "passes", "rest")
        sums = sums.join(facts, "s").withColumns(
            {
                "whole": F.col("upto") <= F.col("rest"),
                "part": (F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("size") < F.col("rest")),
            }
        )
        sums = store(sums, "blocks")
        cut = sums.filter("part").select("s", "block", (F.col("rest") - F.col("upto") + F.col("size")).alias("rest"))
        self.fitted = store(_fit(units.join(cut, ["s", "block"])), "fitted")

        last = F.when(F.col("whole") | F.col("part"), F.array(F.col("passes"))).otherwise(F.array().cast("array<int>"))
        full = F.when(F.col("passes") > 0, F.sequence(F.lit(0), F.col("passes") - 1)).otherwise(F.array().cast("array<int>"))
        block_passes = sums.select("s", "block", F.explode(F.concat(full, last)).alias("pass"))
        ticket = F.row_number().over(Window.partitionBy("s").orderBy("block", "pass"))
        self.quotas = store(splitting_tree(block_passes.select("s", ticket.alias("ticket")), shards), "quotas")
        drawn = _draws(block_passes, self.quotas).groupBy("s", "block")
        drawn = drawn.agg(F.sort_array(F.collect_list(F.struct("pass", "shard"))).alias("draws"))
        drawn = drawn.join(sums.select("s", "block", "part", "passes"), ["s", "block"])
        self.draws = store(drawn, "draws")

    def placed(self, rows: DataFrame, source: str = "source", rk: str = "rk") -> DataFrame:
        """Rows with the number of their source (s), their block and the source's size and target."""
        src = fresh(rows, "src")
        facts = self.sources.select("s", F.col("source").alias(src), "blocks", "source_size", "target")
        joined = rows.join(facts, same(F.col(source), F.col(src))).drop(src)
        return joined.withColumn("block", _block(F.col(rk), F.col("blocks"))).drop("blocks")

    def drawn(self, rows: DataFrame, doc_id: str = "doc_id", rk: str = "rk") -> DataFrame:
        """Placed rows with ``draws``, the (pass, shard) in which the mix takes them."""
        joined = rows.join(self.draws, ["s", "block"], "left")
        own, key = fresh(joined, "fit_id"), fresh(joined, "fit_rk")
        fitted = self.fitted.select(F.col("rk").alias(key), F.col("doc_id").alias(own), F.lit(True).alias("fits"))
        joined = joined.join(fitted, (F.col(rk) == F.col(key)) & same(F.col(doc_id), F.col(own)), "left")
        cut = F.expr("filter(draws, d -> not part or d.pass < passes or coalesce(fits, false))")
        return joined.withColumn("draws", cut).drop("part", "passes", "fits", own, key)


def mix_amounts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """What the mix takes: doc_id, size, source_size, target, taken for every input row.

    NULL sources are one source, last in order.  NULL, empty and blank texts have size 0 and
    taken 0; rows of one id and text are taken equally often.  An empty table gives no rows.  The
    result depends on the rows alone, not on their order or placement.
    """
    plan = Mix(docs, doc_id, text, source)
    rows = plan.drawn(plan.placed(plan.sizes))
    taken = (F.col("size") * F.coalesce(F.size("draws"), F.lit(0))).cast("long")
    return rows.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", shards: int | None = None
) -> DataFrame:
    """The mixture: every row as often as it is taken, with its ``shard`` and ``copy``.

    The columns of ``docs`` and two more; a clash of names raises.  Rows are gathered by shard,
    in as many partitions as there are shards, and lie in random order within it.  Unless
    ``shards`` (a power of two) is given, it follows from the words.  See ``mix_amounts`` for the
    defined cases.
    """
    if {"shard", "copy"} & {c.lower() for c in docs.columns}:
        raise ValueError("docs has a column shard or copy")
    plan = Mix(docs, doc_id, text, source, shards)
    inner = {c: f"c{k}" for k, c in enumerate(docs.columns)}  # own names beside those of the plan
    rows = docs.select([F.col(f"`{c}`").alias(n) for c, n in inner.items()])
    rows = rows.withColumn("rk", row_key(inner[doc_id], inner[text]))
    rows = plan.drawn(plan.placed(rows, inner[source]), inner[doc_id])
    taken = rows.select(*inner.values(), "rk", F.explode("draws").alias("d"))
    placed = taken.repartition(plan.shards, F.col("d.shard")).sortWithinPartitions(
        "d.shard", F.xxhash64(F.lit(SEED + 3), "rk", "d.pass"), "rk", "d.pass"
    )
    out = [F.col(n).alias(c) for c, n in inner.items()]
    return placed.select(*out, F.col("d.shard").alias("shard"), F.col("d.pass").alias("copy"))
