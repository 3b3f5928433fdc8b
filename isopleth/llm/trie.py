"""Prefix trie of conversations: ternary search trees over dictionary-encoded turns, by range shard.

Every distinct turn (role, text) gets a number, every conversation becomes a sequence of
numbers, and equal sequences are counted once.  The distinct sequences are dealt to range
shards in lexicographic order.  Each shard inserts its sequences into a ternary search tree,
the median first, then the medians of both halves, so that the search tree among the children
of a node is balanced; a traversal with an explicit stack then adds up members, leaves and savings.

A node that several shards hold lies, in each of them, on the path of the shard's first or
last sequence.  Only these boundary nodes are merged: first what each holds apart from
boundary children, then the sums over subtrees, which follow from sums along the two paths of
each shard.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from isopleth.llm.common import BLANK, same, store

#: Turns (repeats within a shard counted once) that one shard's tree may hold on average.
SHARD_TURNS = 400_000
#: Leading turns by which sequences are dealt to shards; sequences that agree in all of them share a shard.
RANGE_TURNS = 512
#: Conversation numbers of one block of the list that is hashed for the end of a sequence.
END_BLOCK = 1 << 14
NONE = -1


class TernaryTree:
    """Trie whose children are kept in binary search trees (``lo``, ``hi``); ``eq`` leads a level down.

    Node 0 is the root, which has no turn.  ``up`` is the parent in the trie, ``count`` and
    ``first`` the members and the smallest of them, ``end`` the sequence that ends at the node.
    """

    def __init__(self) -> None:
        self.turn, self.lo, self.eq, self.hi = (array("q") for _ in range(4))
        self.up, self.depth, self.words, self.count, self.first, self.end = (array("q") for _ in range(6))
        self._new(0, NONE, 0, 0)

    def _new(self, turn: int, up: int, depth: int, words: int) -> int:
        for links in (self.lo, self.eq, self.hi, self.end):
            links.append(NONE)
        self.turn.append(turn)
        self.up.append(up)
        self.depth.append(depth)
        self.words.append(words)
        self.count.append(0)
        self.first.append(0)
        return len(self.turn) - 1

    def _join(self, at: int, count: int, first: int) -> None:
        self.first[at] = min(self.first[at], first) if self.count[at] else first
        self.count[at] += count

    def insert(self, turns: list[int], words: list[int], count: int, first: int, which: int) -> None:
        turn, lo, eq, hi = self.turn, self.lo, self.eq, self.hi
        at = 0
        self._join(at, count, first)
        for depth, (x, w) in enumerate(zip(turns, words), 1):
            side, here, now = eq, at, eq[at]
            while now != NONE and turn[now] != x:
                side, here = (lo, now) if x < turn[now] else (hi, now)
                now = side[here]
            if now == NONE:
                now = side[here] = self._new(x, at, depth, w)
            at = now
            self._join(at, count, first)
        self.end[at] = which

    def path(self, turns: list[int]) -> list[int]:
        """Nodes from the root to the end of a sequence that was inserted."""
        out = [0]
        for x in turns:
            now = self.eq[out[-1]]
            while self.turn[now] != x:
                now = self.lo[now] if x < self.turn[now] else self.hi[now]
            out.append(now)
        return out

    def preorder(self) -> Iterator[int]:
        """Every node after its parent in the trie, without recursion."""
        stack = [0]
        while stack:
            now = stack.pop()
            yield now
            stack.extend(x for x in (self.lo[now], self.hi[now], self.eq[now]) if x != NONE)


def median_order(n: int) -> Iterator[int]:
    """0 ... n - 1, the median first, then those of both halves."""
    stack = [(0, n)]
    while stack:
        a, b = stack.pop()
        if a < b:
            mid = (a + b) // 2
            yield mid
            stack += [(mid + 1, b), (a, mid)]


def build(rows: list[tuple[list[int], list[int], int, int]]) -> TernaryTree:
    """Tree of (turns, words, count, first) in lexicographic order of the turns."""
    tree = TernaryTree()
    for k in median_order(len(rows)):
        tree.insert(*rows[k], k)
    return tree


NODE = T.StructType(
    [T.StructField("shard", T.IntegerType()), T.StructField("side", T.StringType())]
    + [
        T.StructField(c, T.LongType())
        for c in (
            "depth", "common", "k1", "k2", "p1", "p2", "conv_id", "parent_conv_id", "n_convs", "words",
            "n_children", "n_leaves", "saved_tokens", "end_n", "end_conv", "s1", "s2",
        )
    ]
)


def _path_keys(turns: list[int]) -> list[tuple[int, int]]:
    """128-bit names of all prefixes, the empty one first; the same in every shard."""
    out, state = [], b""
    for x in [0, *turns]:
        state = xxhash.xxh3_128_digest(state + int(x).to_bytes(8, "little", signed=True))
        out.append((int.from_bytes(state[:8], "little", signed=True), int.from_bytes(state[8:], "little", signed=True)))
    return out


def shard_nodes(rows: list[tuple[list[int], list[int], int, int]], names: list[tuple[int, int]], shard: int) -> dict[str, list]:
    """Columns of the nodes of one shard (see ``NODE``).

    Inner nodes (``side`` NULL) are complete.  The nodes on the path of the first sequence
    ("f") and the further ones on the path of the last ("l") hold what they have apart from
    boundary children; ``common`` is the depth down to which both paths agree.
    """
    tree = build(rows)
    first, last = rows[0][0], rows[-1][0]
    side, key = {}, {}
    for turns, name in ((first, "f"), (last, "l")):
        for node, k in zip(tree.path(turns), _path_keys(turns)):
            side.setdefault(node, name)
            key[node] = k
    common = max(tree.depth[n] for n in set(tree.path(first)) & set(tree.path(last)))
    size = len(tree.turn)
    children, leaves, saved = (array("q", bytes(8 * size)) for _ in range(3))
    for now in reversed(list(tree.preorder())):
        if now in side:
            continue
        if not children[now]:
            leaves[now] = 1
        saved[now] += (tree.count[now] - 1) * tree.words[now]
        up = tree.up[now]
        children[up] += 1
        leaves[up] += leaves[now]
        saved[up] += saved[now]
    out: dict[str, list] = {f.name: [] for f in NODE.fields}
    for now in range(size):
        up, end = tree.up[now], tree.end[now]
        k, p = key.get(now, (None, None)), key.get(up, (None, None))
        inner_parent = up != NONE and up not in side
        e = rows[end][2:] if end != NONE else (None, None)
        s = names[end] if end != NONE else (None, None)
        values = (
            shard, side.get(now), tree.depth[now], common, *k, *p, tree.first[now], tree.first[up] if inner_parent else None,
            tree.count[now], tree.words[now], children[now], leaves[now], saved[now], *e, *s,
        )
        for column, value in zip(out.values(), values):
            column.append(value)
    return out


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, names = [], []
    for batch in batches:
        get = {c: batch.column(c).to_pylist() for c in batch.schema.names}
        rows += list(zip(get["ids"], get["words"], get["n"], get["first"]))
        names += list(zip(get["s1"], get["s2"]))
    if rows:
        kinds = {T.IntegerType(): pa.int32(), T.StringType(): pa.string(), T.LongType(): pa.int64()}
        schema = pa.schema([(f.name, kinds[f.dataType]) for f in NODE.fields])
        table = pa.Table.from_pydict(shard_nodes(rows, names, TaskContext.get().partitionId()), schema=schema)
        yield from table.to_batches(max_chunksize=50_000)


def encode_turns(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Conversations as sequences: conv_id, ids (turn numbers) and words (of each turn).

    Turns are in order of ``turn`` (NULL first; ties by the first 16 characters of the role, the
    first 32 of the text, then by hash).  NULL role or text is empty; repeated rows are turns of
    their own.  Rows without conv_id belong to no conversation and are left out.  The numbers are those of a stored dictionary of the
    distinct turns; texts are told apart by 124 bits and never shuffled.
    """
    role_text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    whole = F.concat(F.octet_length(role_text[0]).cast("string"), F.lit(" "), *role_text).cast("binary")
    n_words = F.size(F.filter(F.split(role_text[1], f"[{BLANK}]+"), lambda w: w != "")).cast("long")
    own = rows.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.xxhash64(F.lit(1), whole).alias("d1"),
        F.conv(F.substring(F.md5(whole), 1, 15), 16, 10).cast("long").alias("d2"),
        n_words.alias("w"),
        F.substring(role_text[0], 1, 16).alias("r16"),
        F.substring(role_text[1], 1, 32).alias("t32"),
    )
    own = store(own, "turns")
    words = store(own.groupBy("d1", "d2").agg(F.min("w").alias("w")).withColumn("id", F.monotonically_increasing_id()), "turn_ids")
    coded = own.drop("w").join(words, ["d1", "d2"]).select("conv_id", F.struct("turn", "r16", "t32", "d1", "d2", "id", "w").alias("t"))
    turns = coded.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    in_order = turns.select("conv_id", _nulls_first("ts").alias("ts"))
    return in_order.select("conv_id", F.col("ts.id").alias("ids"), F.col("ts.w").alias("words"))


def _nulls_first(ts: str) -> Column:
    """``array_sort`` of structs puts NULL fields last or first depending on the release; this does not."""
    return F.concat(F.filter(ts, lambda t: t["turn"].isNull()), F.filter(ts, lambda t: t["turn"].isNotNull()))


def share_openings(convs: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversations whose first turns are those of the first one of their group of ``every`` numbers.

    The first h turns are replaced by those of conversation c - c % every (all if it has fewer,
    none if it is absent); h is the unsigned crc32 of the decimal number, modulo ``most``.
    """
    heads = convs.filter(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), *[F.slice(c, 1, most - 1).alias(f"head_{c}") for c in ("ids", "words")]
    )
    own = convs.withColumns({"base": F.col("conv_id") - F.col("conv_id") % every, "h": _opening(most)})
    joined = own.join(heads, "base", "left")
    rebuilt = [
        F.concat(
            F.coalesce(F.slice(f"head_{c}", F.lit(1), F.col("h")), F.array().cast("array<long>")),
            F.slice(c, F.col("h") + 1, F.greatest(F.size(c), F.lit(1))),
        ).alias(c)
        for c in ("ids", "words")
    ]
    return joined.select("conv_id", *rebuilt)


def _opening(most: int) -> Column:
    return (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")


def _hash_lists(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each sequence's blocks, which arrive in order; one state at a time is held."""
    now, state = None, None
    for pdf in batches:
        out = []
        for s1, s2, part in zip(pdf["s1"], pdf["s2"], pdf["part"]):
            if (s1, s2) == now:
                state.update(b",")
            else:
                if now is not None:
                    out.append((*now, state.hexdigest()))
                now, state = (s1, s2), hashlib.sha256()
            state.update(part.encode())
        yield pd.DataFrame(out, columns=["s1", "s2", "sha"]).astype({"s1": "int64", "s2": "int64"})
    if now is not None:
        yield pd.DataFrame([(*now, state.hexdigest())], columns=["s1", "s2", "sha"])


def _end_hashes(named: DataFrame, repeated: DataFrame) -> DataFrame:
    """Hash of the ascending numbers of the conversations of each repeated sequence.

    Numbers are gathered by blocks; a sequence's blocks then pass through one hash state in
    order, which SHA-256 asks for, so a group of any size takes no more memory than one block.
    """
    members = named.join(repeated, ["s1", "s2"], "left_semi").select("s1", "s2", "conv_id")
    blocks = members.groupBy("s1", "s2", F.floor(F.col("conv_id") / END_BLOCK).alias("block"))
    listed = blocks.agg(F.array_sort(F.collect_list("conv_id")).alias("c"))
    parts = listed.select("s1", "s2", "block", F.array_join(F.transform("c", lambda x: x.cast("string")), ",").alias("part"))
    ordered = parts.repartition("s1", "s2").sortWithinPartitions("s1", "s2", "block")
    return ordered.mapInPandas(_hash_lists, "s1 long, s2 long, sha string")


def prefix_trie(convs: DataFrame) -> DataFrame:
    """All nodes of the trie of the sequences in ``convs`` (conv_id, ids, words; one row each).

    One row per node: conv_id (smallest member), depth, parent_conv_id (NULL for the root),
    n_convs, n_children, n_leaves, saved_tokens (summed over the subtree: members beyond
    the first, times the words of the node's turn) and ends_sha256 (of the comma-joined numbers
    of the conversations that end at the node; none: of the empty string).

    Conversations without turns are members of the root.  Without conversations there are
    no rows.  Copies of a sequence are counted before they are dealt, so a sequence that a third
    of the conversations share is one row of one shard; an opening that many share is cut
    between shards like any other.  What a task holds is a shard of about ``SHARD_TURNS`` turns.
    """
    spark = convs.sparkSession
    names = [F.xxhash64(F.lit(k), "ids").alias(f"s{k}") for k in (1, 2)]
    named = store(convs.select("conv_id", "ids", "words", *names), "sequences")
    groups = named.groupBy("ids", "words", "s1", "s2").agg(F.count("*").alias("n"), F.min("conv_id").alias("first"))
    groups = store(groups, "distinct_sequences")
    turns = groups.agg(F.sum(F.size("ids"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // SHARD_TURNS))
    dealt = groups.repartitionByRange(shards, F.slice("ids", 1, RANGE_TURNS)).sortWithinPartitions("ids")
    nodes = store(dealt.mapInArrow(_shards, NODE), "trie_nodes")

    merged = store(_merge_boundary(nodes.filter("side is not null")), "boundary_nodes")
    inner = nodes.filter("side is null")
    hung = inner.filter("p1 is not null").drop("parent_conv_id")  # children of boundary nodes
    parents = nodes.filter("side is not null").select("shard", F.col("k1").alias("p1"), F.col("k2").alias("p2"))
    parents = parents.join(merged.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id")), ["p1", "p2"])
    hung = hung.join(parents, ["shard", "p1", "p2"])
    kept = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "end_n", "end_conv", "s1", "s2"]
    whole = inner.filter("p1 is null").select(kept).union(hung.select(kept)).union(merged.select(kept))

    many = F.coalesce(F.col("end_n") > 1, F.lit(False))
    hashes = _end_hashes(named, groups.filter("n > 1"))
    lone = F.sha2(F.coalesce(F.col("end_conv").cast("string"), F.lit("")).cast("binary"), 256)
    ends = whole.filter(~many).withColumn("ends_sha256", lone)
    shared = whole.filter(many).join(hashes.withColumnRenamed("sha", "ends_sha256"), ["s1", "s2"])
    out = [*kept[:7], "ends_sha256"]
    return ends.select(out).union(shared.select(out))


def _merge_boundary(rows: DataFrame) -> DataFrame:
    """Boundary nodes of all shards, each once, with the sums over their whole subtrees."""
    own = rows.groupBy("k1", "k2").agg(
        *[F.max(c).alias(c) for c in ("p1", "p2", "depth", "words", "end_n", "end_conv", "s1", "s2")],
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.min("conv_id").alias("conv_id"),
        F.min("shard").alias("owner"),
    )
    own = store(own, "boundary_sums")
    below = own.filter("p1 is not null").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("more"))
    own = own.join(below, ["k1", "k2"], "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0)
    own = own.withColumns(
        {
            "own_leaves": F.col("n_leaves") + leaf,
            "own_saved": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words"),
        }
    )
    own = store(own.drop("more", "n_leaves", "saved_tokens"), "boundary_own")
    # each node's own sum counts in the one shard that owns it; in a shard, subtrees are ends of its two paths
    here = rows.select("shard", "side", "depth", "common", "k1", "k2").join(
        own.select("k1", "k2", "owner", "own_leaves", "own_saved"), ["k1", "k2"]
    )
    down = W.partitionBy("shard", "side").orderBy(F.col("depth").desc()).rowsBetween(W.unboundedPreceding, 0)
    sums = []
    for c in ("leaves", "saved"):
        owned = F.when(F.col("shard") == F.col("owner"), F.col(f"own_{c}")).otherwise(0)
        branch = F.sum(F.when(F.col("side") == "l", owned)).over(W.partitionBy("shard"))
        at_branch = F.when((F.col("side") == "f") & (F.col("depth") <= F.col("common")), F.coalesce(branch, F.lit(0))).otherwise(0)
        sums.append((F.sum(owned).over(down) + at_branch).alias(c))
    parts = here.select("k1", "k2", *sums).groupBy("k1", "k2")
    totals = parts.agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    whole = own.join(totals, ["k1", "k2"])
    up = own.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    keys = [same(whole[c], up[c]) for c in ("p1", "p2")]
    return whole.join(up, keys, "left").drop(up["p1"]).drop(up["p2"])
