"""Near duplicates by SimHash fingerprints and Golay-code fuzzy hashing.

A fingerprint of 64 bits is cut into three segments of at most 23 bits.  If two
fingerprints differ in at most two bits, then by the pigeonhole principle some segment
agrees entirely and the one after it (cyclically) differs in at most one bit:

* errors (1, 1, 0) in any places: the clean segment's successor has one error;
* both errors in one segment: the segment two before it is clean, and so is the next.

So each fingerprint gets, for each of the three segments, the segment itself with
every Golay key of the next one: at most 18 keys.  Fingerprints that share a key are
candidates, and are verified by their Hamming distance.

Two bits of 64 hold little more than exact copies.  With a ``similarity`` the texts are compared
by the Jaccard similarity of their shingle sets instead.  Each set gets ``BANDS`` minimum
hashes, and beside each a segment of 23 bits, each bit drawn from a minimum hash of its own: at
similarity J a bit differs with probability (1 - J) / 2.  A minimum hash with each Golay key of its
segment is a bucket key.  Members of a bucket meet the nearest ones by their sketches, see
``candidates``; pairs whose sketches are near enough are verified by their whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isopleth.llm import golay
from isopleth.llm.common import bounded, discard, fresh, mix64, row_key, same, store
from isopleth.llm.components import components


SHINGLE = 3
SEED = 42
MAX_BITS = 2
#: First bit and width of the three segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fingerprints of a bucket that are compared pairwise; larger buckets go by midpoints, see ``links``.
PAIRWISE = 64
#: Minimum hashes of a shingle set that are bucketed, each with a segment of the sketch.
BANDS = 8
SKETCH_BITS = BANDS * golay.LENGTH
SKETCH_WORDS = -(-SKETCH_BITS // 64)
#: Members of a bucket up to which all near pairs are candidates; members that meet in one block of larger
#: ones, on average; minimum hashes that refine buckets of more than a block.
SMALL, BLOCK, REFINING = 6, 64, 3
#: Standard deviations by which the sketches of a candidate may differ more than the similarity lets expect.
SPARE = 5.0
#: Odd multipliers of the minimum hashes: first those that are bucketed, then one for each sketch bit.
MULTIPLIERS = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS + SKETCH_BITS, np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, size: int = SHINGLE) -> list[bytes]:
    """Shingles of the text with A-Z lower-cased, repeats included; fewer words: the whole sequence."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    return [b" ".join(x) for x in zip(*(words[k:] for k in range(size)))]


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash; 0 for a text without words."""
    parts = shingles(text, size)
    if not parts:
        return 0
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in parts), np.uint64, len(parts))
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        block = hashes[k : k + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def _fingerprints(size: int):
    @F.pandas_udf(T.LongType())
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        """Fingerprint of every text, as a signed long."""
        for texts in batches:
            yield pd.Series(
                [int(np.uint64(fingerprint(t, size)).astype(np.int64)) for part in bounded(texts) for t in part], dtype="int64"
            )

    return prints


def bucket_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, key) of all bucket keys of unsigned fingerprints."""
    seg = [(prints >> np.uint64(a)) & np.uint64((1 << n) - 1) for a, n in SEGMENTS]
    rows, out = [], []
    for k in range(3):
        index, real = golay.keys(seg[(k + 1) % 3])
        key = (np.int64(k) << 40) | (seg[k].astype(np.int64)[:, None] << 12) | index
        at, _ = np.nonzero(real)
        rows.append(at)
        out.append(key[real])
    return np.concatenate(rows), np.concatenate(out)


def _keys_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        prints = pdf["fp"].to_numpy(np.int64)
        for k in range(0, len(prints), 50_000):
            part = prints[k : k + 50_000]
            rows, key = bucket_keys(part.view(np.uint64))
            yield pd.DataFrame({"key": key, "fp": part[rows]})


def _bucket_links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Verified links inside each bucket: as many as join its members, not all pairs."""
    for pdf in batches:
        u, v = [], []
        for members in pdf["fps"]:
            a = np.sort(np.asarray(members, np.int64))
            near = np.bitwise_count(a.view(np.uint64)[:, None] ^ a.view(np.uint64)[None, :]) <= MAX_BITS
            root = np.arange(len(a))
            for i, j in np.argwhere(np.triu(near, 1)):
                x, y = i, j
                while root[x] != x:
                    x = root[x]
                while root[y] != y:
                    y = root[y]
                if x != y:
                    root[max(x, y)] = min(x, y)
                    u.append(a[i])
                    v.append(a[j])
        yield pd.DataFrame({"u": np.array(u, np.int64), "v": np.array(v, np.int64)})


def _midpoints(prints: DataFrame) -> DataFrame:
    """Links among fingerprints by their midpoints, 65 rows for each.

    Two fingerprints differ in at most two bits if and only if some value is within one
    bit of both.  A value has at most 65 fingerprints within one bit, so no group is large.
    """
    around = F.expr("concat(array(fp), transform(sequence(0, 63), k -> fp ^ shiftleft(1L, k)))")
    rows = prints.select("fp", F.explode(around).alias("mid"))
    groups = rows.groupBy("mid").agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
    pairs = groups.select(F.array_min("fps").alias("u"), F.explode("fps").alias("v"))
    return pairs.filter("u <> v").distinct()


def links(prints: DataFrame, pairwise: int = PAIRWISE) -> DataFrame:
    """Links (u, v) among distinct fingerprints (column fp) that join all within two bits.

    Buckets of up to ``pairwise`` fingerprints are verified pair by pair in a task.  The
    fingerprints of larger buckets are verified through midpoints, which finds the same links
    without forming pairs; ``pairwise`` only chooses between two exact ways.
    """
    keyed = store(prints.select("fp").mapInPandas(_keys_of, "key long, fp long"), "golay")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    sizes = store(sizes, "buckets")
    shared = store(keyed.join(sizes, "key"), "candidates")
    small = shared.filter(F.col("n") <= pairwise).groupBy("key").agg(F.collect_list("fp").alias("fps"))
    found = small.select("fps").distinct().mapInPandas(_bucket_links, "u long, v long")
    large = shared.filter(F.col("n") > pairwise).select("fp").distinct()
    return found.union(_midpoints(large)).distinct()


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    return np.unique(np.array([xxhash.xxh64_intdigest(s, SEED) for s in set(shingles(text, size))], np.uint64))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sorted sets, not both empty."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def minimum_hashes(hashes: np.ndarray) -> np.ndarray:
    """Minimum of a set under each multiplier, mixed so that every bit may serve."""
    low = np.full(len(MULTIPLIERS), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(hashes), 512):
        np.minimum(low, (hashes[None, k : k + 512] * MULTIPLIERS[:, None]).min(axis=1), out=low)
    return mix64(low)


def set_keys(minima: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n, keys) bucket keys of the sets' minimum hashes, which of them are not padding, and (n, words) sketches."""
    n = len(minima)
    bits = (minima[:, BANDS:] & np.uint64(1)).astype(np.uint8)
    segments = bits.reshape(-1, golay.LENGTH) @ (1 << np.arange(golay.LENGTH))
    index, real = golay.keys(segments)
    heads = mix64(minima[:, :BANDS] + np.arange(BANDS, dtype=np.uint64)).reshape(-1, 1)
    packed = np.zeros((n, SKETCH_WORDS * 8), np.uint8)
    packed[:, : -(-SKETCH_BITS // 8)] = np.packbits(bits, axis=1)
    return mix64(heads + index.astype(np.uint64)).reshape(n, -1), real.reshape(n, -1), packed.view(np.uint64)


def _sketches(size: int):
    words = [f"w{k}" for k in range(SKETCH_WORDS)]

    @F.pandas_udf("node long, keys array<long>, heads array<long>, " + ", ".join(f"{w} long" for w in words))
    def sketch(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        """Name of the shingle set (0: no words), bucket keys, minimum hashes and sketch of every text."""
        for texts in batches:
            nodes, minima = [], []
            for part in bounded(texts):
                for t in part:
                    own = shingle_set(t, size)
                    nodes.append(xxhash.xxh3_64_intdigest(own.tobytes(), SEED) if len(own) else 0)
                    minima.append(minimum_hashes(own))
            minima = np.stack(minima) if nodes else np.zeros((0, len(MULTIPLIERS)), np.uint64)
            keys, real, packed = set_keys(minima)
            out = {"node": np.array(nodes, np.uint64).view(np.int64)}
            out["keys"] = [k[r].view(np.int64) if n else k[:0].view(np.int64) for n, k, r in zip(nodes, keys, real)]
            out["heads"] = list(minima[:, :REFINING].view(np.int64))
            yield pd.DataFrame(out | {w: packed[:, k].view(np.int64) for k, w in enumerate(words)})

    return sketch


def most_bits(similarity: float) -> int:
    """Bits in which the sketches of a candidate may differ."""
    p = (1 - similarity) / 2
    return int(SKETCH_BITS * p + SPARE * np.sqrt(SKETCH_BITS * p * (1 - p)))


def _meeting(most: int, width: int):
    """Pairs of members of a block whose sketches differ in at most ``most`` bits; a member is node, root and sketch words.

    Members with one root are joined already and do not meet.  In a block of up to ``SMALL`` members all pairs are
    given, in a larger one those of every member with the one nearest to it, the smallest node of several.
    """

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [np.zeros((0, 2), np.int64)]
            for members in pdf["members"]:
                a = np.asarray(members, np.int64).reshape(-1, width)
                a = a[np.argsort(a[:, 0])]
                words = a[:, 2:].view(np.uint64)
                bits = np.bitwise_count(words[:, None] ^ words[None]).sum(axis=2, dtype=np.int64)
                bits[a[:, None, 1] == a[None, :, 1]] = SKETCH_BITS + 1
                if len(a) <= SMALL:
                    i, j = np.nonzero(np.triu(bits <= most, 1))
                else:
                    j = bits.argmin(axis=1)
                    i = np.flatnonzero(bits.min(axis=1) <= most)
                    j = j[i]
                out.append(np.sort(np.stack([a[i, 0], a[j, 0]], axis=1), axis=1))
            found = np.unique(np.concatenate(out), axis=0)
            yield pd.DataFrame({"u": found[:, 0], "v": found[:, 1]})

    return pairs


def _dealt(rows: DataFrame, key: str, salt: int) -> DataFrame:
    """Members of buckets (``key``, n, node, ...) with the block of their bucket that ``salt`` deals them to."""
    blocks = F.ceil(F.col("n") / BLOCK)
    return rows.withColumn("block", F.xxhash64(key, F.pmod(F.xxhash64(F.lit(salt), key, "node"), blocks)))


def _block_pairs(rows: DataFrame, words: list[str], most: int) -> DataFrame:
    """Candidate pairs (u, v), each once, within the blocks of the rows (block, node, root, sketch words)."""
    members = F.flatten(F.collect_list(F.array("node", "root", *words))).alias("members")
    blocks = rows.groupBy("block").agg(members, F.count("*").alias("m")).filter("m > 1").select("members")
    return store(blocks.mapInPandas(_meeting(most, 2 + len(words)), "u long, v long").distinct(), "pairs")


def _words(rows: DataFrame) -> list[str]:
    """Columns that hold the sketch."""
    return [c for c in (f"w{k}" for k in range(SKETCH_WORDS)) if c in rows.columns]


def candidates(nodes: DataFrame, most: int = SKETCH_BITS) -> tuple[DataFrame, DataFrame]:
    """(first, members): first candidate pairs (u, v) of the nodes (node, keys, heads, sketch words), and the
    members of the larger buckets, among which ``later_candidates`` seeks others once the first are verified.

    Members of a bucket meet in blocks of about ``BLOCK``; a block compares all its sketches and gives, for
    more than ``SMALL`` members, each one's nearest.  So pairs and rows grow in proportion to
    the bucket entries, whatever the size of a bucket, and no bucket or member is dropped or cut.
    """
    words = _words(nodes)
    keyed = store(nodes.select("node", F.explode("keys").alias("key")), "golay")
    sums = store(keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "buckets")
    shared = keyed.join(sums, "key").join(nodes.select("node", "heads", *words), "node")
    shared = store(shared, "members")
    discard(keyed)
    first = _block_pairs(_dealt(shared, "key", 0).withColumn("root", F.col("node")), words, most)
    return first, shared.filter(F.col("n") > SMALL)


def later_candidates(members: DataFrame, roots: DataFrame, most: int) -> DataFrame:
    """Further candidate pairs (u, v), of nodes without a common root (node, root), from the members of large buckets.

    Each member meets the nearest one of another root.  Buckets of more than one block are dealt
    anew, and beside them stand the finer buckets of members that share one of ``REFINING`` further minimum
    hashes too, in which texts that are alike stay together and others part.
    """
    words = _words(members)
    rows = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rows = store(rows, "rooted")
    finer = rows.filter(F.col("n") > BLOCK).select("key", "node", "root", *words, F.posexplode("heads").alias("k", "head"))
    finer = finer.select(F.xxhash64("key", "k", "head").alias("fine"), "node", "root", *words)
    finer = finer.join(finer.groupBy("fine").agg(F.count("*").alias("n")).filter("n > 1"), "fine")
    block = ["block", "node", "root", *words]
    pairs = _block_pairs(_dealt(rows, "key", 1).select(block).union(_dealt(finer, "fine", 1).select(block)), words, most)
    discard(rows)
    return pairs


def _alike(similarity: float):
    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            good = [
                jaccard(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) >= similarity for a, b in zip(pdf["a"], pdf["b"])
            ]
            yield pdf.loc[np.array(good, bool), ["u", "v"]]

    return check


def _set_bytes(size: int):
    @F.pandas_udf(T.BinaryType())
    def sets(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shingle_set(t, size).tobytes() for part in bounded(texts) for t in part], dtype=object)

    return sets


def _verified(pairs: DataFrame, nodes: DataFrame, own: DataFrame, size: int, similarity: float) -> DataFrame:
    """The pairs (u, v) whose whole shingle sets are similar enough; only texts of such pairs are shuffled."""
    ends = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    ends = store(ends.join(nodes.select("node", "one"), "node"), "ends")
    rows = own.withColumn("one", F.struct(row_key().alias("rk"), F.col("doc_id").alias("id"))).join(ends, "one")
    sets = rows.select("node", _set_bytes(size)("text").alias("own"))
    sets = store(sets.groupBy("node").agg(F.any_value("own").alias("own")), "sets")
    both = pairs.join(sets.select(F.col("node").alias("u"), F.col("own").alias("a")), "u")
    both = both.join(sets.select(F.col("node").alias("v"), F.col("own").alias("b")), "v")
    return store(both.select("u", "v", "a", "b").mapInPandas(_alike(similarity), "u long, v long"), "links")


def set_links(nodes: DataFrame, own: DataFrame, size: int, similarity: float) -> DataFrame:
    """Verified links (u, v) that join the shingle sets.

    The first candidates are verified, then later ones whose ends the first links have not joined.
    So m near copies cost about m verifications a round, not m * m.
    """
    most = most_bits(similarity)
    first, members = candidates(nodes, most)
    links = _verified(first, nodes, own, size, similarity)
    roots = store(components(links), "roots")
    later = later_candidates(members, roots, most)
    rest = store(later.join(first, ["u", "v"], "left_anti"), "pairs")
    for table in (members, first, later):
        discard(table)
    return links.union(_verified(rest, nodes, own, size, similarity))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, similarity: float | None = None
) -> DataFrame:
    """Fingerprint and component of every whole text, by shingles of ``size`` words.

    One row per input row: doc_id, rk (row key), fingerprint (16 hex digits), component_id (the
    smallest non-NULL id that steps of at most two bits lead to) and root (names the component).
    With ``similarity`` a step leads to a text whose shingle set has at least that Jaccard
    similarity, and the fingerprint names the shingle set.

    Texts that are NULL, empty or blank have fingerprint zero and are linked like any other.
    Documents of one fingerprint share a node, so copies cost nothing and repeated rows repeat
    their result.  If all ids of a component are NULL, so is component_id.  Only
    fingerprints are shuffled, never texts.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    if similarity is None:
        prints = store(own.select("doc_id", row_key().alias("rk"), _fingerprints(size)("text").alias("fp")), "prints")
        nodes = store(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
        joined = links(nodes)
    else:
        prints = own.select("doc_id", row_key().alias("rk"), _sketches(size)("text").alias("s"))
        sketch = ["keys", "heads", *[f"w{k}" for k in range(SKETCH_WORDS)]]
        prints = store(prints.select("doc_id", "rk", F.col("s.node").alias("fp"), *[f"s.{c}" for c in sketch]), "prints")
        one = F.min(F.struct("rk", F.col("doc_id").alias("id"))).alias("one")
        same_set = [F.any_value(c).alias(c) for c in sketch]
        nodes = store(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), one, *same_set), "nodes")
        joined = set_links(nodes.withColumnRenamed("fp", "node"), own, size, similarity)
    roots = components(joined).withColumnsRenamed({"node": "fp"})
    rooted = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = store(rooted.select("fp", "root").join(firsts, "root").select("fp", "component_id", "root"), "classes")
    return prints.join(named, "fp").select(
        "doc_id", "rk", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root"
    )


def drop_near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, similarity: float | None = None
) -> DataFrame:
    """The rows of ``docs`` that are left if one document of each component stays.

    The document with the component's id stays; of repeated rows (same id and text) one.  Of
    rows with that id but other texts, and of a component without ids, the one with the
    smallest row key stays.  All columns are kept.  The texts are shuffled once.
    """
    found = near_duplicates(docs, doc_id, text, size, similarity)
    best = found.filter(same(F.col("doc_id"), F.col("component_id"))).groupBy("root")
    key, pick = fresh(docs, "key"), fresh(docs, "pick")
    best = best.agg(F.min(F.struct("rk", "doc_id")).alias(pick))
    best = store(best.select(pick), "kept")
    keyed = docs.withColumn(key, F.struct(row_key(doc_id, text).alias("rk"), F.col(doc_id).alias("doc_id")))
    return keyed.join(best, keyed[key] == best[pick], "left_semi").dropDuplicates([key]).drop(key)
