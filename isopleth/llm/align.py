"""Alignment of two tokenizers by an associative monoid of fragments.

A fragment is what a byte range of a text says about the alignment: the tokens up to and
including the first byte at which tokens of both sides end (the open prefix), the groups that
are closed after it, and the tokens behind the last such byte (the open suffix).  Two neighbouring
fragments compose by closing the group that the left suffix and the right prefix form.
Composition is associative, so the fragments of a text may be composed in any bracketing: within
a task they are folded, and the parts of very long documents, which different tasks encode,
are composed by a tree reduction.

Both tokenizers start anew before a space that follows no space and precedes no blank, and before
a line feed that follows no blank.  What stands between two such cuts (a unit) has the same
tokens wherever it occurs, so a byte range needs no more of its text than the units it touches,
and a worker remembers what it made of recent strings.

A block is the run of documents that a worker handles together.  It names its distinct linked
id pairs once, parts refer to them by number, and only these tables meet the corpus-wide counts.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cache, reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isopleth.llm.common import store
from isopleth.llm.planes import LETTERS, Remembered, byte_alphabet, byte_letters, packed, tokenizer_path

#: What the piece model and byte-level vocabularies write for a space.
BLANK_SIGN, SPACE_LETTER = chr(0x2581), chr(0x120)
LEFT, RIGHT = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Characters of a byte range of a very long document, how far from its end a cut is looked for, and of a block.
PART_CHARS, CONTEXT_CHARS, BLOCK_CHARS = 1 << 16, 1 << 12, 1 << 22
#: Units that a worker remembers (and as many less recent ones).
CACHE_UNITS = 200_000
#: Neighbouring fragments that one step of the tree reduction composes.
FAN_IN = 16
#: Letters that count as blanks in some tables only.
UNSURE = chr(0x180E) + chr(0x200B)
UNIT = re.compile(rf"(?: |\n+)[^\s{UNSURE}]+")
CUT = re.compile(rf"(?<! )(?= [^\s{UNSURE}])|(?<=[^\s{UNSURE}])(?=\n)")

#: The byte-level pattern for plain characters: ASCII and the Latin-1 letters, whose kinds are beyond dispute.
PLAIN = re.compile(rf"[ \t\n\r!-~{LETTERS}]+")
PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+")

Token = tuple[int, int]  # id, length in bytes
Side = tuple[Token, ...]


class Closed(NamedTuple):
    """Closed groups: as text, how many, and their links as 64-bit codes (left id << 32 | right id)."""

    text: str = ""
    n: int = 0
    codes: bytes = b""


def joined(*parts: Closed) -> Closed:
    return Closed(";".join(p.text for p in parts if p.n), sum(p.n for p in parts), b"".join(p.codes for p in parts))


def one_group(group: tuple[Side, Side]) -> Closed:
    """A single group from its tokens."""
    ids, sizes = zip(*(([t for t, _ in side], [n for _, n in side]) for side in group))
    codes = link_codes(*(np.array(x, np.int64) for x in ids), *(np.cumsum(x, dtype=np.int64) for x in sizes))
    return Closed("|".join(",".join(map(str, x)) for x in ids), 1, codes.tobytes())


@dataclass(frozen=True)
class Fragment:
    """Alignment of a byte range.

    ``met`` says whether tokens of both sides end at a common byte within the range (its start does
    not count).  If not, everything is prefix.  ``closed`` holds the groups between.
    """

    met: bool
    prefix: tuple[Side, Side]
    closed: Closed = Closed()
    suffix: tuple[Side, Side] = ((), ())

    def __add__(self, other: Fragment) -> Fragment:
        if not self.met:
            prefix = (self.prefix[0] + other.prefix[0], self.prefix[1] + other.prefix[1])
            return Fragment(other.met, prefix, other.closed, other.suffix)
        between = (self.suffix[0] + other.prefix[0], self.suffix[1] + other.prefix[1])
        if not other.met:
            return Fragment(True, self.prefix, self.closed, between)
        return Fragment(True, self.prefix, joined(self.closed, one_group(between), other.closed), other.suffix)


EMPTY = Fragment(False, ((), ()))


def link_codes(a: np.ndarray, b: np.ndarray, a_end: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """Codes of all token pairs that share bytes, in order.

    Both sides spell the same bytes.  Between two neighbouring ends of any token lies one pair,
    and each linked pair lies between one such two.
    """
    at = np.minimum(np.searchsorted(a_end, b_end), len(a_end) - 1)
    ends = np.sort(np.concatenate([a_end, b_end[a_end[at] != b_end]]), kind="stable")
    return (a[np.searchsorted(a_end, ends)] << 32) | b[np.searchsorted(b_end, ends)]


@cache
def _written(vocabulary: int) -> tuple[np.ndarray, ...]:
    """Ids as text with each of the three signs that may follow one."""
    return tuple(np.array([f"{i}{sign}" for i in range(vocabulary)], object) for sign in ",|;")


def close_groups(a: np.ndarray, b: np.ndarray, a_end: np.ndarray, b_end: np.ndarray, common: np.ndarray) -> Closed:
    """Groups of tokens that begin and end at common ends; ``common`` are the ends of the groups."""
    if not len(common):
        return Closed()
    comma, bar, semicolon = _written(1 << int(max(a.max(initial=0), b.max(initial=0), 1)).bit_length())
    group = [np.searchsorted(common, end) for end in (a_end, b_end)]
    words = [np.where(common[g] == end, last[ids], comma[ids]) for g, end, ids, last in zip(group, (a_end, b_end), (a, b), (bar, semicolon))]
    order = np.argsort(np.concatenate([2 * group[0], 2 * group[1] + 1]), kind="stable")
    return Closed("".join(np.concatenate(words)[order].tolist())[:-1], len(common), link_codes(a, b, a_end, b_end).tobytes())


def fragment(
    a: np.ndarray, b: np.ndarray, a_len: np.ndarray, b_len: np.ndarray, a_from: int = 0, b_from: int = 0, whole: bool = False
) -> Fragment:
    """Fragment of the tokens (ids and lengths) that end in a byte range; ``a_from`` and ``b_from`` are where the first ones begin.

    With ``whole`` the range is a whole text: its start is a common end, and the first group is closed too.
    """
    a_end, b_end = a_from + np.cumsum(a_len, dtype=np.int64), b_from + np.cumsum(b_len, dtype=np.int64)
    at = np.minimum(np.searchsorted(b_end, a_end), len(b_end) - 1)
    common = a_end[b_end[at] == a_end] if len(b_end) else b_end
    tokens = lambda i, j, k, m: (tuple(zip(a[i:j].tolist(), a_len[i:j].tolist())), tuple(zip(b[k:m].tolist(), b_len[k:m].tolist())))
    if not len(common):
        return Fragment(False, tokens(0, len(a), 0, len(b)))
    i, k = (0, 0) if whole else (int(np.searchsorted(e, common[0], "right")) for e in (a_end, b_end))
    j, m = (int(np.searchsorted(e, common[-1], "right")) for e in (a_end, b_end))
    closed = close_groups(a[i:j], b[k:m], a_end[i:j], b_end[k:m], common if whole else common[1:])
    return Fragment(True, tokens(0, i, 0, k), closed, tokens(j, len(a), m, len(b)))


class Tokenizers:
    """Both tokenizers of a worker, with the bytes of their tokens and what they made of recent strings."""

    def __init__(self, left: str, right: str) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.left = Tokenizer.from_file(left)
        self.left.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model = self.left.model
        self.right = sentencepiece.SentencePieceProcessor(model_file=right)
        letters = byte_alphabet()
        self.letters = byte_letters()
        # another kind of left tokenizer gets whole units
        config = json.loads(self.left.to_str())
        before = config["pre_tokenizer"]
        self.known = config["normalizer"] is None and before == before | {"type": "ByteLevel", "use_regex": True, "add_prefix_space": False}
        spelt = {i: bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t, i in self.left.get_vocab().items()}
        self.left_bytes = [spelt.get(i, b"") for i in range(max(spelt) + 1)]
        self.right_bytes = []
        for i in range(self.right.get_piece_size()):
            piece = self.right.id_to_piece(i)
            raw = bytes([int(piece[3:5], 16)]) if self.right.is_byte(i) else piece.replace(BLANK_SIGN, " ").encode()
            self.right_bytes.append(raw)
        self.left_len, self.right_len = (np.array([len(x) for x in side], np.int64) for side in (self.left_bytes, self.right_bytes))
        self.blank = self.right.piece_to_id(BLANK_SIGN)
        # where every byte has a letter of its own, plain text is always spelt
        self.known = self.known and set(letters.values()) <= {x[0] for x in self.left_bytes if len(x) == 1}
        self.pieces = Remembered(self._piece, CACHE_UNITS)
        self.left_units = Remembered(self._left, CACHE_UNITS // 4)
        self.right_units = Remembered(lambda x: self._right([x])[0], CACHE_UNITS)

    def _piece(self, piece: str) -> bytes:
        if piece[0] == " " and piece.isascii() and not piece.isspace():
            return packed([t.id for t in self.model.tokenize(SPACE_LETTER + piece[1:])])
        return packed([t.id for t in self.model.tokenize(piece.translate(self.letters))])

    def _left(self, unit: str) -> bytes:
        return packed(self._spelt(unit, self.left.encode(unit, add_special_tokens=False).ids, self.left_bytes))

    def _right(self, units: list[str]) -> list[bytes]:
        """Ids of units, which begin with a space or a line feed; the piece model adds a space of its own."""
        out = self.right.encode([x[1:] if x[0] == " " else x for x in units], num_threads=1)
        out = [[self.blank] if x == " " else ids if x[0] == " " else ids[1:] for x, ids in zip(units, out)]
        spell = self.right_bytes.__getitem__
        if b"".join([b"".join(map(spell, ids)) for ids in out]) != "".join(units).encode():
            out = [self._spelt(x, ids, self.right_bytes) for x, ids in zip(units, out)]
        return [array("I", ids).tobytes() for ids in out]

    @staticmethod
    def _spelt(unit: str, ids: list[int], spell: list[bytes]) -> list[int]:
        """The ids if their bytes are those of the unit, else none."""
        return ids if b"".join([spell[i] for i in ids]) == unit.encode() else []

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides for a text made of whole units; None if one of them does not spell it."""
        units = units_of(text)
        if self.known and PLAIN.fullmatch(text):  # cut here, so that only the merges of a piece are the tokenizer's work
            left = list(map(self.pieces.__getitem__, PIECE.findall(text)))
        else:
            left = list(map(self.left_units.__getitem__, units))
        known = self.right_units
        lacking = [x for x in set(units) if x not in known]
        if lacking:  # encoded together; what is too long to be remembered is met again below
            old = known.older
            made = {x: old[x] for x in lacking if x in old}
            new = [x for x in lacking if x not in made and len(x) <= known.longest]
            known.learn_all(made | dict(zip(new, self._right(new))))
        right = list(map(known.__getitem__, units))
        if b"" in left or b"" in right:
            return None
        return tuple(np.frombuffer(b"".join(side), np.uint32).astype(np.int64) for side in (left, right))


_workers: dict[tuple[str, str], Tokenizers] = {}


def tokenizers(left: str, right: str) -> Tokenizers:
    """The worker's pair of tokenizers."""
    if (left, right) not in _workers:
        _workers[left, right] = Tokenizers(tokenizer_path(left), tokenizer_path(right))
    return _workers[left, right]


def units_of(text: str) -> list[str]:
    """The units of a text that begins with a space or a line feed."""
    units = UNIT.findall(text)  # enough where blanks are single spaces and runs of line feeds
    return units if sum(map(len, units)) == len(text) else [x for x in CUT.split(text) if x]


def text_parts(text: str, limit: int = PART_CHARS, context: int = CONTEXT_CHARS) -> Iterator[tuple[str, int, int]]:
    """Consecutive ranges of a text, of about ``limit`` characters, as (window, skip, take).

    The window reaches from the cut at or before the range to the one at or after it, so that the
    tokens within are those of the whole text; the range is the ``take`` bytes of it behind the
    first ``skip``.  A range ends at its limit, in the middle of a token or not; only
    where no cut is within ``context`` characters of that place does it end at the next cut.
    """
    start = window = 0
    while start < len(text):
        end = right = after = len(text)
        if len(text) - start > limit:
            edge = start + limit
            found = CUT.search(text, edge)
            right = found.start() if found else len(text)
            before = [m.start() for m in CUT.finditer(text, max(start, edge - context), edge)]
            near = right - edge <= context and before
            end, after = (edge, before[-1]) if near and right > edge else (right, right)
        yield text[window:right], len(text[window:start].encode()), len(text[start:end].encode())
        start, window = end, after


def range_fragment(both: Tokenizers, window: str, skip: int, take: int) -> tuple[Fragment, int, int] | None:
    """Fragment of a range and its numbers of tokens; None if the window is not spelt."""
    sides = both.encode(window)
    if sides is None:
        return None
    cut = []
    for ids, sizes in zip(sides, (both.left_len, both.right_len)):
        ends = np.cumsum(sizes[ids])
        a, b = np.searchsorted(ends, [skip, skip + take], "right")
        cut.append((ids[a:b], sizes[ids[a:b]], int(ends[a - 1]) if a else 0))
    (a, a_len, a_from), (b, b_len, b_from) = cut
    return fragment(a, b, a_len, b_len, a_from, b_from), len(a), len(b)


class Blocks:
    """Collects rows with their linked pairs; hands out blocks, see the module's text."""

    def __init__(self, name: str) -> None:
        self.name, self.n = f"{name}{TaskContext.get().partitionId()}", 0
        self._clear()

    def _clear(self) -> None:
        self.rows: list[dict] = []
        self.pairs: list[np.ndarray] = []
        self.size = 0

    def add(self, row: dict, pairs: np.ndarray, size: int) -> None:
        self.rows.append(row)
        self.pairs.append(pairs)
        self.size += size

    def finish(self) -> pd.DataFrame:
        """One row for each part, and one (``head``) with the distinct pairs and how often each occurs."""
        name = f"{self.name}-{self.n}"
        distinct, times = np.unique(np.concatenate([np.zeros(0, np.int64), *self.pairs]), return_counts=True)
        small = "<u2" if len(distinct) <= 1 << 16 else "<u4"
        for row, pairs in zip(self.rows, self.pairs):
            own, n = np.unique(np.searchsorted(distinct, pairs), return_counts=True)
            times_kind = "<u1" if not len(n) or n.max() < 256 else "<u4"
            row |= {"block": name, "head": False, "pairs": own.astype(small).tobytes(), "counts": n.astype(times_kind).tobytes()}
        head = {"block": name, "head": True, "digest": None, "pairs": distinct.astype("<i8").tobytes(), "counts": times.astype("<i8").tobytes()}
        out = _typed(pd.DataFrame([head, *self.rows], columns=list(PART)), PART)
        self.n += 1
        self._clear()
        return out


#: Columns of the stored parts; ``digest`` is NULL for parts of very long documents.
PART = {
    "block": "string", "head": "boolean", "doc_id": "long", "u": "long", "n_a": "long", "n_b": "long", "n_groups": "long",
    "n_links": "long", "digest": "string", "pairs": "binary", "counts": "binary",
}
#: Fragments of byte ranges: ``at`` is the range in which the prefix closes; the open ends are (id, bytes) as 32-bit integers.
FRAGMENT = {"u": "long", "part": "long", "at": "long", "met": "boolean", "pa": "binary", "pb": "binary", "sa": "binary", "sb": "binary"}
#: Closed groups: those of a range (kind 1), or the one that closes where a range begins (kind 0).
GROUPS = {"u": "long", "at": "long", "kind": "int", "n_groups": "long", "n_a": "long", "n_b": "long", "text": "string", "codes": "binary"}


def _ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{c} {t}" for c, t in columns.items())


def _typed(pdf: pd.DataFrame, columns: dict[str, str]) -> pd.DataFrame:
    kinds = {"long": "Int64", "int": "Int32", "boolean": "boolean"}
    return pd.DataFrame({c: pdf[c].astype(kinds[t]) if t in kinds else _or_none(pdf[c]) for c, t in columns.items()})


def _or_none(column: pd.Series) -> pd.Series:
    """Objects, with None where a row had no value (a column of NaN alone is not taken for strings)."""
    column = column.astype(object)
    return column.where(column.notna(), None)


def _align_whole(left: str, right: str):
    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Documents that are a range of their own."""
        both, blocks = tokenizers(left, right), Blocks("w")
        for pdf in batches:
            for doc, u, text in zip(pdf["doc_id"], pdf["u"], pdf["text"]):
                row = {"doc_id": None if pd.isna(doc) else int(doc), "u": u, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "digest": ""}
                pairs = np.zeros(0, np.int64)
                sides = both.encode(" " + text) if text else None
                if sides is not None:
                    a, b = sides
                    closed = fragment(a, b, both.left_len[a], both.right_len[b], whole=True).closed
                    pairs = np.frombuffer(closed.codes, np.int64)
                    row |= {"n_a": len(a), "n_b": len(b), "n_groups": closed.n, "n_links": len(pairs)}
                    row["digest"] = hashlib.sha256(closed.text.encode()).hexdigest()
                blocks.add(row, pairs, len(text or ""))
                if blocks.size >= BLOCK_CHARS:
                    yield blocks.finish()
        if blocks.rows:
            yield blocks.finish()

    return align


def _align_ranges(left: str, right: str):
    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Fragment and closed groups of each byte range; ``ok`` is false if the tokens do not spell it."""
        both = tokenizers(left, right)
        columns = FRAGMENT | GROUPS | {"ok": "boolean"}
        for pdf in batches:
            rows = []
            for u, part, window, skip, take in zip(*(pdf[c] for c in ("u", "part", "window", "skip", "take"))):
                row = {"u": u, "part": part, "at": part, "kind": 1, "ok": False}
                made = range_fragment(both, window, skip, take)
                if made is not None:
                    f, n_a, n_b = made
                    row |= {"ok": True, "met": f.met, "n_a": n_a, "n_b": n_b, "n_groups": f.closed.n, "text": f.closed.text}
                    row |= {"codes": f.closed.codes} | _pack(f)
                rows.append(row)
            yield _typed(pd.DataFrame(rows, columns=list(columns)), columns)

    return align


def _pack(f: Fragment) -> dict[str, bytes]:
    ends = zip(("pa", "pb", "sa", "sb"), (*f.prefix, *f.suffix))
    return {name: np.array(tokens, "<i4").reshape(-1, 2).tobytes() for name, tokens in ends}


def _unpack(row) -> Fragment:
    pa, pb, sa, sb = (tuple(map(tuple, np.frombuffer(row[c], "<i4").reshape(-1, 2).tolist())) for c in ("pa", "pb", "sa", "sb"))
    return Fragment(bool(row["met"]), (pa, pb), Closed(), (sa, sb))


def compose(fragments: list[tuple[Fragment, int]]) -> tuple[Fragment, int, list[tuple[int, Closed]]]:
    """Composition of neighbours, each with the range in which its prefix closes, and the groups closed between them.

    The groups closed within the fragments are left out; they stay where they are.
    """
    whole, at, closed = replace(fragments[0][0], closed=Closed()), fragments[0][1], []
    for f, f_at in fragments[1:]:
        now = whole + replace(f, closed=Closed())
        if now.closed.n:
            closed.append((f_at, now.closed))
        if not whole.met:
            at = f_at
        whole = replace(now, closed=Closed())
    return whole, at, closed


def _group_row(u: int, at: int, group: Closed) -> dict:
    # the tokens are counted with their ranges
    return {"u": u, "at": at, "kind": 0, "n_groups": 1, "n_a": 0, "n_b": 0, "text": group.text, "codes": group.codes}


def _tree_step(last: bool):
    """One level of the tree: up to ``FAN_IN`` neighbours become one; the last level closes the first group as well."""
    columns = FRAGMENT | GROUPS

    def step(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        u, up = int(key[0]), int(key[1])
        whole, at, closed = compose([(_unpack(r), int(r["at"])) for r in pdf.to_dict("records")])
        rows = [_group_row(u, k, g) for k, g in closed]
        if last:
            rows += [_group_row(u, at, one_group(whole.prefix))] if whole.met else []
        else:
            rows.append({"u": u, "part": up, "at": at, "met": whole.met, **_pack(whole)})
        return _typed(pd.DataFrame(rows, columns=list(columns)), columns)

    return step


def _hash_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each document's groups, which arrive in order; one state at a time is held."""
    now = state = None
    for pdf in batches:
        out = []
        for u, text in zip(pdf["u"], pdf["text"]):
            if u == now:
                state.update(b";")
            else:
                out += [(now, state.hexdigest())] if state else []
                now, state = u, hashlib.sha256()
            state.update(text.encode())
        yield pd.DataFrame(out, columns=["u", "digest"]).astype({"u": "int64"})
    if state:
        yield pd.DataFrame([(now, state.hexdigest())], columns=["u", "digest"])


def _block_groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    blocks = Blocks("r")
    for pdf in batches:
        for u, n_a, n_b, n_groups, codes in zip(*(pdf[c] for c in ("u", "n_a", "n_b", "n_groups", "codes"))):
            pairs = np.frombuffer(codes, np.int64)
            blocks.add({"u": u, "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": len(pairs), "digest": None}, pairs, 4 * len(pairs))
            if blocks.size >= BLOCK_CHARS:
                yield blocks.finish()
    if blocks.rows:
        yield blocks.finish()


def _pairs_of_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for block, pairs, counts in zip(pdf["block"], pdf["pairs"], pdf["counts"]):
            code = np.frombuffer(pairs, "<i8")
            out = {"block": block, "k": np.arange(len(code), dtype=np.int32), "code": code, "n": np.frombuffer(counts, "<i8")}
            yield pd.DataFrame(out)


def _score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums over the links of each part; a block's counts come before its parts."""
    totals = best = None
    for pdf in batches:
        out = []
        for row in pdf.itertuples(index=False):
            if row.head:
                totals, best = np.asarray(row.totals, np.int64), np.asarray(row.bests, np.int64)
                continue
            n_best = count_sum = 0
            if row.n_links:
                own = np.frombuffer(row.pairs, "<u2" if len(totals) <= 1 << 16 else "<u4")
                n = np.frombuffer(row.counts, "<u1" if len(row.counts) == len(own) else "<u4").astype(np.int64)
                n_best, count_sum = int(n[best[own] == 1].sum()), int((n * totals[own]).sum())
            out.append((row.doc_id, row.u, row.n_a, row.n_b, row.n_groups, row.n_links, n_best, count_sum, row.digest))
        yield pd.DataFrame(out, columns=list(SCORED)).astype({c: "Int64" for c, t in SCORED.items() if t == "long"})


SCORED = {c: "long" for c in ("doc_id", "u", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")} | {"digest": "string"}


def _ranges(limit: int):
    @F.pandas_udf("array<struct<window: string, skip: long, take: long>>")
    def ranges(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([[dict(zip(("window", "skip", "take"), p)) for p in text_parts(" " + t, limit)] for t in texts], dtype=object)

    return ranges


def _long_documents(long: DataFrame, left: str, right: str, limit: int) -> tuple[DataFrame, DataFrame]:
    """(parts, digests) of documents that are cut into byte ranges."""
    spark = long.sparkSession
    cut = long.select("u", F.posexplode(_ranges(limit)("text")).alias("part", "p"))
    # the ranges are dealt out: those of one document are encoded by many tasks
    cut = cut.select("u", F.col("part").cast("long").alias("part"), "p.window", "p.skip", "p.take").repartition("u", "part")
    leaves = store(cut.mapInPandas(_align_ranges(left, right), _ddl(FRAGMENT | GROUPS | {"ok": "boolean"})), "fragments")
    bad = leaves.filter(~F.col("ok")).select("u").distinct()
    leaves = leaves.join(bad, "u", "left_anti")
    level = leaves.select(*FRAGMENT)
    widest = (leaves.agg(F.max("part")).first()[0] or 0) + 1
    closed = [leaves.filter("n_groups > 0 or n_a > 0 or n_b > 0").select(*GROUPS)]
    while True:
        last = widest <= FAN_IN
        grouped = level.withColumn("up", F.floor(F.col("part") / FAN_IN)).groupBy("u", "up")
        made = store(grouped.applyInPandas(_tree_step(last), _ddl(FRAGMENT | GROUPS)), "tree")
        closed.append(made.filter("kind = 0").select(*GROUPS))
        if last:
            break
        level, widest = made.filter("kind is null").select(*FRAGMENT), -(-widest // FAN_IN)
    groups = reduce(DataFrame.union, closed)
    parts = groups.mapInPandas(_block_groups, _ddl(PART))
    ordered = groups.filter("n_groups > 0").select("u", "at", "kind", "text")
    ordered = ordered.repartition("u").sortWithinPartitions("u", "at", "kind").select("u", "text")
    return parts, store(ordered.mapInPandas(_hash_groups, "u long, digest string"), "group_hashes")


def align_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    left: str = LEFT,
    right: str = RIGHT,
    part_chars: int = PART_CHARS,
) -> DataFrame:
    """How the tokens of two tokenizers lie on each other, for every whole text.

    One row per input row: doc_id, n_a, n_b (tokens), n_groups (between bytes at which tokens of both
    sides end), n_links (pairs of tokens that share bytes), n_best (links whose id pair is linked
    most often in the corpus among the pairs of its right id, ties included), count_sum (over the links,
    how often the id pair is linked in the corpus) and groups_sha256 (of the groups, as ``group_text``
    writes them, joined by semicolons).

    Texts that are NULL or empty, or that the tokens of one side do not spell, have zeros and an empty
    hash, and count nowhere.  Repeated rows are texts of their own.  No documents give no rows.  Texts
    of more than ``part_chars`` characters are cut into byte ranges, which are dealt to tasks; no other
    text is shuffled.  Pair counts of the corpus are joined to the blocks' tables, not broadcast.
    """
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    own = own.withColumn("u", F.monotonically_increasing_id())
    is_long = F.coalesce(F.length("text") > part_chars, F.lit(False))
    whole = own.filter(~is_long).mapInPandas(_align_whole(left, right), _ddl(PART))
    whole = store(whole, "aligned")
    long = store(own.filter(is_long), "long_texts")
    parts, digests = _long_documents(long, left, right, part_chars)
    stored = whole.union(store(parts, "aligned_ranges"))

    heads = stored.filter("head").select("block", "pairs", "counts")
    linked = store(heads.mapInPandas(_pairs_of_blocks, "block string, k int, code long, n long"), "block_pairs")
    counts = store(linked.groupBy("code").agg(F.sum("n").alias("total")), "pair_counts")
    right_id = F.col("code").bitwiseAND(F.lit((1 << 32) - 1))
    most = counts.groupBy(right_id.alias("b")).agg(F.max("total").alias("most"))
    ranked = counts.withColumn("b", right_id).join(most, "b")
    ranked = store(ranked.select("code", "total", (F.col("total") == F.col("most")).cast("long").alias("best")), "pair_ranks")
    scored = linked.join(ranked, "code").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("k", "total", "best"))).alias("s"))
    none = F.lit(None)
    heads = scored.select(
        "block", F.lit(True).alias("head"), *[none.cast(PART[c]).alias(c) for c in list(PART)[2:]],
        F.col("s.total").alias("totals"), F.col("s.best").alias("bests"),
    )
    rows = stored.filter("not head").select(*PART, *[none.cast("array<long>").alias(c) for c in ("totals", "bests")])
    dealt = heads.union(rows).repartition("block").sortWithinPartitions("block", F.col("head").desc())
    result = store(dealt.mapInPandas(_score, _ddl(SCORED)), "scores")

    sums = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    short = result.filter("digest is not null").select("doc_id", *sums, F.col("digest").alias("groups_sha256"))
    parts = result.filter("digest is null").groupBy("u").agg(*[F.sum(c).alias(c) for c in sums])
    ids = long.select("doc_id", "u").join(parts, "u", "left").join(digests, "u", "left")
    ids = ids.select("doc_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in sums], F.coalesce("digest", F.lit("")).alias("groups_sha256"))
    return short.union(ids)
