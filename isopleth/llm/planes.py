"""Token ids in bit planes.

A file holds the ids of documents one after the other in blocks of ``BLOCK`` ids.  A block is
transposed: plane k has bit k of every id (or, with ``plane=8``, byte k), and each
plane is compressed by itself with zstandard, so that the nearly constant high planes cost almost
nothing.  A table of the documents and an index of all blocks end the file:

    MAGIC | planes of block 0 | ... | document tables | index | offset and size of the index, its crc32 | MAGIC

The index gives the place of every plane, so any range of ids is read without the rest.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from isopleth.llm.common import row_key, store
from isopleth.llm.warc import open_store
from isopleth.session import new_dir

MAGIC = b"IDPLANE1"
TAIL = struct.Struct("<QQI")
#: Ids of a block, of a file, and documents of one document table.
BLOCK, FILE_IDS, TABLE_DOCS = 1 << 16, 1 << 24, 1 << 16
LEVEL = 3
END_ID = 2
#: Tokenizer file; a name is looked up among the installed public tokenizers.
TOKENIZER = "word_bpe_49k.json"
#: Characters that are encoded at once, words that a worker remembers (and as many less recent ones), longest of them.
STEP_CHARS, CACHE_WORDS, CACHE_LENGTH = 1 << 20, 200_000, 100
#: Files of one step of the running sum over files.
SUM_STEP = 1024
#: Blanks that the tokenizer drops and that no token spans.
WORD = re.compile(r"[^ \t\n\r]+")
# The steps of the word tokenizer before its merges.
STEPS = ["NFC", "Replace", "Lowercase"]
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Printable ASCII and the Latin-1 letters: normal form already, one lower-case letter each, kinds beyond dispute.
LETTERS = "A-Za-z" + "".join(f"{chr(a)}-{chr(b)}" for a, b in ((0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0xFF)))
PLAIN = re.compile(rf"[ \t\n\r!-~{LETTERS}]*")
PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^ \t\n\r{LETTERS}0-9]+")


def tokenizer_path(name: str) -> str:
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_alphabet() -> dict[str, int]:
    """Letters by which byte-level vocabularies write bytes: printable ones stand for themselves,
    the others for the letters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def byte_letters() -> dict[int, str]:
    """Translation table of the characters below 256 to the letters of their bytes in UTF-8."""
    letter = {b: c for c, b in byte_alphabet().items()}
    return {k: "".join(letter[b] for b in chr(k).encode()) for k in range(256)}


class Remembered(dict):
    """What ``make`` gives for a string, made when first met.

    When ``limit`` strings are held they become the less recent half, which goes when the limit is
    reached again; a string in use moves back, so frequent ones stay.
    """

    def __init__(self, make: Callable[[str], Any], limit: int, longest: int = CACHE_LENGTH) -> None:
        super().__init__()
        self.make, self.limit, self.longest, self.older = make, limit, longest, {}

    def __missing__(self, key: str) -> Any:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self.learn(key, value)
        return value

    def learn(self, key: str, value: Any) -> None:
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[key] = value


    def learn_all(self, made: dict[str, Any]) -> None:
        if len(self) + len(made) > self.limit:
            self.older = dict(self)
            self.clear()
        self.update(made)


def packed(ids: list[int]) -> bytes:
    """Ids as 32-bit integers; what is remembered is put together without touching single ids."""
    return array("I", ids).tobytes()


class WordIds:
    """Ids of words under a tokenizer file.

    Where the file has the steps that are known here, plain text is cut into pieces without it and
    only the merges of a piece are its work; all else goes through the whole tokenizer word by word.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        config = json.loads(self.tokenizer.to_str())
        steps = [x["type"] for x in (config["normalizer"] or {}).get("normalizers", [])]
        before = (config["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0].get("pattern", {})
        self.known = steps == STEPS and before == {"Regex": PATTERN}
        self.letters = byte_letters()
        self.pieces = Remembered(self._piece, CACHE_WORDS)
        self.words = Remembered(self._word, CACHE_WORDS // 4)

    def _piece(self, piece: str) -> bytes:
        return packed([t.id for t in self.model.tokenize(piece if piece.isascii() else piece.translate(self.letters))])

    def _word(self, word: str) -> bytes:
        return packed(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def ids(self, text: str) -> np.ndarray:
        """Ids of a text that begins and ends with whole words."""
        if self.known and PLAIN.fullmatch(text) and not any(x in text for x in self.special):
            found = map(self.pieces.__getitem__, PIECE.findall(text.lower()))
        else:
            found = map(self.words.__getitem__, WORD.findall(text))
        return np.frombuffer(b"".join(found), np.uint32)


_encoders: dict[str, WordIds] = {}


def encoder(path: str) -> WordIds:
    """The worker's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = WordIds(path)
    return _encoders[path]


def pieces(text: str, limit: int = STEP_CHARS) -> Iterator[str]:
    """Consecutive parts of about ``limit`` characters, cut at blanks only."""
    start = 0
    while len(text) - start > limit:
        cut = max(text.rfind(b, start, start + limit) for b in " \t\n\r")
        if cut <= start:
            after = [k for b in " \t\n\r" if (k := text.find(b, start + limit)) >= 0]
            if not after:
                break
            cut = min(after)
        yield text[start:cut]
        start = cut
    yield text[start:]


def encode(text: str | None, ids: WordIds) -> Iterator[np.ndarray]:
    """Ids of a whole text, part by part.

    The tokenizer turns blanks into breaks that no token spans, so a text's ids are those of its
    words in turn, and a word's ids do not depend on its neighbours.
    """
    for part in pieces(text or ""):
        yield ids.ids(part)


def to_planes(ids: np.ndarray, plane: int = 1) -> list[bytes]:
    """Bit planes (or byte planes, ``plane=8``) of unsigned ids, lowest first, up to the highest bit in use."""
    width = int(ids.max()).bit_length() if len(ids) else 0
    octets = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if plane == 8:
        return [octets[:, k].tobytes() for k in range(-(-width // 8))]
    bits = np.unpackbits(octets, axis=1, bitorder="little")[:, :width]
    return [x.tobytes() for x in np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")]


def from_planes(planes: list[bytes], n: int, plane: int = 1) -> np.ndarray:
    """The ids again."""
    octets = np.zeros((n, 4), np.uint8)
    if plane == 8:
        for k, p in enumerate(planes):
            octets[:, k] = np.frombuffer(p, np.uint8)
    elif planes:
        bits = np.unpackbits(np.frombuffer(b"".join(planes), np.uint8).reshape(len(planes), -1), axis=1, count=n, bitorder="little")
        for k, bit in enumerate(bits):
            octets[:, k // 8] |= bit << (k % 8)
    return np.ascontiguousarray(octets).view("<u4").reshape(-1)


class PlaneWriter:
    """Writes one file front to back; holds one block and one document table at most."""

    def __init__(self, out, plane: int = 1) -> None:
        self.out, self.plane, self.at = out, plane, 0
        self.compress = zstandard.ZstdCompressor(level=LEVEL).compress
        self.parts: list[np.ndarray] = []
        self.waiting = self.ids = self.n_docs = 0
        self.blocks: list[list] = []
        self.tables: list[list[int]] = []
        self.docs: list[tuple[int | None, int]] = []
        self._put(MAGIC)

    def _put(self, data: bytes) -> int:
        self.out.write(data)
        self.at += len(data)
        return len(data)

    def add(self, ids: np.ndarray) -> int:
        """Append ids; returns how many."""
        self.parts.append(ids)
        self.waiting += len(ids)
        if self.waiting >= BLOCK:
            whole = np.concatenate(self.parts)
            full = len(whole) - len(whole) % BLOCK
            for k in range(0, full, BLOCK):
                self._block(whole[k : k + BLOCK])
            self.parts, self.waiting = [whole[full:]], len(whole) - full
        return len(ids)

    def _block(self, ids: np.ndarray) -> None:
        place, crc = self.at, zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
        sizes = [self._put(self.compress(p)) for p in to_planes(ids, self.plane)]
        self.blocks.append([place, len(ids), crc, sizes])
        self.ids += len(ids)

    def document(self, doc_id: int | None, n: int) -> None:
        """Close a document of the last ``n`` ids."""
        self.docs.append((doc_id, n))
        self.n_docs += 1
        if len(self.docs) >= TABLE_DOCS:
            self._table()

    def _table(self) -> None:
        ids, sizes = np.array([(d or 0, n) for d, n in self.docs], "<i8").reshape(-1, 2).T
        known = np.packbits([d is not None for d, _ in self.docs])
        data = self.compress(ids.tobytes() + sizes.tobytes() + known.tobytes())
        self.tables.append([self.at, self._put(data), len(self.docs)])
        self.docs = []

    def close(self) -> None:
        if self.waiting:
            self._block(np.concatenate(self.parts))
        if self.docs:
            self._table()
        index = {"plane": self.plane, "ids": self.ids, "docs": self.n_docs, "blocks": self.blocks, "tables": self.tables}
        data = self.compress(json.dumps(index).encode())
        place = self.at
        self._put(data)
        self._put(TAIL.pack(place, len(data), zlib.crc32(data)) + MAGIC)
        self.out.close()


class PlaneReader:
    """Reads the index of an open file, then any part of it by range."""

    def __init__(self, file) -> None:
        self.file, size = file, file.size()
        self.expand = zstandard.ZstdDecompressor().decompress
        tail = self._read(size - TAIL.size - len(MAGIC), TAIL.size + len(MAGIC)) if size > TAIL.size + len(MAGIC) else b""
        if not tail.endswith(MAGIC) or self._read(0, len(MAGIC)) != MAGIC:
            raise ValueError("not a plane file, or cut short")
        place, length, crc = TAIL.unpack(tail[: TAIL.size])
        data = self._read(place, length)
        if zlib.crc32(data) != crc:
            raise ValueError("the index is damaged")
        self.index = json.loads(self.expand(data))
        self.starts = np.cumsum([0] + [b[1] for b in self.index["blocks"]])

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def documents(self) -> Iterator[tuple[int | None, int]]:
        """(id, number of ids) of the documents in order."""
        for at, size, n in self.index["tables"]:
            data = self.expand(self._read(at, size))
            ids, sizes = np.frombuffer(data[: 16 * n], "<i8").reshape(2, n).tolist()
            known = np.unpackbits(np.frombuffer(data[16 * n :], np.uint8), count=n)
            yield from ((d if k else None, m) for d, m, k in zip(ids, sizes, known))

    def block(self, k: int) -> np.ndarray:
        at, n, crc, sizes = self.index["blocks"][k]
        data, planes, used = self._read(at, sum(sizes)), [], 0
        for size in sizes:
            planes.append(self.expand(data[used : used + size]))
            used += size
        ids = from_planes(planes, n, self.index["plane"])
        if zlib.crc32(ids.tobytes()) != crc:
            raise ValueError(f"block {k} is damaged")
        return ids

    def ids(self, start: int, n: int) -> np.ndarray:
        """The ids from ``start`` on, ``n`` at most; reads the blocks that hold them."""
        if n <= 0 or start >= self.index["ids"]:
            return np.zeros(0, "<u4")
        a = int(np.searchsorted(self.starts, start, "right")) - 1
        b = min(int(np.searchsorted(self.starts, start + n, "left")), len(self.index["blocks"]))
        whole = np.concatenate([self.block(k) for k in range(a, b)])
        return whole[start - self.starts[a] : start - self.starts[a] + n]


def _writer(folder: str, tokenizer: str, end_id: int, plane: int, file_ids: int):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """One file after the other; a name is used once, so a repeated task leaves no mixture."""
        ids = encoder(tokenizer_path(tokenizer))
        files, base = open_store(folder)
        files.create_dir(base, recursive=True)
        part, seq = TaskContext.get().partitionId(), 0
        end = np.array([end_id], np.uint32)
        out = path = None

        def finish() -> pd.DataFrame:
            out.close()
            return pd.DataFrame({"path": [path], "part": [part], "seq": [seq], "ids": [out.ids], "docs": [out.n_docs]})

        for pdf in batches:
            for doc, text in zip(pdf["doc_id"], pdf["text"]):
                if out is None:
                    name = f"part-{part:07d}-{seq:05d}-{uuid.uuid4().hex}.idp"
                    path = f"{folder}/{name}"
                    out = PlaneWriter(files.open_output_stream(f"{base}/{name}"), plane)
                n = sum(out.add(x) for x in encode(None if pd.isna(text) else text, ids)) + out.add(end)
                out.document(None if pd.isna(doc) else int(doc), n)
                if out.ids + out.waiting >= file_ids:
                    yield finish()
                    out, seq = None, seq + 1
        if out is not None:
            yield finish()

    return write


def write_ids(
    docs: DataFrame,
    folder: str,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    plane: int = 1,
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Encode every whole text and write the ids in ascending order of the documents' ids.

    One row per file: path, part and seq (files are in this order), ids, docs, and start (ids of all
    files before it).  Every document ends with ``end_id``.  NULL, empty and blank texts
    have that id only.  NULL doc_ids come first; equal doc_ids are in an order that follows from
    the texts.  Rows of one doc_id, or equal rows, may be cut between files.  Other columns are
    ignored; no documents give no files.  The texts are shuffled once, by ranges of the ids.
    """
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    own = own.withColumns({"rk": row_key(), "u": F.monotonically_increasing_id()})
    ordered = own.repartitionByRange("doc_id", "rk", "u").sortWithinPartitions("doc_id", "rk", "u").select("doc_id", "text")
    kind = "path string, part long, seq long, ids long, docs long"
    files = store(ordered.mapInPandas(_writer(folder, tokenizer, end_id, plane, file_ids), kind), "plane_files")
    step = F.floor(F.col("part") / SUM_STEP)
    before = files.groupBy(step.alias("step")).agg(F.sum("ids").alias("n"))
    before = before.select("step", F.coalesce(F.sum("n").over(W.orderBy("step").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inner = F.sum("ids").over(W.partitionBy("step").orderBy("part", "seq").rowsBetween(W.unboundedPreceding, -1))
    placed = files.withColumn("step", step).withColumn("inner", F.coalesce(inner, F.lit(0))).join(before, "step")
    return placed.select("path", "part", "seq", "ids", "docs", (F.col("base") + F.col("inner")).alias("start"))


def _reader(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for path, start in zip(pdf["path"], pdf["start"]):
            files, inner = open_store(path)
            with files.open_input_file(inner) as file:
                reader, rows = PlaneReader(file), []
                held, held_at = np.zeros(0, "<u4"), 0  # the last block read and its first id
                at, block = 0, 0
                for doc, n in reader.documents():
                    crc, end = 0, at + n
                    while at < end:
                        if at >= held_at + len(held):
                            held_at += len(held)
                            held = reader.block(block)
                            block += 1
                        part = held[at - held_at : end - held_at]
                        crc = zlib.crc32(part.tobytes(), crc)
                        at += len(part)
                    rows.append((doc, int(start) + end - n, n, crc))
                    if len(rows) >= 50_000:
                        yield _frame(rows)
                        rows = []
                yield _frame(rows)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"])
    return out.astype({"doc_id": "Int64", "start": "int64", "n_tokens": "int64", "ids_crc32": "int64"})


def read_documents(files: DataFrame) -> DataFrame:
    """Documents of the files (path, start): doc_id, start, n_tokens, ids_crc32 (of little-endian 32-bit ids).

    Each file is read by one task, a block at a time.  Damaged files raise.
    """
    n = files.count()
    dealt = files.select("path", "start").repartitionByRange(max(1, n), "path")
    return dealt.mapInPandas(_reader, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_ids(path: str, start: int, n: int) -> np.ndarray:
    """Ids ``start`` to ``start + n`` of one file, by its index."""
    files, inner = open_store(path)
    with files.open_input_file(inner) as file:
        return PlaneReader(file).ids(start, n)


def round_trip(docs: DataFrame) -> DataFrame:
    """Write the documents' ids below the shared folder and read them back."""
    files = store(write_ids(docs, new_dir(docs.sparkSession, "planes")), "plane_index")
    return read_documents(files)
