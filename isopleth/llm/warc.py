"""Web archives in ZIP packages.

A package is a ZIP file whose members are stored, not compressed: ``archive/data.warc``
holds WARC records one after the other, ``indexes/index.cdxj`` one JSON line a record with
its offset and length.  The reader parses the central directory (with its ZIP64 form),
finds archive and index members, and reads single records by byte range.

Paths are Hadoop or local paths; files are opened through ``pyarrow.fs``, so a
package may lie in any store that it knows.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isopleth.llm.common import store
from isopleth.session import new_dir

#: Payloads from this size on are stored once; equal ones become revisits.
REVISIT_BYTES = 1000
#: A package is closed when its archive member has this many bytes.
PACKAGE_BYTES = 64 << 20
#: Records whose ranges lie this close are fetched together, up to READ_BYTES.
READ_GAP, READ_BYTES = 4096, 4 << 20
#: Archive bytes that a reading task gets, about.
TASK_BYTES = 32 << 20
ARCHIVE, INDEX = "archive/data.warc", "indexes/index.cdxj"

# Fixed values of the ZIP format: signatures and the 32-bit and 16-bit marks for "see the ZIP64 field".
LOCAL, CENTRAL, END, END64, LOCATOR64 = b"PK\3\4", b"PK\1\2", b"PK\5\6", b"PK\6\6", b"PK\6\7"
MARK32, MARK16 = 0xFFFFFFFF, 0xFFFF
STORED = 0


def open_store(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and path within it of a Hadoop or local path."""
    if path.startswith("file:"):
        return arrow_fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return arrow_fs.FileSystem.from_uri(path) if "://" in path else (arrow_fs.LocalFileSystem(), path)


class PackageWriter:
    """Writes one package front to back: archive member, then index member, then directory.

    Sizes and checksums are known only at the end, so they stand in a data descriptor
    after each member (general purpose bit 3).  ``zip64`` forces the long form.
    """

    def __init__(self, out, zip64: bool = False) -> None:
        self.out, self.zip64, self.at, self.members = out, zip64, 0, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        self.members.append([name.encode(), self.at, 0, 0])
        raw = name.encode()
        self._put(LOCAL + struct.pack("<5H3I2H", 45, 8, STORED, 0, 0x21, 0, 0, 0, len(raw), 0) + raw)

    def add(self, data: bytes) -> int:
        """Append to the open member; returns the offset within it."""
        member = self.members[-1]
        offset = member[2]
        member[2] += len(data)
        member[3] = zlib.crc32(data, member[3])
        self._put(data)
        return offset

    def end_member(self) -> None:
        _, _, size, crc = self.members[-1]
        kind = "<I2Q" if self.zip64 or size >= MARK32 else "<3I"
        self._put(b"PK\7\x08" + struct.pack(kind, crc, size, size))

    def close(self) -> None:
        start = self.at
        long_form = self.zip64
        for raw, at, size, crc in self.members:
            wide = self.zip64 or size >= MARK32 or at >= MARK32
            long_form |= wide
            extra = struct.pack("<2H3Q", 1, 24, size, size, at) if wide else b""
            shown = (MARK32, MARK32, MARK32) if wide else (size, size, at)
            head = struct.pack("<6H3I5H2I", 45, 45, 8, STORED, 0, 0x21, crc, *shown[:2], len(raw), len(extra), 0, 0, 0, 0, shown[2])
            self._put(CENTRAL + head + raw + extra)
        size, count = self.at - start, len(self.members)
        long_form |= start >= MARK32
        if long_form:
            where = self.at
            self._put(END64 + struct.pack("<Q2H2I4Q", 44, 45, 45, 0, 0, count, count, size, start))
            self._put(LOCATOR64 + struct.pack("<IQI", 0, where, 1))
            self._put(END + struct.pack("<4H2IH", 0, 0, MARK16, MARK16, MARK32, MARK32, 0))
        else:
            self._put(END + struct.pack("<4H2IH", 0, 0, count, count, size, start, 0))
        self.out.close()


@dataclass(frozen=True)
class Member:
    name: str
    start: int  # of the data
    size: int


def _read(file, at: int, size: int) -> bytes:
    file.seek(at)
    data = file.read(size)
    if len(data) != size:
        raise ValueError(f"{size} bytes wanted at {at}, {len(data)} there")
    return data


def members(file, size: int) -> list[Member]:
    """Stored members of a package, from its central directory; ValueError if it is broken."""
    tail = _read(file, max(0, size - 66_000), min(size, 66_000))
    end = tail.rfind(END)
    while end >= 0 and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail):
        end = tail.rfind(END, 0, end)  # the signature may also stand in the comment
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<H2I", tail, end + 10)
    if MARK16 == count or MARK32 in (length, start):
        if tail[end - 20 : end - 16] != LOCATOR64:
            raise ValueError("no ZIP64 locator")
        (where,) = struct.unpack_from("<Q", tail, end - 12)
        head = _read(file, where, 56)
        if head[:4] != END64:
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<3Q", head, 32)
    directory, at, out = _read(file, start, length), 0, []
    for _ in range(count):
        if directory[at : at + 4] != CENTRAL:
            raise ValueError("broken central directory")
        method, packed, full, n, m, k, offset = struct.unpack_from("<6xH8x2I3H8xI", directory, at + 4)
        name = directory[at + 46 : at + 46 + n].decode()
        extra = directory[at + 46 + n : at + 46 + n + m]
        at += 46 + n + m + k
        while len(extra) >= 4:
            tag, width = struct.unpack_from("<2H", extra)
            if tag == 1:
                long_values = list(struct.unpack_from(f"<{width // 8}Q", extra, 4))
                full = long_values.pop(0) if full == MARK32 else full
                packed = long_values.pop(0) if packed == MARK32 else packed
                offset = long_values.pop(0) if offset == MARK32 else offset
            extra = extra[4 + width :]
        if method == STORED and packed == full:
            local = _read(file, offset, 30)
            if local[:4] != LOCAL:
                raise ValueError("broken local header")
            n, m = struct.unpack_from("<2H", local, 26)
            out.append(Member(name, offset + 30 + n + m, full))
    return out


def make_record(page_id, url: str | None, kind: str, refers_to, payload: bytes, digest: str) -> bytes:
    """WARC record of a payload; a revisit carries digest and length but no block."""
    block = payload if kind == "response" else b""
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{url}')}>",
        "WARC-Target-URI": (url or "").replace("\r", "%0D").replace("\n", "%0A"),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Length": len(block),
        "X-Payload-Length": len(payload),
    }
    if page_id is not None:
        head["X-Page-ID"] = page_id
    if kind == "revisit":
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        head["X-Refers-To-Page-ID"] = refers_to
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of one record; ValueError if it is cut short."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/") or not mark:
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    length = int(fields["Content-Length"])
    if rest[length:] != b"\r\n\r\n":
        raise ValueError("record and Content-Length differ")
    return fields, rest[:length]


def _whole(x) -> int | None:
    return None if pd.isna(x) else int(x)


def _writer(folder: str, package_bytes: int, zip64: bool):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """One package after the other; a name is used once, so a repeated task leaves no mixture."""
        files, base = open_store(folder)
        files.create_dir(base, recursive=True)
        package = path = None
        lines: list[bytes] = []

        def finish() -> pd.DataFrame:
            package.end_member()
            package.begin(INDEX)
            for k in range(0, len(lines), 1000):
                package.add(b"".join(lines[k : k + 1000]))
            package.end_member()
            package.close()
            return pd.DataFrame({"path": [path], "bytes": [package.at], "records": [len(lines)]})

        for pdf in batches:
            for page, url, html, refers in zip(pdf["page_id"], pdf["url"], pdf["html"], pdf["refers_to"]):
                if package is None:
                    name = f"part-{uuid.uuid4().hex}.wacz"
                    path = f"{folder}/{name}"
                    package = PackageWriter(files.open_output_stream(f"{base}/{name}"), zip64)
                    package.begin(ARCHIVE)
                    lines = []
                page, refers = _whole(page), _whole(refers)
                payload = (html or "").encode("utf-8", "surrogatepass")
                digest = hashlib.sha1(payload).hexdigest()
                kind = "response" if refers is None else "revisit"
                record = make_record(page, url, kind, refers, payload, digest)
                entry = {"offset": package.add(record), "length": len(record), "digest": digest}
                lines.append(json.dumps(entry).encode() + b"\n")
                if package.members[-1][2] >= package_bytes:
                    yield finish()
                    package = None
        if package is not None:
            yield finish()

    return write


def write_packages(
    pages: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES, zip64: bool = False
) -> DataFrame:
    """Write every row of ``pages`` (page_id, url, html) as a record; returns the packages' paths.

    Of equal payloads of at least ``REVISIT_BYTES`` the one with the largest page_id is a
    response and the others revisit it.  Only digests that occur twice are joined back.
    A NULL html is an empty payload; a NULL page_id never is the one referred to unless
    all are NULL, and then all are responses, as are repeated rows of the largest id.
    """
    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    payload = F.col("html").cast("binary")
    sized = own.withColumns({"d": F.sha1(payload), "n": F.octet_length(payload)})
    long_ones = sized.filter(F.col("n") >= REVISIT_BYTES).groupBy("d")
    groups = long_ones.agg(F.max("page_id").alias("last"), F.count("*").alias("copies"))
    groups = store(groups.filter("copies > 1").select(F.col("d").alias("digest"), "last"), "digests")
    joined = sized.join(groups, F.when(F.col("n") >= REVISIT_BYTES, F.col("d")) == F.col("digest"), "left")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last"))
    rows = joined.select("page_id", "url", "html", refers.alias("refers_to"))
    return store(rows.mapInPandas(_writer(folder, package_bytes, zip64), "path string, bytes long, records long"), "packages")


def _entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Byte ranges of all records of the packages, from their indexes."""
    for pdf in batches:
        for path, size in zip(pdf["path"], pdf["bytes"]):
            files, inner = open_store(path)
            with files.open_input_file(inner) as file:
                own = {m.name: m for m in members(file, int(size))}
                index, archive = own[INDEX], own[ARCHIVE]
                entries = [json.loads(x) for x in _read(file, index.start, index.size).splitlines()]
            for k in range(0, len(entries), 10_000):
                part = entries[k : k + 10_000]
                at = [archive.start + e["offset"] for e in part]
                if any(e["offset"] + e["length"] > archive.size for e in part):
                    raise ValueError(f"{path}: an index entry lies outside the archive")
                yield pd.DataFrame({"path": path, "at": at, "length": [e["length"] for e in part]})


def _ranges(at: list[int], length: list[int]) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """Fetches (start, size, records in it) for sorted ranges."""
    group: list[tuple[int, int]] = []
    for a, n in zip(at, length):
        if group and (a - sum(group[-1]) > READ_GAP or a + n - group[0][0] > READ_BYTES):
            yield group[0][0], sum(group[-1]) - group[0][0], group
            group = []
        group.append((a, n))
    if group:
        yield group[0][0], sum(group[-1]) - group[0][0], group


def _fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for path, part in pdf.groupby("path", sort=False):
            part = part.sort_values("at")
            files, inner = open_store(path)
            with files.open_input_file(inner) as file:
                for start, size, group in _ranges(part["at"].tolist(), part["length"].tolist()):
                    data, rows = _read(file, start, size), []
                    for a, n in group:
                        head, block = parse_record(data[a - start : a - start + n])
                        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                        if head["WARC-Type"] == "response" and hashlib.sha1(block).hexdigest() != digest:
                            raise ValueError(f"{path}: payload at {a} is damaged")
                        rows.append(
                            (
                                head.get("X-Page-ID"), head["WARC-Target-URI"], int(head["X-Payload-Length"]), digest,
                                head["WARC-Type"], head.get("X-Refers-To-Page-ID"), block,
                            )
                        )
                    out = pd.DataFrame(rows, columns=RECORD)
                    for c in ("page_id", "refers_to"):
                        out[c] = pd.array([None if x is None else int(x) for x in out[c]], "Int64")
                    yield out


RECORD = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]


def read_packages(packages: DataFrame) -> DataFrame:
    """Records of the packages (path, bytes): page_id, url, payload_bytes, payload_digest,
    record_type, refers_to and payload (binary, empty for revisits).

    A first step reads directories and indexes only; the ranges are then dealt out, so large
    packages are read by many tasks.  Damaged packages and payloads raise.
    """
    entries = packages.select("path", "bytes").repartition("path").mapInPandas(_entries, "path string, at long, length long")
    # the rows are tiny, what they stand for is not: a number of tasks by bytes, which Spark keeps
    size = packages.agg(F.sum("bytes")).first()[0] or 0
    dealt = entries.repartition(-(-size // TASK_BYTES) or 1, "path", F.floor(F.col("at") / F.lit(READ_BYTES)))
    kind = (
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long, payload binary"
    )
    return dealt.mapInPandas(_fetch, kind)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages as packages into the shared folder and read their records back."""
    return read_packages(write_packages(pages, new_dir(pages.sparkSession, "wacz")))
