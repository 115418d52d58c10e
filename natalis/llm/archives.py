"""Web archives inside ZIP packages: WARC records written in packages, and read back in place.

A package is a ZIP file whose members are stored, not compressed: ``archive/*.warc.gz`` with one gzip member per
record, and ``indexes/*.cdxj`` with a line per record that gives its place. A reader looks at the end of the file
only to find the central directory (32-bit or ZIP64), takes the place of the members from it, reads the index and
then just the bytes of each wanted record. Nothing is unpacked to disk.

Tasks write each package under a name of their own and hand on its path. The table of paths is stored by Spark's
committer, so a package of a lost or repeated task is never read. Files are opened through Arrow's file systems.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from natalis.llm.shared import bounded_batches, fresh_path, saved

PACKAGE_BYTES = 32 << 20
READ_BLOCK = 8 << 20
NO_DATE = "1970-01-01T00:00:00Z"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URI_SAFE = "".join(chr(c) for c in range(33, 127) if chr(c) not in '"<>\\^`{|}')


# --- ZIP -------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Member:
    """A member of a ZIP file: the place of its local header, its compression method and sizes."""

    name: str
    header: int
    method: int
    packed: int
    size: int


def file_at(path: str):
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def _read(file, start: int, length: int) -> bytes:
    file.seek(start)
    data = file.read(length)
    if len(data) < length:
        raise ValueError(f"the file ends before byte {start + length}")
    return data


def directory(file, size: int) -> list[Member]:
    """Members listed in the central directory, with ZIP64 fields where the 32-bit ones are full."""
    tail_at = max(0, size - 22 - 0xFFFF - 20)
    tail = _read(file, tail_at, size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and (len(tail) - at < 22 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("no end of central directory: not a ZIP file")
    entries, length, start = struct.unpack_from("<HII", tail, at + 10)
    if at >= 20 and tail[at - 20 : at - 16] == b"PK\x06\x07":
        (end,) = struct.unpack_from("<Q", tail, at - 12)
        record = _read(file, end, 56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("the ZIP64 locator points to no ZIP64 record")
        entries, length, start = struct.unpack_from("<QQQ", record, 32)
    data, members, at = _read(file, start, length), [], 0
    for _ in range(entries):
        if data[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", data, at + 8)
        packed, full = struct.unpack_from("<II", data, at + 20)
        n, extra, comment = struct.unpack_from("<HHH", data, at + 28)
        (header,) = struct.unpack_from("<I", data, at + 42)
        name = data[at + 46 : at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        field, end = at + 46 + n, at + 46 + n + extra
        while field + 4 <= end:
            kind, width = struct.unpack_from("<HH", data, field)
            if kind == 1:  # 64-bit values of the full fields only, in this order
                place = field + 4
                for what in ("full", "packed", "header"):
                    if {"full": full, "packed": packed, "header": header}[what] == 0xFFFFFFFF:
                        (value,) = struct.unpack_from("<Q", data, place)
                        place += 8
                        full, packed, header = (
                            value if what == "full" else full,
                            value if what == "packed" else packed,
                            value if what == "header" else header,
                        )
            field += 4 + width
        members.append(Member(name, header, method, packed, full))
        at = end + comment
    return members


def data_start(file, member: Member) -> int:
    """First byte of a member's data, behind its local header."""
    head = _read(file, member.header, 30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError(f"no local header for {member.name}")
    name, extra = struct.unpack_from("<HH", head, 26)
    return member.header + 30 + name + extra


def member_bytes(file, member: Member) -> bytes:
    """A whole small member, such as an index: stored, deflated, or a gzip file in either form."""
    data = _read(file, data_start(file, member), member.packed)
    if member.method == zipfile.ZIP_DEFLATED:
        data = zlib.decompress(data, -15)
    elif member.method != zipfile.ZIP_STORED:
        raise ValueError(f"{member.name}: compression method {member.method}")
    return gzip.decompress(data) if member.name.endswith(".gz") else data


# --- WARC ------------------------------------------------------------------------------------------


def record_id(key: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'record:{key}')}>"


def record_bytes(key: str | None, url: str | None, payload: bytes, digest: str, refers_to: tuple | None) -> bytes:
    """A WARC/1.1 record. ``refers_to`` is None for a response, else (key of the response,), without a payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(key)}",
        f"WARC-Date: {NO_DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=_URI_SAFE)}")
    if key is not None:
        head.append(f"X-Record-Key: {quote(key)}")
    if refers_to is not None:
        head += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: {record_id(refers_to[0])}"]
        if refers_to[0] is not None:
            head.append(f"X-Refers-To-Key: {quote(refers_to[0])}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Header fields, HTTP header fields and payload of one uncompressed record."""
    if not data.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, _fields(http), payload


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- packages --------------------------------------------------------------------------------------


def package(records: bytes, lines: list[str]) -> bytes:
    """A ZIP package of one archive of concatenated gzip records and its index."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for name, data in (
            ("archive/data.warc.gz", records),
            ("indexes/index.cdxj", "".join(lines).encode()),
            ("datapackage.json", json.dumps({"profile": "data-package", "wacz_version": "1.1.1"}).encode()),
        ):
            z.writestr(zipfile.ZipInfo(name), data)
    return out.getvalue()


def write_packages(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    text_col: str = "html",
    min_bytes: int = 0,
    package_bytes: int = PACKAGE_BYTES,
) -> DataFrame:
    """Write a record per row into packages in the shared folder; returns (path, records), stored.

    Of rows with equal payloads of at least ``min_bytes`` bytes that with the largest id is a response and the
    others are revisits of it; if several rows have this id, all of them are responses. A NULL text is an empty
    payload, a NULL id is smaller than any other. Each task fills packages of about ``package_bytes``, so it holds one
    at a time.
    """
    bounded_batches(pages.sparkSession)
    payload = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    alike = rows.filter(F.octet_length("payload") >= min_bytes).groupBy("sha1").agg(F.count("*").alias("n"), F.max("id").alias("first"))
    repeated = saved(alike.filter("n > 1").select("sha1", "first"), "repeated-payloads")
    joined = rows.join(repeated.withColumn("known", F.lit(True)), "sha1", "left")
    joined = joined.select(
        F.col("id").cast("string").alias("key"),
        "url",
        "payload",
        (F.col("known").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))).alias("again"),
        F.col("first").cast("string").alias("first"),
    )
    folder = fresh_path(pages.sparkSession, "packages")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, inner = fs.FileSystem.from_uri(folder)
        system.create_dir(inner, recursive=True)
        buffer, lines = bytearray(), []

        def close() -> pd.DataFrame:
            name = f"{uuid.uuid4().hex}.wacz"
            with system.open_output_stream(f"{inner}/{name}") as out:
                out.write(package(bytes(buffer), lines))
            done = pd.DataFrame({"path": [f"{folder}/{name}"], "records": [len(lines)]})
            buffer.clear()
            lines.clear()
            return done

        for batch in batches:
            for key, url, payload, again, first in batch.itertuples(index=False, name=None):
                digest = base32_sha1(payload)
                record = gzip.compress(record_bytes(key, url, payload, digest, (first,) if again else None), 6, mtime=0)
                place = {"url": url, "digest": f"sha1:{digest}", "offset": len(buffer), "length": len(record), "filename": "data.warc.gz"}
                lines.append(f"{quote(url or '-', safe=_URI_SAFE)} {NO_DATE} {json.dumps(place)}\n")
                buffer += record
                if len(buffer) >= package_bytes:
                    yield close()
        if lines:
            yield close()

    return saved(joined.mapInPandas(write, "path string, records bigint"), "manifest")


def locate(packages: DataFrame, path_col: str = "path") -> DataFrame:
    """(path, start, length): where each indexed record lies in its package, from directory and index alone."""

    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch[path_col]:
                with file_at(path) as file:
                    members = directory(file, file.size())
                    archives = {}
                    for m in members:
                        if m.name.startswith("archive/"):
                            if m.method != zipfile.ZIP_STORED:
                                raise ValueError(f"{path}: {m.name} is compressed, so its records cannot be read in place")
                            archives[m.name.removeprefix("archive/")] = data_start(file, m)
                    for m in members:
                        if m.name.startswith("indexes/") and m.name.removesuffix(".gz").endswith((".cdx", ".cdxj")):
                            found = [json.loads(line.split(" ", 2)[2]) for line in member_bytes(file, m).decode().split("\n") if line.strip()]
                            yield pd.DataFrame(
                                {
                                    "path": path,
                                    "start": [archives[p["filename"]] + int(p["offset"]) for p in found],
                                    "length": [int(p["length"]) for p in found],
                                }
                            )

    return packages.select(path_col).mapInPandas(places, "path string, start bigint, length bigint")


_RECORD = (
    "path string, start bigint, type string, record_id string, url string, date string, key string,"
    " refers_to_key string, payload_bytes bigint, payload_digest string, payload binary"
)


def read_records(packages: DataFrame, path_col: str = "path", block: int = READ_BLOCK, payloads: bool = True) -> DataFrame:
    """One row per record of the packages. The payload of a response is held against its digest.

    Records are dealt out by package and ``block`` of bytes, so a large package is read by many tasks, each going
    forward through its part. A revisit has no payload; its size is the one its HTTP header states.
    """
    places = locate(packages, path_col).withColumn("_block", F.floor(F.col("start") / block))
    # a fixed number of parts: by the size of these short rows alone Spark would join them into too few tasks
    parts = int(packages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = places.repartition(parts, "path", "_block").sortWithinPartitions("path", "start")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened, file = None, None
        for batch in batches:
            rows, held = [], 0
            for path, start, length in zip(batch["path"], batch["start"], batch["length"], strict=True):
                if path != opened:
                    if file is not None:
                        file.close()
                    opened, file = path, file_at(path)
                head, http, payload = parse_record(gzip.decompress(_read(file, start, length)))
                kind, digest = head["warc-type"], head.get("warc-payload-digest", "").removeprefix("sha1:")
                size = len(payload) if kind == "response" else int(http.get("content-length", 0))
                if kind == "response" and base32_sha1(payload) != digest:
                    raise ValueError(f"{path}, byte {start}: the payload differs from its digest")
                key, refers = head.get("x-record-key"), head.get("x-refers-to-key")
                rows.append((path, start, kind, head.get("warc-record-id"), head.get("warc-target-uri"), head.get("warc-date"), key, refers, size, digest, payload if payloads and kind == "response" else None))
                held += len(payload)
                if held > block:
                    yield pd.DataFrame(rows, columns=names)
                    rows, held = [], 0
            yield pd.DataFrame(rows, columns=names)
        if file is not None:
            file.close()

    names = [part.split()[0] for part in _RECORD.split(",")]
    found = dealt.select("path", "start", "length").mapInPandas(read, _RECORD)
    return found.withColumns({c: F.url_decode(F.replace(F.col(c), F.lit("+"), F.lit("%2B"))) for c in ("key", "refers_to_key")})


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str = "html") -> DataFrame:
    """Write all rows as records, read the packages back, and give one row per record under the rows' ids."""
    kind = pages.schema[id_col].dataType
    records = read_records(write_packages(pages, id_col, url_col, text_col), payloads=False)
    return records.select(
        F.col("key").cast(kind).alias(id_col),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.col("refers_to_key").cast(kind).alias("refers_to"),
    )
