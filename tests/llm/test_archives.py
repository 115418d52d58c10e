import base64
import hashlib
import io
import struct
import zipfile

import pytest

from natalis.llm import archives


class Far(io.BytesIO):
    """A file that counts the bytes read from it."""

    taken = 0

    def read(self, n=-1):
        data = super().read(n)
        self.taken += len(data)
        return data


@pytest.mark.parametrize("comment", [b"", b"PK\x05\x06 not the end", b"x" * 65535])
@pytest.mark.parametrize("wide", [False, True])
def test_directory(comment, wide):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.comment = comment
        for i in range(30):
            with z.open(zipfile.ZipInfo(f"archive/é{i}.bin"), "w", force_zip64=wide) as member:
                member.write(bytes([i]) * 5000 * i)
        z.writestr("indexes/a.cdx", b"lines\n" * 100, zipfile.ZIP_DEFLATED)
    data = out.getvalue()
    file = Far(data)
    members = archives.directory(file, len(data))
    assert file.taken < 65535 + 22 + 20 + 5000
    assert [m.name for m in members] == [*(f"archive/é{i}.bin" for i in range(30)), "indexes/a.cdx"]
    assert archives.member_bytes(file, members[7]) == bytes([7]) * 35000
    assert archives.member_bytes(file, members[-1]) == b"lines\n" * 100


def test_zip64_directory():
    """A hand-made package with all 32-bit fields full."""
    body, name = b"hello records", b"archive/data.warc.gz"
    full = 0xFFFFFFFF
    extra = struct.pack("<HHQQQ", 1, 24, len(body), len(body), 0)
    local = struct.pack("<4s5H3I2H", b"PK\x03\x04", 45, 0, 0, 0, 0, 0, full, full, len(name), 20) + name + struct.pack("<HHQQ", 1, 16, len(body), len(body))
    central = struct.pack("<4s6H3I5H2I", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, 0, full, full, len(name), len(extra), 0, 0, 0, 0, full) + name + extra
    at = len(local) + len(body)
    end64 = struct.pack("<4sQ2H2I4Q", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(central), at)
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, at + len(central), 1)
    end = struct.pack("<4s4H2IH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, full, full, 0)
    data = local + body + central + end64 + locator + end
    (member,) = archives.directory(io.BytesIO(data), len(data))
    assert archives.member_bytes(io.BytesIO(data), archives.Member(member.name[:-3], *list(vars(member).values())[1:])) == body
    for broken in (b"", data[:-30], b"no zip" * 50):
        with pytest.raises(ValueError):
            archives.directory(io.BytesIO(broken), len(broken))


ROWS = (
    [(i, f"http://x.org/{i}?q=é\r\nX: y", "same ä" if i % 3 else f"own {i}", "z") for i in range(60)]
    + [(100, None, None, ""), (101, "u", "", ""), (102, "u", "\r\n\r\n<p>", ""), (None, "u", "same ä", ""), (None, "v", "lonely", "")]
    + [(7, "twice", "seven", ""), (7, "twice", "seven", ""), (200, "long", "word " * 60_000, "")]
)


@pytest.mark.parametrize("size", [1, 2000, archives.PACKAGE_BYTES])
def test_round_trip(spark, size):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string, payload string").repartition(3)
    packages = archives.write_packages(pages, package_bytes=size)
    records = archives.read_records(packages, block=4000).collect()
    assert len(records) == len(ROWS)
    largest = {}
    for key, _, html, _ in ROWS:
        html = html or ""
        largest[html] = max(largest.get(html, -1), -1 if key is None else key)
    got = {}
    for r in records:
        got.setdefault(r.key, []).append(r)
    for key, _, html, _ in ROWS:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        first = largest[html or ""] in (key, -1)
        assert any(
            (r.payload_bytes, r.payload_digest, r.type) == (len(data), digest, "response" if first else "revisit")
            and r.refers_to_key == (None if first else str(largest[html or ""]))
            and (r.payload == data if first else r.payload is None)
            for r in got[None if key is None else str(key)]
        )
    done = archives.round_trip(pages)
    assert done.count() == len(ROWS) and dict(done.dtypes)["refers_to"] == "bigint"
    assert archives.round_trip(pages.limit(0)).count() == 0
