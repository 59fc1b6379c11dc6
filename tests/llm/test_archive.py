"""ZIP packages: the directory parser against the standard library, and the round trip."""

import hashlib
import io
import struct
import zipfile

import pytest

from dockcast.llm import archive

PAGES = "page_id long, url string, html string, payload string, digest string"


def test_directory_of_plain_and_wide_packages():
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_STORED) as z:
        z.comment = b"a comment with PK\5\6 inside"
        z.writestr("one", b"abc" * 10)
        with z.open(zipfile.ZipInfo("two"), "w", force_zip64=True) as m:
            m.write(b"xyz")
    found = {m.name: m for m in archive.directory(data, len(data.getvalue()))}
    assert {n: archive._at(data, archive.data_start(data, m), m.size) for n, m in found.items()} == {"one": b"abc" * 10, "two": b"xyz"}


def test_directory_with_zip64_end():
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("one", b"hello")
    raw = data.getvalue()
    end = raw.rfind(b"PK\5\6")
    length, start = struct.unpack_from("<II", raw, end + 12)
    entry = bytearray(raw[start : start + length])
    struct.pack_into("<II", entry, 20, 0xFFFFFFFF, 0xFFFFFFFF)
    struct.pack_into("<H", entry, 30, 28)
    struct.pack_into("<I", entry, 42, 0xFFFFFFFF)
    entry += struct.pack("<HHQQQ", 1, 24, 5, 5, 0)
    record = b"PK\6\6" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 1, 1, len(entry), start)
    locator = b"PK\6\7" + struct.pack("<IQI", 0, start + len(entry), 1)
    last = b"PK\5\6" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    wide = io.BytesIO(raw[:start] + bytes(entry) + record + locator + last)
    (member,) = archive.directory(wide, len(wide.getvalue()))
    assert (member.size, archive._at(wide, archive.data_start(wide, member), 5)) == (5, b"hello")


def test_broken_packages_are_refused():
    with pytest.raises(ValueError, match="end of central directory"):
        archive.directory(io.BytesIO(b"no zip"), 6)
    good = archive.record(1, "http://x", b"p", hashlib.sha256(b"p").hexdigest(), None, 1)
    assert archive.parse(good)["payload"] == b"p"
    with pytest.raises(ValueError, match="isn't what"):
        archive.parse(good.replace(b"\r\n\r\np\r\n", b"\r\n\r\nq\r\n"))


@pytest.mark.parametrize("run_bytes", [1, archive.RUN_BYTES])
def test_round_trip(spark, run_bytes):
    long = "ü" * 120
    rows = [(1, "u", "short"), (2, None, "short"), (9, "a\r\nb", long), (4, "u", long), (4, "u", long), (None, "u", long),
            (7, "u", None), (8, "u", ""), (None, "u", "z" * 200), (10, "u", "x\r\n\r\ny" * 60_000)]
    pages = spark.createDataFrame([(*r, "p", "d") for r in rows], PAGES)
    packages = archive.write(pages)
    got = archive.read(packages, run_bytes=run_bytes).collect()
    assert len(got) == len(rows) and sum(r.records for r in packages.collect()) == len(rows)
    want = []
    for i, _, html in rows:
        body = (html or "").encode()
        refers = 4 if html == long and i != 4 else None
        want.append((i, len(body), hashlib.sha256(body).hexdigest(), "response" if refers is None else "revisit", refers))
        assert any(r.payload == (body if refers is None else None) and r.page_id == i for r in got)
    key = lambda x: sorted(x, key=repr)
    assert key([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]) == key(want)
    assert next(r.url for r in got if r.page_id == 9) == "a%0D%0Ab"
    assert archive.read(archive.write(pages.limit(0))).count() == 0
