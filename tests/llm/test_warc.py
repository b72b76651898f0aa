"""WARC records in ZIP packages: exact round trip, foreign and ZIP64 packages, broken files."""

import base64
import hashlib
import io
import struct
import zipfile

import pyarrow as pa
import pytest

from tillcast.llm import warc_zip as wz

OUT = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def brute(rows, least=0):
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        largest = max(same, default=None)
        refers = largest if len(data) >= least and largest != page_id and same else None
        out.append((page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def round_trip(spark, rows, spec=wz.WarcSpec()):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, refers_to int, same string")
    packages = wz.write_packages(df, spec)
    found = wz.read_packages(packages, spec, payloads=True).collect()
    payloads = sorted((r.page_id, bytes(r.payload).decode()) for r in found if r.payload is not None and r.page_id is not None)
    held = brute(rows, spec.least_bytes)
    assert sorted((tuple(r[c] for c in OUT) for r in found), key=str) == held
    responses = {r[0] for r in held if r[3] == "response"}
    assert payloads == sorted((p, h or "") for p, _, h in rows if p is not None and p in responses)
    return packages


def test_whole_table_and_copies(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", "url", "html").collect()]
    copies = [(p + 10_000, u, h) for p, u, h in rows[::3]] + [(p + 20_000, u, h) for p, u, h in rows[::7]]
    round_trip(spark, rows + copies)


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "ü\r\nX: y", "a"), (4, "u", "\r\n\r\n"), (5, "u", "WARC/1.1\r\n"), (6, "u", "é" * 400_000), (7, "u", "é" * 400_000), (None, "u", "only the null"), (None, "u", "a"), (-8, "u", "neg"), (-9, "u", "neg")]
    round_trip(spark, rows)
    round_trip(spark, rows, wz.WarcSpec(least_bytes=4))
    assert wz.read_packages(wz.write_packages(spark.createDataFrame([], "page_id long, url string, html string"))).count() == 0


def test_several_packages_and_ranges(spark):
    rows = [(i, "u", f"page {i} " + "x" * (i % 50)) for i in range(300)]
    packages = round_trip(spark, rows, wz.WarcSpec(package_bytes=2000, range_bytes=700)).collect()
    assert len(packages) > 10 and sum(p.records for p in packages) == 300
    with zipfile.ZipFile(packages[0].path.removeprefix("file:")) as held:
        assert held.testzip() is None and set(held.namelist()) == {wz.DATA, wz.INDEX}


def members(raw):
    return wz.members(pa.BufferReader(raw)), pa.BufferReader(raw)


@pytest.mark.parametrize("note", [b"", b"a note with PK\x05\x06 in it"])
def test_packages_of_another_writer(note):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as made:
        made.comment = note
        made.writestr("a/plain.txt", b"hello there")
        made.writestr("packed.txt", b"x" * 100, zipfile.ZIP_DEFLATED)
        with made.open("wide.txt", "w", force_zip64=True) as wide:
            wide.write(b"wide member")
    named, file = members(out.getvalue())
    for name, data in (("a/plain.txt", b"hello there"), ("wide.txt", b"wide member")):
        assert wz._read_at(file, wz.data_offset(file, named[name]), named[name].size) == data
    with pytest.raises(ValueError, match="compressed"):
        wz.data_offset(file, named["packed.txt"])


def test_more_members_than_plain_zip_counts():
    out = io.BytesIO()
    package = wz.StoredZip(out)
    for i in range(66_000):
        package.begin(f"m{i}")
        package.write(b"%d" % i)
        package.end()
    package.close()
    named, file = members(out.getvalue())
    assert len(named) == 66_000
    assert wz._read_at(file, wz.data_offset(file, named["m65999"]), named["m65999"].size) == b"65999"
    assert len(zipfile.ZipFile(io.BytesIO(out.getvalue())).namelist()) == 66_000


def test_broken_packages():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as made:
        made.writestr("a", b"data")
    raw = out.getvalue()
    for broken in (b"", raw[:-5], raw[:40], b"PK" + b"x" * 100):
        with pytest.raises(ValueError):
            members(broken)
    at = raw.rfind(struct.pack("<I", wz._CENTRAL))
    with pytest.raises(ValueError, match="central"):
        members(raw[:at] + b"XXXX" + raw[at + 4 :])


def test_damaged_payload_is_found():
    packed = wz.record(1, "u", b"payload", None, wz.WarcSpec())
    assert wz.parse_record(packed)["payload"] == b"payload"
    import zlib

    raw = zlib.decompress(packed, 31).replace(b"payload", b"PAYLOAD")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    with pytest.raises(ValueError, match="digest"):
        wz.parse_record(packer.compress(raw) + packer.flush())
