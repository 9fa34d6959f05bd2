import io
import struct
import zipfile

from tuneforge.llm import queries, warc

from ..conftest import SF_SMALL

BIG = "<p>" + "é" * 200 + "</p>"
PAGES = [(5, "http://a/\r\nX: y", BIG), (3, "http://b/ ?q=ü", BIG), (9, None, BIG), (None, "http://n", BIG), (1, "u", None),
         (2, "u", ""), (4, "u", "short"), (6, "u", "short"), (7, "u", "x" * 300_000), (8, "u", "\r\n\r\n" * 40), (3, "http://b/ ?q=ü", BIG)]


def test_round_trip(spark):
    pages = spark.createDataFrame([(*p, "z") for p in PAGES], "page_id long, url string, html string, payload string")
    for n in (3, 10**6):
        records = warc.list_records(warc.write_archives(pages.repartition(2), archive_records=n))
        got = warc.read_records(records).collect()
        assert len(got) == len(PAGES)
        by_id = {r.page_id: r for r in got}
        for i, _, html in PAGES:
            r, data = by_id[i], (html or "").encode()
            revisit = html == BIG and i != 3
            assert r.payload_bytes == len(data) and r.record_type == ("revisit" if revisit else "response")
            assert r.refers_to == (3 if revisit else None)
            assert (r.payload is None) if revisit else bytes(r.payload) == data
    assert warc.read_records(warc.list_records(warc.write_archives(pages.limit(0)))).count() == 0


def test_zip_directories(tmp_path):
    """Comment with a false end record, and a ZIP64 directory as a large archive has it."""
    plain = io.BytesIO()
    with zipfile.ZipFile(plain, "w") as z:
        z.writestr("a.txt", "hello")
        z.writestr("dir/b.txt", b"x" * 1000)
        z.writestr("c.txt", "zzz", zipfile.ZIP_DEFLATED)
        z.comment = b"PK\x05\x06 not the end"
    data = plain.getvalue()
    names = warc.read_directory(io.BytesIO(data), len(data))
    assert set(names) == {"a.txt", "dir/b.txt", "c.txt"}
    at, n = warc.member_range(io.BytesIO(data), names["a.txt"])
    assert data[at:at + n] == b"hello" and names["c.txt"][0] == 8

    body = b"archive bytes"
    local = b"PK\x03\x04" + struct.pack("<HHHHHIIIHH", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 1, 20) + b"m" \
        + struct.pack("<HHQQ", 1, 16, len(body), len(body))
    entry = b"PK\x01\x02" + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 1, 28, 0, 0, 0, 0,
                                       0xFFFFFFFF) + b"m" + struct.pack("<HHQQQ", 1, 24, len(body), len(body), 0)
    start = len(local) + len(body)
    end64 = b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 1, 1, len(entry), start)
    locator = b"PK\x06\x07" + struct.pack("<IQI", 0, start + len(entry), 1)
    end = b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    data = local + body + entry + end64 + locator + end
    names = warc.read_directory(io.BytesIO(data), len(data))
    at, n = warc.member_range(io.BytesIO(data), names["m"])
    assert data[at:at + n] == body


def test_registered(spark):
    assert queries.QUERIES["op1_warc_zip"](spark, SF_SMALL).count() == spark.read.parquet(SF_SMALL + "/pages.parquet").count()
