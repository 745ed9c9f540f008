import base64
import hashlib

import pytest

from pricelens.llm import warc
from pricelens.llm._shared import scratch

SCHEMA = "page_id bigint, url string, html string, payload string, record_type string"


def pages():
    body = "<html><body>%s</body></html>"
    rows = [(i, f"http://e.com/{i}?q=é a\r\nX: y", body % ("word é " * (i % 7 + 1))) for i in range(60)]
    rows += [(100 + i, None, body % "hot") for i in range(40)]
    rows += [(200, "u", None), (201, "u", ""), (202, None, "x"), (203, "u", "long " * 60_000), (204, "u", "WARC/1.1\r\n\r\n"), (None, "u", "nobody"), (None, None, "hot alone")]
    return [(*r, "clash", "clash") for r in rows + rows[5:7] + rows[5:6]]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("min_bytes", [0, 40])
def test_round_trip(spark, min_bytes):
    rows = pages()
    files = warc.write(spark.createDataFrame(rows, SCHEMA).repartition(6), scratch(spark, "test-warc"), min_bytes=min_bytes, file_bytes=70_000)
    got = warc.read(files).collect()
    assert len(got) == len(rows) == sum(r["n_records"] for r in files.collect())
    groups = {}
    for p, _, html, *_ in rows:
        groups.setdefault(html or "", []).append(p)
    for html, ids in groups.items():
        mine = sorted((r for r in got if r["payload_digest"] == digest(html)), key=lambda r: (r["record_type"], str(r["page_id"])))
        assert all(r["payload_bytes"] == len(html.encode()) for r in mine) and len(mine) == len(ids)
        real = [r for r in mine if r["record_type"] == "response"]
        assert all(bytes(r["payload"]).decode() == html and r["refers_to"] is None for r in real)
        if len(html.encode()) < min_bytes:
            assert len(real) == len(ids)
        else:
            first = min((p for p in ids if p is not None), default=None)
            assert [r["page_id"] for r in real] == [first]
            assert all(r["refers_to"] == first and r["payload"] is None for r in mine if r["record_type"] == "revisit")


def test_one_record_can_be_read_alone(spark):
    import zstandard

    files = warc.write(spark.createDataFrame(pages(), SCHEMA).coalesce(1), scratch(spark, "test-warc"))
    path = files.first()["path"].removeprefix("file://")
    raw = open(path, "rb").read()
    n = int.from_bytes(raw[4:8], "little")
    assert int.from_bytes(raw[:4], "little") == warc.DICTIONARY_FRAME and n > 0
    coder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw[8:8 + n]))
    frame = raw[8 + n:]
    seen = 0
    while frame:
        one = coder.decompressobj()
        assert one.decompress(frame).startswith(b"WARC/1.1\r\n")
        frame, seen = one.unused_data, seen + 1
    assert seen == files.first()["n_records"] + 1


def test_empty_table(spark):
    files = warc.write(spark.createDataFrame([], SCHEMA), scratch(spark, "test-warc"))
    assert files.count() == 0 and warc.read(files).count() == 0
