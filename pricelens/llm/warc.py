"""WARC archives whose records are compressed one by one with a shared dictionary.

A Zstandard dictionary is built from a bounded sample of the records, written
into every file as a leading skippable frame, and each record becomes one
Zstandard frame that needs only that dictionary, so a record can be read at its
offset. Of equal payloads one record is the response; the others are revisits
that refer to it.

Every attempt of a task writes files with names of its own; only files named in
the manifest, which Spark commits, are read.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import filesystem, settle

#: Magic number of the skippable frame that holds a dictionary.
DICTIONARY_FRAME = 0x184D2A5D
#: The dictionary's size, and the sample it is built from: so many records, cut
#: to so many bytes each (16 MB at most reach the driver).
DICTIONARY_BYTES, SAMPLE_RECORDS, SAMPLE_BYTES = 64 << 10, 1000, 16 << 10
FILE_BYTES = 128 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def dictionary(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from records sampled by the hashes of their ids and payloads;
    the sample's bytes themselves where it is too small to train on."""
    import zstandard

    share = min(1.0, SAMPLE_RECORDS / max(1, pages.count()))
    chosen = F.pmod(F.xxhash64(id_col, html_col), F.lit(1 << 30)) < int(share * (1 << 30))
    rows = (pages.where(chosen & (F.length(html_col) > 0)).select(F.encode(F.substring(html_col, 1, SAMPLE_BYTES), "UTF-8").alias("b"))
            .limit(SAMPLE_RECORDS).collect())
    samples = [bytes(r[0])[:SAMPLE_BYTES] for r in rows]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if samples else b""
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def _coder(kind: str, data: bytes):
    import zstandard

    d = zstandard.ZstdCompressionDict(data) if data else None
    return zstandard.ZstdCompressor(level=3, dict_data=d) if kind == "write" else zstandard.ZstdDecompressor(dict_data=d)


def plan_records(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """(_ll_key, _ll_grouped, _ll_first): for each distinct page id and payload
    (by their hash) that has an equal payload elsewhere, the smallest id with it.

    Payloads of fewer than ``min_bytes`` bytes are left out. Only ids and
    digests move; a payload that a third of the pages share is grouped with
    partial aggregates.
    """
    body = F.coalesce(F.col(html_col), F.lit(""))
    slim = settle(pages.select(_key(id_col, html_col).alias("_ll_key"), F.col(id_col).alias("_ll_id"), F.sha2(body, 256).alias("_ll_sum"), F.octet_length(body).alias("_ll_bytes")), "payload-sums")
    firsts = (slim.where(F.col("_ll_bytes") >= min_bytes).groupBy("_ll_sum")
              .agg(F.min("_ll_id").alias("_ll_first"), F.count(F.lit(1)).alias("_ll_n")).where("_ll_n > 1").drop("_ll_n"))
    return slim.join(firsts, "_ll_sum").select("_ll_key", "_ll_first").distinct().withColumn("_ll_grouped", F.lit(True))


def _key(id_col: str, html_col: str):
    """Identity of a record: null payloads are empty ones."""
    return F.sha2(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.coalesce(F.col(html_col), F.lit(""))), 256)


def _record(kind: str, page_id: str, number: int, url: str | None, body: bytes, digest: str, first: str | None, date: str) -> bytes:
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{quote(page_id)}:{number}>", f"WARC-Date: {date}", f"X-Page-Id: {quote(page_id)}",
            f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{quote(first)}:1>", f"X-Refers-To-Page-Id: {quote(first)}"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    block = http + (body if kind == "response" else b"")
    return ("WARC/1.1\r\n" + "\r\n".join([*head, f"Content-Length: {len(block)}"]) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


#: What stands for a null page id in a record's fields (no id is empty).
NO_ID = ""


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0,
          file_bytes: int = FILE_BYTES, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write a record for every row; returns the manifest (path, n_records).

    A null payload is empty. Of repeated rows with one id and payload one is the
    response, the others revisit it. A null id is written as an empty field, is
    never chosen as the response while another id has the payload, and its
    equals refer to an empty id if it is alone. An empty table writes no file.
    Other columns are not archived.
    """
    words = dictionary(pages, id_col, html_col)
    plan = plan_records(pages, id_col, html_col, min_bytes)
    rows = pages.select(_key(id_col, html_col).alias("_ll_key"), F.col(id_col).alias("_ll_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    planned = rows.join(plan, "_ll_key", "left")  # payloads are moved once, by the key of join and window
    again = Window.partitionBy("_ll_key").orderBy("url")
    text_id, text_first = F.coalesce(F.col("_ll_id").cast("string"), F.lit(NO_ID)), F.coalesce(F.col("_ll_first").cast("string"), F.lit(NO_ID))
    is_first = F.col("_ll_grouped").isNull() | (F.col("_ll_id").eqNullSafe(F.col("_ll_first")) & (F.col("_ll_k") == 1))
    planned = planned.withColumn("_ll_k", F.row_number().over(again)).select(
        text_id.alias("page"), F.col("_ll_k").alias("k"), "url", "html", F.when(is_first, F.lit(None).cast("string")).otherwise(text_first).alias("refers"))

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, attempt = _coder("write", words), TaskContext.get().partitionId(), uuid.uuid4().hex[:12]
        paths, counts, sink, size = [], [], None, 0
        try:
            for b in batches:
                for page, k, url, html, refers in zip(*(c.to_pylist() for c in b.columns)):
                    if sink is None or size >= file_bytes:
                        if sink is not None:
                            sink.close()
                        paths.append(f"{folder}/pages-{part:06d}-{len(paths):04d}-{attempt}.warc.zst"), counts.append(0)
                        fs, local = filesystem(paths[-1])
                        fs.create_dir(local.rsplit("/", 1)[0], recursive=True)
                        sink = fs.open_output_stream(local, compression=None, buffer_size=1 << 20)
                        info = b"software: pricelens\r\nformat: WARC File Format 1.1\r\n"
                        sink.write(struct.pack("<II", DICTIONARY_FRAME, len(words)) + words)
                        sink.write(coder.compress((f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {date}\r\n"
                                                   f"Content-Type: application/warc-fields\r\nContent-Length: {len(info)}\r\n\r\n").encode() + info + b"\r\n\r\n"))
                        size = len(words)
                    body = (html or "").encode()
                    digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
                    frame = coder.compress(_record("response" if refers is None else "revisit", page, k, url, body, digest, refers, date))
                    sink.write(frame)
                    size, counts[-1] = size + len(frame), counts[-1] + 1
        finally:
            if sink is not None:
                sink.close()
        if paths:
            yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(counts, pa.int64())], names=["path", "n_records"])

    return settle(planned.mapInArrow(archive, "path string, n_records bigint"), "warc-files")


def _headers(stream) -> dict[str, str]:
    out = {}
    while line := stream.readline().rstrip(b"\r\n"):
        name, _, value = line.decode().partition(": ")
        out[name.lower()] = value
    return out


def records(stream) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """(WARC fields, HTTP fields, payload) of each record of an open archive; the
    dictionary is taken from the file's first frame."""
    magic, n = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("the archive does not start with a dictionary frame")
    plain = io.BufferedReader(_coder("read", stream.read(n)).stream_reader(stream, read_across_frames=True), 1 << 16)
    while plain.readline():  # the version line
        fields = _headers(plain)
        block = io.BytesIO(plain.read(int(fields["content-length"])))
        plain.read(4)
        http = {}
        if fields["content-type"].startswith("application/http"):
            block.readline()
            http = _headers(block)
        yield fields, http, block.read()


def read(manifest: DataFrame, id_type: str = "bigint", payloads: bool = True) -> DataFrame:
    """One row per page record of the archives: page_id, payload_bytes and
    payload_digest (of the full payload), record_type, refers_to, url and
    payload (null for revisits, or where ``payloads`` is false). A response whose payload does not have its
    digest is an error."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.binary()]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for b in batches:
            for path in b.column(0).to_pylist():
                fs, local = filesystem(path)
                with fs.open_input_stream(local, compression=None) as f:
                    rows, size = [], 0
                    for fields, http, body in records(f):
                        if fields["warc-type"] == "warcinfo":
                            continue
                        digest, response = fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-type"] == "response"
                        if response and base64.b32encode(hashlib.sha1(body).digest()).decode() != digest:
                            raise ValueError(f"{path}: a payload does not have its digest {digest}")
                        rows.append((_unquoted(fields["x-page-id"]), int(http["content-length"]), digest, fields["warc-type"],
                                     None if response else _unquoted(fields["x-refers-to-page-id"]), fields.get("warc-target-uri"), body if response and payloads else None))
                        size += len(body)
                        if size > 8 << 20 or len(rows) >= 4096:
                            yield batch(rows)
                            rows, size = [], 0
                    if rows:
                        yield batch(rows)

    paths = manifest.select("path")
    paths = paths.repartition(max(1, paths.count()), "path")  # a task for each file; paths alone would be coalesced
    found = paths.mapInArrow(
        scan, "page_id string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, url string, payload binary")
    back = lambda c: F.when(F.col(c) != NO_ID, F.col(c).cast(id_type)).alias(c)
    return found.select(back("page_id"), "payload_bytes", "payload_digest", "record_type", back("refers_to"), "url", "payload")


def _unquoted(value: str) -> str:
    from urllib.parse import unquote

    return unquote(value)
