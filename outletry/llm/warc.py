"""Seekable Zstandard bundles of WARC records (operator 9).

A bundle holds independent frames of whole records, then an index of record ids and
their frame-relative offsets, then a seek table (see :mod:`token_files`), so a record
is read by decompressing one frame. Of records with equal payloads one is stored
in full; the others are revisit records that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_path, small_batches, stage
from .token_files import FRAME_BYTES, FramedReader, FramedWriter

DATE = "2024-01-01T00:00:00Z"  # of every record, so that reruns agree
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the WARC 1.1 format
PAGE = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC 1.1 record. A revisit keeps the HTTP header, so its length stays known."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if kind == "revisit":
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes, at: int = 0) -> tuple[dict[str, str], bytes, bytes, int]:
    """The record at an offset: its header, HTTP header, payload, and the next offset."""
    stop = raw.index(b"\r\n\r\n", at)
    lines = raw[at:stop].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no record at {at}")
    head = dict(x.split(": ", 1) for x in lines[1:])
    begin, n = stop + 4, int(head["Content-Length"])
    http, _, payload = raw[begin : begin + n].partition(b"\r\n\r\n")
    return head, http, payload, begin + n + 4


def _number(urn: str) -> int | None:
    text = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def _row(head: dict[str, str], http: bytes, payload: bytes) -> tuple:
    n = int(dict(x.split(b": ", 1) for x in http.split(b"\r\n")[1:])[b"Content-Length"])
    if head["WARC-Type"] == "response" and (n != len(payload) or digest(payload) != head["WARC-Payload-Digest"].removeprefix("sha1:")):
        raise ValueError(f"{head['WARC-Record-ID']} is damaged")
    return _number(head["WARC-Record-ID"]), n, head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"], _number(head["WARC-Refers-To"]) if "WARC-Refers-To" in head else None


class Bundle:
    """Random access to a bundle's records by their ids."""

    def __init__(self, uri: str):
        self.frames = FramedReader(uri)
        (n,) = struct.unpack_from("<Q", self.frames.index)
        table = np.frombuffer(self.frames.index, "<i8", 3 * n, 8).reshape(-1, 3)
        has = np.frombuffer(self.frames.index, "u1", n, 8 + 24 * n)
        self.places: dict[int | None, list[tuple[int, int]]] = {}
        for (page, frame, offset), ok in zip(table.tolist(), has.tolist(), strict=True):
            self.places.setdefault(page if ok else None, []).append((frame, offset))

    def get(self, page_id: int | None) -> list[tuple[dict[str, str], bytes]]:
        """Header and payload of all records of an id, each by one frame."""
        return [(h, p) for f, o in self.places.get(page_id, []) for h, _, p, _ in [parse(self.frames.frame(f), o)]]


def first_of_equals(pages: DataFrame, min_bytes: int) -> DataFrame:
    """(page_id, sha, refers_to): the rows that repeat the payload of a smaller page_id."""
    p = pages.select("page_id", "sha", "n").where(F.col("page_id").isNotNull() & (F.col("n") >= min_bytes)).drop("n")
    first = p.groupBy("sha").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")).where("refers_to < last").drop("last")
    return p.join(first, "sha").where(F.col("page_id") > F.col("refers_to")).distinct()


def write_bundles(pages: DataFrame, path: str, min_bytes: int = 0) -> DataFrame:
    """Write a record for every page; returns the manifest (part, path, records).

    Null html is empty; equal payloads of min_bytes or more are stored once, with the
    smallest page_id; smaller ones each in full. A null page_id is always stored in
    full, and so is every repeated row of the smallest id. Null url: the record
    names none. No rows give no bundles; extra columns are ignored. Payloads are
    equal if their SHA-256 are.
    """
    small_batches(pages.sparkSession)
    html = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    url = F.col("url").cast("string") if "url" in pages.columns else F.lit(None).cast("string")
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), html.alias("payload"))
    p = p.withColumns({"sha": F.unhex(F.sha2("payload", 256)), "n": F.octet_length("payload")})
    refers = stage(first_of_equals(p, min_bytes), "warc-refers")
    p = p.drop("n").join(refers, ["page_id", "sha"], "left").drop("sha")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        part, out, held, size, places = context.partitionId(), None, [], 0, []
        name = f"{path}/bundle-{part:06d}.warc.zst"
        for batch in batches:
            for row in batch.to_pylist():
                out = out or FramedWriter(name, str(context.taskAttemptId()))
                raw = record("response" if row["refers_to"] is None else "revisit", row["page_id"], row["url"], row["payload"], row["refers_to"])
                places.append((row["page_id"], len(out.entries), size))
                held.append(raw)
                if (size := size + len(raw)) >= FRAME_BYTES:
                    out.frame(b"".join(held))
                    held, size = [], 0
        if out:
            if held:
                out.frame(b"".join(held))
            table = np.array([(i or 0, f, o) for i, f, o in places], "<i8")
            out.close(struct.pack("<Q", len(places)) + table.tobytes() + np.array([i is not None for i, _, _ in places], "u1").tobytes())
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "path": [name], "records": [len(places)]})

    return stage(p.mapInArrow(write, "part int, path string, records long"), "warc-manifest")


def read_bundles(manifest: DataFrame) -> DataFrame:
    """One row a record of the bundles, each payload held against its digest."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch["path"].to_pylist():
                frames = FramedReader(path)
                for k in range(len(frames)):
                    raw, at, rows = frames.frame(k), 0, []
                    while at < len(raw):
                        head, http, payload, at = parse(raw, at)
                        rows.append(_row(head, http, payload))
                    a, b, c, d, e = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_pydict({"page_id": pa.array(a, pa.int64()), "payload_bytes": pa.array(b, pa.int64()), "payload_digest": pa.array(c, pa.string()), "record_type": pa.array(d, pa.string()), "refers_to": pa.array(e, pa.int64())})
                frames.close()

    return manifest.repartition(max(1, manifest.count())).mapInArrow(read, PAGE)


def bundle_pages(pages: DataFrame, path: str | None = None, min_bytes: int = 0) -> DataFrame:
    """Write all pages (to a new shared folder if no path is given) and read them back."""
    return read_bundles(write_bundles(pages, path or fresh_path(pages.sparkSession, "warc"), min_bytes))
