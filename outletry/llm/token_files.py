"""Binary token files (operator 3): independent Zstandard frames behind a seek table.

A file is, one after another:

* data frames: each a complete Zstandard frame of some whole documents' ids, as
  little-endian unsigned 32-bit integers, ending each document with the end id;
* a skippable frame (magic 0x184D2A50) with the documents' ids and lengths;
* the seek table of the public seekable format: a skippable frame (0x184D2A5E) with
  compressed size, plain size and XXH64 checksum (its low 32 bits) of every frame
  before it, the number of frames, a descriptor, and the magic 0x8F92EAB1.

So any Zstandard program can read a whole file, and :class:`TokenFile` decompresses
only the frames that hold the documents it is asked for.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh_path, id_and_text, small_batches, stage
from .tokens import encoder

# Fixed values of the seekable format.
SKIPPABLE, SEEK_SKIPPABLE, SEEK_MAGIC, WITH_CHECKSUM = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
_ENTRY, _FOOTER = struct.Struct("<III"), struct.Struct("<IBI")
FRAME_BYTES = 1 << 18
MANIFEST = "part int, path string, n_docs long, n_tokens long"


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI (file, hdfs, s3, gs) and the path in it."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


class FramedWriter:
    """Writes frames, then an index frame and the seek table; appears under its name when complete."""

    def __init__(self, uri: str, attempt: str, level: int = 3):
        self.fs, self.path = open_store(uri)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.temporary = f"{self.path}.{attempt}.tmp"
        self.out, self.compress = self.fs.open_output_stream(self.temporary), zstandard.ZstdCompressor(level=level, write_checksum=True).compress
        self.entries: list[tuple[int, int, int]] = []

    def frame(self, plain: bytes) -> int:
        """Writes a frame; returns its number."""
        packed = self.compress(plain)
        self.out.write(packed)
        self.entries.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        return len(self.entries) - 1

    def close(self, index: bytes) -> None:
        self.out.write(struct.pack("<II", SKIPPABLE, len(index)) + index)
        self.entries.append((len(index) + 8, 0, 0))
        table = b"".join(_ENTRY.pack(*e) for e in self.entries) + _FOOTER.pack(len(self.entries), WITH_CHECKSUM, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SEEK_SKIPPABLE, len(table)) + table)
        self.out.close()
        if self.fs.get_file_info(self.path).type != pafs.FileType.NotFound:
            self.fs.delete_file(self.path)  # by an attempt before, whose executor was lost; not all stores rename onto a file
        self.fs.move(self.temporary, self.path)


class FramedReader:
    """Reads the seek table and the index, and then single frames."""

    def __init__(self, uri: str):
        fs, path = open_store(uri)
        self.file = fs.open_input_file(path)
        end = self.file.size()
        n, flags, magic = _FOOTER.unpack(self._at(end - _FOOTER.size, _FOOTER.size))
        if magic != SEEK_MAGIC or flags != WITH_CHECKSUM:
            raise ValueError(f"{uri} has no seek table")
        table = np.frombuffer(self._at(end - _FOOTER.size - 12 * n, 12 * n), "<u4").reshape(-1, 3)
        self.checksums, self.plain = table[:-1, 2], table[:-1, 1].astype(np.int64)
        ends = table[:, 0].astype(np.int64).cumsum()
        self.begins, self.sizes = ends - table[:, 0], table[:, 0].astype(np.int64)
        self.index = self._at(int(self.begins[-1]) + 8, int(self.sizes[-1]) - 8)

    def _at(self, at: int, n: int) -> bytes:
        return self.file.read_at(n, at)

    def __len__(self) -> int:
        return len(self.plain)

    def frame(self, k: int) -> bytes:
        plain = zstandard.ZstdDecompressor().decompress(self._at(int(self.begins[k]), int(self.sizes[k])), max_output_size=int(self.plain[k]))
        if xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.checksums[k]:
            raise ValueError(f"frame {k} is damaged")
        return plain

    def close(self) -> None:
        self.file.close()


def pack_index(ids: list[int | None], tokens: list[int]) -> bytes:
    """The documents of a file: their number, ids, whether they have one, and lengths in ids."""
    return struct.pack("<Q", len(ids)) + np.array([x or 0 for x in ids], "<i8").tobytes() + np.array(tokens, "<i8").tobytes() + np.array([x is not None for x in ids], "u1").tobytes()


class TokenFile:
    """Random access to the documents of a file."""

    def __init__(self, uri: str):
        self.frames = FramedReader(uri)
        raw = self.frames.index
        (n,) = struct.unpack_from("<Q", raw)
        ids, self.tokens, has = np.frombuffer(raw, "<i8", n, 8), np.frombuffer(raw, "<i8", n, 8 + 8 * n), np.frombuffer(raw, "u1", n, 8 + 16 * n)
        self.doc_ids = [int(i) if h else None for i, h in zip(ids, has, strict=True)]
        self.starts = self.tokens.cumsum() - self.tokens
        self.frame_starts = self.frames.plain.cumsum() - self.frames.plain

    def documents(self, wanted: list[int]) -> Iterator[tuple[int, bytes]]:
        """(place in the file, ids) of the documents at the ascending places `wanted`."""
        last, plain = -1, b""
        for k in wanted:
            at = int(self.starts[k]) * 4
            f = int(np.searchsorted(self.frame_starts, at, "right")) - 1
            if f != last:
                last, plain = f, self.frames.frame(f)
            at -= int(self.frame_starts[f])
            yield k, plain[at : at + int(self.tokens[k]) * 4]


def write_tokens(docs: DataFrame, path: str, tokenizer: str = "byte_bpe_50k.json", end_id: int = 2) -> DataFrame:
    """Encode whole texts and write them in ascending order of doc_id; returns the manifest.

    One file for each range of ids. Null text is empty, so it holds the end id alone; a
    null doc_id comes first; repeated ids are documents of their own, ordered by the
    hash of their text, so that one id's many rows still spread over ranges. No rows
    give no files. Extra columns are ignored. Each file is written under another name
    and then renamed, so lost or repeated tasks leave no half files.
    """
    small_batches(docs.sparkSession)
    d = id_and_text(docs).withColumn("h", F.xxhash64("text"))
    d = d.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").drop("h")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context, encode, end = TaskContext.get(), encoder(tokenizer), struct.pack("<I", end_id)
        part, out, ids, counts, held, size = context.partitionId(), None, [], [], [], 0
        name = f"{path}/part-{part:06d}.tok.zst"
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                out = out or FramedWriter(name, str(context.taskAttemptId()))
                raw = encode(text) + end
                ids.append(doc_id)
                counts.append(len(raw) // 4)
                held.append(raw)
                if (size := size + len(raw)) >= FRAME_BYTES:
                    out.frame(b"".join(held))
                    held, size = [], 0
        if out:
            if held:
                out.frame(b"".join(held))
            out.close(pack_index(ids, counts))
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "path": [name], "n_docs": [len(ids)], "n_tokens": [sum(counts)]})

    return stage(d.mapInArrow(write, MANIFEST), "token-manifest")


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with the number of ids in all files before; it has a row for a file."""
    by = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("file_start", F.coalesce(F.sum("n_tokens").over(by), F.lit(0)))


def read_tokens(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """Documents of the files: doc_id, start, n_tokens, ids_crc32, and the ids (array) if asked."""
    n = max(1, manifest.count())
    files = with_starts(manifest).repartition(n)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file = TokenFile(row["path"])
                rows: list[tuple] = []
                size = 0
                for k, raw in file.documents(list(range(len(file.doc_ids)))):
                    rows.append((file.doc_ids[k], row["file_start"] + int(file.starts[k]), len(raw) // 4, zlib.crc32(raw), raw if with_ids else b""))
                    size += len(rows[-1][4]) + 32
                    if size > 8 << 20:
                        yield out(rows)
                        rows, size = [], 0
                if rows:
                    yield out(rows)
                file.frames.close()

    def out(rows: list[tuple]) -> pa.RecordBatch:
        a, b, c, d, e = zip(*rows, strict=True)
        cols = {"doc_id": pa.array(a, pa.int64()), "start": pa.array(b, pa.int64()), "n_tokens": pa.array(c, pa.int64()), "ids_crc32": pa.array(d, pa.int64())}
        if with_ids:
            cols["ids"] = pa.array([np.frombuffer(x, "<u4").astype(np.int64) for x in e], pa.list_(pa.int64()))
        return pa.RecordBatch.from_pydict(cols)

    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)


def encode_to_files(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write all documents (to a new shared folder if no path is given) and read them back.

    One row a document: doc_id, start, n_tokens, ids_crc32. Null and empty texts are the
    end id alone; null ids come first; repeated ids and rows are documents of their own,
    in the order of their texts' hashes (equal ones in any); no rows give none; extra
    columns are ignored.
    """
    return read_tokens(write_tokens(docs, path or fresh_path(docs.sparkSession, "tokens"), **options))
