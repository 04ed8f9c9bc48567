"""Token ids in files of independent zstandard frames with a seek table.

A file holds, in doc_id order, one zstandard frame of little-endian ids per
document, then a skippable frame with the documents' ids, then the seek table of
the public zstandard seekable format: per frame its compressed and plain size
and the low 32 bits of the XXH64 of the plain bytes. A reader fetches the tail,
then only the frames of the documents it wants, and checks each one.

Documents are range-partitioned by doc_id, and every task writes the file of its
partition: first under a name of its attempt, then renamed, so that a task that
is run again replaces its file by an equal one.

Defined results: a NULL or empty text is its end id alone; a NULL doc_id comes
first; rows that share a doc_id follow each other in the order of their texts;
an empty table gives no file.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regcurate.llm.shared import by_bytes, in_arrow, scratch_path, staged
from regcurate.llm.tokens import tokenizer

# Fixed values of the public zstandard (seekable) format.
SKIPPABLE, SEEK_TABLE, SEEKABLE_FOOTER = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared folder's URI."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return pafs.FileSystem.from_uri(uri)


class TokenFileWriter:
    """Appends documents' ids to an open binary stream."""

    def __init__(self, out, dtype: str = "<u4", level: int = 1):
        import zstandard

        self._out, self._dtype = out, dtype
        self._zip = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self._frames: list[bytes] = []
        self._doc_ids: list[int | None] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        import xxhash

        if len(ids) and int(ids.max()) > np.iinfo(self._dtype).max:
            raise ValueError(f"id {int(ids.max())} of document {doc_id} does not fit {self._dtype}")
        plain = ids.astype(self._dtype).tobytes()
        frame = self._zip.compress(plain)
        self._out.write(frame)
        self._frames.append(struct.pack("<III", len(frame), len(plain),
                                        xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self._doc_ids.append(doc_id)

    def close(self) -> None:
        n = len(self._doc_ids)
        index = (self._dtype.encode().ljust(4) + struct.pack("<I", n)
                 + np.array([d is not None for d in self._doc_ids], np.uint8).tobytes()
                 + np.array([d or 0 for d in self._doc_ids], "<i8").tobytes())
        head = struct.pack("<II", SKIPPABLE, len(index))
        self._out.write(head + index)
        # the index is a frame without content in the seek table
        entries = self._frames + [struct.pack("<III", len(head) + len(index), 0, 0)]
        table = b"".join(entries) + struct.pack("<IBI", len(entries), CHECKSUMS, SEEKABLE_FOOTER)
        self._out.write(struct.pack("<II", SEEK_TABLE, len(table)) + table)


class CorruptFrame(ValueError):
    """A frame does not have the bytes its seek table promises."""


class TokenFileReader:
    """Random access to one file of :class:`TokenFileWriter`."""

    def __init__(self, source):
        import zstandard

        self._in, self._unzip = source, zstandard.ZstdDecompressor()
        size = source.seek(0, io.SEEK_END)
        source.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE_FOOTER or flags != CHECKSUMS:
            raise CorruptFrame("no seek table")
        source.seek(size - 9 - 12 * n)
        table = np.frombuffer(source.read(12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self._at = np.concatenate([[0], np.cumsum(table[:, 0])])
        self._plain, self._sums = table[:-1, 1], table[:-1, 2]
        source.seek(int(self._at[n - 1]) + 8)
        index = source.read(int(table[-1, 0]) - 8)
        self._dtype = index[:4].decode().strip()
        here = np.frombuffer(index, np.uint8, n - 1, 8).astype(bool)
        ids = np.frombuffer(index, "<i8", n - 1, 8 + n - 1)
        self.doc_ids = [int(d) if h else None for d, h in zip(ids, here)]
        self._next = -1

    def __len__(self) -> int:
        return len(self.doc_ids)

    def read(self, k: int) -> np.ndarray:
        """ids of the k-th document, from its frame alone."""
        import xxhash

        if k != self._next:
            self._in.seek(int(self._at[k]))
        self._next = k + 1
        plain = self._unzip.decompress(self._in.read(int(self._at[k + 1] - self._at[k])))
        if len(plain) != self._plain[k] or \
                xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self._sums[k]:
            raise CorruptFrame(f"frame {k}")
        return np.frombuffer(plain, self._dtype).astype("<u4")


_MANIFEST = pa.schema([("part", pa.int64()), ("file", pa.string()), ("n_docs", pa.int64()),
                       ("n_tokens", pa.int64())])


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int,
                      dtype: str = "<u4") -> DataFrame:
    """Write the files under ``folder`` (a shared URI) and return their staged
    manifest: part, file, n_docs, n_tokens; parts follow doc_id order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, ctx = tokenizer(vocabulary), TaskContext.get()
        fs, base = filesystem(folder)
        name = f"part-{ctx.partitionId():06d}.zst"
        own = f"{base}/.{name}.{ctx.taskAttemptId()}"
        stream = writer = None
        n_docs = n_tokens = 0
        for batch in by_bytes(batches, "text", 4 << 20):
            if writer is None:
                fs.create_dir(base, recursive=True)
                stream = fs.open_output_stream(own)
                writer = TokenFileWriter(stream, dtype)
            ids, off = tok.encode(batch.column("text"))
            for d, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                full = np.append(ids[off[d]:off[d + 1]], end_id)
                writer.add(doc_id, full)
                n_tokens += len(full)
            n_docs += batch.num_rows
        if writer is not None:
            writer.close()
            stream.close()
            fs.move(own, f"{base}/{name}")
            yield pa.RecordBatch.from_pylist([{"part": ctx.partitionId(), "file": name,
                                               "n_docs": n_docs, "n_tokens": n_tokens}], _MANIFEST)

    tie = F.xxhash64(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ordered = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    manifest = in_arrow(ordered, run, "part long, file string, n_docs long, n_tokens long")
    return staged(manifest, "token-manifest", merge=False)


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files, each
    frame checked; ``start`` counts the ids of all documents before it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(f"{base}/{row['file']}") as source:
                    reader = TokenFileReader(source)
                    sizes, sums = [], []
                    for k in range(len(reader)):
                        ids = reader.read(k)
                        sizes.append(len(ids))
                        sums.append(zlib.crc32(ids.tobytes()))
                    starts = row["base"] + np.cumsum(sizes) - sizes
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(reader.doc_ids, pa.int64()), pa.array(starts, pa.int64()),
                         pa.array(sizes, pa.int64()), pa.array(sums, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    # one file per task; a given number of partitions is not merged by AQE
    files = max(1, manifest.count())
    return in_arrow(based.repartitionByRange(files, "part"), run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_and_read(docs: DataFrame, vocabulary: str, end_id: int,
                    dtype: str = "<u4") -> DataFrame:
    """Write all documents and read the files back, under the session's shared
    folder."""
    folder = scratch_path(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, folder, vocabulary, end_id, dtype), folder)
