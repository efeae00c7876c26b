"""Token ids as seekable files: independent zstandard frames and a trailing seek table.

File: data frames (little-endian unsigned 32-bit ids, ``FRAME_IDS`` each, every
one a zstandard frame of its own), a skippable frame with the document index,
and the seek table as a skippable frame: per frame its compressed and
decompressed size and the lower 32 bits of the xxh64 of its ids, then the frame
count, a descriptor and the magic number, so that a reader starts at the end of
the file. Any zstandard decoder reads the ids, passing over the two others. A
reader of some documents fetches and decompresses only the frames they lie in,
and checks each against its checksum.

Files are written in ascending doc_id order: range partitions, one file each.
A task writes under a name of its own attempt and reports the file as a row;
the rows are committed by Spark, so files of lost or repeated tasks are never
read. Texts are tokenized in the writing task and never kept.

Defined cases: null or empty text is the end id alone. Null doc_ids come first
and read back as null; repeated doc_ids are documents of their own, ordered by
their text. An empty table has no file with documents. Other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from equilibra.llm._tokens import ID, encoded
from equilibra.llm._work import cells, files_of, partition, run_dir, saved

FRAME_IDS = 1 << 16
#: Fixed values of the seekable format.
SKIPPABLE, SEEK_TABLE, FOOTER, CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
INDEX = np.dtype([("doc_id", "<i8"), ("present", "u1"), ("n_tokens", "<i8")])


class Writer:
    """Writes one file; holds a frame of ids and the index entries since its start."""

    def __init__(self, stream, frame_ids: int = FRAME_IDS, level: int = 1):
        import zstandard

        self.stream, self.size = stream, 4 * frame_ids
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.held, self.frames, self.index, self.tokens = bytearray(), [], [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.index.append((doc_id or 0, doc_id is not None, len(ids) // 4))
        self.tokens += len(ids) // 4
        self.held += ids
        while len(self.held) >= self.size:
            self._frame(bytes(self.held[: self.size]))
            del self.held[: self.size]

    def _frame(self, data: bytes) -> None:
        import xxhash

        packed = self.zstd.compress(data)
        self.stream.write(packed)
        self.frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

    def close(self) -> None:
        if self.held:
            self._frame(bytes(self.held))
        index = self.zstd.compress(np.array(self.index, INDEX).tobytes())
        self.stream.write(struct.pack("<II", SKIPPABLE, len(index)) + index)
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        self.stream.write(struct.pack("<II", SEEK_TABLE, len(table) + 9))
        self.stream.write(table + struct.pack("<IBI", len(self.frames), CHECKSUMS, FOOTER))
        self.stream.close()


class Reader:
    """Reads one file from its end; ``document(k)`` decompresses only what it needs."""

    def __init__(self, file):
        import zstandard

        self.file, self.zstd, self.loaded = file, zstandard.ZstdDecompressor(), (-1, b"")
        size = file.size()
        frames, descriptor, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != FOOTER or descriptor != CHECKSUMS:
            raise ValueError("not a seekable file with checksums")
        at = size - 17 - 12 * frames
        table = np.frombuffer(file.read_at(12 * frames, at + 8), "<u4").reshape(frames, 3).astype(np.int64)
        self.checks = table[:, 2]
        self.ends, self.id_ends = np.cumsum(table[:, 0]), np.cumsum(table[:, 1]) // 4
        start = int(self.ends[-1]) if frames else 0
        self.index = np.frombuffer(self.zstd.decompress(file.read_at(at - start - 8, start + 8)), INDEX)
        self.doc_ends = np.cumsum(self.index["n_tokens"])

    def _frame(self, k: int) -> bytes:
        import xxhash

        if self.loaded[0] != k:
            start = int(self.ends[k - 1]) if k else 0
            data = self.zstd.decompress(self.file.read_at(int(self.ends[k]) - start, start))
            if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.checks[k]:
                raise ValueError(f"frame {k} is damaged")
            self.loaded = k, data
        return self.loaded[1]

    def parts(self, k: int) -> Iterator[bytes]:
        """The ids of the file's k-th document, frame by frame."""
        at, end = int(self.doc_ends[k] - self.index["n_tokens"][k]), int(self.doc_ends[k])
        while at < end:
            f = int(np.searchsorted(self.id_ends, at, "right"))
            first = int(self.id_ends[f - 1]) if f else 0
            stop = min(end, int(self.id_ends[f]))
            yield self._frame(f)[4 * (at - first) : 4 * (stop - first)]
            at = stop

    def document(self, k: int) -> np.ndarray:
        return np.frombuffer(b"".join(self.parts(k)), ID)


def write_tokens(docs: DataFrame, path: str, folder: str) -> DataFrame:
    """Write the files under ``folder``; the manifest: part, file, docs, tokens, start
    (ids in all earlier files). One row per file, in doc_id order by part."""

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa

        writer, name, where = None, "", None
        for doc, ids in encoded(path, True, cells(batches, "doc_id", "text")):
            if writer is None:
                fs, root = files_of(folder)
                fs.create_dir(root, recursive=True)
                name = f"{partition():05d}-{uuid.uuid4().hex}.ids.zst"
                where = fs.open_output_stream(f"{root}/{name}", compression=None)
                writer = Writer(where)
            writer.add(doc, ids)
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pylist([{"part": partition(), "file": name, "docs": len(writer.index), "tokens": writer.tokens}], pa.schema([("part", pa.int32()), ("file", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())]))

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = ordered.repartitionByRange("doc_id", F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text")
    manifest = saved(ordered.mapInArrow(write, "part int, file string, docs long, tokens long"), f"{folder}/manifest")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return saved(manifest.withColumn("start", F.coalesce(F.sum("tokens").over(earlier), F.lit(0).cast("long"))), f"{folder}/index")


def read_tokens(index: DataFrame, folder: str) -> DataFrame:
    """What the files hold, per document: doc_id, start, n_tokens, ids_crc32, file, position."""

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        fs, root = files_of(folder)
        for name, start in cells(batches, "file", "start"):
            with fs.open_input_file(f"{root}/{name}") as file:
                reader = Reader(file)
                sums = np.zeros(len(reader.index), np.int64)
                for k in range(len(sums)):
                    check = 0
                    for part in reader.parts(k):
                        check = zlib.crc32(part, check)
                    sums[k] = check
                n = reader.index["n_tokens"].astype(np.int64)
                ids = pa.array(reader.index["doc_id"].astype(np.int64), mask=reader.index["present"] == 0)
                columns = [ids, pa.array(reader.doc_ends - n + start), pa.array(n), pa.array(sums), pa.array([name] * len(n), pa.string()), pa.array(np.arange(len(n)))]
                for at in range(0, len(n), 10_000):
                    yield pa.RecordBatch.from_arrays([c.slice(at, 10_000) for c in columns], names=["doc_id", "start", "n_tokens", "ids_crc32", "file", "position"])

    files = max(1, index.count())
    return index.select("file", "start").repartition(files).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, file string, position long")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    folder = run_dir(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, path, folder), folder)
