"""Token-id files: independent zstandard frames, a trailing seek table, a checksum for each frame."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.common import cut, id_and_text, shared_folder, text_slices
from reviewloom.llm.tokens import PieceEncoder, default_path

#: Uncompressed bytes at which a frame is closed; a longer document has a frame of its own.
FRAME_BYTES = 256 << 10
END_ID = 1
# The numbers of the zstandard seekable format, and a skippable frame for the directory.
SEEK_MAGIC, SEEK_FRAME, DIRECTORY_FRAME = 0x8F92EAB1, 0x184D2A5E, 0x184D2A5D
CHECKSUMS = 0x80
NO_ID = -(1 << 63)


def opened(path: str):
    """File system and path of a URI or local path."""
    path = re.sub("^file:/+", "file:///", path)
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path else (pyarrow.fs.LocalFileSystem(), path)


class FrameWriter:
    """Writes documents to one file; frame payload: number of documents, ids, lengths, token ids."""

    def __init__(self, stream, narrow: bool):
        self.stream, self.kind = stream, "<u2" if narrow else "<u4"
        self.packer = zstandard.ZstdCompressor(level=3, write_content_size=True)
        self.entries, self.heads, self.waiting, self.size = [], [], [], 0
        self.documents = self.tokens = 0

    def add(self, doc_id: int, ids: np.ndarray) -> None:
        self.waiting.append((doc_id, ids))
        self.size += ids.nbytes
        self.documents, self.tokens = self.documents + 1, self.tokens + len(ids)
        if self.size >= FRAME_BYTES:
            self.flush()

    def flush(self) -> None:
        if not self.waiting:
            return
        doc_ids = np.array([d for d, _ in self.waiting], "<i8")
        sizes = np.array([len(x) for _, x in self.waiting], "<u4")
        ids = np.concatenate([x for _, x in self.waiting]).astype(self.kind)
        payload = struct.pack("<II", len(doc_ids), ids.itemsize) + doc_ids.tobytes() + sizes.tobytes() + ids.tobytes()
        frame = self.packer.compress(payload)
        self.stream.write(frame)
        self.entries.append((len(frame), len(payload), xxhash.xxh64_intdigest(payload) & 0xFFFFFFFF))
        self.heads.append((int(doc_ids[0]), len(doc_ids)))
        self.waiting, self.size = [], 0

    def close(self) -> None:
        self.flush()
        heads = b"".join(struct.pack("<qI", *h) for h in self.heads)
        self.stream.write(struct.pack("<II", DIRECTORY_FRAME, len(heads)) + heads)
        table = b"".join(struct.pack("<III", *e) for e in self.entries)
        table += struct.pack("<IBI", len(self.entries), CHECKSUMS, SEEK_MAGIC)
        self.stream.write(struct.pack("<II", SEEK_FRAME, len(table)) + table)
        self.stream.close()


class FrameReader:
    """Reads documents of one file; only the frames that are asked for are read and decompressed."""

    def __init__(self, path: str):
        system, place = opened(path)
        self.stream = system.open_input_file(place)
        end = self.stream.size()
        frames, flags, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != SEEK_MAGIC or flags != CHECKSUMS:
            raise ValueError(f"{path} has no seek table")
        table = end - 9 - 12 * frames
        self.entries = np.frombuffer(self._at(table, 12 * frames), "<u4").reshape(-1, 3)
        self.offsets = np.concatenate([[0], np.cumsum(self.entries[:, 0].astype(np.int64))])
        directory = self._at(table - 8 - 12 * frames, 12 * frames)
        self.heads = [struct.unpack_from("<qI", directory, 12 * i) for i in range(frames)]

    def _at(self, offset: int, size: int) -> bytes:
        self.stream.seek(offset)
        return self.stream.read(size)

    def frame(self, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document ids, lengths and token ids of a frame, its checksum verified."""
        packed, size, checksum = (int(x) for x in self.entries[i])
        payload = zstandard.ZstdDecompressor().decompress(self._at(int(self.offsets[i]), packed), max_output_size=size)
        if xxhash.xxh64_intdigest(payload) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {i} is damaged")
        n, width = struct.unpack_from("<II", payload)
        doc_ids, sizes = np.frombuffer(payload, "<i8", n, 8), np.frombuffer(payload, "<u4", n, 8 + 8 * n)
        return doc_ids, sizes, np.frombuffer(payload, f"<u{width}", -1, 8 + 12 * n).astype("<u4")

    def document(self, doc_id: int) -> list[np.ndarray]:
        """Token ids of every document with this id; reads the frames that may hold it."""
        found, first = [], [h for h, _ in self.heads]
        for i in range(max(int(np.searchsorted(first, doc_id, "left")) - 1, 0), int(np.searchsorted(first, doc_id, "right"))):
            doc_ids, sizes, ids = self.frame(i)
            ends = np.cumsum(sizes)
            found += [ids[ends[k] - sizes[k] : ends[k]] for k in np.flatnonzero(doc_ids == doc_id)]
        return found


def write_token_files(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text, append the end id and write the files in ascending order of ids.

    Returns the manifest, one row per file: file_no (in order of ids), path, documents, tokens.
    A task writes a file of its own name for each attempt, so only files named in the manifest
    count. Null texts are empty; null ids come first and are written as the smallest number;
    documents with the same id stay next to each other in the order of their texts' hash.
    """
    path = path or default_path("word_bpe_49k.json")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, writer, place = TaskContext.get(), None, ""
        encoder = PieceEncoder(path, "words")
        narrow = encoder.tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16
        for batch in batches:
            for part in text_slices(batch, "text"):
                ids, offsets = encoder.encode(part.column("text"))
                ids = np.insert(ids, offsets[1:], end_id).astype("<u2" if narrow else "<u4")
                ends = offsets[1:] + np.arange(1, len(offsets))
                if writer is None:
                    place = f"{folder}/ids-{context.partitionId():06d}-{context.taskAttemptId()}.zst"
                    system, local = opened(place)
                    system.create_dir(local.rpartition("/")[0], recursive=True)
                    writer = FrameWriter(system.open_output_stream(local, compression=None), narrow)
                for doc_id, a, b in zip(part.column("doc_id").to_pylist(), [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                    writer.add(NO_ID if doc_id is None else doc_id, ids[a:b])
        if writer is not None:
            writer.close()
            row = {"file_no": context.partitionId(), "path": place, "documents": writer.documents, "tokens": writer.tokens}
            yield pa.RecordBatch.from_pylist([row], pa.schema([("file_no", pa.int32()), ("path", pa.string()), ("documents", pa.int64()), ("tokens", pa.int64())]))

    narrow = id_and_text(docs, id_col, text_col)
    ordered = narrow.withColumn("key", F.xxhash64("text"))  # one id, or null, for many rows doesn't make one range
    order = [F.asc_nulls_first("doc_id"), F.col("key")]
    ordered = ordered.repartitionByRange(*order).sortWithinPartitions(*order)
    return cut(ordered.mapInArrow(write, "file_no int, path string, documents long, tokens long"))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Read files back: doc_id, start (tokens of all documents before), n_tokens, ids_crc32 and path."""
    upto = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    placed = manifest.select("file_no", "path", F.coalesce(F.sum("tokens").over(upto), F.lit(0)).alias("file_start"))
    kind = "doc_id long, start long, n_tokens long, ids_crc32 long, path string"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                reader, start = FrameReader(file["path"]), file["file_start"]
                for i in range(len(reader.entries)):
                    doc_ids, sizes, ids = reader.frame(i)
                    ends = np.cumsum(sizes, dtype=np.int64)
                    crc = [zlib.crc32(ids[e - n : e]) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
                    arrays = [pa.array(doc_ids, pa.int64(), mask=doc_ids == NO_ID), pa.array(start + ends - sizes, pa.int64()), pa.array(sizes, pa.int64()), pa.array(crc, pa.int64()), pa.array([file["path"]] * len(crc), pa.string())]
                    yield pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in kind.split(", ")])
                    start += int(ends[-1])

    files = manifest.count()
    return placed.repartition(max(files, 1), "file_no").mapInArrow(read, kind)


def token_files(docs: DataFrame, folder: str | None = None, path: str | None = None) -> DataFrame:
    """Write and read back in one step; the folder defaults to a new one among the checkpoints."""
    folder = folder or shared_folder(docs.sparkSession, "token-ids")
    return read_token_files(write_token_files(docs, folder, path))
