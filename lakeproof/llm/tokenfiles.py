"""Token ids in files of compressed byte planes.

A chunk holds up to ``CHUNK_IDS`` ids as four byte planes: the first byte of every id,
then the second of every id and so on. Neighbouring bytes of one plane are alike, and
the planes of the high bytes nearly empty, so each plane is compressed by itself with
zstandard. A document of more than a chunk spans several; short ones share a chunk.

File: ``MAGIC``, the chunks, the index, and a trailer of index length and ``MAGIC``. The
index is zstandard of JSON: for each chunk its place, plane sizes, number of ids and the
id before which it starts, and the documents' ids and lengths in file order. Any range
of ids is read by the chunks that cover it.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from lakeproof.llm.encoding import encoder_of
from lakeproof.llm.support import in_slices, staged, text_of
from lakeproof.session import scratch_path
from lakeproof.sources.remote import resolve

MAGIC = b"LPTKPL01"
CHUNK_IDS = 1 << 16
PLANES = 4
VOCABULARY = "word_bpe_49k.json"
END_ID = 1
#: Bytes of text that make one file.
TEXT_PER_FILE = 32 << 20
FILE_SCHEMA = "file int, path string, documents bigint, tokens bigint, bytes bigint"


def planes(ids: np.ndarray) -> list[bytes]:
    """The byte planes of a block of ids, each compressed."""
    pack = zstandard.ZstdCompressor(level=3).compress
    table = ids.astype("<u4").view(np.uint8).reshape(-1, PLANES)
    return [pack(np.ascontiguousarray(table[:, k]).tobytes()) for k in range(PLANES)]


def from_planes(packed: list[bytes], count: int) -> np.ndarray:
    unpack = zstandard.ZstdDecompressor().decompress
    table = np.empty((count, PLANES), np.uint8)
    for k, plane in enumerate(packed):
        table[:, k] = np.frombuffer(unpack(plane, max_output_size=max(count, 1)), np.uint8)
    return table.reshape(-1).view("<u4")


class TokenFileWriter:
    """Writes documents in the order given; at most a chunk and one document are held."""

    def __init__(self, stream) -> None:
        self.stream, self.at, self.tokens = stream, 0, 0
        self.waiting: list[np.ndarray] = []
        self.held = 0
        self.index: dict[str, list] = {"chunks": [], "doc_ids": [], "lengths": []}
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.index["doc_ids"].append(doc_id)
        self.index["lengths"].append(len(ids))
        self.waiting.append(ids)
        self.held += len(ids)
        while self.held >= CHUNK_IDS:
            self._chunk(CHUNK_IDS)

    def _chunk(self, count: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.empty(0, "<u4")
        self.waiting, self.held = [ids[count:]], len(ids) - count
        packed = planes(ids[:count])
        self.index["chunks"].append([self.at, [len(p) for p in packed], count, self.tokens])
        self.tokens += count
        for plane in packed:
            self._put(plane)

    def close(self) -> None:
        if self.held:
            self._chunk(self.held)
        index = zstandard.ZstdCompressor().compress(json.dumps(self.index).encode())
        self._put(index)
        self._put(struct.pack("<Q", len(index)) + MAGIC)


class TokenFileReader:
    """Reads ids by their place in the file, chunk by chunk."""

    def __init__(self, stream, size: int) -> None:
        self.stream = stream
        stream.seek(size - 16)
        length, magic = struct.unpack("<Q8s", stream.read(16))
        if magic != MAGIC:
            raise ValueError("not a token file, or a broken one")
        stream.seek(size - 16 - length)
        self.index = json.loads(zstandard.ZstdDecompressor().decompress(stream.read(length)))
        self.starts = [c[3] for c in self.index["chunks"]]
        self.cached: tuple[int, np.ndarray] = (-1, np.empty(0, "<u4"))

    def chunk(self, number: int) -> np.ndarray:
        if self.cached[0] != number:
            at, sizes, count, _ = self.index["chunks"][number]
            self.stream.seek(at)
            self.cached = number, from_planes([self.stream.read(n) for n in sizes], count)
        return self.cached[1]

    def read(self, start: int, count: int) -> np.ndarray:
        parts, end = [], start + count
        number = max(int(np.searchsorted(self.starts, start, "right")) - 1, 0)
        while start < end:
            ids = self.chunk(number)[start - self.starts[number]:end - self.starts[number]]
            parts.append(ids)
            start, number = start + len(ids), number + 1
        return np.concatenate(parts) if parts else np.empty(0, "<u4")

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, place in the file, ids) in file order."""
        at = 0
        for doc_id, length in zip(self.index["doc_ids"], self.index["lengths"]):
            yield doc_id, at, self.read(at, length)
            at += length


def write_token_files(
    documents: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = END_ID, files: int | None = None,
) -> DataFrame:
    """Encode every text and write the ids in ascending doc_id order; (file, path, documents, tokens, bytes).

    Files are numbered in doc_id order. ``files`` is their number, or follows from the
    bytes of all texts. A file is written under a name of its own attempt, and the
    returned table names the attempt that counts, so a task that runs again after a lost
    executor does no harm. Null text is empty and leaves the end id alone; a null doc_id
    sorts first; repeated rows are written each.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    rows = documents.select("doc_id", text_of())
    if files is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        files = max(1, -(-size // TEXT_PER_FILE))
    # rows that share an id are told apart by their texts, and copies by their places, so that no id fills a file
    order = (F.col("doc_id").asc_nulls_first(), "version", "copy")
    ordered = rows.withColumns({"version": F.xxhash64("text"), "copy": F.monotonically_increasing_id()}).repartitionByRange(
        files, *order
    ).sortWithinPartitions(*order).select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        end, writer, count, encoder = np.array([end_id], "<u4"), None, 0, encoder_of(path)
        for batch in in_slices(batches):
            if writer is None:
                address = f"{folder}/{uuid.uuid4().hex}.tokens"
                filesystem, place = resolve(address)
                filesystem.create_dir(place.rsplit("/", 1)[0], recursive=True)
                stream = filesystem.open_output_stream(place)
                writer = TokenFileWriter(stream)
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), encoder.encode(batch["text"].to_pylist())):
                writer.add(doc_id, np.concatenate([np.frombuffer(ids, "<u4"), end]))
                count += 1
        if writer is not None:
            writer.close()
            stream.close()
            yield pa.RecordBatch.from_pydict({
                "file": pa.array([TaskContext.get().partitionId()], pa.int32()), "path": [address],
                "documents": pa.array([count], pa.int64()), "tokens": pa.array([writer.tokens], pa.int64()),
                "bytes": pa.array([writer.at], pa.int64()),
            })

    return staged(ordered.mapInArrow(write, FILE_SCHEMA), "token-files")


def read_token_files(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files that a table names.

    ``start`` counts the ids of all documents before it, in the order of the files. The
    window over files is small: it holds one row for each file.
    """
    before = F.sum("tokens").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    placed = staged(files.select("path", F.coalesce(before, F.lit(0)).alias("before")), "token-places")
    count = max(1, placed.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                filesystem, place = resolve(row["path"])
                with filesystem.open_input_file(place) as stream:
                    reader = TokenFileReader(stream, stream.size())
                    found = []
                    for doc_id, at, ids in reader.documents():
                        found.append((doc_id, row["before"] + at, len(ids), zlib.crc32(ids.tobytes())))
                        if len(found) == 4096:
                            yield _read_batch(found)
                            found = []
                    yield _read_batch(found)

    # dealt out one by one: a hash of so few rows would give some tasks several files and others none
    return placed.coalesce(1).repartition(count).mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _read_batch(found: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*found)) or [[]] * 4
    names = ("doc_id", "start", "n_tokens", "ids_crc32")
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], list(names))


def token_file_round_trip(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Write the documents' ids to files in the shared folder and report what the files hold."""
    return read_token_files(write_token_files(documents, scratch_path(spark, "tokens")))
