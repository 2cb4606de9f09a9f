"""Token ids in wavelet matrices: one compressed file per shard, with access, counts and places of ids."""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoarfrost.llm.common import SharedFile, map_arrow, new_folder, pieces, read_file, running_total, stored, text_buffers
from hoarfrost.llm.tokens import crc_of, encoder, with_end

MAGIC = b"WMTX0001"
#: Ids after which a task begins another file. A document is never cut.
SHARD_IDS = 1 << 22
#: Bits between two entries of a plane's rank directory.
BLOCK_BITS = 512
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


class WaveletMatrix:
    """Ids as bit planes, the highest bit first; after each plane the zeros move before the ones, in order.

    A plane is kept packed, with the number of ones before each block, so a rank looks at one block.
    """

    def __init__(self, planes: list[np.ndarray], length: int):
        self.planes, self.length = planes, length
        self.levels = len(planes)
        self.ranks = []
        for plane in planes:
            step = BLOCK_BITS // 8
            padded = np.zeros(-(-len(plane) // step) * step, np.uint8)
            padded[: len(plane)] = _ONES[plane]
            ones = padded.reshape(-1, step).sum(1, dtype=np.int64)
            self.ranks.append(np.concatenate([[0], np.cumsum(ones)]))
        self.zeros = [length - int(r[-1]) for r in self.ranks]

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        levels = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        row = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        planes = []
        for level in range(levels - 1, -1, -1):
            bits = row & row.dtype.type(1 << level) != 0
            planes.append(np.packbits(bits))
            # Compressed in place: on bits without a pattern this takes a third of the time of an index by mask.
            after, zeros = np.empty_like(row), len(row) - np.count_nonzero(bits)
            np.compress(~bits, row, out=after[:zeros])
            np.compress(bits, row, out=after[zeros:])
            row = after
        return cls(planes, len(ids))

    def decode(self) -> np.ndarray:
        """All ids: the planes are undone from the last to the first, and each adds its bit."""
        row = np.zeros(self.length, np.uint16 if self.levels <= 16 else np.uint32)
        for level, plane in enumerate(reversed(self.planes)):
            bits = np.unpackbits(plane, count=self.length).view(bool)
            before = np.empty_like(row)
            zeros = self.zeros[self.levels - 1 - level]
            before[np.flatnonzero(~bits)] = row[:zeros]
            before[np.flatnonzero(bits)] = row[zeros:] | row.dtype.type(1 << level)
            row = before
        return row.astype(np.uint32)

    def _ones(self, plane: int, at: np.ndarray) -> np.ndarray:
        """Ones before each place of a plane."""
        at = np.asarray(at, np.int64)
        block = at // BLOCK_BITS
        count = self.ranks[plane][block].copy()
        byte, upto = block * (BLOCK_BITS // 8), at // 8
        for k in range(BLOCK_BITS // 8):
            whole = byte + k < upto
            if not whole.any():
                break
            count[whole] += _ONES[self.planes[plane][(byte + k)[whole]]]
        rest = at % 8
        last = self.planes[plane][np.minimum(upto, len(self.planes[plane]) - 1)] if self.length else np.zeros(len(at), np.uint8)
        return count + _ONES[np.where(rest > 0, last >> (8 - rest), 0).astype(np.uint8)]

    def access(self, at: np.ndarray) -> np.ndarray:
        """The ids at some places, without decoding the others."""
        at, out = np.asarray(at, np.int64), np.zeros(len(at), np.uint32)
        for plane in range(self.levels):
            ones = self._ones(plane, at)
            bit = (self.planes[plane][at // 8] >> (7 - at % 8).astype(np.uint8)) & 1
            out = (out << np.uint32(1)) | bit
            at = np.where(bit == 1, self.zeros[plane] + ones, at - ones)
        return out

    def _interval(self, token: int, upto: int) -> tuple[int, int]:
        low, high = 0, upto
        if token >> self.levels:
            return 0, 0
        for plane in range(self.levels):
            a, b = self._ones(plane, np.array([low, high])).tolist()
            if token >> (self.levels - 1 - plane) & 1:
                low, high = self.zeros[plane] + a, self.zeros[plane] + b
            else:
                low, high = low - a, high - b
        return low, high

    def count(self, token: int, upto: int | None = None) -> int:
        """How often an id occurs, before a place if one is given (rank)."""
        low, high = self._interval(token, self.length if upto is None else upto)
        return high - low

    def places(self, token: int) -> np.ndarray:
        """Every place of an id (select for all ranks at once), in ascending order."""
        low, high = self._interval(token, self.length)
        at = np.arange(low, high, dtype=np.int64)
        for plane in range(self.levels - 1, -1, -1):
            bits = np.unpackbits(self.planes[plane], count=self.length)
            one = token >> (self.levels - 1 - plane) & 1
            at = np.flatnonzero(bits == one)[at - (self.zeros[plane] if one else 0)]
        return at


def pack(keys: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    """One shard's file: a header, each document's key and number of ids, and the compressed planes."""
    matrix, zip_ = WaveletMatrix.build(ids), zstandard.ZstdCompressor(level=1)
    sections = [zip_.compress(json.dumps(keys).encode()), zip_.compress(counts.astype("<u4").tobytes())]
    sections += [zip_.compress(plane.tobytes()) for plane in matrix.planes]
    head = struct.pack("<QQI", matrix.length, len(keys), matrix.levels)
    return b"".join([MAGIC, head, struct.pack(f"<{len(sections)}Q", *map(len, sections)), *sections])


def unpack(data: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """A file's keys, numbers of ids and matrix."""
    if data[:8] != MAGIC:
        raise ValueError("not a wavelet shard")
    length, _, levels = struct.unpack_from("<QQI", data, 8)
    sizes = struct.unpack_from(f"<{levels + 2}Q", data, 28)
    at, unzip, sections = 28 + 8 * (levels + 2), zstandard.ZstdDecompressor(), []
    for size in sizes:
        sections.append(unzip.decompress(data[at : at + size]))
        at += size
    planes = [np.frombuffer(x, np.uint8) for x in sections[2:]]
    return json.loads(sections[0]), np.frombuffer(sections[1], "<u4").astype(np.int64), WaveletMatrix(planes, length)


def write_shards(
    docs: DataFrame, tokenizer: str, end: int, folder: str, key: str = "doc_id", text: str = "text", lower: bool = False, shard_ids: int = SHARD_IDS
) -> DataFrame:
    """Encode every text, and write the ids in ascending key order as wavelet shards below `folder`.

    Returns a stored table of the files: part and seq (together their order), file, docs and ids. The
    key must be an integer. A key that many rows share is split over tasks by its texts and by row.
    Null texts are empty, null keys come first; each row is a document, repeated or not.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        encode = encoder(tokenizer, lower, special=True).encode
        keys, counts, ids = [], [], []

        def flush() -> pa.RecordBatch:
            nonlocal seq
            name, flat = f"part-{part:07d}-{seq:05d}.wm", np.concatenate(ids)
            file = SharedFile(folder, name)
            file.write(pack(keys, np.concatenate(counts), flat))
            file.close()
            row = {"part": [part], "seq": [seq], "file": [name], "docs": [len(keys)], "ids": [len(flat)]}
            seq += 1
            for x in (keys, counts, ids):
                x.clear()
            return pa.RecordBatch.from_pydict(row)

        for batch in pieces(batches, text):
            got, offsets = with_end(*encode(*text_buffers(batch.column(text))), end)
            keys += batch.column(key).to_pylist()
            counts.append(np.diff(offsets))
            ids.append(got)
            if sum(map(len, ids)) >= shard_ids:
                yield flush()
        if keys:
            yield flush()

    rows = docs.select(F.col(key).cast("long").alias(key), text, F.xxhash64(text).alias("_text"), F.monotonically_increasing_id().alias("_row"))
    ordered = rows.repartitionByRange(key, "_text", "_row").sortWithinPartitions(key, "_text", "_row").select(key, text)
    return stored(map_arrow(ordered, write, "part long, seq long, file string, docs long, ids long", keeps=True), "wavelet-files")


def read_shards(files: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """Per document, from the files alone: key, start (ids of all documents before it), n_tokens, ids_crc32."""

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, first in zip(batch.column("file").to_pylist(), batch.column("first").to_pylist(), strict=True):
                keys, counts, matrix = unpack(read_file(folder, name))
                ids, ends = matrix.decode(), np.cumsum(counts)
                crcs = [crc_of(ids[b - n : b]) for b, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                columns = [pa.array(keys, pa.int64()), pa.array(first + ends - counts), pa.array(counts), pa.array(crcs, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [key, "start", "n_tokens", "ids_crc32"])

    numbered = running_total(files.withColumn("_at", F.col("part") * (1 << 20) + F.col("seq")), "_at", "ids", "first")
    placed = stored(numbered.select("file", "first", "ids"), "wavelet-places")
    # Files are much larger than their rows here, so they are dealt out one by one.
    parts = max(1, min(placed.count(), 100_000))
    return map_arrow(placed.repartition(parts, "file"), load, f"{key} long, start long, n_tokens long, ids_crc32 long")


def lookup(files: DataFrame, folder: str, token: int) -> DataFrame:
    """Every occurrence of an id: file, doc_id and place in the document. Only planes are searched."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                keys, counts, matrix = unpack(read_file(folder, name))
                at, ends = matrix.places(token), np.cumsum(counts)
                doc = np.searchsorted(ends, at, "right")
                keys = np.array(keys, object)
                arrays = [pa.array([name] * len(at), pa.string()), pa.array(keys[doc], pa.int64()), pa.array(at - (ends - counts)[doc])]
                yield pa.RecordBatch.from_arrays(arrays, ["file", "doc_id", "place"])

    return map_arrow(files.select("file"), find, "file string, doc_id long, place long")


def index_documents(docs: DataFrame, tokenizer: str, end: int) -> DataFrame:
    """Write documents as wavelet shards to a new folder and read them back, one row per document."""
    folder = new_folder(docs.sparkSession, "wavelet")
    return read_shards(write_shards(docs, tokenizer, end, folder), folder)
