"""Token matrices for training: best-fit-decreasing packing and binary rows.

Each task packs the documents of its own input partition, so no ids are shuffled. Pieces are taken in
blocks of bounded size, longest first; each goes to the open bin with the least room that still holds
it, found by descending a segment tree over room sizes. Documents longer than a row are split without
loss. Bins that a block leaves with room stay open for the next one; the oldest are closed beyond
OPEN_BINS, so memory does not grow with the partition.

A row of the matrix is binary: CAPACITY ids (unsigned 32-bit little-endian, padded with the pad id)
and as many positions, which start again from 0 at every segment; cu_seqlens holds the cumulative
segment lengths from 0. The segment of a document carries its id and its first token's place in it.

Defined results: null and empty texts give a segment with the closing id alone; equal documents are
each kept; an empty table gives no rows; extra columns are not read. Row ids are unique and the same on
a retried task, and follow the input's partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lychgate.llm.common import docs_of, small_batches, to_arrow
from lychgate.llm.packing import CLOSING
from lychgate.llm.tokens import byte_bpe

CAPACITY = 2048
BLOCK_TOKENS = 1 << 20
OPEN_BINS = 256
PAD = 0


class RoomTree:
    """Open bins by the room they have left; least(n) finds the least room that is n or more."""

    def __init__(self, capacity: int):
        self.size = 1
        while self.size <= capacity:
            self.size *= 2
        self.tree = [0] * (2 * self.size)
        self.bins: list[list] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, by: int) -> None:
        i = room + self.size
        while i:
            self.tree[i] += by
            i //= 2

    def put(self, room: int, what) -> None:
        self.bins[room].append(what)
        self._add(room, 1)

    def take(self, room: int):
        self._add(room, -1)
        return self.bins[room].pop()

    def least(self, n: int) -> int:
        tree, i = self.tree, n + self.size
        if tree[i]:
            return n
        while i > 1:
            if i % 2 == 0 and tree[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if tree[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return -1

    def __len__(self) -> int:
        return self.tree[1]


class BestFitDecreasing:
    """Bins of segments (doc id, start, ids); add() gives those that are full, close() the rest."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS):
        self.capacity, self.open_bins, self.rooms = capacity, open_bins, RoomTree(capacity)

    def add(self, pieces: list[tuple]) -> Iterator[list[tuple]]:
        """pieces: (doc id, start, ids as bytes), of any length up to the capacity."""
        for piece in sorted(pieces, key=lambda p: -len(p[2])):
            n = len(piece[2]) // 4
            room = self.rooms.least(n)
            own = self.rooms.take(room) if room >= 0 else []
            left = (room if room >= 0 else self.capacity) - n
            own.append(piece)
            if left:
                self.rooms.put(left, own)
            else:
                yield own
        room = 1
        while len(self.rooms) > self.open_bins:  # those with the least room go first
            room = self.rooms.least(room)
            yield self.rooms.take(room)

    def close(self) -> Iterator[list[tuple]]:
        while len(self.rooms):
            yield self.rooms.take(self.rooms.least(1))


def matrix_row(segments: list[tuple], capacity: int = CAPACITY) -> tuple[bytes, bytes, list[int]]:
    """(ids, positions, cumulative segment lengths) of a bin."""
    ids = b"".join([s[2] for s in segments])
    lengths = [len(s[2]) // 4 for s in segments]
    cumulative = np.concatenate([[0], np.cumsum(lengths)])
    positions = np.arange(capacity, dtype="<u4")
    positions[: cumulative[-1]] -= np.repeat(cumulative[:-1], lengths).astype("<u4")
    positions[cumulative[-1] :] -= np.uint32(cumulative[-1])
    pad = np.full(capacity - cumulative[-1], PAD, "<u4").tobytes()
    return ids + pad, positions.tobytes(), cumulative.tolist()


SCHEMA = (
    "row_id long, n_tokens long, doc_ids array<long>, starts array<long>, cu_seqlens array<int>, ids binary, positions binary"
)


def token_rows(docs: DataFrame, file: str, capacity: int = CAPACITY) -> DataFrame:
    """Packed rows of all documents: SCHEMA."""
    kinds = to_arrow(StructType.fromDDL(SCHEMA))

    def run(batches):
        from pyspark import TaskContext

        bpe, packer = byte_bpe(file), BestFitDecreasing(capacity)
        number = TaskContext.get().partitionId() << 33
        block: list[tuple] = []
        size = 0
        done: list[tuple] = []

        def emit(bins):
            nonlocal number
            for segments in bins:
                ids, positions, cumulative = matrix_row(segments, capacity)
                done.append((number, cumulative[-1], [s[0] for s in segments], [s[1] for s in segments], cumulative, ids, positions))
                number += 1
                if len(done) == 200:
                    yield flush()

        def flush():
            out = pa.RecordBatch.from_pydict(dict(zip(kinds.names, map(list, zip(*done, strict=True)), strict=True)), schema=kinds)
            done.clear()
            return out

        for batch in batches:
            for i, t in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                ids = bpe.encode(t or "") + CLOSING
                block += [(i, s // 4, ids[s : s + 4 * capacity]) for s in range(0, len(ids), 4 * capacity)]
                size += len(ids) // 4
                if size >= BLOCK_TOKENS:
                    yield from emit(packer.add(block))
                    block, size = [], 0
        yield from emit(packer.add(block))
        yield from emit(packer.close())
        if done:
            yield flush()

    return small_batches(docs.select(F.col("doc_id").cast("long"), "text")).mapInArrow(run, SCHEMA)


def write_rows(rows: DataFrame, path: str) -> None:
    """Rows as Parquet; what a loader needs to map ids as a matrix is one binary column of fixed width."""
    rows.write.mode("overwrite").option("compression", "zstd").parquet(path)


def as_matrix(rows: list, capacity: int = CAPACITY) -> np.ndarray:
    """Ids of collected rows, one row of the matrix each."""
    return np.frombuffer(b"".join(r["ids"] for r in rows), "<u4").reshape(-1, capacity)


def digest_rows(rows: DataFrame) -> DataFrame:
    """Rows with checksums in place of the binary columns."""
    return with_digests(rows).drop("ids", "positions")


def with_digests(rows: DataFrame) -> DataFrame:
    """Rows with checksums of the binary columns."""
    return rows.select(
        "row_id", "n_tokens", F.size("doc_ids").cast("long").alias("n_segments"), "doc_ids", "starts", "cu_seqlens",
        "ids", "positions", F.crc32("ids").alias("ids_crc32"), F.crc32("positions").alias("positions_crc32"),
    )


def op9_token_output(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return with_digests(token_rows(docs_of(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json")))
