"""Packing documents into sequences of bounded length, shortest pack first over the histogram.

A document is its ids and a closing id. It is cut into pieces of the sequence length and one rest;
the lengths of all pieces form a histogram of at most that many entries, which alone is packed: from
the longest length on, each piece goes to the pack that is shortest so far, if it fits there, else
to a new one, for whole groups of equal packs at once. The result is a list of patterns with counts.
Pieces of a length are numbered and take the pattern slots of that length in order.

Numbers come from counts by (bucket, length), so that a length that most pieces share is spread over
buckets; only the histogram and the slots (both bounded by the sequence length) reach the driver.

Defined results: a null or empty text is one piece with the closing id alone; a text of any length is
cut, nothing is dropped; documents with equal ids or texts are each packed; an empty table gives an
empty table; extra columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lychgate.llm.common import docs_of, map_batches, small_batches, to_arrow, written
from lychgate.llm.tokens import byte_bpe

LENGTH = 1024
CLOSING = b"\0\0\0\0"
#: Pieces of one bucket, about.
BUCKET_ROWS = 20_000


def shortest_pack_first(histogram: dict[int, int], capacity: int = LENGTH) -> list[tuple[int, tuple[int, ...]]]:
    """(count, lengths in a pack) that hold every piece of the histogram. A group of equal packs is
    split only where a length ends, so there are at most two groups a length."""
    groups: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    fills: list[int] = []

    def put(fill: int, count: int, pattern: tuple[int, ...]) -> None:
        if fill not in groups:
            groups[fill] = []
            heappush(fills, fill)
        groups[fill].append((count, pattern))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        if not 0 < length <= capacity:
            raise ValueError(f"piece of length {length}")
        while left and fills and fills[0] + length <= capacity:
            fill = fills[0]
            count, pattern = groups[fill].pop()
            if not groups[fill]:
                del groups[fill]
                heappop(fills)
            take = min(left, count)
            if take < count:
                put(fill, count - take, pattern)
            put(fill + length, take, (*pattern, length))
            left -= take
        deep = capacity // length
        if left >= deep:
            put(deep * length, left // deep, (length,) * deep)
            left %= deep
        if left:
            put(left * length, 1, (length,) * left)
    return [g for fill in sorted(groups) for g in groups[fill]]


def slots_of(patterns: list[tuple[int, tuple[int, ...]]]) -> dict[int, tuple[list[int], list[int], list[int]]]:
    """By length: the first rank of each slot, the first sequence of its pattern, its offset there."""
    slots: dict[int, tuple[list[int], list[int], list[int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for count, pattern in patterns:
        offset = 0
        for length in pattern:
            first, base, at = slots.setdefault(length, ([], [], []))
            first.append(used.get(length, 0))
            base.append(sequence)
            at.append(offset)
            used[length] = used.get(length, 0) + count
            offset += length
        sequence += count
    return slots


def pieces_of(docs: DataFrame, file: str, length: int = LENGTH) -> DataFrame:
    """Cut documents: doc_id, start, length, ids_crc32, doc_tokens."""

    def batch(cols):
        bpe = byte_bpe(file)
        rows = []
        for i, t in zip(cols["doc_id"], cols["text"], strict=True):
            ids = bpe.encode(t or "") + CLOSING
            n = len(ids) // 4
            rows += [(i, s, min(length, n - s), zlib.crc32(ids[4 * s : 4 * (s + length)]), n) for s in range(0, n, length)]
        yield dict(zip(("doc_id", "start", "length", "ids_crc32", "doc_tokens"), map(list, zip(*rows, strict=True)), strict=True))

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), batch, schema)


def ranked(pieces: DataFrame) -> DataFrame:
    """pieces with rank, from 0 among those of equal length; no task holds more than a bucket of a length."""
    buckets = max(1, -(-pieces.count() // BUCKET_ROWS))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("bucket", "length").count().withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0)))
    own = Window.partitionBy("bucket", "length").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    return (
        dealt.withColumn("own", F.row_number().over(own) - 1)
        .join(offsets.drop("count"), ["bucket", "length"])
        .withColumn("rank", F.col("own") + F.col("before"))
        .drop("bucket", "own", "before")
    )


def pack(docs: DataFrame, file: str, length: int = LENGTH) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    pieces = written(pieces_of(docs, file, length), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    slots = slots_of(shortest_pack_first(histogram, length))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = to_arrow(_ddl(schema))
    shared = pieces.sparkSession.sparkContext.broadcast(slots)

    def place(batches):
        at = shared.value
        for batch in batches:
            cols = batch.to_pydict()
            rows = []
            for n, r in zip(cols["length"], cols["rank"], strict=True):
                first, base, offset = at[n]
                k = bisect_right(first, r) - 1
                rows.append((base[k] + r - first[k], offset[k]))
            out = {k: cols[k] for k in names[:5]} | {"sequence_id": [x[0] for x in rows], "offset": [x[1] for x in rows]}
            yield pa.RecordBatch.from_pydict(out, schema=kinds)

    return small_batches(ranked(pieces)).mapInArrow(place, schema)


def _ddl(schema: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema)


def gather_sequences(packed: DataFrame, docs: DataFrame, file: str) -> DataFrame:
    """Sequences with their ids: sequence_id, ids array<int> in order of offset. Pieces are cut from the
    documents again by doc_id, which must be unique here."""
    spans = packed.groupBy("doc_id").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("spans"))

    def batch(cols):
        bpe = byte_bpe(file)
        rows = []
        for t, spans in zip(cols["text"], cols["spans"], strict=True):
            ids = np.frombuffer(bpe.encode(t or "") + CLOSING, "<u4")
            rows += [(s["sequence_id"], s["offset"], ids[s["start"] : s["start"] + s["length"]].tolist()) for s in spans]
        yield {"sequence_id": [r[0] for r in rows], "offset": [r[1] for r in rows], "part": [r[2] for r in rows]}

    parts = map_batches(docs.join(spans, "doc_id").select("text", "spans"), batch, "sequence_id long, offset long, part array<int>")
    ordered = F.sort_array(F.collect_list(F.struct("offset", "part")))
    return parts.groupBy("sequence_id").agg(F.flatten(F.transform(ordered, lambda x: x["part"])).alias("ids"))


def op3_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(docs_of(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
