"""Bounded samples of labelled documents, for fitting classifiers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lychgate.llm.common import crc_mod, map_batches, written
from lychgate.llm.near_dup import Forest, band_keys, estimates, minima, pack_bits
from lychgate.llm.shingles import set_key, shingle_set

#: The most labelled rows that a classifier is fitted on, about.
TRAIN_ROWS = 20_000
#: Estimated similarity from which texts of a label are near copies here.
NEAR = 0.8


def held_out(id_col: Column) -> Column:
    return crc_mod(id_col, 5) == 0


def training_rows(spark: SparkSession, docs: DataFrame, sf_dir: str, label: str, rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, label 0/1) of labelled documents outside the held-out part: all of them, or an even sample of
    about `rows` by hash of the id. Only ids and labels of the sample are broadcast, so the bound holds
    for that too. Of several labels of an id the largest counts; rows without one are left out. Of texts of a label
    with equal sets of shingles, and of near copies (met in a band of minima and NEAR by their packed minima), one stands
    for all, lest their words count as often as they were copied; texts without words merge only if equal. Signatures
    of the sample alone reach the driver. The sample is written once, for it is read several times."""
    known = spark.read.parquet(f"{sf_dir}/labels.parquet").where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    part = max(1, -(-known.count() // rows))
    chosen = known.where(F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(part)) == 0)
    chosen = chosen.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max(label) > 0).cast("int").alias("label"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def batch(cols):
        sets = [shingle_set(t) for t in cols["text"]]
        low = [minima(s) if len(s) else None for s in sets]
        yield cols | {
            "set": [set_key(s) if len(s) else t.encode() for s, t in zip(sets, cols["text"], strict=True)],
            "bands": [[] if m is None else band_keys(m).tolist() for m in low],
            "packed": [[] if m is None else pack_bits(m).view(np.int64).tolist() for m in low],
        }

    schema = "text string, label int, set binary, bands array<long>, packed array<long>"
    keyed = map_batches(texts.join(F.broadcast(chosen), "doc_id").select("text", "label"), batch, schema)
    one = written(keyed.groupBy("set", "label").agg(F.min("text").alias("text"), F.first("bands").alias("bands"), F.first("packed").alias("packed")), "labelled")
    copies = near_copies(one.where("size(bands) > 0").select("set", "label", "bands", "packed").toArrow())
    gone = spark.createDataFrame(copies, "set binary, label int")
    return written(one.join(F.broadcast(gone), ["set", "label"], "left_anti").select("text", "label"), "labelled")


def near_copies(table: pa.Table) -> list[tuple[bytes, int]]:
    """(set, label) of all but the least of each group of near copies."""
    table = table.sort_by([("label", "ascending"), ("set", "ascending")])
    sets, labels, bands = (table[c].to_pylist() for c in ("set", "label", "bands"))
    packed = np.array(table["packed"].to_pylist(), np.int64).view(np.uint64)
    forest, first = Forest(len(sets)), {}
    for i, (label, keys) in enumerate(zip(labels, bands, strict=True)):
        for k in keys:
            j = first.setdefault((label, k), i)
            if forest.root(i) != forest.root(j) and estimates(packed[i : i + 1], packed[j : j + 1])[0, 0] >= NEAR:
                forest.join(i, j)
    return [(bytes(sets[i]), labels[i]) for i in range(len(sets)) if forest.root(i) != i]
