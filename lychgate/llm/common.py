"""What the training-data operators share: batches, scratch tables, caches, document ids."""

from __future__ import annotations

import ctypes
import gc
import re
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows and bytes of one Arrow batch handed to Python; whole texts are held, so batches are kept short. A row
#: that is longer alone makes a batch of its own.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20
#: Bytes that a worker's caches hold together, about, and the longest key that is kept.
CACHE_BYTES, CACHE_KEY = 96 << 20, 256

_own_dirs: dict[str, str] = {}


def docs_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir. Where it is unset, a temporary one if Spark runs in one
    process, as in tests; on a cluster that is an error, for its machines do not share one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        _own_dirs[app] = "file://" + tempfile.mkdtemp(prefix="lychgate-")
    return _own_dirs[app]


def _tables(spark: SparkSession) -> str:
    """This application's scratch tables, deleted when it ends."""
    path = f"{scratch_dir(spark)}/lychgate/{spark.sparkContext.applicationId}"
    if path not in _own_dirs:
        _hadoop(spark, path, lambda fs, p: fs.mkdirs(p) and fs.deleteOnExit(p))
        _own_dirs[path] = path
    return path


def _hadoop(spark: SparkSession, path: str, act: Callable):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return act(where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where)


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder, reread: cuts the lineage and outlives a lost executor."""
    spark = df.sparkSession
    path = f"{_tables(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(table: DataFrame) -> None:
    """Delete a table of written() of which everything that is still needed has been written too."""
    _hadoop(table.sparkSession, table._scratch, lambda fs, p: fs.delete(p, True))


def release(spark: SparkSession) -> None:
    """Delete every scratch table of this application; results read before stay valid only if written. Without
    it they go when the application ends."""
    path = _tables(spark)
    _hadoop(spark, path, lambda fs, p: fs.delete(p, True))
    _own_dirs.pop(path)


def map_batches(
    df: DataFrame, fn: Callable[[dict[str, list]], Iterable[dict[str, list]]], schema: str
) -> DataFrame:
    """fn over column lists of each Arrow batch; it yields column lists that fit the schema."""
    kinds = StructType.fromDDL(schema)
    arrow = to_arrow(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(start, BATCH_ROWS)
                for out in fn(part.to_pydict()):
                    yield pa.RecordBatch.from_pydict(out, schema=arrow)

    return small_batches(df).mapInArrow(run, schema)


def filter_texts(df: DataFrame, keep: Callable, model) -> DataFrame:
    """Rows of df for which keep(model, texts) holds, in one pass over whole rows; model is broadcast."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array([bool(x) for x in keep(shared.value, batch["text"].to_pylist())]))

    return small_batches(df).mapInArrow(run, df.schema)


#: Bits of the filter of likely(): 4 MB, whatever the tables' size.
FILTER_BITS = 25


def _places(ids: np.ndarray) -> np.ndarray:
    h = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - FILTER_BITS)


def bitmap_of(ids: DataFrame) -> np.ndarray:
    """One bit an id (a column of longs), at a hashed place of a bitmap of fixed size."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = np.unique(_places(batch.column(0).drop_null().to_numpy(zero_copy_only=False)))
            words, first = np.unique(places >> np.uint64(6), return_index=True)
            if len(words):
                one = np.bitwise_or.reduceat(np.uint64(1) << (places & np.uint64(63)), first)
                yield pa.RecordBatch.from_arrays([pa.array(words.astype(np.int32)), pa.array(one.view(np.int64))], names=["word", "bits"])

    words = ids.mapInArrow(bits, "word int, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bitmap = np.zeros(2 ** (FILTER_BITS - 6), np.uint64)
    bitmap[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return bitmap


def _sieve(df: DataFrame, shared, column: str, inside: bool) -> DataFrame:
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                known = batch[column].is_valid().to_numpy(zero_copy_only=False)
                at = _places(batch[column].fill_null(0).to_numpy(zero_copy_only=False))
                hit = (shared.value[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool) & known
                yield batch.filter(pa.array(hit == inside))

    return small_batches(df).mapInArrow(keep, df.schema)


def likely(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows of df whose integer `column` may be in ids (one column of longs): all that are, and of the others a
    share that grows with the number of ids. Only the bitmap is broadcast; a join with ids then need not
    shuffle rows without partner."""
    return _sieve(df, df.sparkSession.sparkContext.broadcast(bitmap_of(ids)), column, True)


def parted(df: DataFrame, ids: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(rows that may be in ids, all other rows), as likely() tells them apart."""
    shared = df.sparkSession.sparkContext.broadcast(bitmap_of(ids))
    return _sieve(df, shared, column, True), _sieve(df, shared, column, False)


def small_batches(df: DataFrame) -> DataFrame:
    """Bounds the rows and bytes of Arrow batches. They are settings of the session, read when a plan is made
    ready to run, so they stay set."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def to_arrow(kinds: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(kinds)


def unused(name: str, columns: list[str]) -> str:
    """A column name like `name` that a table does not have, whatever the case of its own."""
    taken = {c.lower() for c in columns}
    name = f"__{name}"
    while name.lower() in taken:
        name += "_"
    return name


def crc_mod(id_col: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo n; null ids count as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % n


class TwoGenerations(dict):
    """A cache of at most `budget` bytes, about: what the last generation used is kept, the rest goes. Long keys are
    made anew each time. weigh: bytes of a value besides its own object's."""

    def __init__(self, make: Callable, budget: int, weigh: Callable = lambda value: 0):
        super().__init__()
        self.make, self.weigh, self.old, self.used, self.half = make, weigh, {}, 0, budget // 2

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) > CACHE_KEY:
            return value
        self.used += 100 + sys.getsizeof(key) + sys.getsizeof(value) + self.weigh(value)
        if self.used > self.half:
            self.old, self.used = dict(self), 0
            self.clear()
        self[key] = value
        return value


_held: dict = {}


def held(owner: tuple, make: Callable, model=None):
    """What an operator keeps in this worker, made anew for another model. A worker serves one operator after the
    other, so what another one kept goes first and its memory is given back."""
    if owner not in _held or _held[owner][0] is not model:
        forget()
        _held[owner] = model, make()
    return _held[owner][1]


def forget() -> None:
    """Drop what operators keep in this worker; the driver keeps its own."""
    if _held and TaskContext.get():
        _held.clear()
        gc.collect()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library gives memory back by itself or not at all
            pass


#: Characters whose case, normal form and class do not differ between libraries' Unicode versions.
BEYOND_LATIN = re.compile("[^\x00-\u024f\u1e00-\u1eff\u2010-\u2027\u2030-\u205e]")
