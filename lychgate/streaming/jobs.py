"""Incremental jobs: landed list files, feed activity, late notices.

Each runs as often as it is started, takes what has landed since, and stops (`availableNow`); the checkpoint
remembers what was read. Replaying is a new checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lychgate.sources import readers


def landed_lists(spark: SparkSession, path: str, kind: str = "obit", glob: str | None = None) -> DataFrame:
    """A stream of list rows from a folder of files, those named for their kind unless glob says otherwise."""
    named, parse = ("*.obitList", readers.obit_list) if kind == "obit" else ("*.obitURLlist", readers.url_list)
    return parse(spark.readStream.option("pathGlobFilter", glob or named).text(path))


def run_once(stream: DataFrame, apply, checkpoint: str):
    """Hands each micro-batch to apply(batch, id) and returns when all that has landed is done."""
    q = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def _versions(spark: SparkSession, root: str):
    """(file system, Path, numbers of the finished versions under root in order)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path(root))] if fs.exists(path(root)) else []
    numbers = sorted(int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit())
    return fs, path, [n for n in numbers if fs.exists(path(f"{root}/v={n}/_SUCCESS"))]


def current(spark: SparkSession, root: str) -> DataFrame | None:
    """The latest finished version of an upserted table, None before the first."""
    _, _, done = _versions(spark, root)
    return spark.read.parquet(f"{root}/v={done[-1]}") if done else None


def upsert_parquet(keys: list[str], order: str, root: str, keep: int = 2):
    """A batch function that keeps, in versions under root, the row of the greatest `order` a key, the stored one of equal
    ones. A batch makes the version after the latest finished one, whatever its own number, so a batch that is tried
    again and a replay under a new checkpoint add to what is stored and change nothing else. Versions older than the last
    `keep` are deleted."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fs, path, done = _versions(spark, root)
        rows = batch.withColumn("_stored", F.lit(0))
        if done:
            rows = spark.read.schema(batch.schema).parquet(f"{root}/v={done[-1]}").withColumn("_stored", F.lit(1)).unionByName(rows)
        rest = [c for c in batch.columns if c not in keys]
        latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(order, "_stored")).alias("r")).select(*keys, "r.*")
        latest.select(*batch.columns).write.mode("overwrite").parquet(f"{root}/v={done[-1] + 1 if done else 0}")
        for n in done[: 1 - keep] if keep > 1 else done:
            fs.delete(path(f"{root}/v={n}"), True)

    return apply


def first_notices(stream: DataFrame, key: str, time: str, late: str = "7 days") -> DataFrame:
    """Each key's first notice within the watermark."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def activity(stream: DataFrame, key: str, time: str, window: str = "1 day", late: str = "3 days") -> DataFrame:
    """Notices a key and window, when it is closed."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window), key).agg(F.count("*").alias("n"))


def high_water(landed: DataFrame, key: str, *marks: str) -> DataFrame:
    """Where the next crawl of each provider goes on from: the greatest of its marks."""
    return landed.groupBy(key).agg(*[F.max(m).alias(f"last_{m}") for m in marks])
