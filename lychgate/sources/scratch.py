"""Folders for files that a query writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def folder(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir, which all machines share, deleted when the application ends. Where that is
    unset, a temporary one if Spark runs in one process; on a cluster that is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if not root and app not in _own:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        _own[app] = "file://" + tempfile.mkdtemp(prefix="lychgate-files-")
    path = f"{(root or _own[app]).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(where)
    fs.deleteOnExit(where)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in a new folder, reread: cuts the lineage and outlives a lost executor."""
    path = f"{folder(df.sparkSession, name)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
