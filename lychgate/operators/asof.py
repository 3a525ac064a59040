"""As-of and interval joins on an equality key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_before(left: DataFrame, right: DataFrame, key: str, at: str, when: str, *take: str) -> DataFrame:
    """Each left row (by row_id) with the right row of its key at the latest `when` up to `at`; of several
    at that moment the largest `take`. The running maximum over the merged, sorted rows of a key needs
    one shuffle and no row pairs."""
    from pyspark.sql import Window

    l = left.select(key, F.col(at).alias("_t"), F.lit(1).alias("_side"), "row_id", *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in take])
    r = right.select(key, F.col(when).alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast(left.schema["row_id"].dataType).alias("row_id"), *take)
    seen = F.when(F.col("_side") == 0, F.struct("_t", *take))
    w = Window.partitionBy(key).orderBy("_t", "_side").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    merged = l.unionByName(r).withColumn("_best", F.max(seen).over(w))
    return merged.where("_side = 1").select("row_id", key, F.col("_best._t").alias(when), *[F.col(f"_best.{c}").alias(c) for c in take])


def overlaps(a_from: Column, a_to: Column, b_from: Column, b_to: Column) -> Column:
    """Whether two closed intervals meet; a missing end is open."""
    return (a_from.isNull() | b_to.isNull() | (a_from <= b_to)) & (a_to.isNull() | b_from.isNull() | (b_from <= a_to))
