"""Keeping dimensions: surrogate ids, upserts with priorities, counters, word lists, feed bounds.

Parquet has no row updates, so an upsert is a union of old and new rows reduced to one a key, to be
written as a new version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from lychgate.sources.scratch import written


def numbered(df: DataFrame, order: str, name: str, first: int) -> DataFrame:
    """df with consecutive numbers from `first` in order of a column, without bringing all rows into one
    task: ranges are sorted apart, and the sizes of those before are added. The ranges are written, for both the
    sizes and the rows have to be of the same ones, whatever executor is lost."""
    sorted_ = written(df.repartitionByRange(F.col(order)).withColumn("_part", F.spark_partition_id()), "ranges")
    own = Window.partitionBy("_part").orderBy(order)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sorted_.groupBy("_part").count().withColumn("_before", F.coalesce(F.sum("count").over(before), F.lit(0)))
    rows = sorted_.withColumn("_own", F.row_number().over(own))
    return rows.join(F.broadcast(sizes.drop("count")), "_part").withColumn(name, F.col("_before") + F.col("_own") + F.lit(first - 1)).drop("_part", "_own", "_before")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], priority: Column) -> DataFrame:
    """One row a key: the greatest priority, at equal priorities the old one."""
    both = old.withColumn("_old", F.lit(1)).unionByName(new.withColumn("_old", F.lit(0)))
    rest = [c for c in old.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(priority, "_old")).alias("b")
    return both.groupBy(*keys).agg(best).select(*keys, *[F.col(f"b.{c}").alias(c) for c in rest])


def replace_rows(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old without the keys of new, and new: the later version of a table after DELETE and INSERT."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def insert_missing(old: DataFrame, new: DataFrame, key: str, name: str, *on: str) -> DataFrame:
    """old and the rows of new that it lacks by `on`, once each, in order of `name`, with ids from the greatest on. Of several new rows the
    least by their other columns, in order, is kept."""
    rest = [c for c in old.columns if c != key]
    others = [c for c in rest if c not in on]
    missing = new.select(*rest).join(old.select(*on), list(on), "left_anti")
    added = missing.groupBy(*on).agg(F.min(F.struct(*others)).alias("_least")).select(*on, "_least.*") if others else missing.distinct()
    first = (old.agg(F.max(key)).first()[0] or 0) + 1
    return old.unionByName(numbered(added, name, key, first).select(*[F.col(c).cast(old.schema[c].dataType) for c in old.columns]))


def observed(df: DataFrame, **counters: Column) -> tuple[DataFrame, Observation]:
    """df, and counts by name of its rows for which a test holds, told once df has been run, without another scan."""
    told = Observation()
    return df.observe(told, F.count(F.lit(1)).alias("read"), *[F.count_if(test).alias(k) for k, test in counters.items()]), told


def add_counts(old: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """male_count and female_count by name after signed changes, and the male share."""
    both = old.select(key, "male_count", "female_count").unionByName(changes.select(key, "male_count", "female_count"))
    out = both.groupBy(key).agg(F.sum("male_count").alias("male_count"), F.sum("female_count").alias("female_count"))
    n = F.col("male_count") + F.col("female_count")
    return out.withColumn("male_pct", F.when(n > 0, F.col("male_count") / n))


def feed_bounds(feeds: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """first_seen and last_seen widened by new dates; last_checked is emptied where a newer date came."""
    new = seen.groupBy(key).agg(F.min("day").alias("_lo"), F.max("day").alias("_hi"))
    out = feeds.join(new, key, "left")
    later = F.coalesce(F.col("_hi") > F.col("last_checked"), F.lit(False))
    return out.select(
        key, F.least("first_seen", "_lo").alias("first_seen"), F.greatest("last_seen", "_hi").alias("last_seen"),
        F.when(~later, F.col("last_checked")).alias("last_checked"),
    )


def inactivity(days: DataFrame, key: str, as_of: Column, grace: int = 3, longest: int = 21, factor: int = 3, name: str | None = None) -> DataFrame:
    """Per feed: distinct days of the last two years, the mean gap (whole days), days since the last one
    less grace, and whether that is an alert. Rows whose `name` column marks them as junk (BR and one more character at the
    beginning) do not count."""
    if name:
        days = days.where(F.coalesce(~F.col(name).like("BR_%"), F.lit(True)))
    recent = days.where((F.col("day") <= as_of) & (F.col("day") > F.add_months(as_of, -24))).select(key, "day").distinct()
    g = recent.groupBy(key).agg(F.count("*").alias("n_days"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    gap = F.floor(F.datediff("last_day", "first_day") / F.col("n_days"))
    quiet = F.greatest(F.lit(0), F.datediff(as_of, "last_day") - grace)
    return g.withColumn("mean_gap", gap).withColumn("quiet", quiet).withColumn("alert", (F.col("quiet") > factor * F.col("mean_gap")) | (F.col("quiet") > longest))
