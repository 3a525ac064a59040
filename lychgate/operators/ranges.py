"""Joins of rows whose intervals of dates meet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lychgate.operators.asof import overlaps
from lychgate.sources.scratch import written

#: Rows of one key and bucket that a task may get of the right side, and how many larger ones are sent to all tasks.
MOST, SENT = 50_000, 10_000


def _days(date: str) -> Column:
    return F.unix_date(F.col(date).cast("date"))


def _buckets(rows: DataFrame, on: list[str], ends: tuple[str, str], width: int, domain: tuple[str, str]) -> DataFrame:
    """rows once for each bucket (_at) that their interval meets; what lies before or after the domain is in its first or last bucket."""
    low, high = (F.floor(F.unix_date(F.lit(x).cast("date")) / width).cast("int") for x in domain)
    place = lambda c, empty: F.when(F.col(c).isNull(), empty).otherwise(F.least(F.greatest(F.floor(_days(c) / width).cast("int"), low), high))
    known = F.lit(True)
    for c in on:
        known = known & F.col(c).isNotNull()
    turned = F.coalesce(_days(ends[0]) > _days(ends[1]), F.lit(False))
    rows = rows.where(known & ~turned).withColumn("_from", place(ends[0], low)).withColumn("_to", place(ends[1], high))
    return rows.withColumn("_at", F.explode(F.sequence("_from", "_to"))).drop("_to")


def interval_join(
    left: DataFrame, right: DataFrame, on: list[str], left_ends: tuple[str, str], right_ends: tuple[str, str], width: int = 366,
    domain: tuple[str, str] = ("1850-01-01", "2100-01-01"), most: int = MOST,
) -> DataFrame:
    """left and right rows with equal keys `on` whose closed intervals of dates meet; a missing end is open; a missing key
    and an interval that ends before it begins meet nothing. Columns of both sides, which share the names of the keys alone.

    An interval is put in each bucket of `width` days that it meets, rows meet by key and bucket, and a pair counts in the first bucket
    that both have. So what is compared grows with the rows of a key and bucket, not of a key. Where the right side has more
    than `most` rows in one, they are dealt to parts and the left rows go to all parts."""
    l, r = _buckets(left, on, left_ends, width, domain), _buckets(right, on, right_ends, width, domain)
    l, r = l.withColumnRenamed("_from", "_left"), r.withColumnRenamed("_from", "_right")
    keys = [*on, "_at"]
    large = written(r.groupBy(*keys).count().where(F.col("count") > most).select(*keys, F.ceil(F.col("count") / most).cast("int").alias("_parts")), "large")
    n = large.count()
    if n:
        large = F.broadcast(large) if n <= SENT else large
        parts = F.coalesce("_parts", F.lit(1))
        l = l.join(large, keys, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
        r = r.join(large, keys, "left").withColumn("_part", F.pmod(F.xxhash64(*right.columns), parts).cast("int")).drop("_parts")
        keys.append("_part")
    met = l.join(r, keys).where(F.col("_at") == F.greatest("_left", "_right"))
    met = met.where(overlaps(*(F.col(c).cast("date") for c in (*left_ends, *right_ends))))
    return met.select(*left.columns, *[c for c in right.columns if c not in on])
