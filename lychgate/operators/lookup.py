"""Lookups against dimensions: batch forms of point queries, existence tests and getters.

A dimension is joined, never looked up row by row; whether it is broadcast is left to the planner's
size estimate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lychgate.sources.scratch import written


def count_by(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    """Rows per key, null keys as a group of their own."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def exists(df: DataFrame, other: DataFrame, on, negate: bool = False) -> DataFrame:
    """Rows of df that have (or have not) a partner in other; df's columns only."""
    return df.join(other, on, "left_anti" if negate else "left_semi")


def with_default(df: DataFrame, other: DataFrame, on: str, column: str, default) -> DataFrame:
    """df with a column of other's, a literal where there is no partner or its value is null."""
    looked = other.select(on, column)
    return df.join(looked, on, "left").withColumn(column, F.coalesce(column, F.lit(default)))


def any_equals(columns: list[str], value: Column) -> Column:
    """Whether any of the columns holds value; nulls never do."""
    return F.coalesce(F.array_contains(F.array_compact(F.array(*columns)), value), F.lit(False))


def all_of(values: Column, test) -> Column:
    """A test that holds for every element of a list that is not empty."""
    return F.coalesce((F.size(values) > 0) & F.forall(values, test), F.lit(False))


#: Different places of a cell that are compared one by one, and the greatest depth of cells.
PLACES, DEEPEST = 64, 15


def nearest_by(df: DataFrame, places: DataFrame, key: str, take: str) -> DataFrame:
    """(row_id, take, distance): per row of df (row_id, key, qx, qy) the place (take, x, y) of the same key at least squared distance, ties to the
    least of take; distances that are no number come last, missing ones at the very end.

    Cells of a key are parted in 16 until they hold few different places. A row goes down from cell to cell, and only into those
    whose places may be as near as what another cell is sure to have."""
    number = lambda *names: reduce(lambda a, b: a & b, [F.abs(c) < 1e150 for c in names])  # noqa: E731  nulls are none
    rank = lambda: F.struct(F.col("distance").isNull().alias("missing"), "distance", take)
    dx, dy = F.col("qx") - F.col("x"), F.col("qy") - F.col("y")
    fine = places.where(number("x", "y")).groupBy(key, "x", "y").agg(F.min(take).alias(take))
    ends = [f(c).alias(f"{n}{c}") for c in ("x", "y") for n, f in (("lo", F.min), ("hi", F.max))]
    boxes = fine.groupBy(key).agg(*ends)
    step = lambda c: F.least(F.floor((F.col(c) - F.col(f"lo{c}")) / F.greatest(F.col(f"hi{c}") - F.col(f"lo{c}"), F.lit(1e-300)) * 4.0**DEEPEST), F.lit(4**DEEPEST - 1))
    fine = written(fine.join(boxes, key).select(key, "x", "y", take, step("x").alias("cx"), step("y").alias("cy")), "places")
    at = lambda depth: [F.shiftright(c, 2 * (DEEPEST - depth)).alias(n) for c, n in (("cx", "i"), ("cy", "j"))]

    def cells(depth: int) -> DataFrame:
        return fine.groupBy(key, *at(depth)).agg(*ends, F.count("*").alias("n"))

    def beyond(c: str, far: bool) -> Column:
        low, high = F.col(f"lo{c}") - F.col(f"q{c}"), F.col(f"q{c}") - F.col(f"hi{c}")
        d = F.greatest(F.abs(low), F.abs(high)) if far else F.greatest(low, high, F.lit(0.0))
        return d * d

    # Rows or keys without a plain distance: what counts of a place is only whether it is a number, and which not.
    kinds = [e for c in ("x", "y") for e in (F.col(c).isNull(), F.when(~number(c), F.col(c)))]
    kinds = places.groupBy(key, *[e.alias(f"_{k}") for k, e in enumerate(kinds)]).agg(F.min_by(F.struct("x", "y", take), take).alias("p")).select(key, "p.*")
    known = boxes.select(key, F.lit(True).alias("known"))
    rows = df.join(known, key, "left").withColumn("plain", F.coalesce(number("qx", "qy") & F.col("known"), F.lit(False)))
    odd = rows.where("not plain").join(kinds, key).withColumn("distance", dx * dx + dy * dy).select("row_id", take, "distance")
    open_ = rows.where("plain").select("row_id", key, "qx", "qy", F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j"))
    out, depth = [odd], 0
    while True:
        met = open_.join(cells(depth), [key, "i", "j"]).withColumn("near", beyond("x", False) + beyond("y", False)).withColumn("far", beyond("x", True) + beyond("y", True))
        bound = met.groupBy("row_id").agg(F.min("far").alias("bound"))
        met = written(met.join(bound, "row_id").where("near <= bound").select("row_id", key, "qx", "qy", "i", "j", "n"), "cells")
        last = F.lit(depth == DEEPEST) | (F.col("n") <= PLACES)
        ends_here = met.where(last).join(fine.select("*", *at(depth)), [key, "i", "j"])
        out.append(ends_here.withColumn("distance", dx * dx + dy * dy).select("row_id", take, "distance"))
        met = met.where(~last)
        if met.isEmpty():
            break
        depth += 1
        child = F.explode(F.sequence(F.lit(0), F.lit(15))).alias("c")
        open_ = met.select("row_id", key, "qx", "qy", "i", "j", child).select("row_id", key, "qx", "qy", *[(F.col(n) * 4 + part).alias(n) for n, part in (("i", F.col("c") % 4), ("j", F.floor(F.col("c") / 4)))])
    every = reduce(DataFrame.union, out)
    return every.groupBy("row_id").agg(F.min(rank()).alias("best")).select("row_id", F.col(f"best.{take}").alias(take), "best.distance")


def unless_missing(*values: Column) -> Column:
    """The greatest of values, null if any is: the rule of engines whose GREATEST does not skip nulls."""
    known = F.lit(True)
    for v in values:
        known = known & v.isNotNull()
    return F.when(known, F.greatest(*values))


def changed_columns(columns: list[str], prefix: str) -> Column:
    """Names of the columns that differ, nulls being equal, from those of the same name with a prefix."""
    return F.array_compact(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(prefix + c)), F.lit(c)) for c in columns]))


def valid_record_exists(df: DataFrame, other: DataFrame, on: list[str], number: str, compat: bool = False) -> DataFrame:
    """df with `found`: whether other has its keys. compat: only where the number found there is 0."""
    seen = other.groupBy(*on).agg(F.max(number).alias("_n")).withColumn("_hit", (F.col("_n") == 0) if compat else F.lit(True))
    return df.join(seen.select(*on, "_hit"), on, "left").withColumn("found", F.coalesce("_hit", F.lit(False))).drop("_hit")


def shuffled(df: DataFrame, seed: int, ordinal: str = "ordinal") -> DataFrame:
    """df in random order, with a column by which sorting restores the order it had by `ordinal`."""
    return df.orderBy(F.xxhash64(F.col(ordinal), F.lit(seed)))


def place_of(df: DataFrame, codes: DataFrame, areas: DataFrame, on: str = "postal_code") -> DataFrame:
    """df with place and province of a postal code (codes: on, place, province), or of its first three characters (areas: area,
    place, province) where the code is not known."""
    whole = codes.select(on, F.col("place").alias("_place"), F.col("province").alias("_province"))
    part = areas.select(F.col("area").alias("_area"), F.col("place").alias("_near"), F.col("province").alias("_within"))
    rows = df.join(whole, on, "left").join(part, F.left(F.col(on), F.lit(3)) == F.col("_area"), "left")
    return rows.select(*df.columns, F.coalesce("_place", "_near").alias("place"), F.coalesce("_province", "_within").alias("province"))


def pure_nicknames(df: DataFrame, nicknames: DataFrame, name: str) -> DataFrame:
    """Rows of df whose name is a nickname (nickname, formal_names) without any formal one."""
    return df.join(nicknames.where(F.coalesce(F.size("formal_names"), F.lit(0)) <= 0).select(F.col("nickname").alias(name)).distinct(), name, "left_semi")


def only_one(df: DataFrame, key: str, *take: str) -> DataFrame:
    """(key, take) of the keys that stand in one row only."""
    return df.groupBy(key).agg(F.count("*").alias("_n"), F.first(F.struct(*take)).alias("_row")).where("_n = 1").select(key, "_row.*")


def or_default(df: DataFrame, keys: DataFrame, key: str, default: dict) -> DataFrame:
    """Rows of df for keys (one column), and a row of defaults for a key without any."""
    return keys.join(df, key, "left").select(key, *[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in default.items()])


def urls_of(df: DataFrame, key: str, url: str) -> DataFrame:
    """(key, urls): each key's urls in order, once."""
    return df.where(F.col(url).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_set(url)).alias("urls"))


def kinds_of(lists: DataFrame, names: DataFrame) -> DataFrame:
    """(id, are_surnames, are_names, are_places) of lists (id, values): whether all are surnames and no given names, all are given
    names or nicknames, all are places, by names (name, kind: given, nickname, surname, place). False for empty lists."""
    kinds = names.groupBy(F.lower("name").alias("_name")).agg(F.collect_set("kind").alias("_kinds"))
    each = lists.select("id", F.explode("values").alias("_name")).withColumn("_name", F.lower("_name")).join(kinds, "_name", "left")
    has = lambda k: F.coalesce(F.array_contains("_kinds", k), F.lit(False))
    told = each.groupBy("id").agg(
        F.bool_and(has("surname") & ~has("given")).alias("are_surnames"), F.bool_and(has("given") | has("nickname")).alias("are_names"), F.bool_and(has("place")).alias("are_places")
    )
    return lists.select("id").join(told, "id", "left").na.fill(False)
