"""The best of what a stored person and later records of the same person tell.

Records of a person are never brought together as a list: what is newest is an aggregate, and names are first reduced to
different ones. So a person with very many records is spread like any other rows before they are grouped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lychgate.functions import dates
from lychgate.functions.names import name_key
from lychgate.operators.linkage import merged_names

#: Columns of which the newest known value counts, and those whose contradictions are told.
NEWEST = ("gender", "dob", "dod", "yob", "yod", "age", "spouse", "service")
TOLD = ("gender", "dob", "dod", "yob", "yod", "age", "service")
LISTS = {"firsts": 3, "middles": 9, "lasts": 4}
#: Feeds from this number on know places better than those below, but for one.
SURE_FEED, UNSURE_FEED = 1000, 1021


def _lists(records: DataFrame) -> DataFrame:
    """id and, for each of LISTS, the different names of a person's records in order of their first appearance."""

    def told(kind: str) -> Column:
        return F.transform(F.coalesce(kind, F.array().cast("array<string>")), lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("at"), x.alias("name")))

    each = F.explode(F.concat(*map(told, LISTS)))
    names = records.select("id", "order", each.alias("x")).select("id", "order", "x.*").where("name is not null and trim(name) != ''")
    first = names.groupBy("id", "kind", name_key(F.col("name")).alias("key")).agg(F.min(F.struct("order", "at", "name")).alias("x"))
    listed = lambda c: F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == c, F.col("x")))), lambda x: x["name"]).alias(f"_{c}")
    return first.groupBy("id").agg(*[listed(c) for c in LISTS])


def merged(stored: DataFrame, records: DataFrame, nicknames: DataFrame) -> DataFrame:
    """stored persons (id, firsts, middles, lasts, NEWEST, place, feed, low, high) after records (the same but low and high, and order).

    First names: the stored ones, then new ones, without repeats up to accents and case, those that are only nicknames (a column name)
    last, three at most; middle and last names likewise. Other values: the newest known one, else the stored. Years come from dates that
    are known, and the age from both. The range of the birth is what dates, years and age allow, within the stored one where they
    meet. The newest known place counts, but not one of a feed below SURE_FEED against the place of a feed from it on (UNSURE_FEED
    apart). contradicted lists the columns of which a record tells another value than the stored one. Persons without records stay as
    they are, records of unknown persons are left out."""
    known = stored.select("id", *[F.col(c).alias(f"_{c}") for c in TOLD])
    off = [F.coalesce(F.max((F.col(c) != F.col(f"_{c}")).cast("int")), F.lit(0)).alias(f"off_{c}") for c in TOLD]
    newest = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("order"))).alias(f"new_{c}") for c in NEWEST]
    place = F.max_by(F.struct("place", "feed"), F.when(F.col("place").isNotNull(), F.col("order"))).alias("new_place")
    told = records.join(known, "id").groupBy("id").agg(*newest, place, *off)
    rows = stored.join(told, "id", "left").join(_lists(records), "id", "left")
    pure = stored.select("id", F.explode("firsts").alias("name")).union(records.select("id", F.explode("firsts")))
    pure = pure.withColumn("key", name_key(F.col("name"))).join(nicknames.select(name_key(F.col("name")).alias("key")).distinct(), "key", "left_semi")
    rows = rows.join(pure.groupBy("id").agg(F.collect_set("name").alias("_pure")), "id", "left")
    none = F.array().cast("array<string>")
    value: dict[str, Column] = {c: F.coalesce(f"new_{c}", c) for c in NEWEST}
    dob, dod = value["dob"], value["dod"]
    value["yob"], value["yod"] = F.coalesce(F.year(dob), value["yob"]), F.coalesce(F.year(dod), value["yod"])
    value["age"] = F.coalesce(F.floor(F.months_between(dod, dob) / 12).cast("int"), value["age"])
    names = {c: merged_names(F.col(c), F.col(f"_{c}"), F.coalesce("_pure", none) if c == "firsts" else none, most) for c, most in LISTS.items()}
    better = (F.col("new_place.feed") < SURE_FEED) & (F.col("feed") >= SURE_FEED) & (F.col("feed") != UNSURE_FEED) & F.col("place").isNotNull()
    value["place"] = F.when(F.coalesce(better, F.lit(False)), F.col("place")).otherwise(F.coalesce("new_place.place", "place"))
    wrong = F.array_compact(F.array(*[F.when(F.col(f"off_{c}") == 1, c) for c in TOLD]))
    rows = rows.select("id", *[names[c].alias(c) for c in LISTS], *[value[c].alias(c) for c in (*NEWEST, "place")], "feed", "low", "high", wrong.alias("contradicted"))
    allowed = dates.dob_bounds(F.col("dob"), F.col("yob"), F.col("dod"), F.col("yod"), F.col("age"))
    rows = rows.withColumn("_a", allowed).withColumn("_low", F.greatest("_a.min_dob", "low")).withColumn("_high", F.least("_a.max_dob", "high"))
    apart = F.coalesce(F.col("_low") > F.col("_high"), F.lit(False))
    rows = rows.withColumn("low", F.when(apart, F.col("_a.min_dob")).otherwise(F.col("_low"))).withColumn("high", F.when(apart, F.col("_a.max_dob")).otherwise(F.col("_high")))
    return rows.drop("_a", "_low", "_high")
