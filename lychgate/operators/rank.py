"""Ranking of monitored persons against the master table, by added points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lychgate.functions import geo
from lychgate.functions.names import hyphen_parts, name_key, similarity
from lychgate.operators.linkage import with_variations
from lychgate.operators.ranges import interval_join
from lychgate.sources.scratch import written

ERROR_DAYS = ((0, 1000), (31, 500), (366, 250), (1000, 100))


def dob_points(a: Column, b: Column) -> Column:
    """+1000 for equal dates; 0 if day and month are exchanged or two of three parts agree, else -500;
    0 if one is missing."""
    same = lambda part: (part(a) == part(b)).cast("int")
    parts = same(F.year) + same(F.month) + same(F.day)
    swapped = (F.year(a) == F.year(b)) & (F.month(a) == F.day(b)) & (F.day(a) == F.month(b))
    return F.when(a.isNull() | b.isNull(), 0).when(a == b, 1000).when(swapped | (parts >= 2), 0).otherwise(-500)


def bound_points(dob: Column, low: Column, high: Column) -> Column:
    """Points of a known date against bounds: on a bound 500, a year off one 250; else by days outside."""
    on = (dob == low).cast("int") * 500 + (dob == high).cast("int") * 500
    off = (dob == F.add_months(low, -12)).cast("int") * 250 + (dob == F.add_months(high, 12)).cast("int") * 250
    outside = F.greatest(F.lit(0), F.datediff(low, dob), F.datediff(dob, high))
    near = F.when(F.lit(False), 0)
    for days, points in ERROR_DAYS:
        near = near.when(outside <= days, points)
    total = F.coalesce(on + off, F.lit(0))
    return F.when(total >= 1000, total).otherwise(F.greatest(total, F.coalesce(near.otherwise(0), F.lit(0))))


def gender_points(a: Column, b: Column) -> Column:
    return F.when(a.isNull() | b.isNull(), 0).when(a == b, 100).otherwise(-50)


def first_points(a: Column, b: Column, a_wide: Column, b_wide: Column) -> Column:
    """750 by similarity of the lists, else three quarters of that by their known variants."""
    own = similarity(a, b)
    return F.when(own > 0, 750 * own).otherwise(750 * 0.75 * similarity(a_wide, b_wide))


def middle_points(a: Column, b: Column) -> Column:
    return 375 * similarity(a, b, multiple=True)


def spouse_points(a_wide: Column, b_wide: Column) -> Column:
    return 375 * similarity(a_wide, b_wide)


def retry_reversed(best: Column, known_dob: Column, last_is_given: Column, first_is_surname: Column) -> Column:
    """Whether to rank again with names exchanged; the result counts from 2000 points on."""
    return (best < 1750) & known_dob & last_is_given & first_is_surname


def range_points(dob: Column, low: Column, high: Column) -> Column:
    """Points of a known date against a stored range: 500 for each end that it is; below 1000 also points by the days that the range
    is wide and the date outside of it."""
    on = F.coalesce((dob == low).cast("int") * 500, F.lit(0)) + F.coalesce((dob == high).cast("int") * 500, F.lit(0))
    off = F.datediff(high, low) + F.greatest(F.lit(0), F.datediff(low, dob), F.datediff(dob, high))
    near = F.lit(0)
    for days, points in reversed(ERROR_DAYS):
        near = F.when(off <= days, points).otherwise(near)
    return F.when(on < 1000, on + F.when(dob.isNotNull() & off.isNotNull(), near).otherwise(0)).otherwise(on)


def year_around(dob: Column, today: Column) -> tuple[Column, Column]:
    """A year before a date of birth and a year after it, the 29th of February as the 28th and the 1st of March; all dates from 1875 if
    it is not known."""
    leap = (F.month(dob) == 2) & (F.dayofmonth(dob) == 29)
    after = F.date_add(F.add_months(dob, 12), leap.cast("int"))
    return F.coalesce(F.add_months(dob, -12), F.lit("1875-01-01").cast("date")), F.coalesce(after, today)


def _given_points(p: str, q: str, compat: bool) -> Column:
    """First names; where they give nothing, the person's against the middle names of the stored one (compat: the person's own)."""
    own = similarity(F.col(f"{p}.firsts"), F.col(f"{q}.firsts"))
    wide = 0.75 * similarity(F.col(f"{p}.wide"), F.col(f"{q}.wide"))
    points = F.floor(750 * F.when(own < 1, wide).otherwise(own))
    return F.when(points > 0, points).otherwise(F.floor(750 * 0.33 * similarity(F.col(f"{p}.wide"), F.col(f"{p if compat else q}.middles"))))


def all_points(p: str = "p", q: str = "q", compat: bool = False) -> Column:
    """Points of a monitored person (struct p) against a stored one (q): birth, gender, first, middle and spouse's names, place."""
    dob, stored = F.col(f"{p}.dob"), F.col(f"{q}.dob")
    born = F.when(dob.isNotNull() & stored.isNull(), range_points(dob, F.col(f"{q}.low"), F.col(f"{q}.high"))).otherwise(dob_points(dob, stored))
    km = geo.haversine(F.col(f"{p}.lat"), F.col(f"{p}.lon"), F.col(f"{q}.lat"), F.col(f"{q}.lon"))
    same = F.coalesce(F.col(f"{p}.province") == F.col(f"{q}.province"), F.lit(False))
    near = geo.proximity_points(km, same, F.col(f"{p}.province").isin(*NORTHERN))
    middle = 375 * similarity(F.col(f"{p}.middles"), F.col(f"{q}.middles"), multiple=True)
    spouse = F.floor(375 * similarity(F.col(f"{p}.spouses"), F.col(f"{q}.spouses")))
    return (born + gender_points(F.col(f"{p}.gender"), F.col(f"{q}.gender")) + _given_points(p, q, compat) + middle.cast("int") + spouse + near).cast("long")


#: Provinces whose places lie far apart; the best of a record from which names are not exchanged, and what exchanged names need.
NORTHERN = ("YT", "NU", "NT")
MARGINAL, CONVINCING = 1750, 2000


def _expanded(persons: DataFrame, first_names: DataFrame, nicknames: DataFrame) -> DataFrame:
    """persons with parts of hyphenated names, and with first names (wide) and spouse's (spouses) in all their versions."""
    rows = persons.withColumn("firsts", hyphen_parts("firsts", 8)).withColumn("_spouse", F.filter(F.array("spouse"), lambda x: F.length(x) > 0))
    rows = with_variations(rows, "firsts", first_names, nicknames, "wide")
    return with_variations(rows, "_spouse", first_names, nicknames, "spouses").drop("_spouse")


def _ranked(persons: DataFrame, stored: DataFrame, today: Column, compat: bool) -> DataFrame:
    """(rec_id, cand_id, points) of the stored persons of equal last names who may be born within a year."""
    after, before = year_around(F.col("dob"), today)
    p = persons.select(name_key(F.col("last")).alias("key"), after.alias("_after"), before.alias("_before"), F.struct("*").alias("p"))
    q = stored.select(name_key(F.col("last")).alias("key"), F.coalesce("low", "dob").alias("_low"), F.coalesce("high", "dob").alias("_high"), F.struct("*").alias("q"))
    met = interval_join(p, q, ["key"], ("_after", "_before"), ("_low", "_high"))
    return met.select(F.col("p.id").alias("rec_id"), F.col("q.id").alias("cand_id"), all_points("p", "q", compat).alias("points"))


def ranked(
    persons: DataFrame, stored: DataFrame, today: Column, first_names: DataFrame, nicknames: DataFrame, given: DataFrame, surnames: DataFrame, most: int = 3, compat: bool = False
) -> DataFrame:
    """(rec_id, cand_id, points, exchanged): the `most` best stored persons of each monitored one, by points, then by id.

    persons and stored: id, last, firsts, middles, spouse, gender, dob, lat, lon, province, and of the stored ones low and high, the range
    of the birth. first_names (name, alt_names) and nicknames (nickname, formal_names) give versions of names; given and
    surnames (name) tell kinds. Persons of a known birth whose best has fewer than 1750 points, whose last name is a given one and
    whose first name a surname, are ranked once more with the two exchanged, and that counts from 2000 points on."""
    p, q = (written(_expanded(x, first_names, nicknames), n) for x, n in ((persons, "persons"), (stored, "stored")))
    first = written(_ranked(p, q, today, compat), "ranked")
    best = first.groupBy(F.col("rec_id").alias("id")).agg(F.max("points").alias("best"))
    known = lambda names: names.select(name_key(F.col("name")).alias("_name")).distinct()
    marginal = p.where("dob is not null and size(firsts) > 0").join(best, "id", "left").where(F.coalesce("best", F.lit(0)) < MARGINAL).drop("best")
    marginal = marginal.withColumn("_name", name_key(F.col("last"))).join(known(given), "_name", "left_semi")
    marginal = marginal.withColumn("_name", name_key(F.col("firsts")[0])).join(known(surnames), "_name", "left_semi").drop("_name")
    turned = marginal.withColumn("_first", F.col("firsts")[0]).withColumn("firsts", F.array("last")).withColumn("last", F.col("_first")).drop("_first", "wide")
    second = _ranked(with_variations(turned, "firsts", first_names, nicknames, "wide").select(p.columns), q, today, compat)
    w = Window.partitionBy("rec_id")
    second = written(second.withColumn("_best", F.max("points").over(w)).where(F.col("_best") >= CONVINCING).drop("_best"), "exchanged")
    every = first.join(second.select("rec_id").distinct(), "rec_id", "left_anti").select("*", F.lit(False).alias("exchanged"))
    every = every.union(second.select("rec_id", "cand_id", "points", F.lit(True)))
    order = w.orderBy(F.desc("points"), "cand_id")
    return every.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= most).drop("_n")
