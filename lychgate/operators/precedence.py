"""New dates against those a record has: taken, turned into a range, or refused, with a code that tells which.

Dates of a record are a struct: dob, low, high (bounds of the birth), yob, dod, flag. Nulls are unknown; yob 0 is more than
one year. Flags: 0 nothing to tell, 3 another death, 6 a birth that widened the range, 12 another birth.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIELDS = ("dob", "low", "high", "yob", "dod", "flag")
WIDEST = 366
EARLIEST = "1900-01-01"


def dates(dob: Column, low: Column, high: Column, yob: Column, dod: Column) -> Column:
    """A record's dates, without a flag yet."""
    return F.struct(dob.cast("date").alias("dob"), low.cast("date").alias("low"), high.cast("date").alias("high"), yob.cast("int").alias("yob"), dod.cast("date").alias("dod"), F.lit(0).alias("flag"))


def _with(record: Column, **changes: Column) -> Column:
    return F.struct(*[changes.get(f, record[f]).alias(f) for f in FIELDS])


def _born(record: Column, day: Column) -> Column:
    return _with(record, dob=day, low=day, high=day, yob=F.year(day))


def _wider(record: Column, low: Column, high: Column) -> Column:
    return _with(record, low=low, high=high, yob=F.when(F.year(low) == F.year(high), F.year(low)).otherwise(0), flag=F.lit(6))


def _true(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def set_birth(record: Column, day: Column, as_of: Column, override: bool = False, next_age: bool = False) -> Column:
    """The record with a birth. Days before EARLIEST or after as_of change nothing. Without a day so far, one outside the bounds
    by a year at most widens them, or is taken if the age was that of the next birthday (next_age) and the year agrees. Another
    day than the one known replaces it where that was the death's day and the new one is earlier; else it is refused."""
    fine = _true((day <= as_of) & (day > F.lit(EARLIEST).cast("date")))
    other = _true(record["dob"] != day)
    above, below = _true(record["dob"].isNull() & (day > record["high"])), _true(record["dob"].isNull() & (day < record["low"]))
    far = F.when(above, F.datediff(day, record["high"])).when(below, F.datediff(record["low"], day)).otherwise(0)
    edge = F.when(above, record["high"]).otherwise(record["low"])
    agrees = F.lit(next_age) & ((F.coalesce(record["yob"], F.lit(0)) == 0) | (F.year(edge) == F.year(day)))
    return (
        F.when(~fine, record)
        .when(F.lit(override) | ~(other | above | below), _born(record, day))
        .when((above | below) & (far > WIDEST), record)
        .when((above | below) & agrees, _born(record, day))
        .when(above, _wider(record, F.coalesce(record["low"], day), day))
        .when(below, _wider(record, day, F.coalesce(record["high"], day)))
        .when(_true((record["dob"] == record["dod"]) & (day < record["dod"])), _born(record, day))
        .otherwise(_with(record, flag=F.lit(12)))
    )


def set_death(record: Column, day: Column, as_of: Column, stale_years: int = 25) -> Column:
    """The record with a death. Another day than the one known is refused, but where that one is more than `stale_years`
    back; both are told by flag 3, and so is a missing day."""
    other = _true(record["dod"] != day)
    stale = _true((F.year(record["dod"]) < F.year(as_of) - stale_years) & (day < as_of))
    flag = F.when(other, 3).otherwise(record["flag"])
    return F.when(day.isNull(), _with(record, flag=F.lit(3))).when(~other | stale, _with(record, dod=day, flag=flag)).otherwise(_with(record, flag=F.lit(3)))
