"""Addresses made from templates, and addresses in one form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOLE = "%p%"
#: How a date may be written in an address.
MASKS = ("yyyyMM", "MM-yyyy", "dd/MM/yyyy", "MM/dd/yyyy", "yyyy-MM-dd", "yyyy", "MM", "dd", "M", "d", "MMMM")
_EPOCH = 2_440_588  # Julian day of 1970-01-01


def dated(day: Column, mask: str) -> Column:
    """A date as a parameter by one of MASKS."""
    if mask not in MASKS:
        raise ValueError(f"no such mask: {mask}")
    return F.date_format(day, mask)


def julian(day: Column) -> Column:
    """The date of a Julian day number."""
    return F.date_add(F.lit("1970-01-01").cast("date"), (day - _EPOCH).cast("int"))


def filled(template: Column, *parameters: Column) -> Column:
    """A template with its holes filled in turn. Null and empty parameters are passed over, holes without a parameter
    stay, and a hole inside a parameter is not one."""
    pieces = F.split(template, HOLE, -1)
    given = F.filter(F.array(*[p.cast("string") for p in parameters]), lambda p: F.length(p) > 0)
    holes = F.size(pieces) - 1
    before = F.zip_with(F.slice(pieces, 1, holes), F.slice(given, 1, F.least(holes, F.size(given))), lambda a, p: F.concat(a, F.coalesce(p, F.lit(HOLE))))
    return F.concat(F.array_join(before, ""), F.element_at(pieces, -1))


def address(url: Column, scheme: str = "http:", host: str = "www.") -> Column:
    """An address with a scheme, and with `host` where www. is or is missing; null if it has // twice, or the scheme
    elsewhere than at its beginning."""
    mark = "//"
    rest = F.when(F.contains(url, F.lit(mark)), F.substring_index(url, mark, -1)).otherwise(url)
    head = F.when(F.contains(url, F.lit(mark)), F.substring_index(url, mark, 1)).otherwise(F.lit(""))
    bare = F.regexp_replace(rest, r"^www\.", "")
    twice = F.size(F.split(url, mark, -1)) > 2
    inside = F.locate(scheme, url) > 1
    return F.when(~twice & ~inside, F.concat(F.when(F.length(head) > 0, head).otherwise(F.lit(scheme)), F.lit(mark + host), bare))
