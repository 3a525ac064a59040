"""Dates: elapsed years, month rounding, numeric disambiguation, eligibility and schedules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def elapse_360(a: Column, b: Column) -> Column:
    """Years from a to b, months of 30 days; null dates give -99999."""
    years = (F.year(b) - F.year(a)) + (F.month(b) - F.month(a)) / 12 + (F.day(b) - F.day(a)) / 360
    return F.coalesce(years, F.lit(-99999.0))


def _year_days(y: Column) -> Column:
    return F.when(((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0), 366.0).otherwise(365.0)


def elapse_actuarial(a: Column, b: Column) -> Column:
    """Years from a to b: the part of the first year, whole years between, the part of the last; four
    places; negative if b comes first."""

    def place(d: Column) -> Column:
        return F.year(d) + (F.dayofyear(d) - 1) / _year_days(F.year(d))

    return F.round(place(b) - place(a), 4)


def month_round(d: Column, option: int) -> Column:
    """0 as is; 1 first of a month on or after; 2 first after; 3 month end on or after; 4 month end after."""
    first = F.trunc(d, "month")
    after = F.add_months(first, 1)
    return {
        0: d,
        1: F.when(d == first, d).otherwise(after),
        2: after,
        3: F.last_day(d),
        4: F.when(d == F.last_day(d), F.last_day(F.date_add(d, 1))).otherwise(F.last_day(d)),
    }[option]


def numeric_date(a: Column, b: Column, c: Column, as_of: Column) -> Column:
    """(date, conviction) of three numbers: year first, or last after day and month or month and day.
    Years lie between 1890 and as_of's; two digits take the latest year that is not past a month
    after as_of. HIGH: one reading; LIKELY: both orders give the same date; POSSIBLE: day and month
    could be exchanged, and month first is taken."""

    def year(y: Column) -> Column:
        recent = F.year(F.add_months(as_of, 1))
        century = recent - recent % 100
        return F.when(y < 100, F.when(century + y <= recent, century + y).otherwise(century + y - 100)).otherwise(y)

    def made(y: Column, m: Column, d: Column) -> Column:
        y = year(y)
        text = F.format_string("%04d-%02d-%02d", y.cast("int"), m.cast("int"), d.cast("int"))
        date = F.when(m.between(1, 12) & d.between(1, 31), F.try_to_date(text, "yyyy-MM-dd"))
        return F.when((y >= 1890) & (date <= F.add_months(as_of, 1)), date)

    ymd, mdy, dmy = F.when(a > 31, made(a, b, c)), F.when(a <= 31, made(c, a, b)), F.when(a <= 31, made(c, b, a))
    date = F.coalesce(ymd, mdy, dmy)
    sure = F.when(ymd.isNotNull() | mdy.isNull() | dmy.isNull(), "HIGH").when(mdy == dmy, "LIKELY").otherwise("POSSIBLE")
    return F.struct(date.alias("date"), F.when(date.isNotNull(), sure).alias("conviction"))


def date_at_age(birth: Column, age: Column, option: int = 0) -> Column:
    """The date a fractional age is reached: the whole years, and the part of the year that follows, in days rounded;
    then month_round."""
    whole = F.floor(age)
    last = F.add_months(birth, (12 * whole).cast("int"))
    days = F.round((age - whole) * F.datediff(F.add_months(birth, (12 * whole + 12).cast("int")), last)).cast("int")
    return month_round(F.date_add(last, days), option)


def eligibility(birth: Column, hired: Column, age: Column, service: Column, points: Column, latest: bool = False) -> Column:
    """The first (or last) of: reaching an age, a length of service, and age plus service of `points`; 999
    leaves one out."""
    span = F.round((points * 365.25 + F.datediff(birth, F.lit("1900-01-01").cast("date")) + F.datediff(hired, F.lit("1900-01-01").cast("date"))) / 2)
    options = [
        F.when(age < 999, date_at_age(birth, age)),
        F.when(service < 999, date_at_age(hired, service)),
        F.when(points < 999, F.greatest(hired, F.date_add(F.lit("1900-01-01").cast("date"), span.cast("int")))),
    ]
    return F.greatest(*options) if latest else F.least(*options)


def dob_bounds(dob: Column, yob: Column, dod: Column, yod: Column, age: Column) -> Column:
    """(min_dob, max_dob) that birth date, birth year, or death and age allow."""
    first = lambda y: F.make_date(y, F.lit(1), F.lit(1))
    last = lambda y: F.make_date(y, F.lit(12), F.lit(31))
    low = F.coalesce(dob, first(yob), F.date_add(F.add_months(dod, -12 * (age.cast("int") + 1)), 1), first(yod - age - 1))
    high = F.coalesce(dob, last(yob), F.add_months(dod, -12 * age.cast("int")), last(yod - age))
    return F.struct(low.alias("min_dob"), high.alias("max_dob"))


def next_run(last: Column, option: Column, weekday: Column, monthday: Column, mask: Column) -> Column:
    """The next run at 05:00 after a last one. option: 0 disabled, 1 daily, 2 Monday to Friday, 3 weekly,
    4 every two weeks, 5 monthly, 6 the weekdays of a bit mask (bit 0 is Sunday). weekday: 1 Sunday to 7."""
    day = F.to_date(last)
    ahead = lambda n: F.date_add(day, n)
    workday = F.element_at(F.filter(F.sequence(F.lit(1), F.lit(7)), lambda n: F.dayofweek(F.date_add(day, n)).between(2, 6)), 1)
    by_week = F.element_at(F.filter(F.sequence(F.lit(1), F.lit(7)), lambda n: F.dayofweek(F.date_add(day, n)) == weekday), 1)
    by_mask = F.try_element_at(F.filter(F.sequence(F.lit(1), F.lit(7)), lambda n: F.shiftright(mask, 0).bitwiseAND(F.expr("1").cast("int") * F.pow(F.lit(2), F.dayofweek(F.date_add(day, n)) - 1).cast("int")) != 0), F.lit(1))
    month = F.add_months(F.trunc(day, "month"), 1)
    monthly = F.least(F.date_add(month, monthday - 1), F.last_day(month))
    date = (
        F.when(option == 1, ahead(1)).when(option == 2, ahead(workday)).when(option == 3, ahead(by_week))
        .when(option == 4, ahead(by_week + 7)).when(option == 5, monthly).when(option == 6, ahead(by_mask))
    )
    return F.to_timestamp(F.concat(date.cast("string"), F.lit(" 05:00:00")))


def date_pair(a: Column, b: Column, as_of: Column) -> Column:
    """Two dates of three numbers each (arrays day-or-month, month-or-day, year) read in one order, the one that
    both allow; month first if both orders do."""

    def read(x: Column, swapped: bool) -> Column:
        m, d = (F.get(x, F.lit(1)), F.get(x, F.lit(0))) if swapped else (F.get(x, F.lit(0)), F.get(x, F.lit(1)))
        text = F.format_string("%04d-%02d-%02d", F.get(x, F.lit(2)), m, d)
        date = F.when(m.between(1, 12) & d.between(1, 31), F.try_to_date(text, "yyyy-MM-dd"))
        return F.when(date <= as_of, date)

    first, second = (F.struct(read(a, s).alias("first"), read(b, s).alias("second")) for s in (False, True))
    fits = lambda p: p["first"].isNotNull() & p["second"].isNotNull() & (p["first"] <= p["second"])
    return F.when(fits(first), first).when(fits(second), second)


def repaired(birth: Column, death: Column, years: Column) -> Column:
    """(birth, death, age, codes) after checks: dates exchanged if death comes first, the age set from both dates
    if it is off, ages over 130 emptied."""
    swapped = death < birth
    b, d = F.when(swapped, death).otherwise(birth), F.when(swapped, birth).otherwise(death)
    real = F.floor(F.months_between(d, b) / 12).cast("int")
    age = F.when(real.isNotNull(), real).otherwise(F.when(years <= 130, years))
    codes = F.array_compact(F.array(F.when(swapped, F.lit("swapped")), F.when(real != years, F.lit("age")), F.when(years > 130, F.lit("too_old"))))
    return F.struct(b.alias("birth"), d.alias("death"), age.alias("age"), codes.alias("codes"))
