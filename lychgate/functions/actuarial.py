"""Survival, discount and life annuities.

Mortality is a parameter: yearly death rates by age, from a table with columns age and q, or from the law of
Makeham. Point functions are columns; annuities sum over payment dates with numpy in a pandas UDF, for all
rows of a batch by age of entry.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LAST_AGE = 120
ADVANCE = (1, 2, 12, 24, 26, 52)
#: Codes of errors.
ERRORS = {"age": 1, "rates": 2, "frequency": 3, "sex": 4, "basis": 5}


def makeham(a: float = 0.0002, b: float = 0.00003, c: float = 1.1) -> np.ndarray:
    """Death rates by age from 0, the last one 1."""
    x = np.arange(LAST_AGE + 1)
    q = 1 - np.exp(-a - b * (c - 1) / np.log(c) * c**x)
    q[-1] = 1
    return q


def improved_by_year(q: np.ndarray, scale: np.ndarray, base: int, year: int, generational: bool = False) -> np.ndarray:
    """Rates after yearly improvements from a base year to `year` by a scale of (age, year from the base on), whose last
    year stands for later ones; generational: an age is reached a year later than the one before."""
    out = np.array(q, float)
    for x in range(len(q)):
        years = max(0, year + (x if generational else 0) - base)
        known = scale[x, :years]
        out[x] *= np.prod(1 - known) * (1 - scale[x, -1]) ** (years - len(known))
    return np.clip(np.round(out, 6), 0, 1)


def improved(q: np.ndarray, scale: np.ndarray, years: int, generational: bool = False) -> np.ndarray:
    """Rates after `years` of improvement, or one more a year of age lived if generational."""
    n = years + np.arange(len(q)) if generational else years
    return np.clip(np.round(q * (1 - scale) ** n, 6), 0, 1)


def blended(male: np.ndarray, female: np.ndarray, share: float) -> np.ndarray:
    return np.round(share * male + (1 - share) * female, 6)


def vt(t: Column, rates: Column) -> Column:
    """Discount of 1 due in t years, four places. rates: [r1, n1, r2, n2, ..., rk], a rate for so many years
    each, the last one for good; null where the list is even or a rate is outside 0 to 1."""
    pairs = F.sequence(F.lit(0), F.floor((F.size(rates) - 1) / 2).cast("int"))
    start = F.struct(F.lit(0.0).alias("log"), t.cast("double").alias("left"))

    def step(acc: Column, i: Column) -> Column:
        rate = F.get(rates, 2 * i)
        years = F.coalesce(F.get(rates, 2 * i + 1), F.lit(float("inf")))
        now = F.least(acc["left"], years)
        return F.struct((acc["log"] - now * F.log1p(rate)).alias("log"), (acc["left"] - now).alias("left"))

    return F.when(valid_rates(rates), F.round(F.exp(F.aggregate(pairs, start, step)["log"]), 4))


def valid_rates(rates: Column) -> Column:
    odd = F.size(rates) % 2 == 1
    even_places = F.filter(rates, lambda x, i: i % 2 == 0)
    return odd & F.forall(even_places, lambda r: (r >= 0) & (r <= 1))


def drop_elapsed(rates: Column, t: Column) -> Column:
    """The rate list as it stands after t years."""
    n = F.size(rates)
    first = F.coalesce(F.get(rates, F.lit(1)), F.lit(float("inf")))
    later = F.slice(rates, F.lit(3), F.greatest(F.lit(0), n - 2))
    return F.when(n == 1, rates).when(first <= t, later).otherwise(F.concat(F.array(rates[0], first - t), later))


@dataclass(frozen=True)
class Frequency:
    payments: int
    arrears: bool
    compounding: int


def frequency(code: float) -> Frequency | None:
    """1, 2, 12, 24, 26 or 52 payments a year; 100 more for arrears; decimals are the interest's frequency."""
    whole = int(code)
    n, arrears = (whole - 100, True) if whole > 100 else (whole, False)
    return Frequency(n, arrears, round((code - whole) * 100) or 1) if n in ADVANCE else None


def parse_sex(c: Column) -> Column:
    """Share of male rates: M, Male or 1; F, Female or 2; a mix from 0 to 1; null otherwise."""
    n = c.try_cast("double")
    key = F.lower(c)
    return F.when(key.isin("m", "male", "1"), 1.0).when(key.isin("f", "female", "2"), 0.0).when((n >= 0) & (n < 1), n)


_BASIS = re.compile(r"^([CDYJ]?)([A-Z]{2}[0-9]{2}|RP0[BWC]|CPM[CIUB]|LAPP)([0-9]{4})?(G2D|G)?$")


def parse_basis(name: str) -> dict | None:
    """Deferral, table, projection year and kind of a mortality basis' name."""
    m = _BASIS.match(name.upper())
    if not m:
        return None
    kind = {None: "static" if m[3] else "none", "G": "generational", "G2D": "two_dimensional"}[m[4]]
    return {"deferral": m[1] or None, "table": m[2], "year": int(m[3]) if m[3] else None, "projection": kind}


def survivors(q: np.ndarray) -> np.ndarray:
    return np.concatenate([[1.0], np.cumprod(1 - q)])


def tpx(l: np.ndarray, age: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Survival for t years from an age, deaths spread evenly over a year of age; six places."""
    lx = lambda a: np.interp(np.minimum(a, len(l) - 1), np.arange(len(l)), l)
    return np.round(lx(age + t) / np.maximum(lx(age), 1e-300), 6)


def _steps(f: Frequency, years: float) -> np.ndarray:
    """Payments' places, counted in payment periods from the start."""
    if f.arrears:
        return np.arange(1, int(years * f.payments + 0.0005) + 1)
    return np.arange(1 + int(max(0.0, years * f.payments - 0.0001)))


def discounts(rates, t: np.ndarray) -> np.ndarray:
    """Value of 1 due in t years; rates: one, or [r1, n1, r2, n2, ..., rk] as in vt()."""
    rates = np.atleast_1d(np.asarray(rates, float))
    left, log = np.asarray(t, float).copy(), np.zeros(len(t))
    for k in range(0, len(rates), 2):
        now = np.minimum(left, rates[k + 1]) if k + 1 < len(rates) else left
        log -= now * np.log1p(rates[k])
        left = left - now
    return np.exp(log)


def dropped(rates, t: float) -> list[float]:
    """The rate list as it stands after t years."""
    rates = [float(x) for x in np.atleast_1d(np.asarray(rates, float))]
    while len(rates) > 1 and rates[1] <= t:
        t -= rates[1]
        rates = rates[2:]
    return rates if len(rates) == 1 else [rates[0], rates[1] - t, *rates[2:]]


def series(rates, f: Frequency, years: float, stepped: bool = False) -> np.ndarray:
    """Discounts at the payments of so many years. stepped: interest is credited every `compounding` payments only."""
    steps = _steps(f, years)
    return discounts(rates, (steps // f.compounding * f.compounding if stepped else steps) / f.payments)


def vt_series(rates: Column, years: int, payments: int, arrears: bool = False) -> Column:
    """series() as an array column, each to four places."""
    steps = F.sequence(F.lit(int(arrears)), F.lit(years * payments - (not arrears)))
    return F.transform(steps, lambda k: vt(k / payments, rates))


def _sure(f: Frequency, guarantee: float, n: int) -> np.ndarray:
    """1 for payments within the guarantee, which are made in any case."""
    paid = int(f.payments * guarantee + 0.0005) if f.arrears else 1 + int(max(0.0, f.payments * guarantee - 0.0001))
    return (np.arange(n) < paid).astype(float)


def _values(paid: np.ndarray, f: Frequency, years: np.ndarray, rates, cola, deferral: float, alive: np.ndarray) -> np.ndarray:
    """Rows of payments, each for its own years, discounted, raised by cola, deferred; four places."""
    longest = float(years.max())
    worth = series(dropped(rates, deferral), f, longest) / series(dropped(cola, deferral), f, longest, stepped=True)
    made = np.array([len(_steps(f, y)) for y in years])
    wait = np.array([deferral])
    start = discounts(rates, wait)[0] / discounts(cola, wait)[0] * alive
    return np.round(np.where(np.arange(paid.shape[1]) < made[:, None], paid * worth, 0.0).sum(axis=1) / f.payments * start, 4)


#: Rows of payments that are valued together.
TOGETHER = 256


def annuities(l: np.ndarray, ages: np.ndarray, i, f: Frequency, guarantee: float = 0.0, cola=0.0, deferral: float = 0.0, mortal: bool = True) -> np.ndarray:
    """Values of 1 a year for life at ages, payments within the guarantee certain; four places. i and cola are rates or lists of
    rates and years. mortal: the deferral has to be survived."""
    ages = np.asarray(ages, float)
    if len(ages) > TOGETHER:
        return np.concatenate([annuities(l, ages[k : k + TOGETHER], i, f, guarantee, cola, deferral, mortal) for k in range(0, len(ages), TOGETHER)])
    years = LAST_AGE - ages - deferral + 1
    t = _steps(f, float(years.max())) / f.payments
    x = tpx(l, (ages + deferral)[:, None], t[None, :])
    alive = tpx(l, ages, np.full(len(ages), deferral)) if mortal else np.ones(len(ages))
    return _values(np.maximum(x, _sure(f, guarantee, len(t))), f, years, i, cola, deferral, alive)


def annuity(l: np.ndarray, age: float, i, f: Frequency, guarantee: float = 0.0, cola=0.0, deferral: float = 0.0, mortal: bool = True) -> float:
    """annuities() at one age."""
    return float(annuities(l, np.array([age]), i, f, guarantee, cola, deferral, mortal)[0])


def joints(
    l1: np.ndarray, l2: np.ndarray, ages1: np.ndarray, ages2: np.ndarray, i, f: Frequency, share: float, option: int, guarantee: float = 0.0, cola=0.0, deferral: float = 0.0, mortal: bool = True
) -> np.ndarray:
    """Values of 1 a year on two lives, of which the part `share` remains after a death; four places. Option 1: after the first
    life's death, 2: after the second's, 3: after either's. The guarantee is on the life or lives whose death reduces
    payments; options 4, 5 and 6 pay like 1, 2 and 3, with the guarantee on the reduced part instead."""
    if option not in range(1, 7) or not 0 <= share <= 5 or guarantee < 0:
        raise ValueError("option, share or guarantee out of range")
    ages = [np.asarray(a, float) for a in (ages1, ages2)]
    if len(ages[0]) > TOGETHER:
        parts = [slice(k, k + TOGETHER) for k in range(0, len(ages[0]), TOGETHER)]
        return np.concatenate([joints(l1, l2, ages[0][p], ages[1][p], i, f, share, option, guarantee, cola, deferral, mortal) for p in parts])
    years = LAST_AGE - np.minimum(*ages) - deferral + 1
    t = _steps(f, float(years.max())) / f.payments
    x, y = (tpx(l, (a + deferral)[:, None], t[None, :]) for l, a in zip((l1, l2), ages))
    sure = _sure(f, guarantee, len(t))
    if option in (2, 5):
        x, y = y, x
    full = x * y if option in (3, 6) else x  # all is paid while both live, or while the first does
    either = x + y - x * y
    if option <= 3:
        paid = np.maximum(sure, full + share * (either - full))
    elif option == 6:
        paid = full + share * (np.maximum(sure, either) - full)
    else:
        kept = np.maximum(sure, y)
        paid = x + share * (kept - x * kept)
    wait = np.full(len(ages[0]), deferral)
    alive = tpx(l1, ages[0], wait) * tpx(l2, ages[1], wait) if mortal else np.ones(len(wait))
    return _values(paid, f, years, i, cola, deferral, alive)


def joint(l1: np.ndarray, l2: np.ndarray, age1: float, age2: float, i, f: Frequency, share: float, option: int, guarantee: float = 0.0, cola=0.0, deferral: float = 0.0, mortal: bool = True) -> float:
    """joints() of one pair of ages."""
    return float(joints(l1, l2, np.array([age1]), np.array([age2]), i, f, share, option, guarantee, cola, deferral, mortal)[0])


def _told(value):
    """A value that can be compared: a list as a tuple, a missing one as None."""
    if isinstance(value, (list, tuple, np.ndarray)):
        return tuple(map(float, value))
    return None if value is None or value != value else float(value)


def _in_groups(make, ages: list[pd.Series], *args: pd.Series) -> pd.Series:
    """make(frequency, columns of ages, *arguments) once for all rows of equal arguments, each pair of ages once; null where an argument is missing
    or make raises ValueError. The first argument is the code of the frequency."""
    out = np.full(len(ages[0]), np.nan)
    groups: dict[tuple, list[int]] = {}
    for k, row in enumerate(zip(*args)):
        groups.setdefault(tuple(map(_told, row)), []).append(k)
    for key, rows in groups.items():
        f = None if None in key else frequency(key[0])
        if f is None:
            continue
        own, back = np.unique(np.column_stack([a.to_numpy(float)[rows] for a in ages]), axis=0, return_inverse=True)
        fine = np.isfinite(own).all(axis=1)
        values = np.full(len(own), np.nan)
        try:
            if fine.any():
                values[fine] = make(f, own[fine], *key[1:])
        except ValueError:
            continue
        out[rows] = values[back.ravel()]
    return pd.Series(out)


def functions(q: np.ndarray):
    """tPx, LIFE and JOINT over a table of death rates, as pandas UDFs; errors give null. Rates and cola are lists."""
    l = survivors(q)

    @F.pandas_udf("double")
    def tpx_(age: pd.Series, t: pd.Series) -> pd.Series:
        ok = age.between(0, LAST_AGE) & (t >= 0)
        return pd.Series(tpx(l, age.clip(0, LAST_AGE).to_numpy(float), t.clip(0).to_numpy(float))).where(ok)

    @F.pandas_udf("double")
    def life_(age: pd.Series, rates: pd.Series, freq: pd.Series, guarantee: pd.Series, cola: pd.Series, deferral: pd.Series) -> pd.Series:
        def one(f, own, r, g, c, d):
            values, ok = np.full(len(own), np.nan), (own[:, 0] >= 0) & (own[:, 0] + d <= LAST_AGE)
            if ok.any():
                values[ok] = annuities(l, own[ok, 0], r, f, g, c, d)
            return values

        return _in_groups(one, [age], freq, rates, guarantee, cola, deferral)

    @F.pandas_udf("double")
    def joint_(age1: pd.Series, age2: pd.Series, rates: pd.Series, freq: pd.Series, share: pd.Series, option: pd.Series, guarantee: pd.Series) -> pd.Series:
        one = lambda f, own, r, s, o, g: joints(l, l, own[:, 0], own[:, 1], r, f, s, int(o), g)
        return _in_groups(one, [age1, age2], freq, rates, share, option, guarantee)

    return tpx_, life_, joint_


def valued(rows: DataFrame, f, args: list[Column], name: str) -> DataFrame:
    """rows with f(*args) as `name`, made once for each distinct row of arguments and spread over all tasks, however few hold the rows."""
    keys = [f"_{name}_{k}" for k in range(len(args))]
    own = rows.select("*", *[a.alias(k) for a, k in zip(args, keys)])
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    once = own.select(*keys).distinct().repartition(parts, *keys).withColumn(name, f(*keys)).select(*[F.col(k).alias(f"{k}_") for k in keys], name)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys])
    return own.join(once, same, "left").select(*rows.columns, name)


#: SQL functions without Python: elapse of two dates, vt of a time and a rate list, eligdate of a date and years from it.
_SQL = (
    """elapse(a DATE, b DATE) RETURNS DOUBLE RETURN round(
         year(b) + (dayofyear(b) - 1) / dayofyear(make_date(year(b), 12, 31)) - year(a) - (dayofyear(a) - 1) / dayofyear(make_date(year(a), 12, 31)), 4)""",
    """vt(t DOUBLE, rates ARRAY<DOUBLE>) RETURNS DOUBLE RETURN CASE WHEN size(rates) % 2 = 1 AND forall(filter(rates, (x, i) -> i % 2 = 0), r -> r BETWEEN 0 AND 1) THEN round(exp(aggregate(
         sequence(0, cast((size(rates) - 1) / 2 AS int)), named_struct('log', 0D, 'left', t), (acc, i) -> named_struct(
         'log', acc.log - least(acc.left, coalesce(get(rates, 2 * i + 1), double('infinity'))) * log1p(get(rates, 2 * i)),
         'left', acc.left - least(acc.left, coalesce(get(rates, 2 * i + 1), double('infinity')))), acc -> acc.log)), 4) END""",
    "eligdate(d DATE, years DOUBLE) RETURNS DATE RETURN date_add(add_months(d, 12 * int(floor(years))), cast(round((years - floor(years)) * datediff(add_months(d, 12 * int(floor(years)) + 12), add_months(d, 12 * int(floor(years))))) AS int))",
)


def register(spark, q: np.ndarray | None = None) -> None:
    """SQL names tpx, life and joint for a mortality table (Makeham's by default), and elapse, vt and eligdate."""
    for name, f in zip(("tpx", "life", "joint"), functions(makeham() if q is None else q)):
        spark.udf.register(name, f)
    for text in _SQL:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {text}")


def error_code(age: Column, freq: Column, rates: Column) -> Column:
    """The first of ERRORS that the inputs have, 0 if none."""
    whole = F.floor(freq)
    n = F.when(whole > 100, whole - 100).otherwise(whole)
    return (
        F.when(~age.between(0, LAST_AGE) | age.isNull(), ERRORS["age"]).when(~valid_rates(rates), ERRORS["rates"])
        .when(~n.isin(*ADVANCE), ERRORS["frequency"]).otherwise(0)
    )
