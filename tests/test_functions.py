"""Edge cases of functions and operators on small rows."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lychgate.functions import actuarial as A
from lychgate.functions import dates, geo, names, text
from lychgate.operators import asof, extract, linkage, lookup, maintain, rank


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first()


def D(s):
    return F.lit(s).cast("date")


def L(*values):
    return F.array(*[F.lit(v) for v in values])


def test_month_rounding(spark):
    r = one(spark, **{f"e{i}": dates.month_round(D("2020-01-31"), i) for i in range(5)}, **{f"f{i}": dates.month_round(D("2020-02-01"), i) for i in range(5)})
    assert [r[f"e{i}"].isoformat() for i in range(5)] == ["2020-01-31", "2020-02-01", "2020-02-01", "2020-01-31", "2020-02-29"]
    assert [r[f"f{i}"].isoformat() for i in range(5)] == ["2020-02-01", "2020-02-01", "2020-03-01", "2020-02-29", "2020-02-29"]


def test_numeric_dates(spark):
    now = D("2021-06-30")
    n = lambda a, b, c: dates.numeric_date(F.lit(a), F.lit(b), F.lit(c), now)
    r = one(spark, bad=n(2020, 13, 1), two=n(5, 6, 2020), day=n(25, 12, 2020), month=n(12, 25, 2020), short=n(3, 4, 21), old=n(3, 4, 85))
    assert r["bad"]["date"] is None and r["bad"]["conviction"] is None
    assert (r["two"]["date"], r["two"]["conviction"]) == (dt.date(2020, 5, 6), "POSSIBLE")
    assert r["day"]["date"] == r["month"]["date"] == dt.date(2020, 12, 25) and r["day"]["conviction"] == "HIGH"
    assert r["short"]["date"] == dt.date(2021, 3, 4) and r["old"]["date"] == dt.date(1985, 3, 4)


def test_elapsed(spark):
    r = one(spark, a=dates.elapse_actuarial(D("2019-07-01"), D("2021-01-01")), b=dates.elapse_actuarial(D("2021-01-01"), D("2019-07-01")), n=dates.elapse_360(F.lit(None).cast("date"), D("2020-01-01")))
    assert r["a"] == -r["b"] == 1.5041 and r["n"] == -99999


def test_schedule(spark):
    run = lambda o, w=2, m=31, mask=0: dates.next_run(F.lit("2024-12-06 09:00:00").cast("timestamp"), F.lit(o), F.lit(w), F.lit(m), F.lit(mask))
    r = one(spark, off=run(0), daily=run(1), work=run(2), week=run(3), two=run(4), month=run(5), mask=run(6, mask=1), none=run(6, mask=0))
    days = {k: v and v.strftime("%m-%d %H") for k, v in r.asDict().items()}
    assert days == {"off": None, "daily": "12-07 05", "work": "12-09 05", "week": "12-09 05", "two": "12-16 05", "month": "01-31 05", "mask": "12-08 05", "none": None}


def test_names(spark):
    r = one(
        spark, s=names.similarity(L("Ann", "B"), L("ann", "Bea")), m=names.similarity(L("Ann", "B"), L("ann", "Bea"), multiple=True), short=names.similarity(L("Ann", "Cy"), L("ann", "Bea"), multiple=True),
        h=names.hyphen_parts(L("Côté-Roy", "cote", "X")), f=names.formal_first(L("Al", "Alan", "Al"), L("Al")), low=names.credibility(F.lit(3), F.lit(1)), five=names.credibility(F.lit(5), F.lit(0)),
        top=names.credibility(F.lit(100), F.lit(0)), zero=names.credibility(F.lit(0), F.lit(0)), u=names.unaccent(F.lit("Œuvre Straße É")),
    )
    assert (r["s"], r["m"], r["short"]) == (1.0, 1.5, -2.0)
    assert r["h"] == ["Côté-Roy", "Côté", "Roy", "X"] and r["f"] == ["Alan", "Al"]
    assert (r["low"], r["five"], r["top"], r["zero"], r["u"]) == ("low", "high", "veryHigh", "zero", "OEuvre Strasse E")


def test_geo(spark):
    r = one(spark, km=geo.haversine(F.lit(0.1), F.lit(0.1), F.lit(0.1), F.lit(1.1)), no=geo.haversine(F.lit(0.0), F.lit(1.0), F.lit(1.0), F.lit(1.0)), null=geo.haversine(F.lit(None).cast("double"), F.lit(1.0), F.lit(1.0), F.lit(1.0)),
            right=geo.province_of_code(F.lit("K1A 0B1")), coded=geo.province_of_code(F.lit("K1A 0B1"), compat=True), west=geo.province_of_code(F.lit("V5K"), compat=True))
    assert r["km"] == pytest.approx(111.19, abs=0.01) and r["no"] == r["null"] == geo.UNKNOWN_KM
    assert (r["right"], r["coded"], r["west"]) == ("ON", "QC", "BC")


def test_text(spark):
    r = one(
        spark, p=text.proper(F.lit("JOHN o'brien-McKAY mcdonald")), n=text.as_number(F.lit("-$1,250.5")), z=text.as_number(F.lit("abc")), pc=text.as_number(F.lit("12 %")),
        s=text.sentences(F.lit("Mr. J. Doe died. He was 80!  Rest.")), u=text.unescape(F.lit("&lt;a&gt; &amp;lt;")), url=text.url_parameter(F.lit("http://example.org/?a=1&id=2&id=3#x"), "id"),
    )
    assert r["p"] == "John O'Brien-McKay McDonald" and (r["n"], r["z"], r["pc"]) == (-1250.5, 0.0, 0.12)
    assert r["s"] == ["Mr. J. Doe died.", "He was 80!", "Rest."] and r["u"] == "<a> &lt;" and r["url"] == "3"


def test_evidence(spark):
    t = F.lit("Il est né le 1er mars 1931. She died on 7 April 2001, 70, after her 50th wedding anniversary.")
    r = one(spark, b=extract.date_near(t, extract.BORN), d=extract.date_near(t, extract.DIED), a=extract.age(t), baby=extract.age(F.lit("lived 3 weeks old")), none=extract.age(F.lit("nothing")),
            y=extract.year_pair(F.lit("(1910 - 1999)")), n=extract.name_parts(F.lit("Dr. Jean De La Cruz Jr.")), empty=extract.date_near(F.lit(None).cast("string"), extract.BORN), v=extract.valid_record(D("1950-01-01"), D("1940-01-01"), F.lit(5)))
    assert r["b"] == dt.date(1931, 3, 1) and r["d"] == dt.date(2001, 4, 7) and (r["a"], r["baby"], r["none"]) == (70, 0, None)
    assert tuple(r["y"]) == (1910, 1999) and tuple(r["n"]) == ("De La Cruz", "Jean", "") and r["empty"] is None and "death_before_birth" in r["v"]


def test_weights(spark):
    df = spark.createDataFrame([(n, [f"v{i}" for i in range(n)]) for n in (1, 2, 3, 4, 6)], "id int, names array<string>")
    got = {}
    for r in linkage.variant_rows(df, "names").orderBy("id", "position").collect():
        got.setdefault(r["id"], []).append(r["weight"])
    assert got == {1: [1.0], 2: [0.5, 0.5], 3: [0.33, 0.33, 0.34], 4: [0.25] * 4, 6: [0.25] * 4}


def test_ranks(spark):
    r = one(spark, eq=rank.dob_points(D("1950-03-04"), D("1950-03-04")), swap=rank.dob_points(D("1950-03-04"), D("1950-04-03")), two=rank.dob_points(D("1950-03-04"), D("1951-03-04")), bad=rank.dob_points(D("1950-03-04"), D("1961-07-09")),
            no=rank.dob_points(F.lit(None).cast("date"), D("1961-07-09")), bound=rank.bound_points(D("1950-01-01"), D("1950-01-01"), D("1950-12-31")))
    assert (r["eq"], r["swap"], r["two"], r["bad"], r["no"], r["bound"]) == (1000, 0, 0, -500, 0, 1000)


def test_greatest_and_lists(spark):
    r = one(spark, g=lookup.unless_missing(F.lit(1), F.lit(None).cast("int")), h=lookup.unless_missing(F.lit(1), F.lit(3)), e=lookup.all_of(F.array().cast("array<int>"), lambda x: x > 0))
    assert (r["g"], r["h"], r["e"]) == (None, 3, False)


def test_asof_without_match(spark):
    left = spark.createDataFrame([(1, "a", dt.date(2020, 1, 5)), (2, "b", dt.date(2020, 1, 5)), (3, "a", dt.date(2019, 1, 1))], "row_id long, k string, at date")
    right = spark.createDataFrame([("a", dt.date(2020, 1, 5), 7), ("a", dt.date(2020, 1, 5), 9), ("a", dt.date(2020, 1, 6), 1)], "k string, seen date, id long")
    got = {r["row_id"]: r["id"] for r in asof.latest_before(left, right, "k", "at", "seen", "id").collect()}
    assert got == {1: 9, 2: None, 3: None}


def test_inactivity(spark):
    days = spark.createDataFrame([("a", dt.date(2020, 1, 1) + dt.timedelta(3 * i)) for i in range(5)] + [("b", dt.date(2020, 1, 1)), ("c", dt.date(2010, 1, 1)), ("d", dt.date(2030, 1, 1))], "f string, day date")
    got = {r["f"]: (r["mean_gap"], r["quiet"], r["alert"]) for r in maintain.inactivity(days, "f", D("2020-01-25")).collect()}
    assert got == {"a": (2, 9, True), "b": (0, 21, True)}


def test_numbered(spark):
    got = maintain.numbered(spark.range(100).select((F.col("id") * 7 % 101).alias("k")), "k", "n", 5).orderBy("k").collect()
    assert [r["n"] for r in got] == list(range(5, 105))


def test_actuarial():
    q = A.makeham()
    l = A.survivors(q)
    assert A.tpx(l, np.array([60.0]), np.array([0.0]))[0] == 1
    assert A.tpx(l, np.array([60.0]), np.array([0.5]))[0] == pytest.approx(1 - q[60] / 2, abs=1e-6)
    monthly, arrears = A.annuity(l, 65, 0.04, A.frequency(12)), A.annuity(l, 65, 0.04, A.frequency(112))
    assert monthly - arrears == pytest.approx(1 / 12, abs=1e-3) and A.annuity(l, 65, 0.04, A.frequency(12), guarantee=10) > monthly
    pays = lambda option, share, **more: A.joint(l, l, 65, 60, 0.04, A.frequency(12), share, option, **more)
    first, second = A.annuity(l, 65, 0.04, A.frequency(12)), A.annuity(l, 60, 0.04, A.frequency(12))
    assert pays(1, 0.0) == pytest.approx(first, abs=1e-3) and pays(2, 0.0) == pytest.approx(second, abs=1e-3)
    assert pays(3, 0.0) + pays(3, 1.0) == pytest.approx(first + second, abs=1e-3)  # both alive, and either
    assert all(pays(o, 0.6) == pytest.approx(pays(o + 3, 0.6), abs=1e-3) for o in (1, 2, 3))  # without a guarantee
    assert pays(1, 0.6, guarantee=10) > pays(4, 0.6, guarantee=10) > pays(4, 0.6)
    assert A.annuity(l, 50, [0.05, 10, 0.03], A.frequency(1), deferral=15.0) == pytest.approx(
        A.discounts([0.05, 10, 0.03], np.array([15.0]))[0] * A.tpx(l, np.array([50.0]), np.array([15.0]))[0] * A.annuity(l, 65, 0.03, A.frequency(1)), abs=1e-3
    )
    assert A.annuity(l, 65, 0.04, A.frequency(12.12), cola=0.02) < A.annuity(l, 65, 0.04, A.frequency(12), cola=0.02)  # raised once a year only
    for wrong in (0, 7):
        with pytest.raises(ValueError):
            pays(wrong, 0.6)
    scale = np.full((len(q), 3), 0.02)
    assert np.allclose(A.improved_by_year(q, scale, 2000, 2010), A.improved(q, np.full(len(q), 0.02), 10), atol=1e-6)
    assert np.allclose(A.improved_by_year(q, scale, 2000, 2010, True), A.improved(q, np.full(len(q), 0.02), 10, True), atol=1e-6)
    assert A.frequency(13) is None and A.frequency(12.02).compounding == 2
    assert A.parse_basis("CUP942015G") == {"deferral": "C", "table": "UP94", "year": 2015, "projection": "generational"} and A.parse_basis("?") is None


def test_cleaning_and_cursors(spark):
    r = one(
        spark, c=text.clean(F.lit("He said “hi” ,then  left ( quickly ) the U.S.A. today")), none=text.between(F.lit("a(b"), "(", ")"), inner=text.between(F.lit("a(b)c"), "(", ")"), first=text.first_of(F.lit("x;y,z"), ",", ";"),
        third=text.nth_position(F.lit("a.b.c.d"), ".", 3), fourth=text.nth_position(F.lit("a.b.c.d"), ".", 4), n=text.occurrences(F.lit("The theme, the end: the"), "the"), s=text.by_length(L("ccc", "b", "aa", "a")),
    )
    assert r["c"] == 'He said "hi", then left (quickly) the USA today'
    assert (r["none"], r["inner"], r["first"], r["third"], r["fourth"], r["n"], r["s"]) == (None, "b", ";", 6, 0, 3, ["a", "b", "aa", "ccc"])


def test_repairs_and_pairs(spark):
    n = lambda *v: L(*v)
    p = lambda a, b: dates.date_pair(n(*a), n(*b), D("2021-01-01"))
    r = one(spark, m=p((3, 4, 1990), (5, 20, 2000)), d=p((3, 4, 1990), (20, 5, 2000)), no=p((30, 30, 1990), (20, 5, 2000)), x=dates.repaired(D("2000-05-01"), D("1930-05-02"), F.lit(50)), y=dates.repaired(F.lit(None).cast("date"), D("2000-01-01"), F.lit(140)))
    assert [v.isoformat() for v in r["m"]] == ["1990-03-04", "2000-05-20"] and [v.isoformat() for v in r["d"]] == ["1990-04-03", "2000-05-20"] and r["no"] is None
    assert r["x"]["birth"] == dt.date(1930, 5, 2) and r["x"]["age"] == 69 and r["x"]["codes"] == ["swapped", "age"] and r["y"]["age"] is None and r["y"]["codes"] == ["too_old"]


def test_merging(spark):
    r = one(
        spark, n=linkage.merged_names(L("Al", "Renée"), L("renee", "Alan", "Bea", "Cy"), L("Al")), e=linkage.merged_names(F.lit(None).cast("array<string>"), L("A"), L("x")), f=linkage.filled(F.lit(0), F.lit(7), 0), g=linkage.filled(F.lit(3), F.lit(7), 0),
        t=linkage.tightened(D("1950-01-01"), D("1950-12-31"), D("1950-03-01"), D("1951-01-01")), apart=linkage.tightened(D("1950-01-01"), D("1950-12-31"), D("1960-03-01"), D("1961-01-01")), one=names.gender_of(F.array(F.struct(F.lit(90).alias("male"), F.lit(10).alias("female")))), none=names.gender_of(F.array().cast("array<struct<male:int,female:int>>")),
    )
    assert r["n"] == ["Renée", "Alan", "Bea"] and r["e"] == ["A"] and (r["f"], r["g"]) == (7, 3)
    assert r["t"]["low"] == dt.date(1950, 3, 1) and r["t"]["high"] == dt.date(1950, 12, 31) and r["apart"]["low"] == dt.date(1950, 1, 1) and r["one"] == pytest.approx(0.5 + 0.4 * 0.95) and r["none"] == 0.5


def test_names_as_worked_by_hand(spark):
    pair = lambda m, f: F.struct(F.lit(m).alias("male"), F.lit(f).alias("female"))
    r = one(
        spark, both=names.similarity(L("A", "B"), L("Alan", "Bea")), letter=names.similarity(L("A"), L("A")), rare=names.credibility(F.lit(3), F.lit(0)), four=names.credibility(F.lit(0), F.lit(4)), ten=names.credibility(F.lit(9), F.lit(1)),
        two=names.gender_of(F.array(pair(300, 0), pair(6, 2))), against=names.gender_of(F.array(pair(6, 2), pair(0, 300))),
    )
    assert (r["both"], r["letter"], r["rare"], r["four"], r["ten"]) == (1.0, 0.5, "medium", "medium", "low")
    # 0.9 of a sure name and 0.1 of 0.75 are 0.975; 0.05 is missing, of which 0.25 * 0.875 squared is added.
    assert r["two"] == pytest.approx(0.975 + 0.05 * 0.25 * 0.875**2) and r["against"] == pytest.approx(0.525 + 0.95 * 0.25 * 0.375**2)


def test_compatible_lookups(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    other = spark.createDataFrame([(1, 0), (2, 5)], "k int, number int")
    found = lambda compat: {r["k"]: r["found"] for r in lookup.valid_record_exists(df, other, ["k"], "number", compat).collect()}
    assert found(False) == {1: True, 2: True, 3: False} and found(True) == {1: True, 2: False, 3: False}
    mixed = lookup.shuffled(spark.range(50).withColumnRenamed("id", "ordinal"), 3)
    assert [r["ordinal"] for r in mixed.collect()] != list(range(50)) and [r["ordinal"] for r in mixed.orderBy("ordinal").collect()] == list(range(50))


def test_values_of_equal_arguments_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.pandas_udf("double")
    def f(a: pd.Series, rates: pd.Series) -> pd.Series:
        made.add(len(a))
        return a + rates.map(lambda r: r[0])

    rows = spark.range(1000).select("id", F.when(F.col("id") % 10 > 0, (F.col("id") % 10).cast("double")).alias("a"))
    out = A.valued(rows, f, [F.col("a"), F.array(F.lit(0.5))], "value")
    got = {r["id"]: r["value"] for r in out.collect()}
    assert out.columns == ["id", "a", "value"] and made.value == 10
    assert len(got) == 1000 and got[7] == 7.5 and got[17] == 7.5 and (got[20] is None or got[20] != got[20])


def test_nearest_places_of_crowded_keys(spark, monkeypatch):
    monkeypatch.setattr(lookup, "PLACES", 4)
    rng = np.random.default_rng(3)
    odd = [None, float("nan"), float("inf")]
    places = [(1000 + n, n % 3, float(x), float(y)) for n, (x, y) in enumerate(np.round(rng.normal(size=(300, 2)), 1))]
    places += [(n, 0, x, 0.5) for n, x in enumerate(odd)] + [(10 + n, 3, x, 0.5) for n, x in enumerate(odd)]
    rows = [(n, n % 4, float(x), float(y)) for n, (x, y) in enumerate(rng.normal(size=(200, 2)))] + [(500 + n, n % 4, x, 0.1) for n, x in enumerate(odd * 2)]

    def wanted(key, x, y):
        out = []
        for v, k, a, b in places:
            if k == key:
                d = None if None in (x, a) else (x - a) * (x - a) + (y - b) * (y - b)
                out.append(((d is None, d is not None and d != d, 0.0 if d is None or d != d else d, v), v))
        return min(out)[1]

    df = spark.createDataFrame(rows, "row_id long, area long, qx double, qy double")
    got = lookup.nearest_by(df, spark.createDataFrame(places, "vec_id long, area long, x double, y double"), "area", "vec_id")
    assert {r["row_id"]: r["vec_id"] for r in got.collect()} == {n: wanted(k, x, y) for n, k, x, y in rows}
