"""Addresses, lists, markup, word classes and dates with precedence on small rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lychgate.functions import markup, urls, vectors
from lychgate.operators import lexicon, maintain, precedence

AS_OF = "2020-01-01"


def one(spark, c):
    return spark.range(1).select(c.alias("v")).first()["v"]


def D(s):
    return F.lit(s).cast("date")


def L(*values):
    return F.array(*[F.lit(v) for v in values])


@pytest.mark.parametrize(
    "template, given, wanted",
    [
        ("a/%p%/b/%p%/c%p%", ["", "x%p%", "5"], "a/x%p%/b/5/c%p%"), ("abc", ["x"], "abc"), ("%p%", ["x", "y"], "x"), ("%p%%p%", ["x"], "x%p%"), ("", [], ""), ("%p%", [None], "%p%"),
    ],
)
def test_templates(spark, template, given, wanted):
    assert one(spark, urls.filled(F.lit(template), *[F.lit(g).cast("string") for g in given])) == wanted


def test_addresses(spark):
    told = {u: one(spark, urls.address(F.lit(u))) for u in ("a.b/c", "http://a.b", "http://www.a.b", "//a.b", "https://a.b//c", "x?u=http:", "")}
    assert list(told.values()) == ["http://www.a.b/c", "http://www.a.b", "http://www.a.b", "http://www.a.b", None, None, "http://www."]
    assert one(spark, urls.dated(urls.julian(F.lit(2459000)), "yyyy-MM-dd")) == "2020-05-30"
    with pytest.raises(ValueError):
        urls.dated(D(AS_OF), "ss")


def test_vectors(spark):
    assert one(spark, vectors.over(L(1.0, 2.0), L(0.0, 4.0))) == [None, 0.5]
    assert one(spark, vectors.plus(L(1.0), L(1.0, 2.0))) is None
    assert one(spark, vectors.scaled(L(1.0, 2.0), F.lit(3.0), lambda x, y: x * y)) == [3.0, 6.0]
    assert one(spark, vectors.negative(L(1, -2))) == [-1, 2] and one(spark, vectors.inverse(L(0.0, 4.0))) == [None, 0.25]
    assert one(spark, vectors.without_at(L(1, 2, 3), 2)) == [1, 3] and one(spark, vectors.without_at(L(1), 5)) == [1]


def test_references_are_read_once(spark):
    assert one(spark, markup.entities(F.lit("&eacute;&#233;&#xE9;&amp;lt;&nosuch; & b&#128512;&#xD800;&#0;&nbsp;."))) == "ééé&lt;&nosuch; & b😀&#xD800;&#0; ."
    assert one(spark, markup.entities(F.lit("a&nbsp;b"), blank=False)) == "a b"
    assert one(spark, markup.entities(F.lit(None).cast("string"))) is None


def test_links(spark):
    c = F.lit('a <a href="q">Click here</a> b <a href="z">Smith</a><abbr>x</abbr>')
    assert one(spark, markup.without_links(c)) == "a  b <abbr>x</abbr>"
    assert one(spark, markup.without_links(c, calls_only=True)) == 'a  b <a href="z">Smith</a><abbr>x</abbr>'


def test_clean_up(spark):
    told = [
        markup.even_brackets(F.lit("a) (b (c) d) (e")), markup.without_inner_points(F.lit(".A.B. St. Ann J.R. best. x.")), markup.plain_dates(F.lit("Jan-5-2020,May-5-2020 2020/1/2-2021/3/4")),
        markup.without_celebration(F.lit("The passing of Ann")), markup.before_last(F.lit("a/b/c"), "/"), markup.after_last(F.lit("a/b/c"), "/"), markup.before_last(F.lit("a"), "/"),
        markup.between_if(F.lit("x[a]b"), "[", "]", "!"), markup.between_if(F.lit("x[a!]b"), "[", "]", "!"), markup.without_all(F.lit("a-b.c"), "-."),
    ]
    assert one(spark, F.array(*told)) == ["a (b (c) d) e", ".AB St. Ann JR best x.", "Jan. 5, 2020, May 5, 2020 2020/1/2 - 2021/3/4", "Ann", "a/b", "c", None, "a", None, "abc"]
    kinds = [markup.begins_with_vowel(F.lit("Éva")), markup.begins_with_vowel(F.lit("bob")), markup.is_foreign(F.lit("née")), markup.is_foreign(F.lit("nee")), markup.quoted(F.lit("«x»")), markup.quoted(F.lit("x'"))]
    assert one(spark, F.array(*kinds)) == [True, False, True, False, True, False]
    assert one(spark, markup.all_digits(F.lit("none"))) == 0


def test_date_ranges(spark):
    texts = ["January 5, 1920 - March 6, 2001", "Jan 5, 1920 - Mar 6, 2001", "5 mai 1920 - 6 août 2001", "January 5, 1920 - March 6, 2001 x", "Jan 5, 1920 - March 6, 2001", ""]
    assert [one(spark, markup.pure_date_range(F.lit(t))) for t in texts] == [True, True, True, False, False, False]
    assert one(spark, markup.pure_date_range(F.lit(texts[0]), "es")) is False and one(spark, markup.pure_date_range(F.lit(texts[2]), "en")) is False


def test_word_classes(spark):
    docs = spark.createDataFrame([(1, "Born on Monday, née lundi; HIS Funeral"), (2, None), (3, "")], "id long, t string")
    told = {(r["id"], r["kind"], r["language"]): r["n"] for r in lexicon.counts(docs, "id", "t", lexicon.lexicon(spark)).collect()}
    assert told == {
        (1, "birth", "en"): 1, (1, "birth", "fr"): 1, (1, "weekday", "en"): 1, (1, "weekday", "fr"): 1, (1, "service", "en"): 1, (1, "service", "es"): 1, (1, "gender", "en"): 1,
    }


def known(dob=None, low=None, high=None, yob=None, dod=None):
    return precedence.dates(D(dob), D(low), D(high), F.lit(yob), D(dod))


@pytest.mark.parametrize(
    "record, day, more, wanted",
    [
        (dict(), "1950-02-01", {}, ("1950-02-01", "1950-02-01", "1950-02-01", 1950, 0)),
        (dict(), "2021-02-01", {}, (None, None, None, None, 0)),
        (dict(), None, {}, (None, None, None, None, 0)),
        (dict(low="1950-01-01", high="1950-12-31", yob=1950), "1951-02-01", {}, (None, "1950-01-01", "1951-02-01", 0, 6)),
        (dict(low="1950-01-01", high="1950-12-31", yob=1950), "1949-12-01", {}, (None, "1949-12-01", "1950-12-31", 0, 6)),
        (dict(low="1950-01-01", high="1950-12-31", yob=1950), "1953-02-01", {}, (None, "1950-01-01", "1950-12-31", 1950, 0)),
        (dict(low="1950-01-01", high="1950-12-31"), "1951-02-01", {"next_age": True}, ("1951-02-01", "1951-02-01", "1951-02-01", 1951, 0)),
        (dict(dob="1950-01-01", low="1950-01-01", high="1950-01-01", yob=1950), "1951-01-01", {}, ("1950-01-01", "1950-01-01", "1950-01-01", 1950, 12)),
        (dict(dob="1950-01-01", low="1950-01-01", high="1950-01-01", yob=1950), "1951-01-01", {"override": True}, ("1951-01-01", "1951-01-01", "1951-01-01", 1951, 0)),
        (dict(dob="1990-01-01", dod="1990-01-01"), "1951-01-01", {}, ("1951-01-01", "1951-01-01", "1951-01-01", 1951, 0)),
    ],
)
def test_births(spark, record, day, more, wanted):
    v = one(spark, precedence.set_birth(known(**record), D(day), D(AS_OF), **more))
    text = lambda x: x if x is None else x.isoformat()
    assert (text(v["dob"]), text(v["low"]), text(v["high"]), v["yob"], v["flag"]) == wanted


@pytest.mark.parametrize("old, new, wanted", [(None, "2010-02-01", (2010, 0)), ("1980-01-01", "2010-02-01", (2010, 3)), ("2005-01-01", "2010-02-01", (2005, 3)), ("2005-01-01", None, (2005, 3)), ("2005-01-01", "2005-01-01", (2005, 0))])
def test_deaths(spark, old, new, wanted):
    v = one(spark, precedence.set_death(known(dod=old), D(new), D(AS_OF)))
    assert (v["dod"].year, v["flag"]) == wanted and isinstance(v["dod"], dt.date)


def test_insert_missing_and_counts(spark):
    old = spark.createDataFrame([(4, "b")], "id long, name string")
    new = spark.createDataFrame([("c",), ("a",), ("b",), ("c",)], "name string")
    assert sorted(maintain.insert_missing(old, new, "id", "name", "name").collect()) == [(4, "b"), (5, "a"), (6, "c")]
    several = spark.createDataFrame([("c", 3), ("c", 1), ("c", None), ("a", 2)], "name string, n long")
    stored = spark.createDataFrame([(4, "b", 9)], "id long, name string, n long")
    for new_rows in (several, several.orderBy("n"), several.repartition(3)):
        assert sorted(maintain.insert_missing(stored, new_rows, "id", "name", "name").collect())[1:] == [(5, "a", 2), (6, "c", None)]
    assert not spark.sparkContext._jsc.getPersistentRDDs()
    rows, told = maintain.observed(new, late=F.col("name") > "a")
    assert rows.count() == 4 and told.get == {"read": 4, "late": 3}
