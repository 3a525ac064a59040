"""Written dates and ages: every form, what is no date or age, and a plain parser over generated notices."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from lychgate.functions import text as T
from lychgate.functions import written as W
from lychgate.operators import extract


def dates(s):
    return [d["date"].isoformat() for d in W.read_dates(s) if d["date"]]


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("May 3rd, 1990", ["1990-05-03"]), ("Sept. 5, 2001", ["2001-09-05"]), ("the 3rd of May 1990", ["1990-05-03"]), ("August the 8th, 2020", ["2020-08-08"]), ("le 1er mai 1990", ["1990-05-01"]), ("3 de mayo del 1990", ["1990-05-03"]),
        ("MAY 3, 1990", ["1990-05-03"]), ("May 3, 1990-June 4, 1991", ["1990-05-03", "1991-06-04"]), ("12 déc. 1988", ["1988-12-12"]), ("Dec 12 1988", ["1988-12-12"]), ("5th day of June, 1999", ["1999-06-05"]), ("February 29, 2000", ["2000-02-29"]),
        ("February 29, 1999", []), ("May 45, 1990", []), ("1990-05-03", []), ("3/May 1990", []), ("May; 3, 1990", []), ("mayhem 3, 1990", []), ("Marc 3, 1990", ["1990-03-03"]), ("3 x May 1990", []), ("", []), ("13 May 3, 1990", ["1990-05-03"]),
    ],
)
def test_forms_of_dates(text, wanted):
    assert dates(text) == wanted


def test_partial_dates_and_ceremony():
    found = W.read_dates("We met May 5 before the funeral on June 6, 2000")
    assert [(d["date"], d["month"], d["day"], d["ceremony"]) for d in found] == [(None, 5, 5, False), (dt.date(2000, 6, 6), 6, 6, True)]
    assert not W.read_dates("health service")and not W.read_dates("the health service, May 45") and W.read_dates("health service May 5, 2001")[0]["ceremony"] is False
    assert W.read_dates("Dec 5")[:1] == [] and W.months()["sept"] == (9, False) and "ma" not in W.months() and W.months()["may"] == (5, True)


def test_against_a_plain_parser():
    """Dates in running text against one pattern a form."""
    rng, names = random.Random(4), W.MONTHS["en"]
    for _ in range(2000):
        day = dt.date(1900, 1, 1) + dt.timedelta(rng.randint(0, 40_000))
        m, end = names[day.month - 1].title(), {1: "st", 2: "nd", 3: "rd"}.get(day.day % 10 * (day.day not in (11, 12, 13)), "th")
        said = rng.choice([f"{m} {day.day}, {day.year}", f"{m[:3]}. {day.day}{end}, {day.year}", f"{day.day}{end} of {m}, {day.year}", f"{day.day} {m[:3]} {day.year}"])
        filler = rng.choice(["He may go in 1990 with 3 of 5", "Room 12 was cold", "On 5 occasions", "In March he ran 12 miles"])
        text = f"{filler}, {said} was sunny; {filler}."
        found = re.search(r"([A-Z][a-z]+)\.? (\d+)(?:st|nd|rd|th)?, (\d{4}) was|(\d+)(?:st|nd|rd|th)? (?:of )?([A-Z][a-z]+),? (\d{4}) was", text).groups()
        month, number, year = found[:3] if found[0] else (found[4], found[3], found[5])
        plain = dt.date(int(year), [n[:3] for n in names].index(month[:3].lower()) + 1, int(number))
        assert dates(text) == [plain.isoformat()] == [day.isoformat()]


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("Her children, 12, 14, survive.", None), ("The barn is over 90 years old.", None), ("She was 5 feet tall, aged 80.", 80), ("He was 30 minutes late.", None), ("He died May 3, 20, at home.", None), ("He was aged 3 hours.", 0),
        ("He was born 40 years ago.", 40), ("John Smith, 68, left us.", 68), ("in her 91st year", 90), ("days before her 90th birthday", 89), ("He was 76.", 76), ("after 40 years of marriage", None), ("aged 200", None), ("aged 7 months", 0), ("aged 30 months", 2),
        ("At 12:45 he was 50 years old", 50), ("He was 3.5 metres away", None), ("He retired aged 65", None), ("at 88 years of age", 88), ("a 10 year battle", None), ("aged 70 since", 70), ("", None), ("12", None), ("the 5 brothers", None), ("He was 76 when he died", 76),
    ],
)
def test_ages(text, wanted):
    found = W.read_age(text)
    assert (found and found[0]) == wanted


def test_sentences_with_months_and_times(spark):
    t = "He left on Jan. 5 at 7 p.m. on foot. It was 3 p.m. Monday. At 5 p.m. The end. Seen in Jan. Then gone."
    parts = spark.range(1).select(T.sentences(F.lit(t)).alias("s")).first()["s"]
    assert parts == ["He left on Jan. 5 at 7 p.m. on foot.", "It was 3 p.m. Monday.", "At 5 p.m.", "The end.", "Seen in Jan.", "Then gone."]


def test_columns_of_nulls_and_empty_texts(spark):
    docs = spark.createDataFrame([(1, None, None), (2, "", None), (3, "He died May 3, 1990, 70, at home. Age 5.", dt.date(1990, 5, 3)), (4, "He died May 3, 1990, 70, at home.", dt.date(1990, 5, 4)), (5, "Born May 3, 1990, 70, at home.", None), (6, "x " * 100_000 + ". Then aged 5", None)], "id long, t string, died date")
    rows = {r["id"]: r for r in docs.select("id", extract.age("t", F.col("died")).alias("age"), extract.written_dates(F.col("t")).alias("d"), extract.born_and_died(F.col("t")).alias("x"), extract.service_date(F.col("t")).alias("s")).collect()}
    assert {i: r["age"] for i, r in rows.items()} == {1: None, 2: None, 3: 70, 4: None, 5: None, 6: 5}
    assert rows[3]["d"] == [dt.date(1990, 5, 3)] and not rows[2]["d"] and rows[3]["x"]["died"] == dt.date(1990, 5, 3) and rows[1]["s"] is None


def test_one_form_of_dates():
    assert W.in_one_form("Jan-5-2020,May-5-2020 2020/1/2-2021/3/4") == "Jan. 5, 2020, May 5, 2020 2020/1/2 - 2021/3/4"
    assert [W.in_one_form(t) for t in ("a 2020-01-31b", "2020-13-31", "Foo-5-2020", "no date  here", "1-2-3")] == ["a 2020/01/31 b", "2020-13-31", "Foo-5-2020", "no date  here", "1-2-3"]
    assert W.balanced("a((((b))))c)") == "a((((b))))c" and W.balanced(")(") == ""


def test_sentences_keep_digits_at_their_ends(spark):
    t = "0997 is a number.  1 is one, and 11.  2 of them were 22"
    assert spark.range(1).select(T.sentences(F.lit(t)).alias("s")).first()["s"] == ["0997 is a number.", "1 is one, and 11.", "2 of them were 22"]


def test_a_range_is_read_once_in_a_worker():
    from lychgate.functions import written

    told = [written.date_range_language("5 mai 1920 - 6 août 2001") for _ in range(3)]
    assert told == ["fr"] * 3 and written.date_range_language.cache_info().hits >= 2
