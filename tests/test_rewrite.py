"""Every rewrite rule by a case, its guard and its count; the order of stages; both ways to run the rules."""

import re

import pytest
from pyspark.sql import functions as F

from lychgate.operators import rewrite as R

CASES = {
    "invisible": ("a­b​c", "abc", 2), "hard_blank": ("a b", "a b", 1), "quotes": ("“a” «b»", '"a" "b"', 4), "apostrophes": ("a’b", "a'b", 1), "dashes": ("a–b—c", "a-b-c", 2), "dots": ("a…", "a...", 1), "ligature": ("œuf", "oeuf", 1),
    "junk": ("De%%% eux***.", "De eux.", 2), "month_glued": ("onMay 3", "on May 3", 1), "weekday": ("Friday, May 3", "May 3", 1), "ordinal": ("May 3rd", "May 3", 1), "year_glued": ("May 3,1990", "May 3, 1990", 1), "year_said": ("in the year 1990", "in 1990", 1),
    "point_for_comma": ("May 3. 1990", "May 3, 1990", 1), "irish": ("O' Hara", "O'Hara", 1), "scottish": ("Mc Kay", "McKay", 1), "predeceased": ("Pre-deceased", "Predeceased", 1), "years_glued": ("80years", "80 years", 1), "age_glued": ("aged80", "aged 80", 1),
    "affection": ("survived by his loving wife, dear son", "survived by his wife, son", 2), "square": ("[a]", "(a)", 1), "empty_brackets": ("( )", "", 1), "commas": ("a,, ,b", "a,b", 1), "blank_before": ("a , b .", "a, b.", 2), "comma_glued": ("a,b;c", "a, b; c", 2),
    "sentence_glued": ("rest.The", "rest. The", 1), "bracket_opens": ("a( b", "a (b", 1), "bracket_closes": ("b )a", "b) a", 1), "blanks": ("a  b\tc", "a b c", 2), "ends": (" a ", "a", 2),
}


def test_every_rule_has_a_case(spark):
    assert set(CASES) == {r.name for r in R.RULES} and [r.stage for r in R.ordered()] == sorted((r.stage for r in R.RULES), key=R.STAGES.index)
    for rule in R.RULES:
        text, wanted, n = CASES[rule.name]
        row = R.with_hits(spark.createDataFrame([(text,)], "t string"), "t", (rule,)).first()
        assert (row["t"], row["hits"][rule.name]) == (wanted, n), rule.name


def test_guards_and_order(spark):
    docs = spark.createDataFrame([(1, "his loving wife"), (2, "mourned by his loving wife"), (3, None), (4, ""), (5, "x,, , y" * 20_000)], "id long, t string")
    rows = {r["id"]: r for r in R.with_hits(docs, "t").collect()}
    assert rows[1]["t"] == "his loving wife" and rows[2]["t"] == "mourned by his wife" and rows[3]["t"] is None and rows[4]["t"] == ""
    assert rows[1]["hits"]["affection"] == 0 and rows[2]["hits"]["affection"] == 1 and set(rows[3]["hits"]) == {0} and rows[5]["hits"]["commas"] == 20_000
    first, last = R.Rule("b", "blanks", "b", "c"), R.Rule("a", "dates", "a", "b")
    assert docs.select(R.repaired(F.lit("ab"), (first, last)).alias("x")).first()["x"] == "cc"


def test_both_ways_and_counts_by_the_way(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    done, told = R.observed(docs, "text")
    one, two = sorted(done.collect(), key=str), sorted(docs.select("doc_id", R.repaired(F.col("text")).alias("text")).collect(), key=str)
    assert one == two and done.columns == ["doc_id", "text"]
    counts = {r["rule"]: r["hits"] for r in R.totals(docs, "text").collect()}
    assert {k: v or 0 for k, v in told.get.items()} == counts
    assert counts["invisible"] == sum(len(re.findall("[­​﻿]", t or "")) for _, t in docs.collect())


def test_columns_named_like_counts(spark):
    docs = spark.createDataFrame([("a,,b", 7)], "t string, _commas_ int")
    row = R.with_hits(docs, "t").first()
    assert row["_commas_"] == 7 and row["hits"]["commas"] == 1 and R.totals(docs.limit(0), "t").where("hits != 0").count() == 0
