"""The best of a stored person and its records, whatever the order in which rows come."""

import datetime as dt

from pyspark.sql import functions as F

from lychgate.operators import merge

PERSON = "id long, firsts array<string>, middles array<string>, lasts array<string>, gender string, dob date, dod date, yob int, yod int, age int, spouse string, service date, place string, feed int"
D = dt.date


def rows(spark, stored, records, seed=None):
    s = spark.createDataFrame([(*r, None, None) for r in stored], f"{PERSON}, low date, high date")
    r = spark.createDataFrame([(*x[1:], x[0]) for x in records], f"{PERSON}, order long")
    if seed:
        r = r.orderBy(F.rand(seed)).repartition(3)
    names = spark.createDataFrame([("bob",), ("Al",), (None,)], "name string")
    return {x["id"]: x for x in merge.merged(s, r, names).collect()}


def test_conflicting_records_in_any_order(spark):
    stored = [
        (1, ["Bob", "Zoé"], ["M."], ["Roy"], "F", None, D(2000, 5, 1), None, None, 70, None, None, "P", 1000), (2, ["Ann"], None, [], None, D(1930, 1, 1), None, None, None, None, "Al", None, "P", 1021), (3, [], [], [], None, None, None, 1940, None, None, None, None, None, None),
    ]
    records = [
        (5, 1, ["zoe", "Ann"], ["m.", "Jean"], ["ROY", "Gray"], "M", D(1930, 5, 1), None, None, None, None, "Cy", None, "Q", 5), (7, 1, ["Dot"], None, None, None, D(1930, 5, 2), D(2000, 5, 1), None, None, 3, None, None, None, 5),
        (6, 2, None, None, ["Lee"], "F", None, D(1990, 1, 1), None, 1991, None, None, None, "Q", 5), (9, 99, ["X"], None, None, None, None, None, None, None, None, None, None, None, 5),
    ]
    for seed in (None, 1, 2):
        got = rows(spark, stored, records, seed)
        assert set(got) == {1, 2, 3}
        one = got[1]
        assert one["firsts"] == ["Zoé", "Ann", "Dot"] and one["middles"] == ["M.", "Jean"] and one["lasts"] == ["Roy", "Gray"] and one["gender"] == "M" and one["spouse"] == "Cy"
        assert (one["dob"], one["dod"], one["yob"], one["yod"], one["age"]) == (D(1930, 5, 2), D(2000, 5, 1), 1930, 2000, 69) and one["low"] == one["high"] == D(1930, 5, 2)
        assert one["place"] == "P" and one["contradicted"] == ["gender", "age"]
        assert got[2]["place"] == "Q" and got[2]["age"] == 60 and got[2]["yod"] == 1990 and got[2]["contradicted"] == [] and got[2]["lasts"] == ["Lee"]
        assert got[3]["low"] == D(1940, 1, 1) and got[3]["high"] == D(1940, 12, 31) and got[3]["firsts"] == []


def test_without_records(spark):
    stored = [(1, ["Ann"], [], ["Roy"], "F", D(1930, 1, 1), None, None, None, None, None, None, "P", 5)]
    assert rows(spark, stored, [])[1]["firsts"] == ["Ann"] and rows(spark, [], []) == {}
