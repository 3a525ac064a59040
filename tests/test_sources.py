"""Files: what is read, written and streamed."""

import datetime as dt

from pyspark.sql import functions as F

from lychgate.sources import readers, schemas, writers
from lychgate.streaming import jobs


def person(**values):
    return ",".join(values.get(n, "") for n in schemas.names(schemas.PERSON))


def test_person_csv(spark, tmp_path):
    lines = [
        person(last1="Last Name", id="ID"), person(last1="Doe", last2="Roe", first1="Ann", id="7", dob="19500102", dod="19000101", age="999", yob="0", run_code="1"),
        person(last1="Gone", id="8", run_code="999"), person(last1="Noid"), person(last1='O"Dd', id="9", age="80", run_code=""),
    ]
    (tmp_path / "p.csv").write_text("\n".join(lines))
    rows = {r["id"]: r for r in readers.person_csv(spark, str(tmp_path / "p.csv")).collect()}
    assert set(rows) == {"7", "9"}
    assert rows["7"]["dob"] == dt.date(1950, 1, 2) and rows["7"]["dod"] is None and rows["7"]["age"] is None and rows["7"]["yob"] is None
    assert rows["7"]["last_names"] == ["Doe", "Roe"] and rows["9"]["last1"] == 'O"Dd' and rows["9"]["age"] == 80 and rows["9"]["run_code"] == 0


def test_lists_round_trip(spark, tmp_path):
    df = spark.createDataFrame([tuple(str(i) for i in range(12)), ("x", None, *["y"] * 10)], schemas.names(", ".join(f"{n} string" for n in schemas.OBIT_LIST)))
    writers.obit_list(df, str(tmp_path / "l"))
    back = readers.obit_list(spark.read.text(str(tmp_path / "l")))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_configuration(spark, tmp_path):
    (tmp_path / "c.txt").write_text("[Host]: example.org\n[Level] : x\nnoise\n[Days]: 3\n")
    assert readers.parameters(spark, str(tmp_path / "c.txt")) == {"Host": "example.org", "Days": "3"}
    (tmp_path / "t.txt").write_text("name full name\nage years old\n\n")
    assert {tuple(r) for r in readers.lookup_table(spark, str(tmp_path / "t.txt")).collect()} == {("name", "full name"), ("age", "years old")}


def test_stream_takes_what_landed(spark, tmp_path):
    folder, state, root = tmp_path / "in", str(tmp_path / "state"), str(tmp_path / "out")
    folder.mkdir()
    line = lambda i, date: "||".join([str(i), "k", f"id{i}", "u", "", "", "", "", "", date, "", ""]) + "||"
    (folder / "a.obitList").write_text(line(1, "2020-01-01") + "\n" + line(2, "2020-01-01") + "\n")
    (folder / "b.other").write_text(line(3, "2020-01-01") + "\n")
    sink = jobs.upsert_parquet(["id"], "pub_date", root)
    jobs.run_once(jobs.landed_lists(spark, str(folder)), sink, state)
    (folder / "c.obitList").write_text(line(1, "2020-03-01") + "\n")
    jobs.run_once(jobs.landed_lists(spark, str(folder)), sink, state)
    got = {r["id"]: r["pub_date"] for r in spark.read.parquet(f"{root}/v=1").collect()}
    assert got == {"id1": "2020-03-01", "id2": "2020-01-01"}
    # A replay under a new checkpoint adds to what is stored.
    (folder / "a.obitList").write_text(line(4, "2020-01-01") + "\n")
    (folder / "c.obitList").unlink()
    jobs.run_once(jobs.landed_lists(spark, str(folder)), sink, str(tmp_path / "again"))
    assert {r["id"]: r["pub_date"] for r in jobs.current(spark, root).collect()} == got | {"id4": "2020-01-01"}
    assert jobs.current(spark, str(tmp_path / "none")) is None


def test_report_totals(spark):
    page = writers.html_report(spark.range(3000).withColumnRenamed("id", "n"), "All & more", F.desc("n"), most=2)
    assert "<td>4498500</td>" in page and "2 of 3000 rows" in page and page.index("2999") < page.index("2998") and "All &amp; more" in page


def test_fetch_plan(spark):
    listed = spark.createDataFrame([("a",), ("a",), ("b",)], "url string")
    assert [r["url"] for r in readers.pages_to_fetch(listed, spark.createDataFrame([("b",)], "url string")).collect()] == ["a"]
    assert readers.listing_pages(spark.createDataFrame([("p", 21)], "provider string, entries int")).count() == 3
