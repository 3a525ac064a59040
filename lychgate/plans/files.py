"""Plans of files and loads: what is written is read back by the declared readers, and decided records are loaded."""

from __future__ import annotations

from pyspark.sql import functions as F

from lychgate.operators import load as P
from lychgate.operators import lookup
from lychgate.plans import linkage
from lychgate.registry import query
from lychgate.sources import readers, scratch, writers
from lychgate.sources import schemas as S
from lychgate.sources.tables import table


@query(
    "person_file",
    """SELECT c_custkey::VARCHAR AS id, 'Doe' || c_custkey % 7 AS last, CASE WHEN c_custkey % 2 = 0 THEN 'Ann|Bea' ELSE 'Ann' END AS firsts, CASE WHEN c_custkey % 3 <> 0 THEN DATE '1930-01-01' + (c_custkey % 900)::INT END AS dob,
       CASE WHEN c_custkey % 4 <> 0 THEN (c_custkey % 110)::INT END AS age, c_nationkey AS provider_id, c_mktsegment || ' x' AS spouse FROM customer WHERE c_custkey % 10 <> 1 AND c_nationkey <> 0""",
)
def person_file(spark, d):
    """Written in the written layout; positions 41 to 43 differ in the read one, so the run code is moved first."""
    k = F.col("c_custkey")
    rows = table(spark, d, "customer").where("c_nationkey <> 0").select(
        F.when(k % 10 != 1, k.cast("string")).alias("id"), F.concat(F.lit("Doe"), (k % 7).cast("string")).alias("last1"), F.lit("Ann").alias("first1"), F.when(k % 2 == 0, "Bea").alias("first2"),
        F.when(k % 3 != 0, F.date_format(F.date_add(F.lit("1930-01-01").cast("date"), (k % 900).cast("int")), "yyyyMMdd")).otherwise("19000101").alias("dob"),
        F.when(k % 4 != 0, k % 110).otherwise(999).alias("age"), F.col("c_nationkey").alias("provider_id"), F.concat("c_mktsegment", F.lit(",x")).alias("spouse"), F.lit("0").alias("first_given_name_used"),
    )
    missing = [c for c in S.names(S.PERSON_WRITTEN) if c not in rows.columns]
    path = scratch.folder(spark, "persons")
    writers.person_csv(rows.select("*", *[F.lit(None).cast("string").alias(c) for c in missing]), path)
    return readers.person_csv(spark, path).select("id", F.col("last1").alias("last"), F.array_join("first_names", "|").alias("firsts"), "dob", "age", "provider_id", "spouse")


def _listed(spark, d, names):
    k = F.col("o_orderkey")
    made = {"provider_id": k % 9, "provider_key": k % 4, "id": k, "url": F.concat(F.lit("http://example.org/"), k.cast("string")), "pub_date": F.to_date("o_orderdate"), "age_at_death": F.when(k % 3 == 0, k % 99)}
    return table(spark, d, "orders").select(*[made.get(n, F.lit(None).cast("string")).alias(n) for n in names])


_LISTED_SQL = """SELECT o_orderkey::VARCHAR AS id, (o_orderkey % 9)::VARCHAR AS provider_id, 'http://example.org/' || o_orderkey AS url, CAST(o_orderdate AS DATE)::VARCHAR AS pub_date,
 CASE WHEN o_orderkey % 3 = 0 THEN (o_orderkey % 99)::VARCHAR END AS age_at_death, dod FROM (SELECT *, NULL::VARCHAR AS dod FROM orders)"""


@query("obit_list_file", _LISTED_SQL)
def obit_list_file(spark, d):
    path = scratch.folder(spark, "obits")
    writers.obit_list(_listed(spark, d, S.OBIT_LIST), path)
    return readers.obit_list(spark.read.text(path)).select("id", "provider_id", "url", "pub_date", "age_at_death", "dod")


@query("url_list_file", _LISTED_SQL)
def url_list_file(spark, d):
    path = scratch.folder(spark, "urls")
    writers.url_list(_listed(spark, d, S.URL_LIST), path)
    return readers.url_list(spark.read.text(path)).select("id", "provider_id", "url", "pub_date", "age_at_death", "dod")


@query("id_file", "SELECT c_custkey::INT AS deceased_number, c_name AS last_name FROM customer")
def id_file(spark, d):
    path = scratch.folder(spark, "ids")
    writers.id_csv(table(spark, d, "customer").select(F.col("c_custkey").alias("deceased_number"), F.col("c_name").alias("last_name")), path)
    return readers.id_csv(spark, path)


@query("issue_logs", "SELECT o_orderstatus AS category, count(*) AS n, min(o_orderkey) AS first_record FROM orders GROUP BY 1")
def issue_logs(spark, d):
    path = scratch.folder(spark, "issues")
    rows = table(spark, d, "orders").select(F.col("o_orderstatus").alias("category"), F.col("o_orderkey").alias("record"), F.lit("checked").alias("message"))
    writers.issues(rows, path)
    return spark.read.parquet(path).groupBy("category").agg(F.count("*").alias("n"), F.min("record").alias("first_record"))


@query(
    "postal_files",
    """SELECT s_suppkey, 'K' || s_suppkey % 10 || 'A' || s_suppkey % 7 || 'B1' AS postal_code, CASE WHEN s_suppkey % 7 < 4 THEN 'Town' || s_suppkey % 7 WHEN s_suppkey % 10 < 8 THEN 'Area' || s_suppkey % 10 END AS place,
       CASE WHEN s_suppkey % 7 < 4 OR s_suppkey % 10 < 8 THEN 'Ontario' END AS province FROM supplier""",
)
def postal_files(spark, d):
    path, near = scratch.folder(spark, "codes"), scratch.folder(spark, "areas")
    codes = spark.createDataFrame([(f"k{i}a {j}b1,{'' if j == 3 else 45.0 + j},-75.0",) for i in range(10) for j in range(4)], "value string")
    spark.createDataFrame([("Postcode,Latitude,Longitude",)], "value string").union(codes).coalesce(1).write.mode("append").text(path)
    spark.createDataFrame([(f"K{i}A,Ontario,ON,35,-5,45.0,-75.0",) for i in range(8)], "value string").write.mode("append").text(near)
    towns = readers.postal_csv(spark, path).select("postal_code", F.concat(F.lit("Town"), F.substring("postal_code", 4, 1)).alias("place"), F.lit("Ontario").alias("province"))
    areas = readers.fsa_csv(spark, near).select(F.col("fsa").alias("area"), F.concat(F.lit("Area"), F.substring("fsa", 2, 1)).alias("place"), "province")
    k = F.col("s_suppkey")
    code = F.concat(F.lit("K"), (k % 10).cast("string"), F.lit("A"), (k % 7).cast("string"), F.lit("B1"))
    return lookup.place_of(table(spark, d, "supplier").select("s_suppkey", code.alias("postal_code")), towns, areas)


@query("notice_pages", "SELECT (page_id % 5)::VARCHAR AS provider_id, 'k' || page_id % 3 AS provider_key, page_id::VARCHAR AS id, length(replace(replace(html, chr(13) || chr(10), chr(10)), chr(13), chr(10)))::INT AS n_chars FROM pages")
def notice_pages(spark, d):
    """Pages decoded from Latin-1 or UTF-8 bytes and their place read from a path."""
    k = F.col("page_id")
    latin = F.col("html").rlike(r"^[\x00-\xff]*$") & (k % 2 == 0)
    content = F.when(latin, F.encode("html", "ISO-8859-1")).otherwise(F.encode("html", "UTF-8"))
    path = F.concat_ws("/", F.lit("in"), (k % 5).cast("string"), F.concat(F.lit("k"), (k % 3).cast("string")), F.concat(k.cast("string"), F.lit(".html")))
    parts = F.split(F.regexp_extract(path, r"([^/]+/[^/]+/[^/]+)\.html?$", 1), "/")
    text = readers.decoded(content, F.when(latin, "ISO-8859-1").otherwise("utf-8"))
    return table(spark, d, "pages").select(parts[0].alias("provider_id"), parts[1].alias("provider_key"), parts[2].alias("id"), F.length(text).alias("n_chars"))


_LOAD_SQL = f"""{linkage._STOP_SQL}, pp AS (SELECT id, last AS last_name, first AS first_name, dob, 1.0::DOUBLE AS weight FROM m),
 dd AS (SELECT rec_id, cand_id AS target, CASE WHEN rec_id % 100 = 0 THEN 'force_new' WHEN rec_id % 52 = 0 THEN 'override' WHEN rec_id % 44 = 0 THEN 'junk' WHEN rec_id % 70 = 0 THEN 'replace'
  WHEN known AND (news OR rec_id % 8 <> 0 OR sufficient) THEN 'update' WHEN known THEN 'skip' ELSE 'insert' END AS action FROM best WHERE rn = 1),
 nn AS (SELECT dd.*, i.lasts[1] AS last_name, i.first AS first_name, i.dob AS dob FROM dd JOIN i ON i.id = rec_id),
 uu AS (SELECT target AS id, arg_max(last_name, rec_id) FILTER (WHERE last_name IS NOT NULL) AS l, arg_max(first_name, rec_id) FILTER (WHERE first_name IS NOT NULL) AS f, arg_max(dob, rec_id) FILTER (WHERE dob IS NOT NULL) AS b
  FROM nn WHERE action IN ('update', 'override') GROUP BY 1),
 rr AS (SELECT target AS id, last_name, first_name, dob FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY rec_id DESC) AS q FROM nn WHERE action = 'replace') WHERE q = 1)"""


@query(
    "load_table",
    f"""WITH {_LOAD_SQL} SELECT pp.id, coalesce(l, last_name) AS last_name, coalesce(f, first_name) AS first_name, coalesce(b, dob) AS dob, weight FROM pp LEFT JOIN uu USING (id) WHERE pp.id NOT IN (SELECT id FROM rr)
        UNION ALL SELECT id, last_name, first_name, dob, NULL FROM rr
        UNION ALL SELECT (SELECT max(id) FROM pp) + row_number() OVER (ORDER BY rec_id), CASE WHEN action = 'junk' THEN 'BR_' ELSE '' END || last_name, first_name, dob, CASE WHEN action = 'junk' THEN 0.0 END FROM nn WHERE action IN ('insert', 'force_new', 'junk')""",
)
def load_table(spark, d):
    r = F.col("rec_id")
    code = F.when(r % 100 == 0, 100).when(r % 52 == 0, 101).when(r % 44 == 0, 900).when(r % 70 == 0, r).otherwise(0)
    action = linkage.L.run_action(code, F.col("known"), F.col("news"), r % 8 == 0, F.col("sufficient"))
    told = linkage.best_candidates(spark, d).select("rec_id", action.alias("action"), F.col("cand_id").alias("target"))
    rows = linkage.incoming(spark, d).select(F.col("id").alias("rec_id"), F.get("lasts", F.lit(0)).alias("last_name"), F.col("first").alias("first_name"), "dob")
    people = linkage.master(spark, d).select("id", F.col("last").alias("last_name"), F.col("first").alias("first_name"), "dob", F.lit(1.0).alias("weight"))
    return P.load(people, told.join(rows.hint("merge"), "rec_id"))


@query(
    "person_rows",
    """WITH r AS (SELECT c_custkey AS id, list_slice(['A', 'B', 'C'], 1, (c_custkey % 3 + 1)::INT) AS n FROM customer), v AS (SELECT id, n, unnest(n) AS last_name, generate_subscripts(n, 1) AS i FROM r)
       SELECT id, last_name, CASE WHEN i = 1 THEN n[2] ELSE n[1] END AS alt_last_name1, CASE WHEN i = 3 THEN n[2] ELSE n[3] END AS alt_last_name2, NULL::VARCHAR AS alt_last_name3, 'Ann' AS first_name, 25 AS columns,
       CASE len(n) WHEN 1 THEN 1.0 WHEN 2 THEN 0.5 ELSE CASE WHEN i = 3 THEN 0.34 ELSE 0.33 END END::DOUBLE AS weight FROM v""",
)
def person_rows(spark, d):
    k = F.col("c_custkey")
    records = table(spark, d, "customer").select(k.alias("id"), F.slice(F.array(F.lit("A"), F.lit("B"), F.lit("C")), F.lit(1), (k % 3 + 1).cast("int")).alias("last_names"), F.array(F.lit("Ann")).alias("first_names"))
    rows = P.person_rows(records, F.lit("2020-01-01").cast("date"))
    return rows.select("id", "last_name", "alt_last_name1", "alt_last_name2", F.col("alt_last_name3").cast("string").alias("alt_last_name3"), "first_name", F.lit(len(rows.columns)).alias("columns"), "weight")


@query(
    "read_person",
    """WITH s AS (SELECT o_custkey AS id, min(o_orderkey % 5 * 1000000000 + o_orderkey) AS k FROM orders GROUP BY 1)
       SELECT c_custkey AS id, CASE WHEN 1800 + c_custkey % 300 BETWEEN 1875 AND 2020 THEN 1800 + c_custkey % 300 END AS yob, CASE WHEN c_custkey % 200 <= 130 THEN c_custkey % 200 END AS age_at_death, k // 1000000000 AS provider_id, k % 1000000000 AS source_id
       FROM customer LEFT JOIN s ON s.id = c_custkey""",
)
def read_person(spark, d):
    k = F.col("c_custkey")
    person = table(spark, d, "customer").select(k.alias("id"), (1800 + k % 300).alias("yob"), F.lit(None).cast("int").alias("yod"), (k % 200).alias("age_at_death"))
    sources = table(spark, d, "orders").select(F.col("o_custkey").alias("id"), (F.col("o_orderkey") % 5).alias("provider_id"), F.lit(1).alias("provider_key"), F.col("o_orderkey").alias("source_id"))
    return P.read_person(person, sources, F.lit("2020-06-01").cast("date")).select("id", "yob", "age_at_death", "provider_id", "source_id")


@query(
    "source_upsert",
    """WITH s AS (SELECT l_orderkey AS person_id, l_suppkey % 3 AS provider_id, 1 AS provider_key, l_partkey % 4 AS source_id, min(CAST(l_shipdate AS DATE)) AS stored FROM lineitem WHERE l_linenumber <= 2 GROUP BY ALL),
       n AS (SELECT l_orderkey AS person_id, l_suppkey % 3 AS provider_id, 1 AS provider_key, l_partkey % 4 AS source_id, max(CAST(l_shipdate AS DATE)) AS newer FROM lineitem WHERE l_linenumber > 2 GROUP BY ALL)
       SELECT person_id, provider_id, source_id, CASE WHEN stored IS NULL THEN 'new' ELSE 'old' END AS url, coalesce(newer, stored) AS publish_date FROM s FULL JOIN n USING (person_id, provider_id, provider_key, source_id)""",
)
def source_upsert(spark, d):
    rows = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("person_id"), (F.col("l_suppkey") % 3).alias("provider_id"), F.lit(1).alias("provider_key"), (F.col("l_partkey") % 4).alias("source_id"), F.to_date("l_shipdate").alias("day"), "l_linenumber"
    )
    keys = ["person_id", "provider_id", "provider_key", "source_id"]
    stored = rows.where("l_linenumber <= 2").groupBy(*keys).agg(F.min("day").alias("publish_date")).withColumn("url", F.lit("old"))
    new = rows.where("l_linenumber > 2").select(*keys, F.col("day").alias("publish_date"), F.lit("new").alias("url"))
    return P.upsert_sources(stored, new).select("person_id", "provider_id", "source_id", "url", "publish_date")


@query(
    "getters",
    """WITH c AS (SELECT o_custkey, count(*) AS n, min(o_orderkey) AS k FROM orders GROUP BY 1)
       SELECT c_custkey, CASE WHEN n = 1 THEN k END AS only_order, coalesce(n, 0) = 0 AS defaulted, CASE WHEN c_custkey % 4 = 1 THEN c_custkey % 4 END AS pure FROM customer LEFT JOIN c ON o_custkey = c_custkey""",
)
def getters(spark, d):
    c, o = table(spark, d, "customer"), table(spark, d, "orders")
    only = lookup.only_one(o.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("only_order")), "c_custkey", "only_order")
    counted = lookup.count_by(o.select(F.col("o_custkey").alias("c_custkey")), "c_custkey")
    told = lookup.or_default(counted, c.select("c_custkey"), "c_custkey", {"n": 0}).select("c_custkey", (F.col("n") == 0).alias("defaulted"))
    nicknames = spark.createDataFrame([("0", ["Alan"]), ("1", []), ("2", ["Bea", "Ann"])], "nickname string, formal_names array<string>")
    pure = lookup.pure_nicknames(c.select("c_custkey", (F.col("c_custkey") % 4).cast("string").alias("name")), nicknames, "name").select("c_custkey", F.col("name").cast("bigint").alias("pure"))
    return told.join(only, "c_custkey", "left").join(pure, "c_custkey", "left").select("c_custkey", "only_order", "defaulted", "pure")


@query(
    "list_kinds",
    """SELECT c_custkey AS id, c_custkey % 4 = 1 AS are_surnames, c_custkey % 4 >= 2 AS are_names, c_custkey % 4 = 3 AS are_places, CASE WHEN n > 0 THEN n ELSE NULL END AS urls FROM customer LEFT JOIN
       (SELECT o_custkey, count(DISTINCT o_orderstatus) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey""",
)
def list_kinds(spark, d):
    k = F.col("c_custkey")
    lists = F.array(F.array().cast("array<string>"), F.array(F.lit("Roy"), F.lit("DOE")), F.array(F.lit("ann"), F.lit("Al")), F.array(F.lit("Hull")))
    names = spark.createDataFrame([("roy", "surname"), ("doe", "surname"), ("Ann", "given"), ("al", "nickname"), ("Hull", "place"), ("hull", "surname"), ("hull", "given")], "name string, kind string")
    c = table(spark, d, "customer").select(k.alias("id"), F.element_at(lists, (k % 4 + 1).cast("int")).alias("values"))
    urls = lookup.urls_of(table(spark, d, "orders").select(F.col("o_custkey").alias("id"), "o_orderstatus"), "id", "o_orderstatus").select("id", F.size("urls").cast("long").alias("urls"))
    return lookup.kinds_of(c, names).join(urls, "id", "left")
