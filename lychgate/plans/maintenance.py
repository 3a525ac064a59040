"""Plans that keep dimensions up to date and watch feeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from lychgate.operators import maintain as M
from lychgate.operators import merge
from lychgate.registry import query
from lychgate.sources.tables import table


@query(
    "upsert_priority",
    """SELECT key, provider, place FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY CASE WHEN provider = 21 THEN 1 ELSE provider END DESC, old DESC) AS n FROM
       (SELECT o_custkey AS key, max(o_orderkey % 30) AS provider, 'old' AS place, 1 AS old FROM orders WHERE o_orderstatus = 'F' GROUP BY 1
        UNION ALL SELECT o_custkey, max(o_orderkey % 25), 'new', 0 FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1)) WHERE n = 1""",
)
def upsert_priority(spark, d):
    o = table(spark, d, "orders")

    def version(rows, n, place):
        return rows.groupBy(F.col("o_custkey").alias("key")).agg(F.max(F.col("o_orderkey") % n).alias("provider")).withColumn("place", F.lit(place))

    rank = F.when(F.col("provider") == 21, 1).otherwise(F.col("provider"))
    return M.upsert(version(o.where("o_orderstatus = 'F'"), 30, "old"), version(o.where("o_orderstatus <> 'F'"), 25, "new"), ["key"], rank)


@query("delete_reload", "SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN 'reloaded' ELSE c_mktsegment END AS segment FROM customer")
def delete_reload(spark, d):
    old = table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    return M.replace_rows(old, old.where("c_custkey % 10 = 0").withColumn("segment", F.lit("reloaded")), ["c_custkey"])


@query(
    "name_counters",
    """SELECT name, sum(m)::BIGINT AS male_count, sum(f)::BIGINT AS female_count, CASE WHEN sum(m) + sum(f) > 0 THEN sum(m) / (sum(m) + sum(f)) END AS male_pct FROM
       (SELECT c_nationkey AS name, (c_custkey % 2)::BIGINT AS m, (1 - c_custkey % 2)::BIGINT AS f FROM customer UNION ALL SELECT s_nationkey, -1 * (s_suppkey % 2)::BIGINT, 1 FROM supplier) GROUP BY 1""",
)
def name_counters(spark, d):
    c, s = table(spark, d, "customer"), table(spark, d, "supplier")
    odd = F.col("c_custkey") % 2
    old = c.groupBy(F.col("c_nationkey").alias("name")).agg(F.sum(odd).alias("male_count"), F.sum(1 - odd).alias("female_count"))
    change = s.select(F.col("s_nationkey").alias("name"), (-(F.col("s_suppkey") % 2)).alias("male_count"), F.lit(1).cast("long").alias("female_count"))
    return M.add_counts(old, change, "name")


@query(
    "feed_bounds",
    """WITH f AS (SELECT c_custkey AS feed, DATE '1995-01-01' + (c_custkey % 100)::INT AS first_seen, DATE '1997-01-01' + (c_custkey % 100)::INT AS last_seen, DATE '1998-01-01' + (c_custkey % 200)::INT AS last_checked FROM customer),
       n AS (SELECT o_custkey AS feed, min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders GROUP BY 1)
       SELECT feed, least(first_seen, lo) AS first_seen, greatest(last_seen, hi) AS last_seen, CASE WHEN NOT coalesce(hi > last_checked, false) THEN last_checked END AS last_checked FROM f LEFT JOIN n USING (feed)""",
)
def feed_bounds(spark, d):
    day = lambda s, n: F.date_add(F.lit(s).cast("date"), (F.col("c_custkey") % n).cast("int"))
    feeds = table(spark, d, "customer").select(F.col("c_custkey").alias("feed"), day("1995-01-01", 100).alias("first_seen"), day("1997-01-01", 100).alias("last_seen"), day("1998-01-01", 200).alias("last_checked"))
    seen = table(spark, d, "orders").select(F.col("o_custkey").alias("feed"), F.to_date("o_orderdate").alias("day"))
    return M.feed_bounds(feeds, seen, "feed")


@query(
    "distinct_dates_gap",
    """WITH d AS (SELECT DISTINCT o_custkey AS feed, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-02' AND CAST(o_orderdate AS DATE) > DATE '1996-01-01' AND o_orderpriority NOT LIKE 'BR_%' AND o_orderkey % 9 <> 0),
       g AS (SELECT feed, count(*) AS n_days, min(day) AS first_day, max(day) AS last_day FROM d GROUP BY 1),
       q AS (SELECT *, (last_day - first_day) // n_days AS mean_gap, greatest(0, DATE '1998-01-01' - last_day - 3) AS quiet FROM g)
       SELECT *, quiet > 3 * mean_gap OR quiet > 21 AS alert FROM q""",
)
def distinct_dates_gap(spark, d):
    days = table(spark, d, "orders").select(F.col("o_custkey").alias("feed"), F.to_date("o_orderdate").alias("day"), F.when(F.col("o_orderkey") % 9 == 0, "BR_junk").otherwise("Roy").alias("last_name"))
    return M.inactivity(days, "feed", F.lit("1998-01-01").cast("date"), name="last_name")


@query("first_nicknames", "SELECT c_nationkey, array_to_string(list_sort(list_distinct(list(lower(c_mktsegment)))), ' ') AS alt_names FROM customer WHERE c_acctbal > 0 GROUP BY 1")
def first_nicknames(spark, d):
    c = table(spark, d, "customer").where("c_acctbal > 0")
    return c.groupBy("c_nationkey").agg(F.array_join(F.array_sort(F.collect_set(F.lower("c_mktsegment"))), " ").alias("alt_names"))


_MERGE_SQL = """s AS (SELECT c_custkey AS id, ['Al', CASE WHEN c_custkey % 3 = 0 THEN 'Ann' ELSE 'Bea' END] AS firsts, CASE WHEN c_custkey % 4 <> 0 THEN c_custkey % 2 END AS gender, CASE WHEN c_custkey % 5 <> 0 THEN DATE '1920-01-01' + (c_custkey * 37 % 9000)::INT END AS dob,
 CASE WHEN c_custkey % 7 = 0 THEN DATE '1999-01-01' + (c_custkey % 300)::INT END AS dod, CASE WHEN c_custkey % 5 = 0 THEN 1930 + c_custkey % 9 END::INT AS yob, 80 + c_custkey % 10 AS age, CASE WHEN c_custkey % 6 <> 0 THEN 'P' || c_custkey % 50 END AS place, 990 + c_custkey % 40 AS feed FROM customer),
 r AS (SELECT o_custkey AS id, o_orderkey AS ord, [['ann', 'Zoé'], ['Cal'], ['ZOE', 'Dot'], []][(o_orderkey % 4 + 1)::INT] AS firsts, CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey % 2 END AS gender, CASE WHEN o_orderkey % 9 = 0 THEN DATE '1925-01-01' + (o_orderkey * 31 % 7000)::INT END AS dob,
 CASE WHEN o_orderkey % 8 = 0 THEN DATE '2000-01-01' + (o_orderkey % 900)::INT END AS dod, CASE WHEN o_orderkey % 6 = 0 THEN 'Q' || o_orderkey % 50 END AS place, 980 + o_orderkey % 60 AS feed FROM orders)"""


@query(
    "merge_people",
    f"""WITH {_MERGE_SQL}, n AS (SELECT id, max_by(gender, ord) FILTER (gender IS NOT NULL) AS gender, max_by(dob, ord) FILTER (dob IS NOT NULL) AS dob, max_by(dod, ord) FILTER (dod IS NOT NULL) AS dod,
         max_by(place, ord) FILTER (place IS NOT NULL) AS place, max_by(feed, ord) FILTER (place IS NOT NULL) AS feed FROM r GROUP BY 1),
        w AS (SELECT id, unnest(firsts) AS name, generate_subscripts(firsts, 1) AS i, -1 AS ord FROM s UNION ALL SELECT id, unnest(firsts), generate_subscripts(firsts, 1), ord FROM r),
        f AS (SELECT id, lower(strip_accents(name)) AS k, min({{'ord': ord, 'i': i, 'name': name}}) AS x FROM w GROUP BY 1, 2), g AS (SELECT id, list(x.name ORDER BY k = 'al', x) AS names FROM f GROUP BY 1),
        o AS (SELECT r.id, max(r.gender <> s.gender) AS a, max(r.dob <> s.dob) AS b, max(r.dod <> s.dod) AS c FROM r JOIN s USING (id) GROUP BY 1),
        m AS (SELECT s.id, array_to_string(names[1:3], '|') AS firsts, coalesce(n.gender, s.gender) AS gender, coalesce(n.dob, s.dob) AS dob, coalesce(n.dod, s.dod) AS dod, s.yob AS y, s.age AS a,
         CASE WHEN n.feed < 1000 AND s.feed >= 1000 AND s.feed <> 1021 AND s.place IS NOT NULL THEN s.place ELSE coalesce(n.place, s.place) END AS place,
         array_to_string(list_filter([CASE WHEN o.a THEN 'gender' END, CASE WHEN o.b THEN 'dob' END, CASE WHEN o.c THEN 'dod' END], lambda x: x IS NOT NULL), '|') AS contradicted FROM s LEFT JOIN n USING (id) LEFT JOIN g USING (id) LEFT JOIN o USING (id)),
        t AS (SELECT *, coalesce(year(dob), y)::INT AS yob, year(dod)::INT AS yod, coalesce(date_diff('year', dob, dod) - (CASE WHEN (month(dod), day(dod)) < (month(dob), day(dob)) AND NOT (dod = last_day(dod) AND dob = last_day(dob) AND month(dod) = month(dob)) THEN 1 ELSE 0 END), a)::INT AS age FROM m)
        SELECT id, firsts, gender, dob, dod, yob, yod, age, place, contradicted, coalesce(dob, make_date(yob, 1, 1)) AS low, coalesce(dob, make_date(yob, 12, 31)) AS high FROM t""",
)
def merge_people(spark, d):
    k, date = F.col("c_custkey"), lambda s, n: F.date_add(F.lit(s).cast("date"), n.cast("int"))
    none, text = F.lit(None), lambda w, n: F.concat(F.lit(w), n.cast("string"))
    empty = F.array().cast("array<string>")
    stored = table(spark, d, "customer").select(
        k.alias("id"), F.array(F.lit("Al"), F.when(k % 3 == 0, "Ann").otherwise("Bea")).alias("firsts"), empty.alias("middles"), F.array(F.lit("Roy")).alias("lasts"), F.when(k % 4 != 0, k % 2).alias("gender"),
        F.when(k % 5 != 0, date("1920-01-01", k * 37 % 9000)).alias("dob"), F.when(k % 7 == 0, date("1999-01-01", k % 300)).alias("dod"), F.when(k % 5 == 0, (1930 + k % 9).cast("int")).alias("yob"), none.cast("int").alias("yod"),
        (80 + k % 10).cast("int").alias("age"), none.cast("string").alias("spouse"), none.cast("date").alias("service"), F.when(k % 6 != 0, text("P", k % 50)).alias("place"), (990 + k % 40).alias("feed"),
        none.cast("date").alias("low"), none.cast("date").alias("high"),
    )
    k = F.col("o_orderkey")
    firsts = F.element_at(F.array(F.array(F.lit("ann"), F.lit("Zoé")), F.array(F.lit("Cal")), F.array(F.lit("ZOE"), F.lit("Dot")), empty), (k % 4 + 1).cast("int"))
    records = table(spark, d, "orders").select(
        F.col("o_custkey").alias("id"), k.alias("order"), firsts.alias("firsts"), empty.alias("middles"), F.array(F.lit("ROY")).alias("lasts"), F.when(k % 5 == 0, k % 2).alias("gender"), F.when(k % 9 == 0, date("1925-01-01", k * 31 % 7000)).alias("dob"),
        F.when(k % 8 == 0, date("2000-01-01", k % 900)).alias("dod"), none.cast("int").alias("yob"), none.cast("int").alias("yod"), none.cast("int").alias("age"), none.cast("string").alias("spouse"), none.cast("date").alias("service"),
        F.when(k % 6 == 0, text("Q", k % 50)).alias("place"), (980 + k % 60).alias("feed"),
    )
    got = merge.merged(stored, records, spark.createDataFrame([("AL",)], "name string"))
    joined = lambda c: F.array_join(c, "|").alias(c)
    return got.select("id", joined("firsts"), "gender", "dob", "dod", "yob", "yod", "age", "place", joined("contradicted"), "low", "high")
