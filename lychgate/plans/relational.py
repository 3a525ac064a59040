"""Plans of lookups, joins, aggregates, sorts and list operators over the tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lychgate.functions import names, text
from lychgate.operators import asof, linkage, lookup
from lychgate.registry import query
from lychgate.sources.tables import table


@query("point_lookup_count", "SELECT c_mktsegment AS segment, count(*) AS n FROM customer GROUP BY 1")
def point_lookup_count(spark, d):
    return lookup.count_by(table(spark, d, "customer").select(F.col("c_mktsegment").alias("segment")), "segment")


@query("equality_lookup", "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def equality_lookup(spark, d):
    c, n = table(spark, d, "customer"), table(spark, d, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select("c_custkey", "n_name")


@query("semi_exists", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def semi_exists(spark, d):
    c, o = table(spark, d, "customer"), table(spark, d, "orders").where("o_orderstatus = 'F'")
    return lookup.exists(c, o, c.c_custkey == o.o_custkey).select("c_custkey")


@query("anti_landed", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '1997-01-01')")
def anti_landed(spark, d):
    c = table(spark, d, "customer")
    o = table(spark, d, "orders").where("o_orderdate >= timestamp'1997-01-01'")
    return lookup.exists(c, o, c.c_custkey == o.o_custkey, negate=True).select("c_custkey")


@query(
    "record_exists_since",
    "SELECT s_suppkey, EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_shipdate >= TIMESTAMP '1998-01-01') AS seen FROM supplier",
)
def record_exists_since(spark, d):
    s = table(spark, d, "supplier")
    late = table(spark, d, "lineitem").where("l_shipdate >= timestamp'1998-01-01'").select(F.col("l_suppkey").alias("s_suppkey")).distinct().withColumn("seen", F.lit(True))
    return s.select("s_suppkey").join(late, "s_suppkey", "left").withColumn("seen", F.coalesce("seen", F.lit(False)))


@query("in_status", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P')")
def in_status(spark, d):
    return table(spark, d, "orders").where(F.col("o_orderstatus").isin("F", "P")).select("o_orderkey", "o_orderstatus")


@query("is_null", "SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL")
def is_null(spark, d):
    docs, labels = table(spark, d, "documents").select("doc_id"), table(spark, d, "labels").select("doc_id", "quality")
    return docs.join(labels, "doc_id", "left").where("quality is null").select("doc_id")


@query("not_like", "SELECT p_partkey, p_brand FROM part WHERE p_brand NOT LIKE 'Brand#1_'")
def not_like(spark, d):
    return table(spark, d, "part").where(~F.col("p_brand").like("Brand#1_")).select("p_partkey", "p_brand")


@query("range_filter", "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-06-01' AND o_orderdate < TIMESTAMP '1997-06-01'")
def range_filter(spark, d):
    return table(spark, d, "orders").where("o_orderdate >= timestamp'1996-06-01' and o_orderdate < timestamp'1997-06-01'").select("o_orderkey")


@query("fold_projection", "SELECT n_nationkey, lower(n_name) AS place FROM nation")
def fold_projection(spark, d):
    return table(spark, d, "nation").select("n_nationkey", F.lower("n_name").alias("place"))


@query(
    "array_any_match",
    "SELECT p_partkey FROM part WHERE p_brand = 'Brand#11' OR p_type = 'ECONOMY' OR split_part(p_name, ' ', 1) = 'Brand#11' OR p_brand = 'Brand#23'",
)
def array_any_match(spark, d):
    p = table(spark, d, "part").withColumn("head", F.split("p_name", " ")[0])
    hit = lookup.any_equals(["p_brand", "head"], F.lit("Brand#11")) | lookup.any_equals(["p_brand"], F.lit("Brand#23")) | lookup.any_equals(["p_type"], F.lit("ECONOMY"))
    return p.where(hit).select("p_partkey")


@query(
    "quantified_lists",
    "SELECT p_partkey, len(string_split(p_name, ' ')) > 0 AND list_bool_and(list_transform(string_split(p_name, ' '), lambda x: length(x) > 4)) AS all_long FROM part",
)
def quantified_lists(spark, d):
    return table(spark, d, "part").select("p_partkey", lookup.all_of(F.split("p_name", " "), lambda x: F.length(x) > 4).alias("all_long"))


@query(
    "asof_last_id",
    """SELECT e.event_id AS row_id, e.user_id AS custkey, o.when_ordered, o.last_id FROM events e LEFT JOIN LATERAL (
         SELECT CAST(o_orderdate AS DATE) AS when_ordered, max(o_orderkey) AS last_id FROM orders
         WHERE o_custkey = e.user_id AND CAST(o_orderdate AS DATE) <= CAST(e.ts AS DATE) GROUP BY 1 ORDER BY 1 DESC LIMIT 1) o ON true""",
)
def asof_last_id(spark, d):
    e = table(spark, d, "events").select(F.col("event_id").alias("row_id"), F.col("user_id").alias("custkey"), F.to_date("ts").alias("at"))
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("custkey"), F.to_date("o_orderdate").alias("when_ordered"), F.col("o_orderkey").alias("last_id"))
    return asof.latest_before(e, o, "custkey", "at", "when_ordered", "last_id").select("row_id", "custkey", "when_ordered", "last_id")


@query(
    "max_greatest",
    """SELECT o_custkey, max(CASE WHEN o_orderdate IS NOT NULL AND l_shipdate IS NOT NULL THEN greatest(o_orderdate, l_shipdate) END) AS last_seen
       FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""",
)
def max_greatest(spark, d):
    o, l = table(spark, d, "orders"), table(spark, d, "lineitem")
    last = F.max(lookup.unless_missing(F.col("o_orderdate"), F.col("l_shipdate"))).alias("last_seen")
    return o.join(l, o.o_orderkey == l.l_orderkey).groupBy("o_custkey").agg(last)


@query(
    "last_publication_default",
    """SELECT c_custkey, coalesce(m, TIMESTAMP '1900-01-01') AS last_seen FROM customer LEFT JOIN
       (SELECT o_custkey, max(o_orderdate) AS m FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON o_custkey = c_custkey""",
)
def last_publication_default(spark, d):
    last = table(spark, d, "orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("last_seen"))
    import datetime

    return lookup.with_default(table(spark, d, "customer").select("c_custkey"), last, "c_custkey", "last_seen", datetime.datetime(1900, 1, 1))


@query(
    "weighted_count",
    """SELECT l_suppkey, count(*) AS n, CAST(round(sum(l_discount) * 100) AS BIGINT) AS weight_hundredths FROM lineitem
       WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '1996-01-01' GROUP BY 1""",
)
def weighted_count(spark, d):
    l = table(spark, d, "lineitem").where("l_shipdate >= timestamp'1995-01-01' and l_shipdate < timestamp'1996-01-01'")
    return l.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.round(F.sum("l_discount") * 100).cast("long").alias("weight_hundredths"))


@query(
    "provider_period",
    "SELECT o_custkey, min(o_orderdate) AS first_seen, max(o_orderdate) AS last_seen FROM orders GROUP BY 1",
)
def provider_period(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_seen"), F.max("o_orderdate").alias("last_seen"))


@query("key_dedupe", "SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def key_dedupe(spark, d):
    return table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag").dropDuplicates()


@query("match_histogram", "SELECT l_returnflag || '/' || l_linestatus AS kind, count(*) AS n FROM lineitem GROUP BY 1")
def match_histogram(spark, d):
    return table(spark, d, "lineitem").groupBy(F.concat_ws("/", "l_returnflag", "l_linestatus").alias("kind")).agg(F.count("*").alias("n"))


@query(
    "bitmask_score",
    """SELECT l_orderkey, bit_or((CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END) | (CASE WHEN l_discount >= 0.05 THEN 2 ELSE 0 END)
         | (CASE WHEN l_tax >= 0.04 THEN 4 ELSE 0 END) | (CASE WHEN l_returnflag = 'R' THEN 8 ELSE 0 END)) AS score,
       bit_count(bit_or((CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END) | (CASE WHEN l_discount >= 0.05 THEN 2 ELSE 0 END)
         | (CASE WHEN l_tax >= 0.04 THEN 4 ELSE 0 END) | (CASE WHEN l_returnflag = 'R' THEN 8 ELSE 0 END))) AS items FROM lineitem GROUP BY 1""",
)
def bitmask_score(spark, d):
    tests = [F.col("l_quantity") > 25, F.col("l_discount") >= 0.05, F.col("l_tax") >= 0.04, F.col("l_returnflag") == "R"]
    flags = linkage.either(*[F.when(t, F.lit(1 << i)).otherwise(F.lit(0)) for i, t in enumerate(tests)])
    rows = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.bit_or(flags).alias("score"))
    return rows.withColumn("items", F.bit_count("score"))


@query(
    "best_of_ties",
    """SELECT l_partkey, l_orderkey, l_linenumber, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey
       ORDER BY l_quantity DESC, l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n = 1""",
)
def best_of_ties(spark, d):
    l = table(spark, d, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_quantity")
    first = F.min(F.struct((-F.col("l_quantity")).alias("q"), "l_orderkey", "l_linenumber")).alias("b")
    return l.groupBy("l_partkey").agg(first).select("l_partkey", "b.l_orderkey", "b.l_linenumber", (-F.col("b.q")).alias("l_quantity"))


@query(
    "report_summary",
    """SELECT o_orderpriority, count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_cents, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) // count(*) AS BIGINT) AS mean_cents, min(o_totalprice) AS least, max(o_totalprice) AS most,
       arg_max(o_totalprice, o_orderkey) AS last_value FROM orders GROUP BY 1""",
)
def report_summary(spark, d):
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    return table(spark, d, "orders").groupBy("o_orderpriority").agg(
        F.count("*").alias("n"), F.sum(cents).alias("total_cents"), F.floor(F.sum(cents) / F.count("*")).alias("mean_cents"), F.min("o_totalprice").alias("least"), F.max("o_totalprice").alias("most"),
        F.max_by("o_totalprice", "o_orderkey").alias("last_value"),
    )


@query(
    "vector_aggregates",
    """SELECT o_custkey, sum(k)::BIGINT AS total, max(k) AS most, min(k) AS least, count(DISTINCT k) AS distinct_values
       FROM (SELECT o_custkey, year(o_orderdate) AS k FROM orders) GROUP BY 1""",
)
def vector_aggregates(spark, d):
    v = table(spark, d, "orders").groupBy("o_custkey").agg(F.collect_list(F.year("o_orderdate").cast("long")).alias("v"))
    return v.select(
        "o_custkey", F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"), F.array_max("v").alias("most"),
        F.array_min("v").alias("least"), F.size(F.array_distinct("v")).cast("long").alias("distinct_values"),
    )


@query(
    "variant_explode_weight",
    """WITH v AS (SELECT p_partkey, list_slice(string_split(p_name || ' ' || p_type || ' ' || p_brand, ' '), 1, 1 + p_partkey % 4) AS a FROM part),
       r AS (SELECT p_partkey, len(a) AS n, unnest(a) AS variant, generate_subscripts(a, 1) AS i FROM v)
       SELECT p_partkey, CAST(i - 1 AS INTEGER) AS position, variant,
       CASE WHEN i = n THEN round(1 - (n - 1) * (floor(100.0 / n) / 100), 2) ELSE floor(100.0 / n) / 100 END AS weight FROM r""",
)
def variant_explode_weight(spark, d):
    tokens = F.split(F.concat_ws(" ", "p_name", "p_type", "p_brand"), " ")
    p = table(spark, d, "part").withColumn("tokens", F.slice(tokens, F.lit(1), (1 + F.col("p_partkey") % 4).cast("int")))
    return linkage.variant_rows(p, "tokens").select("p_partkey", "position", "variant", "weight")


@query(
    "interval_overlap",
    """WITH f AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS first FROM orders GROUP BY 1)
       SELECT o_orderkey, o.o_custkey FROM orders o JOIN f ON f.o_custkey = o.o_custkey
       WHERE CAST(o_orderdate AS DATE) >= first - INTERVAL 1 YEAR AND CAST(o_orderdate AS DATE) <= first + INTERVAL 1 YEAR""",
)
def interval_overlap(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"))
    first = o.groupBy("o_custkey").agg(F.min("day").alias("first"))
    hit = asof.overlaps(F.col("day"), F.col("day"), F.add_months("first", -12), F.add_months("first", 12))
    return o.join(first, "o_custkey").where(hit).select("o_orderkey", "o_custkey")


@query(
    "nearest_neighbour",
    """WITH e AS (SELECT vec_id, label, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings),
       q AS (SELECT * FROM e WHERE label = 0), p AS (SELECT * FROM e WHERE label = 1)
       SELECT row_id, vec_id, distance FROM (SELECT q.vec_id AS row_id, p.vec_id, (q.x - p.x) * (q.x - p.x) + (q.y - p.y) * (q.y - p.y) AS distance,
       row_number() OVER (PARTITION BY q.vec_id ORDER BY (q.x - p.x) * (q.x - p.x) + (q.y - p.y) * (q.y - p.y), p.vec_id) AS n
       FROM q JOIN p ON q.vec_id % 20 = p.vec_id % 20) WHERE n = 1""",
)
def nearest_neighbour(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", "label", F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    q = e.where("label = 0").select(F.col("vec_id").alias("row_id"), F.col("x").alias("qx"), F.col("y").alias("qy"), (F.col("vec_id") % 20).alias("area"))
    p = e.where("label = 1").select("vec_id", "x", "y", (F.col("vec_id") % 20).alias("area"))
    return lookup.nearest_by(q, p, "area", "vec_id").select("row_id", "vec_id", "distance")


@query(
    "change_detection",
    """SELECT s_suppkey, [x FOR x IN [CASE WHEN s_name IS DISTINCT FROM n THEN 's_name' END, CASE WHEN s_nationkey IS DISTINCT FROM k THEN 's_nationkey' END,
       CASE WHEN s_acctbal IS DISTINCT FROM b THEN 's_acctbal' END] IF x IS NOT NULL]::VARCHAR AS changed FROM
       (SELECT *, CASE WHEN s_suppkey % 3 = 0 THEN upper(s_name) ELSE s_name END AS n, CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE s_nationkey END AS k,
       CASE WHEN s_suppkey % 2 = 0 THEN s_acctbal + 1 ELSE s_acctbal END AS b FROM supplier)""",
)
def change_detection(spark, d):
    s = table(spark, d, "supplier")
    new = s.select(
        "s_suppkey", F.when(F.col("s_suppkey") % 3 == 0, F.upper("s_name")).otherwise(F.col("s_name")).alias("new_s_name"),
        F.when(F.col("s_suppkey") % 5 != 0, F.col("s_nationkey")).alias("new_s_nationkey"),
        F.when(F.col("s_suppkey") % 2 == 0, F.col("s_acctbal") + 1).otherwise(F.col("s_acctbal")).alias("new_s_acctbal"),
    )
    differs = lookup.changed_columns(["s_name", "s_nationkey", "s_acctbal"], "new_")
    return s.join(new, "s_suppkey").select("s_suppkey", F.concat(F.lit("["), F.array_join(differs, ", "), F.lit("]")).alias("changed"))


@query(
    "name_union_sorted",
    """SELECT c_nationkey, list_sort(list_distinct(list(c_mktsegment) || list(upper(substr(c_mktsegment, 1, 3)))))::VARCHAR AS alt_names FROM customer GROUP BY 1""",
)
def name_union_sorted(spark, d):
    g = table(spark, d, "customer").groupBy("c_nationkey").agg(F.collect_set("c_mktsegment").alias("a"), F.collect_set(F.upper(F.substring("c_mktsegment", 1, 3))).alias("b"))
    return g.select("c_nationkey", F.concat(F.lit("["), F.array_join(names.union_sorted(F.col("a"), F.col("b")), ", "), F.lit("]")).alias("alt_names"))


@query(
    "list_operators",
    """SELECT p_partkey, len(list_intersect(a, b)) AS common, array_to_string(list_sort(list_filter(a, lambda x: NOT list_contains(b, x))), ' ') AS only_first
       FROM (SELECT p_partkey, list_distinct(string_split(p_name, ' ')) AS a, list_distinct(string_split(p_type || ' ' || split_part(p_name, ' ', 1), ' ')) AS b FROM part)""",
)
def list_operators(spark, d):
    a, b = F.split("p_name", " "), F.split(F.concat_ws(" ", "p_type", F.split("p_name", " ")[0]), " ")
    return table(spark, d, "part").select("p_partkey", F.size(F.array_intersect(a, b)).cast("long").alias("common"), F.array_join(F.array_sort(F.array_except(a, b)), " ").alias("only_first"))


@query(
    "list_sort_fold",
    "SELECT n_regionkey, array_to_string(list_reverse_sort(list(lower(n_name))), ',') AS names FROM nation GROUP BY 1",
)
def list_sort_fold(spark, d):
    g = table(spark, d, "nation").groupBy("n_regionkey").agg(F.collect_list(F.lower("n_name")).alias("v"))
    return g.select("n_regionkey", F.array_join(text.sorted_list(F.col("v"), fold=True, descending=True), ",").alias("names"))


@query(
    "miss_streak",
    """SELECT l_orderkey, min(l_linenumber) AS stop_at FROM (SELECT l_orderkey, l_linenumber, sum(CASE WHEN l_returnflag <> 'N' THEN 1 ELSE 0 END)
       OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_returnflag ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS missed FROM lineitem) WHERE missed >= 3 GROUP BY 1""",
)
def miss_streak(spark, d):
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag").rowsBetween(-2, 0)
    l = table(spark, d, "lineitem").withColumn("missed", F.sum(F.when(F.col("l_returnflag") != "N", 1).otherwise(0)).over(w))
    return l.where("missed >= 3").groupBy("l_orderkey").agg(F.min("l_linenumber").alias("stop_at"))


@query("top_one", "SELECT o_custkey, arg_max(o_orderkey, (o_totalprice, -o_orderkey)) AS best_order FROM orders GROUP BY 1")
def top_one(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_totalprice", -F.col("o_orderkey"))).alias("best_order"))


@query(
    "next_surrogate_id",
    "SELECT c_custkey, (SELECT max(o_custkey) FROM orders) + row_number() OVER (ORDER BY c_custkey) AS new_id FROM customer WHERE c_mktsegment = 'BUILDING'",
)
def next_surrogate_id(spark, d):
    from lychgate.operators.maintain import numbered

    top = table(spark, d, "orders").agg(F.max("o_custkey")).first()[0] or 0
    c = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey")
    return numbered(c, "c_custkey", "new_id", top + 1)
