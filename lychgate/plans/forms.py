"""Plans of addresses, number lists, markup and written dates, word classes, dates with precedence, and run counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from lychgate.functions import markup, urls, vectors
from lychgate.operators import lexicon, maintain, precedence
from lychgate.registry import query
from lychgate.sources.scratch import folder
from lychgate.sources.tables import table


@query(
    "url_filled",
    """SELECT o_orderkey, 'https://a.example/' || o_orderkey || '?d=' || strftime(o_orderdate, '%d/%m/%Y') || '&m=' || strftime(o_orderdate, '%Y%m') AS url,
       'b/' || month(o_orderdate) || '/' || strftime(o_orderdate, '%B') || '/%p%' AS short, CAST(o_orderdate AS DATE) AS day FROM orders""",
)
def url_filled(spark, d):
    day = F.to_date("o_orderdate")
    number = F.datediff(day, F.lit("1858-11-17").cast("date")) + 2_400_001
    return table(spark, d, "orders").select(
        "o_orderkey", urls.filled(F.lit("https://a.example/%p%?d=%p%&m=%p%"), F.col("o_orderkey"), urls.dated(day, "dd/MM/yyyy"), urls.dated(day, "yyyyMM")).alias("url"),
        urls.filled(F.lit("b/%p%/%p%/%p%"), F.lit(""), urls.dated(day, "M"), urls.dated(day, "MMMM")).alias("short"), urls.julian(number).alias("day"),
    )


@query(
    "url_address",
    """SELECT page_id, CASE WHEN len(string_split(url, '//')) > 2 THEN NULL ELSE split_part(url, '//', 1) || '//www.' || regexp_replace(split_part(url, '//', 2), '^www\\.', '') END AS full_url,
       CASE WHEN len(string_split(url, '//')) > 2 THEN NULL ELSE 'http://' || regexp_replace(split_part(url, '//', 2), '^www\\.', '') END AS bare_url FROM pages""",
)
def url_address(spark, d):
    rest = F.substring_index("url", "//", -1)
    bare = F.when(F.size(F.split("url", "//", -1)) == 2, urls.address(rest, "http:", ""))
    return table(spark, d, "pages").select("page_id", urls.address(F.col("url"), "https:").alias("full_url"), bare.alias("bare_url"))


@query(
    "vector_arithmetic",
    """SELECT p_partkey, p_size + 2.0 AS added, p_retailprice - 0.5 AS taken, p_size * 2.0 AS product, CASE WHEN p_size = 1 THEN NULL ELSE 2.0 / (p_size - 1) END AS quotient,
       greatest(p_size, 25)::DOUBLE AS high, least(p_retailprice, 1000.0) AS low, 1.0 / p_size AS inverse, pow(2.0, p_size % 5) AS raised, CAST(NULL AS DOUBLE) AS uneven,
       list_sort([p_size, 10, 20])::VARCHAR AS placed FROM part""",
)
def vector_arithmetic(spark, d):
    size, price = F.col("p_size").cast("double"), F.col("p_retailprice").cast("double")
    a, b = F.array(size, price), F.array(F.lit(2.0), F.lit(0.5))
    placed = vectors.sorted_with(F.array(F.lit(10), F.lit(20)), F.col("p_size").cast("int"))
    return table(spark, d, "part").select(
        "p_partkey", vectors.plus(a, b)[0].alias("added"), vectors.minus(a, b)[1].alias("taken"), vectors.times(a, b)[0].alias("product"),
        vectors.over(F.array(F.lit(2.0)), F.array(size - 1))[0].alias("quotient"), vectors.greatest(a, F.array(F.lit(25.0), F.lit(0.0)))[0].alias("high"),
        vectors.least(a, F.array(F.lit(0.0), F.lit(1000.0)))[1].alias("low"), vectors.inverse(a)[0].alias("inverse"), vectors.power(F.lit(2.0), F.array(F.col("p_size") % 5))[0].alias("raised"),
        vectors.plus(a, F.array(F.lit(1.0)))[0].alias("uneven"), F.concat(F.lit("["), F.array_join(placed, ", "), F.lit("]")).alias("placed"),
    )


@query(
    "character_references",
    "SELECT p_partkey, 'é' || p_name || 'éé€&lt; &nosuch; & ' || p_brand || ' ' AS plain FROM part",
)
def character_references(spark, d):
    c = F.concat(F.lit("&eacute;"), "p_name", F.lit("&#233;&#xE9;&euro;&amp;lt; &nosuch; & "), "p_brand", F.lit("&nbsp;"))
    return table(spark, d, "part").select("p_partkey", markup.entities(c).alias("plain"))


@query("link_removal", "SELECT page_id, regexp_replace(html, '(?is)<a\\b[^>]*>.*?</a>', '', 'g') AS rest FROM pages")
def link_removal(spark, d):
    return table(spark, d, "pages").select("page_id", markup.without_links(F.col("html")).alias("rest"))


@query(
    "plain_dates",
    """SELECT o_orderkey, 'on ' || year(o_orderdate) || '/' || strftime(o_orderdate, '%m/%d') || ', or ' || strftime(o_orderdate, '%B') || ' ' || day(o_orderdate) || ', ' || year(o_orderdate) || ' there' AS written,
       'St. A B (c) ' || o_orderstatus AS pointless, o_orderkey AS digits, o_orderstatus || ' d' AS outside, ' ' || o_orderstatus AS named FROM orders""",
)
def plain_dates(spark, d):
    day = F.to_date("o_orderdate")
    c = F.concat(F.lit("on "), F.date_format(day, "yyyy-MM-dd"), F.lit(", or "), F.date_format(day, "MMMM-d-yyyy"), F.lit(" there"))
    return table(spark, d, "orders").select(
        "o_orderkey", markup.plain_dates(c).alias("written"), markup.without_inner_points(markup.even_brackets(F.concat(F.lit("St. A. B) (c) "), "o_orderstatus"))).alias("pointless"),
        markup.all_digits(F.concat(F.lit("no "), F.col("o_orderkey").cast("string"), F.lit("x"))).alias("digits"),
        markup.without_bracketed(F.concat("o_orderstatus", F.lit(" (b c) d"))).alias("outside"), markup.without_celebration(F.concat(F.lit("Celebration of Life for "), "o_orderstatus")).alias("named"),
    )


@query(
    "date_ranges",
    "SELECT l_orderkey, l_linenumber, l_linenumber % 3 <> 0 AS pure, l_linenumber % 3 = 1 AS english FROM lineitem",
)
def date_ranges(spark, d):
    a, b = F.to_date("l_shipdate"), F.date_add(F.to_date("l_shipdate"), 9000)
    english = F.concat(F.date_format(a, "MMMM d, yyyy"), F.lit(" - "), F.date_format(b, "MMMM d, yyyy"))
    french = F.concat(F.dayofmonth(a), F.lit(" février "), F.year(a), F.lit(" - "), F.dayofmonth(b), F.lit(" août "), F.year(b))
    c = F.when(F.col("l_linenumber") % 3 == 1, english).when(F.col("l_linenumber") % 3 == 2, french).otherwise(F.concat(english, F.lit(".")))
    lang = markup.range_language(c)  # read once for both
    told = lambda is_: F.when(c.isNotNull(), is_)
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", told(lang.isNotNull()).alias("pure"), told(lang.eqNullSafe(F.lit("en"))).alias("english"))


_LEXICON_SQL = ", ".join(f"('{k}', '{lang}', '{w}')" for k, lang, w, _ in lexicon.entries())


@query(
    "word_classes",
    f"""SELECT doc_id, kind, language, count(*) AS n FROM (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}]+'), lambda x: length(x) > 0)) AS word FROM documents)
        JOIN (VALUES {_LEXICON_SQL}) l(kind, language, entry) ON word = entry GROUP BY 1, 2, 3""",
)
def word_classes(spark, d):
    return lexicon.counts(table(spark, d, "documents"), "doc_id", "text", lexicon.lexicon(spark))


@query(
    "date_precedence",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN k = 1 AND day <> known THEN known WHEN k = 2 AND day <= known THEN day WHEN k = 2 THEN NULL ELSE day END AS dob,
         CASE WHEN k = 2 AND day > known AND day <= known + 366 THEN day WHEN k = 2 AND day > known THEN known WHEN k = 1 AND day <> known THEN NULL ELSE day END AS high,
         CASE WHEN k = 2 AND day > known + 366 THEN year(known) WHEN k = 2 AND day > known THEN 0 WHEN k = 1 AND day <> known THEN year(known) ELSE year(day) END AS yob,
         CASE WHEN k = 1 AND day <> known THEN 12 WHEN k = 2 AND day > known AND day <= known + 366 THEN 6 ELSE 0 END AS flag,
         CASE WHEN k = 0 THEN day WHEN year(known) < 1994 THEN day ELSE known END AS dod
       FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linenumber % 3 AS k, CAST(l_shipdate AS DATE) AS day, CAST(o_orderdate AS DATE) AS known FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
)
def date_precedence(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("l_linenumber") % 3).alias("k"), F.to_date("l_shipdate").alias("day"), F.to_date("o_orderdate").alias("known"))
    k, known, nothing = F.col("k"), F.col("known"), F.lit(None)
    # Rows know a birth (1), only that it was in the years up to a day (2), or nothing (0); all but the last know a death.
    record = precedence.dates(F.when(k == 1, known), F.when(k == 2, F.lit("1900-01-02").cast("date")), F.when(k == 2, known), F.when(k != 0, F.year(known)), nothing)
    dead = precedence.dates(nothing, nothing, nothing, nothing, F.when(k != 0, known))
    as_of = F.lit("2019-01-01").cast("date")
    rows = rows.withColumn("born", precedence.set_birth(record, F.col("day"), as_of)).withColumn("died", precedence.set_death(dead, F.col("day"), as_of))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "born.dob", "born.high", F.col("born.yob").cast("long").alias("yob"), "born.flag", "died.dod")


@query(
    "run_statistics",
    "SELECT count(*) AS read, count(*) FILTER (WHERE o_orderstatus = 'F') AS loaded, count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1997-01-01') AS recent, count(*) AS written FROM orders",
)
def run_statistics(spark, d):
    rows, told = maintain.observed(table(spark, d, "orders"), loaded=F.col("o_orderstatus") == "F", recent=F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp"))
    path = folder(spark, "orders-read")
    rows.write.mode("overwrite").parquet(path)
    return spark.createDataFrame([told.get | {"written": spark.read.parquet(path).count()}], "read long, loaded long, recent long, written long")


@query(
    "insert_missing",
    """WITH old AS (SELECT s_suppkey AS id, s_name AS name FROM supplier), new AS (SELECT DISTINCT c_mktsegment AS name FROM customer UNION SELECT s_name FROM supplier)
       SELECT id, name FROM old UNION ALL SELECT (SELECT max(id) FROM old) + row_number() OVER (ORDER BY name) AS id, name FROM new WHERE name NOT IN (SELECT name FROM old)""",
)
def insert_missing(spark, d):
    old = table(spark, d, "supplier").select(F.col("s_suppkey").cast("long").alias("id"), F.col("s_name").alias("name"))
    new = table(spark, d, "customer").select(F.col("c_mktsegment").alias("name")).distinct().union(old.select("name"))
    return maintain.insert_missing(old, new, "id", "name", "name")
