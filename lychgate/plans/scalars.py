"""Plans of scalar functions over the tables' strings, dates and numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from lychgate.functions import dates, geo, names, text
from lychgate.registry import query
from lychgate.sources.tables import table


@query("string_slices", "SELECT p_partkey, left(p_name, 4) AS l, right(p_name, 4) AS r, substr(p_name, 3, 5) AS m, substr(p_name, 4) AS dl, left(p_name, greatest(0, length(p_name) - 3)) AS dr FROM part")
def string_slices(spark, d):
    c = F.col("p_name")
    return table(spark, d, "part").select("p_partkey", F.left(c, F.lit(4)).alias("l"), F.right(c, F.lit(4)).alias("r"), text.middle(c, 3, 5).alias("m"), text.drop_left(c, 3).alias("dl"), text.drop_right(c, 3).alias("dr"))


@query(
    "accent_fold",
    """SELECT doc_id, replace(replace(replace(replace(replace(replace(replace(translate(text, 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ', 'aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY'), 'ß', 'ss'), 'œ', 'oe'), 'Œ', 'OE'),
       'æ', 'ae'), 'Æ', 'AE'), 'ﬁ', 'fi'), 'ﬂ', 'fl') AS plain FROM documents""",
)
def accent_fold(spark, d):
    return table(spark, d, "documents").select("doc_id", names.unaccent(F.col("text")).alias("plain"))


@query(
    "proper_case",
    """SELECT p_partkey, array_to_string(list_transform(string_split(lower(p_name || ' mcdonald'), ' '), lambda w: CASE WHEN w = 'mcdonald' THEN 'McDonald' ELSE upper(w[1]) || substr(w, 2) END), ' ') AS named FROM part""",
)
def proper_case(spark, d):
    return table(spark, d, "part").select("p_partkey", text.proper(F.concat("p_name", F.lit(" mcdonald"))).alias("named"))


@query("trim_family", "SELECT event_id, regexp_replace(regexp_replace(' ,' || event_type || '; ', '^[\\s,;:\\-]+|[\\s,;:\\-]+$', '', 'g'), 'x', 'x') AS ends, event_type AS inside, event_type || 's' AS owner FROM events")
def trim_family(spark, d):
    c = F.col("event_type")
    return table(spark, d, "events").select(
        "event_id", text.strip_ends(F.concat(F.lit(" ,"), c, F.lit("; "))).alias("ends"), text.strip_book_ends(F.concat(F.lit("(("), c, F.lit("))")), "((", "))").alias("inside"),
        text.strip_possessive(F.concat(c, F.lit("s'"))).alias("owner"),
    )


@query("hyphen_helpers", "SELECT p_partkey, split_part(p_name, ' ', 1) AS pre, substr(p_name, strpos(p_name, ' ') + 1) AS post, substr(replace(p_name, ' ', '-'), strpos(p_name, ' ') + 1) || '-' || split_part(p_name, ' ', 1) AS turned FROM part WHERE strpos(p_name, ' ') > 0")
def hyphen_helpers(spark, d):
    h = F.regexp_replace("p_name", " ", "-")
    p = table(spark, d, "part").where(F.contains("p_name", F.lit(" ")))
    return p.select("p_partkey", text.pre_hyphen(h).alias("pre"), F.replace(text.post_hyphen(h), F.lit("-"), F.lit(" ")).alias("post"), text.reciprocal(h).alias("turned"))


@query("string_classes", "SELECT p_partkey, regexp_full_match(p_type, '[A-Za-z]+') AS alpha, regexp_full_match(substr(p_brand, 7), '[0-9]+') AS number, p_type = upper(p_type) AND regexp_matches(p_type, '[A-Z]') AS caps, regexp_matches(p_name, '^[A-Z]') AS capital FROM part")
def string_classes(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", text.is_alpha(F.col("p_type")).alias("alpha"), text.is_numeric(F.substring("p_brand", 7, 9)).alias("number"), text.is_all_caps(F.col("p_type")).alias("caps"),
        text.is_capitalised(F.col("p_name")).alias("capital"),
    )


@query("number_parse", "SELECT o_orderkey, round(o_totalprice, 2) AS price, (o_orderkey % 100) / 100 AS share, 0.0::DOUBLE AS none, TRY_CAST(regexp_extract(o_orderpriority, '([0-9]+)', 1) AS BIGINT) AS level FROM orders")
def number_parse(spark, d):
    price = F.concat(F.lit("$"), F.format_number(F.round("o_totalprice", 2), 2))
    share = F.concat((F.col("o_orderkey") % 100).cast("string"), F.lit("%"))
    return table(spark, d, "orders").select(
        "o_orderkey", text.as_number(price).alias("price"), text.as_number(share).alias("share"), text.as_number(F.col("o_orderstatus")).alias("none"),
        text.first_number(F.col("o_orderpriority")).alias("level"),
    )


@query("id_codec", "SELECT p_partkey, translate(p_name || ',' || p_type, ' ,/', '_$#') AS id, p_name || ',' || p_type AS back FROM part")
def id_codec(spark, d):
    c = F.concat_ws(",", "p_name", "p_type")
    return table(spark, d, "part").select("p_partkey", text.to_id(c).alias("id"), text.from_id(text.to_id(c)).alias("back"))


@query("count_words", "SELECT doc_id, len(list_filter(regexp_split_to_array(text, '[ \\t\\n\\r\\f\\v]+'), lambda w: length(w) > 0)) AS n_words FROM documents")
def count_words(spark, d):
    return table(spark, d, "documents").select("doc_id", text.count_words(F.col("text")).cast("long").alias("n_words"))


@query(
    "first_difference",
    "SELECT c_custkey, coalesce(list_min(list_filter(range(1, greatest(length(a), length(b)) + 1), lambda i: substr(a, i, 1) <> substr(b, i, 1))), 0) AS place FROM (SELECT c_custkey, c_name AS a, 'Customer#' || lpad((c_custkey // 2 * 2)::VARCHAR, 9, '0') AS b FROM customer)",
)
def first_difference(spark, d):
    other = F.concat(F.lit("Customer#"), F.lpad((F.col("c_custkey") - F.col("c_custkey") % 2).cast("string"), 9, "0"))
    return table(spark, d, "customer").select("c_custkey", text.first_difference(F.col("c_name"), other).cast("long").alias("place"))


@query("tag_strip", r"SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->|<script.*?</script>|<style.*?</style>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '[ \t\n\r\f\v]+', ' ', 'g')) AS plain FROM pages")
def tag_strip(spark, d):
    return table(spark, d, "pages").select("page_id", text.strip_tags(F.col("html")).alias("plain"))


@query(
    "entity_unescape",
    """SELECT page_id, replace(replace(replace(replace(replace(replace(replace(html, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&apos;', ''''), '&nbsp;', ' '), '&amp;', '&') AS plain FROM pages""",
)
def entity_unescape(spark, d):
    return table(spark, d, "pages").select("page_id", text.unescape(F.col("html")).alias("plain"))


@query("tag_content", "SELECT page_id, nullif(regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1), '') AS title FROM pages")
def tag_content(spark, d):
    return table(spark, d, "pages").select("page_id", text.within(F.col("html"), "title").alias("title"))


@query("url_param", "SELECT page_id, regexp_extract(url || '?id=' || page_id || '&id=' || (page_id + 1), '.*[?&]id=([^&#]*)', 1) AS id, split_part(split_part(url, '://', 2), '/', 1) AS host FROM pages")
def url_param(spark, d):
    u = F.concat("url", F.lit("?id="), F.col("page_id").cast("string"), F.lit("&id="), (F.col("page_id") + 1).cast("string"))
    return table(spark, d, "pages").select("page_id", text.url_parameter(u, "id").alias("id"), F.parse_url("url", F.lit("HOST")).alias("host"))


@query("json_value", "SELECT event_id, nullif(regexp_extract(props, '\"k\"\\s*:\\s*\"?([^\",}\\]]*)', 1), '') AS k FROM events")
def json_value(spark, d):
    return table(spark, d, "events").select("event_id", text.json_value(F.col("props"), "k").alias("k"))


@query("number_format", "SELECT o_orderkey, format('{:,}', CAST(round(o_totalprice) AS BIGINT)) AS shown FROM orders")
def number_format(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.format_number(F.round("o_totalprice").cast("long"), 0).alias("shown"))


_DAYS = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(o_orderdate AS DATE) AS a, CAST(l_shipdate AS DATE) AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey"


def _days(spark, d):
    l, o = table(spark, d, "lineitem"), table(spark, d, "orders")
    return l.join(o, l.l_orderkey == o.o_orderkey).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.to_date("o_orderdate").alias("a"), F.to_date("l_shipdate").alias("b"))


@query("elapse_360", f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round((year(b) - year(a)) + (month(b) - month(a)) / 12 + (day(b) - day(a)) / 360, 6) AS years FROM ({_DAYS})")
def elapse_360(spark, d):
    return _days(spark, d).withColumn("years", F.round(dates.elapse_360(F.col("a"), F.col("b")), 6)).drop("a", "b")


def _place(c: str) -> str:
    return f"(year({c}) + (dayofyear({c}) - 1) / (CASE WHEN (year({c}) % 4 = 0 AND year({c}) % 100 <> 0) OR year({c}) % 400 = 0 THEN 366.0::DOUBLE ELSE 365.0::DOUBLE END))"


@query("elapse_actuarial", f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round({_place('b')} - {_place('a')}, 4) AS years FROM ({_DAYS})")
def elapse_actuarial(spark, d):
    return _days(spark, d).withColumn("years", dates.elapse_actuarial(F.col("a"), F.col("b"))).drop("a", "b")


@query(
    "month_round",
    """SELECT o_orderkey, d AS r0, CAST(CASE WHEN day(d) = 1 THEN d ELSE date_trunc('month', d) + INTERVAL 1 MONTH END AS DATE) AS r1, CAST(date_trunc('month', d) + INTERVAL 1 MONTH AS DATE) AS r2,
       last_day(d) AS r3, CASE WHEN d = last_day(d) THEN last_day(d + 1) ELSE last_day(d) END AS r4 FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
def month_round(spark, d):
    day = F.to_date("o_orderdate")
    return table(spark, d, "orders").select("o_orderkey", *[dates.month_round(day, i).alias(f"r{i}") for i in range(5)])


@query("date_extremes", "SELECT o_orderkey, greatest(CAST(o_orderdate AS DATE), DATE '1996-01-01', DATE '1995-05-05') AS latest, least(CAST(o_orderdate AS DATE), DATE '1996-01-01') AS earliest, strftime(o_orderdate, '%d/%m/%Y') AS shown FROM orders")
def date_extremes(spark, d):
    day, lit = F.to_date("o_orderdate"), lambda s: F.lit(s).cast("date")
    return table(spark, d, "orders").select("o_orderkey", F.greatest(day, lit("1996-01-01"), lit("1995-05-05")).alias("latest"), F.least(day, lit("1996-01-01")).alias("earliest"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("shown"))


@query(
    "numeric_dates",
    """SELECT o_orderkey, d AS ymd, CASE WHEN day(d) <= 12 THEN make_date(year(d), day(d), month(d)) ELSE d END AS dmy,
       CASE WHEN day(d) > 12 THEN 'HIGH' WHEN day(d) = month(d) THEN 'LIKELY' ELSE 'POSSIBLE' END AS conviction FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
def numeric_dates(spark, d):
    day, now = F.to_date("o_orderdate"), F.lit("2024-06-30").cast("date")
    y, m, n = F.year(day), F.month(day), F.day(day)
    dmy = dates.numeric_date(n, m, y, now)
    return table(spark, d, "orders").select("o_orderkey", dates.numeric_date(y, m, n, now)["date"].alias("ymd"), dmy["date"].alias("dmy"), dmy["conviction"].alias("conviction"))


@query(
    "birth_bounds",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN make_date(1900 + (c_custkey % 90)::INT, 1, 1) ELSE CAST(DATE '2010-03-15' - to_years((c_custkey % 90)::INT + 1) + INTERVAL 1 DAY AS DATE) END AS min_dob,
       CASE WHEN c_custkey % 3 = 0 THEN make_date(1900 + (c_custkey % 90)::INT, 12, 31) ELSE CAST(DATE '2010-03-15' - to_years((c_custkey % 90)::INT) AS DATE) END AS max_dob FROM customer""",
)
def birth_bounds(spark, d):
    k = (F.col("c_custkey") % 90).cast("int")
    birth_year = F.when(F.col("c_custkey") % 3 == 0, 1900 + k)
    none = F.lit(None)
    b = dates.dob_bounds(none.cast("date"), birth_year, F.lit("2010-03-15").cast("date"), none.cast("int"), k)
    return table(spark, d, "customer").select("c_custkey", b["min_dob"].alias("min_dob"), b["max_dob"].alias("max_dob"))


@query(
    "schedule_next",
    """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN d + INTERVAL 1 DAY + INTERVAL 5 HOUR
        WHEN 1 THEN d + to_days(CASE dayofweek(d) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END) + INTERVAL 5 HOUR
        ELSE date_trunc('month', d) + INTERVAL 1 MONTH + INTERVAL 14 DAY + INTERVAL 5 HOUR END AS next_run
       FROM (SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS d FROM orders)""",
)
def schedule_next(spark, d):
    option = F.element_at(F.array(F.lit(1), F.lit(2), F.lit(5)), (F.col("o_orderkey") % 3 + 1).cast("int"))
    run = dates.next_run(F.col("o_orderdate"), option, F.lit(2), F.lit(15), F.lit(0))
    return table(spark, d, "orders").select("o_orderkey", run.alias("next_run"))


@query(
    "haversine",
    """SELECT vec_id, CASE WHEN label = 0 THEN 9999999.0 ELSE round(2 * 6371.0 * asin(sqrt(pow(sin(radians(b - a) / 2), 2) + cos(radians(a)) * cos(radians(b)) * pow(sin(radians(20) / 2), 2))), 3) END AS km
       FROM (SELECT vec_id, label, vec_id % 80 + 1.0 AS a, 60.0 - vec_id % 50 AS b FROM embeddings)""",
)
def haversine(spark, d):
    k = F.col("vec_id")
    km = geo.haversine(F.when(F.col("label") != 0, k % 80 + 1.0), F.lit(10.0), 60.0 - k % 50, F.lit(30.0))
    return table(spark, d, "embeddings").select("vec_id", F.round(km, 3).alias("km"))


@query(
    "postal_province",
    """SELECT n_nationkey, CASE l WHEN 'A' THEN 'NL' WHEN 'B' THEN 'NS' WHEN 'C' THEN 'PE' WHEN 'E' THEN 'NB' WHEN 'G' THEN 'QC' WHEN 'H' THEN 'QC' WHEN 'J' THEN 'QC' WHEN 'K' THEN 'ON' WHEN 'L' THEN 'ON'
       WHEN 'M' THEN 'ON' WHEN 'N' THEN 'ON' WHEN 'P' THEN 'ON' WHEN 'R' THEN 'MB' WHEN 'S' THEN 'SK' WHEN 'T' THEN 'AB' WHEN 'V' THEN 'BC' WHEN 'X' THEN 'NT' WHEN 'Y' THEN 'YT' END AS province,
       CASE WHEN n_nationkey % 2 = 0 THEN 'QC' ELSE 'ON' END AS by_name FROM (SELECT n_nationkey, upper(n_name[1]) AS l FROM nation)""",
)
def postal_province(spark, d):
    named = F.when(F.col("n_nationkey") % 2 == 0, "Québec").otherwise("on")
    return table(spark, d, "nation").select("n_nationkey", geo.province_of_code(F.col("n_name")).alias("province"), geo.province_code(named).alias("by_name"))


@query(
    "date_pairs",
    """SELECT o_orderkey, d AS first, DATE '2000-05-20' AS second
       FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders) WHERE d <= DATE '2000-05-20'""",
)
def date_pairs(spark, d):
    day = F.to_date("o_orderdate")
    a = F.array(F.dayofmonth(day), F.month(day), F.year(day))
    p = dates.date_pair(a, F.array(F.lit(20), F.lit(5), F.lit(2000)), F.lit("2010-01-01").cast("date"))
    return table(spark, d, "orders").where(day <= F.lit("2000-05-20").cast("date")).select("o_orderkey", p["first"].alias("first"), p["second"].alias("second"))


@query(
    "date_repair",
    """SELECT l_orderkey, l_linenumber, l_partkey, least(a, b) AS birth, greatest(a, b) AS death, date_diff('year', least(a, b), greatest(a, b))
         - CASE WHEN month(greatest(a, b)) * 31 + day(greatest(a, b)) < month(least(a, b)) * 31 + day(least(a, b)) AND NOT (greatest(a, b) = last_day(greatest(a, b)) AND least(a, b) = last_day(least(a, b)) AND month(a) = month(b)) THEN 1 ELSE 0 END AS age,
       b < a AS swapped FROM (SELECT l_orderkey, l_linenumber, l_partkey, CAST(o_orderdate AS DATE) AS a, CAST(l_shipdate AS DATE) AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
)
def date_repair(spark, d):
    r = dates.repaired(F.col("a"), F.col("b"), F.lit(50))
    return _days(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", r["birth"].alias("birth"), r["death"].alias("death"), r["age"].alias("age"), F.array_contains(r["codes"], "swapped").alias("swapped"))


@query(
    "cursor_reads",
    """SELECT page_id, split_part(split_part(html, '<title>', 2), '</title>', 1) AS title, split_part(url, '://', 1) AS scheme, strpos(url, '/') AS slash, substr(url, strpos(url, '//') + 2) AS rest FROM pages WHERE strpos(html, '<title>') > 0""",
)
def cursor_reads(spark, d):
    p = table(spark, d, "pages").where(F.locate("<title>", F.col("html")) > 0)
    return p.select("page_id", text.between(F.col("html"), "<title>", "</title>").alias("title"), text.before(F.col("url"), "://").alias("scheme"), text.nth_position(F.col("url"), "/", 1).cast("long").alias("slash"), text.after(F.col("url"), "//").alias("rest"))


@query("occurrences", "SELECT doc_id, len(regexp_extract_all(' ' || regexp_replace(lower(text), '[^\\p{L}]+', '  ', 'g') || ' ', ' the ')) AS n FROM documents")
def occurrences(spark, d):
    return table(spark, d, "documents").select("doc_id", text.occurrences(F.col("text"), "the").cast("long").alias("n"))


@query("list_by_length", "SELECT n_regionkey, array_to_string(list_transform(list_sort(list((length(n_name), n_name))), lambda x: x[2]), ',') AS names FROM nation GROUP BY 1")
def list_by_length(spark, d):
    g = table(spark, d, "nation").groupBy("n_regionkey").agg(F.collect_list("n_name").alias("v"))
    return g.select("n_regionkey", F.array_join(text.by_length(F.col("v")), ",").alias("names"))
