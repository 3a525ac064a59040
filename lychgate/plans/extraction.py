"""Plans of text evidence. Sentences of notices are made from orders, so that their facts are known; word
statistics run over documents."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from lychgate.functions import personal
from lychgate.functions import text as T
from lychgate.operators import extract as X
from lychgate.operators import phrases as P
from lychgate.registry import query
from lychgate.sources.tables import table


def _in(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


_FACTS = "f AS (SELECT o_orderkey, born, CAST(born + to_years(years) AS DATE) AS died, years FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS born, (o_orderkey % 90 + 1)::INT AS years FROM orders))"
_WORDS_SQL = "w AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}]+'), lambda x: length(x) > 0)) AS word FROM documents)"


@query("word_frequency", f"WITH {_WORDS_SQL} SELECT word, count(*) AS n FROM w GROUP BY 1")
def word_frequency(spark, d):
    return table(spark, d, "documents").select(F.explode(T.words(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


_LANG_SQL = f"""{_WORDS_SQL}, n AS (SELECT doc_id, count(*) FILTER (WHERE word IN {_in(X.LANGUAGE_WORDS['en'])}) AS en, count(*) FILTER (WHERE word IN {_in(X.LANGUAGE_WORDS['fr'])}) AS fr,
 count(*) FILTER (WHERE word IN {_in(X.LANGUAGE_WORDS['es'])}) AS es FROM w GROUP BY 1)"""


@query(
    "lang_vote",
    f"WITH {_LANG_SQL} SELECT doc_id, CASE WHEN coalesce(en + fr + es, 0) = 0 THEN NULL WHEN fr > en AND fr >= es THEN 'fr' WHEN es > en AND es > fr THEN 'es' ELSE 'en' END AS vote FROM documents LEFT JOIN n USING (doc_id)",
)
def lang_vote(spark, d):
    return table(spark, d, "documents").select("doc_id", X.language_vote(F.col("text")).alias("vote"))


@query(
    "bilingual_flag",
    f"""WITH {_LANG_SQL} SELECT doc_id, coalesce((en >= 5)::INT + (fr >= 5)::INT + (es >= 5)::INT, 0) + CASE WHEN coalesce(en + fr + es, 0) > 0 AND lang IN ('en', 'fr', 'es') AND
        lang <> CASE WHEN fr > en AND fr >= es THEN 'fr' WHEN es > en AND es > fr THEN 'es' ELSE 'en' END THEN 10 ELSE 0 END AS counted FROM documents LEFT JOIN n USING (doc_id)""",
)
def bilingual_flag(spark, d):
    known = F.when(F.col("lang").isin("en", "fr", "es"), F.col("lang"))
    return table(spark, d, "documents").select("doc_id", X.languages_counted(F.col("text"), known).alias("counted"))


_GENDER_SQL = f"""{_LANG_SQL}, l AS (SELECT doc_id, CASE WHEN fr > en AND fr >= es THEN 'fr' WHEN es > en AND es > fr THEN 'es' WHEN en > 0 THEN 'en' END AS lang FROM n),
 g AS (SELECT doc_id, count(*) FILTER (WHERE (lang = 'en' AND word IN ('he', 'his', 'him', 'father', 'husband', 'son', 'brother', 'grandfather', 'uncle')) OR (lang = 'fr' AND word IN ('il', 'père', 'époux', 'fils', 'frère'))
  OR (lang = 'es' AND word IN ('él', 'padre', 'esposo', 'hijo', 'hermano'))) AS m, count(*) FILTER (WHERE (lang = 'en' AND word IN ('she', 'her', 'hers', 'mother', 'wife', 'daughter', 'sister', 'grandmother', 'aunt'))
  OR (lang = 'fr' AND word IN ('elle', 'mère', 'épouse', 'fille', 'soeur')) OR (lang = 'es' AND word IN ('ella', 'madre', 'esposa', 'hija', 'hermana'))) AS f FROM w JOIN l USING (doc_id) GROUP BY 1)"""


@query("gender_vote", f"WITH {_GENDER_SQL} SELECT doc_id, CASE WHEN m > f + 3 THEN 'M' WHEN f > m + 3 THEN 'F' END AS gender FROM documents LEFT JOIN g USING (doc_id)")
def gender_vote(spark, d):
    return table(spark, d, "documents").select("doc_id", X.gender_vote(F.col("text")).alias("gender"))


@query(
    "deity_correction",
    """WITH p AS (SELECT o_orderkey, CASE WHEN o_orderkey % 8 = 0 THEN 'F' ELSE 'M' END AS gender, o_orderkey % 5 <> 0 AS deity, o_orderkey % 23 AS m, o_orderkey % 4 AS f, o_orderkey % 41 / 40.0::DOUBLE AS share FROM orders),
       q AS (SELECT *, CASE WHEN f > 0 AND m > 15 THEN greatest(0, f - (m - 10) // 5) ELSE f END AS net FROM p)
       SELECT o_orderkey, CASE WHEN gender = 'M' AND deity AND share < 0.75 THEN CASE WHEN net = 0 THEN CASE WHEN share < 0.025 THEN 'F' WHEN share < 0.1 THEN NULL ELSE 'M' END
         WHEN net = 1 THEN CASE WHEN share < 0.05 THEN 'F' WHEN share < 0.2 THEN NULL ELSE 'M' END WHEN net = 2 THEN NULL ELSE 'F' END ELSE gender END AS gender FROM q""",
)
def deity_correction(spark, d):
    k = F.col("o_orderkey")
    text = F.when(k % 5 != 0, "He went to be with the Lord.").otherwise("He went home.")
    got = X.deity_corrected(F.when(k % 8 == 0, "F").otherwise("M"), text, k % 23, k % 4, k % 41 / 40)
    return table(spark, d, "orders").select("o_orderkey", got.alias("gender"))


@query(
    "ordered_gender",
    """SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'F' WHEN c_custkey % 3 = 0 THEN 'M' WHEN c_custkey % 3 = 1 THEN 'F' WHEN c_custkey % 7 < 2 THEN CASE WHEN c_custkey % 7 = 0 THEN 'F' ELSE 'M' END END AS gender,
       CASE WHEN c_custkey % 4 = 0 THEN 'swap' WHEN c_custkey % 4 = 3 THEN 'unsure' ELSE 'keep' END AS name_order FROM customer""",
)
def ordered_gender(spark, d):
    k = F.col("c_custkey")
    name = F.when(k % 5 == 0, "Mrs. Ann Roy").otherwise("Ann Roy")
    text = F.when(k % 3 == 0, "Beloved husband of Ann, loving father of two and dear brother; a wife mourns.").when(k % 3 == 1, "Devoted MOTHER of Al.").otherwise("Loving mother, devoted father.")
    share = F.when(k % 7 == 0, 0.05).when(k % 7 == 1, 0.95).otherwise(0.5)
    count = lambda *n: F.element_at(F.array(*map(F.lit, n)), (k % 4 + 1).cast("int"))
    order = X.name_order(count(1, 50, 5, 2), count(40, 2, 30, 4), count(60, 3, 9, 5), count(5, 70, 20, 3))
    return table(spark, d, "customer").select("c_custkey", X.gender_by_evidence(X.title_gender(name), X.relation_gender(text), X.gender_by_share(share)).alias("gender"), order.alias("name_order"))


@query(
    "numeric_dates",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS first_date, CASE WHEN day(o_orderdate) > 12 OR day(o_orderdate) = month(o_orderdate) THEN CAST(o_orderdate AS DATE) ELSE make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate)) END AS second_date,
       CASE WHEN day(o_orderdate) > 12 THEN 'HIGH' WHEN day(o_orderdate) = month(o_orderdate) THEN 'LIKELY' ELSE 'POSSIBLE' END AS conviction, 3 AS n, 1900 + (o_orderkey % 90)::INT AS year_alone FROM orders""",
)
def numeric_dates(spark, d):
    day, as_of = F.to_date("o_orderdate"), F.lit("2020-06-01").cast("date")
    alone = 1900 + F.col("o_orderkey") % 90
    text = F.concat(F.lit("Seen "), F.date_format(day, "yyyy-MM-dd"), F.lit(", again "), F.date_format(day, "dd/MM/yyyy"), F.lit(" and 25.12.1999, not 1.2.3.4 or 31/31/2000, in "), alone.cast("string"), F.lit(" or 1492."))
    found = X.numeric_dates(text, as_of)
    at = lambda n, f: F.get(found, F.lit(n))[f]
    return table(spark, d, "orders").select(
        "o_orderkey", at(0, "date").alias("first_date"), at(1, "date").alias("second_date"), at(1, "conviction").alias("conviction"), F.size(found).alias("n"), F.get(X.years_in(text, as_of), F.lit(0)).alias("year_alone")
    )


@query(
    "partial_dates",
    f"""WITH {_FACTS} SELECT o_orderkey, month(born)::INT AS month, day(born)::INT AS day, 9900 + month(born)::INT AS code, 2 AS n, 2 AS open_sentences,
        CASE o_orderkey % 3 WHEN 0 THEN (o_orderkey % 800) // 365 WHEN 1 THEN (o_orderkey % 800) // 52 ELSE (o_orderkey % 800) // 12 END::INT AS units FROM f""",
)
def partial_dates(spark, d):
    n, k = notices(spark, d), F.col("o_orderkey")
    text = F.concat(F.lit("A gathering on "), F.date_format("born", "MMMM d"), F.lit(". Then on 3 mai, as on "), F.date_format("died", "MMMM d, yyyy"), F.lit(". Again on "), F.date_format("born", "MMMM d, yyyy"), F.lit("."))
    found, one = X.partial_dates(text), F.get(X.partial_dates(text), F.lit(0))
    unit = F.element_at(F.array(F.lit("days"), F.lit("weeks"), F.lit("months")), (k % 3 + 1).cast("int"))
    units = X.age_in_units(F.concat(F.lit("He was "), (k % 800).cast("string"), F.lit(" "), unit, F.lit(" old.")))
    return n.select("o_orderkey", one["month"].alias("month"), one["day"].alias("day"), one["code"].alias("code"), F.size(found).alias("n"), F.size(X.age_sentences(text, F.col("died"))).alias("open_sentences"), units.alias("units"))


_TIMES = "regexp_replace(regexp_replace(text, '(^|[^\\p{L}])(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Sept|Oct|Nov|Dec)\\.([ \\t\\n\\r\\f\\v]+[0-9])', '\\1\\2' || chr(1) || '\\3', 'g'), '(^|[^\\p{L}])([AaPp]\\.[Mm])\\.([ \\t\\n\\r\\f\\v]+(?:[^\\p{Lu} \\t\\n\\r\\f\\v]|Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday))', '\\1\\2' || chr(1) || '\\3', 'g')"
_MARK = f"regexp_replace(regexp_replace({_TIMES}, '(^|[^\\p{{L}}])(Mr|Mrs|Ms|Dr|St|Rev|Jr|Sr|Mme|Mlle|M|Ave|No|\\p{{Lu}})\\.', '\\1\\2' || chr(1), 'g'), '([.!?])[ \\t\\n\\r\\f\\v]+', '\\1' || chr(2), 'g')"
_SENTENCES_SQL = f"s AS (SELECT doc_id, list_filter(list_transform(string_split({_MARK}, chr(2)), lambda x: trim(replace(x, chr(1), '.'))), lambda x: length(x) > 0) AS parts FROM documents)"


@query("sentence_split", f"WITH {_SENTENCES_SQL} SELECT doc_id, len(parts) AS n, parts[1] AS head FROM s")
def sentence_split(spark, d):
    s = T.sentences(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.size(s).cast("long").alias("n"), F.try_element_at(s, F.lit(1)).alias("head"))


@query(
    "first_word_rank",
    f"""WITH {_SENTENCES_SQL}, f AS (SELECT doc_id, regexp_extract(unnest(parts), '^(\\p{{L}}+)', 1) AS word FROM s), n AS (SELECT doc_id, word, count(*) AS n FROM f WHERE word <> '' GROUP BY 1, 2)
        SELECT doc_id, word, n FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, word) AS r FROM n) WHERE r = 1""",
)
def first_word_rank(spark, d):
    words = table(spark, d, "documents").select("doc_id", F.explode(T.sentences(F.col("text"))).alias("s"))
    n = words.select("doc_id", F.regexp_extract("s", r"^(\p{L}+)", 1).alias("word")).where("word != ''").groupBy("doc_id", "word").agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("m"), "word")).alias("b")
    return n.groupBy("doc_id").agg(best).select("doc_id", "b.word", (-F.col("b.m")).alias("n"))


def notices(spark, d):
    """A notice an order: born on its date, died so many years later, with age, spouse and service."""
    k = F.col("o_orderkey")
    born = F.to_date("o_orderdate")
    years = (k % 90 + 1).cast("int")
    died = F.add_months(born, years * 12)
    said = F.date_add(died, 5)
    long = lambda c: F.concat(F.date_format(c, "MMMM d"), F.lit(", "), F.date_format(c, "yyyy"))
    french = F.concat(F.dayofmonth(born).cast("string"), F.lit(" "), F.element_at(F.array(*[F.lit(m) for m in X.MONTHS["fr"]]), F.month(born)), F.lit(" "), F.year(born).cast("string"))
    text = F.concat(
        F.when(k % 5 == 0, F.concat(F.lit("Née le "), french)).otherwise(F.concat(F.lit("She was born on "), long(born))), F.lit(". Dr. A. Field wrote this. She passed away on "), long(died),
        F.when(k % 3 == 0, F.concat(F.lit(" in her "), (years + 1).cast("string"), F.lit("th year."))).otherwise(F.concat(F.lit(" aged "), years.cast("string"), F.lit("."))),
        F.when(k % 2 == 0, F.lit(" Beloved wife of 40 years, Robert.")).otherwise(F.lit(" She was married in 1990.")), F.lit(" The funeral takes place on "), long(said), F.lit("."),
    )
    return table(spark, d, "orders").select("o_orderkey", born.alias("born"), died.alias("died"), years.alias("years"), text.alias("text"))




@query("born_died_assoc", f"WITH {_FACTS} SELECT o_orderkey, born, died FROM f")
def born_died_assoc(spark, d):
    return notices(spark, d).select("o_orderkey", X.dates_near(F.col("text"), born=X.BORN, died=X.DIED).alias("d")).select("o_orderkey", "d.born", "d.died")


@query("service_date", f"WITH {_FACTS} SELECT o_orderkey, died + 5 AS service FROM f")
def service_date(spark, d):
    return notices(spark, d).select("o_orderkey", X.service_date(F.col("text")).alias("service"))


@query("date_extract", f"WITH {_FACTS} SELECT o_orderkey, 3::BIGINT AS n, born AS first_date FROM f")
def date_extract(spark, d):
    dates = X.written_dates(F.col("text"))
    return notices(spark, d).select("o_orderkey", F.size(dates).cast("long").alias("n"), F.try_element_at(dates, F.lit(1)).alias("first_date"))


@query("age_extract", f"WITH {_FACTS} SELECT o_orderkey, years AS age FROM f")
def age_extract(spark, d):
    return notices(spark, d).select("o_orderkey", X.age(F.col("text")).alias("age"))


@query("spouse_extract", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'Robert' END AS spouse, CASE WHEN o_orderkey % 2 = 0 THEN 40 ELSE 30 END AS married FROM orders")
def spouse_extract(spark, d):
    t = F.col("text")
    return notices(spark, d).select("o_orderkey", X.spouse(t).alias("spouse"), X.years_married(t, F.lit(2020)).alias("married"))


@query("record_validation", f"WITH {_FACTS} SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'age_differs' ELSE '' END AS codes FROM f")
def record_validation(spark, d):
    n = notices(spark, d)
    wrong = F.col("years") + F.when(F.col("o_orderkey") % 7 == 0, 5).otherwise(0)
    return n.select("o_orderkey", F.array_join(X.valid_record(F.col("born"), F.col("died"), wrong), ",").alias("codes"))


@query(
    "structured_names",
    """SELECT c_custkey, 'Last' || (c_custkey % 7) AS last, 'Anna' AS first, CASE WHEN c_custkey % 2 = 0 THEN 'Maria' ELSE '' END AS middle, CASE WHEN c_custkey % 3 = 0 THEN 'Gray' ELSE '' END AS maiden, CASE WHEN c_custkey % 5 = 0 THEN 'F' END AS gender FROM customer""",
)
def structured_names(spark, d):
    k = F.col("c_custkey")
    last = F.concat(F.lit("Last"), (k % 7).cast("string"))
    mid = F.when(k % 2 == 0, " Maria").otherwise("")
    name = F.when(k % 4 < 2, F.concat(last, F.lit(", Anna"), mid)).otherwise(F.concat(F.lit("Anna"), mid, F.lit(" "), last))
    name = F.concat(F.when(k % 5 == 0, "Mrs. ").otherwise(""), name, F.when(k % 3 == 0, " (née Gray)").otherwise(""))
    p = X.name_parts(name)
    maiden = F.coalesce(F.try_element_at(X.alternates(name), F.lit(1)), F.lit(""))
    return table(spark, d, "customer").select("c_custkey", p["last"].alias("last"), p["first"].alias("first"), p["middle"].alias("middle"), maiden.alias("maiden"), X.title_gender(name).alias("gender"))


@query("year_pairs", "SELECT c_custkey, 1900 + (c_custkey % 50)::INT AS yob, 1980 + (c_custkey % 40)::INT AS yod FROM customer")
def year_pairs(spark, d):
    k = F.col("c_custkey")
    text = F.concat(F.lit("In memory "), (1900 + k % 50).cast("string"), F.when(k % 2 == 0, "-").otherwise(" ~ "), (1980 + k % 40).cast("string"), F.lit(" at rest"))
    p = X.year_pair(text)
    return table(spark, d, "customer").select("c_custkey", p["yob"].alias("yob"), p["yod"].alias("yod"))


@query(
    "scrape_rules",
    """SELECT page_id, 'title' AS field, regexp_extract(html, '<title>([^<]*)</title>', 1) AS value FROM pages WHERE regexp_extract(html, '<title>([^<]*)</title>', 1) <> ''
       UNION ALL SELECT page_id, 'heading', regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1) FROM pages WHERE regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1) <> ''
       UNION ALL SELECT page_id, 'paragraph', regexp_extract(html, '<p[^>]*>([^<]*)</p>', 1) FROM pages WHERE regexp_extract(html, '<p[^>]*>([^<]*)</p>', 1) <> ''""",
)
def scrape_rules(spark, d):
    rules = [("title", "<title>([^<]*)</title>"), ("heading", "<h1[^>]*>([^<]*)</h1>"), ("paragraph", "<p[^>]*>([^<]*)</p>")]
    return X.apply_rules(table(spark, d, "pages").select("page_id", "html"), rules, "html").select("page_id", "field", "value")


@query(
    "evidence_arbitration",
    """SELECT l_orderkey AS key, l_returnflag AS field, value FROM (SELECT l_orderkey, l_returnflag, CAST(l_shipdate AS DATE) AS value,
       row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber, CAST(l_shipdate AS DATE)) AS n FROM lineitem) WHERE n = 1""",
)
def evidence_arbitration(spark, d):
    e = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_returnflag").alias("field"), F.to_date("l_shipdate").alias("value"), "l_linenumber")
    return X.by_priority(e, "key", "field", F.col("l_linenumber")).select("key", "field", "value")


@query(
    "back_to_back_dates",
    f"WITH {_FACTS} SELECT o_orderkey, born AS first, died AS second FROM f",
)
def back_to_back_dates(spark, d):
    long = lambda c: F.concat(F.date_format(c, "MMMM d"), F.lit(", "), F.date_format(c, "yyyy"))
    pair = X.back_to_back(F.concat(F.lit("In memory "), long("died"), F.lit(" - "), long("born"), F.lit(" at rest")))
    return notices(spark, d).select("o_orderkey", pair["first"].alias("first"), pair["second"].alias("second"))


@query("relation_cut", f"WITH {_FACTS} SELECT o_orderkey, 'She died. ' AS kept, o_orderkey % 128 & 4 <> 0 AS wants_age FROM f")
def relation_cut(spark, d):
    text = F.concat(F.lit("She died. Survived by "), F.col("o_orderkey").cast("string"), F.lit(" sons."))
    return table(spark, d, "orders").select("o_orderkey", X.before_relations(text).alias("kept"), X.wants(F.col("o_orderkey") % 128, "age").alias("wants_age"))


@query(
    "first_word_gender",
    f"""WITH {_SENTENCES_SQL} SELECT doc_id, len(list_filter(parts, lambda x: lower(regexp_extract(x, '^(\\p{{L}}+)', 1)) IN {_in(X.GENDER_WORDS['en']['M'])})) AS male,
        len(list_filter(parts, lambda x: lower(regexp_extract(x, '^(\\p{{L}}+)', 1)) IN {_in(X.GENDER_WORDS['en']['F'])})) AS female FROM s""",
)
def first_word_gender(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", *[X.first_word_tally(t, X.GENDER_WORDS["en"][g]).cast("long").alias(n) for g, n in (("M", "male"), ("F", "female"))])


@query("places_named", f"WITH {_WORDS_SQL} SELECT DISTINCT doc_id, word AS place FROM w WHERE word IN ('he', 'she', 'that', 'les', 'und', 'del')")
def places_named(spark, d):
    places = spark.createDataFrame([(x,) for x in ("he", "she", "that", "les", "und", "del")], "place string")
    return X.places_named(table(spark, d, "documents"), places, "doc_id", "text")


@query(
    "notice_heads",
    f"""WITH {_FACTS} SELECT o_orderkey, 'He was born in ' || CASE WHEN o_orderkey % 2 = 0 THEN 'the year ' ELSE '' END || year(born) || '. Dr. A. Field wrote this.' AS head, year(born)::INT AS born_in,
       'He said "no", (so it is) in the USA; and left.' AS plain FROM f""",
)
def notice_heads(spark, d):
    k = F.col("o_orderkey")
    head = F.concat(F.lit("He was born in "), F.when(k % 2 == 0, F.lit("the year ")).otherwise(F.lit("")), F.year("born").cast("string"), F.lit(". Dr. A. Field wrote this. "), "text")
    loose = F.lit("He  said “no” , ( so it is ) in the U.S.A.;and left .")
    return notices(spark, d).select("o_orderkey", X.head_sentences(head, 2).alias("head"), X.born_year(head).alias("born_in"), T.clean(loose).alias("plain"))


@query(
    "places_of_words",
    f"""WITH l AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}]+'), lambda x: length(x) > 0) AS a FROM documents),
        r AS (SELECT doc_id, unnest(a) AS place FROM l UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(a)), lambda i: a[i] || ' ' || a[i + 1])) FROM l)
        SELECT DISTINCT doc_id, place FROM r WHERE place IN ('the', 'of the', 'de la', 'in der')""",
)
def places_of_words(spark, d):
    places = spark.createDataFrame([(x,) for x in ("the", "of the", "de la", "in der")], "place string")
    return X.places_named(table(spark, d, "documents"), places, "doc_id", "text", most=2)


@query("spanish_dates", f"WITH {_FACTS} SELECT o_orderkey, 2::BIGINT AS n, born AS first_date, died AS last_date FROM f")
def spanish_dates(spark, d):
    said = lambda c, de: F.concat(F.dayofmonth(c).cast("string"), F.lit(" de "), F.element_at(F.array(*[F.lit(m) for m in X.MONTHS["es"]]), F.month(c)), F.lit(f" {de} "), F.year(c).cast("string"))
    dates = X.written_dates(F.concat(F.lit("Nació el "), said("born", "de"), F.lit(" y murió el "), said("died", "del"), F.lit(".")))
    return notices(spark, d).select("o_orderkey", F.size(dates).cast("long").alias("n"), dates[0].alias("first_date"), F.try_element_at(dates, F.lit(-1)).alias("last_date"))


#: Written dates: B and b month in full and short, U in capitals, f and s French and Spanish, d day, o day with an ending, w weekday, y year.
_FORMS = (
    "{B} {d}, {y}", "{B} {o}, {y}", "{b}. {d}, {y}", "{b} {d} {y}", "the {o} of {B} {y}", "{d} {B} {y}", "{B} the {o}, {y}", "{w}, {B} {d}, {y}", "the {o} day of {B}, {y}", "{d} {f} {y}",
    "{w} {d} {b} {y}", "{d} de {s} de {y}", "{d} de {s} del {y}", "{B} {d} of {y}", "({B} {d}, {y})", "{U} {d}, {y}", "{d} {f}, {y}", "{d}/{y} {B}", "{B} {y}", "{B} 45, {y}",
)
_GOOD = 17


def written_as(date, form):
    """A date in one of _FORMS, by the form's place."""
    day, ones = F.dayofmonth(date), F.dayofmonth(date) % 10
    ending = F.when(day.between(11, 13), "th").when(ones == 1, "st").when(ones == 2, "nd").when(ones == 3, "rd").otherwise("th")
    named = lambda lang: F.element_at(F.array(*[F.lit(m) for m in X.MONTHS[lang]]), F.month(date))
    parts = {
        "B": F.date_format(date, "MMMM"), "b": F.date_format(date, "MMM"), "U": F.upper(F.date_format(date, "MMMM")), "f": named("fr"), "s": named("es"), "d": day.cast("string"),
        "o": F.concat(day.cast("string"), ending), "w": F.date_format(date, "EEEE"), "y": F.year(date).cast("string"),
    }
    text = F.element_at(F.array(*[F.lit(x) for x in _FORMS]), (form + 1).cast("int"))
    for k, value in parts.items():
        text = F.replace(text, F.lit("{" + k + "}"), value)
    return text


@query(
    "date_forms",
    f"""WITH {_FACTS} SELECT o_orderkey, CASE WHEN o_orderkey % {len(_FORMS)} < {_GOOD} THEN born END AS first_date, CASE WHEN o_orderkey // 7 % {len(_FORMS)} < {_GOOD} THEN died END AS second_date,
        (o_orderkey % {len(_FORMS)} < {_GOOD})::INT + (o_orderkey // 7 % {len(_FORMS)} < {_GOOD})::INT + 1 AS n FROM f""",
)
def date_forms(spark, d):
    k, n = F.col("o_orderkey"), len(_FORMS)
    text = F.concat(F.lit("On "), written_as(F.col("born"), k % n), F.lit(" it rained at 5 p.m. in Rome. Then, "), written_as(F.col("died"), F.floor(k / 7) % n), F.lit(" was dry. Jan. 5 came, and Sept. 1, 2020 too."))
    dates = F.filter(X.W.found_dates(T.sentences(text)), lambda x: x["date"].isNotNull())
    of = lambda s: F.get(F.filter(dates, lambda x: x["sentence"] == s), F.lit(0))["date"]
    return notices(spark, d).select("o_orderkey", of(0).alias("first_date"), of(1).alias("second_date"), F.size(dates).alias("n"))


@query(
    "keyword_dates",
    f"""WITH {_FACTS}, k AS (SELECT *, o_orderkey % 5 AS v FROM f) SELECT o_orderkey, CASE WHEN v = 4 THEN died ELSE born END AS born, CASE WHEN v = 3 THEN NULL ELSE died END AS died, v IN (0, 3, 4) AS credible,
        CASE WHEN v = 0 THEN born END AS head_first, CASE WHEN v = 0 THEN died END AS head_second FROM k""",
)
def keyword_dates(spark, d):
    k = F.col("o_orderkey")
    b, e = written_as(F.col("born"), k % _GOOD), written_as(F.col("died"), F.floor(k / 3) % _GOOD)
    said = F.concat(F.lit("Ann was born on "), b, F.lit(". "))
    text = (
        F.when(k % 5 == 0, F.concat(said, F.lit("She died on "), e, F.lit(".")))
        .when(k % 5 == 1, F.concat(F.lit("We are sad. All of us are. "), said, F.lit("She passed away on "), e, F.lit(". Her service was on May 5, 2030.")))
        .when(k % 5 == 2, F.concat(said, F.lit("She was loved. She was kind. After her health service post she died, they say, on "), e, F.lit(".")))
        .when(k % 5 == 3, F.concat(said, F.lit("Her funeral, after she died, takes place on "), e, F.lit(".")))
        .otherwise(F.concat(F.lit("Ann was stillborn on "), e, F.lit(".")))
    )
    long = lambda c: F.date_format(c, "MMMM d, yyyy")
    head = F.when(k % 5 == 0, F.concat(F.lit("Roy "), long("born"), F.lit(" - "), long("died"))).otherwise(F.concat(F.lit("Roy and all of us: "), long("born"), F.lit(" - "), long("died")))
    rows = notices(spark, d).select("o_orderkey", X.born_and_died(text).alias("x"), X.heading_dates(head).alias("h"))
    return rows.select("o_orderkey", "x.born", "x.died", "x.credible", F.col("h.first").alias("head_first"), F.col("h.second").alias("head_second"))


#: What a notice says of an age, with the age it tells as SQL of n, and whether in parts of a year.
_AGES = (
    ("He was {n}.", "n", 0), ("She died at home aged {n}.", "n", 0), ("Gone at the age of {n} years.", "n", 0), ("She passed away in her {n}th year.", "n - 1", 0), ("He left on his {n}th birthday.", "n", 0),
    ("It was days before her {n}th birthday.", "n - 1", 0), ("Ann Roy, {n}, left us.", "n", 0), ("He was born in Rome {n} years ago.", "n", 0), ("After {n} years of marriage, she died at the age of 81.", "81", 0),
    ("Husband of {n} years, Robert wept.", "NULL", 0), ("Her children, {n}, 14, survive.", "NULL", 0), ("The barn is over {n} years old.", "NULL", 0), ("She was {n} feet tall, aged 80.", "80", 0),
    ("He was {n} minutes late.", "NULL", 0), ("He died May 3, {n}, at home.", "NULL", 0), ("He died on May 3 at {n} years of age.", "n", 0), ("She was aged {n} months.", "n // 12", 1), ("A boy, aged {n} hours.", "0", 1),
    ("Our {n} weeks old girl.", "n // 52", 1), ("After a {n} year battle he rests.", "NULL", 0), ("He gave ${n} to all.", "NULL", 0), ("He raised {n} children.", "NULL", 0), ("Psalm {n} was read.", "NULL", 0),
    ("Lost at {n} Main Street.", "NULL", 0), ("Il était âgé de {n} ans.", "n", 0), ("Décédée à l'âge de {n} ans.", "n", 0), ("Murió a la edad de {n} años.", "n", 0), ("At 7 p.m. he was {n} years old.", "n", 0),
    ("It was their {n}th anniversary.", "NULL", 0), ("He worked here until he was {n}.", "NULL", 0), ("He died on {d} aged {n}.", "n", 0), ("He sang on {e} aged {n}.", "NULL", 0), ("Born on {d}, aged {n}, or so.", "n", 0),
    ("She was {n}% sure.", "NULL", 0), ("At 12:{n} he slept, {n} years old.", "n", 0),
)


@query(
    "age_contexts",
    f"""WITH {_FACTS}, a AS (SELECT o_orderkey, o_orderkey % {len(_AGES)} AS v, o_orderkey // 3 % 90 + 10 AS n FROM f), t AS (SELECT *, CASE v {' '.join(f'WHEN {i} THEN {sql}' for i, (_, sql, _) in enumerate(_AGES))} END::INT AS age FROM a)
        SELECT o_orderkey, age, CASE WHEN age IS NOT NULL THEN v IN ({', '.join(str(i) for i, x in enumerate(_AGES) if x[2])}) END AS in_parts FROM t""",
)
def age_contexts(spark, d):
    k = F.col("o_orderkey")
    text = F.element_at(F.array(*[F.lit(x) for x, _, _ in _AGES]), (k % len(_AGES) + 1).cast("int"))
    for name, value in (("n", (F.floor(k / 3) % 90 + 10).cast("string")), ("d", F.date_format("died", "MMMM d, yyyy")), ("e", F.date_format("born", "MMMM d, yyyy"))):
        text = F.replace(text, F.lit("{" + name + "}"), value)
    told = X.age_told(F.concat(F.lit("We are sad. "), text), F.col("died"))
    return notices(spark, d).select("o_orderkey", told.alias("x")).select("o_orderkey", "x.age", "x.in_parts")


#: Names of persons with their slots: f, g, l, m stand for a first, a second first, a last and another last name.
_PERSONS = (
    ("{f} {l}", "f", "", "l", "", "", ""), ("{l}, {f}", "f", "", "l", "", "", ""), ("{f} {g} {l}", "f", "g", "l", "", "", ""), ("{l}, {f} {g}", "f", "g", "l", "", "", ""), ("Dr. {f} {g} {l}, Jr.", "f", "g", "l", "Jr.", "", ""),
    ("{f} de la {l}", "f", "", "de la l", "", "", ""), ("{f} {g} van der {l}", "f", "g", "van der l", "", "", ""), ("van {l}, {f}", "f", "", "van l", "", "", ""), ("{f} De La {l} III", "f", "", "De La l", "III", "", ""),
    ('{f} "{g}" {l}', "f", "", "l", "", "g", ""), ("{f} ({g}) {l}", "f", "", "l", "", "g", ""), ("{f} {l} (née {m})", "f", "", "l", "", "", "m"), ("Mrs. {f} {l}, née {m}", "f", "", "l", "", "", "m"), ("{f} {l} dit {m}", "f", "", "l", "", "", "m"),
    ("{f} {l} aka {g}", "f", "", "l", "", "g", ""), ("{f} J. {l}", "f", "J.", "l", "", "", ""), ("{f} {l}-{m}", "f", "", "l-m", "", "", ""), ("{f} de {l} {m}", "f", "", "de l m", "", "", ""), ("{l} {f}", "f", "", "l", "", "", ""),
    ("{f} {l} (formerly de {m})", "f", "", "l", "", "", "de m"), ("  {f}   {l} , Esq.", "f", "", "l", "Esq.", "", ""), ('{f} {l} ("{g}")', "f", "", "l", "", "g", ""),
)


def _slot_sql(at: int) -> str:
    """A slot of _PERSONS as SQL: letters that stand alone are columns, the rest is text."""
    pieces = [[x for x in re.split(r"(?<![A-Za-z])([fglm])(?![A-Za-z])", p[at]) if x] for p in _PERSONS]
    said = [" || ".join(x if x in "fglm" else f"'{x}'" for x in own) or "''" for own in pieces]
    return "CASE v " + " ".join(f"WHEN {k} THEN {x}" for k, x in enumerate(said)) + " END"


@query(
    "parsed_names",
    f"""WITH p AS (SELECT c_custkey, c_custkey % {len(_PERSONS)} AS v, 'Fira' || chr((97 + c_custkey % 26)::INT) AS f, 'Gina' || chr((97 + c_custkey // 3 % 26)::INT) AS g, 'Lor' || chr((97 + c_custkey // 5 % 26)::INT) AS l, 'Mor' || chr((97 + c_custkey // 7 % 26)::INT) AS m FROM customer)
        SELECT c_custkey, {_slot_sql(1)} AS first, {_slot_sql(2)} AS middle, {_slot_sql(3)} AS last, {_slot_sql(4)} AS suffix, {_slot_sql(5)} AS nickname, {_slot_sql(6)} AS alternate, v = 18 AS turned FROM p""",
)
def parsed_names(spark, d):
    k = F.col("c_custkey")
    letter = lambda n: F.chr((97 + F.floor(k / n) % 26).cast("long"))
    text = F.element_at(F.array(*[F.lit(p[0]) for p in _PERSONS]), (k % len(_PERSONS) + 1).cast("int"))
    for slot, stem, n in (("f", "Fira", 1), ("g", "Gina", 3), ("l", "Lor", 5), ("m", "Mor", 7)):
        text = F.replace(text, F.lit("{" + slot + "}"), F.concat(F.lit(stem), letter(n)))
    rows = table(spark, d, "customer").select("c_custkey", text.alias("name"))
    stems = spark.range(26).select(F.chr(97 + F.col("id")).alias("c"))
    counts = stems.select(F.concat(F.lit("fira"), "c").alias("name"), F.lit(90).alias("given"), F.lit(1).alias("surnames")).union(stems.select(F.concat(F.lit("LOR"), "c"), F.lit(2), F.lit(80)))
    one = lambda c: F.coalesce(F.get(c, F.lit(0)), F.lit("")).alias(c[:-1])
    return personal.parsed(rows, "c_custkey", "name", counts).select("c_custkey", "first", "middle", "last", "suffix", one("nicknames"), one("alternates"), "turned")


_PHRASES = ("the", "of the", "of the thth", "in the", "de la", "la", "in der", "und", "de", "that the of")


@query(
    "phrase_hits",
    f"""WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, list_transform(regexp_extract_all(text, '\\p{{L}}+(?:[''’]\\p{{L}}+)*'), lambda x: replace(lower(x), '’', '''')) AS a FROM documents WHERE text IS NOT NULL),
        p AS (SELECT phrase, string_split(phrase, ' ')[1] AS head, len(string_split(phrase, ' ')) AS n FROM (SELECT unnest({list(_PHRASES)}) AS phrase)),
        e AS MATERIALIZED (SELECT doc_id, unnest(a) AS word, generate_subscripts(a, 1) - 1 AS i FROM w),
        m AS MATERIALIZED (SELECT doc_id, i, max(n) AS n, max_by(phrase, n) AS phrase FROM e JOIN p ON e.word = p.head JOIN w USING (doc_id) WHERE array_to_string(a[i + 1 : i + n], ' ') = phrase GROUP BY 1, 2),
        o AS MATERIALIZED (SELECT *, max(i + n) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS past FROM m),
        h AS MATERIALIZED (SELECT *, sum(CASE WHEN past IS NULL OR past <= i THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS chain FROM o),
        k AS (SELECT doc_id, chain, i, n, phrase FROM h WHERE past IS NULL OR past <= i
          UNION ALL SELECT doc_id, chain, x.i, x.n, x.phrase FROM (SELECT h.doc_id, h.chain, min({{'i': h.i, 'n': h.n, 'phrase': h.phrase}}) AS x FROM k JOIN h ON h.doc_id = k.doc_id AND h.chain = k.chain AND h.i >= k.i + k.n GROUP BY 1, 2))
        SELECT doc_id, phrase, count(*) AS n, sum(i)::BIGINT AS places FROM k GROUP BY 1, 2""",
)
def phrase_hits(spark, d):
    phrases = spark.createDataFrame([(p, "k") for p in _PHRASES], "phrase string, kind string")
    hits = P.phrase_hits(table(spark, d, "documents"), "doc_id", "text", phrases)
    return hits.groupBy("doc_id", "phrase").agg(F.count("*").alias("n"), F.sum("word").alias("places"))


@query(
    "told_of_person",
    f"""WITH {_FACTS} SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'Ann Roy died on ' || strftime(died, '%Y-%m-%d') || '.' WHEN 1 THEN 'Ann' || o_orderkey || ' left us.' WHEN 2 THEN 'Bob ' || strftime(born, '%Y-%m-%d') || ' rests' ELSE '' END AS told FROM f""",
)
def told_of_person(spark, d):
    k, day = F.col("o_orderkey"), lambda c: F.date_format(c, "yyyy-MM-dd")
    text = (
        F.when(k % 4 == 0, F.concat(F.lit("It is with GREAT sadness that we announce Ann Roy died on "), day("died"), F.lit(". Also survived\nby "), k.cast("string"), F.lit(" sons.")))
        .when(k % 4 == 1, F.concat(F.lit("In loving memory of Ann"), k.cast("string"), F.lit(" left us. Il laisse dans le deuil Bob. In memory of Al.")))
        .when(k % 4 == 2, F.concat(F.lit("Peacefully Bob "), day("born"), F.lit(" rests  surrounded by his family")))
        .otherwise("C’est avec une grande tristesse que  peacefully").alias("text")
    )
    return P.told_of_person(notices(spark, d).select("o_orderkey", text), "o_orderkey", "text", P.family_phrases(spark))
