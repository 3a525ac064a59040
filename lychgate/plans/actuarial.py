"""Plans of the actuarial functions over parameters taken from the tables' keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from lychgate.functions import actuarial as A
from lychgate.functions import dates
from lychgate.registry import query
from lychgate.sources.tables import table


@query(
    "vt",
    """SELECT p_partkey, round(pow(1.05, -least(t, 10)) * pow(1.03, -greatest(t - 10, 0)), 4) AS v FROM (SELECT p_partkey, (p_partkey % 300) / 10 AS t FROM part)""",
)
def vt(spark, d):
    rates = F.array(F.lit(0.05), F.lit(10.0), F.lit(0.03))
    return table(spark, d, "part").select("p_partkey", A.vt((F.col("p_partkey") % 300) / 10, rates).alias("v"))


@query("rate_vector", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN '0.04|3.0|0.03' ELSE '0.03' END AS rest, CASE WHEN p_partkey % 5 = 0 THEN 1 WHEN p_partkey % 3 = 0 THEN 3 ELSE 0 END AS error FROM part")
def rate_vector(spark, d):
    k = F.col("p_partkey")
    rates = F.array(F.lit(0.04), F.lit(5.0), F.lit(0.03))
    rest = A.drop_elapsed(rates, F.when(k % 2 == 0, 2.0).otherwise(7.0))
    error = A.error_code(F.when(k % 5 == 0, 130).otherwise(60), F.when(k % 3 == 0, 7).otherwise(112), rates)
    return table(spark, d, "part").select("p_partkey", F.concat_ws("|", F.transform(rest, lambda x: x.cast("string"))).alias("rest"), error.alias("error"))


@query("sex_parse", "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 0.0 WHEN 2 THEN 0.25 END::DOUBLE AS male_share FROM customer")
def sex_parse(spark, d):
    code = F.element_at(F.array(F.lit("Male"), F.lit("2"), F.lit("0.25"), F.lit("?")), (F.col("c_custkey") % 4 + 1).cast("int"))
    return table(spark, d, "customer").select("c_custkey", A.parse_sex(code).alias("male_share"))


@query(
    "eligdate",
    """SELECT c_custkey, least(CAST(birth + INTERVAL 65 YEAR AS DATE), CAST(hired + INTERVAL 30 YEAR AS DATE)) AS first_date, greatest(CAST(birth + INTERVAL 65 YEAR AS DATE), CAST(hired + INTERVAL 30 YEAR AS DATE)) AS last_date
       FROM (SELECT c_custkey, DATE '1950-01-10' + (c_custkey % 900)::INT AS birth, DATE '1975-03-03' + (c_custkey % 2500)::INT AS hired FROM customer)""",
)
def eligdate(spark, d):
    day = lambda s, n: F.date_add(F.lit(s).cast("date"), (F.col("c_custkey") % n).cast("int"))
    args = (day("1950-01-10", 900), day("1975-03-03", 2500), F.lit(65.0), F.lit(30.0), F.lit(999.0))
    return table(spark, d, "customer").select("c_custkey", dates.eligibility(*args).alias("first_date"), dates.eligibility(*args, latest=True).alias("last_date"))


#: Survivors by Makeham's law, which ends at 121, and survival for t years from an age.
_LIVES_SQL = """l AS (SELECT list(CASE WHEN x > 120 THEN 0 ELSE exp(-0.0002::DOUBLE * x - 0.00003::DOUBLE / ln(1.1::DOUBLE) * (pow(1.1::DOUBLE, x) - 1)) END ORDER BY x) AS lx FROM range(0, 123) r(x))"""
_LX = "(lx[least(floor({0}), 121)::INT + 1] * (1 - (least({0}, 121) - least(floor({0}), 121))) + lx[least(floor({0}), 121)::INT + 2] * (least({0}, 121) - least(floor({0}), 121)))"


def _survival(age: str, t: str) -> str:
    return f"round({_LX.format(f'({age} + {t})')} / {_LX.format(f'({age})')}, 6)"


@query("tpx", f"WITH {_LIVES_SQL} SELECT p_partkey, {_survival('(p_partkey % 100)', '(p_partkey % 37 / 4.0::DOUBLE)')} AS p FROM part, l")
def tpx(spark, d):
    f, _, _ = A.functions(A.makeham())
    k = F.col("p_partkey")
    return table(spark, d, "part").select("p_partkey", f((k % 100).cast("double"), (k % 37 / 4).cast("double")).alias("p"))


#: Interest of 4 % for 10 years and 3 % later, less what a deferral has used up; cola of 1 %.
_WORTH = "pow(1.04::DOUBLE, -least({t}, greatest(10 - {d}, 0))) * pow(1.03::DOUBLE, -greatest({t} - greatest(10 - {d}, 0), 0))"


@query(
    "life",
    f"""WITH {_LIVES_SQL}, p AS (SELECT p_partkey, 40 + p_partkey % 50 AS age, CASE WHEN p_partkey % 2 = 0 THEN 12 ELSE 1 END AS n, p_partkey % 2 AS late, p_partkey % 3 * 5 AS g, p_partkey % 4 * 4 AS d, lx FROM part, l)
        SELECT p_partkey, round(list_sum(list_transform(range(late, CASE WHEN late = 1 THEN 121 - age - d + 1 ELSE (121 - age - d) * n END), lambda k:
        greatest({_survival('(age + d)', '(k / n::DOUBLE)')}, CASE WHEN k - late < greatest(g * n, 1 - late) THEN 1 ELSE 0 END) * {_WORTH.format(t='(k / n::DOUBLE)', d='d')} * pow(1.01::DOUBLE, k / n::DOUBLE))) / n
        * pow(1.04::DOUBLE, -least(d, 10)) * pow(1.03::DOUBLE, -greatest(d - 10, 0)) * pow(1.01::DOUBLE, d) * {_survival('age', 'd')}, 4) AS value FROM p""",
)
def life(spark, d):
    _, f, _ = A.functions(A.makeham())
    k = F.col("p_partkey")
    freq = F.when(k % 2 == 0, 12.0).otherwise(101.0)
    rates = F.array(F.lit(0.04), F.lit(10.0), F.lit(0.03))
    args = [(40 + k % 50).cast("double"), rates, freq, (k % 3 * 5).cast("double"), F.array(F.lit(0.01)), (k % 4 * 4).cast("double")]
    return A.valued(table(spark, d, "part").select("p_partkey"), f, args, "value")


@query(
    "joint",
    f"""WITH {_LIVES_SQL}, p AS (SELECT p_partkey, 50 + p_partkey % 30 AS a, 48 + p_partkey % 31 AS b, p_partkey % 7 AS o, p_partkey % 2 * 5 AS g, lx FROM part, l),
        q AS (SELECT p_partkey, o, g, unnest(list_transform(range((121 - least(a, b)) * 12), lambda k: {{'k': k, 'x': {_survival('a', '(k / 12.0::DOUBLE)')}, 'y': {_survival('b', '(k / 12.0::DOUBLE)')}, 's': CASE WHEN k < greatest(12 * g, 1) THEN 1.0 ELSE 0.0 END}})) AS u FROM p),
        r AS (SELECT p_partkey, o, u.k AS k, u.x AS x, u.y AS y, u.s AS s FROM q),
        t AS (SELECT p_partkey, o, k, CASE o WHEN 1 THEN greatest(s, x + 0.6::DOUBLE * (y - x * y)) WHEN 2 THEN greatest(s, y + 0.6::DOUBLE * (x - x * y)) WHEN 3 THEN greatest(s, x * y + 0.6::DOUBLE * (x + y - 2 * x * y))
        WHEN 4 THEN x + 0.6::DOUBLE * (greatest(s, y) - x * greatest(s, y)) WHEN 5 THEN y + 0.6::DOUBLE * (greatest(s, x) - y * greatest(s, x)) WHEN 6 THEN x * y + 0.6::DOUBLE * (greatest(s, 1 - (1 - x) * (1 - y)) - x * y) END AS paid FROM r)
        SELECT p_partkey, CASE WHEN min(o) = 0 THEN NULL ELSE round(sum(paid * pow(1.04::DOUBLE, -(k / 12.0::DOUBLE)) ORDER BY k) / 12, 4) END AS value FROM t GROUP BY 1""",
)
def joint(spark, d):
    _, _, f = A.functions(A.makeham())
    k = F.col("p_partkey")
    args = [(50 + k % 30).cast("double"), (48 + k % 31).cast("double"), F.array(F.lit(0.04)), F.lit(12.0), F.lit(0.6), (k % 7).cast("double"), (k % 2 * 5).cast("double")]
    return A.valued(table(spark, d, "part").select("p_partkey"), f, args, "value")


@query(
    "vt_series",
    """SELECT p_partkey, array_to_string(list_transform(range(1, 13), lambda k: round(pow(1.05::DOUBLE, -least(k / 4.0::DOUBLE, 1 + p_partkey % 2)) * pow(1.02::DOUBLE, -greatest(k / 4.0::DOUBLE - 1 - p_partkey % 2, 0)), 4)::VARCHAR), ' ') AS discounts FROM part""",
)
def vt_series(spark, d):
    rates = F.array(F.lit(0.05), (1 + F.col("p_partkey") % 2).cast("double"), F.lit(0.02))
    return table(spark, d, "part").select("p_partkey", F.array_join(F.transform(A.vt_series(rates, 3, 4, True), lambda x: x.cast("string")), " ").alias("discounts"))


@query(
    "sql_functions",
    """SELECT c_custkey, round(year(b) + (dayofyear(b) - 1) / (CASE WHEN year(b) % 4 = 0 THEN 366.0 ELSE 365.0 END) - year(a) - (dayofyear(a) - 1) / (CASE WHEN year(a) % 4 = 0 THEN 366.0 ELSE 365.0 END), 4) AS years,
       round(pow(1.05::DOUBLE, -least(t, 2)) * pow(1.01::DOUBLE, -greatest(t - 2, 0)), 4) AS v, CAST(a + INTERVAL 65 YEAR AS DATE) + round((t - floor(t)) * (CAST(a + INTERVAL 66 YEAR AS DATE) - CAST(a + INTERVAL 65 YEAR AS DATE)))::INT AS first_day
       FROM (SELECT c_custkey, DATE '1950-03-01' + (c_custkey % 900)::INT AS a, DATE '2001-05-05' + (c_custkey % 777)::INT AS b, c_custkey % 16 / 4.0::DOUBLE AS t FROM customer)""",
)
def sql_functions(spark, d):
    A.register(spark)
    table(spark, d, "customer").createOrReplaceTempView("_sql_functions")
    return spark.sql(
        """SELECT c_custkey, elapse(a, b) AS years, vt(t, array(0.05D, 2D, 0.01D)) AS v, eligdate(a, 65 + t - floor(t)) AS first_day FROM
           (SELECT c_custkey, date_add(DATE '1950-03-01', int(c_custkey % 900)) AS a, date_add(DATE '2001-05-05', int(c_custkey % 777)) AS b, double(c_custkey % 16) / 4 AS t FROM _sql_functions)"""
    )
