"""Record linkage over records made from customers, suppliers and parts.

Records: one a customer, its last name from a bounded list, alternates, first and middle names, birth and
death dates or ranges, place, age, spouse and gender, all functions of the key, so that SQL can make the same ones. Incoming
records are all customers, perturbed by key. The SQL spells the bits and keys as numbers of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lychgate.functions import geo, names
from lychgate.operators import linkage as L
from lychgate.operators import rank
from lychgate.registry import query
from lychgate.sources.tables import table

_MASTER_SQL = """b AS (SELECT c_custkey AS id, c_custkey % 11 AS r, DATE '1930-01-01' + CAST(c_custkey % 400 AS INTEGER) AS born FROM customer),
 m AS (SELECT id, 'last' || (id % 97) AS last, CASE WHEN id % 5 = 0 AND id % 97 <> id % 89 THEN 'last' || (id % 89) END AS alt, 'first' || (id % 13) AS first, CASE WHEN id % 9 <> 0 THEN 'mid' || (id % 4) END AS middle,
 born, CASE WHEN r > 1 THEN born END AS dob, CASE WHEN r <> 0 THEN year(born) END AS yob, CASE WHEN r = 1 AND id % 2 = 0 THEN DATE '1900-01-01' ELSE born - (CASE r WHEN 0 THEN 100 WHEN 1 THEN 800 ELSE 0 END) END AS low, born + (CASE r WHEN 0 THEN 100 WHEN 1 THEN 800 ELSE 0 END) AS high,
 CASE WHEN id % 17 <> 0 AND NOT (r = 1 AND id % 2 = 0) THEN DATE '2015-01-01' + CAST(id % 300 AS INTEGER) END AS dod, CASE WHEN id % 34 <> 0 THEN 2015 END AS yod, CASE WHEN id % 19 <> 0 THEN id % 2 END AS gender,
 CASE WHEN id % 6 = 0 THEN 80 + id % 3 END AS age, CASE id % 7 WHEN 0 THEN 'Ann' WHEN 1 THEN 'Bea' END AS spouse, 42.5::DOUBLE + id % 17 AS lat, -60.5::DOUBLE - id % 23 AS lon FROM b)"""
_INCOMING_SQL = """i AS (SELECT id, CASE WHEN id % 12 = 0 THEN [coalesce(alt, last)] WHEN id % 10 = 0 AND alt IS NOT NULL THEN [last, alt] ELSE [last] END AS lasts,
 CASE WHEN id % 20 = 0 THEN 'f' WHEN id % 24 = 5 THEN replace(first, 'first', 'nick') ELSE first END AS first, CASE id % 18 WHEN 1 THEN 'm' WHEN 3 THEN 'other' ELSE middle END AS middle,
 CASE WHEN id % 16 <> 0 AND id % 32 <> 8 THEN dob END AS dob, CASE WHEN id % 16 <> 0 THEN yob END AS yob, CASE WHEN id % 32 = 8 THEN born - 50 WHEN id % 16 <> 0 THEN low END AS low,
 CASE WHEN id % 32 = 8 THEN born + 50 WHEN id % 16 <> 0 THEN high END AS high, CASE WHEN id % 28 = 0 THEN dod + 1 ELSE dod END AS dod, yod, CASE WHEN id % 36 = 0 THEN 1 - gender ELSE gender END AS gender,
 CASE WHEN id % 30 = 0 THEN age + 1 ELSE age END AS age, CASE WHEN id % 14 = 0 THEN 'ANN' WHEN id % 21 = 0 THEN 'Cy' ELSE spouse END AS spouse, lat + (CASE WHEN id % 40 = 0 THEN 20 WHEN id % 44 = 0 THEN 3 ELSE 0 END) AS lat, lon FROM m)"""
#: The day on which the records come in.
TODAY = "2015-11-01"
_PASSES = [["last", "dob", "dod"], ["last", "dob"], ["last", "dod"], ["last", "first"]]
_CANDIDATES_SQL = """v AS (SELECT id, last, first, dob, dod FROM m UNION ALL SELECT id, alt, first, dob, dod FROM m WHERE alt IS NOT NULL),
 j AS (SELECT id, unnest(lasts) AS last, generate_subscripts(lasts, 1) - 1 AS position, first, dob, dod FROM i),
 c AS (SELECT rec_id, cand_id, min(block) // 10 AS pass, min(block) % 10 AS position FROM (
  SELECT j.id AS rec_id, v.id AS cand_id, 10 + position AS block FROM j JOIN v USING (last, dob, dod)
  UNION ALL SELECT j.id, v.id, 20 + position FROM j JOIN v USING (last, dob) UNION ALL SELECT j.id, v.id, 30 + position FROM j JOIN v USING (last, dod)
  UNION ALL SELECT j.id, v.id, 40 + position FROM j JOIN v USING (last, first)) GROUP BY 1, 2)"""


def master(spark, d) -> DataFrame:
    k, r = F.col("id"), F.col("id") % 11
    word = lambda w, n: F.concat(F.lit(w), (k % n).cast("string"))
    open_ = (r == 1) & (k % 2 == 0)
    wide = F.when(r == 0, 100).when(r == 1, 800).otherwise(0)
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.date_add(F.lit("1930-01-01").cast("date"), (F.col("c_custkey") % 400).cast("int")).alias("born"))
    return rows.select(
        "id", word("last", 97).alias("last"), F.when((k % 5 == 0) & (k % 97 != k % 89), word("last", 89)).alias("alt"), word("first", 13).alias("first"),
        F.when(k % 9 != 0, word("mid", 4)).alias("middle"), "born", F.when(r > 1, F.col("born")).alias("dob"), F.when(r != 0, F.year("born")).alias("yob"),
        F.when(open_, F.lit("1900-01-01").cast("date")).otherwise(F.date_sub("born", wide)).alias("low"), F.date_add("born", wide).alias("high"),
        F.when((k % 17 != 0) & ~open_, F.date_add(F.lit("2015-01-01").cast("date"), (k % 300).cast("int"))).alias("dod"), F.when(k % 34 != 0, 2015).alias("yod"),
        F.when(k % 19 != 0, k % 2).alias("gender"), F.when(k % 6 == 0, 80 + k % 3).alias("age"), F.when(k % 7 == 0, "Ann").when(k % 7 == 1, "Bea").alias("spouse"),
        (42.5 + k % 17).alias("lat"), (-60.5 - k % 23).alias("lon"),
    )


def incoming(spark, d) -> DataFrame:
    i, col = F.col("id"), F.col
    told, ranged = i % 16 != 0, i % 32 == 8
    return master(spark, d).select(
        "id", F.when(i % 12 == 0, F.array(F.coalesce("alt", "last"))).when((i % 10 == 0) & col("alt").isNotNull(), F.array("last", "alt")).otherwise(F.array("last")).alias("lasts"),
        F.when(i % 20 == 0, "f").when(i % 24 == 5, F.replace("first", F.lit("first"), F.lit("nick"))).otherwise(col("first")).alias("first"),
        F.when(i % 18 == 1, "m").when(i % 18 == 3, "other").otherwise(col("middle")).alias("middle"),
        F.when(told & ~ranged, col("dob")).alias("dob"), F.when(told, col("yob")).alias("yob"), F.when(ranged, F.date_sub("born", 50)).when(told, col("low")).alias("low"),
        F.when(ranged, F.date_add("born", 50)).when(told, col("high")).alias("high"), F.when(i % 28 == 0, F.date_add("dod", 1)).otherwise(col("dod")).alias("dod"), "yod",
        F.when(i % 36 == 0, 1 - col("gender")).otherwise(col("gender")).alias("gender"), F.when(i % 30 == 0, col("age") + 1).otherwise(col("age")).alias("age"),
        F.when(i % 14 == 0, "ANN").when(i % 21 == 0, "Cy").otherwise(col("spouse")).alias("spouse"),
        (col("lat") + F.when(i % 40 == 0, 20).when(i % 44 == 0, 3).otherwise(0)).alias("lat"), "lon",
    )


def by_name(rows: DataFrame) -> DataFrame:
    """Records once for each of their last names, with its place."""
    return rows.select("id", F.posexplode("lasts").alias("position", "last"), "first", "dob", "dod")


def variants(rows: DataFrame) -> DataFrame:
    return rows.withColumn("last", F.explode(F.array_compact(F.array("last", "alt")))).select("id", "last", "first", "dob", "dod")


def candidates(spark, d) -> DataFrame:
    return L.candidates(by_name(incoming(spark, d)), variants(master(spark, d)), _PASSES)


@query("blocking_passes", f"WITH {_MASTER_SQL}, {_INCOMING_SQL}, {_CANDIDATES_SQL} SELECT * FROM c")
def blocking_passes(spark, d):
    return candidates(spark, d)


_KM = "2 * 6371.0 * asin(sqrt(pow(sin((radians(m.lat) - radians(i.lat)) / 2), 2) + cos(radians(i.lat)) * cos(radians(m.lat)) * pow(sin((radians(m.lon) - radians(i.lon)) / 2), 2)))"
_YEARS = "round(year({1}) + (dayofyear({1}) - 1) / (CASE WHEN year({1}) % 4 = 0 THEN 366.0 ELSE 365.0 END) - year({0}) - (dayofyear({0}) - 1) / (CASE WHEN year({0}) % 4 = 0 THEN 366.0 ELSE 365.0 END), 4)"
_EVIDENCE_SQL = f"""{_MASTER_SQL}, {_INCOMING_SQL}, {_CANDIDATES_SQL}, w AS (SELECT rec_id, cand_id, pass, position, i.lasts, CASE WHEN m.alt IS NULL THEN [m.last] ELSE [m.last, m.alt] END AS stored,
 i.first AS f, m.first AS g, i.middle AS x, m.middle AS y, i.gender AS s, m.gender AS t, i.age AS a, m.age AS z, i.spouse AS p, m.spouse AS q, {_KM} AS km, i.dob AS d, m.dob AS e, i.yob AS yd, m.yob AS ye,
 i.low AS il, i.high AS ih, m.low AS ml, m.high AS mh, i.dod AS o, m.dod AS u, i.yod AS yo, m.yod AS yu, coalesce({_YEARS.format('i.low', 'i.high')}, 99) AS iw, coalesce({_YEARS.format('m.low', 'm.high')}, 99) AS mw
 FROM c JOIN i ON rec_id = i.id JOIN m ON cand_id = m.id),
 h AS (SELECT *, len(list_intersect(lasts, stored)) AS ln, CASE WHEN (length(f) = 1 AND left(g, 1) = f) OR f = g THEN 1 ELSE 0 END AS fn, CASE WHEN (length(x) = 1 AND left(y, 1) = x) OR x = y THEN 1 ELSE 0 END AS mn,
 (x IS NOT NULL)::INT AS xs, (y IS NOT NULL)::INT AS ys, pass IN (3, 4) AS born, pass IN (2, 4) AS died,
 coalesce(il > mh, false) OR coalesce(ih < ml, false) AS apart, coalesce(d BETWEEN ml AND mh, false) AS inm, coalesce(e BETWEEN il AND ih, false) AS ini,
 pass = 4 AND (coalesce(o IS NOT NULL AND u IS NULL AND e IS NULL AND ml <= DATE '1900-01-01' AND o > mh, false) OR coalesce(u IS NOT NULL AND o IS NULL AND d IS NULL AND il <= DATE '1900-01-01' AND u > ih, false)) AS late,
 coalesce((il >= ml AND ih <= mh) OR ((il = ml OR ih = mh) AND iw <= 1 AND mw <= 1), false) AS held FROM w),
 n AS (SELECT *, d IS NULL AND e IS NULL AND iw < 2 AND mw < 2 AS ranges, d IS NOT NULL AND e IS NULL AND mw < 2 AS onlyi, d IS NULL AND e IS NOT NULL AND iw < 2 AS onlym,
 NOT (d IS NOT NULL AND e IS NOT NULL) AND yd IS NOT NULL AND ye IS NOT NULL AS years, NOT (o IS NOT NULL AND u IS NOT NULL) AND yo IS NOT NULL AND yu IS NOT NULL AS dyears FROM h),
 e AS (SELECT rec_id, cand_id, pass, position,
 (CASE WHEN list_contains(lasts, stored[1]) THEN 262144 ELSE 0 END) | (CASE WHEN len(stored) > 1 AND list_contains(lasts, stored[2]) THEN 131072 ELSE 0 END) | (CASE WHEN fn = 1 THEN 2048 ELSE 0 END)
 | (CASE WHEN length(f) > 1 AND f <> g AND replace(f, 'nick', 'first') = g THEN 256 ELSE 0 END) | (CASE WHEN mn = 1 THEN 4 ELSE 0 END) | (CASE WHEN s = t THEN 128 ELSE 0 END) | (CASE WHEN a = z THEN 1048576 ELSE 0 END)
 | (CASE WHEN lower(p) = lower(q) THEN 2097152 ELSE 0 END) | (CASE WHEN km <= 25 THEN 4194304 ELSE 0 END) | (CASE pass WHEN 1 THEN 12384 WHEN 2 THEN 8224 WHEN 3 THEN 4160 ELSE 0 END)
 | (CASE WHEN born THEN (CASE WHEN d = e THEN 8192 ELSE 0 END) | (CASE WHEN years AND yd = ye THEN 32 ELSE 0 END) | (CASE WHEN (onlyi AND inm) OR (onlym AND ini) THEN 524288 ELSE 0 END) | (CASE WHEN ranges AND held THEN 24 ELSE 0 END) ELSE 0 END)
 | (CASE WHEN died THEN (CASE WHEN o = u THEN 4096 ELSE 0 END) | (CASE WHEN dyears AND yo = yu THEN 64 ELSE 0 END) ELSE 0 END) AS same,
 (CASE WHEN len(stored) > ln AND len(lasts) > ln THEN 262144 ELSE 0 END) | (CASE WHEN xs > mn AND ys > mn THEN 4 ELSE 0 END) | (CASE WHEN s <> t THEN 128 ELSE 0 END) | (CASE WHEN a <> z THEN 1048576 ELSE 0 END)
 | (CASE WHEN lower(p) <> lower(q) THEN 2097152 ELSE 0 END) | (CASE WHEN km > 1500 THEN 4194304 ELSE 0 END)
 | (CASE WHEN born THEN (CASE WHEN d <> e OR (onlyi AND NOT inm) OR (onlym AND NOT ini) OR apart THEN 8192 ELSE 0 END) | (CASE WHEN years AND yd <> ye THEN 32 ELSE 0 END) | (CASE WHEN (ranges AND NOT held) OR apart THEN 24 ELSE 0 END) ELSE 0 END)
 | (CASE WHEN late THEN 4096 ELSE 0 END) | (CASE WHEN died THEN (CASE WHEN o <> u THEN 4096 ELSE 0 END) | (CASE WHEN dyears AND yo <> yu THEN 64 ELSE 0 END) ELSE 0 END) AS differs,
 len(list_filter(lasts, lambda l: NOT list_contains(stored, l))) > 0 OR fn = 0 OR xs > mn OR (s IS NOT NULL AND t IS NULL)
 OR (born AND ((d IS NOT NULL AND e IS NULL AND (mw >= 2 OR inm)) OR (d IS NULL AND e IS NULL AND mw >= 2 AND iw < 2))) OR (died AND ((o IS NOT NULL AND u IS NULL) OR (yo IS NOT NULL AND yu IS NULL))) AS news,
 len(lasts) <> len(stored) OR ln <> len(stored) OR fn = 0 OR xs <> ys OR mn <> ys OR (s IS NULL) <> (t IS NULL) OR coalesce(s <> t, false) OR a IS DISTINCT FROM z OR km > 200 OR late
 OR (born AND (coalesce(d <> e, false) OR (years AND yd <> ye) OR (onlyi AND NOT inm) OR (onlym AND NOT ini) OR (ranges AND NOT held) OR apart))
 OR (died AND (coalesce(o <> u, false) OR (dyears AND yo <> yu) OR (NOT dyears AND (o IS NULL OR u IS NULL) AND (o IS DISTINCT FROM u OR yo IS DISTINCT FROM yu)))) AS unlike,
 greatest(len(lasts), len(stored)) + 1 + greatest(xs, ys) + (s IS NOT NULL OR t IS NOT NULL)::INT + (a IS NOT NULL OR z IS NOT NULL)::INT + (CASE pass WHEN 1 THEN 2 WHEN 4 THEN 0 ELSE 1 END)
 + (CASE WHEN born AND (d IS NOT NULL OR e IS NOT NULL OR yd IS NOT NULL OR ye IS NOT NULL) THEN 1 ELSE 0 END) + (CASE WHEN died AND (o IS NOT NULL OR u IS NOT NULL OR yo IS NOT NULL OR yu IS NOT NULL) THEN 1 ELSE 0 END) AS potential,
 (CASE WHEN len(stored) > ln AND len(lasts) > ln THEN 0 ELSE ln END) + fn + (CASE WHEN xs > mn AND ys > mn THEN 0 ELSE mn END) AS names,
 ln >= 2 AND ln = least(len(lasts), len(stored)) AND fn = 1 AS enough, born AND NOT apart AND coalesce(year(mh) - year(il) <= 1, false) AS close FROM n)"""


def evidence() -> list:
    """Columns of evidence of rows with the structs i (incoming) and m (master), and the column pass."""
    i, m = F.col("i"), F.col("m")
    nick = lambda x, y: F.replace(x, F.lit("nick"), F.lit("first")) == y
    dob = [F.struct(c["dob"].alias("exact"), c["yob"].alias("year"), c["low"].alias("low"), c["high"].alias("high")) for c in (i, m)]
    dod = [F.struct(c["dod"].alias("exact"), c["yod"].alias("year")) for c in (i, m)]
    parts = [
        *L.named(L.last_names(i["last_names"], m["last_names"]), L.first_names(i["first_names"], m["first_names"], nick), L.middle_names(i["middle_names"], m["middle_names"])),
        L.genders(i["gender"], m["gender"]), L.ages(i["age"], m["age"]), L.spouses(i["spouse"], m["spouse"]), L.places(geo.haversine(i["lat"], i["lon"], m["lat"], m["lon"])),
    ]
    told = L.by_pass(F.col("pass"), parts, L.births(*dob), L.deaths(*dod), L.births_and_deaths(*dob, *dod))
    return [*told, (F.lit(TODAY).cast("date") < F.date_add(i["dod"], 60)).alias("_recent")]


def as_structs(rows: DataFrame, key: str, name: str) -> DataFrame:
    """Records as structs, with their names as lists, which are made once a record and not for each pair."""
    listed = lambda *c: F.array_compact(F.array(*c))
    last = F.col("lasts") if "lasts" in rows.columns else listed("last", "alt")
    return rows.select(F.col("id").alias(key), F.struct("*", last.alias("last_names"), F.array("first").alias("first_names"), listed("middle").alias("middle_names")).alias(name))


def with_evidence(rows: DataFrame, told: list) -> DataFrame:
    """Pairs that hold the structs i and m, with evidence and score."""
    return rows.select("rec_id", "cand_id", "pass", "position", *told).withColumn("net_score", L.net_score())


def scored(pairs: DataFrame, records: DataFrame, stored: DataFrame, told: list) -> DataFrame:
    return with_evidence(pairs.join(as_structs(records, "rec_id", "i").hint("merge"), "rec_id").join(as_structs(stored, "cand_id", "m").hint("merge"), "cand_id"), told)


def sides(spark, d) -> tuple[DataFrame, DataFrame]:
    """Incoming and stored records with their keys, each with all that is known of it."""
    records, stored = incoming(spark, d), master(spark, d)
    return L.keyed(by_name(records), _PASSES, as_structs(records, "id", "i")), L.keyed(variants(stored), _PASSES, as_structs(stored, "id", "m"))


@query("candidate_evidence", f"WITH {_EVIDENCE_SQL} SELECT *, same - 2 * bit_count(differs) AS net_score FROM e")
def candidate_evidence(spark, d):
    return with_evidence(L.met(*sides(spark, d), _PASSES), evidence()).drop("_recent")


_KEY_SQL = f"""{_EVIDENCE_SQL}, y AS (SELECT *, differs & 1060960 <> 0 AS clash, same & 8192 <> 0 AS dob, same & 4096 <> 0 AS dod, same & 262144 <> 0 AS last, same & 229376 <> 0 AS alt, same & 2048 <> 0 AS first, same & 256 <> 0 AS like_,
 same & 524288 <> 0 AS within, same & 4194304 <> 0 AS place, differs = 0 AS clean FROM e),
 r AS (SELECT *, CASE WHEN clash OR differs & 262144 <> 0 THEN 0 WHEN (dob OR place) AND last AND first THEN CASE WHEN dod THEN 20 ELSE 16 END WHEN dob AND alt AND first THEN CASE WHEN dod THEN 19 ELSE 15 END
 WHEN (dob OR within) AND like_ THEN CASE WHEN dob AND last THEN CASE WHEN dod THEN 18 ELSE 10 END WHEN dob AND alt THEN CASE WHEN dod THEN 17 ELSE 9 END
  WHEN last THEN CASE WHEN dod THEN 14 ELSE 13 END WHEN alt THEN CASE WHEN dod THEN 6 ELSE 5 END ELSE 0 END
 WHEN last AND first THEN CASE WHEN dod THEN 12 ELSE 4 END WHEN last AND like_ THEN CASE WHEN dod THEN 8 ELSE 2 END WHEN last THEN 0
 WHEN alt AND first THEN CASE WHEN dod THEN 11 ELSE 3 END WHEN alt AND like_ THEN CASE WHEN dod THEN 7 ELSE 1 END ELSE 0 END AS k0 FROM y),
 f AS (SELECT *, k0 >= 12 OR (NOT (k0 >= 7 AND clean) AND ((potential >= 6 AND NOT unlike) OR (k0 >= 4 AND clean AND (enough OR (names >= 3 AND (close OR place)))))) AS sure FROM r),
 k AS (SELECT *, CASE WHEN rec_id % 50 = 0 AND rec_id = cand_id THEN 21 WHEN NOT sure AND NOT clean THEN 0 WHEN k0 = 16 AND position <> 0 THEN 15 ELSE k0 END AS match_key,
 (rec_id % 50 = 0 AND rec_id = cand_id) OR ((sure OR (k0 >= 7 AND clean)) AND NOT (NOT sure AND NOT clean)) AS known,
 (rec_id % 50 = 0 AND rec_id = cand_id) OR sure OR ((k0 >= 7 AND clean) AND k0 >= 4 AND NOT clash AND rec_id % 3 = 0) AS sufficient, same - 2 * bit_count(differs) AS net_score FROM f)"""


def with_decision(rows: DataFrame) -> DataFrame:
    rec = F.col("rec_id")
    same_id = (rec % 50 == 0) & (rec == F.col("cand_id"))
    return L.decided(rows, F.col("_recent"), family=rec % 3 == 0, by_alternate=F.col("position") != 0, same_id=same_id).drop("_recent")


def decided(pairs: DataFrame, records: DataFrame, stored: DataFrame, told: list) -> DataFrame:
    return with_decision(scored(pairs, records, stored, told))


@query("match_keys", f"WITH {_KEY_SQL} SELECT rec_id, cand_id, match_key, known, sufficient FROM k")
def match_keys(spark, d):
    rows = with_decision(with_evidence(L.met(*sides(spark, d), _PASSES), evidence()))
    return rows.select("rec_id", "cand_id", "match_key", "known", "sufficient")


_STOP_SQL = f"""{_KEY_SQL}, s AS (SELECT *, min(CASE WHEN match_key >= 15 THEN pass * 10 + position END) OVER (PARTITION BY rec_id) AS stop FROM k),
 t AS (SELECT * FROM s WHERE stop IS NULL OR pass * 10 + position <= stop), best AS (SELECT *, row_number() OVER (PARTITION BY rec_id ORDER BY match_key DESC, net_score DESC, cand_id) AS rn FROM t)"""


def blocks(spark, d) -> DataFrame:
    """Blocks of each record up to the first that settles it: passes by dates in one round, the wide one by names in another."""
    settled = F.col("match_key") >= L.KEYS.index("alt_key")
    score = lambda rows: with_decision(with_evidence(rows, evidence()))
    return L.blocks_in_passes(*sides(spark, d), [_PASSES[:3], _PASSES[3:]], score, settled, L.ranked(F.col("match_key"), F.col("net_score"), F.col("cand_id")))


def best_candidates(spark, d) -> DataFrame:
    best = blocks(spark, d).groupBy("rec_id").agg(F.max(F.struct("best", "block")).alias("_b"))
    block = F.col("_b.block")
    pairs = best.select("rec_id", L.ranked_id(F.col("_b.best")).alias("cand_id"), F.floor(block / 10).cast("int").alias("pass"), (block % 10).alias("position"))
    rows = decided(pairs, incoming(spark, d), master(spark, d), evidence())
    return L.best(rows, "rec_id", F.desc("match_key"), F.desc("net_score"), F.col("cand_id"))


@query("early_stop_passes", f"WITH {_STOP_SQL} SELECT rec_id, cand_id, pass, position FROM t")
def early_stop_passes(spark, d):
    records, stored = incoming(spark, d), master(spark, d)
    stops = blocks(spark, d).groupBy(F.col("rec_id").alias("id")).agg(F.max("stop").alias("_stop"))
    told = records.select("id").join(stops.hint("merge"), "id", "left")
    rows = L.met(L.keyed(by_name(records), _PASSES, told), L.keyed(variants(stored), _PASSES, stored.select("id")), _PASSES)
    return rows.where(F.col("_stop").isNull() | (L.block_of() <= F.col("_stop"))).select("rec_id", "cand_id", "pass", "position")


@query("linkage_best", f"WITH {_STOP_SQL} SELECT rec_id, cand_id, match_key, net_score FROM best WHERE rn = 1")
def linkage_best(spark, d):
    return best_candidates(spark, d).select("rec_id", "cand_id", "match_key", "net_score")


@query("linkage_histogram", f"WITH {_STOP_SQL} SELECT match_key, count(*) AS n FROM best WHERE rn = 1 GROUP BY 1")
def linkage_histogram(spark, d):
    return best_candidates(spark, d).groupBy("match_key").agg(F.count("*").alias("n"))


@query(
    "load_action",
    f"""WITH {_STOP_SQL} SELECT rec_id, CASE WHEN rec_id % 100 = 0 THEN 'force_new' WHEN rec_id % 52 = 0 THEN 'override' WHEN rec_id % 44 = 0 THEN 'junk'
        WHEN known AND (news OR rec_id % 8 <> 0 OR sufficient) THEN 'update' WHEN known THEN 'skip' ELSE 'insert' END AS action FROM best WHERE rn = 1""",
)
def load_action(spark, d):
    r = F.col("rec_id")
    code = F.when(r % 100 == 0, 100).when(r % 52 == 0, 101).when(r % 44 == 0, 900).otherwise(0)
    action = L.run_action(code, F.col("known"), F.col("news"), r % 8 == 0, F.col("sufficient"))
    return best_candidates(spark, d).select("rec_id", action.alias("action"))


_PERSONS_SQL = """c AS (SELECT c_custkey AS id, c_custkey % 15 AS j, c_custkey // 15 AS f, DATE '1935-01-01' + (c_custkey * 61 % 5000)::INT AS born FROM customer),
 q AS (SELECT id, 'Last' || f AS last, CASE WHEN id % 9 = 0 THEN ['Given' || (id % 5), 'Nick' || (id % 4)] WHEN id % 9 = 1 THEN ['Given' || (id % 5) || '-Ann'] ELSE ['Given' || (id % 5)] END AS firsts,
  CASE id % 3 WHEN 0 THEN ['Mid' || (id % 2)] WHEN 1 THEN ['Mid' || (id % 2), 'X'] ELSE ['Given' || ((id + 1) % 5)] END AS middles, CASE id % 4 WHEN 0 THEN 'Bob' WHEN 1 THEN 'Zoe' END AS spouse,
  CASE WHEN id % 8 <> 0 THEN id % 2 END AS gender, CASE WHEN id % 4 <> 1 THEN born END AS dob, CASE id % 12 WHEN 1 THEN NULL WHEN 5 THEN born ELSE born - (id % 7)::INT END AS low,
  CASE id % 12 WHEN 1 THEN NULL WHEN 5 THEN born ELSE born + (id % 11 * 40)::INT END AS high, 42.5::DOUBLE + id % 17 AS lat, CASE WHEN id % 10 <> 0 THEN -60.5::DOUBLE - id % 23 END AS lon,
  ['ON', 'QC', 'YT'][(id % 3 + 1)::INT] AS province FROM c),
 s AS (SELECT s_suppkey AS id, s_suppkey * 15 + s_suppkey % 15 AS t FROM supplier),
 p AS (SELECT id, CASE WHEN id % 7 = 3 THEN 'Given' || (t % 5) ELSE 'Last' || id END AS last, CASE WHEN id % 7 = 3 THEN 'last' || id WHEN id % 7 = 4 THEN 'Nick' || (t % 5) WHEN id % 7 = 5 THEN 'Given' || ((t + 1) % 5) ELSE 'Given' || (t % 5) END AS first,
  CASE WHEN id % 3 = 0 THEN ['Mid' || (t % 2)] WHEN id % 3 = 1 THEN ['M'] ELSE [] END AS middles, CASE id % 4 WHEN 0 THEN 'Robert' WHEN 1 THEN 'Zoé' END AS spouse, t % 2 AS gender,
  CASE WHEN id % 11 <> 0 THEN DATE '1935-01-01' + (t * 61 % 5000)::INT + (CASE id % 6 WHEN 1 THEN 10 WHEN 2 THEN 300 ELSE 0 END)::INT END AS dob, 42.5::DOUBLE + t % 17 AS lat, -60.5::DOUBLE - t % 23 AS lon,
  ['ON', 'QC', 'YT'][(t % 3 + 1)::INT] AS province FROM s)"""
_SHARED_SQL = "len(list_filter({0}, lambda x: list_contains({1}, x))) > 0"
_VERSIONS_SQL = "flatten(list_transform({0}, lambda x: CASE WHEN x LIKE 'nick%' THEN [x, replace(x, 'nick', 'given')] WHEN x = 'given2' THEN [x, 'alt2', 'given3'] ELSE [x] END))"
_RANK_SQL = f"""{_PERSONS_SQL},
 q1 AS (SELECT *, list_transform(flatten(list_transform(firsts, lambda x: CASE WHEN contains(x, '-') THEN list_concat([x], string_split(x, '-')) ELSE [x] END)), lambda x: lower(x)) AS names,
  CASE WHEN spouse = 'Bob' THEN ['bob', 'robert'] WHEN spouse IS NULL THEN [] ELSE [lower(spouse)] END AS spouses FROM q),
 q2 AS (SELECT *, {_VERSIONS_SQL.format('names')} AS wide FROM q1),
 p1 AS (SELECT *, lower(last) AS l, lower(first) AS g, false AS exchanged FROM p UNION ALL SELECT *, lower(first), lower(last), true FROM p),
 p2 AS (SELECT *, {_VERSIONS_SQL.format('[g]')} AS wide, CASE spouse WHEN 'Robert' THEN ['robert'] WHEN 'Zoé' THEN ['zoe'] ELSE [] END AS spouses FROM p1),
 m AS (SELECT p.id AS rec_id, q.id AS cand_id, p.exchanged, p.dob AS d, q.dob AS e, q.low, q.high, p.gender AS s, q.gender AS t, p.g, q.names, p.wide AS pw, q.wide AS qw, p.middles[1] AS x, q.middles AS y, p.spouses AS ps, q.spouses AS qs, p.province AS pp, q.province AS qp,
  2 * 6371.0 * asin(sqrt(pow(sin((radians(q.lat) - radians(p.lat)) / 2), 2) + cos(radians(p.lat)) * cos(radians(q.lat)) * pow(sin((radians(q.lon) - radians(p.lon)) / 2), 2))) AS km
  FROM p2 p JOIN q2 q ON p.l = lower(q.last) AND coalesce(q.low, q.dob, DATE '1800-01-01') <= coalesce((p.dob + INTERVAL 1 YEAR)::DATE + (CASE WHEN month(p.dob) = 2 AND day(p.dob) = 29 THEN 1 ELSE 0 END), DATE '2024-01-01')
  AND coalesce(q.high, q.dob, DATE '2200-01-01') >= coalesce((p.dob - INTERVAL 1 YEAR)::DATE, DATE '1875-01-01')),
 n AS (SELECT *, CASE WHEN d = low THEN 500 ELSE 0 END + CASE WHEN d = high THEN 500 ELSE 0 END AS ends, (high - low) + greatest(0, low - d, d - high) AS off,
  len(list_filter(y, lambda v: v = x OR ((length(v) = 1 OR length(x) = 1) AND v[1] = x[1]))) AS hits, list_contains(names, g) AS same FROM m),
 k AS (SELECT rec_id, cand_id, exchanged, (CASE WHEN d IS NULL THEN 0
   WHEN e IS NULL THEN ends + CASE WHEN ends >= 1000 OR off IS NULL THEN 0 WHEN off <= 0 THEN 1000 WHEN off <= 31 THEN 500 WHEN off <= 366 THEN 250 WHEN off <= 1000 THEN 100 ELSE 0 END
   WHEN d = e THEN 1000 WHEN (year(d) = year(e) AND month(d) = day(e) AND day(d) = month(e)) OR (year(d) = year(e))::INT + (month(d) = month(e))::INT + (day(d) = day(e))::INT = 2 THEN 0 ELSE -500 END)
  + (CASE WHEN t IS NULL THEN 0 WHEN s = t THEN 100 ELSE -50 END)
  + (CASE WHEN same THEN 750 WHEN {_SHARED_SQL.format('pw', 'qw')} THEN 562 WHEN {_SHARED_SQL.format('pw', 'list_transform(y, lambda v: lower(v))')} THEN 247 ELSE 0 END)
  + (CASE WHEN x IS NULL THEN 0 WHEN hits < 1 THEN -375 WHEN list_contains(y, x) THEN 375 ELSE 187 END) + (CASE WHEN {_SHARED_SQL.format('ps', 'qs')} THEN 375 ELSE 0 END)
  + (CASE WHEN km < 25 THEN 750 WHEN km < 100 THEN 500 WHEN km < 250 THEN 350 WHEN km < 750 THEN 250 WHEN pp = qp THEN CASE WHEN pp = 'YT' THEN 250 ELSE 150 END ELSE 0 END) AS points FROM n),
 b AS (SELECT p.id AS rec_id, max(k.points) FILTER (NOT k.exchanged) AS best, max(k.points) FILTER (k.exchanged) AS other, any_value(p.dob) AS dob, any_value(p.last) AS last, any_value(p.first) AS first FROM p LEFT JOIN k ON k.rec_id = p.id GROUP BY 1),
 u AS (SELECT rec_id, coalesce(best, 0) < 1750 AND dob IS NOT NULL AND last LIKE 'Given%' AND lower(first) LIKE 'last%' AND coalesce(other, 0) >= 2000 AS turned FROM b)"""


def _monitored(spark, d) -> tuple[DataFrame, DataFrame]:
    """Monitored persons, one a supplier, and stored ones, 15 customers of each last name."""
    word = lambda w, n: F.concat(F.lit(w), n.cast("string"))
    pick = lambda k: F.element_at(F.array(F.lit("ON"), F.lit("QC"), F.lit("YT")), (k % 3 + 1).cast("int"))
    days = lambda k: F.date_add(F.lit("1935-01-01").cast("date"), (k * 61 % 5000).cast("int"))
    none = F.array().cast("array<string>")
    k = F.col("c_custkey")
    born, open_, sure = days(k), k % 12 == 1, k % 12 == 5
    stored = table(spark, d, "customer").select(
        k.alias("id"), word("Last", F.floor(k / 15)).alias("last"),
        F.when(k % 9 == 0, F.array(word("Given", k % 5), word("Nick", k % 4))).when(k % 9 == 1, F.array(F.concat(word("Given", k % 5), F.lit("-Ann")))).otherwise(F.array(word("Given", k % 5))).alias("firsts"),
        F.when(k % 3 == 0, F.array(word("Mid", k % 2))).when(k % 3 == 1, F.array(word("Mid", k % 2), F.lit("X"))).otherwise(F.array(word("Given", (k + 1) % 5))).alias("middles"),
        F.when(k % 4 == 0, "Bob").when(k % 4 == 1, "Zoe").alias("spouse"), F.when(k % 8 != 0, k % 2).alias("gender"), F.when(k % 4 != 1, born).alias("dob"),
        F.when(sure, born).when(~open_, F.date_sub(born, (k % 7).cast("int"))).alias("low"), F.when(sure, born).when(~open_, F.date_add(born, (k % 11 * 40).cast("int"))).alias("high"),
        (42.5 + k % 17).alias("lat"), F.when(k % 10 != 0, -60.5 - k % 23).alias("lon"), pick(k).alias("province"),
    )
    k = F.col("s_suppkey")
    t, turned = k * 15 + k % 15, k % 7 == 3
    given, last = word("Given", t % 5), word("Last", k)
    first = F.when(turned, word("last", k)).when(k % 7 == 4, word("Nick", t % 5)).when(k % 7 == 5, word("Given", (t + 1) % 5)).otherwise(given)
    persons = table(spark, d, "supplier").select(
        k.alias("id"), F.when(turned, given).otherwise(last).alias("last"), F.array(first).alias("firsts"),
        F.when(k % 3 == 0, F.array(word("Mid", t % 2))).when(k % 3 == 1, F.array(F.lit("M"))).otherwise(none).alias("middles"), F.when(k % 4 == 0, "Robert").when(k % 4 == 1, "Zoé").alias("spouse"),
        (t % 2).alias("gender"), F.when(k % 11 != 0, F.date_add(days(t), F.when(k % 6 == 1, 10).when(k % 6 == 2, 300).otherwise(0))).alias("dob"), (42.5 + t % 17).alias("lat"), (-60.5 - t % 23).alias("lon"), pick(t).alias("province"),
    )
    return persons, stored


@query(
    "rank_monitored",
    f"""WITH {_RANK_SQL}, r AS (SELECT k.*, row_number() OVER (PARTITION BY rec_id ORDER BY points DESC, cand_id) AS n FROM k JOIN u USING (rec_id) WHERE k.exchanged = u.turned)
        SELECT rec_id AS rec, cand_id AS cand, points::BIGINT AS points, exchanged FROM r WHERE n <= 3""",
)
def rank_monitored(spark, d):
    persons, stored = _monitored(spark, d)
    listed = lambda *names: spark.createDataFrame([(n,) for n in names], "name string")
    versions = spark.createDataFrame([("given2", ["Alt2", "Given3"]), ("Robert", [])], "name string, alt_names array<string>")
    nicknames = spark.createDataFrame([(f"Nick{i}", [f"Given{i}"]) for i in range(5)] + [("bob", ["Robert"])], "nickname string, formal_names array<string>")
    surnames = stored.select(F.col("last").alias("name")).union(persons.select(F.concat(F.lit("Last"), F.col("id").cast("string"))))
    best = rank.ranked(persons, stored, F.lit("2024-01-01").cast("date"), versions, nicknames, listed(*(f"given{i}" for i in range(5))), surnames)
    return best.select(F.col("rec_id").alias("rec"), F.col("cand_id").alias("cand"), "points", "exchanged")


@query(
    "name_similarity",
    """SELECT p_partkey, least(1.0, list_sum(list_transform(a, lambda x: CASE WHEN x = kind OR x = brand THEN 1.0 ELSE 0.0 END + CASE WHEN x[1] = letter THEN 0.5 ELSE 0.0 END)))::DOUBLE AS sim,
       CASE WHEN len(list_filter(a, lambda x: x[1] = letter OR x = a[1])) < least(len(a), 2) THEN -least(len(a), 2)
            ELSE len(list_filter(a, lambda x: x[1] = letter AND x <> a[1])) * 0.5 + len(list_filter(a, lambda x: x = a[1])) END::DOUBLE AS many
       FROM (SELECT p_partkey, string_split(lower(p_name), ' ') AS a, lower(p_type) AS kind, lower(p_brand) AS brand, substr(lower(p_name), 1, 1) AS letter FROM part)""",
)
def name_similarity(spark, d):
    a, letter = F.split("p_name", " "), F.substring("p_name", 1, 1)
    single = names.similarity(a, F.array("p_type", letter, "p_brand"))
    return table(spark, d, "part").select("p_partkey", single.alias("sim"), names.similarity(a, F.array(F.upper(a[0]), letter), multiple=True).alias("many"))


_NAMES_SQL = "n AS (SELECT c_nationkey AS name_id, count(*) FILTER (WHERE c_custkey % 3 = 0) AS male, count(*) FILTER (WHERE c_custkey % 3 <> 0 AND c_custkey % 7 > c_nationkey % 7) AS female FROM customer GROUP BY 1)"


def _name_counts(spark, d):
    k = F.col("c_custkey")
    return table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("name_id")).agg(
        F.count_if(k % 3 == 0).alias("male"), F.count_if((k % 3 != 0) & (k % 7 > F.col("c_nationkey") % 7)).alias("female")
    )


@query(
    "name_credibility",
    f"""WITH {_NAMES_SQL} SELECT name_id, CASE WHEN male + female > 0 THEN male / (male + female) END AS male_pct, CASE WHEN male + female = 0 THEN 'zero'
        WHEN male + female <= 10 AND male > 0 AND female > 0 THEN 'low' WHEN male + female <= 50 AND NOT ((male = 0 OR female = 0) AND male + female >= 5) THEN 'medium'
        WHEN male + female <= 250 AND NOT ((male = 0 OR female = 0) AND male + female >= 100) THEN 'high' ELSE 'veryHigh' END AS tier,
        (male + female >= 10 AND (male / (male + female) >= 0.8 OR male / (male + female) <= 0.2)) AS convincing FROM n""",
)
def name_credibility(spark, d):
    m, f = F.col("male"), F.col("female")
    return _name_counts(spark, d).select("name_id", names.male_share(m, f).alias("male_pct"), names.credibility(m, f).alias("tier"), names.convincing(F.lit("xx"), m, f).alias("convincing"))


@query(
    "gender_plausible",
    f"""WITH {_NAMES_SQL} SELECT name_id, CASE WHEN male + female < 100 THEN male > 0 ELSE male / (male + female) > 0.005 END AS as_male,
        CASE WHEN male + female < 100 THEN female > 0 ELSE male / (male + female) < 0.995 END AS as_female, male + female >= 1 AS as_any FROM n""",
)
def gender_plausible(spark, d):
    m, f = F.col("male"), F.col("female")
    return _name_counts(spark, d).select("name_id", *[names.gendered(m, f, F.lit(g)).alias(n) for g, n in (("M", "as_male"), ("F", "as_female"), (None, "as_any"))])


@query(
    "proximity_tiers",
    """WITH p AS (SELECT s_suppkey, (s_suppkey % 17) + 42.5 AS lat, -60.5 - (s_suppkey % 23) AS lon FROM supplier)
       SELECT s_suppkey, round(2 * 6371.0 * asin(sqrt(pow(sin((radians(lat) - radians(45.5)) / 2), 2) + cos(radians(45.5)) * cos(radians(lat)) * pow(sin(radians(lon + 73.5) / 2), 2))), 3) AS km,
       CASE WHEN 2 * 6371.0 * asin(sqrt(pow(sin((radians(lat) - radians(45.5)) / 2), 2) + cos(radians(45.5)) * cos(radians(lat)) * pow(sin(radians(lon + 73.5) / 2), 2))) < 25 THEN 750
       WHEN 2 * 6371.0 * asin(sqrt(pow(sin((radians(lat) - radians(45.5)) / 2), 2) + cos(radians(45.5)) * cos(radians(lat)) * pow(sin(radians(lon + 73.5) / 2), 2))) < 100 THEN 500
       WHEN 2 * 6371.0 * asin(sqrt(pow(sin((radians(lat) - radians(45.5)) / 2), 2) + cos(radians(45.5)) * cos(radians(lat)) * pow(sin(radians(lon + 73.5) / 2), 2))) < 250 THEN 350
       WHEN 2 * 6371.0 * asin(sqrt(pow(sin((radians(lat) - radians(45.5)) / 2), 2) + cos(radians(45.5)) * cos(radians(lat)) * pow(sin(radians(lon + 73.5) / 2), 2))) < 750 THEN 250
       WHEN s_suppkey % 2 = 0 AND s_suppkey % 3 = 0 THEN 250 WHEN s_suppkey % 2 = 0 THEN 150 ELSE 0 END AS points FROM p""",
)
def proximity_tiers(spark, d):
    k = F.col("s_suppkey")
    km = geo.haversine(F.lit(45.5), F.lit(-73.5), (k % 17) + 42.5, -60.5 - (k % 23))
    return table(spark, d, "supplier").select("s_suppkey", F.round(km, 3).alias("km"), geo.proximity_points(km, k % 2 == 0, k % 3 == 0).alias("points"))


@query(
    "hyphenated_names",
    """SELECT p_partkey, array_to_string(CASE WHEN p_partkey % 2 = 0 THEN [replace(p_name, ' ', '-'), split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)] ELSE [p_name] END, '|') AS names
       FROM part WHERE split_part(p_name, ' ', 1) <> split_part(p_name, ' ', 2) AND split_part(p_name, ' ', 3) = ''""",
)
def hyphenated_names(spark, d):
    w = F.split("p_name", " ")
    p = table(spark, d, "part").where((F.size(w) == 2) & (w[0] != w[1]))
    joined = F.when(F.col("p_partkey") % 2 == 0, F.concat_ws("-", w[0], w[1])).otherwise(F.col("p_name"))
    return p.select("p_partkey", F.array_join(names.hyphen_parts(F.array(joined)), "|").alias("names"))



#: Counts around the tiers' borders, unanimous and mixed.
_TIERS = [(0, 0), (9, 1), (10, 1), (49, 1), (50, 1), (249, 1), (250, 1), (1, 0), (0, 4), (5, 0), (0, 100), (99, 0), (3, 0), (7, 3), (20, 40), (999, 2), (2, 999), (5001, 1), (1, 9000)]
_TIERS_SQL = "v(k, male, female) AS (VALUES " + ", ".join(f"({k}, {m}, {f})" for k, (m, f) in enumerate(_TIERS)) + ")"


_TIER_SQL = """CASE WHEN male + female = 0 THEN 'zero' WHEN male * female > 0 THEN CASE WHEN male + female > 250 THEN 'veryHigh' WHEN male + female > 50 THEN 'high' WHEN male + female > 10 THEN 'medium' ELSE 'low' END
 WHEN male + female >= 100 THEN 'veryHigh' WHEN male + female >= 5 THEN 'high' ELSE 'medium' END"""


@query(
    "name_tiers",
    f"""WITH {_TIERS_SQL} SELECT c_custkey, {_TIER_SQL} AS tier, (CASE WHEN male + female > 0 THEN male / (male + female)::DOUBLE ELSE 0 END) > (CASE {_TIER_SQL} WHEN 'veryHigh' THEN 0.95 WHEN 'high' THEN 0.9 WHEN 'medium' THEN 0.75 WHEN 'low' THEN 0.5 ELSE 0.25 END) AS male_ok,
        (CASE WHEN male + female > 0 THEN male / (male + female)::DOUBLE ELSE 0 END) < (CASE {_TIER_SQL} WHEN 'veryHigh' THEN 0.05 WHEN 'high' THEN 0.1 WHEN 'medium' THEN 0.25 WHEN 'low' THEN 0.5 ELSE 0.75 END) AS female_ok,
        CASE WHEN male + female > 0 AND male::DOUBLE / (male + female) < 0.0025 THEN 0 ELSE male END AS male, CASE WHEN male + female > 0 AND male::DOUBLE / (male + female) > 0.9975 THEN 0 ELSE female END AS female,
        CASE WHEN c_custkey % 13 < 10 AND k >= 17 THEN 0 ELSE c_custkey % 13 END AS surnames FROM customer JOIN v ON k = c_custkey % {len(_TIERS)}""",
)
def name_tiers(spark, d):
    tiers = spark.createDataFrame([(i, (m, f)) for i, (m, f) in enumerate(_TIERS)], "k int, p struct<male:int,female:int>")
    c = table(spark, d, "customer").join(F.broadcast(tiers), F.col("c_custkey") % len(_TIERS) == F.col("k"))
    m, f, k = F.col("p.male"), F.col("p.female"), F.col("c_custkey")
    fixed = names.corrected(m, f, k % 13)
    return c.select(
        "c_custkey", names.credibility(m, f).alias("tier"), names.gender_consistent(m, f, F.lit("M")).alias("male_ok"), names.gender_consistent(m, f, F.lit(None).cast("string"), F.lit(0.05)).alias("female_ok"),
        fixed["male"].alias("male"), fixed["female"].alias("female"), fixed["surnames"].alias("surnames"),
    )


@query(
    "gender_of_names",
    f"""WITH {_TIERS_SQL}, t AS (SELECT k, CASE WHEN male + female > 0 THEN male / (male + female)::DOUBLE ELSE 0.5 END AS s, {_TIER_SQL} AS tier FROM v),
        c AS (SELECT c_custkey, c_custkey % 4 AS n, a.s AS s, a.tier AS tier, b.s AS s2, e.s AS s3 FROM customer JOIN t a ON a.k = c_custkey % {len(_TIERS)} JOIN t b ON b.k = c_custkey // 7 % {len(_TIERS)} JOIN t e ON e.k = c_custkey // 11 % {len(_TIERS)}),
        w AS (SELECT *, CASE tier WHEN 'veryHigh' THEN 0.9 WHEN 'high' THEN 0.8 ELSE 0.7 END::DOUBLE AS w, CASE tier WHEN 'zero' THEN 0.0 WHEN 'low' THEN 0.8 WHEN 'medium' THEN 0.875 WHEN 'high' THEN 0.95 ELSE 1.0 END::DOUBLE AS trust,
         CASE n WHEN 2 THEN s2 ELSE (s2 + s3) / 2 END AS rest, CASE n WHEN 2 THEN (s + s2) / 2 ELSE (s + s2 + s3) / 3 END AS mean FROM c),
        x AS (SELECT *, w * (0.5 - s) + (1 - w) * (0.5 - rest) AS c FROM w)
        SELECT c_custkey, round(CASE n WHEN 0 THEN 0.5 WHEN 1 THEN 0.5 - (0.5 - s) * trust ELSE 0.5 - CASE WHEN c <= 0 THEN c - (1 + c / 0.5) * mean * mean * 0.25 ELSE c + (1 - c / 0.5) * (1 - mean) * (1 - mean) * 0.25 END END, 9) AS p_male FROM x""",
)
def gender_of_names(spark, d):
    k, n = F.col("c_custkey"), len(_TIERS)
    tiers = spark.createDataFrame([(i, (m, f)) for i, (m, f) in enumerate(_TIERS)], "k int, pair struct<male:int,female:int>")
    rows = table(spark, d, "customer").select("c_custkey")
    for name, place in (("first", k % n), ("second", F.floor(k / 7) % n), ("third", F.floor(k / 11) % n)):
        rows = rows.join(F.broadcast(tiers.select("k", F.col("pair").alias(name))), place == F.col("k")).drop("k")
    listed = F.slice(F.array("first", "second", "third"), F.lit(1), (k % 4).cast("int"))
    return rows.select("c_custkey", F.round(names.gender_of(listed), 9).alias("p_male"))


@query(
    "name_variations",
    """SELECT c_custkey, array_to_string(list_sort(list_distinct(list_concat(['Al' || c_custkey % 3, 'Zoe'], CASE c_custkey % 3 WHEN 0 THEN ['Alan', 'Alf', 'Albert'] WHEN 1 THEN ['Andre'] ELSE [] END))), '|') AS variations FROM customer""",
)
def name_variations(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.array(F.concat(F.lit("Al"), (F.col("c_custkey") % 3).cast("string")), F.lit("Zoé")).alias("names"))
    first = spark.createDataFrame([("al0", ["Alan", "Alf"]), ("Nobody", ["X"])], "name string, alt_names array<string>")
    nick = spark.createDataFrame([("AL0", ["Albert", "Alan"]), ("al1", ["André"])], "nickname string, formal_names array<string>")
    return L.with_variations(c, "names", first, nick).select(F.col("id").alias("c_custkey"), F.array_join("variations", "|").alias("variations"))


@query(
    "name_kind",
    f"""WITH {_NAMES_SQL} SELECT name_id, CASE WHEN male = 0 AND female > 0 THEN 'surname' WHEN female * 1.25 * (CASE WHEN name_id % 2 = 0 THEN 1.0 ELSE 0.5 END) / nullif(male, 0) > 3 THEN 'surname'
        WHEN female * 1.25 * (CASE WHEN name_id % 2 = 0 THEN 1.0 ELSE 0.5 END) / nullif(male, 0) < 0.333 THEN 'given' ELSE 'unsure' END AS kind FROM n""",
)
def name_kind(spark, d):
    kind = names.likely_kind(F.lit("xx"), F.col("male"), F.col("female"), F.col("name_id") % 2 == 0)
    return _name_counts(spark, d).select("name_id", kind.alias("kind"))


@query(
    "merge_records",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'Alan|Ann|Al' ELSE 'Ann|Bea|Al' END AS names, coalesce(nullif(c_nationkey, 0), 99) AS place,
       DATE '1950-01-01' + (c_custkey % 10)::INT AS low, CASE WHEN c_custkey % 10 > 5 THEN DATE '1950-01-20' ELSE DATE '1950-01-10' END AS high FROM customer""",
)
def merge_records(spark, d):
    k = F.col("c_custkey")
    old = F.array(F.lit("Al"), F.when(k % 3 == 0, "Alan").otherwise("Ann"))
    new = F.array(F.when(k % 3 == 0, "Ann").otherwise("ann"), F.when(k % 3 == 0, "AL").otherwise("Bea"))
    lit = lambda s: F.lit(s).cast("date")
    ends = L.tightened(lit("1950-01-01"), F.when(k % 10 > 5, lit("1950-01-20")).otherwise(lit("1950-01-10")), F.date_add(lit("1950-01-01"), (k % 10).cast("int")), lit("1950-02-01"))
    return table(spark, d, "customer").select(
        "c_custkey", F.array_join(L.merged_names(old, new, F.array(F.lit("Al"))), "|").alias("names"), L.filled(F.col("c_nationkey"), F.lit(99), 0).alias("place"),
        ends["low"].alias("low"), ends["high"].alias("high"),
    )


@query(
    "source_ids",
    """SELECT o.o_orderkey, l.l_partkey AS found_id, CASE WHEN o.o_orderkey % 7 = l.l_partkey % 7 THEN 'exact' ELSE 'family' END AS kind FROM orders o
       JOIN lineitem l ON o.o_orderkey = l.l_orderkey AND o.o_custkey % 10 = l.l_suppkey % 10""",
)
def source_ids(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderkey").alias("source_id"), (F.col("o_custkey") % 10).alias("provider_id"), (F.col("o_orderkey") % 7).alias("provider_key"))
    l = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("source_id"), (F.col("l_suppkey") % 10).alias("provider_id"), (F.col("l_partkey") % 7).alias("provider_key"), F.col("l_partkey").alias("id"))
    return L.source_match(o, l).select("o_orderkey", "found_id", "kind")


@query(
    "rank_points",
    """SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN 1000 WHEN 1 THEN 1000 WHEN 2 THEN 500 WHEN 3 THEN 250 ELSE 0 END AS bounds, CASE WHEN s_suppkey % 2 = 0 THEN 750.0 ELSE 562.5 END::DOUBLE AS first,
       375.0::DOUBLE AS middle, CASE WHEN s_suppkey % 2 = 0 THEN 0.0 ELSE 375.0 END::DOUBLE AS spouse, s_suppkey % 2 = 1 AND s_suppkey % 3 = 0 AS again FROM supplier""",
)
def rank_points(spark, d):
    k, dob = F.col("s_suppkey"), F.lit("1940-01-01").cast("date")
    days = lambda *n: F.element_at(F.array(*[F.lit(x) for x in n]), (k % 5 + 1).cast("int"))
    low, high = F.date_add(dob, days(0, 0, 20, 300, 5000)), F.date_add(dob, days(0, 400, 40, 310, 5010))
    own, other = F.array(F.lit("ann")), F.when(k % 2 == 0, F.array(F.lit("ann"))).otherwise(F.array(F.lit("zoe")))
    wide = F.when(k % 2 == 0, F.array(F.lit("bob"))).otherwise(F.array(F.lit("ann"), F.lit("zoe")))
    again = rank.retry_reversed(F.when(k % 2 == 1, 1700).otherwise(1800), F.lit(True), k % 3 == 0, F.lit(True))
    return table(spark, d, "supplier").select(
        "s_suppkey", rank.bound_points(dob, low, high).cast("int").alias("bounds"), rank.first_points(own, other, own, wide).cast("double").alias("first"),
        rank.middle_points(own, own).cast("double").alias("middle"), rank.spouse_points(own, wide).cast("double").alias("spouse"), again.alias("again"),
    )
