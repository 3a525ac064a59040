"""Record linkage: blocking in passes, evidence bits, match keys, decisions, best candidates, load actions.

Candidates come from equality joins of several key sets, tagged with the pass; each comparator gives its part of
the evidence: bits of `same` or `differs`, whether the record has news or is unlike the stored one, how many data
could match and how many names do. The match key is one decision chain over the bits, and a decision follows from key
and evidence. Scores are numbers whose higher bits weigh more, so the best candidate is the greatest (key, score) with
ties to the earliest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lychgate.functions import dates
from lychgate.sources.scratch import written

#: The evidence bits. Scores are compared as numbers, so the order is the bits' importance.
BITS = {
    "prefix": 0, "suffix": 1, "middle": 2, "min_dob": 3, "max_dob": 4, "yob": 5, "yod": 6, "gender": 7, "first_like": 8,
    "first_aka2": 9, "first_aka1": 10, "first": 11, "dod": 12, "dob": 13, "second": 14, "last_alt3": 15, "last_alt2": 16,
    "last_alt1": 17, "last": 18, "dob_within": 19, "age": 20, "spouse": 21, "place": 22,
}

#: Match keys in ascending order of certainty.
KEYS = (
    "none", "no_key_alt_name_alt", "no_key_alt", "no_key_alt_name", "no_key", "close_dob_alt_name", "close_dob_name",
    "dod_alt_name_alt", "dod_name_alt", "dob_alt_name_alt", "dob_name_alt", "dod_alt_name", "dod_name", "dod_dob_alt_name",
    "dod_dob_name", "alt_key", "key", "alt_key_dob_dod_name_alt", "key_dob_dod_name_alt", "alt_key_dod", "key_dod", "id",
)

#: Dates up to this one stand for unknown ones, and the first from which a stored range counts.
UNKNOWN_DATE, LEAST_DATE = "1900-01-01", "1875-01-01"


def bit(name: str) -> int:
    return 1 << BITS[name]


def has(column: str, *names: str) -> Column:
    """Whether any of the named bits is set."""
    mask = reduce(int.__or__, map(bit, names))
    return F.col(column).bitwiseAND(F.lit(mask)) != 0


def candidates(records: DataFrame, master: DataFrame, passes: list[list[str]]) -> DataFrame:
    """(rec_id, cand_id, pass, position): pairs that agree on all keys of a pass; the first pass that finds a pair, and the
    place in the record of the name that it was found by. records and master hold id and the keys, records also position
    (0 to 9); null keys do not meet."""
    return met(keyed(records, passes), keyed(master, passes), passes).select("rec_id", "cand_id", "pass", "position")


def keyed(rows: DataFrame, passes: list[list[str]], told: DataFrame | None = None) -> DataFrame:
    """A side of met(): a row an id, with the different keys that it has in each pass, records' with their positions and in
    order; for each row of told (id, ...) of that id one, with told's columns."""
    place = ["position"] if "position" in rows.columns else []
    whole = lambda keys: F.when(reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in keys]), F.struct(*place, F.struct(*keys).alias("key")))
    kept = rows.groupBy("id").agg(*[F.array_sort(F.collect_set(whole(keys))).alias(f"_in{n}") for n, keys in enumerate(passes, 1)])
    return written(kept if told is None else kept.join(told.hint("merge"), "id"), "keyed")


def met(records: DataFrame, master: DataFrame, passes: list[list[str]], of: Iterable[int] | None = None) -> DataFrame:
    """(rec_id, cand_id, pass, position, ...) of two sides made by keyed(): pairs that agree in one of the passes `of` (numbers from 1,
    all if not given) and in no earlier one of all, where they first agree, with what was told of both.

    Both sides bring the keys of their other rows and passes along, so whether an earlier one finds a pair is seen where it is
    found: pairs, whose number may grow with the square of the tables, are neither shuffled nor written. For the same reason the
    sides' sizes tell nothing of the work, and their parts are not made fewer."""
    parts = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = [f"_in{n}" for n in range(1, len(passes) + 1)]
    more = [[c for c in side.columns if c not in ("id", *own)] for side in (records, master)]
    out = []
    for n in of or range(1, len(passes) + 1):
        names = [f"_key{j}" for j in range(len(passes[n - 1]))]
        l = records.select(F.col("id").alias("rec_id"), *more[0], *[F.transform(c, lambda x: x["key"]).alias(f"_l{c}") for c in own[:n]], F.posexplode(own[n - 1]).alias("_at", "_row"))
        l = l.select("*", F.slice(f"_l_in{n}", F.lit(1), F.col("_at")).alias("_before"), F.col("_row.position").alias("position"), *[F.col(f"_row.key.{k}").alias(c) for k, c in zip(passes[n - 1], names)])
        r = master.select(F.col("id").alias("cand_id"), *more[1], *[F.transform(c, lambda x: x["key"]).alias(f"_r{c}") for c in own[:n]], F.explode(own[n - 1]).alias("_row"))
        r = r.select("*", *[F.col(f"_row.key.{k}").alias(c) for k, c in zip(passes[n - 1], names)])
        l, r = l.drop("_at", "_row", f"_l_in{n}").repartition(parts, *names), r.drop("_row").repartition(parts, *names)
        earlier = [F.arrays_overlap("_before", f"_r_in{n}"), *[F.arrays_overlap(f"_l{c}", f"_r{c}") for c in own[: n - 1]]]
        rows = l.join(r.hint("merge"), names).where(~reduce(lambda x, y: x | y, earlier))
        out.append(rows.select("rec_id", "cand_id", F.lit(n).alias("pass"), "position", *more[0], *more[1]))
    return reduce(DataFrame.union, out)


def first_blocks(found: list[DataFrame]) -> DataFrame:
    first = reduce(DataFrame.union, found).groupBy("rec_id", "cand_id").agg(F.min("block").alias("block"))
    return first.select("rec_id", "cand_id", F.floor(F.col("block") / 10).cast("int").alias("pass"), (F.col("block") % 10).alias("position"))


def candidates_of_pass(records: DataFrame, master: DataFrame, keys: list[str], n: int, most: int | None = None, refine: tuple[str, ...] = ()) -> DataFrame:
    """(rec_id, cand_id, block) of pass n alone, block 10 times the pass and the position. Blocks, master rows of equal keys, of more than
    `most` rows meet by the columns `refine`, too. Both sides grow with the tables, so neither is sent to the driver: equal values lie so
    close in files that a table of a few MB there is hundreds in memory."""
    l = records.select(F.col("id").alias("rec_id"), (n * 10 + F.col("position")).alias("block"), *keys, *refine)
    r = master.select(F.col("id").alias("cand_id"), *keys, *refine)
    if most is None:
        return l.join(r.drop(*refine).hint("merge"), keys).select("rec_id", "cand_id", "block")
    large = written(r.groupBy(*keys).count().where(F.col("count") > most).select(*keys), "large")
    small = l.join(large, keys, "left_anti").drop(*refine).join(r.drop(*refine).hint("merge"), keys).select("rec_id", "cand_id", "block")
    return small.union(l.join(large, keys, "left_semi").join(r.hint("merge"), [*keys, *refine]).select("rec_id", "cand_id", "block"))


def settled_in_passes(
    records: DataFrame, master: DataFrame, rounds: list[list[list[str]]], score: Callable[[DataFrame], DataFrame], sufficient: Column, most: int | None = None, refine: tuple[str, ...] = ()
) -> DataFrame:
    """What early_stop() keeps of all passes, by joining and scoring one round of them after the other, and in each only the records
    that no earlier one settled. Passes of sharp keys may share a round; those of wide ones get rounds of their own. score makes evidence
    of candidates(); sufficient tells which of its rows settle a record; blocks are the record's names in a pass, in order. Every round is
    written, so a later one reads what is left."""
    todo, found, n = records, [], 0
    for k, passes in enumerate(rounds, 1):
        pairs = first_blocks([candidates_of_pass(todo, master, keys, n + j, most, refine) for j, keys in enumerate(passes, 1)])
        n += len(passes)
        for before in found:  # a pair counts in the first pass that finds it
            pairs = pairs.join(before.select("rec_id", "cand_id").hint("merge"), ["rec_id", "cand_id"], "left_anti")
        scored = score(pairs).withColumn("_block", F.col("pass") * 10 + F.col("position"))
        rows = written(early_stop(scored, sufficient, "_block").withColumn("_settled", sufficient), f"round-{k}")
        found.append(rows.drop("_settled", "_block"))
        if k < len(rounds):
            told = rows.where("_settled").select(F.col("rec_id").alias("id")).distinct()
            todo = written(todo.join(told.hint("merge"), "id", "left_anti"), f"todo-{k}")
    return reduce(DataFrame.union, found)


def block_of() -> Column:
    """Passes by name, in order."""
    return F.col("pass") * 10 + F.col("position")


def blocks_in_passes(records: DataFrame, master: DataFrame, rounds: list[list[list[str]]], score: Callable[[DataFrame], DataFrame], sufficient: Column, rank: Column) -> DataFrame:
    """(rec_id, block, best, settles, stop) of two sides made by keyed() with all passes: of each block of a record the greatest rank
    of its candidates and whether one is sufficient, and the record's first block that has such a one; blocks behind it are
    left out. By rounds of passes, as in settled_in_passes(), but pairs are scored where they meet and only blocks, some a record, are
    written: rank has to be a number, so that blocks are aggregated without sorting pairs."""
    passes, todo, found, n = [p for r in rounds for p in r], records, [], 0
    for k, own in enumerate(rounds, 1):
        rows = score(met(todo, master, passes, range(n + 1, n + len(own) + 1)))
        n += len(own)
        found.append(written(rows.groupBy("rec_id", block_of().alias("block")).agg(F.max(rank).alias("best"), F.max(sufficient).alias("settles")), f"round-{k}"))
        if k < len(rounds):
            todo = todo.join(found[-1].where("settles").select(F.col("rec_id").alias("id")).distinct().hint("merge"), "id", "left_anti")
    return early_stop(reduce(DataFrame.union, found).withColumn("stop", F.min(F.when(F.col("settles"), F.col("block"))).over(Window.partitionBy("rec_id"))), F.col("settles"), "block")


#: More than twice any id.
_IDS = Decimal(2**64)


def ranked(key: Column, score: Column, cand: Column) -> Column:
    """A number that is greatest for the greatest key, then score, then least id."""
    return (key.cast("long") * F.lit(2**32) + score.cast("long")).cast("decimal(20,0)") * F.lit(_IDS) - cand.cast("decimal(20,0)")


def ranked_id(rank: Column) -> Column:
    """The id in a number made by ranked()."""
    rest = F.pmod(-rank, F.lit(_IDS))
    return F.when(rest < F.lit(Decimal(2**63)), rest).otherwise(rest - F.lit(_IDS)).cast("long")


def early_stop(scored: DataFrame, sufficient: Column, block: str = "pass") -> DataFrame:
    """Of each record only the blocks (numbers in order: passes, or passes by last name) up to the first that held a
    sufficient candidate."""
    w = Window.partitionBy("rec_id")
    first = F.min(F.when(sufficient, F.col(block))).over(w)
    return scored.withColumn("_stop", first).where(F.col("_stop").isNull() | (F.col(block) <= F.col("_stop"))).drop("_stop")


def flag(test: Column, name: str) -> Column:
    """The bit's value where the test holds, else 0; a test on nulls does not hold."""
    return F.when(test, F.lit(bit(name))).otherwise(F.lit(0))


def either(*flags: Column) -> Column:
    return reduce(lambda a, b: a.bitwiseOR(b), flags)


#: What evidence is made of, each with what no evidence is.
_NOTHING = {"same": 0, "differs": 0, "news": False, "unlike": False, "potential": 0, "names": 0, "enough": False, "close": False}


def evidence(**parts: Column) -> dict[str, Column]:
    return {k: parts.get(k, F.lit(v)) for k, v in _NOTHING.items()}


def together(*parts: dict[str, Column]) -> list[Column]:
    """The columns of _NOTHING of all comparators: bits are united, numbers added, and any yes is a yes."""
    out = []
    for k, nothing in _NOTHING.items():
        own = [p[k] for p in parts]
        how = either if k in ("same", "differs") else (lambda *x: reduce(lambda a, b: a | b, x)) if nothing is False else (lambda *x: reduce(lambda a, b: a + b, x))
        out.append(how(*own).alias(k))
    return out


def _yes(test: Column) -> Column:
    """A test on nulls does not hold."""
    return F.coalesce(test, F.lit(False))


def _one(test: Column) -> Column:
    return _yes(test).cast("int")


def genders(rec: Column, db: Column) -> dict[str, Column]:
    """Genders, null if unknown."""
    one_sided = rec.isNull() != db.isNull()
    return evidence(
        same=flag(rec == db, "gender"), differs=flag(rec != db, "gender"), news=rec.isNotNull() & db.isNull(), unlike=one_sided | _yes(rec != db),
        potential=(rec.isNotNull() | db.isNotNull()).cast("int"),
    )


#: Fixed value: lists of so many names, which most are, are compared without functions of lists, by the same rules.
_FEW = 2


def _few(*lists: Column) -> Column:
    return reduce(lambda a, b: a & b, [F.size(x).between(0, _FEW) for x in lists])


def _any(names: Column, test: Callable[[Column], Column]) -> Column:
    """exists() of a list of at most _FEW."""
    return reduce(lambda a, b: a | b, [F.when(F.size(names) > j, test(F.get(names, F.lit(j)))).otherwise(F.lit(False)) for j in range(_FEW)])


def _hits(rec: Column, db: Column, same: Callable[[Column, Column], Column]) -> Column:
    """In how many pairs of two lists the names are the same."""
    met = [F.when((F.size(rec) > j) & (F.size(db) > k) & same(F.get(rec, F.lit(j)), F.get(db, F.lit(k))), 1).otherwise(0) for j in range(_FEW) for k in range(_FEW)]
    every = F.aggregate(rec, F.lit(0), lambda n, x: n + F.size(F.filter(db, lambda y: same(x, y))))
    return F.when(_few(rec, db), reduce(lambda a, b: a + b, met)).otherwise(every)


def _missing(rec: Column, db: Column, same: Callable[[Column, Column], Column]) -> Column:
    return F.when(_few(rec, db), _any(rec, lambda x: ~_any(db, lambda y: same(x, y)))).otherwise(F.exists(rec, lambda x: ~F.exists(db, lambda y: same(x, y))))


def _equal(x: Column, y: Column) -> Column:
    return x == y


def _initial_or_equal(x: Column, y: Column) -> Column:
    """A record's name of one letter is any stored one that it begins."""
    return F.when(F.length(x) == 1, F.left(y, F.lit(1)) == x).otherwise(x == y)


def last_names(rec: Column, db: Column) -> dict[str, Column]:
    """Lists of last names; a bit tells the place in the stored list. Names left over on both sides differ; two or more that
    are all of the shorter list are enough."""
    n, shorter, longer = _hits(rec, db, _equal), F.least(F.size(rec), F.size(db)), F.greatest(F.size(rec), F.size(db))
    bits = [flag(F.array_contains(rec, F.get(db, F.lit(j))), name) for j, name in enumerate(("last", "last_alt1", "last_alt2", "last_alt3"))]
    apart = (F.size(db) > n) & (F.size(rec) > n)
    return evidence(
        same=either(*bits), differs=flag(apart, "last"), news=_missing(rec, db, _equal), unlike=(F.size(rec) != F.size(db)) | (n != F.size(db)), potential=longer,
        names=F.when(apart, 0).otherwise(n), enough=(n >= 2) & (n == shorter),
    )


def first_names(rec: Column, db: Column, related: Callable[[Column, Column], Column] = lambda x, y: F.lit(False)) -> dict[str, Column]:
    """Lists of first names; related(record's, stored) tells formal and informal versions, which count less and are news.
    `enough` is left to be met with that of the last names."""
    n = _hits(rec, db, _initial_or_equal)
    other = lambda some: some(rec, lambda x: (F.length(x) > 1) & some(db, lambda y: (x != y) & related(x, y)))
    like = F.when(_few(rec, db), other(_any)).otherwise(other(F.exists))
    return evidence(
        same=either(flag(n > 0, "first"), flag(like, "first_like")), news=_missing(rec, db, _initial_or_equal), unlike=(F.size(rec) != F.size(db)) | (n != F.size(db)),
        potential=F.greatest(F.size(rec), F.size(db)), names=(n >= 1).cast("int"), enough=n >= 1,
    )


def middle_names(rec: Column, db: Column) -> dict[str, Column]:
    n = _hits(rec, db, _initial_or_equal)
    apart = (F.size(db) > n) & (F.size(rec) > n)
    return evidence(
        same=flag(n > 0, "middle"), differs=flag(apart, "middle"), news=_missing(rec, db, _initial_or_equal), unlike=(F.size(rec) != F.size(db)) | (n != F.size(db)),
        potential=F.greatest(F.size(rec), F.size(db)), names=F.when(apart, 0).otherwise(n),
    )


def named(last: dict, first: dict, middle: dict) -> list[dict]:
    """The three comparators of names, enough only if last and first names both are."""
    enough = last["enough"] & first["enough"]
    return [last | {"enough": enough}, first | {"enough": F.lit(False)}, middle]


def _known(d: Column) -> Column:
    return _yes(d > F.lit(UNKNOWN_DATE).cast("date"))


def _width(low: Column, high: Column, least: str) -> Column:
    """Years of a range, 99 if it is not known."""
    return F.when(_yes(low > F.lit(least).cast("date")) & high.isNotNull(), dates.elapse_actuarial(low, high)).otherwise(F.lit(99.0))


def births(rec: Column, db: Column) -> dict[str, Column]:
    """Dates of birth as structs (exact, year, low, high), null where unknown."""
    a, b = rec["exact"], db["exact"]
    have, stored = _known(a), _known(b)
    rec_width, db_width = _width(rec["low"], rec["high"], UNKNOWN_DATE), _width(db["low"], db["high"], LEAST_DATE)
    both, neither = have & stored, ~have & ~stored
    years = ~both & _yes(rec["year"] > 0) & _yes(db["year"] > 0)
    only_rec, only_db = have & ~stored & (db_width < 2), stored & ~have & (rec_width < 2)
    in_db, in_rec = _yes(a.between(db["low"], db["high"])), _yes(b.between(rec["low"], rec["high"]))
    ranges = neither & (db_width < 2) & (rec_width < 2)
    shared = ((rec["low"] == db["low"]) | (rec["high"] == db["high"])) & (db_width <= 1) & (rec_width <= 1)
    held = _yes((rec["low"] >= db["low"]) & (rec["high"] <= db["high"])) | _yes(shared)
    apart = _yes(rec["low"] > db["high"]) | _yes(rec["high"] < db["low"])
    off = [both & (a != b), years & (rec["year"] != db["year"]), only_rec & ~in_db, only_db & ~in_rec, ranges & ~held, apart]
    return evidence(
        same=either(flag(both & (a == b), "dob"), flag(years & (rec["year"] == db["year"]), "yob"), flag((only_rec & in_db) | (only_db & in_rec), "dob_within"), flag(ranges & held, "min_dob"), flag(ranges & held, "max_dob")),
        differs=either(flag(off[0] | off[2] | off[3] | apart, "dob"), flag(off[1], "yob"), flag(off[4] | apart, "min_dob"), flag(off[4] | apart, "max_dob")),
        news=(have & ~stored & ((db_width >= 2) | in_db)) | (neither & (db_width >= 2) & (rec_width < 2)), unlike=_yes(reduce(lambda x, y: x | y, off)),
        potential=(have | stored | _yes(rec["year"] > 0) | _yes(db["year"] > 0)).cast("int"), close=~apart & _yes(F.year(db["high"]) - F.year(rec["low"]) <= 1),
    )


def deaths(rec: Column, db: Column) -> dict[str, Column]:
    """Dates of death as structs (exact, year)."""
    a, b, x, y = rec["exact"], db["exact"], rec["year"], db["year"]
    have, stored = _known(a), _known(b)
    both = have & stored
    years = ~both & _yes(x > 0) & _yes(y > 0)
    other = ~both & ~years & (~a.eqNullSafe(b) | ~x.eqNullSafe(y))
    return evidence(
        same=either(flag(both & (a == b), "dod"), flag(years & (x == y), "yod")), differs=either(flag(both & (a != b), "dod"), flag(years & (x != y), "yod")),
        news=(have & ~stored) | (_yes(x > 0) & ~_yes(y > 0)), unlike=_yes(both & (a != b)) | _yes(years & (x != y)) | other,
        potential=(have | stored | _yes(x > 0) | _yes(y > 0)).cast("int"),
    )


def births_and_deaths(rec_dob: Column, db_dob: Column, rec_dod: Column, db_dod: Column) -> dict[str, Column]:
    """One side's death after the other's latest birth, where that one has no dates but an open range: such a latest birth
    stands for the death."""

    def after(dod: Column, other_dod: Column, other_dob: Column) -> Column:
        open_range = _yes(other_dob["low"] <= F.lit(UNKNOWN_DATE).cast("date"))
        return _known(dod["exact"]) & ~_known(other_dod["exact"]) & ~_known(other_dob["exact"]) & open_range & _yes(dod["exact"] > other_dob["high"])

    off = after(rec_dod, db_dod, db_dob) | after(db_dod, rec_dod, rec_dob)
    return evidence(differs=flag(off, "dod"), unlike=off)


def ages(rec: Column, db: Column) -> dict[str, Column]:
    """Ages, null if unknown."""
    return evidence(same=flag(rec == db, "age"), differs=flag(rec != db, "age"), unlike=~rec.eqNullSafe(db), potential=(rec.isNotNull() | db.isNotNull()).cast("int"))


def spouses(rec: Column, db: Column, related: Callable[[Column, Column], Column] = lambda x, y: F.lit(False)) -> dict[str, Column]:
    same = (F.lower(rec) == F.lower(db)) | related(rec, db)
    both = (F.length(rec) > 0) & (F.length(db) > 0)
    return evidence(same=flag(both & same, "spouse"), differs=flag(both & ~same, "spouse"))


def places(km: Column) -> dict[str, Column]:
    """By distance, null if a place is not known."""
    return evidence(same=flag(km <= 25, "place"), differs=flag(km > 1500, "place"), unlike=_yes(km > 200))


def by_pass(n: Column, parts: list[dict], dob: dict, dod: dict, both: dict) -> list[Column]:
    """Evidence of the comparators and of dates: what a pass was joined on is the same without comparing."""
    first, second, third = n == 1, n == 2, n == 3
    joined = evidence(
        same=F.when(first, F.lit(bit("dob") | bit("dod") | bit("yob") | bit("yod"))).when(second, F.lit(bit("dob") | bit("yob"))).when(third, F.lit(bit("dod") | bit("yod"))).otherwise(F.lit(0)),
        potential=F.when(first, 2).when(second | third, 1).otherwise(0),
    )

    def where(test: Column, part: dict) -> dict:
        return {k: F.when(test, c).otherwise(F.lit(_NOTHING[k])) for k, c in part.items()}

    return together(*parts, joined, where(~(first | second), dob), where(~(first | third), dod), where(~(first | second | third), both))


def match_key(same: str = "same", differs: str = "differs") -> Column:
    """The match key's place in KEYS, from evidence bits."""
    k = KEYS.index
    dob, dod = has(same, "dob"), has(same, "dod")
    last, alt = has(same, "last"), has(same, "last_alt1", "last_alt2", "last_alt3")
    first, like, within = has(same, "first"), has(same, "first_like"), has(same, "dob_within")
    clash = has(differs, "dob", "yob", "dod", "yod", "age")

    def by_dod(with_dod: str, without: str) -> Column:
        return F.when(dod, k(with_dod)).otherwise(k(without))

    born = (
        F.when(dob & last, by_dod("key_dob_dod_name_alt", "dob_name_alt")).when(dob & alt, by_dod("alt_key_dob_dod_name_alt", "dob_alt_name_alt"))
        .when(last, by_dod("dod_dob_name", "dod_dob_alt_name")).when(alt, by_dod("close_dob_name", "close_dob_alt_name")).otherwise(k("none"))
    )
    return F.when(clash | has(differs, "last"), F.lit(k("none"))).otherwise(
        F.when((dob | has(same, "place")) & last & first, by_dod("key_dod", "key"))
        .when(dob & alt & first, by_dod("alt_key_dod", "alt_key"))
        .when((dob | within) & like, born)
        .when(last & first, by_dod("dod_name", "no_key"))
        .when(last & like, by_dod("dod_name_alt", "no_key_alt"))
        .when(~last & alt & first, by_dod("dod_alt_name", "no_key_alt_name"))
        .when(~last & alt & like, by_dod("dod_alt_name_alt", "no_key_alt_name_alt"))
        .otherwise(k("none"))
    )


def decided(rows: DataFrame, recent: Column | None = None, family: Column | None = None, by_alternate: Column | None = None, same_id: Column | None = None) -> DataFrame:
    """rows of evidence with match_key, known (the record is stored already) and sufficient (nothing is left to ask).

    Keys from dod_name on decide; below, nothing that differs, six data that could match on like records, enough names, or
    three names with close births or places promote a candidate; what is left with anything that differs is none.
    recent: the death lies less than 60 days back; family: the source is of the same family; by_alternate: found by an alternate
    last name, by which a key is only an alternate one; same_id: the source's id is the same, which is the highest key."""
    k, none = KEYS.index, F.lit(False)
    clean, key = F.col("differs") == 0, F.col("_key")
    high = key >= k("dod_name")
    plain = clean & ((key >= k("dod_alt_name_alt")) | ((key >= k("dod_alt_name")) & has("same", "age")))
    many = ~plain & (F.col("potential") >= 6) & ~F.col("unlike")
    name = ~plain & ~many & (key >= k("no_key")) & clean & (F.col("enough") | ((F.col("names") >= 3) & (F.col("close") | has("same", "place"))))
    enough = high | many | name
    lost = ~enough & ~clean
    rows = rows.withColumn("_key", match_key()).withColumn("_enough", enough).withColumn("_known", (enough | plain) & ~lost)
    rows = rows.withColumn("_key", F.when(lost, F.lit(k("none"))).when((F.col("_key") == k("key")) & (none if by_alternate is None else by_alternate), F.lit(k("alt_key"))).otherwise(F.col("_key")))
    minor = ~has("differs", "dob", "yob", "dod", "yod", "age")
    told = F.col("_enough") | (F.col("_known") & (F.col("_key") >= k("dod_name")) & (none if recent is None else _yes(recent)))
    told = told | (F.col("_known") & (F.col("_key") >= k("no_key")) & minor & (none if family is None else _yes(family)))
    by_id = none if same_id is None else _yes(same_id)
    return rows.select(
        *[c for c in rows.columns if c not in ("_key", "_enough", "_known")], F.when(by_id, F.lit(k("id"))).otherwise(F.col("_key")).alias("match_key"),
        (by_id | F.col("_known")).alias("known"), (by_id | told).alias("sufficient"),
    )


def net_score(same: str = "same", differs: str = "differs") -> Column:
    return F.col(same) - 2 * F.bit_count(F.col(differs))


def best(scored: DataFrame, by: str, *order: Column) -> DataFrame:
    """One row of each `by`: the first in order."""
    w = Window.partitionBy(by).orderBy(*order)
    return scored.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def run_action(run_code: Column, acceptable: Column, new_info: Column, same_feed: Column, sufficient: Column) -> Column:
    """What to do with an incoming record: force_new (100), override (101), junk (900), replace (any other
    code but 0 and 1, an existing id), update or insert."""
    update = acceptable & (new_info | ~same_feed | sufficient)
    return (
        F.when(run_code == 100, "force_new").when(run_code == 101, "override").when(run_code == 900, "junk")
        .when(~run_code.isin(0, 1), "replace").when(update, "update").when(acceptable, "skip").otherwise("insert")
    )


def variant_rows(df: DataFrame, names: str, most: int = 4) -> DataFrame:
    """A row for each of up to `most` name variants, weighted 1/n cut to hundredths, the rest on the last."""
    n = F.size("_v")
    part = F.floor(100 / n) / 100
    rows = df.withColumn("_v", F.slice(F.col(names), 1, most)).select("*", F.posexplode("_v").alias("position", "variant"))
    weight = F.when(F.col("position") == n - 1, F.round(1 - (n - 1) * part, 2)).otherwise(part)
    return rows.withColumn("weight", weight).drop("_v")


def with_variations(records: DataFrame, names: str, first_names: DataFrame, nicknames: DataFrame, out: str = "variations") -> DataFrame:
    """records (id, ...) with the names of a list column and all their versions: alternatives of first_names (name, alt_names)
    and formal names of nicknames (nickname, formal_names), without accents, sorted, each once."""
    from lychgate.functions.names import name_key, unaccent

    own = records.select("id", F.explode(names).alias("_name")).withColumn("_key", name_key(F.col("_name")))
    known = first_names.select(name_key(F.col("name")).alias("_key"), F.explode("alt_names").alias("_other")).unionByName(
        nicknames.select(name_key(F.col("nickname")).alias("_key"), F.explode("formal_names").alias("_other"))
    )
    more = own.join(known, "_key").select("id", F.col("_other").alias("_name"))
    grouped = own.select("id", "_name").union(more).groupBy("id").agg(F.array_sort(F.collect_set(unaccent(F.col("_name")))).alias(out))
    return records.join(grouped, "id", "left").withColumn(out, F.coalesce(out, F.array().cast("array<string>")))


def merged_names(old: Column, new: Column, nicknames: Column, most: int = 3) -> Column:
    """First names of a record and its update: old ones first, without repeats up to accents and case, formal ones
    before nicknames, `most` at most."""
    from lychgate.functions import names

    empty = F.array().cast("array<string>")
    both = F.concat(F.coalesce(old, empty), F.coalesce(new, empty))
    kept = F.aggregate(both, empty, lambda done, x: F.when(F.exists(done, lambda y: names.same_name(x, y)), done).otherwise(F.concat(done, F.array(x))))
    return F.slice(names.formal_first(kept, nicknames), 1, most)


def filled(old: Column, new: Column, unknown=None) -> Column:
    """The old value, or the new one where the old is null or stands for unknown."""
    known = old if unknown is None else F.nullif(old, F.lit(unknown))
    return F.coalesce(known, new)


def tightened(old_low: Column, old_high: Column, new_low: Column, new_high: Column) -> Column:
    """The common part of two ranges; the old one where they do not meet."""
    low, high = F.greatest(old_low, new_low), F.least(old_high, new_high)
    apart = F.coalesce(low > high, F.lit(False))
    return F.struct(F.when(apart, old_low).otherwise(low).alias("low"), F.when(apart, old_high).otherwise(high).alias("high"))


def source_match(records: DataFrame, known: DataFrame, compat: bool = False) -> DataFrame:
    """Records with the ids of stored sources of the same provider and id: `exact` if the provider's key is the
    same too, else `family`. compat: never exact."""
    k = known.select("provider_id", "source_id", F.col("provider_key").alias("_key"), F.col("id").alias("found_id"))
    kind = F.when(F.lit(not compat) & (F.col("provider_key") == F.col("_key")), "exact").otherwise("family")
    return records.join(k, ["provider_id", "source_id"]).withColumn("kind", kind).drop("_key")
