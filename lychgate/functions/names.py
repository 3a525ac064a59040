"""Names: accents, similarity, conviction and credibility of name statistics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"


def unaccent(c: Column) -> Column:
    """Letters without accents; ligatures as two letters."""
    for one, two in (("œ", "oe"), ("Œ", "OE"), ("æ", "ae"), ("Æ", "AE"), ("ß", "ss"), ("ﬁ", "fi"), ("ﬂ", "fl")):
        c = F.replace(c, F.lit(one), F.lit(two))
    return F.translate(c, ACCENTED, PLAIN)


def name_key(c: Column) -> Column:
    """What two spellings of a name have in common."""
    return F.lower(unaccent(F.trim(c)))


def same_name(a: Column, b: Column) -> Column:
    return name_key(a) == name_key(b)


def initial_match(a: Column, b: Column) -> Column:
    """Whether one of two names is the other's initial."""
    x, y = name_key(a), name_key(b)
    return ((F.length(x) == 1) | (F.length(y) == 1)) & (F.left(x, F.lit(1)) == F.left(y, F.lit(1)))


def similarity(a: Column, b: Column, multiple: bool = False) -> Column:
    """Of two name lists: a pair of equal names counts 1, one where either is the other's initial 0.5. Single: the sum,
    1 at most. Multiple: the sum, or minus the shorter list's length if fewer pairs than that match. A name takes no more
    pairs after an equal one, nor an initial after its first."""
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("hits"), F.lit(False).alias("done"))

    def meet(x: Column):
        def step(acc: Column, y: Column) -> Column:
            p, q = name_key(x), name_key(y)
            initial = (F.length(p) == 1) | (F.length(q) == 1)
            hit = ~acc["done"] & F.when(initial, F.left(p, F.lit(1)) == F.left(q, F.lit(1))).otherwise(p == q)
            points = F.when(hit, F.when(initial, 0.5).otherwise(1.0)).otherwise(0.0)
            return F.struct((acc["sum"] + points).alias("sum"), (acc["hits"] + hit.cast("int")).alias("hits"), (acc["done"] | (hit & (~initial | (F.length(p) == 1)))).alias("done"))

        return F.aggregate(b, start, step)

    each = F.transform(a, meet)
    total = F.aggregate(each, F.lit(0.0), lambda s, x: s + x["sum"])
    if not multiple:
        return F.least(F.lit(1.0), total)
    hits = F.aggregate(each, F.lit(0), lambda s, x: s + x["hits"])
    least = F.least(F.size(a), F.size(b))
    return F.when(hits < least, -least.cast("double")).otherwise(total)


def male_share(male: Column, female: Column) -> Column:
    return F.when(male + female > 0, male / (male + female))


def credibility(male: Column, female: Column) -> Column:
    """Tier of a name's counts: zero, low, medium, high or veryHigh; unanimous counts rise sooner."""
    n = male + female
    unanimous = (male == 0) | (female == 0)
    return (
        F.when(n == 0, "zero")
        .when((n <= 10) & ~unanimous, "low")
        .when((n <= 50) & ~(unanimous & (n >= 5)), "medium")
        .when((n <= 250) & ~(unanimous & (n >= 100)), "high")
        .otherwise("veryHigh")
    )


def corrected(male: Column, female: Column, surnames: Column) -> Column:
    """(male, female, surnames) without what are likely errors of reading: the other gender where one has more than
    0.9975, and fewer than ten surnames of a name given more than 5000 times."""
    share = male_share(male, female)
    m, f = F.when(share < 0.0025, F.lit(0)).otherwise(male), F.when(share > 0.9975, F.lit(0)).otherwise(female)
    return F.struct(m.alias("male"), f.alias("female"), F.when((surnames < 10) & (m + f > 5000), F.lit(0)).otherwise(surnames).alias("surnames"))


#: The least share of a gender that a name of it may have, by credibility tier.
CONSISTENT = {"veryHigh": 0.95, "high": 0.90, "medium": 0.75, "low": 0.50, "zero": 0.25}


def gender_consistent(male: Column, female: Column, gender: Column, others: Column = None) -> Column:
    """Whether a name goes with a gender (M or F): its share must be above the tier's. For a null gender the likelihood of
    `others` (0 female to 1 male) decides if it is beyond 0.9 or 0.1."""
    share = F.coalesce(male_share(male, female), F.lit(0.0))
    least = F.create_map(*[F.lit(x) for kv in CONSISTENT.items() for x in kv])[credibility(male, female)]
    told = gender if others is None else F.coalesce(gender, F.when(others > 0.9, "M").when(others < 0.1, "F"))
    return F.coalesce(F.when(told == "M", share > least).when(told == "F", share < 1 - least), F.lit(False))


def gendered(male: Column, female: Column, gender: Column) -> Column:
    """Whether a name may be of a gender (M, F or null): by count when rare, else by share."""
    n = male + female
    share = male_share(male, female)
    return (
        F.when(gender == "M", F.when(n < 100, male > 0).otherwise(share > 0.005))
        .when(gender == "F", F.when(n < 100, female > 0).otherwise(share < 0.995))
        .otherwise(n >= 1)
    )


def convincing(name: Column, male: Column, female: Column) -> Column:
    """A name of two letters or more, seen ten times, mostly of one gender."""
    share = male_share(male, female)
    return (F.length(name) >= 2) & (male + female >= 10) & ((share >= 0.8) | (share <= 0.2))


def formal_first(names: Column, nicknames: Column) -> Column:
    """Names in order, those that are only nicknames last; no repeats."""
    distinct = F.array_distinct(names)
    return F.concat(F.filter(distinct, lambda x: ~F.array_contains(nicknames, x)), F.filter(distinct, lambda x: F.array_contains(nicknames, x)))


def hyphen_parts(names: Column, most: int = 4) -> Column:
    """Names and the parts of hyphenated ones, without repeats up to accents and case, `most` at most."""
    parts = F.flatten(F.transform(names, lambda x: F.when(F.contains(x, F.lit("-")), F.concat(F.array(x), F.split(x, "-"))).otherwise(F.array(x))))
    empty = F.array().cast("array<string>")
    kept = F.aggregate(parts, empty, lambda done, x: F.when(F.exists(done, lambda y: same_name(x, y)), done).otherwise(F.concat(done, F.array(x))))
    return F.slice(kept, 1, most)


def union_sorted(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_union(F.coalesce(a, F.array().cast("array<string>")), F.coalesce(b, F.array().cast("array<string>"))))


#: How far a single name's share is trusted, by credibility tier.
TRUST = {"zero": 0.0, "low": 0.8, "medium": 0.875, "high": 0.95, "veryHigh": 1.0}


def trusted_share(male: Column, female: Column) -> Column:
    """The male share drawn towards one half by its counts' credibility; one half without counts."""
    tier = credibility(male, female)
    trust = F.create_map(*[F.lit(x) for kv in TRUST.items() for x in kv])[tier]
    return F.lit(0.5) + (F.coalesce(male_share(male, female), F.lit(0.5)) - 0.5) * trust


#: The weight of the first of several names, by credibility tier.
FIRST_WEIGHT = {"zero": 0.7, "low": 0.7, "medium": 0.7, "high": 0.8, "veryHigh": 0.9}


def gender_of(counts: Column) -> Column:
    """From 0 (female) to 1 (male) of names as structs (male, female), the first name first; one half for none. One name:
    its trusted share. More: the first weighs FIRST_WEIGHT, the others share the rest; then a quarter of what is missing to
    certainty is added as often as the names agree on it, by the square of their mean share."""
    n = F.size(counts)
    shares = F.transform(counts, lambda c: F.coalesce(male_share(c["male"], c["female"]), F.lit(0.5)))
    first = F.get(counts, F.lit(0))
    weight = F.create_map(*[F.lit(x) for kv in FIRST_WEIGHT.items() for x in kv])[credibility(first["male"], first["female"])]
    total = F.aggregate(shares, F.lit(0.0), lambda a, x: a + x)
    lead = F.get(shares, F.lit(0))
    mean = weight * lead + (1 - weight) * (total - lead) / (n - 1)  # towards male above one half
    agree = F.when(mean >= 0.5, total / n).otherwise(1 - total / n)
    more = (1 - F.abs(mean - 0.5) / 0.5) * agree * agree * 0.25
    several = F.when(mean >= 0.5, mean + more).otherwise(mean - more)
    return F.when(n == 0, 0.5).when(n == 1, trusted_share(first["male"], first["female"])).otherwise(several)


def likely_kind(name: Column, given: Column, surnames: Column, known_gender: Column) -> Column:
    """given, surname or unsure: one letter is given; else by surnames for a given name, halved if the gender is
    unknown."""
    ratio = surnames * 1.25 * F.when(known_gender, 1.0).otherwise(0.5) / F.nullif(given, F.lit(0))
    return (
        F.when(F.length(name) == 1, "given").when((given == 0) & (surnames > 0), "surname").when(ratio > 3, "surname").when(ratio < 0.333, "given").otherwise("unsure")
    )


def valid_given(name: Column) -> Column:
    """A name to be counted: two letters or more after a closing full stop is cut, and no bare initial."""
    return (F.length(F.rtrim(name, F.lit("."))) >= 2) & ~name.rlike(r"^\p{L}\.$")


def formal_version(name: Column, nicknames: Column) -> Column:
    """Whether a name is in a list of formal names, up to accents and case."""
    return F.exists(nicknames, lambda x: same_name(x, name))
