"""Evidence from the text of a notice: language, gender, dates, ages, spouse, names, and its arbitration.

All are columns over whole texts, so a corpus is read once. Written dates and ages are read in Arrow batches (functions/written.py); the rest
stays in the JVM.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lychgate.functions import personal
from lychgate.functions import text as T
from lychgate.functions import written as W
from lychgate.functions.written import MONTHS as MONTHS

#: Frequent words of each language.
LANGUAGE_WORDS = {
    "en": ("the", "and", "of", "was", "in", "to", "his", "her", "he", "she", "with", "for", "is", "that"),
    "fr": ("le", "la", "les", "de", "des", "et", "un", "une", "du", "est", "dans", "son", "sa", "qui"),
    "es": ("el", "los", "las", "del", "y", "que", "en", "con", "su", "por", "una", "se", "al"),
}
#: Words that tell the gender of the person spoken of, by language.
GENDER_WORDS = {
    "en": {
        "M": ("he", "his", "him", "father", "husband", "son", "brother", "grandfather", "uncle"),
        "F": ("she", "her", "hers", "mother", "wife", "daughter", "sister", "grandmother", "aunt"),
    },
    "fr": {"M": ("il", "père", "époux", "fils", "frère"), "F": ("elle", "mère", "épouse", "fille", "soeur")},
    "es": {"M": ("él", "padre", "esposo", "hijo", "hermano"), "F": ("ella", "madre", "esposa", "hija", "hermana")},
}
#: Words of those left behind that tell the gender of who is spoken of, after a word of affection.
RELATION_WORDS = {
    "M": ("husband", "father", "dad", "son", "brother", "grandfather", "grandpa", "uncle", "nephew", "époux", "père", "fils", "frère"),
    "F": ("wife", "mother", "mom", "daughter", "sister", "grandmother", "grandma", "aunt", "niece", "épouse", "mère", "fille", "soeur"),
}
AFFECTION = r"(?:beloved|loving|devoted|dear|cherished|proud|caring|cher|chère|bien-aimée?|tendre)"
DEITY = r"\b(?:God|Lord|Jesus|Christ|Dieu|Seigneur|Dios|Señor)\b"
TITLES = {"M": ("mr", "monsieur", "m", "sir"), "F": ("mrs", "ms", "miss", "mme", "madame", "mlle")}
BORN, DIED, MARRIED = r"(?i)\b(born|birth|née? le)\b", r"(?i)\b(died|passed away|death|décédée?)\b", r"(?i)\b(married|wed)\b"
SERVICE = r"(?i)\b(funeral|service|memorial|visitation|funérailles)\b"
SPOUSE = r"(?:[Hh]is wife|[Hh]er husband|[Hh]usband of|[Ww]ife of|[Bb]eloved spouse of)(?: (?:of )?[0-9]+ years)?,? (\p{Lu}\p{L}+)"
STILLBORN = r"(?i)\b(stillborn|born sleeping|mort-née?)\b"


def count_in(words: Column, lexicon) -> Column:
    return F.size(F.filter(words, lambda w: w.isin(*lexicon)))


def language_counts(text: Column, use) -> Column:
    """use(counts) with the number of each language's frequent words, {language: column}; the words are made once, and those
    of no list are left out before they are counted."""
    every = sorted({w for words in LANGUAGE_WORDS.values() for w in words})
    kept = F.filter(T.words(text), lambda w: w.isin(*every))
    return T.once(kept, lambda w: use({k: count_in(w, v) for k, v in LANGUAGE_WORDS.items()}))


def _vote(n: dict[str, Column], prior: Column | None) -> Column:
    vote = F.when((n["fr"] > n["en"]) & (n["fr"] >= n["es"]), "fr").when((n["es"] > n["en"]) & (n["es"] > n["fr"]), "es").otherwise("en")
    return F.when(n["en"] + n["fr"] + n["es"] == 0, F.lit(None).cast("string") if prior is None else prior).otherwise(vote)


def language_vote(text: Column, prior: Column | None = None) -> Column:
    """en on ties, fr if more than en and no fewer than es, es if more than both; the prior if none counts."""
    return language_counts(text, lambda n: _vote(n, prior))


def languages_counted(text: Column, known: Column | None = None, least: int = 5) -> Column:
    """How many languages count `least` words, and 10 more if the known language is another one than the text's."""

    def use(n: dict[str, Column]) -> Column:
        several = sum(((c >= least).cast("int") for c in n.values()), F.lit(0))
        return several if known is None else several + F.when(F.coalesce(known != _vote(n, None), F.lit(False)), 10).otherwise(0)

    return language_counts(text, use)


def bilingual(text: Column, known: Column | None = None, least: int = 5) -> Column:
    """Whether two languages or more count `least` words, or the known one is another."""
    return languages_counted(text, known, least) >= 2


def gender_counts(text: Column, language: Column, use) -> Column:
    """use(male, female) with the words of the language that tell a gender; none for a null language."""
    every = sorted({w for of in GENDER_WORDS.values() for words in of.values() for w in words})

    def count(words: Column, gender: str) -> Column:
        n = F.lit(0)
        for k, of in GENDER_WORDS.items():
            n = F.when(language == k, count_in(words, of[gender])).otherwise(n)
        return n

    return T.once(F.filter(T.words(text), lambda w: w.isin(*every)), lambda w: use(count(w, "M"), count(w, "F")))


def gender_vote(text: Column, language: Column | None = None, margin: int = 3) -> Column:
    """M or F where the words for one in the text's language (the one given, or by vote) are more than `margin` ahead, else
    null."""
    told = language_vote(text) if language is None else language
    return gender_counts(text, told, lambda m, f: F.when(m > f + margin, "M").when(f > m + margin, "F"))


def deity_corrected(gender: Column, text: Column, male: Column, female: Column, share: Column) -> Column:
    """A male gender of a text that speaks of a deity, whose pronouns are male: where the names' likelihood of a male (share,
    0 to 1) is below 0.75, fewer female words allow it only for likelier names, and two or more take it back. Of more than
    15 male words a fifth of those beyond 10 is set off against the female ones."""
    net = F.when((female > 0) & (male > 15), F.greatest(F.lit(0), female - F.floor((male - 10) / 5))).otherwise(female)
    unsure = F.lit(None).cast("string")
    told = (
        F.when(net == 0, F.when(share < 0.025, "F").when(share < 0.1, unsure).otherwise(gender))
        .when(net == 1, F.when(share < 0.05, "F").when(share < 0.2, unsure).otherwise(gender))
        .when(net == 2, unsure).otherwise("F")
    )
    return F.when((gender == "M") & text.rlike(DEITY) & (share < 0.75), told).otherwise(gender)


def relation_gender(text: Column) -> Column:
    """M or F where words like "beloved wife" tell more often of one, else null."""
    n = {g: F.regexp_count(text, F.lit(rf"(?i)\b{AFFECTION}\s+(?:{'|'.join(words)})\b")) for g, words in RELATION_WORDS.items()}
    return F.when(n["M"] > n["F"], "M").when(n["F"] > n["M"], "F")


def gender_by_evidence(*evidence: Column) -> Column:
    """The first of ordered evidence that tells: title, pronouns, other names, relations, likelihood of the names."""
    return F.coalesce(*evidence)


def gender_by_share(share: Column, sure: float = 0.9) -> Column:
    """M or F by the names' likelihood of a male."""
    return F.when(share >= sure, "M").when(share <= 1 - sure, "F")


def name_order(first_given: Column, first_surname: Column, last_given: Column, last_surname: Column, often: int = 3) -> Column:
    """keep, swap or unsure for a first and a last name, from how often each stands as a given name and as a surname: swapped if
    each is `often` times as frequent in the other's place and neither fits its own."""
    fits = (first_given >= first_surname) | (last_surname >= last_given)
    turned = (first_surname > often * first_given) & (last_given > often * last_surname)
    return F.when(turned, "swap").when(fits, "keep").otherwise("unsure")


def title_gender(name: Column) -> Column:
    first = F.lower(F.regexp_extract(name, r"^\s*(\p{L}+)\.?\s", 1))
    return F.when(first.isin(*TITLES["M"]), "M").when(first.isin(*TITLES["F"]), "F")


def written_dates(text: Column) -> Column:
    """All dates written with a month's name, in order."""
    return F.transform(F.filter(W.found_dates(T.sentences(text)), lambda d: d["date"].isNotNull()), lambda d: d["date"])


def _with_sentences(text: Column, use) -> Column:
    """use(sentences, complete dates in them)."""
    told = F.struct(T.sentences(text).alias("sentences"), F.filter(W.found_dates(T.sentences(text)), lambda d: d["date"].isNotNull()).alias("dates"))
    return T.once(told, lambda x: use(x["sentences"], x["dates"]))


def dates_near(text: Column, **keywords: str) -> Column:
    """A struct with a date for each keyword: the first one in the first sentence that holds the keyword and a date, after
    the keyword if there is one, else the sentence's first. Sentences are parted and read once."""

    def told(sentences: Column, dates: Column, keyword: str) -> Column:
        # The words of ceremony are no keyword's, and come after what is told of the person.
        own = F.filter(dates, lambda d: F.get(sentences, d["sentence"]).rlike(keyword))
        first = F.filter(own, lambda d: d["sentence"] == F.get(own, F.lit(0))["sentence"])
        after = F.filter(first, lambda d: d["start"] + 1 > F.regexp_instr(F.get(sentences, d["sentence"]), F.lit(keyword)))
        return F.coalesce(F.get(after, F.lit(0)), F.get(first, F.lit(0)))["date"]

    return _with_sentences(text, lambda s, d: F.struct(*[told(s, d, k).alias(name) for name, k in keywords.items()]))


def date_near(text: Column, keyword: str) -> Column:
    """The date of one keyword as dates_near() finds it."""
    return dates_near(text, date=keyword)["date"]


def born_and_died(text: Column) -> Column:
    """(born, died, credible): the dates of birth and death; both are the date of a stillbirth. Dates behind a word of ceremony do not count, and
    nothing from the third sentence on is fully credible."""

    def use(sentences: Column, dates: Column) -> Column:
        own = F.filter(dates, lambda d: ~d["ceremony"])

        def near(keyword: str) -> Column:
            fit = F.filter(own, lambda d: F.get(sentences, d["sentence"]).rlike(keyword))
            first = F.filter(fit, lambda d: d["sentence"] == F.get(fit, F.lit(0))["sentence"])
            after = F.filter(first, lambda d: d["start"] + 1 > F.regexp_instr(F.get(sentences, d["sentence"]), F.lit(keyword)))
            return F.coalesce(F.get(after, F.lit(0)), F.get(first, F.lit(0)))

        still = near(STILLBORN)
        born, died = F.coalesce(still, near(BORN)), F.coalesce(still, near(DIED))
        last = F.greatest(born["sentence"], died["sentence"])
        return F.struct(born["date"].alias("born"), died["date"].alias("died"), F.when(last.isNotNull(), last < 2).alias("credible"))

    return _with_sentences(text, use)


def service_date(text: Column) -> Column:
    """The date of a sentence that speaks of a service and holds exactly one."""

    def use(sentences: Column, dates: Column) -> Column:
        alone = F.filter(dates, lambda d: F.get(sentences, d["sentence"]).rlike(SERVICE) & (F.size(F.filter(dates, lambda e: e["sentence"] == d["sentence"])) == 1))
        return F.get(alone, F.lit(0))["date"]

    return _with_sentences(text, use)


def heading_dates(text: Column, words: int = 8) -> Column:
    """(first, second) of a heading, null where none: dates that end within half of `words` words, and within all of them."""
    dates = F.filter(W.found_dates(F.array(text)), lambda d: d["date"].isNotNull())

    def use(found: Column) -> Column:
        first, second = F.get(found, F.lit(0)), F.get(found, F.lit(1))
        near = first["past"] <= words // 2
        return F.struct(F.when(near, first["date"]).alias("first"), F.when(near & (second["past"] <= words), second["date"]).alias("second"))

    return T.once(dates, use)


def numeric_dates(text: Column, as_of: Column) -> Column:
    """Dates written in numbers, in order: structs (date, conviction) as dates.numeric_date() reads them."""
    from lychgate.functions import dates

    found = F.regexp_extract_all(text, F.lit(r"(?<![0-9./-])[0-9]{1,4}([-/.])[0-9]{1,2}\1[0-9]{1,4}(?![0-9]|[./-][0-9])"), F.lit(0))
    parts = F.transform(found, lambda x: F.transform(F.split(x, "[-/.]"), lambda p: p.cast("int")))
    return F.filter(F.transform(parts, lambda p: dates.numeric_date(p[0], p[1], p[2], as_of)), lambda r: r["date"].isNotNull())


def years_in(text: Column, as_of: Column) -> Column:
    """Years that stand alone, from 1875 to that of as_of, in order and once each."""
    found = F.regexp_extract_all(text, F.lit(r"(?<![0-9./-])[0-9]{4}(?![0-9]|[./-][0-9])"), F.lit(0))
    return F.array_distinct(F.filter(F.transform(found, lambda y: y.cast("int")), lambda y: y.between(1875, F.year(as_of))))


def partial_dates(text: Column) -> Column:
    """Days and months without a year, in order: structs (month, day, code); the code 9900 + month marks such a date."""
    found = F.filter(W.found_dates(T.sentences(text)), lambda d: d["date"].isNull())
    return F.transform(found, lambda d: F.struct(d["month"].alias("month"), d["day"].alias("day"), (9900 + d["month"]).alias("code")))


def age_sentences(text: Column, death: Column) -> Column:
    """Sentences in which an age may be read: those without a date, or with one only, the date of death."""

    def use(sentences: Column, dates: Column) -> Column:
        def open_(s: Column, k: Column) -> Column:
            own = F.filter(dates, lambda d: d["sentence"] == k)
            return (F.size(own) == 0) | ((F.size(own) == 1) & F.coalesce(F.get(own, F.lit(0))["date"] == death, F.lit(False)))

        return F.filter(sentences, open_)

    return _with_sentences(text, use)


def age_in_units(text: Column) -> Column:
    """Whole years of an age told in days, weeks or months; null if it is not."""
    told = age_told(text)
    return F.when(told["in_parts"], told["age"])


def age_told(text: Column, death: Column | None = None) -> Column:
    """(age, in_parts) of the first sentence that tells an age, null without one; in_parts: it was told in days, weeks or months."""
    return W.found_age(T.sentences(text), F.lit(None).cast("date") if death is None else death)


def age(text: Column, death: Column | None = None) -> Column:
    """Age at death: "aged N", "N years old", "was N", "Nth birthday", "Ann Roy, N,"; one less for "in his Nth year" and before a
    birthday; whole years of ages in days, weeks or months. Numbers that count something else, or follow what is no age, are passed over."""
    return age_told(text, death)["age"]


def spouse(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, SPOUSE, 1), F.lit(""))


def years_married(text: Column, year: Column) -> Column:
    """Years named with a marriage, or the years since one, below 100."""
    named = F.regexp_extract(text, r"(?i)\b(?:husband|wife|spouse|married)\b[^.]*?\b([0-9]{1,2}) years", 1).try_cast("int")
    since = year - F.regexp_extract(text, r"(?i)\bmarried in ([0-9]{4})", 1).try_cast("int")
    n = F.coalesce(named, since)
    return F.when(n.between(0, 99), n)


def born_year(text: Column) -> Column:
    return F.regexp_extract(text, r"(?i)\bborn in (?:the year )?([0-9]{4})\b", 1).try_cast("int")


def year_pair(text: Column) -> Column:
    """(birth year, death year) written as 1900-1990 or 1900 ~ 1990."""
    a = F.regexp_extract(text, r"\b(1[89][0-9]{2}|20[0-9]{2})\s*[-~–]\s*(1[89][0-9]{2}|20[0-9]{2})\b", 1).try_cast("int")
    b = F.regexp_extract(text, r"\b(1[89][0-9]{2}|20[0-9]{2})\s*[-~–]\s*(1[89][0-9]{2}|20[0-9]{2})\b", 2).try_cast("int")
    return F.when(b >= a, F.struct(a.alias("yob"), b.alias("yod")))


def alternates(name: Column) -> Column:
    """Other surnames and names of a person: née, formerly, also known as."""
    return F.array_distinct(F.regexp_extract_all(name, F.lit(r"(?i)(?:\bn[ée]e?|\bformerly|\baka|\ba\.k\.a\.|\balso known as)[:]? \(?(?-i:(\p{Lu}[\p{L}'-]+))"), F.lit(1)))


def name_parts(name: Column) -> Column:
    """(last, first, middle) of "Last, First Middle" or "First Middle Last"; titles, suffixes and what is in
    brackets left out, particles kept with the surname."""
    told = personal.slots(name)
    return F.struct(told["last"].alias("last"), told["first"].alias("first"), told["middle"].alias("middle"))


def by_priority(evidence: DataFrame, key: str, field: str, rank: Column) -> DataFrame:
    """Of the known values of each key and field the one of the least rank."""
    w = Window.partitionBy(key, field).orderBy(rank, "value")
    return evidence.where("value is not null").withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def apply_rules(pages: DataFrame, rules: list[tuple], text: str) -> DataFrame:
    """Rows of pages with every rule (field, pattern), or (provider, field, pattern) for pages of that provider, that matches: the
    first group of its pattern as value. The rules are columns of one scan."""
    found = []
    for *provider, field, pattern in rules:
        value = F.regexp_extract(text, pattern, 1)
        if provider:
            value = F.when(F.col("provider") == provider[0], value)
        found.append(F.struct(F.lit(field).alias("field"), value.alias("value")))
    return pages.withColumn("_found", F.explode(F.filter(F.array(*found), lambda r: r["value"] != ""))).select(*pages.columns, "_found.*")


def valid_record(birth: Column, death: Column, years: Column) -> Column:
    """Codes of what is wrong with a record's dates: death before birth, age off by over a year, over 125."""
    real = F.floor(F.months_between(death, birth) / 12)
    codes = F.array(
        F.when(death < birth, F.lit("death_before_birth")), F.when(F.abs(real - years) > 1, F.lit("age_differs")),
        F.when(real > 125, F.lit("too_old")),
    )
    return F.array_compact(codes)


#: Words after which a notice speaks of others.
RELATIONS = ("survived by", "predeceased by", "leaves behind", "mourned by")
#: Bits of what a run extracts.
RUN_BITS = {"names": 1, "dates": 2, "age": 4, "gender": 8, "spouse": 16, "service": 32, "place": 64}


def before_relations(text: Column) -> Column:
    """A notice up to the first word that turns to the family."""
    return F.regexp_replace(text, "(?is)\\b(" + "|".join(RELATIONS) + r")\b.*$", "")


def head_sentences(text: Column, n: int) -> Column:
    return F.array_join(F.slice(T.sentences(text), 1, n), " ")


def wants(run_types: Column, what: str) -> Column:
    """Whether a run's bits ask for an extraction."""
    return run_types.bitwiseAND(F.lit(RUN_BITS[what])) != 0


def back_to_back(text: Column) -> Column:
    """(first, second) of two written dates with a dash between, in order of time."""

    def use(sentences: Column, dates: Column) -> Column:
        pairs = F.zip_with(dates, F.slice(dates, 2, F.greatest(F.size(dates), F.lit(1))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))

        def parted(p: Column) -> Column:
            gap = F.substr(F.get(sentences, p["a"]["sentence"]), p["a"]["end"] + 1, p["b"]["start"] - p["a"]["end"])
            return F.coalesce((p["a"]["sentence"] == p["b"]["sentence"]) & gap.rlike(r"^\s*[-–~]\s*$"), F.lit(False))

        return F.get(F.filter(pairs, parted), F.lit(0))

    one = _with_sentences(text, use)
    return F.when(one.isNotNull(), F.struct(F.least(one["a"]["date"], one["b"]["date"]).alias("first"), F.greatest(one["a"]["date"], one["b"]["date"]).alias("second")))


def first_word_tally(text: Column, words) -> Column:
    """How many sentences begin with one of the words."""
    return F.size(F.filter(T.sentences(text), lambda s: F.lower(F.regexp_extract(s, r"^(\p{L}+)", 1)).isin(*words)))


def places_named(docs: DataFrame, places: DataFrame, id_col: str, text: str, most: int = 1) -> DataFrame:
    """(id_col, place) for every place of a dimension (column place, lower case, words parted by one blank) of up to `most`
    words that a text names. Words in a row are joined with the dimension, so the number of places does not multiply the
    texts."""
    rows = docs.select(id_col, T.words(F.col(text)).alias("_1"))
    for n in range(2, most + 1):  # n words are n - 1 of them and the word after
        left = F.greatest(F.lit(0), F.size("_1") - n + 1)
        rows = rows.withColumn(f"_{n}", F.zip_with(F.slice(f"_{n - 1}", 1, left), F.slice("_1", n, left), lambda a, b: F.concat(a, F.lit(" "), b)))
    each = rows.select(id_col, F.explode(F.array_distinct(F.concat(*[f"_{n}" for n in range(1, most + 1)]))).alias("place"))
    return each.join(places.select("place").distinct(), "place", "left_semi").select(id_col, "place")
