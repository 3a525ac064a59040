"""Written dates and ages, read by small machines over the words of a sentence.

A date is found by states: month, day and year in English order ("May 3rd, 1990", "Sept. 5 2001", "August the 8th, 2020") or day, month
and year ("the 3rd of May 1990", "1er mai 1990", "3 de mayo de 1990"), with months in full or shortened. An age is a number whose
neighbours fit a rule that accepts and none that rejects. Both work on sentences as lists, in Arrow batches, so that a column of texts
is read once; a sentence without a month's name or a number costs a search only.
"""

from __future__ import annotations

import datetime as dt
import re
from functools import cache, lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Month names.
MONTHS = {
    "en": ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"),
    "fr": ("janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre"),
    "es": ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre"),
}
#: Words that a date may have inside, and words after which dates and times belong to a ceremony.
LINKS = {"of", "de", "del", "day"}
CEREMONY = {"service", "services", "funeral", "memorial", "visitation", "celebration", "funérailles", "messe", "misa", "burial"}
_TOKEN = re.compile(r"[0-9]+(?:st|nd|rd|th|er|ère|e|º|°)?(?![0-9])|[^\W\d_]+")
_ORDINAL = re.compile(r"[0-9]+[^\W\d_º°]+|[0-9]+[º°]")
_GAP = re.compile(r"[\s,.]*")
_FOLD = str.maketrans("éèêûôáíóúñç", "eeeuoaiounc")


#: Texts whose manner of dates a worker keeps, for few dates are in many ranges.
RANGES = 1 << 14


@cache
def months() -> dict[str, tuple[int, bool]]:
    """(month, whether it is the full name) of names and of their beginnings of three letters or more that no other month shares."""
    out: dict[str, set] = {}
    for names in MONTHS.values():
        for number, name in enumerate(names, 1):
            for size in range(3, len(name) + 1):
                for form in (name[:size], name[:size].translate(_FOLD)):
                    out.setdefault(form, set()).add(number)
    full = {form for names in MONTHS.values() for name in names for form in (name, name.translate(_FOLD))}
    return {form: (min(numbers), form in full) for form, numbers in out.items() if len(numbers) == 1 or form in full}


def _kind(word: str) -> tuple[str, int]:
    """Class of a word for the machine: month, day, year, the, link or other, and its number."""
    if word[0].isdigit():
        n = int(re.match("[0-9]+", word)[0])
        plain = word.isdigit()
        return ("day", n) if len(word.rstrip("ºª°")) <= 5 and 1 <= n <= 31 and n < 100 else ("year", n) if plain and len(word) == 4 else ("other", n)
    low = word.lower()
    if low in ("the", "el", "le"):
        return "the", 0
    if low in LINKS:
        return "link", 0
    found = months().get(low)
    return ("month", found[0]) if found else ("other", 0)


#: State and class of the next word to the next state; a date ends in "done", one without a year in md or dm.
STATES = {
    ("", "month"): "m", ("m", "the"): "m the", ("m", "day"): "md", ("m the", "day"): "md", ("md", "link"): "md of", ("md", "year"): "done", ("md of", "year"): "done",
    ("", "day"): "d", ("d", "link"): "d of", ("d of", "link"): "d of", ("d", "month"): "dm", ("d of", "month"): "dm", ("dm", "link"): "dm of", ("dm", "year"): "done", ("dm of", "year"): "done",
}


def _date_from(sentence: str, tokens: list, kinds: list, i: int, real: bool) -> dict | None:
    """The longest date that begins at a word: date, month, day and the place past its last word. A day and a month without a year count
    where the month is in full and no year follows."""
    if tokens[i][1] and sentence[tokens[i][1] - 1] in "0123456789/$":
        return None
    state, seen, best, full = "", {}, None, False
    for j in range(i, len(tokens)):
        joined = j == i or _GAP.fullmatch(sentence, tokens[j - 1][2], tokens[j][1])
        kind, n = kinds[j]
        state = STATES.get((state, kind)) if joined else None
        if state is None:
            return None if joined and kind == "year" else best
        seen[kind] = n
        full |= kind == "month" and months()[tokens[j][0].lower()][1]
        told = {"month": seen.get("month"), "day": seen.get("day"), "past": j + 1}
        if state == "done":
            try:
                return told | {"date": dt.date(seen["year"], seen["month"], seen["day"])}
            except ValueError:
                return None if real else told | {"date": seen["year"]}
        if state in ("md", "dm") and full:
            best = told | {"date": None}
    return best


def read_dates(sentence: str, real: bool = True) -> list[dict]:
    """Dates of a sentence in order: date (null without a year), month, day, place of the first word and past the last, start and end in
    characters, and whether a word of ceremony stands before. real: only days that their months have, else the year stands for the date."""
    tokens = [(m[0], m.start(), m.end()) for m in _TOKEN.finditer(sentence)]
    kinds = [_kind(t[0]) for t in tokens]
    out, i, ceremony = [], 0, False
    while i < len(tokens):
        word = tokens[i][0].lower()
        if word in CEREMONY and not (i and tokens[i - 1][0].lower() == "health"):
            ceremony = True
        found = _date_from(sentence, tokens, kinds, i, real) if kinds[i][0] in ("day", "month") else None
        if found and found["date"] is None and kinds[i + 1][0] in ("day", "month"):
            later = _date_from(sentence, tokens, kinds, i + 1, real)
            found = None if later and later["date"] else found  # "Room 13, May 3, 1990"
        if found:
            end = found["past"]
            out.append({"word": i, "start": tokens[i][1], "end": tokens[end - 1][2], "ceremony": ceremony, **found})
            i = end
        else:
            i += 1
    return out


_MONTHISH = re.compile("(?i)" + "|".join(sorted({n[:3].translate(_FOLD) for names in MONTHS.values() for n in names} | {n[:3] for names in MONTHS.values() for n in names})))
_FOUND = "array<struct<sentence:int,word:int,past:int,start:int,end:int,date:date,month:int,day:int,ceremony:boolean>>"


def found_dates(sentences: Column) -> Column:
    """Dates of a list of sentences as read_dates() gives them, each with its sentence's place, from 0; null for a null list."""

    @F.pandas_udf(_FOUND)
    def run(lists: pd.Series) -> pd.Series:
        return lists.map(lambda own: None if own is None else [{"sentence": k, **d} for k, s in enumerate(own) if s and _MONTHISH.search(s) for d in read_dates(s)])

    return run(sentences)


#: Words that speak of an age, unless one of NOT_AGE (fixed values) follows; who was so old; words that turn to something else.
AGE_WORDS = {"age", "aged", "years", "year", "old", "ans", "âge", "âgé", "âgée", "años", "edad"}
NOT_AGE = {"battle", "illness", "courageous", "struggle", "ago", "since", "have"}
PRONOUNS = {"he", "she", "il", "elle", "él", "ella"}
WAS = {"was", "était", "is", "turned"}
TURNS = {"worked", "served", "moved", "retired", "survived", "predeceased", "employed", "graduated", "joined", "smoked"}
#: Relatives whose years of marriage are no age.
SPOUSES = {"wife", "husband", "spouse", "married", "époux", "épouse", "esposo", "esposa", "marriage", "sweetheart", "partner"}
#: What a number counts if it is no age, and words before a number that is none.
COUNTED = {
    "anniversary", "lbs", "pounds", "child", "children", "grandchildren", "am", "pm", "minutes", "minute", "feet", "foot", "inches", "tall", "km", "miles", "dollars", "percent", "acres", "sons", "daughters",
}
BARRED = {"over", "nearly", "some", "about", "no", "number", "psalm", "chapter", "highway", "route", "room", "unit"}
ROADS = {"avenue", "street", "road", "drive", "rd", "ave", "st", "rue", "boulevard", "highway"}
#: Parts of a year: numbers of them are divided, and the age is flagged.
PARTS = {"hour": 8766, "hours": 8766, "day": 365, "days": 365, "jours": 365, "días": 365, "week": 52, "weeks": 52, "semaines": 52, "semanas": 52, "month": 12, "months": 12, "mois": 12, "meses": 12}
#: An age not yet reached: "days before her 90th birthday".
SHORT_OF = {"before", "shy", "short", "approaching", "avant", "antes"}
_WORD = re.compile(r"[0-9]+(?:st|nd|rd|th|e|ème)?(?![0-9])|[^\W\d_]+(?:[.'’][^\W\d_]+)*")


def read_age(sentence: str) -> tuple[int, bool] | None:
    """(age, whether it was told in parts of a year) of a sentence without other dates: the first number below 125 that a rule accepts and
    none rejects."""
    found = [(m[0], m.start(), m.end()) for m in _WORD.finditer(sentence)]
    words = [w.lower() for w, _, _ in found]
    born = event = short = False
    for i, word in enumerate(words):
        nxt = words[i + 1 : i + 4] + [""] * 3
        if word in TURNS:
            return None
        born |= word == "born"
        event |= word in ("after", "après", "depuis")
        short |= word in SHORT_OF
        if not word[0].isdigit():
            continue
        n, ordinal = int(re.match("[0-9]+", word)[0]), bool(_ORDINAL.fullmatch(word))
        before = words[i - 1] if i else ""
        if n >= 125 and nxt[0] not in PARTS or _glued(sentence, found[i]) or before in BARRED or before in months() and months()[before][1]:
            continue
        if nxt[0] in COUNTED or nxt[0] in ("a.m", "p.m") or nxt[1] in ROADS or nxt[0] in ROADS or nxt[0] in months() and months()[nxt[0]][1]:
            continue
        told = nxt[2] if nxt[1] == "of" else nxt[1]
        if event and (told in NOT_AGE | {"health"} or told in SPOUSES):
            event = False
            continue
        if any(w in SPOUSES for w in words[max(0, i - 3) : i]) and nxt[0] in ("years", "ans", "años"):
            continue
        in_parts = nxt[0] in PARTS
        if ordinal:
            if nxt[0] in ("birthday", "anniversaire"):
                return n - short, False
            if nxt[0] in ("year", "année") and before in ("his", "her", "sa", "their", "the"):
                return n - 1, False
            continue
        if born and nxt[0] == "years" and nxt[1] == "ago":
            return n, False
        named = before in WAS and i > 1 and (words[i - 2] in PRONOUNS or found[i - 2][0][:1].isupper())
        aged = before in ("aged", "age", "âgé", "âgée") or before in ("of", "de") and i > 1 and words[i - 2] in ("age", "aged", "âge", "âgé", "âgée", "edad")
        years = nxt[0] in ("years", "ans", "años", "year") and nxt[1] not in NOT_AGE and (nxt[1] in ("old", "young", "of", "") and (nxt[1] != "of" or nxt[2] == "age") or _ends(sentence, found, i + 1))
        if in_parts and (aged or named or nxt[1] == "old"):
            return n // PARTS[nxt[0]], True
        if in_parts:
            continue
        if aged or years or named and (nxt[0] in AGE_WORDS | {"", "when", "and", "at"} or _ends(sentence, found, i)):
            return n - (short and not aged), False
        if _between_commas(sentence, found, i) and found[i - 1][0][:1].isupper() and not words[i - 1][0].isdigit():
            return n, False
    return None


def _glued(sentence: str, token: tuple[str, int, int]) -> bool:
    """Whether a number is part of a longer one, a sum, a share, a code or a time."""
    before, after = sentence[: token[1]][-1:], sentence[token[2] :][:2]
    return before in ("$", "€", "£", "/", "#", ":", "-") and before != "" or after[:1] in ("%", "/", ":", "-") or after[:1] in (".", ",") and after[1:].isdigit()


def _ends(sentence: str, found: list, i: int) -> bool:
    """Whether the sentence or a part of it ends after a word."""
    return i < len(found) and (i + 1 == len(found) or sentence[found[i][2] :].lstrip()[:1] in (",", ".", ";", ")", "!", "—"))


def _between_commas(sentence: str, found: list, i: int) -> bool:
    left = sentence[found[i - 1][2] : found[i][1]].strip() if i else ""
    rest = sentence[found[i][2] :].lstrip()
    follows = found[i + 1][0] if i + 1 < len(found) else ""
    return left == "," and rest[:1] == "," and not follows[:1].isdigit()


_BIRTH = re.compile(r"(?i)\b(?:born|birth|née?|nacido|nació)\b")
_NUMBER = re.compile("[0-9]")


def found_age(sentences: Column, death: Column) -> Column:
    """The age (struct age, in_parts) of the first sentence that tells one, of those without a date or with one only, the date of death; where
    that is null, any date of a sentence that does not speak of a birth. Null without an age."""

    @F.pandas_udf("struct<age:int,in_parts:boolean>")
    def run(lists: pd.Series, deaths: pd.Series) -> pd.DataFrame:
        out = []
        for own, died in zip(lists, deaths):
            found = None
            for s in () if own is None else own:
                if not s or not _NUMBER.search(s):
                    continue
                dates = [d for d in read_dates(s) if d["date"]] if _MONTHISH.search(s) else []
                if len(dates) > 1 or dates and (_BIRTH.search(s) if pd.isna(died) else dates[0]["date"] != died):
                    continue
                for d in dates:
                    s = f"{s[: d['start']]}Then{s[d['end'] :]}"  # a word in the date's place
                if found := read_age(s):
                    break
            out.append(found or (None, None))
        return pd.DataFrame(out, columns=["age", "in_parts"]).astype({"age": "Int32", "in_parts": "boolean"})

    told = run(sentences, death.cast("date"))
    return F.when(told["age"].isNotNull(), told)


def _of_texts(kind: str, fn):
    """fn over a column of texts, in Arrow batches; null for null."""

    @F.pandas_udf(kind)
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else fn(t)).astype("boolean" if kind == "boolean" else object)

    return run


#: A date whose fields a hyphen or slash parts: year, month and day in numbers, or a month's name, day and year.
_FIELDS = re.compile(r"(?<![\w/-])(?:(?P<year>[0-9]{4})(?P<mark>[-/])(?P<month>[0-9]{1,2})(?P=mark)(?P<day>[0-9]{1,2})|(?P<name>[^\W\d_]{3,9})-(?P<nday>[0-9]{1,2})-(?P<nyear>[0-9]{4}))(?![0-9])")


def _said(m: re.Match) -> str | None:
    """A date of fields in one form, 2020/01/31 or January 31, 2020; null if it is none."""
    if m["name"]:
        month, full = months().get(m["name"].lower(), (0, False))
        fine = month and m["name"].lower() in {n[: len(m["name"])] for n in MONTHS["en"]} and 1 <= int(m["nday"]) <= 31
        return f"{m['name']}{'' if full else '.'} {m['nday']}, {m['nyear']}" if fine else None
    return f"{m['year']}/{m['month']}/{m['day']}" if 1 <= int(m["month"]) <= 12 and 1 <= int(m["day"]) <= 31 else None


def in_one_form(text: str) -> str:
    """text with dates whose fields hyphens part in one form, set off by blanks; a hyphen between two dates gets blanks, too."""
    out, at, joined = [], 0, text
    pattern = re.compile(_FIELDS.pattern.replace(r"(?<![\w/-])", r"(?<![\w/])"))
    for m in pattern.finditer(joined):
        said = _said(m)
        if said is None:
            continue
        between = joined[at : m.start()]
        if out and between.strip() == "-":
            between = " - "
        elif out and between.strip() == ",":
            between = ", "
        elif between and not between[-1].isspace():
            between += " "
        out += [between, said]
        at = m.end()
    rest = joined[at:]
    if out and rest[:1].isalnum():
        rest = " " + rest
    return re.sub(r" +([,;])", r"\1", re.sub(" +", " ", "".join([*out, rest]))).strip(" ") if out else text


def plain_dates(text: Column) -> Column:
    return _of_texts("string", in_one_form)(text)


@lru_cache(RANGES)
def date_range_language(text: str) -> str | None:
    """en or fr if a text is two written dates of one manner, a hyphen between blanks and nothing else."""
    found = [d for d in read_dates(text, real=False) if d["date"]]
    if len(found) != 2 or found[0]["start"] or found[1]["end"] != len(text) or text[found[0]["end"] : found[1]["start"]] != " - ":
        return None
    manners = set()
    for d in found:
        said = text[d["start"] : d["end"]]
        name = re.search(r"[^\W\d_]{3,}", said)[0].lower()
        own = tuple(lang for lang, names in MONTHS.items() if any(n.startswith(name) or n.translate(_FOLD).startswith(name) for n in names))
        manners.add((said[0].isdigit(), months()[name][1] or name == "may", own))
    if {first for first, _, _ in manners} == {False} and len({full for _, full, _ in manners}) == 1 and all("en" in own for _, _, own in manners):
        return "en"
    return "fr" if {(first, full) for first, full, _ in manners} == {(True, True)} and all("fr" in own for _, _, own in manners) else None


def range_language(text: Column) -> Column:
    """date_range_language() of texts, null for null."""
    return _of_texts("string", date_range_language)(text)


def pure_date_range(text: Column, language: str | None = None) -> Column:
    return _of_texts("boolean", lambda t: (found := date_range_language(t)) is not None and language in (None, found))(text)


def balanced(text: str) -> str:
    """text without round brackets that have no partner."""
    open_, lone = [], set()
    for i, c in enumerate(text):
        if c == "(":
            open_.append(i)
        elif c == ")":
            if open_:
                open_.pop()
            else:
                lone.add(i)
    lone.update(open_)
    return "".join(c for i, c in enumerate(text) if i not in lone) if lone else text


def even_brackets(text: Column) -> Column:
    return _of_texts("string", balanced)(text)
