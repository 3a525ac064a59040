"""Names of persons taken apart by a machine over their words.

A word is a prefix, a suffix, a particle, a mark of another name ("née", "aka"), an initial, or a name, which a table of counts may tell to be a
given one or a surname. What brackets and quotation marks hold is read on its own. The machine fills slots: prefix, first, middle, last,
suffix, nicknames, alternates. Particles, capital or not, belong to the surname that follows them.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lychgate.functions.names import name_key

PREFIXES = {"mr", "mrs", "ms", "miss", "dr", "rev", "sir", "mme", "mlle", "monsieur", "madame", "fr", "sister", "señor", "señora", "don", "doña"}
SUFFIXES = {"jr", "sr", "ii", "iii", "iv", "esq", "phd", "md", "qc", "fils", "père"}
PARTICLES = {"de", "du", "des", "la", "le", "les", "las", "los", "del", "della", "di", "da", "dos", "van", "von", "der", "den", "ter", "ten", "st", "ste", "el", "al", "bin", "ibn", "y"}
#: Marks after which another surname, and another name of whatever kind, is told.
BORN_AS = ("née", "né", "nee", "born", "formerly", "maiden name")
ALSO = ("also known as", "known as", "a.k.a.", "a.k.a", "aka", "alias", "dite", "dit")
_MARKS = re.compile(r"(?i)(?<![^\W_])(" + "|".join(re.escape(m) for m in sorted((*BORN_AS, *ALSO), key=len, reverse=True)) + r")(?![^\W_]):?\s+")
_HELD = re.compile(r"\(([^()]*)\)|[\"“”«]([^\"“”«»]*)[\"”“»]|(?<![^\s(])['‘]([^'‘’]+)['’](?=[\s,)]|$)")
SLOTS = "prefix string, first string, middle string, last string, suffix string, nicknames array<string>, alternates array<string>, turned boolean"
NAMES = [s.split()[0] for s in SLOTS.split(", ")]


def _plain(word: str) -> str:
    return word.strip(".,").lower()


def _is_suffix(part: str) -> bool:
    words = part.split()
    return bool(words) and all(_plain(w).replace(".", "") in SUFFIXES for w in words)


def _proper(word: str) -> str:
    """A word in capitals with only its parts' first letters so, but for initials."""
    if len(word.replace(".", "")) < 2 or word != word.upper() or "." in word[:-1] or _is_suffix(word):
        return word
    return re.sub(r"[^\W\d_]+", lambda m: m[0][0] + m[0][1:].lower(), word)


def _grouped(words: list[str]) -> list[str]:
    """Words with the particles before them as one; particles at the end stand alone, and the first word of a name is none."""
    out, held = [], []
    for i, word in enumerate(words):
        if _plain(word) in PARTICLES and i + 1 < len(words) and (out or held or word[0].islower() or len(words) == 2):
            held.append(word)
        else:
            out.append(" ".join([*held, word]))
            held = []
    return out


def read_name(text: str, kinds: dict[str, str] | None = None) -> dict:
    """Slots of a name. kinds: given or surname, by words in lower case without accents."""
    kinds = kinds or {}
    nicknames: list[str] = []
    alternates: list[str] = []

    def held(m: re.Match) -> str:
        inside = next((g for g in m.groups() if g is not None), "").strip(" ,\"'“”‘’«»")
        if not inside:
            return " "
        if _MARKS.match(inside + " "):
            return f" {inside} "
        (alternates if m[1] is not None and kinds.get(inside.lower()) == "surname" else nicknames).append(inside)
        return " "

    text = _HELD.sub(held, text or "")
    pieces = _MARKS.split(text)
    for mark, own in zip(pieces[1::2], pieces[2::2]):
        words = [_proper(w.strip(",;")) for w in own.split() if w.strip(",;()")]
        words = [w for w in words if _plain(w) not in PREFIXES | {"and", "or"} and not _is_suffix(w)]
        if not words:
            continue
        if mark.lower() in BORN_AS:
            alternates.append(_grouped(words)[-1] if len(words) > 1 and _plain(words[0]) not in PARTICLES else " ".join(words))
        elif len(words) == 1 and kinds.get(words[0].lower()) != "surname" and mark.lower() not in ("dit", "dite"):
            nicknames.append(words[0])
        else:
            alternates.append(" ".join(words))
    parts = [p.strip() for p in pieces[0].split(",")]
    suffix = [w for p in parts[1:] if _is_suffix(p) for w in p.split()]
    parts = [p for k, p in enumerate(parts) if p and not (k and _is_suffix(p))]
    inverted = len(parts) > 1
    words = [[_proper(w) for w in p.split()] for p in parts]
    prefix: list[str] = []
    for own in words:
        while own and _plain(own[0]) in PREFIXES and (len(own) > 1 or len(words) > 1):
            prefix.append(own.pop(0))
        while len(own) > 1 and _is_suffix(own[-1]):
            suffix.insert(0, own.pop())
    words = [w for w in words if w]
    last, rest, turned = "", [], False
    if len(words) > 1 and inverted:
        last, rest = " ".join(words[0]), _grouped([w for own in words[1:] for w in own])
    elif words:
        groups = _grouped(words[0])
        if len(groups) == 1:
            kind = kinds.get(_key(groups[0]))
            last, rest = ("", groups) if kind == "given" else (groups[0], [])
        else:
            tail = 2 if len(groups) > 2 and " " in groups[-2] else 1  # "Ana de la Cruz Lopez"
            last, rest = " ".join(groups[-tail:]), groups[:-tail]
            turned = len(groups) == 2 and kinds.get(_key(groups[0])) == "surname" and kinds.get(_key(groups[1])) == "given"
            if turned:
                last, rest = groups[0], [groups[1]]
    once = lambda x: list(dict.fromkeys(x))
    return {
        "prefix": " ".join(prefix), "first": rest[0] if rest else "", "middle": " ".join(rest[1:]), "last": last, "suffix": " ".join(suffix), "nicknames": once(nicknames), "alternates": once(alternates), "turned": turned,
    }


_FOLDED = str.maketrans("àáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy")


def _key(word: str) -> str:
    return word.strip(".,").lower().translate(_FOLDED)


def slots(name: Column, kinds: Column | None = None) -> Column:
    """Slots of a name (SLOTS), null for null. kinds: an array of structs (word, kind)."""

    @F.pandas_udf(f"struct<{', '.join(s.replace(' ', ':', 1) for s in SLOTS.split(', '))}>")
    def run(texts: pd.Series, told: pd.Series) -> pd.DataFrame:
        none = dict.fromkeys(NAMES)
        out = [none if t is None else read_name(t, {} if k is None else {x["word"]: x["kind"] for x in k}) for t, k in zip(texts, told)]
        return pd.DataFrame(out, columns=NAMES).astype({"turned": "boolean"})

    empty = F.array().cast("array<struct<word:string,kind:string>>")
    return run(name, empty if kinds is None else kinds)


def parsed(rows: DataFrame, key: str, name: str, counts: DataFrame, often: int = 3) -> DataFrame:
    """(key, slots) of the names in rows, one row a key. counts (name, given, surnames) tells a word's kind: given or surname if it is
    `often` times as frequent as the other. Words meet counts in a join, so either table may be of any size."""
    known = counts.groupBy(name_key(F.col("name")).alias("_word")).agg(F.sum("given").alias("_g"), F.sum("surnames").alias("_s"))
    kind = F.when(F.col("_g") > often * F.col("_s"), "given").when(F.col("_s") > often * F.col("_g"), "surname")
    known = known.select("_word", kind.alias("_kind")).where("_kind is not null")
    words = rows.select(key, F.explode(F.array_distinct(F.split(name_key(F.col(name)), r"[^\p{L}'-]+"))).alias("_word")).where("_word != ''")
    told = words.join(known, "_word").groupBy(key).agg(F.collect_list(F.struct(F.col("_word").alias("word"), F.col("_kind").alias("kind"))).alias("_kinds"))
    return rows.select(key, name).join(told, key, "left").select(key, slots(F.col(name), F.col("_kinds")).alias("_s")).select(key, "_s.*")
