"""Names against a grammar that composes them, phrases against plain scans."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lychgate.functions import personal
from lychgate.operators import phrases

FIRST, LAST = ["Anna", "Jean-Luc", "Bob", "Zoé", "J."], ["Roy", "O'Brien", "Smith-Jones", "Côté", "McKay"]
PARTICLES = ["", "", "", "de ", "de la ", "van der ", "Van ", "De La ", "von "]


def composed(rng):
    """A name as a grammar makes it, and its slots."""
    prefix, suffix = rng.choice(["", "", "Dr. ", "Mrs. "]), rng.choice(["", "", "Jr.", "III", "Ph.D."[:0]])
    first, middle, last = rng.choice(FIRST), rng.choice(["", "", "Maria", "M.", "Maria J."]), rng.choice(PARTICLES) + rng.choice(LAST)
    nick, born = rng.choice(["", "", "Annie", "Bo"]), rng.choice(["", "", "Gray", "de la Tour"])
    told = {"prefix": prefix.strip(), "first": first, "middle": middle, "last": last, "suffix": suffix, "nicknames": [nick] if nick else [], "alternates": [born] if born else [], "turned": False}
    said = f' "{nick}"' if nick and rng.random() < 0.5 else f" ({nick})" if nick else ""
    ending = f" {suffix}" if suffix and rng.random() < 0.5 else f", {suffix}" if suffix else ""
    maiden = rng.choice([f" (née {born})", f", née {born}", f" formerly {born}"]) if born else ""
    given = first + (f" {middle}" if middle else "")
    if rng.random() < 0.5:
        return f"{prefix}{last}, {given}{said}{ending if ending[:1] == ' ' else ''}{maiden}", told | ({} if ending[:1] in ("", " ") else {"suffix": ""})
    return f"{prefix}{given}{said} {last}{ending}{maiden}", told


def test_names_of_a_grammar():
    rng = random.Random(9)
    for _ in range(3000):
        text, told = composed(rng)
        assert personal.read_name(text) == told, text


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("Maria de la Cruz", ("Maria", "", "de la Cruz")), ("Ludwig van Beethoven", ("Ludwig", "", "van Beethoven")), ("ROY, ANN M.", ("Ann", "M.", "Roy")), ("Cher", ("", "", "Cher")), ("De Niro, Robert", ("Robert", "", "De Niro")), ("", ("", "", "")),
        ("Ana de la Cruz Lopez", ("Ana", "", "de la Cruz Lopez")), (" , ", ("", "", "")), ("Roy,", ("", "", "Roy")), ("(née Gray)", ("", "", "")), ("Van Morrison", ("", "", "Van Morrison")), (" ".join(f"N{i}" for i in range(300)), ("N0", " ".join(f"N{i}" for i in range(1, 299)), "N299")),
    ],
)
def test_forms_of_names(text, wanted):
    told = personal.read_name(text)
    assert (told["first"], told["middle"], told["last"]) == wanted


def test_kinds_by_counts(spark):
    rows = spark.createDataFrame([(1, "Roy Ann"), (2, "Ann Roy"), (3, "Ann"), (4, None), (5, ""), (6, "Zoé (Roy) Côté")], "id long, name string")
    counts = spark.createDataFrame([("ann", 50, 2), ("ROY", 3, 90), ("roy", 2, 1), ("zoe", 4, 4)], "name string, given long, surnames long")
    got = {r["id"]: r for r in personal.parsed(rows, "id", "name", counts).collect()}
    assert [(got[i]["first"], got[i]["last"], got[i]["turned"]) for i in (1, 2, 3, 4, 5)] == [("Ann", "Roy", True), ("Ann", "Roy", False), ("Ann", "", False), (None, None, None), ("", "", False)]
    assert got[6]["alternates"] == ["Roy"] and got[6]["nicknames"] == [] and personal.parsed(rows.limit(0), "id", "name", counts).count() == 0


def plain_hits(text, table):
    """Longest phrase at each place, by trying every phrase at every word."""
    words, out, i = [m.group().lower() for m in re.finditer(r"[^\W\d_]+", text)], [], 0
    while i < len(words):
        fit = [p for p in table if words[i : i + len(p.split())] == p.lower().split()]
        if fit:
            best = max(fit, key=lambda p: len(p.split()))
            out.append((best, i))
            i += len(best.split())
        else:
            i += 1
    return out


def test_phrases_against_plain_scans(spark):
    rng = random.Random(6)
    pool = ["a", "b", "c", "d"]
    table = list({" ".join(rng.choice(pool) for _ in range(rng.randint(1, 5))) for _ in range(40)} - set(pool[:3]))
    texts = [(i, rng.choice([" ", ", ", "\n"]).join(rng.choice([*pool, "E"]) for _ in range(rng.randint(0, 60)))) for i in range(300)] + [(900, None), (901, ""), (902, "a b " * 40_000)]
    docs = spark.createDataFrame(texts, "id long, text string")
    known = spark.createDataFrame([(p, "k") for p in table + table] + [(None, "k"), ("", "k")], "phrase string, kind string")
    got = {}
    for r in phrases.phrase_hits(docs, "id", "text", known).collect():
        got.setdefault(r["id"], []).append((r["word"], r["phrase"]))
        assert dict(texts)[r["id"]][r["start"] : r["end"]].lower().replace(",", "").split() == r["phrase"].split()
    for i, t in texts:
        assert sorted(got.get(i, [])) == [(k, p) for p, k in plain_hits(t or "", table)]


def test_what_is_told_of_the_person(spark):
    docs = spark.createDataFrame([(1, "Peacefully, Ann died.  She is survived by two. Peacefully."), (2, None), (3, ""), (4, "Peacefully")], "id long, t string")
    got = {r["id"]: r["told"] for r in phrases.told_of_person(docs, "id", "t", phrases.family_phrases(spark)).collect()}
    assert got == {1: ", Ann died. She is", 2: None, 3: "", 4: ""}
    with pytest.raises(ValueError):
        old, phrases.MOST = phrases.MOST, 3
        try:
            phrases.phrase_hits(docs, "id", "t", phrases.family_phrases(spark))
        finally:
            phrases.MOST = old
