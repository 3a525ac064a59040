"""Repair of texts by a table of ordered rules, with counts of what each rule did."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

#: Rules work stage after stage, and within one in their order.
STAGES = ("characters", "dates", "words", "marks", "blanks")
_MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
_APART = r"(^|[^\p{L}\p{N}])"


@dataclass(frozen=True)
class Rule:
    """Where `pattern` matches, `put` stands instead ($1 is the first group); only in texts that match `guard`, if there is one. Patterns
    look at what they match only, so that counts of matches are counts of changes."""

    name: str
    stage: str
    pattern: str
    put: str
    guard: str | None = None


RULES = (
    Rule("invisible", "characters", "[­​﻿]", ""),
    Rule("hard_blank", "characters", "[   ]", " "),
    Rule("quotes", "characters", "[“”„«»]", '"'),
    Rule("apostrophes", "characters", "[‘’‚]", "'"),
    Rule("dashes", "characters", "[–—‒]", "-"),
    Rule("dots", "characters", "…", "..."),
    Rule("ligature", "characters", "œ", "oe"),
    Rule("junk", "characters", r"[%*#$&]{3,}", ""),
    Rule("month_glued", "dates", rf"(\p{{Ll}})({_MONTHS}) ([0-9])", "$1 $2 $3"),
    Rule("weekday", "dates", rf"(?:Mon|Tues|Wednes|Thurs|Fri|Satur|Sun)day,? ({_MONTHS})", "$1"),
    Rule("ordinal", "dates", rf"({_MONTHS}) ([0-9]{{1,2}})(?:st|nd|rd|th)", "$1 $2"),
    Rule("year_glued", "dates", r"([0-9]{1,2},)([12][0-9]{3})", "$1 $2"),
    Rule("year_said", "dates", r"in the year ([12][0-9]{3})", "in $1"),
    Rule("point_for_comma", "dates", rf"({_MONTHS}) ([0-9]{{1,2}})\. ?([12][0-9]{{3}})", "$1 $2, $3"),
    Rule("irish", "words", rf"{_APART}O' (\p{{Lu}})", "$1O'$2"),
    Rule("scottish", "words", rf"{_APART}Mc (\p{{Lu}})", "$1Mc$2"),
    Rule("predeceased", "words", "([Pp])re-deceased", "$1redeceased"),
    Rule("years_glued", "words", "([0-9])(years|ans|años)", "$1 $2"),
    Rule("age_glued", "words", rf"{_APART}(age|aged)([0-9])", "$1$2 $3"),
    Rule("affection", "words", rf"{_APART}(?:loving|beloved|dearly loved|dear) (wife|husband|mother|father|son|daughter)", "$1$2", "(?:[Ss]urvived|[Pp]redeceased|mourned) by"),
    Rule("square", "marks", r"\[([^\[\]]*)\]", "($1)"),
    Rule("empty_brackets", "marks", r"\( *\)", ""),
    Rule("commas", "marks", ",(?: *,)+", ","),
    Rule("blank_before", "marks", " +([,;:!?.])", "$1"),
    Rule("comma_glued", "marks", r"([,;!?])(\p{L})", "$1 $2"),
    Rule("sentence_glued", "marks", r"(\p{Ll}\.)(\p{Lu})", "$1 $2"),
    Rule("bracket_opens", "marks", r"(\p{L})\( *", "$1 ("),
    Rule("bracket_closes", "marks", r" *\)(\p{L})", ") $1"),
    Rule("blanks", "blanks", "[ \t\n\r\f]{2,}|[\t\n\r\f]", " "),
    Rule("ends", "blanks", "^ | $", ""),
)


def ordered(rules: tuple[Rule, ...] = RULES) -> list[Rule]:
    """Rules in the order in which they work."""
    return sorted(rules, key=lambda r: STAGES.index(r.stage))


def _fits(rule: Rule, text: Column) -> Column:
    return F.lit(True) if rule.guard is None else text.rlike(rule.guard)


def repaired(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """text after all rules, as one expression."""
    for rule in ordered(rules):
        put = F.regexp_replace(text, rule.pattern, rule.put)
        text = put if rule.guard is None else F.when(_fits(rule, text), put).otherwise(text)
    return text


def with_hits(rows: DataFrame, text: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """rows with text after all rules, and hits, a struct with the number of places that each rule changed; 0 for a null text. Every rule
    is a step of its own, so that a text is changed and counted once."""
    taken = {c.lower() for c in rows.columns}
    names = {r.name: f"_{r.name}_" + "_" * (f"_{r.name}_".lower() in taken) for r in ordered(rules)}
    for rule in ordered(rules):
        c = F.col(text)
        n = F.coalesce(F.when(_fits(rule, c), F.regexp_count(c, F.lit(rule.pattern))), F.lit(0)).cast("long")
        put = F.regexp_replace(c, rule.pattern, rule.put)
        put = put if rule.guard is None else F.when(_fits(rule, c), put).otherwise(c)
        rows = rows.select(*[put.alias(text) if x == text else F.col(x) for x in rows.columns], n.alias(names[rule.name]))
    hits = F.struct(*[F.col(v).alias(k) for k, v in names.items()]).alias("hits")
    return rows.select(*[F.col(c) for c in rows.columns if c not in names.values()], hits)


def observed(rows: DataFrame, text: str, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, Observation]:
    """rows with text after all rules, and the rules' counts by name, told once the rows have been run, without another scan."""
    told = Observation()
    done = with_hits(rows, text, rules)
    done = done.observe(told, *[F.sum(f"hits.{r.name}").alias(r.name) for r in ordered(rules)])
    return done.drop("hits"), told


def totals(rows: DataFrame, text: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(rule, stage, hits) over all rows, in one pass."""
    done = with_hits(rows, text, rules).agg(*[F.coalesce(F.sum(f"hits.{r.name}"), F.lit(0)).alias(r.name) for r in ordered(rules)])
    parts = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.stage).alias("stage"), F.col(r.name).alias("hits")) for r in ordered(rules)])
    return done.select(F.explode(parts).alias("x")).select("x.*")
