"""Repair of texts by rules, over whole documents and pages."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from lychgate.operators import rewrite as R
from lychgate.registry import query
from lychgate.sources.tables import table


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _steps(rows: str) -> str:
    """The rules in turn as steps s0, s1, ... of SQL: t is the text, h1, h2, ... are the numbers of changes."""
    out = [f"s0 AS (SELECT {rows})"]
    for k, rule in enumerate(R.ordered(), 1):
        put, fits = _literal(re.sub(r"\$([0-9])", r"\\\1", rule.put)), f"regexp_matches(t, {_literal(rule.guard)})" if rule.guard else "true"
        pattern = _literal(rule.pattern)
        out.append(
            f"s{k} AS (SELECT * REPLACE (CASE WHEN {fits} THEN regexp_replace(t, {pattern}, {put}, 'g') ELSE t END AS t), CASE WHEN {fits} THEN coalesce(len(regexp_extract_all(t, {pattern})), 0) ELSE 0 END AS h{k} FROM s{k - 1})"
        )
    return ", ".join(out)


_N = len(R.RULES)
_SUM = " + ".join(f"h{k}" for k in range(1, _N + 1))
_LOOSE = "text || ' He died Friday, May 3rd,1990 aged80years,survived by his loving wife ,Ann O'' Neil(née Mc Kay).Rest ( )  […] in the year ' || (1900 + doc_id % 90)"


@query("text_rules", f"WITH {_steps(f'doc_id, {_LOOSE} AS t FROM documents')} SELECT doc_id, t AS repaired, coalesce({_SUM}, 0)::BIGINT AS changes FROM s{_N}")
def text_rules(spark, d):
    loose = F.concat(
        F.col("text"), F.lit(" He died Friday, May 3rd,1990 aged80years,survived by his loving wife ,Ann O' Neil(née Mc Kay).Rest ( )  […] in the year "), (1900 + F.col("doc_id") % 90).cast("string")
    )
    rows = R.with_hits(table(spark, d, "documents").select("doc_id", loose.alias("t")), "t")
    total = sum((F.col(f"hits.{r.name}") for r in R.RULES), F.lit(0))
    return rows.select("doc_id", F.col("t").alias("repaired"), total.cast("long").alias("changes"))


@query(
    "rule_hits",
    f"WITH {_steps('html AS t FROM pages')}, n AS (SELECT {', '.join(f'sum(h{k})::BIGINT AS h{k}' for k in range(1, _N + 1))} FROM s{_N}) "
    + " UNION ALL ".join(f"SELECT '{r.name}' AS rule, '{r.stage}' AS stage, coalesce(h{k}, 0) AS hits FROM n" for k, r in enumerate(R.ordered(), 1)),
)
def rule_hits(spark, d):
    return R.totals(table(spark, d, "pages").select("html"), "html")
