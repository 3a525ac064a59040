"""Writers of the notice files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lychgate.sources import schemas as S


def person_csv(df: DataFrame, path: str) -> None:
    """Rows by the written layout's names, appended, unquoted."""
    cols = S.names(S.PERSON_WRITTEN)
    plain = [F.coalesce(F.regexp_replace(F.col(c).cast("string"), "[,\\r\\n]", " "), F.lit("")).alias(c) for c in cols]
    df.select(F.concat_ws(",", *plain).alias("value")).write.mode("append").text(path)


def id_csv(df: DataFrame, path: str) -> None:
    df.select(F.concat_ws(",", "deceased_number", "last_name", F.lit("")).alias("value")).write.mode("append").text(path)


def lines(df: DataFrame, separator: str, names) -> DataFrame:
    return df.select(F.concat_ws(separator, *[F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names]).alias("value"))


def url_list(df: DataFrame, path: str) -> None:
    lines(df, "|", S.URL_LIST).write.mode("append").text(path)


def obit_list(df: DataFrame, path: str) -> None:
    """Each line ends with a separator too."""
    lines(df, "||", S.OBIT_LIST).select(F.concat("value", F.lit("||")).alias("value")).write.mode("append").text(path)


def issues(df: DataFrame, path: str) -> None:
    """Log rows (category, record, message) by category."""
    df.write.mode("append").partitionBy("category").parquet(path)


def html_report(df: DataFrame, title: str, *order, most: int = 1000) -> str:
    """A result as an HTML table: the first `most` rows in order (of all columns, if none is given), how many there are,
    and totals of numeric columns over all of them."""
    import html

    numeric = [c for c, t in df.dtypes if t in ("int", "bigint", "double", "float")]
    totals = df.agg(F.count("*").alias("_n"), *[F.sum(c).alias(c) for c in numeric]).first()
    rows = df.orderBy(*(order or df.columns)).limit(most).collect()
    head = "".join(f"<th>{html.escape(c)}</th>" for c in df.columns)
    body = "".join("<tr>" + "".join(f"<td>{html.escape('' if v is None else str(v))}</td>" for v in r) + "</tr>" for r in rows)
    sums = "".join(f"<td>{(totals[c] or 0) if c in numeric else ''}</td>" for c in df.columns)
    return f"<h1>{html.escape(title)}</h1><p>{len(rows)} of {totals['_n']} rows</p><table><tr>{head}</tr>{body}<tr>{sums}</tr></table>"
