"""Readers of the notice files: declared schemas, no inference, bad rows kept apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lychgate.sources import schemas as S


def person_csv(spark: SparkSession, path: str) -> DataFrame:
    """The unquoted person file; the header, rows of code 999 and rows without an id are left out."""
    raw = spark.read.schema(S.PERSON).option("quote", "").option("mode", "PERMISSIVE").csv(path)
    kept = (F.col("last1") != "Last Name") & ~F.col("run_code").eqNullSafe("999") & (F.trim("id") != "")
    return S.typed_person(raw.where(F.coalesce(kept, F.lit(False))))


def id_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("deceased_number int, last_name string, rest string").csv(path).drop("rest").where("deceased_number is not null")


def nickname_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("formal string, nickname string").csv(path).where("nickname is not null")


def _split(lines: DataFrame, separator: str, names) -> DataFrame:
    parts = F.split("value", separator)
    return lines.where(F.size(parts) >= len(names)).select(*[S.known_text(parts[i]).alias(n) for i, n in enumerate(names)])


def url_list(lines: DataFrame) -> DataFrame:
    """Lines (column value) of a URL list."""
    return _split(lines, r"\|", S.URL_LIST)


def obit_list(lines: DataFrame) -> DataFrame:
    return _split(lines, r"\|\|", S.OBIT_LIST)


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    return url_list(spark.read.option("pathGlobFilter", "*.obitURLlist").text(path))


def read_obit_list(spark: SparkSession, path: str) -> DataFrame:
    return obit_list(spark.read.option("pathGlobFilter", "*.obitList").text(path))


def whole_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, value): a row a file."""
    return spark.read.option("wholetext", True).option("pathGlobFilter", glob).text(path).select(F.input_file_name().alias("path"), "value")


def notice_files(spark: SparkSession, path: str, glob: str = "*.htm*") -> DataFrame:
    """(path, provider_id, provider_key, id, value): a row a file that lies at .../provider/key/id.html; values without the
    marks that a page's encoding may leave (byte order marks, ligatures, zero bytes)."""
    place = F.regexp_extract_all("path", F.lit(r"([^/]+)/([^/]+)/([^/]+)\.html?$"), F.lit(0))
    parts = F.split(F.get(place, F.lit(0)), "/")
    files = spark.read.option("wholetext", True).option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(path)
    rows = files.select(F.input_file_name().alias("path"), cleaned(F.col("value")).alias("value"))
    return rows.select("path", F.get(parts, F.lit(0)).alias("provider_id"), F.get(parts, F.lit(1)).alias("provider_key"), F.regexp_replace(F.get(parts, F.lit(2)), r"\.html?$", "").alias("id"), "value")


def cleaned(text: Column) -> Column:
    """A page's text without byte order marks and zero bytes, ligatures as letters, line ends as \\n."""
    text = F.translate(F.regexp_replace(text, "\r\n?", "\n"), "\ufeff\x00", "")
    for one, two in (("\ufb00", "ff"), ("\ufb01", "fi"), ("\ufb02", "fl"), ("\ufb03", "ffi"), ("\ufb04", "ffl")):
        text = F.replace(text, F.lit(one), F.lit(two))
    return text


def decoded(content: Column, charset: Column) -> Column:
    """Bytes of a page as text by the charset that it names: UTF-8, ISO-8859-1 (also for Windows-1252) or UTF-16; UTF-8 for
    others."""
    key = F.lower(charset)
    latin = key.isin("iso-8859-1", "latin1", "windows-1252", "us-ascii")
    return cleaned(F.when(latin, F.decode(content, "ISO-8859-1")).when(key.startswith("utf-16"), F.decode(content, "UTF-16")).otherwise(F.try_validate_utf8(content.cast("string"))))


def lookup_table(spark: SparkSession, path: str) -> DataFrame:
    """"field value" lines as (field, value)."""
    return spark.read.text(path).select(F.regexp_extract("value", r"^(\S+)\s+(.*)$", 1).alias("field"), F.trim(F.regexp_extract("value", r"^(\S+)\s+(.*)$", 2)).alias("value")).where("field != ''")


def parameters(spark: SparkSession, path: str) -> dict[str, str]:
    """"[Key]: value" lines of a small configuration file."""
    rows = spark.read.text(path).select(F.regexp_extract("value", r"^\[([^\]]+)\]:\s*(.*)$", 1).alias("k"), F.trim(F.regexp_extract("value", r"^\[([^\]]+)\]:\s*(.*)$", 2)).alias("v"))
    return {r["k"]: r["v"] for r in rows.where("k != ''").collect()}


def postal_csv(spark: SparkSession, path: str) -> DataFrame:
    """Postal codes without blanks; missing coordinates are null."""
    raw = spark.read.schema("postal_code string, latitude string, longitude string").option("header", True).csv(path)
    number = lambda c: F.nullif(F.trim(c), F.lit("")).try_cast("double").alias(c)
    return raw.select(F.regexp_replace(F.upper("postal_code"), r"\s", "").alias("postal_code"), number("latitude"), number("longitude"))


def fsa_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("fsa string, province string, abbr string, code int, time_zone int, latitude double, longitude double").csv(path)


def pages_to_fetch(listed: DataFrame, landed: DataFrame, key: str = "url") -> DataFrame:
    """Listed pages that have not landed yet, each once."""
    return listed.dropDuplicates([key]).join(landed.select(key), key, "left_anti")


def listing_pages(providers: DataFrame, per_page: int = 10) -> DataFrame:
    """(provider, page) for as many entries as each provider lists."""
    return providers.withColumn("page", F.explode(F.sequence(F.lit(1), F.ceil(F.col("entries") / per_page).cast("int"))))
