"""Schemas of the notice files and tables, and what stands for a missing value in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Positions of the person file as it is read.
PERSON = (
    "last1 string, last2 string, last3 string, last4 string, first1 string, first2 string, first3 string, middle string, prefix string, suffix string, "
    "gender string, dob string, dod string, min_dob string, max_dob string, yob string, yod string, age string, url string, last_updated string, "
    "language_code string, language string, provider_id string, provider_key string, id string, service_date string, publish_date string, spouse string, "
    "flag1 string, flag2 string, flag3 string, flag4 string, flag5 string, flag6 string, flag7 string, flag8 string, flag9 string, flag10 string, check_text string, "
    "postal_code string, num_unmatched string, prior_unmatched string, run_code string"
)
#: The last three positions differ in the file as it is written.
PERSON_WRITTEN = PERSON.replace("num_unmatched string, prior_unmatched string, run_code string", "prior_unmatched string, run_code string, first_given_name_used string")
URL_LIST = ("provider_id", "provider_key", "url", "post_request", "dob", "yob", "dod", "yod", "maiden_names", "id", "pub_date", "age_at_death", "place_key")
OBIT_LIST = ("provider_id", "provider_key", "id", "url", "dob", "yob", "dod", "yod", "maiden_names", "pub_date", "age_at_death", "place_key")
#: What stands for "unknown".
NO_DATES = ("0001-01-01", "1875-01-01", "1900-01-01")
NO_AGE = 999


def names(ddl: str) -> list[str]:
    return [x.split()[0] for x in ddl.split(", ")]


def known_date(c: Column, pattern: str = "yyyyMMdd") -> Column:
    d = F.try_to_date(c, pattern)
    return F.when(~d.isin(*[F.lit(x).cast("date") for x in NO_DATES]), d)


def known_number(c: Column, unknown: int = 0) -> Column:
    n = c.try_cast("int")
    return F.when(n != unknown, n)


def known_text(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def typed_person(raw: DataFrame) -> DataFrame:
    """Person rows with dates, numbers and nulls; last and first names also as lists."""
    dates = ("dob", "dod", "min_dob", "max_dob", "last_updated", "service_date", "publish_date")
    numbers = ("yob", "yod", "provider_id", "provider_key", "num_unmatched", "prior_unmatched")
    out = {c: known_text(F.col(c)) for c in raw.columns}
    out |= {c: known_date(F.col(c)) for c in dates if c in raw.columns}
    out |= {c: known_number(F.col(c)) for c in numbers if c in raw.columns}
    out |= {"age": known_number(F.col("age"), NO_AGE), "run_code": F.coalesce(F.col("run_code").try_cast("int"), F.lit(0))}
    lists = {"last_names": ("last1", "last2", "last3", "last4"), "first_names": ("first1", "first2", "first3")}
    rows = raw.withColumns(out)
    return rows.withColumns({k: F.array_compact(F.array(*v)) for k, v in lists.items()})
