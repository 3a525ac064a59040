"""Loading decided records into the table of persons, and what the table's rows are read as.

A load is a new version of the table: rows that are replaced go, rows that are updated take what the incoming record knows,
and the others are added with new ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lychgate.operators import linkage, maintain
from lychgate.sources.scratch import written

#: The columns of a stored person, a row for each variant of the last name.
PERSON_COLUMNS = (
    "id", "last_name", "alt_last_name1", "alt_last_name2", "alt_last_name3", "first_name", "name_aka1", "name_aka2", "middle_names", "prefix", "suffix", "gender", "dob", "min_dob", "max_dob",
    "dod", "yob", "yod", "age_at_death", "spouse_name", "dos", "language", "weight", "first_loaded", "last_updated",
)
#: Begins the last name of a record that is kept only so that it is not read again.
JUNK = "BR_"
ADDING = ("insert", "force_new", "junk")
UPDATING = ("update", "override")


def person_rows(records: DataFrame, loaded: Column) -> DataFrame:
    """PERSON_COLUMNS of records (id, last_names, first_names, middle, ...): a row for each last name, which stands first in its
    row and the others after it, weighted by their number. Columns that records lack are null."""
    rows = linkage.variant_rows(records, "last_names")
    others = F.filter(F.col("last_names"), lambda x: x != F.col("variant"))
    made = {"last_name": F.col("variant"), "first_loaded": loaded, "last_updated": loaded, "weight": F.col("weight")}
    made |= {f"alt_last_name{i + 1}": F.get(others, F.lit(i)) for i in range(3)}
    made |= {n: F.get("first_names", F.lit(i)) for i, n in enumerate(("first_name", "name_aka1", "name_aka2"))}
    return rows.select(*[made.get(c, F.col(c) if c in records.columns else F.lit(None)).alias(c) for c in PERSON_COLUMNS])


def load(people: DataFrame, incoming: DataFrame, key: str = "id") -> DataFrame:
    """The table people (key, ...) after incoming records (rec_id, action, target, and columns of people but the key; missing
    ones are null): update and override fill the target's row with what is known, the later record first; replace puts the
    record in the target's place; insert and force_new add it; junk adds it too, named so that it is not read again,
    with weight 0 where that is a column; skip and review leave the table as it is. New keys follow the greatest one in order
    of rec_id."""
    rest = [c for c in people.columns if c != key]
    known = {c: F.col(c) if c in incoming.columns else F.lit(None) for c in rest}
    rows = incoming.select("rec_id", "action", "target", *[known[c].cast(people.schema[c].dataType).alias(c) for c in rest])
    rows = written(rows, "incoming")  # each action reads it
    newest = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("rec_id"))).alias(f"_{c}") for c in rest]
    changes = rows.where(F.col("action").isin(*UPDATING)).groupBy(F.col("target").alias(key)).agg(*newest)
    replaced = rows.where("action = 'replace'").groupBy(F.col("target").alias(key)).agg(F.max_by(F.struct(*rest), "rec_id").alias("_row")).select(key, "_row.*")
    kept = people.join(replaced.select(key).hint("merge"), key, "left_anti").join(changes.hint("merge"), key, "left")
    kept = kept.select(key, *[F.coalesce(f"_{c}", c).alias(c) for c in rest])
    added = rows.where(F.col("action").isin(*ADDING))
    junk = F.col("action") == "junk"
    if "last_name" in rest:
        added = added.withColumn("last_name", F.when(junk, F.concat(F.lit(JUNK), F.coalesce("last_name", F.lit("")))).otherwise(F.col("last_name")))
    if "weight" in rest:
        added = added.withColumn("weight", F.when(junk, F.lit(0).cast(people.schema["weight"].dataType)).otherwise(F.col("weight")))
    first = people.agg(F.coalesce(F.max(key), F.lit(0))).first()[0] + 1
    return kept.unionByName(replaced).unionByName(maintain.numbered(added, "rec_id", key, first).select(key, *rest))


def upsert_sources(known: DataFrame, new: DataFrame) -> DataFrame:
    """Source ids (person_id, provider_id, provider_key, source_id, url, publish_date) with new ones: of one that is stored
    only the date of publication is taken over."""
    keys = ["person_id", "provider_id", "provider_key", "source_id"]
    both = known.withColumn("_stored", F.lit(1)).unionByName(new.withColumn("_stored", F.lit(0)))
    latest = F.coalesce(F.max_by("publish_date", F.when(F.col("_stored") == 0, F.col("publish_date"))), F.max("publish_date"))
    return both.groupBy(*keys).agg(F.max_by("url", F.struct("_stored", "url")).alias("url"), latest.alias("publish_date"))


def read_person(person: DataFrame, sources: DataFrame, as_of: Column) -> DataFrame:
    """Persons (id, yob, yod, age_at_death, ...) as they are read: years from 1875 to this one, ages up to 130, and of their
    sources (id, provider_id, provider_key, source_id) the first."""
    year = lambda c: F.when(F.col(c).between(1875, F.year(as_of)), F.col(c)).alias(c)
    first = sources.groupBy("id").agg(F.min(F.struct("provider_id", "provider_key", "source_id")).alias("_s")).select("id", "_s.*")
    rest = [c for c in person.columns if c not in ("id", "yob", "yod", "age_at_death")]
    told = person.select("id", *rest, year("yob"), year("yod"), F.when(F.col("age_at_death").between(0, 130), F.col("age_at_death")).alias("age_at_death"))
    return told.join(first, "id", "left")
