"""Classes of words in three languages, as one table, and counts of them in texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lychgate.functions.text import words
from lychgate.operators.extract import GENDER_WORDS, MONTHS

#: Words by class and language, besides the months and the words of gender.
CLASSES = {
    "prefix": {"en": ("mr", "mrs", "ms", "miss", "dr", "rev", "sir"), "fr": ("monsieur", "madame", "mme", "mlle", "abbé"), "es": ("señor", "señora", "don", "doña")},
    "suffix": {"en": ("jr", "sr", "ii", "iii", "iv", "esq", "phd"), "fr": ("fils", "père"), "es": ("hijo",)},
    "weekday": {
        "en": ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"),
        "fr": ("lundi", "mardi", "mercredi", "jeudi", "vendredi", "samedi", "dimanche"),
        "es": ("lunes", "martes", "miércoles", "jueves", "viernes", "sábado", "domingo"),
    },
    "birth": {"en": ("born", "birth", "birthday"), "fr": ("né", "née", "naissance"), "es": ("nació", "nacido", "nacida")},
    "death": {"en": ("died", "death", "passed", "deceased"), "fr": ("décédé", "décédée", "décès", "mort"), "es": ("murió", "falleció", "fallecida")},
    "age": {"en": ("age", "aged", "old", "years"), "fr": ("âge", "âgé", "âgée", "ans"), "es": ("edad", "años")},
    "service": {"en": ("funeral", "service", "memorial", "visitation", "burial"), "fr": ("funérailles", "obsèques", "messe"), "es": ("funeral", "misa", "velorio")},
    "relationship": {"en": ("survived", "predeceased", "family", "friends"), "fr": ("famille", "amis", "proches"), "es": ("familia", "amigos")},
}


def entries() -> list[tuple[str, str, str, str | None]]:
    """(class, language, word, gender), gender only for words that tell it."""
    out = [(kind, lang, word, None) for kind, by in CLASSES.items() for lang, own in by.items() for word in own]
    out += [("month", lang, word, None) for lang, own in MONTHS.items() for word in own]
    return out + [("gender", lang, word, g) for lang, by in GENDER_WORDS.items() for g, own in by.items() for word in own]


def lexicon(spark: SparkSession) -> DataFrame:
    """The table of all entries(); its size is that of the lists above."""
    return spark.createDataFrame(entries(), "kind string, language string, word string, gender string")


def counts(docs: DataFrame, key: str, text: str, table: DataFrame) -> DataFrame:
    """(key, kind, language, n): how many words of a text are of a class, by language; a word may be of several. Whether the
    table of words is sent to all tasks is left to its size."""
    each = docs.select(key, F.explode(words(F.col(text))).alias("word"))
    return each.join(table, "word").groupBy(key, "kind", "language").agg(F.count("*").alias("n"))
