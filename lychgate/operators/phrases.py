"""Phrases of several words, matched longest first in one pass over a text, whatever their number."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Phrases that a worker may hold; more are an error, so that none is left out.
MOST = 500_000
#: Phrases by what they do to a notice: cut it off, for others are spoken of from there, or stand for nothing.
FAMILY = {
    "cut": (
        "survived by", "predeceased by", "leaves behind", "is mourned by", "left to mourn", "mourned by", "she will be missed by", "he will be missed by", "dear wife of the late", "also survived by", "lovingly remembered by",
        "il laisse dans le deuil", "elle laisse dans le deuil", "outre ses parents", "le sobreviven",
    ),
    "filler": (
        "it is with great sadness that we announce", "it is with heavy hearts that", "with great sorrow", "after a long illness", "after a courageous battle with", "peacefully", "surrounded by family", "surrounded by her family", "surrounded by his family",
        "in loving memory of", "in memory of", "the family announces", "c'est avec tristesse que", "c'est avec une grande tristesse que", "con gran tristeza",
    ),
}
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")


def words_of(text: str) -> list[tuple[str, int, int]]:
    """Words in lower case with a plain apostrophe, and where they begin and end."""
    return [(m[0].lower().replace("’", "'"), m.start(), m.end()) for m in _WORD.finditer(text)]


class Phrases:
    """A trie over words; a node is a dictionary, and "" in it holds what its phrase stands for."""

    def __init__(self, phrases: list[tuple[str, str]]):
        self.root: dict = {}
        for phrase, kind in phrases:
            node = self.root
            for word, _, _ in words_of(phrase):
                node = node.setdefault(word, {})
            if node is not self.root:
                node[""] = (phrase, min(kind, node[""][1])) if "" in node else (phrase, kind)

    def hits(self, text: str) -> Iterator[tuple[str, str, int, int, int]]:
        """(phrase, kind, place of its first word, start, end) from left to right, the longest at each place; none overlaps another."""
        words = words_of(text)
        i = 0
        while i < len(words):
            node, best = self.root.get(words[i][0]), None
            j = i + 1
            while node is not None:
                if "" in node:
                    best = j, node[""]
                if j == len(words):
                    break
                node = node.get(words[j][0])
                j += 1
            if best:
                yield *best[1], i, words[i][1], words[best[0] - 1][2]
                i = best[0]
            else:
                i += 1


def family_phrases(spark: SparkSession) -> DataFrame:
    """FAMILY as a table (phrase, kind)."""
    return spark.createDataFrame([(p, k) for k, own in FAMILY.items() for p in own], "phrase string, kind string")


def _held(phrases: DataFrame):
    """A trie of a table (phrase, kind), sent to the workers once."""
    rows = phrases.where("phrase is not null").select("phrase", F.coalesce("kind", F.lit("")).alias("kind")).distinct().limit(MOST + 1).toArrow()
    if rows.num_rows > MOST:
        raise ValueError(f"more than {MOST} phrases")
    pairs = sorted(zip(rows["phrase"].to_pylist(), rows["kind"].to_pylist()))
    return phrases.sparkSession.sparkContext.broadcast(Phrases(pairs))


def phrase_hits(docs: DataFrame, key: str, text: str, phrases: DataFrame) -> DataFrame:
    """(key, phrase, kind, word, start, end) of every match in texts; start and end count characters from 0. Case and the kind of apostrophe
    do not matter; of equal phrases one counts, under its least kind. Null texts have none."""
    trie = _held(phrases)
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, phrase string, kind string, word int, start int, end int"
    own = pa.schema([("phrase", pa.string()), ("kind", pa.string()), ("word", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches):
        for batch in batches:
            at, rows = [], []
            for k, t in enumerate(batch[1].to_pylist()):
                found = list(trie.value.hits(t)) if t else []
                at += [k] * len(found)
                rows += found
            if rows:
                cols = [pa.array(c, f.type) for c, f in zip(zip(*rows), own)]
                yield pa.RecordBatch.from_arrays([batch[0].take(pa.array(at)), *cols], names=[key, *own.names])

    return docs.select(key, text).mapInArrow(run, schema)


def told_of_person(docs: DataFrame, key: str, text: str, phrases: DataFrame, out: str = "told") -> DataFrame:
    """(key, out): texts up to the first phrase of kind cut, without those of kind filler; blanks are squeezed. Null for null."""
    trie = _held(phrases)
    kind = docs.schema[key].dataType.simpleString()

    def kept(t: str) -> str:
        parts, at = [], 0
        for _, kind, _, start, end in trie.value.hits(t):
            parts.append(t[at:start])
            at = len(t) if kind == "cut" else end
            if kind == "cut":
                break
        return re.sub(r"\s+", " ", " ".join([*parts, t[at:]])).strip()

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch[0], pa.array([None if t is None else kept(t) for t in batch[1].to_pylist()], pa.string())], names=[key, out])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, `{out}` string")
