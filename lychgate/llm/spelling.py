"""Spelling variants of words, by a positional q-gram inverted index with a count filter.

1. Words are counted in whole texts, task by task, before they are shuffled.
2. One edit leaves the first or the second half of a word as it is. So words are dealt by their length and either half to
   blocks, where they are indexed; words one code point longer come to the same blocks by the shorter word's halves and only ask.
   A block of more than INDEXED words is dealt to several tasks, each with a part of the index and all that ask.
3. A task keeps postings of the rest of each word, by gram (Q code points, with marks at both ends) and place, in order. A
   word that asks finds for each of its grams the postings at the same place, or, of shorter words, at the place before, too. One
   edit spoils Q grams at most, so a partner has all others. The shortest lists, one more than may be missing, are merged
   by a heap; what they name is sought in the longer lists by bisection, and kept if it reaches the bound.
4. Kept pairs are verified, and each is reported in one block only.
5. The near word with most occurrences is the form of a word if it has at least RATIO times as many; forms of forms are
   followed by doubling steps, a join each, of which there are few, for counts grow by RATIO on each link.

Defined results: words are compared as they are counted; null texts have none; a null doc_id is an empty text in the damage's checksum; rows
that share a doc_id all count; texts are read whole and words have any length; of near words of equal counts the
smallest in code-point order is the form; an empty table gives none; extra columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from heapq import merge
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lychgate.llm.common import docs_of, forget, small_batches, to_arrow, written

Q = 2
LEAST_LENGTH, LEAST_COUNT, RATIO = 5, 3, 2
#: Words of an index in one task, and different words that a task counts before it hands them on.
INDEXED, COUNTED = 20_000, 200_000
#: One in so many words of a text loses a code point in the query.
DAMAGE = 97
#: Marks before and after a word's rest.
BEGIN, END = "\x01", "\x02"
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs_of(text: str | None, least: int = 1) -> Counter:
    """Runs of letters of least code points or more as they are written, with their numbers."""
    pattern = _RUN if least < 2 else re.compile(_RUN.pattern[:-1] + f"{{{least},}}")
    return Counter(pattern.findall(text or ""))


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, damage: int = 0) -> DataFrame:
    """(word, n): words of docs (doc_id, text), A-Z in lower case. damage: one word of a text in so many loses a code point."""
    kinds = to_arrow(StructType.fromDDL("word string, n long"))

    def run(batches):
        forget()
        counts: dict[str, int] = {}

        def out():
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], schema=kinds)

        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                head = crc32(b"%b:" % (b"" if doc is None else str(doc).encode()))
                for word, n in runs_of(text, least_length).items():
                    word = word.lower() if word.isascii() else word.translate(_LOWER)
                    if damage and not (h := crc32(word.encode(), head)) % damage:
                        word = word[: h % len(word)] + word[h % len(word) + 1 :]
                        if len(word) < least_length:
                            continue
                    counts[word] = counts.get(word, 0) + n
                if len(counts) > COUNTED:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    return small_batches(rows).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def blocks(words: DataFrame, least_length: int = LEAST_LENGTH, indexed: int = INDEXED) -> DataFrame:
    """(key, part, word, n, own): words in the blocks of their halves; own: whether the block's index holds the word, which otherwise
    only asks. key: length of the indexed words, which half, the half."""
    size = F.length("word")

    def at(n, own):
        half = (n / 2).cast("int")
        first, rest = F.col("word").substr(F.lit(1), half), F.col("word").substr(size - (n - half) + 1, n - half)
        return [F.struct(F.concat(n.cast("string"), F.lit(side), half).alias("key"), F.lit(own).alias("own")) for side, half in (("<", first), (">", rest))]

    rows = words.select("word", "n", F.explode(F.array(*at(size, True), *at(size - 1, False))).alias("x")).select("x.key", "word", "n", "x.own")
    rows = written(rows.where(F.col("own") | (F.length("word") > least_length)), "halves")
    large = rows.where("own").groupBy("key").agg(F.ceil(F.count("*") / indexed).cast("int").alias("parts")).where("parts > 1")
    met = rows.join(written(large, "large"), "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    dealt = met.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return dealt.select("key", "part", "word", "n", (F.col("own") & (F.pmod(F.xxhash64("word"), F.col("parts")) == F.col("part"))).alias("own"))


def grams(rest: str) -> list[str]:
    padded = BEGIN + rest + END
    return [padded[i : i + Q] for i in range(len(padded) - Q + 1)]


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point makes b of a."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1 or a == b:
        return False
    i = next((i for i, y in enumerate(b) if a[i] != y), len(b))
    return a[i + 1 :] == (b[i + 1 :] if len(a) == len(b) else b[i:])


class Index:
    """Postings of words of one length with the same half."""

    def __init__(self, length: int, first: bool):
        self.length, self.half, self.first = length, length // 2, first
        self.words: list[str] = []
        self.counts: list[int] = []
        size = length - self.half if first else self.half
        self.postings: list[dict[str, list[int]]] = [{} for _ in range(size + 1)]

    def rest(self, word: str) -> str:
        return word[self.half :] if self.first else word[: len(word) - (self.length - self.half)]

    def add(self, word: str, n: int) -> None:
        for held, gram in zip(self.postings, grams(self.rest(word)), strict=True):
            held.setdefault(gram, []).append(len(self.words))
        self.words.append(word)
        self.counts.append(n)

    def partners(self, word: str) -> list[int]:
        """Indexed words one edit away: of the same length those that come after word, and of a shorter one those that the other half's
        block does not report."""
        rest = grams(self.rest(word))
        longer = len(word) > self.length
        enough = len(rest) - Q
        lists = []
        for i, gram in enumerate(rest):
            places = (i - 1, i) if longer else (i,)
            lists.append([x for p in places if 0 <= p < len(self.postings) and (x := self.postings[p].get(gram))])
        if sum(1 for x in lists if not x) > Q:
            return []
        lists.sort(key=lambda x: sum(map(len, x)))
        found = Counter(merge(*(x for short in lists[: Q + 1] for x in short)))
        out = []
        for i, n in found.items():
            other = self.words[i]
            if not longer and other <= word or longer and not self.first and other[: self.half] == word[: self.half]:
                continue
            for left, group in zip(range(len(rest) - Q - 2, -1, -1), lists[Q + 1 :]):
                if n + left + 1 < enough:
                    break
                for x in group:
                    at = bisect_left(x, i)
                    n += at < len(x) and x[at] == i
            if n >= enough and one_edit(word, other):
                out.append(i)
        return out


def near_words(words: DataFrame, least_length: int = LEAST_LENGTH, indexed: int = INDEXED) -> DataFrame:
    """(word, n, near, near_n): every two words of words (word, n) that one edit makes of each other, both ways round. All words have least_length
    code points or more, which is 4 at least."""
    if least_length < 2 * Q:
        raise ValueError(f"words have to have {2 * Q} code points or more: {least_length}")
    schema = "word string, n long, near string, near_n long"
    kinds = to_arrow(StructType.fromDDL(schema))

    def run(batches):
        forget()
        now, index, asked, rows = None, None, 0, []

        def ask(word, n):
            for i in index.partners(word):
                other, m = index.words[i], index.counts[i]
                rows.extend(((word, n, other, m), (other, m, word, n)))

        def close():
            """Indexed words ask when all of them are there."""
            nonlocal asked
            while index and asked < len(index.words):
                ask(index.words[asked], index.counts[asked])
                asked += 1
                if len(rows) > 10_000:
                    yield out()

        def out():
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.types, strict=True)], schema=kinds)
            rows.clear()
            return made

        for batch in batches:
            for key, part, word, n, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (key, part) != now:
                    yield from close()
                    now, asked = (key, part), 0
                    length, side = re.match("([0-9]+)([<>])", key).groups()
                    index = Index(int(length), side == "<")
                if own:
                    index.add(word, n)
                elif index.words:
                    ask(word, n)
                if len(rows) > 10_000:
                    yield out()
        yield from close()
        if rows:
            yield out()

    dealt = blocks(words, least_length, indexed).repartition("key", "part").sortWithinPartitions("key", "part", F.col("own").desc())
    return small_batches(dealt).mapInArrow(run, schema)


def forms(words: DataFrame, least_length: int = LEAST_LENGTH, ratio: int = RATIO, indexed: int = INDEXED) -> DataFrame:
    """word, form, n, n_near, form_n for every row of words (word, n), one of each word."""
    alone = words.select("word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n"))
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("n"), "near"))).alias("best")
    told = near_words(words, least_length, indexed).union(alone).groupBy("word").agg(F.max("n").alias("n"), F.count("near").alias("n_near"), best)
    fits = -F.col("best.n") >= ratio * F.col("n")
    return told.select("word", F.when(fits, F.col("best.near")).alias("form"), "n", "n_near", F.when(fits, -F.col("best.n")).alias("form_n"))


def roots(found: DataFrame) -> DataFrame:
    """(word, root) of the words of found (word, form) that have a form: the last form of a form."""
    now = written(found.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = written(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        now = step.select("word", "root")
        if step.where("moved").isEmpty():
            return now


def variants(words: DataFrame, least_length: int = LEAST_LENGTH, ratio: int = RATIO, indexed: int = INDEXED) -> DataFrame:
    """word, form, root, n, n_near, form_n for every row of words (word, n), one of each word; root is the same for all spellings of a group."""
    found = written(forms(words, least_length, ratio, indexed), "forms")
    root = F.coalesce("root", "word").alias("root")
    return found.join(roots(found), "word", "left").select("word", "form", root, "n", "n_near", "form_n")


def op13_spelling(spark, sf_dir: str) -> DataFrame:
    return variants(written(word_counts(docs_of(spark, sf_dir), damage=DAMAGE), "words"))
