"""Language identification with interpolated Kneser-Ney character models, one a language.

Counts. Every training text adds its space-delimited words, in lower case, to counts of ORDER
characters; a word is preceded by ORDER - 1 marks and followed by one, so grams do not cross words.
All training rows but the calibration sample are counted, in partial sums by task. Lower orders are not
counted again: their Kneser-Ney counts are the numbers of distinct characters before a gram.

Model. Counts, context sums, discounts and interpolated probabilities are aggregations and joins on the gram, so
they are spread over the cluster, all languages of a gram in one row. Every distinct gram is kept with its
own count. Only the finished arrays reach the driver and the workers: for each gram of each order a 64-bit hash, in
ascending order, and its probability in every language, and for each context its weights. They grow with the
corpus' distinct grams, which are far fewer than its words.

Prediction. The language of the lowest cross-entropy a character; the score is the softmax over the
languages' total costs, tempered so that it is calibrated on a sample of training rows that the
counts leave out (one in ten, about CALIBRATION_ROWS at most; rows of a language that has no other ones are
counted instead). The same sample gives the cross-entropy above
which a text is marked rejected: it is like none of the languages, and lang_pred is then only the nearest of them.

Defined results: null texts and texts without a letter (Unicode category L) are `und` with score 0; words of any
length are read whole, those over LONG characters in parts that know the characters before them; of languages of
equal cost the first in order of their names is taken; rows are told one by one, so a repeated doc_id gives a row
each; without training rows every text is `und`; an empty table gives an empty one; equal texts get equal results; extra
columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lychgate.llm.common import crc_mod, docs_of, held, map_batches, small_batches, to_arrow, written

ORDER = 5
LONG = 64
CALIBRATION_ROWS = 5_000
REJECT_QUANTILE = 0.995
MARK = "\x02"
_FLUSH_WORDS = 150_000
_CACHE_WORDS = 300_000
#: Words that are looked up together, about.
_PART_WORDS = 50_000
_LETTER = regex.compile(r"\p{L}")
_PLACE = np.random.Generator(np.random.PCG64(5)).integers(1, 2**63, ORDER + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def words_of(text: str) -> list[str]:
    return text.lower().split()


def marked(word: str) -> list[str]:
    """A word with its marks, in parts of LONG characters, each after the ORDER - 1 characters before it."""
    p = MARK * (ORDER - 1) + word + MARK
    return [p] if len(word) < LONG else [p[i : i + LONG + ORDER - 1] for i in range(0, len(p) - ORDER + 1, LONG)]


def held_out(id_col: Column) -> Column:
    return crc_mod(id_col, 4) == 2


def count_grams(words: list[tuple[str, int]]) -> tuple[list[str], np.ndarray]:
    """Distinct ORDER-grams of words with their counts, told apart by their 64-bit hashes."""
    parts, numbers = [], []
    for w, n in words:
        own = marked(w)
        parts += own
        numbers += [n] * len(own)
    text = "".join(parts)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.array([len(p) for p in parts])
    lengths = sizes - ORDER + 1
    place = np.repeat(np.cumsum(sizes) - np.cumsum(lengths), lengths) + np.arange(int(lengths.sum()))
    _, first, of = np.unique(_hash_at(codes, place, ORDER), return_index=True, return_inverse=True)
    counts = np.bincount(of, np.repeat(np.array(numbers, np.float64), lengths), len(first)).astype(np.int64)
    return [text[e - ORDER + 1 : e + 1] for e in place[first].tolist()], counts


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) partial counts of ORDER-grams over all rows of docs (lang, text)."""
    schema = "lang string, gram string, n long"
    kinds = to_arrow(StructType.fromDDL(schema))

    def flush(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, words in counts.items():
            own = [*words.items()]
            for at in range(0, len(own), _PART_WORDS):
                grams, numbers = count_grams(own[at : at + _PART_WORDS])
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.string()), pa.array(numbers)], schema=kinds)
        counts.clear()

    def run(batches):
        counts: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                words = words_of(text)
                for at in range(0, len(words), _FLUSH_WORDS):
                    counts.setdefault(lang, Counter()).update(words[at : at + _FLUSH_WORDS])
                    if sum(map(len, counts.values())) > _FLUSH_WORDS:
                        yield from flush(counts)
        yield from flush(counts)

    return small_batches(docs.select("lang", "text")).mapInArrow(run, schema)


def _hash_at(codes: np.ndarray, ends: np.ndarray, order: int) -> np.ndarray:
    """Hashes of the grams of an order that end at some places of a row of character codes."""
    h = np.full(len(ends), order, np.uint64)
    for i in range(order):
        h += (codes[ends - order + 1 + i] + np.uint64(1)) * _PLACE[i]
    h ^= h >> np.uint64(31)
    return h * _PLACE[ORDER]


@dataclass
class Models:
    langs: list[str]
    #: By order from 1: sorted hashes and log probabilities (grams, languages). Where a language has not seen a gram
    #: that another has, it holds what its lower orders give, so that a gram found needs no other lookup.
    grams: list[tuple[np.ndarray, np.ndarray]]
    #: By context length from 1: sorted hashes and log weights; 0 where unseen.
    contexts: list[tuple[np.ndarray, np.ndarray]]
    #: Log probability of a character that a language has never seen.
    floor: np.ndarray
    temper: float = 1.0
    reject: float = np.inf

    def costs(self, words: list[str]) -> np.ndarray:
        """Negative log probabilities (words, languages) and, in the last column, characters counted."""
        return self.costs_of([MARK * (ORDER - 1) + w + MARK for w in words])

    def costs_of(self, parts: list[str]) -> np.ndarray:
        """The same of parts that begin with the ORDER - 1 characters before them."""
        codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        lengths = np.array([len(p) - ORDER + 1 for p in parts])
        ends = np.cumsum(lengths + ORDER - 1)
        starts = ends - lengths
        place = np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(int(lengths.sum()))
        logp = np.zeros((len(place), len(self.langs)))
        todo = np.arange(len(place))
        for order in range(ORDER, 0, -1):
            keys, values = self.grams[order - 1]
            at, found = _find(keys, _hash_at(codes, place[todo], order))
            logp[todo[found]] += values[at[found]]
            todo = todo[~found]
            if not len(todo):
                break
            if order > 1:
                keys, values = self.contexts[order - 2]
                at, found = _find(keys, _hash_at(codes, place[todo] - 1, order - 1))
                logp[todo[found]] += values[at[found]]
        logp[todo] += self.floor
        out = np.add.reduceat(-logp, np.cumsum(lengths) - lengths, axis=0)
        return np.hstack([out, lengths[:, None]])


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in sorted keys, and whether what is wanted is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def discount_of(once: int, twice: int) -> float:
    """From the numbers of grams counted once and twice."""
    return min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5


def _per(places, what) -> list[Column]:
    return [what(k, F.col(f"n{k}")).alias(f"n{k}") for k in places]


def fitted(partial: DataFrame, langs: list[str] | None = None) -> Models:
    """Models from partial counts (lang, gram, n) of ORDER-grams: interpolated Kneser-Ney, by aggregations and joins on
    the gram. Where a language has not seen a gram that another has, the same sums give what its lower orders say.
    langs: all languages there, if known; one without grams is left out."""
    langs = sorted(langs if langs is not None else (r["lang"] for r in partial.select("lang").distinct().collect()))
    if not langs:
        return build({})
    own = [F.coalesce(F.sum(F.when(F.col("lang") == x, F.col("n"))), F.lit(0)).alias(f"n{k}") for k, x in enumerate(langs)]
    tables = {ORDER: written(partial.groupBy("gram").agg(*own), "order")}
    for order in range(ORDER - 1, 0, -1):
        below = tables[order + 1].groupBy(F.substring("gram", 2, order).alias("gram"))
        tables[order] = written(below.agg(*_per(range(len(langs)), lambda k, n: F.sum((n > 0).cast("long")))), "order")

    def told(order: int) -> DataFrame:
        sums = [f(F.col(f"n{k}")).alias(f"{name}{k}") for k in range(len(langs)) for name, f in (
            ("once", lambda n: F.sum((n == 1).cast("long"))), ("twice", lambda n: F.sum((n == 2).cast("long"))), ("total", F.sum), ("kinds", lambda n: F.sum((n > 0).cast("long"))),
        )]
        return tables[order].agg(F.lit(order).alias("order"), *sums)

    facts = told(1)
    for order in range(2, ORDER + 1):
        facts = facts.union(told(order))
    of = {r["order"]: r for r in facts.collect()}
    seen = [k for k in range(len(langs)) if of[1][f"total{k}"]]
    if not seen:
        return build({})
    discount = {o: {k: discount_of(r[f"once{k}"], r[f"twice{k}"]) for k in seen} for o, r in of.items()}
    # Order 1: what is left of the sum is shared evenly by an alphabet twice as large as what was seen.
    share = {k: discount[1][k] * of[1][f"kinds{k}"] / of[1][f"total{k}"] / max(256, 2 * of[1][f"kinds{k}"]) for k in seen}
    cut = lambda k, n, order: F.greatest(n - F.lit(discount[order][k]), F.lit(0.0))
    chance = {1: written(tables[1].select("gram", *_per(seen, lambda k, n: cut(k, n, 1) / of[1][f"total{k}"] + F.lit(share[k]))), "chance")}
    out = []
    for order in range(2, ORDER + 1):
        context = F.substring("gram", 1, order - 1)
        sums = [F.sum(F.col(f"n{k}")).alias(f"t{k}") for k in seen]
        left = [
            F.when(F.sum(F.col(f"n{k}")) > 0, F.lit(discount[order][k]) * F.sum((F.col(f"n{k}") > 0).cast("long")) / F.sum(F.col(f"n{k}"))).otherwise(F.lit(1.0)).alias(f"l{k}")
            for k in seen
        ]
        contexts = written(tables[order].groupBy(context.alias("context")).agg(*sums, *left), "contexts")
        out.append(contexts.select(F.lit(-(order - 1)).alias("order"), F.col("context").alias("gram"), F.array(*[F.log(f"l{k}").cast("float") for k in seen]).alias("logs")))
        lower = chance[order - 1].select(F.col("gram").alias("suffix"), *[F.col(f"n{k}").alias(f"p{k}") for k in seen])
        both = tables[order].withColumn("context", context).withColumn("suffix", F.substring("gram", 2, order - 1)).join(contexts, "context").join(lower, "suffix")
        now = both.select("gram", *_per(seen, lambda k, n: F.when(F.col(f"t{k}") > 0, cut(k, n, order) / F.col(f"t{k}")).otherwise(F.lit(0.0)) + F.col(f"l{k}") * F.col(f"p{k}")))
        chance[order] = written(now, "chance")
    for order, table in chance.items():
        out.append(table.select(F.lit(order).alias("order"), "gram", F.array(*[F.log(f"n{k}").cast("float") for k in seen]).alias("logs")))
    rows = out[0]
    for more in out[1:]:
        rows = rows.union(more)

    def hashed(cols):
        at = {}
        for i, o in enumerate(cols["order"]):
            at.setdefault(o, []).append(i)
        for o, places in at.items():
            n = abs(o)
            codes = np.frombuffer("".join([cols["gram"][i] for i in places]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
            hashes = _hash_at(codes, np.arange(n - 1, len(codes), n), n).view(np.int64)
            yield {"order": [o] * len(places), "hash": hashes.tolist(), "logs": [cols["logs"][i] for i in places]}

    got = map_batches(rows, hashed, "order int, hash long, logs array<float>").toArrow().combine_chunks()
    orders, hashes = got["order"].to_numpy(), got["hash"].to_numpy().view(np.uint64)
    logs = got["logs"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(seen))

    def array(order: int) -> tuple[np.ndarray, np.ndarray]:
        own = np.flatnonzero(orders == order)
        own = own[np.argsort(hashes[own])]
        return hashes[own], logs[own]

    return Models([langs[k] for k in seen], [array(o) for o in range(1, ORDER + 1)], [array(-o) for o in range(1, ORDER)], np.log([share[k] for k in seen]))


def build(counts: dict[str, dict[str, int]]) -> Models:
    """What fitted() gives, from ORDER-gram counts by language in one process."""
    langs = sorted(counts)
    probability: list[dict[str, np.ndarray]] = [{} for _ in range(ORDER)]
    weight: list[dict[str, np.ndarray]] = [{} for _ in range(ORDER)]
    floor = np.zeros(len(langs))
    for k, lang in enumerate(langs):
        by_order = [dict(counts[lang])]
        while len(by_order) < ORDER:
            by_order.insert(0, Counter([g[1:] for g in by_order[0]]))
        # The mark that fills the left of a word is given, not predicted.
        below: dict[str, float] = {}
        for order, own in enumerate(by_order, 1):
            once = sum(1 for n in own.values() if n == 1)
            twice = sum(1 for n in own.values() if n == 2)
            discount = discount_of(once, twice)
            total, kinds = Counter(), Counter()
            for g, n in own.items():
                total[g[:-1]] += n
                kinds[g[:-1]] += 1
            if order == 1:
                alphabet = max(256, 2 * len(own))
                left = discount * kinds[""] / total[""]
                floor[k] = np.log(left / alphabet)
                now = {g: (n - discount) / total[""] + left / alphabet for g, n in own.items()}
            else:
                left = {c: discount * kinds[c] / total[c] for c in total}
                now = {g: (n - discount) / total[g[:-1]] + left[g[:-1]] * below[g[1:]] for g, n in own.items()}
                for c, x in left.items():
                    weight[order - 1].setdefault(c, np.zeros(len(langs)))[k] = np.log(x)
            for g, p in now.items():
                probability[order - 1].setdefault(g, np.full(len(langs), np.nan))[k] = np.log(p)
            below = now
    for order, own in enumerate(probability, 1):
        for g, p in own.items():
            missing = np.isnan(p)
            if missing.any():
                lower = floor if order == 1 else probability[order - 2][g[1:]] + weight[order - 1].get(g[:-1], 0.0)
                own[g] = np.where(missing, lower, p)

    def arrays(table: dict[str, np.ndarray], order: int):
        if not table:
            return np.zeros(0, np.uint64), np.zeros((0, len(langs)), np.float32)
        codes = np.frombuffer("".join(table).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        hashes = _hash_at(codes, np.arange(order - 1, len(codes), order), order)
        values = np.array(list(table.values()), np.float32)
        sort = np.argsort(hashes)
        return hashes[sort], values[sort]
    return Models(
        langs,
        [arrays(t, o) for o, t in enumerate(probability, 1)],
        [arrays(weight[o], o) for o in range(1, ORDER)],
        floor,
    )


class Scorer:
    """Texts against the models, through a bounded cache of words' costs."""

    def __init__(self, models: Models):
        self.models, self.known, self.old = models, {}, {}
        self.costs = self.old_costs = np.zeros((1024, len(models.langs) + 1))

    def _learn(self, words: list[str]) -> None:
        if len(self.known) > _CACHE_WORDS:
            self.old, self.old_costs = self.known, self.costs
            self.known, self.costs = {}, np.zeros_like(self.costs)
        new = list(set(words).difference(self.known))
        first = len(self.known)
        if first + len(new) > len(self.costs):
            self.costs = np.vstack([self.costs[:first], np.zeros((first + 2 * len(new), self.costs.shape[1]))])
        before = [w for w in new if w in self.old]
        if before:
            self.costs[first : first + len(before)] = self.old_costs[[self.old[w] for w in before]]
            new = before + [w for w in new if w not in self.old]
        for at in range(len(before), len(new), 5_000):
            part = new[at : at + 5_000]
            self.costs[first + at : first + at + len(part)] = self.models.costs(part)
        self.known.update(zip(new, range(first, first + len(new)), strict=True))

    def totals(self, texts: list[str]) -> np.ndarray:
        """By text: cost by language and, last, the characters counted."""
        out = np.zeros((len(texts), self.costs.shape[1]))
        flat: list[str] = []
        starts: list[int] = []
        own: list[int] = []

        def add():
            if flat:
                self._learn(flat)
                rows = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
                out[own] += np.add.reduceat(self.costs[rows], starts, axis=0)
            flat.clear(), starts.clear(), own.clear()

        for k, text in enumerate(texts):
            words = words_of(text)
            if max(map(len, words), default=0) >= LONG:
                long = [w for w in words if len(w) >= LONG]
                words = [w for w in words if len(w) < LONG]
                for w in long:
                    parts = marked(w)
                    for at in range(0, len(parts), 1_000):
                        out[k] += self.models.costs_of(parts[at : at + 1_000]).sum(axis=0)
            for at in range(0, len(words), _PART_WORDS):  # a longer text adds up from parts of its own
                if at or len(words) > _PART_WORDS or len(flat) > _PART_WORDS:
                    add()
                starts.append(len(flat))
                own.append(k)
                flat += words[at : at + _PART_WORDS]
        add()
        return out

    def total(self, text: str) -> np.ndarray:
        return self.totals([text])[0]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, float | None, bool]]:
        """By text: (language or und, score, cross-entropy in nats a character, rejected)."""
        told = [k for k, t in enumerate(texts) if t and self.models.langs and _LETTER.search(t)]
        out: list[tuple] = [("und", 0.0, None, True)] * len(texts)
        for k, row in zip(told, self.totals([texts[k] for k in told]) if told else (), strict=True):
            costs, n = row[:-1], row[-1]
            best = int(np.argmin(costs))
            entropy = float(costs[best] / n)
            out[k] = self.models.langs[best], float(softmax(costs, self.models.temper)[best]), entropy, entropy > self.models.reject
        return out


def softmax(costs: np.ndarray, temper: float) -> np.ndarray:
    e = np.exp(-(costs - costs.min()) * temper)
    return e / e.sum()


def _scorer(shared) -> Scorer:
    """One scorer a worker, for the model used last; a worker keeps a broadcast value between tasks."""
    return held(("language",), lambda: Scorer(shared.value), shared.value)


def train(docs: DataFrame, rows: Column) -> Models:
    """Models of the languages of docs' rows for which `rows` holds and lang and text are not null."""
    spark = docs.sparkSession
    known = docs.where(rows & F.col("lang").isNotNull() & F.col("text").isNotNull())
    part = max(10, known.count() // CALIBRATION_ROWS)
    chosen = F.pmod(F.xxhash64("doc_id"), F.lit(part)) == 0
    # A language of which all rows are chosen is counted all the same.
    of = {r["lang"]: r["all"] for r in known.groupBy("lang").agg(F.min(chosen.cast("int")).alias("all")).collect()}
    rare = [lang for lang, every in of.items() if every]
    sampled = chosen & ~F.col("lang").isin(rare) if rare else chosen
    models = fitted(gram_counts(known.where(~sampled)), [*of])
    if not models.langs:
        return models
    shared = spark.sparkContext.broadcast(models)

    def batch(cols):
        scorer = _scorer(shared)
        kept = [(lang, t) for lang, t in zip(cols["lang"], cols["text"], strict=True) if lang in models_of and _LETTER.search(t)]
        yield {"lang": [k[0] for k in kept], "costs": scorer.totals([k[1] for k in kept]).tolist()}

    models_of = set(models.langs)
    seen = map_batches(known.where(sampled).select("lang", "text"), batch, "lang string, costs array<double>").toArrow().to_pydict()
    if seen["lang"]:
        costs = np.array(seen["costs"])
        own = np.array([models.langs.index(x) for x in seen["lang"]])
        entropy = costs[:, :-1] / costs[:, -1:]
        models.reject = float(np.quantile(entropy[np.arange(len(own)), own], REJECT_QUANTILE))

        def loss(temper: float) -> float:
            z = -(costs[:, :-1] - costs[:, :-1].min(axis=1, keepdims=True)) * temper
            return float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(own)), own]))

        models.temper = min(np.geomspace(0.005, 1, 60), key=loss)
    return models


def identify(docs: DataFrame, models: Models) -> DataFrame:
    """Per row: doc_id, lang_pred, score, entropy, rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def batch(cols):
        scorer = _scorer(shared)
        rows = scorer.predict(cols["text"])
        names = ("lang_pred", "score", "entropy", "rejected")
        yield {"doc_id": cols["doc_id"]} | {n: [r[k] for r in rows] for k, n in enumerate(names)}

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), batch, "doc_id long, lang_pred string, score double, entropy double, rejected boolean")


def op5_language(spark, sf_dir: str) -> DataFrame:
    docs = docs_of(spark, sf_dir)
    found = identify(docs, train(docs, ~held_out(F.col("doc_id"))))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "entropy", "rejected")
