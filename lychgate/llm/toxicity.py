"""Toxicity: a lexicon trie walked together with a Levenshtein automaton, and the hits' contexts.

Lexicon. From a bounded sample of labelled rows: words, and beginnings of words, that stand in at least
SUPPORT toxic texts, whatever the size of the sample, and in nearly no other (PRECISION), so unevenly that chance does
not explain it (EVIDENCE). Words may hold digits, hyphens and other marks inside; scripts that do not part
words by spaces are read as pairs of neighbouring characters. The words that a beginning begins stay terms, from which
misspelt ones are told. All such terms are kept; the bound of the sample bounds them.

Match. A word, in lower case without marks at its ends, is a hit if it is a term, if a beginning
begins it, or if it is within EDITS edits of a term of FUZZY letters or more: the automaton's states, a place in the
word and the number of edits so far, are carried down the trie, and a branch ends where no step is left to a state or
the letter that must follow is missing. Digits and signs that stand for letters are read as these. Results are cached by
word in two generations of bounded bytes.

Context. A hit is quoted if a quotation mark opens in the WINDOW words before it and one closes in
those after it, or if a word of reporting stands in that window. A logistic model over counts of direct and
quoted hits of each kind, distinct terms and density, fitted on the same sample, gives the score.

Defined results: null and empty texts have no hits and get the score of that; without training rows,
or with one label only, the score is that share of ones (0.5 without any); a text of any length counts
whole; equal texts get equal scores; rows are scored one by one, so a repeated doc_id gives a row each; of several terms
within the edits of a word the one that the walk meets first is named, which is the same in every run; an empty table
gives an empty one; extra columns are not read.
"""

from __future__ import annotations

import string
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lychgate.llm.common import CACHE_BYTES, TwoGenerations, docs_of, filter_texts, held, map_batches, small_batches, to_arrow
from lychgate.llm.labelled import TRAIN_ROWS, held_out, training_rows

SUPPORT, PRECISION, FUZZY, EDITS = 5, 0.9, 5, 1
STEM = (4, 5, 6)
WINDOW = 8
#: The least log likelihood ratio of a term's toxic share against that of all texts; SUPPORT toxic texts and no other always do.
EVIDENCE = 7.0
THRESHOLD = 0.5
#: Words of reporting in the languages of the corpus.
REPORTING = frozenset("said says called calls word words term quote quoted wrote dit mot sagte wort dijo palabra".split())
_MARKS = string.punctuation + "«»“”„‘’…¡¿"
_QUOTES = frozenset("\"'«»“”„‘’")
_LEET = str.maketrans("013457@$!", "oieastasi")
_FLUSH = 100_000
_LETTER = regex.compile(r"\p{L}")
#: Scripts that do not part words by spaces.
_UNPARTED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]+")
EXACT, BEGUN, NEAR = 1, 2, 3


def plain(word: str) -> str:
    return word.strip(_MARKS)


def words_of(text: str | None) -> list[str]:
    """Words in lower case; a run of an unparted script as its pairs of neighbouring characters."""
    words = (text or "").lower().split()
    if text and not text.isascii() and _UNPARTED.search(text):
        words = [x for w in words for x in _pairs(w)]
    return words


def _pairs(word: str) -> list[str]:
    out, at = [], 0
    for m in _UNPARTED.finditer(word):
        out += [word[at : m.start()]] if at < m.start() else []
        out += [word[i : i + 2] for i in range(m.start(), max(m.start() + 1, m.end() - 1))]
        at = m.end()
    return [*out, word[at:]] if at < len(word) else out


class Lexicon:
    """Terms and beginnings in a trie; find(word) gives (kind, term) or None."""

    def __init__(self, words: list[str], stems: list[str], edits: int = EDITS):
        self.words, self.stems, self.edits = sorted(words), sorted(stems), edits
        self.root: dict = {}
        for kind, terms in ((EXACT, self.words), (BEGUN, self.stems)):
            for t in terms:
                node = self.root
                for c in t:
                    node = node.setdefault(c, {})
                node[kind] = t
        self.lengths = {len(t) for t in self.words if len(t) >= FUZZY}

    def find(self, word: str) -> tuple[int, str] | None:
        node = self.root
        for c in word:
            node = node.get(c)
            if node is None:
                break
            if BEGUN in node:
                return BEGUN, node[BEGUN]
        else:
            if EXACT in node:
                return EXACT, node[EXACT]
        if self.edits and not self.lengths.isdisjoint(range(len(word) - self.edits, len(word) + self.edits + 1)) and (near := self.near(word)):
            return NEAR, near
        return None

    def near(self, word: str) -> str | None:
        """The first term of FUZZY letters or more within the edits of word."""
        n, edits = len(word), self.edits
        stack = [(self.root, 0, 0)]
        while stack:
            node, i, e = stack.pop()
            if e == edits:  # the rest has to match letter for letter
                while i < n and (node := node.get(word[i])) is not None:
                    i += 1
                if node is not None and (t := node.get(EXACT)) and len(t) >= FUZZY:
                    return t
                continue
            if n - i <= edits - e and (t := node.get(EXACT)) and len(t) >= FUZZY:
                return t
            letter, after = word[i : i + 1], word[i + 1 : i + 2]
            for c, child in node.items():
                if c.__class__ is int:
                    continue
                if c == letter:
                    stack.append((child, i + 1, e))
                elif letter and (e + 1 < edits or not after or after in child):
                    stack.append((child, i + 1, e + 1))  # another letter stands for it
                if e + 1 < edits or not letter or letter in child:
                    stack.append((child, i, e + 1))  # it was left out
            if letter:
                stack.append((node, i + 1, e + 1))  # the word has one more
        return None


@dataclass
class Model:
    words: list[str]
    stems: list[str]
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1))
    edits: int = EDITS

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.hstack([np.ones((len(x), 1)), x]) @ self.weights if len(self.weights) > 1 else np.full(len(x), self.weights[0])
        return 1 / (1 + np.exp(-z))


class Matcher:
    def __init__(self, model: Model):
        self.model, self.lexicon = model, Lexicon(model.words, model.stems, model.edits)
        self.known = TwoGenerations(self._find, CACHE_BYTES)

    def _find(self, word: str) -> tuple[int, str]:
        w = plain(word)
        found = self.lexicon.find(w) if w else None
        if found is None and not w.isalpha() and (read := plain(word.translate(_LEET))) != w:
            found = self.lexicon.find(read)
            if found and found[0] == EXACT:
                found = NEAR, found[1]
        return found or (0, "")

    def hits(self, words: list[str]) -> list[tuple[int, int, str, bool]]:
        """(place, kind, term, quoted) of the hits among lower-case words."""
        out = []
        for i, (kind, term) in enumerate(map(self.known.__getitem__, words)):
            if kind:
                before, after = words[max(0, i - WINDOW) : i], words[i + 1 : i + 1 + WINDOW]
                own = words[i]
                opens = own[0] in _QUOTES or any(w[0] in _QUOTES for w in before)
                closes = own.rstrip(".,;:!?")[-1:] in _QUOTES or any(w.rstrip(".,;:!?")[-1:] in _QUOTES for w in after)
                told = any(plain(w) in REPORTING for w in before + after)
                out.append((i, kind, term, opens and closes or told))
        return out

    def features(self, text: str | None) -> list[float]:
        words = words_of(text)
        hits = self.hits(words)
        if not hits:
            return [0.0] * 8
        n = Counter((kind, quoted) for _, kind, _, quoted in hits)
        counts = [float(np.log1p(n[kind, quoted])) for kind in (EXACT, BEGUN, NEAR) for quoted in (False, True)]
        return [*counts, float(np.log1p(len({h[2] for h in hits}))), float(np.log1p(100 * len(hits) / len(words)))]


def term_counts(rows: DataFrame) -> DataFrame:
    """(term, stem, toxic, other): in how many texts of each label a word or a beginning stands."""
    schema = "term string, stem boolean, toxic long, other long"
    kinds = to_arrow(StructType.fromDDL(schema))

    def flush(counts):
        keys = list({*counts[0], *counts[1]})
        cols = [[k[0] for k in keys], [k[1] for k in keys], [counts[1][k] for k in keys], [counts[0][k] for k in keys]]
        for c in counts:
            c.clear()
        return pa.RecordBatch.from_pydict(dict(zip(kinds.names, cols)), schema=kinds)

    def run(batches):
        counts = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist(), strict=True):
                words = {w for x in set(words_of(text)) if (len(w := plain(x)) > 2 or _UNPARTED.match(w)) and _LETTER.search(w)}
                counts[label].update((w, False) for w in words)
                counts[label].update({(w[:n], True) for w in words if w.isalpha() for n in STEM if len(w) > n})
                if len(counts[0]) + len(counts[1]) > _FLUSH:
                    yield flush(counts)
        yield flush(counts)

    return small_batches(rows).mapInArrow(run, schema).groupBy("term", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def _evidence(share: float) -> Column:
    """Log likelihood ratio of the toxic and other counts against share; more texts in the same proportion have more."""
    n = F.col("toxic") + F.col("other")
    part = lambda k, p: F.when(k > 0, k * F.log(k / (n * p))).otherwise(0.0)
    return part(F.col("toxic"), share) + part(F.col("other"), 1 - share)


def choose(table: DataFrame, share: float) -> tuple[list[str], list[str]]:
    """Words and beginnings for the lexicon; share: of the texts that are toxic."""
    # In as many texts as if both labels were equally frequent.
    other = F.col("other") * (share / (1 - share))
    good = table.where((F.col("toxic") >= SUPPORT) & (_evidence(share) >= min(EVIDENCE, -SUPPORT * np.log(share)) - 1e-9) & (F.col("toxic") / (F.col("toxic") + other) >= PRECISION))
    rows = good.orderBy(F.desc("toxic"), "term", "stem").collect()
    words = {r["term"]: r["toxic"] for r in rows if not r["stem"]}
    stems: dict[str, int] = {}
    for r in sorted((r for r in rows if r["stem"]), key=lambda r: (len(r["term"]), r["term"])):
        term, n = r["term"], r["toxic"]
        # A beginning stands for many words; one that a single word makes up is that word's.
        alone = max((k for w, k in words.items() if w.startswith(term)), default=0)
        if n >= 2 * SUPPORT and n > 1.5 * alone and not any(term.startswith(s) for s in stems):
            stems[term] = n
    return list(words), list(stems)


def logistic(x: np.ndarray, y: np.ndarray, damp: float = 1.0) -> np.ndarray:
    """Weights, the constant first, by Newton steps with a ridge on all but the constant."""
    a = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(a.shape[1])
    ridge = np.diag([1e-6, *[damp] * x.shape[1]])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge, a.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _matcher(model: Model) -> Matcher:
    """One matcher a worker, for the model used last."""
    return held(("toxicity",), lambda: Matcher(model), model)


def train(spark, docs: DataFrame, sf_dir: str, rows: int = TRAIN_ROWS, edits: int = EDITS) -> Model:
    sample = training_rows(spark, docs, sf_dir, "toxic", rows)
    n, toxic = sample.agg(F.count("*"), F.sum("label")).first()
    if not n or toxic in (0, n):
        share = min(1 - 1e-6, max(1e-6, toxic / n)) if n else 0.5
        return Model([], [], np.array([np.log(share / (1 - share))]))
    model = Model(*choose(term_counts(sample), toxic / n), edits=edits)
    shared = spark.sparkContext.broadcast(model)

    def batch(cols):
        m = _matcher(shared.value)
        yield {"x": [m.features(t) for t in cols["text"]], "label": cols["label"]}

    got = map_batches(sample, batch, "x array<double>, label int").toArrow()
    x, y = np.array(got["x"].to_pylist()), got["label"].to_numpy().astype(float)
    order = np.lexsort((*x.T, y))
    model.weights = logistic(x[order], y[order])
    return model


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, score, predicted, hits (direct and quoted)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def batch(cols):
        m = _matcher(shared.value)
        p = shared.value.scores(np.array([m.features(t) for t in cols["text"]]).reshape(-1, 8))
        yield {"doc_id": cols["doc_id"], "score": p.tolist(), "predicted": (p >= threshold).astype(int).tolist()}

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), batch, "doc_id long, score double, predicted int")


def accept(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """docs, whole rows, below the threshold's score."""

    def clean(model, texts):
        m = _matcher(model)
        return model.scores(np.array([m.features(t) for t in texts]).reshape(-1, 8)) < threshold

    return filter_texts(docs, clean, model)


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = docs_of(spark, sf_dir)
    return score(docs, train(spark, docs, sf_dir)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
