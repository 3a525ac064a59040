"""Quality by a generalised additive model with pairwise interactions.

Every text gives FEATURES numbers from whole-text counts. The model is a sum of lookup tables, one a
feature over its quantile bins and one for each of the PAIRS strongest pairs over coarser bins. They are
learned by cyclic boosting: round after round each feature in turn gets a tree of at most LEAVES leaves
on its bins, fitted to the gradient and shrunk; pairs follow on what the single features leave,
with trees that split each of the two once. Scoring looks bins up and adds, for a batch at once.

Fitted on a sample of TRAIN_ROWS labelled rows at most (labelled.py), by its features, which alone reach
the driver.

Defined results: null and empty texts have features of 0 and get the score of these; without
training rows, or with one label only, every score is that share of ones (0.5 without any); a text of any length is
counted whole; rows are scored one by one, so a repeated doc_id gives a row each, and equal texts get equal scores; an
empty table gives an empty one; extra columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lychgate.llm.common import docs_of, filter_texts, map_batches
from lychgate.llm.labelled import TRAIN_ROWS, held_out, training_rows

FEATURES = (
    "log_words", "upper", "symbols", "marks", "bars", "digits", "lines", "mean_word", "distinct", "repeats", "same_lines",
    "beyond_ascii", "sentence_marks",
)
BINS, PAIR_BINS, LEAVES, PAIRS = 48, 10, 3, 8
ROUNDS, RATE, DAMP = 120, 0.12, 1.0
THRESHOLD = 0.3


def _bytes(chars: bytes) -> np.ndarray:
    out = np.zeros(256)
    out[list(chars)] = 1
    return out


_CLASSES = np.stack([
    _bytes(bytes(range(65, 91))), _bytes(bytes(range(97, 123))), _bytes(b"#$%&*+/<=>@\\^_`~{}[]"), _bytes(b"!?"), _bytes(b"|"),
    _bytes(b"0123456789"), _bytes(b"\n"), _bytes(bytes(range(128, 256))), _bytes(b".,;:"),
])


def features_of(text: str | None) -> list[float]:
    """FEATURES of a whole text."""
    data = (text or "").encode()
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    upper, lower, symbols, marks, bars, digits, lines, beyond, stops = _CLASSES @ np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size = len(data)
    rows = data.split(b"\n")
    return [
        float(np.log1p(n)), upper / max(1.0, upper + lower), symbols / size, marks / size, bars / size, digits / size, lines / size,
        (size - n + 1) / n, len(set(words)) / n, sum(map(eq, words, words[1:])) / n, 1 - len(set(rows)) / len(rows), beyond / size,
        stops / size,
    ]


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + DAMP)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Values by bin of a tree on one feature's bins, from gradient and curvature sums."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = (1e-9, None)
        for k, (a, b) in enumerate(parts):
            if b - a > 1:
                lg, lh = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
                tg, th = g[a:b].sum(), h[a:b].sum()
                gain = _gain(lg, lh) + _gain(tg - lg, th - lh) - _gain(tg, th)
                at = int(np.argmax(gain))
                if gain[at] > best[0]:
                    best = (gain[at], (k, a + at + 1))
        if best[1] is None:
            break
        k, cut = best[1]
        a, b = parts[k]
        parts[k : k + 1] = [(a, cut), (cut, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + DAMP)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Values of a tree that splits two features once each, over a grid of bins, and its gain."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    n, m = g.shape
    tg, th = cg[-1, -1], ch[-1, -1]
    a, b = cg[:-1, :-1], ch[:-1, :-1]
    quarters = [(a, b), (cg[:-1, -1:] - a, ch[:-1, -1:] - b), (cg[-1:, :-1] - a, ch[-1:, :-1] - b)]
    quarters.append((tg - a - quarters[1][0] - quarters[2][0], th - b - quarters[1][1] - quarters[2][1]))
    gain = sum(_gain(x, y) for x, y in quarters) - _gain(tg, th)
    i, j = np.unravel_index(int(np.argmax(gain)), gain.shape)
    out = np.zeros((n, m))
    for k, (rows, cols) in enumerate([(slice(0, i + 1), slice(0, j + 1)), (slice(0, i + 1), slice(j + 1, m)), (slice(i + 1, n), slice(0, j + 1)), (slice(i + 1, n), slice(j + 1, m))]):
        out[rows, cols] = quarters[k][0][i, j] / (quarters[k][1][i, j] + DAMP)
    return out, float(gain[i, j])


@dataclass
class Additive:
    base: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for f, (cuts, table) in enumerate(zip(self.cuts, self.tables)):
            out += table[np.searchsorted(cuts, x[:, f], side="right")]
        for i, j, table in self.pairs:
            out += table[np.searchsorted(self.coarse[i], x[:, i], side="right"), np.searchsorted(self.coarse[j], x[:, j], side="right")]
        return 1 / (1 + np.exp(-out))


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.arange(1, bins) / bins))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS) -> Additive:
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        share = min(1 - 1e-6, max(1e-6, share))
        return Additive(float(np.log(share / (1 - share))))
    share = y.mean()
    model = Additive(float(np.log(share / (1 - share))))
    d = x.shape[1]
    model.cuts = [_cuts(x[:, f], BINS) for f in range(d)]
    model.coarse = [_cuts(x[:, f], PAIR_BINS) for f in range(d)]
    bins = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(model.cuts)]
    wide = [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(model.coarse)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    total = np.full(len(y), model.base)

    def gradient():
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for f in range(d):
            g, h = gradient()
            step = RATE * _tree(np.bincount(bins[f], g, len(model.tables[f])), np.bincount(bins[f], h, len(model.tables[f])), LEAVES)
            model.tables[f] += step
            total += step[bins[f]]

    def grid(i: int, j: int, values: np.ndarray) -> np.ndarray:
        n, m = len(model.coarse[i]) + 1, len(model.coarse[j]) + 1
        return np.bincount(wide[i] * m + wide[j], values, n * m).reshape(n, m)

    g, h = gradient()
    usable = [f for f in range(d) if len(model.coarse[f])]
    gains = [(_pair_tree(grid(i, j, g), grid(i, j, h))[1], i, j) for i in usable for j in usable if i < j]
    chosen = [(i, j) for _, i, j in sorted(gains, reverse=True)[:PAIRS]]
    tables = {p: np.zeros((len(model.coarse[p[0]]) + 1, len(model.coarse[p[1]]) + 1)) for p in chosen}
    for _ in range(rounds // 4):
        for i, j in chosen:
            g, h = gradient()
            step = RATE * _pair_tree(grid(i, j, g), grid(i, j, h))[0]
            tables[i, j] += step
            total += step[wide[i], wide[j]]
    model.pairs = [(i, j, t) for (i, j), t in tables.items()]
    return model


def train(spark, docs: DataFrame, sf_dir: str, rows: int = TRAIN_ROWS) -> Additive:
    def batch(cols):
        yield {"x": [features_of(t) for t in cols["text"]], "label": cols["label"]}

    got = map_batches(training_rows(spark, docs, sf_dir, "quality", rows), batch, "x array<double>, label int").toArrow()
    x = np.array(got["x"].to_pylist()).reshape(-1, len(FEATURES))
    y = got["label"].to_numpy().astype(float)
    order = np.lexsort((*x.T, y))  # the same sums whatever order the rows came in
    return fit(x[order], y[order])


def score(docs: DataFrame, model: Additive, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def batch(cols):
        p = shared.value.scores(np.array([features_of(t) for t in cols["text"]]).reshape(-1, len(FEATURES)))
        yield {"doc_id": cols["doc_id"], "score": p.tolist(), "predicted": (p >= threshold).astype(int).tolist()}

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), batch, "doc_id long, score double, predicted int")


def accept(docs: DataFrame, model: Additive, threshold: float = THRESHOLD) -> DataFrame:
    """docs, whole rows, of at least the threshold's score."""
    return filter_texts(docs, lambda shared, texts: shared.scores(np.array([features_of(t) for t in texts]).reshape(-1, len(FEATURES))) >= threshold, model)


def op7_quality(spark, sf_dir: str) -> DataFrame:
    docs = docs_of(spark, sf_dir)
    return score(docs, train(spark, docs, sf_dir)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
