"""Near-duplicate groups against all pairs, on small and on awkward documents."""

import random

import numpy as np
import pytest

from lychgate.llm import common, graph, near_dup, shingles
from tests.llm.conftest import TEXTS


def brute(rows):
    """doc_id to smallest id reachable, from all pairs; rows of an id are linked."""
    ids = [i for i, _ in rows]
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in near_dup.iter_brute_links([t for _, t in rows]):
        p, q = root(ids[a]), root(ids[b])
        up[max(p, q)] = min(p, q)
    return {i: root(i) for i in ids}


def near_copies(rng, words, n, most):
    out = []
    for _ in range(n):
        w = list(words)
        for _ in range(rng.randint(0, most)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def check(docs, rows):
    got = near_dup.near_duplicates(docs).collect()
    expected = brute(rows)
    assert {r["doc_id"]: r["component_id"] for r in got} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got) and len(got) == len(rows)
    return {r["doc_id"]: r for r in got}


def test_groups(spark, make):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    texts = [*TEXTS, "One  TWO three", "one two three", "b"]
    for size in (8, 40, 150):
        base = [rng.choice(words) for _ in range(size)]
        texts += near_copies(rng, base, 40, 5)
    texts += ["same text of six words here"] * 30 + [" ".join(rng.choice(words) for _ in range(60)) for _ in range(60)]
    rng.shuffle(texts)
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    got = check(make(rows), rows)
    sizes = {i: len({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := (t or "").encode().lower().split()) else ()) for i, t in rows}
    assert {i: r["n_shingles"] for i, r in got.items()} == sizes


def test_blocks_of_large_families(spark, make, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_SETS", 25)
    rng = random.Random(9)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = list(enumerate(near_copies(rng, base, 160, 6)))
    check(make(rows), rows)


def test_nulls_repeats_and_empty(spark, make):
    got = near_dup.near_duplicates(make([(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (9, None)])).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in got) == [("5", "5", True), ("5", "5", True), ("9", "9", True), ("None", "None", False)]
    assert near_dup.near_duplicates(make([])).count() == 0
    # One id with two texts links what is near to either.
    rows = [(1, "p q r s t u"), (2, "p q r s t u"), (2, "k l m n o p"), (3, "k l m n o p")]
    assert {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(make(rows)).collect()} == {1: 1, 2: 1, 3: 1}


def test_one_of_each(spark, make):
    docs = make([(4, "a b c d e f"), (4, "a b c d e f"), (7, "A b c d e f"), (8, None), (9, ""), (None, "x")])
    kept = near_dup.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["4", "8", "9", "None"]


def test_estimates_follow_similarity():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.85, 0.95):
        errors = []
        for _ in range(40):
            both, a, b = (rng.integers(0, 2**63, int(n), dtype=np.uint64) for n in (2000 * share, 1000 * (1 - share), 1000 * (1 - share)))
            p, q = (near_dup.pack_bits(near_dup.minima(np.concatenate([both, x])))[None] for x in (a, b))
            errors.append(near_dup.estimates(p, q)[0, 0] - share)
        assert abs(np.mean(errors)) < 0.05 and np.max(np.abs(errors)) < near_dup.MARGIN


def test_products_are_exact():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40), dtype=np.uint64)) for _ in range(30)]
    rows, cols = list(range(10)), list(range(5, 30))
    got = near_dup._products(sets, rows, cols)
    assert all(got[i, j] == len(set(sets[r].tolist()) & set(sets[c].tolist())) == shingles.common(sets[r], sets[c]) for i, r in enumerate(rows) for j, c in enumerate(cols))


def test_components(spark):
    path = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 150), (7, 7), (300, 300)]
    df = spark.createDataFrame([*path, (None, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in graph.components(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 100, 150: 100}


def test_bitmap_keeps_all_ids(spark):
    df = spark.range(0, 5000).selectExpr("if(id % 10 = 0, null, id) as k", "id as v")
    ids = spark.range(0, 5000, 7)
    maybe, rest = common.parted(df, ids, "k")
    wanted = {i for i in range(0, 5000, 7) if i % 10}
    inside = {r["k"] for r in maybe.collect()}
    assert wanted <= inside and len(inside) < len(wanted) + 20 and maybe.count() + rest.count() == 5000


@pytest.mark.parametrize("text", ["a\x0bb\x0cc\x1cd", "A\xa0B é"])
def test_words_follow_the_pattern(text):
    import re

    pattern = re.findall(rb"[^\x20\x09-\x0D]+", text.encode())
    assert shingles.words_of(text) == [w.lower() for w in pattern]


def test_near_forest_connects_what_pairs_connect():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, (6, 5), dtype=np.uint64)
    packed = base[rng.integers(0, 6, 300)].copy()
    for row in packed:
        row[rng.integers(0, 5)] ^= rng.integers(0, 2**40, dtype=np.uint64)
    for least in (0.5, 0.8, 0.95):
        near = near_dup.estimates(packed, packed) >= least
        forest, whole = near_dup.Forest(300), near_dup.Forest(300)
        for x, y in near_dup.near_forest(packed, least):
            assert near[x, y]
            forest.join(x, y)
        for x, y in np.argwhere(near):
            whole.join(int(x), int(y))
        assert len(forest.edges) == len(whole.edges) and all(forest.root(x) == forest.root(y) for x, y in np.argwhere(near))
    assert near_dup.near_forest(packed[:0], 0.5) == [] == near_dup.near_forest(packed[:1], 0.5)


def test_common_phrases_make_no_families(spark, make):
    """Documents that share boilerplate, and so bands, but are not near each other are never compared on whole sets."""
    rng = random.Random(12)
    phrase = [f"b{i}" for i in range(60)]
    rows = [(i, " ".join([*phrase, *(f"{i}w{rng.randrange(10**6)}" for _ in range(60))])) for i in range(300)]
    rows += [(1000 + i, t) for i, t in enumerate(near_copies(rng, [f"c{i}" for i in range(90)], 12, 2))]
    docs = make(rows)
    classes = near_dup.signatures(docs).selectExpr("doc_id as node", "bands", "packed")
    met = classes.selectExpr("node", "explode(bands) as band").groupBy("band").count().where("count > 1 and count < 13").count()
    pairs = {(r["a"], r["b"]) for r in near_dup.near_pairs(classes, 85).collect()}
    assert met > 0 and pairs and all(a >= 1000 and b >= 1000 for a, b in pairs)
    check(docs, rows)


def test_many_rows_without_words(spark):
    docs = spark.range(10_000).selectExpr("id as doc_id", "if(id % 3 = 0, null, if(id % 3 = 1, '', ' ')) as text")
    got = near_dup.near_duplicates(docs.union(spark.createDataFrame([(20_000, "a b"), (20_001, "A b")], "doc_id long, text string")))
    rows = {r["doc_id"]: r for r in got.collect()}
    assert len(rows) == 10_002 and rows[20_001]["component_id"] == 20_000
    assert all(rows[i]["component_id"] == i and rows[i]["kept"] and rows[i]["n_shingles"] == 0 for i in range(10_000))
