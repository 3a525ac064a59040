"""Repeated passages against a table of all 50-word runs."""

import random

import numpy as np
from pyspark.sql import functions as F

from lychgate.llm import near_dup, passages, shingles
from tests.llm.conftest import TEXTS


def brute(rows, least=passages.MIN_WORDS):
    """Word places of each document inside a run that a document of smaller id has."""
    words = {i: (t or "").encode().lower().split() for i, t in rows}
    first, out = {}, {}
    for i in sorted(words):
        w = words[i]
        for k in range(len(w) - least + 1):
            run = tuple(w[k : k + least])
            if first.setdefault(run, i) != i:
                out.setdefault(i, set()).update(range(k, k + least))
    return out


def test_compact_windows_are_maximal():
    rng = np.random.default_rng(4)
    for n in (45, 46, 47, 200, 700):
        s = rng.integers(0, 2**63, n, dtype=np.uint64)
        order = (shingles.mix(s ^ passages._SEED[1]) & ~passages._LOW) | np.arange(n, dtype=np.uint64)
        expected = []
        for c in range(n):
            left, right = c, c
            while left > 0 and order[left - 1] > order[c]:
                left -= 1
            while right < n - 1 and order[right + 1] > order[c]:
                right += 1
            if right - left + 1 >= passages.SPAN:
                expected.append((left, c, right))
        assert list(zip(*(x.tolist() for x in passages.compact_windows(s, 1)))) == expected


def test_repeats(spark, make):
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(3000)}"
    shared = [[word() for _ in range(n)] for n in (50, 55, 80, 300)]
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    for i in range(20, 120):
        own = [word() for _ in range(rng.randint(0, 400))]
        if rng.random() < 0.5:
            at = rng.randint(0, len(own))
            own[at:at] = rng.choice(shared)
        rows.append((i, " ".join(own)))
    rows += [(200, rows[60][1]), (201, rows[60][1]), (202, " ".join(shared[0] * 3))]
    got = {}
    for r in passages.merged(passages.repeats(make(rows))).collect():
        assert r["source"] < r["doc_id"]
        got.setdefault(r["doc_id"], set()).update(range(r["start"], r["end"]))
    expected = brute(rows)
    assert set(got) == set(expected)
    assert all(expected[i] <= got[i] and len(got[i] - expected[i]) < 20 for i in got)


def test_near_passage(spark, make):
    rng = random.Random(2)
    p = [f"p{rng.randrange(10**6)}" for _ in range(120)]
    q = [*p[:40], "changed", *p[41:100], "again", *p[101:]]
    pad = lambda k: [f"{k}{j}" for j in range(90)]
    rows = [(1, " ".join([*pad("a"), *p, *pad("b")])), (2, " ".join([*pad("c"), *q, *pad("d")])), (3, " ".join(pad("e")))]
    (r,) = passages.merged(passages.repeats(make(rows))).collect()
    assert (r["doc_id"], r["source"]) == (2, 1) and r["start"] == 90 and r["end"] == 210


def test_cutting(spark, make):
    p = " ".join(f"p{i}" for i in range(60))
    docs = make([(1, f"keep  this {p}\nend"), (2, f"other\t words {p} more"), (3, p), (4, None), (5, "short"), (None, p)])
    kept = {r["doc_id"]: r for r in passages.without_repeats(docs).collect()}
    assert passages.without_repeats(docs).columns == docs.columns
    assert kept[1]["text"] == f"keep  this {p}\nend" and kept[2]["text"] == "other\t words more" and kept[2]["n_chars"] == len("other\t words more")
    assert 3 not in kept and kept[4]["text"] is None and kept[5]["text"] == "short" and kept[None]["text"] == p
    assert passages.without_repeats(make([])).count() == 0
    assert passages.cut_words("a b", [(0, 2)]) == "" and passages.cut_words(" a  b c", [(1, 2)]) == " a  c"


def test_columns_named_like_helpers(spark, make):
    p = " ".join(f"p{i}" for i in range(60))
    docs = make([(1, f"keep {p}"), (2, f"other {p} more"), (2, f"other {p} more")])
    for name in ("__id", "__spans", "__Place", "__place_", "kept"):
        docs = docs.withColumn(name, F.lit(f"own {name}"))
    for stage in (passages.without_repeats, near_dup.one_of_each):
        out = stage(docs)
        assert out.columns == docs.columns and all(r[c] == f"own {c}" for r in out.collect() for c in ("__id", "__spans", "__Place", "__place_", "kept"))


def test_common_centres_between_other_documents(spark, make):
    """Two documents share a passage whose centres are also centres of unrelated documents of smaller and larger ids."""
    p = [f"p{j}" for j in range(50)]
    s = shingles.shingle_hashes(shingles.word_hashes([w.encode() for w in p]))
    centres = {int(np.argmin((shingles.mix(s ^ passages._SEED[f]) & ~passages._LOW) | np.arange(len(s), dtype=np.uint64))) for f in range(passages.HASHES)}
    rows = [(i, " ".join([*(f"{i}a{j}" for j in range(70)), *p, *(f"{i}b{j}" for j in range(70))])) for i in (50, 51, 52)]
    for n, c in enumerate(sorted(centres)):
        for base in (-10_000, 10_000):
            for i in range(base + n * 100, base + n * 100 + 60):  # of many surroundings some have their centre there
                rows.append((i, " ".join([*(f"{i}c{j}" for j in range(45)), *p[c : c + 5], *(f"{i}d{j}" for j in range(45))])))
    got = {r["doc_id"]: r for r in passages.merged(passages.repeats(make(rows))).collect()}
    assert set(got) == {51, 52} and all((r["start"], r["end"], r["source"]) == (70, 120, 50) for r in got.values())


def test_hashes_of_stretches():
    s = np.random.default_rng(1).integers(0, 2**63, 300, dtype=np.uint64)
    t = np.concatenate([s[100:], s[:150]])
    start = np.arange(50)
    a, b = passages.Stretches(s).hashes(start + 120, start + 166), passages.Stretches(t).hashes(start + 20, start + 66)
    assert a.tolist() == b.tolist() and len(set(a.tolist())) == 50


def test_evidence_of_both_directions(spark):
    """Functions that name either document as the representative count together."""
    w, v = 100 << 32 | 40 << 16 | 40, 300 << 32 | 40 << 16 | 40
    met = spark.createDataFrame([(7, 5, 0, w, v), (5, 7, 1, v, w)], "doc_id long, rep long, function int, window long, rep_window long")
    (r,) = passages.candidates(met).collect()
    assert {r["doc_id"], r["rep"]} == {5, 7}


def near_pairs(pairs, pieces, size, seed):
    """Pairs of documents whose passages of 50 words differ in one word, not at an end, and pieces of the passages in documents of smaller and larger ids."""
    rng, rows = random.Random(seed), []
    own = lambda tag, n: [f"{tag}x{j}" for j in range(n)]
    for k in range(pairs):
        p = [f"p{k}w{j}" for j in range(50)]
        q = list(p)
        q[rng.randrange(6, 44)] = f"changed{k}"
        for i, words in ((100_000 + 2 * k, p), (100_001 + 2 * k, q)):
            rows.append((i, " ".join([*own(f"{i}a", 60), *words, *own(f"{i}b", 60)])))
        for n in range(pieces):
            at = rng.randint(0, 50 - size) if n else (50 - size) // 2
            for i in (k * pieces + n, 200_000 + k * pieces + n):
                rows.append((i, " ".join([*own(f"{i}c", 60), *p[at : at + size], *own(f"{i}d", 60)])))
    return rows


def test_near_passages_between_other_documents(spark, make):
    """Pieces of 14 words of a passage stand in documents of smaller and larger ids, all over it."""
    found = {}
    for pieces, size in ((0, 14), (6, 14), (12, 20)):
        rows = near_pairs(150, pieces, size, pieces)
        spans = passages.merged(passages.repeats(make(rows))).collect()
        found[pieces] = sum(r["doc_id"] >= 100_000 and r["doc_id"] % 2 == 1 and r["source"] == r["doc_id"] - 1 for r in spans)
        assert all(100_000 <= r["doc_id"] < 200_000 for r in spans)
    assert found[0] >= 145 and found[6] >= 0.95 * 150 and found[12] >= 0.6 * 150, found


def test_no_document_at_a_class_hides_another(spark, make):
    """Two passages differ in a word; documents of smaller and larger ids have 30 words of them with other words beside."""
    rng, p = random.Random(6), [f"p{j}" for j in range(50)]
    q = [*p[:44], "changed", *p[45:]]
    own = lambda tag, n: [f"{tag}x{j}" for j in range(n)]
    rows = [(i, " ".join([*own(f"{i}a", 60), *words, *own(f"{i}b", 60)])) for i, words in ((500, p), (501, q))]
    for i in [*range(40), *range(900, 940)]:
        at = rng.randint(0, 20)
        rows.append((i, " ".join([*own(f"{i}c", 60), *p[at : at + 30], *own(f"{i}d", 60)])))
    (r,) = passages.merged(passages.repeats(make(rows))).collect()
    assert (r["doc_id"], r["source"]) == (501, 500)


def test_rows_of_a_group_grow_with_it(spark, make):
    """Near copies of one text with a word changed at two places of each: rows that meet grow as the copies do, and every copy is told."""
    rng, met = random.Random(3), []
    text = [f"p{j}" for j in range(160)]
    for n in (150, 1200):
        rows = []
        for i in range(n):
            words = list(text)
            for at in (rng.randrange(10, 80), rng.randrange(80, 150)):
                words[at] = f"changed{i}x{at}"
            rows.append((i, " ".join(words)))
        docs = make(rows)
        met.append(passages.collisions(docs, passages.windows_of(docs)).count())
        told = {r["doc_id"] for r in passages.merged(passages.repeats(docs)).collect()} if n == 150 else set(range(1, 150))
        assert told == set(range(1, 150))
    assert met[1] < 1.5 * 8 * met[0], met


def test_similar_by_parts(spark, make):
    """A word of every 30 is changed: as a whole the texts are not similar by PERCENT, each two runs of equal words are."""
    p = [f"p{j}" for j in range(400)]
    q = [f"q{j}" if j % 30 == 10 else w for j, w in enumerate(p)]
    (r,) = passages.merged(passages.repeats(make([(1, " ".join(p)), (2, " ".join(q))]))).collect()
    assert (r["doc_id"], r["source"], r["start"], r["end"]) == (2, 1, 11, 400)
    x, y = (np.unique(w, return_inverse=True)[1][k * 400 :][:400].astype(np.uint32) for k, w in ((0, p + q), (1, p + q)))
    assert passages.proven(x, y, [0])
