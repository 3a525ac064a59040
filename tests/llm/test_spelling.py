import random
import re
from collections import Counter
from zlib import crc32

import duckdb
import pytest

from lychgate.llm import queries, spelling
from tests.test_oracle import rows


def plain_counts(docs, damage=0, least=5, count=3):
    out = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if doc is None else doc}:{w}".encode())
            if damage and h % damage == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            out[w] += 1
    return {w: n for w, n in out.items() if len(w) >= least and n >= count}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def plain_variants(counts):
    """word: (form, root, n, n_near, form_n) by comparing all words with all."""
    near = {w: [x for x in counts if abs(len(x) - len(w)) < 2 and distance(w, x) == 1] for w in counts}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {w: (form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()}


def table(spark, counts):
    return spark.createDataFrame([(w, n, "k", 1, "r") for w, n in counts.items()], "word string, n long, key string, part int, root string")


def got(df):
    found = df.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in found}
    assert len(out) == len(found)
    return out


def made(n, seed, letters, longest=9):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(5, longest))) for _ in range(n)}
    for w in sorted(words)[: n // 2]:
        i = rng.randrange(len(w))
        words.add(rng.choice([w[:i] + w[i + 1 :] + "x" * (len(w) == 5), w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :]]))
    return {w: rng.choice([3, 3, 4, 6, 7, 12, 14, 30, 100]) for w in words}


@pytest.mark.parametrize(("n", "letters", "indexed"), [(400, "ab", 20_000), (400, "ab", 5), (600, "thenaoé", 30), (200, "À×ÿz", 20_000)])
def test_against_all_pairs(spark, n, letters, indexed):
    counts = made(n, n, letters)
    assert got(spelling.variants(table(spark, counts), indexed=indexed)) == plain_variants(counts)


def test_each_pair_once_in_split_blocks(spark):
    counts = dict.fromkeys((f"aaaa{a}{b}{c}{d}" for a in "abc" for b in "abc" for c in "abc" for d in "abc"), 3) | {"aaaa" + "b" * k: 9 for k in range(1, 6)}
    pairs = [(r["word"], r["near"]) for r in spelling.near_words(table(spark, counts), indexed=10).collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == {(a, b) for a in counts for b in counts if abs(len(a) - len(b)) < 2 and distance(a, b) == 1}
    parts = spelling.blocks(table(spark, counts), indexed=10).where("own").groupBy("key", "part").count()
    assert parts.where("count > 40").count() == 0 and parts.where("part > 2").count() > 0


def test_query_against_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert rows(queries.queries()["op13_spelling"](spark, sf).toPandas()) == rows(con.execute(queries.OP13_SQL).df())


def test_counts_of_whole_texts(spark, make):
    docs = [(1, None), (2, ""), (3, "Hello hello HELLO"), (4, "ÉCOLE École école ÷×÷×÷"), (4, "÷×÷×÷ ÷×÷×÷ x" + "y" * 70_000), (None, "x" + "y" * 70_000 + " hello"), (5, "x" + "y" * 70_000 + "1" + "tests-tests_tests"), *((i, "wordy " * i) for i in range(6, 300))]
    for damage in (0, 3, 97):
        found = spelling.word_counts(make(docs), damage=damage).collect()
        assert {r["word"]: r["n"] for r in found} == plain_counts(docs, damage) and len(found) == len({r["word"] for r in found})


def test_long_chains_and_empty_tables(spark):
    chain = {"abcde" + "f" * k: 3 * 2**k for k in range(30)}
    answer = got(spelling.variants(table(spark, chain)))
    assert {v[1] for v in answer.values()} == {"abcde" + "f" * 29} and answer["abcde"][0] == "abcdef"
    assert got(spelling.variants(table(spark, {}))) == {} and got(spelling.variants(table(spark, {"alone": 3}))) == {"alone": (None, "alone", 3, 0, None)}
    with pytest.raises(ValueError):
        spelling.near_words(table(spark, chain), 3)


def test_one_edit():
    words = ["", "a", "b", "ab", "ba", "aab", "aba", "abab", "abba", "aabba"]
    assert all(spelling.one_edit(a, b) == (distance(a, b) == 1) for a in words for b in words)
