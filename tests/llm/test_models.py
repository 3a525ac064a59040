"""Language, quality, toxicity and nearest neighbours: parts against plain versions, held-out accuracy, edge cases."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lychgate.llm import ann, labelled, language, quality, toxicity
from tests.llm.conftest import TEXTS

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labels_dir(spark, tmp_path_factory):
    """A labels table for the documents of a test."""

    def write(rows):
        d = str(tmp_path_factory.mktemp("labels"))
        spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
        return d

    return write


def test_language_probabilities_sum_to_one():
    counts = {"x": {}}
    for w in ("abab", "abba", "b"):
        p = language.MARK * 4 + w + language.MARK
        for i in range(len(p) - 4):
            counts["x"][p[i : i + 5]] = counts["x"].get(p[i : i + 5], 0) + 1
    m = language.build(counts)
    for prefix in ("", "a", "ab", "abb"):
        total = 0.0
        for c in ("a", "b", language.MARK):
            whole = m.costs([prefix + c] if c != language.MARK else [prefix])
            if c != language.MARK:
                # Cost of the word less that of ending it after its last character.
                ended = m.costs([prefix + c])[0, 0]
                total += np.exp(-(ended - _end(m, prefix + c) - _before(m, prefix)))
            else:
                total += np.exp(-(whole[0, 0] - _before(m, prefix)))
        assert 0.9 < total < 1.0001


def _end(m, word):
    """Cost of the closing mark after a word."""
    return m.costs([word])[0, 0] - _before(m, word)


def _before(m, word):
    """Cost of a word's characters without its closing mark, by order of characters."""
    cost, text = 0.0, language.MARK * 4 + word
    for i in range(4, len(text)):
        cost -= _logp(m, text[i - 4 : i + 1])
    return cost


def _logp(m, gram):
    """Log probability of a gram's last character, read from the arrays one by one."""
    def find(table, g):
        keys, values = table
        codes = np.frombuffer(g.encode("utf-32-le"), np.uint32).astype(np.uint64)
        h = language._hash_at(codes, np.array([len(g) - 1]), len(g))[0]
        at = np.searchsorted(keys, h)
        return values[at, 0] if at < len(keys) and keys[at] == h else None

    weight = 0.0
    for n in range(5, 0, -1):
        p = find(m.grams[n - 1], gram[-n:])
        if p is not None and not np.isnan(p):
            return weight + p
        if n > 1:
            weight += find(m.contexts[n - 2], gram[-n:-1]) or 0.0
    return weight + m.floor[0]


def test_language_costs_against_single_lookups():
    rng = random.Random(1)
    counts = {"x": {}}
    for _ in range(300):
        p = language.MARK * 4 + "".join(rng.choice("abcde") for _ in range(rng.randint(1, 7))) + language.MARK
        for i in range(len(p) - 4):
            counts["x"][p[i : i + 5]] = counts["x"].get(p[i : i + 5], 0) + 1
    m = language.build(counts)
    for w in ("a", "abc", "edcbaab", "zq", "abzba"):
        plain = _before(m, w) - _logp(m, (language.MARK * 4 + w + language.MARK)[-5:])
        assert m.costs([w, "other"])[0, 0] == pytest.approx(plain, rel=1e-5)


def test_language_costs_of_unseen_grams():
    """A language's costs are the same whether or not another language fills in its unseen grams."""
    rng = random.Random(2)
    counts = {"x": {}, "y": {}}
    for lang, letters in (("x", "abcd"), ("y", "cdef")):
        for _ in range(200):
            p = language.MARK * 4 + "".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) + language.MARK
            for i in range(len(p) - 4):
                counts[lang][p[i : i + 5]] = counts[lang].get(p[i : i + 5], 0) + 1
    both = language.build(counts)
    words = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 9))) for _ in range(200)]
    for k, lang in enumerate(both.langs):
        alone = language.build({lang: counts[lang]}).costs(words)
        assert np.allclose(both.costs(words)[:, k], alone[:, 0], rtol=1e-5)


def test_scorer_keeps_costs_over_generations(monkeypatch):
    monkeypatch.setattr(language, "_CACHE_WORDS", 20)
    m = language.build({"x": {"\x02\x02\x02\x02a": 3, "\x02\x02\x02ab": 2, "\x02\x02ab\x02": 2}})
    scorer, rng = language.Scorer(m), random.Random(1)
    for _ in range(60):
        words = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 7))) for _ in range(9)]
        assert np.allclose(scorer.total(" ".join(words)), m.costs(words).sum(axis=0))


def test_language_on_documents(spark):
    got = language.op5_language(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    r = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert r[0] > 0.98 and 0 <= r[1] <= r[2] <= 1


def test_language_keeps_every_gram(spark, make):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(8)) for _ in range(1500)]
    marked = [language.MARK * 4 + w + language.MARK for w in words]
    grams = {p[i : i + 5] for p in marked for i in range(len(p) - 4)}
    m = language.train(make([(i, " ".join(words)) for i in range(30)], ["en"] * 30), F.lit(True))
    assert len(m.grams[-1][0]) == len(grams) > 10_000


def test_language_edges(spark, make):
    rows = [*enumerate(TEXTS), (90, "12 34 !!"), *((100 + i, "der die und das " * 5) for i in range(30)), *((200 + i, "the and of with " * 5) for i in range(30)), (400, "the " + "x" * 100_000)]
    lang = [None] * 7 + ["de"] * 30 + ["en"] * 30 + [None]
    docs = make(rows, lang)
    m = language.train(docs, F.lit(True))
    got = {r["doc_id"]: r for r in language.identify(docs, m).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (0, 1, 2, 90)) and got[100]["lang_pred"] == "de" and got[230 - 1]["lang_pred"] == "en"
    assert got[400]["rejected"] and got[101][1:] == got[102][1:]
    none = language.train(docs, F.lit(False))
    assert {r["lang_pred"] for r in language.identify(docs, none).collect()} == {"und"}
    assert language.identify(make([]), m).count() == 0


def plain_kneser_ney(words, order=5):
    """Probability of a character after others by interpolated Kneser-Ney, by definition: from the words of one language."""
    runs = [language.MARK * (order - 1) + w + language.MARK for w in words]
    grams = Counter(r[i : i + order] for r in runs for i in range(len(r) - order + 1))
    counts = {order: grams}
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    discounts = {}
    for n, own in counts.items():
        once, twice = (sum(x == k for x in own.values()) for k in (1, 2))
        discounts[n] = min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5

    def chance(gram):
        n = len(gram)
        after = {g: x for g, x in counts[n].items() if g[:-1] == gram[:-1]}
        total = sum(after.values())
        if n == 1:
            return max(0.0, after.get(gram, 0) - discounts[1]) / total + discounts[1] * len(after) / total / max(256, 2 * len(after))
        if not total:
            return chance(gram[1:])
        return max(0.0, after.get(gram, 0) - discounts[n]) / total + discounts[n] * len(after) / total * chance(gram[1:])

    return chance


def test_language_model_against_its_definition(spark):
    rng = random.Random(3)
    own = {lang: ["".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(120)] for lang, letters in (("x", "abcd"), ("y", "cdefé"), ("z", "a"))}
    own["x"].append("long" * 40)
    rows = [(lang, " ".join(words[i : i + 10])) for lang, words in own.items() for i in range(0, len(words), 10)]
    m = language.fitted(language.gram_counts(spark.createDataFrame(rows, "lang string, text string")))
    assert m.langs == ["x", "y", "z"]
    scorer = language.Scorer(m)
    for w in ("abba", "é", "zq", "cdefc", "long" * 33, "x" * 64, "y" * 63):
        r = language.MARK * 4 + w + language.MARK
        for k, lang in enumerate(m.langs):
            chance = plain_kneser_ney(own[lang])
            assert scorer.total(w)[k] == pytest.approx(-sum(np.log(chance(r[i - 4 : i + 1])) for i in range(4, len(r))), rel=1e-6)
        assert scorer.total(w)[-1] == len(w) + 1


def test_rare_language_and_texts_without_letters(spark, make):
    """A language of which every training row is a calibration row is learned; numerals are no letters."""
    rows = [(i, "the and of with this that " * 3) for i in range(100)]
    docs = make(rows, ["en"] * 100)
    rare = docs.select("doc_id").where(F.pmod(F.xxhash64("doc_id"), F.lit(10)) == 0).first()[0]
    rows[rare] = (rare, "õun järv öö jää")
    rows += [(200, "²½ ①"), (201, "²½ ① ö"), (202, "öö jää")]
    docs = make(rows, [*("et" if i == rare else "en" for i in range(100)), None, None, None])
    m = language.train(docs, F.lit(True))
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs, m).collect()}
    assert m.langs == ["en", "et"] and got[200] == "und" and got[201] != "und" and got[202] == "et" and got[rare] == "et"


def test_held_out_rows(spark):
    import zlib

    rows = spark.range(300).select("id", language.held_out(F.col("id")), labelled.held_out(F.col("id"))).collect()
    assert all((a, b) == (zlib.crc32(str(i).encode()) % 4 == 2, zlib.crc32(str(i).encode()) % 5 == 0) for i, a, b in rows)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_automaton_against_distances():
    rng = random.Random(6)
    terms = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(4, 8))) for _ in range(40)})
    lexicon = toxicity.Lexicon(terms, [])
    long = [t for t in terms if len(t) >= toxicity.FUZZY]
    for _ in range(3000):
        w = "".join(rng.choice("abcd") for _ in range(rng.randint(3, 9)))
        near = lexicon.near(w)
        assert (near is not None) == any(distance(w, t) <= 1 for t in long)
        assert near is None or distance(w, near) <= 1


def test_automaton_of_more_edits():
    rng = random.Random(7)
    terms = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(4, 9))) for _ in range(25)})
    long = [t for t in terms if len(t) >= toxicity.FUZZY]
    for edits in (0, 1, 2, 3):
        lexicon = toxicity.Lexicon(terms, [], edits)
        for _ in range(600):
            w = "".join(rng.choice("abcd") for _ in range(rng.randint(2, 11)))
            near = lexicon.near(w)
            assert (near is not None) == any(distance(w, t) <= edits for t in long)
            assert near is None or distance(w, near) <= edits


def test_terms_with_digits_hyphens_and_unparted_scripts(spark):
    rows = [("w3rd-one x 笨蛋东西", 1), ("garden 花园", 0)] * 10
    words, _ = toxicity.choose(toxicity.term_counts(spark.createDataFrame(rows, "text string, label int")), 0.5)
    assert {"w3rd-one", "笨蛋", "蛋东"} <= set(words) and "花园" not in words
    m = toxicity.Matcher(toxicity.Model(words, []))
    assert [t for _, _, t, _ in m.hits(toxicity.words_of("A W3RD-0NE 你是笨蛋"))] == ["w3rd-one", "笨蛋"]


def test_lexicon_kinds_and_context():
    m = toxicity.Matcher(toxicity.Model(["idiot", "scum"], ["grum"]))
    kinds = lambda text: [(k, q) for _, k, _, q in m.hits(text.lower().split())]
    assert kinds("you IDIOT!") == [(toxicity.EXACT, False)] and kinds("idi0t idoit idiots") == [(toxicity.NEAR, False), (toxicity.NEAR, False)]
    assert kinds("scun") == [] and kinds("grumling") == [(toxicity.BEGUN, False)]
    assert kinds('he wrote "you idiot" today') == [(toxicity.EXACT, True)] and kinds("") == []


def test_misspelt_words_of_a_beginning(spark):
    rows = [("stup", True, 60, 0), ("stupid", False, 30, 0), ("stupidly", False, 25, 0), ("stupor", False, 20, 0)]
    lexicon = toxicity.Lexicon(*toxicity.choose(spark.createDataFrame(rows, "term string, stem boolean, toxic long, other long"), 0.5))
    assert lexicon.stems == ["stup"] and lexicon.find("stupidity") == (toxicity.BEGUN, "stup")
    assert all(lexicon.find(w) == (toxicity.NEAR, "stupid") for w in ("stopid", "sttupid", "supid"))


def test_rare_terms_of_a_large_sample(spark):
    """A term of a few texts stays a term however many toxic texts there are."""
    docs, labels = [], []
    for i in range(4000):
        toxic = i % 2
        docs.append((i, ("filthor" if toxic else "garden") + (" zarquon" if toxic and i < 60 else "")))
        labels.append((i, 1, toxic))
    rows = spark.createDataFrame([(t, x[2]) for (_, t), x in zip(docs, labels)], "text string, label int")
    words, _ = toxicity.choose(toxicity.term_counts(rows), 0.5)
    assert "zarquon" in words and "garden" not in words
    table = spark.createDataFrame([("pure", False, 5, 0), ("chance", False, 5, 4)], "term string, stem boolean, toxic long, other long")
    assert toxicity.choose(table, 0.1)[0] == ["pure"]


def fixture_texts():
    rng = random.Random(4)
    good = lambda: " ".join("".join(rng.choice("aeinrst") for _ in range(rng.randint(2, 8))) for _ in range(60)) + "."
    rows, labels = [], []
    for i in range(600):
        bad, toxic = i % 5 == 0, i % 7 == 0
        t = good().upper() + "!!!!" if bad else good()
        if toxic:
            t = t.replace(" ", " grumbo ", 1) + " blarg"
        rows.append((i, t))
        labels.append((i, int(not bad), int(toxic)))
    return rows, labels


def test_classifiers(spark, make, labels_dir):
    rows, labels = fixture_texts()
    docs, d = make([*rows, (1000, None), (1001, ""), (1002, rows[1][1])]), labels_dir([*labels, (7, None, None), (None, 1, 1)])
    for module, column in ((quality, 1), (toxicity, 2)):
        m = module.train(spark, docs, d)
        got = {r["doc_id"]: r for r in module.score(docs, m).collect()}
        assert len(got) == 603 and all(0 <= r["score"] <= 1 for r in got.values()) and got[1002]["score"] == got[1]["score"]
        assert np.mean([got[i]["predicted"] == x[column] for i, x in enumerate(labels)]) > 0.97
        accepted = module.accept(docs, m)
        assert accepted.columns == docs.columns and {r["doc_id"] for r in accepted.collect()} == {i for i, r in got.items() if r["predicted"] == (column == 1)}
        assert module.score(make([]), m).count() == 0


def test_classifiers_without_labels(spark, make, labels_dir):
    docs = make(list(enumerate(TEXTS)))
    for module in (quality, toxicity):
        assert {r["score"] for r in module.score(docs, module.train(spark, docs, labels_dir([]))).collect()} == {0.5}
        one_sided = module.train(spark, docs, labels_dir([(i, 1, 1) for i in range(6)]))
        assert {r["predicted"] for r in module.score(docs, one_sided).collect()} == {1}


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    m = quality.fit(x[:3000], y[:3000])
    assert np.mean((m.scores(x[3000:]) > 0.5) == y[3000:]) > 0.9 and (0, 1) in {(i, j) for i, j, _ in m.pairs}


def brute_neighbours(vectors, queries, k=20):
    out = {}
    for q in queries:
        others = [(-float(np.dot(v, vectors[q])), i) for i, v in vectors.items() if i != q]
        out[q] = [i for _, i in sorted(others)[:k]]
    return out


def test_neighbours_recall(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    vectors = {int(i): np.array(v, np.float64) for i, v in zip(table.vec_id, table.embedding)}
    got = {}
    for r in ann.op2_ann(spark, SF).orderBy("query_id", "rank").collect():
        assert r["score"] == pytest.approx(float(np.dot(vectors[r["query_id"]], vectors[r["vec_id"]])), abs=1e-12)
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    expected = brute_neighbours(vectors, [i for i in vectors if i % 20 == 0])
    assert set(got) == set(expected) and all(len(v) == 20 for v in got.values())
    assert np.mean([len(set(got[q]) & set(expected[q])) / 20 for q in got]) >= 0.9


def test_neighbours_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [1.0, inf]), (5, [1.0, None]), (6, [1.0]), (None, [1.0, 1.0]), (20, [0.5, 0.5]), (21, [0.5, 0.5]), (22, [0.5, 0.5])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    got = ann.search(ann.usable(df), F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(0, 1, 20), (0, 2, 21), (0, 3, 22), (20, 1, 0), (20, 2, 21), (20, 3, 22)]
    assert ann.search(ann.usable(df.limit(0)), F.lit(True)).count() == 0


@pytest.mark.parametrize("size", [1.0, 1e25])
def test_queries_unlike_the_other_vectors(spark, size):
    rng = np.random.default_rng(5)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    x = unit(rng.normal(size=(50, 64)))[rng.integers(0, 50, 8000)] + 0.05 * rng.normal(size=(8000, 64))
    x[::20] = unit(rng.normal(size=(400, 64)))
    x *= size
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.search(ann.usable(df), F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    expected = brute_neighbours(dict(enumerate(x)), range(0, 8000, 800))
    score = x[::20] @ x.T
    score[np.arange(400), np.arange(0, 8000, 20)] = -np.inf
    true = np.argpartition(-score, 20, axis=1)[:, :20]
    assert all(set(true[q // 20]) == set(v) for q, v in expected.items())
    assert np.mean([len(got[20 * i] & set(v.tolist())) / 20 for i, v in enumerate(true)]) >= 0.9


def test_many_copies_of_a_vector(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(400)] + [(400 + i, rng.normal(size=4).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.search(ann.usable(df), F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    expected = brute_neighbours({i: np.array(v) for i, v in rows}, range(0, 800, 20))
    assert all(got[q] == expected[q] for q in range(0, 400, 20))
    assert np.mean([len(set(got[q]) & set(expected[q])) / 20 for q in got]) >= 0.9
