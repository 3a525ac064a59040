"""The registered queries: contract columns, SQL, held-out rows, and limits of memory."""

import os
import random

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lychgate.llm import ann, common, packing, quality, queries, token_output, toxicity
from lychgate.llm.tokens import byte_bpe
from tests.test_oracle import rows

CONTRACT = {
    "op1_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op2_ann": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op3_packing": {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op4_passages": {"doc_id": "bigint"},
    "op5_language": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op6_minhash": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op7_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op8_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op9_token_output": {"row_id": "bigint", "ids": "binary", "positions": "binary", "cu_seqlens": "array<int>"},
    "op10_ogg_media": {
        "doc_id": "bigint", "n_bytes": "bigint", "payload_bytes": "bigint", "payload_sha256": "string", "tail_crc32": "bigint", "media_bytes": "bigint", "media_sha256": "string", "feature": "string",
    },
    "op11_url_rules": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op12_conversations": {
        "conv_id": "bigint", "gaps": "bigint", "blank": "bigint", "duplicate": "bigint", "truncated": "bigint", "illegal": "bigint", "cost": "bigint", "audit": "string", "repaired_sha256": "string",
    },
    "op13_spelling": {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"},
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_columns_of_the_contract(spark, sf, name):
    kinds = dict(queries.queries()[name](spark, sf).dtypes)
    assert CONTRACT[name].items() <= kinds.items()


def test_near_duplicates_against_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert rows(queries.queries()["op6_minhash"](spark, sf).toPandas()) == rows(con.execute(queries.OP6_SQL).df())


@pytest.mark.parametrize(("name", "label"), [("op7_quality", "quality"), ("op8_toxicity", "toxic")])
def test_held_out_rows_of_the_driver(spark, name, label):
    d = "/root/testdata/sf0.01"
    scored = queries.queries()[name](spark, d).where("held_out")
    known = scored.join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where(f"{label} is not null")
    right, n = known.agg(F.avg((F.col("predicted") == F.col(label)).cast("int")), F.count("*")).first()
    assert n > 20 and right >= 0.95


def test_recall_at_a_larger_size(spark):
    d = "/root/testdata/sf0.1"
    got = ann.op2_ann(spark, d).groupBy("query_id").agg(F.collect_list("vec_id").alias("v")).toPandas()
    table = spark.read.parquet(f"{d}/embeddings.parquet").toPandas()
    ids, x = table.vec_id.to_numpy(), np.stack(table.embedding.to_numpy()).astype(np.float64)
    found = []
    for q, v in zip(got.query_id, got.v):
        score = x @ x[ids == q][0]
        score[ids == q] = -np.inf
        found.append(len(set(v) & set(ids[np.lexsort((ids, -score))[:20]].tolist())) / 20)
    assert len(found) > 40 and np.mean(found) >= 0.9


def plain_hits(model, text):
    """Places, kinds and quotation of hits by comparing every word with every term."""
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    def kind(w, plain):
        if any(w.startswith(s) for s in model.stems):
            return toxicity.BEGUN
        if w in model.words:
            return toxicity.EXACT if plain else toxicity.NEAR
        return toxicity.NEAR if any(len(t) >= toxicity.FUZZY and distance(w, t) <= 1 for t in model.words) else 0

    words, out = toxicity.words_of(text), []
    for i, word in enumerate(words):
        w = toxicity.plain(word)
        k = kind(w, True) if w else 0
        if not k and w and not w.isalpha():
            k = kind(toxicity.plain(word.translate(str.maketrans("013457@$!", "oieastasi"))), False)
        if k:
            near = words[max(0, i - 8) : i] + words[i + 1 : i + 9]
            opens = any(x[0] in "\"'«»“”„‘’" for x in words[max(0, i - 8) : i + 1])
            closes = any(x.rstrip(".,;:!?")[-1:] in set("\"'«»“”„‘’") for x in words[i : i + 9])
            out.append((i, k, opens and closes or any(toxicity.plain(x) in toxicity.REPORTING for x in near)))
    return out


def test_hits_against_plain_comparison():
    rng = random.Random(2)
    terms = ["idiot", "scumbag", "moron", "pest-ilent", "w3rd"]
    model = toxicity.Model(terms, ["grum"])
    matcher = toxicity.Matcher(model)
    pool = [*terms, "idi0t", "m0ron", "morron", "scumbog", "grumling", "scum", "fine", "day", "said", '"so', 'it"', "w3rd!", "IDIOT,", "«non»", "pestilent", "a"]
    for _ in range(400):
        text = " ".join(rng.choice(pool) for _ in range(rng.randint(0, 25)))
        assert [(i, k, q) for i, k, _, q in matcher.hits(toxicity.words_of(text))] == plain_hits(model, text)


def test_additive_scores_against_plain_sums():
    rng = np.random.default_rng(1)
    x = rng.random((500, 4))
    model = quality.fit(x, (x[:, 0] + x[:, 1] * x[:, 2] > 0.8).astype(float), 20)
    for row, got in zip(x[:60], model.scores(x[:60])):
        place = lambda cuts, v: sum(v >= c for c in cuts)
        z = model.base + sum(t[place(c, v)] for c, t, v in zip(model.cuts, model.tables, row))
        z += sum(t[place(model.coarse[i], row[i]), place(model.coarse[j], row[j])] for i, j, t in model.pairs)
        assert got == pytest.approx(1 / (1 + np.exp(-z)))


def test_caches_hold_bytes_and_no_long_keys():
    cache = common.TwoGenerations(lambda k: k * 2, 100_000)
    for i in range(20_000):
        assert cache[f"word{i}"] == f"word{i}word{i}"
    assert cache["x" * 10**6] == "x" * (2 * 10**6) and max(map(len, cache)) < 100
    assert (len(cache) + len(cache.old)) * 200 < 150_000
    own = byte_bpe(public_tokenizers.path("byte_bpe_50k.json"))
    before = own.used
    own.encode("a " + "x" * 300_000)
    assert own.used == before


def test_batches_are_bounded_by_bytes(spark):
    docs = spark.range(0, 60, 1, 1).selectExpr("id as doc_id", "repeat('abcdefg ', 131072) as text")  # 60 texts of 1 MB in one task

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["bytes"])

    got = [r["bytes"] for r in common.small_batches(docs).mapInArrow(sizes, "bytes long").collect()]
    assert sum(got) > 60 << 20 and max(got) <= common.BATCH_BYTES + (3 << 20)


def test_very_long_text(spark):
    text = "one two three four five six seven eight nine ten " * 400_000  # 20 MB
    docs = spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string")
    got = {r["doc_id"]: r["doc_tokens"] for r in packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).groupBy("doc_id").agg(F.max("doc_tokens").alias("doc_tokens"), F.sum("length").alias("n")).collect()}
    assert got[1] > 4_000_000 and got[2] == 2


def test_written_token_rows(spark, sf, tmp_path):
    table = token_output.token_rows(spark.read.parquet(f"{sf}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
    path = str(tmp_path / "rows")
    token_output.write_rows(table, path)
    one, two = (sorted((r["row_id"], bytes(r["ids"]), bytes(r["positions"]), tuple(r["cu_seqlens"])) for r in df.collect()) for df in (table, spark.read.parquet(path)))
    assert one == two and len(one) > 10


OWN = "".join(f"q{i} " for i in range(200))
AWKWARD = [(1, None), (2, ""), (3, " \n"), (4, "word"), (5, "a b c d e f g"), (5, "a b c d e f h"), (None, "a b c d e f g"), (6, "A b c d e f g"), (7, " ".join(f"p{i}" for i in range(70))), (8, OWN + " ".join(f"p{i}" for i in range(70))), (9, "ü" * 50_000)]


@pytest.mark.parametrize("texts", [AWKWARD, []])
def test_pipeline_on_awkward_documents(spark, make, tmp_path, texts):
    d = str(tmp_path)
    make(texts).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(4, 1, 0), (None, 0, 1), (5, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, d)
        assert out.columns == docs.columns
        docs = common.written(out, name)
    kept = docs.collect()
    if texts:
        ids = [r["doc_id"] for r in kept]
        assert ids.count(5) == 1 and {1, 2, 3, 4, 7, 9} <= set(ids) and None in ids and {r["text"] for r in kept if r["doc_id"] == 8} == {OWN}
    else:
        assert not kept
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, d).collect()
    assert len({(r["doc_id"], r["doc_tokens"], r["ids_crc32"], r["sequence_id"], r["offset"]) for r in packed}) == len(packed) >= len(kept)
    assert os.path.exists(f"{d}/documents.parquet")
