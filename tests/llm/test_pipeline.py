"""Each stage of the pipeline on what its predecessor kept, against plain versions."""

import public_tokenizers
import pytest

import corpus_pipeline
from lychgate.llm import near_dup, quality, toxicity
from tests.llm.test_passages import brute
from tests.llm.test_tokens import checked_packing


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    root, out = str(tmp_path_factory.mktemp("stages")), {}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{root}/{name}")
        out[name] = (docs, spark.read.parquet(f"{root}/{name}"))
        docs = out[name][1]
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_order_and_columns(stages):
    assert list(stages) == ["toxicity", "quality", "near_dedup", "passages", "packing"]
    first = stages["toxicity"][0].columns
    assert all(after.columns == first for name, (_, after) in stages.items() if name != "packing")


@pytest.mark.parametrize(("name", "module", "bad"), [("toxicity", toxicity, 1), ("quality", quality, 0)])
def test_classifier_stages(spark, sf, stages, name, module, bad):
    before, after = stages[name]
    scores = module.score(before, module.train(spark, before, sf)).collect()
    assert set(texts(after)) == {r["doc_id"] for r in scores if r["predicted"] != bad}
    assert texts(after).items() <= texts(before).items()


def test_near_dedup_stage(stages):
    before, after = (texts(df) for df in stages["near_dedup"])
    assert after.items() <= before.items() and not list(near_dup.iter_brute_links(list(after.values())))
    ids = sorted(before)
    links = {}
    for a, b in near_dup.iter_brute_links([before[i] for i in ids]):
        links.setdefault(ids[b], set()).add(ids[a])
        links.setdefault(ids[a], set()).add(ids[b])
    for i in set(before) - set(after):  # what went is reached from a smaller id that stayed
        reached, todo = {i}, [i]
        while todo:
            for j in links.get(todo.pop(), ()):
                if j not in reached:
                    reached.add(j)
                    todo.append(j)
        assert min(reached) in after and min(reached) < i


def test_passages_stage(stages):
    before, after = (texts(df) for df in stages["passages"])
    repeated = brute(sorted(before.items()))
    assert all(i not in after or len(after[i].split()) <= len(before[i].split()) - len(repeated[i]) for i in repeated)
    assert all(after[i] == before[i] for i in after if len(after[i]) == len(before[i])) and not brute(sorted(after.items()))


def test_packing_stage(stages):
    before, after = stages["packing"]
    checked_packing(after.collect(), sorted(texts(before).items()))


def test_run(spark, sf, stages):
    assert corpus_pipeline.run(spark, sf).count() == stages["packing"][1].count()
    assert public_tokenizers.path("byte_bpe_50k.json")
