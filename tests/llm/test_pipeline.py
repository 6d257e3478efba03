"""The pipeline's stages one after the other, each against what it should leave."""

import importlib.util
from collections import Counter

import pytest
from fixtures import documents, frame
from test_dedup import brute_links
from test_models import labelled

if importlib.util.find_spec("corpus_pipeline") is None:
    pytest.skip("no pipeline here", allow_module_level=True)


def test_every_stage_on_what_its_predecessor_kept(spark, tmp_path):
    import corpus_pipeline

    good, labels = labelled(spark, 120)
    folder = str(tmp_path)
    labels.write.parquet(f"{folder}/labels.parquet")
    frame(spark).unionByName(good.withColumn("doc_id", good["doc_id"] + 1000)).select(
        "doc_id", "text", "lang", "source", "n_chars"
    ).write.parquet(f"{folder}/documents.parquet")

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = [docs]
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, kept[-1], folder)
        out.write.parquet(f"{folder}/{name.replace(' ', '-')}")
        kept.append(spark.read.parquet(f"{folder}/{name.replace(' ', '-')}"))
    assert all(k.columns == docs.columns for k in kept[:-1])
    rows = [[(r["doc_id"], r["text"]) for r in k.collect()] for k in kept[:-1]]
    assert set(rows[1]) <= set(rows[0])
    assert sorted(t or "" for _, t in rows[2]) == sorted({t or "" for _, t in rows[1]})
    triples = [(i, t, None) for i, t in rows[2]]
    assert len(rows[3]) == brute_links(triples)[2]
    assert max(Counter(rows[4]).values()) <= 3
    packed = kept[-1].collect()
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == Counter(i for i, _ in rows[4])
    assert len(documents()) > 0


def test_pipeline_on_an_empty_table(spark, tmp_path):
    import corpus_pipeline

    folder = str(tmp_path)
    frame(spark, []).write.parquet(f"{folder}/documents.parquet")
    labelled(spark, 8)[1].limit(0).write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
