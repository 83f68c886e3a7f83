"""Registered queries of the subpackage: recall, agreement between stages, and plans."""

from __future__ import annotations

import corpus_pipeline
import numpy as np
import pytest
from retail_lens.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_names():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(ORACLE) <= set(QUERIES)


def test_neighbour_recall_on_the_given_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, e = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    e /= np.linalg.norm(e, axis=1)[:, None]
    got = {(r.query_id, r.vec_id) for r in QUERIES["op1_hilbert_neighbours"](spark, SF).collect()}
    true = set()
    for q in np.flatnonzero(ids % 50 == 0):
        near = e @ e[q]
        near[q] = -9
        true |= {(int(ids[q]), int(ids[j])) for j in np.argsort(-near)[:5]}
    assert len(got) == len(true) and len(got & true) >= 0.9 * len(true)


def test_pipeline(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_join", "mixing", "bpe"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.drop_toxic(spark, docs, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet").groupBy("doc_id").max("toxic").toDF("doc_id", "toxic")
    gone = docs.join(kept, "doc_id", "left_anti").join(labels, "doc_id").agg({"toxic": "avg", "doc_id": "count"}).first()
    assert kept.columns == docs.columns and gone["avg(toxic)"] in (None, 1.0)
    once = corpus_pipeline.drop_near_copies(spark, kept, SF)
    assert once.columns == docs.columns and once.count() == once.select("doc_id").distinct().count() < kept.count()
    mixed = corpus_pipeline.mix_sources(spark, once, SF)
    assert mixed.columns == docs.columns and mixed.join(once, "doc_id", "left_anti").count() == 0
    got = corpus_pipeline.run(spark, SF)
    assert got.count() == mixed.count() and got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


@pytest.mark.parametrize("name", ["op2_minimax_shards", "op7_source_mixing", "op8_licences"])
def test_native_plans(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
