"""Registered queries against their SQL, held-out quality and brute force; the pipeline stage by stage."""

import duckdb
import numpy as np
import pytest
from compare import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from labwatch.llm import stages
from labwatch.llm.common import crc_remainder
from labwatch.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    assert compare(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) == []


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_languages_held_out(spark):
    found = QUERIES["op1_language_id"](spark, LARGER)
    truth = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "lang")
    rows = found.where("held_out").join(truth, "doc_id").collect()
    assert len(rows) > 100 and np.mean([r.lang == r.lang_pred for r in rows]) >= 0.95


def test_language_model_held_out(spark):
    rows = QUERIES["op4_hmm_lm"](spark, LARGER).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_embedding_links(spark):
    data = duckdb.sql(f"SELECT vec_id, label, embedding FROM '{LARGER}/embeddings.parquet'").fetchnumpy()
    unit = np.stack(data["embedding"]).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.98) & (data["label"][:, None] == data["label"][None, :])
    want = dict(zip(data["vec_id"].tolist(), (links.sum(axis=1) - 1).tolist()))
    got = {r.vec_id: r.n_links for r in QUERIES["op5_embedding_dedup"](spark, LARGER).collect()}
    assert set(got) == set(want) and all(got[i] <= want[i] for i in want)
    assert sum(got.values()) >= 0.9 * sum(want.values())


def test_packing_is_close_to_the_bound(spark):
    rows = QUERIES["op7_packing"](spark, FOLDER).collect()
    assert len({r.sequence_id for r in rows}) <= -(-sum(r.length for r in rows) // 4096) + 1


def test_toxicity_held_out(spark):
    scored = QUERIES["op10_toxicity"](spark, "/root/testdata/sf0.1").where("held_out")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = scored.join(labels, "doc_id").select("toxic", "predicted").collect()
    plain = [r for r in rows if r.toxic == 0]
    assert np.mean([r.predicted for r in plain]) <= 0.02
    assert np.mean([r.predicted for r in rows if r.toxic == 1]) >= 0.6


def test_stages_pass_columns_on(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumns({"score": F.lit(1), "copy": F.lit("c")})
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "jaccard_join", "suffix_dedup", "mixing", "packing"]
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "copy"], name
        docs = docs.sparkSession.createDataFrame(docs.collect(), docs.schema)
        assert name == "mixing" or docs.count() <= before
        before = docs.count()
    packed = stages.pack_sequences(spark, docs, FOLDER)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert packed.where("piece = 0").count() == docs.count()


def test_pipeline_runs_and_keeps_no_near_copies(spark):
    packed = corpus_pipeline.run(spark, FOLDER)
    kept = {r.doc_id for r in packed.select("doc_id").distinct().collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    copies = docs.groupBy("text").agg(F.collect_list("doc_id").alias("ids")).where("size(ids) > 1").collect()
    assert all(len(kept & set(r.ids)) <= 1 for r in copies)


def test_empty_tables_through_the_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        assert out.count() == 0
    held = crc_remainder("doc_id", 5) == 0
    assert docs.where(held).count() == 0
