"""The pipeline on the small tables, stage by stage against plain versions."""

import re

import corpus_pipeline
from daycut.llm import catalog, decontam, secrets

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    out, before = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, before, SF)
        if name != names[-1]:
            assert rows.columns == docs.columns
        out[name] = before = rows.checkpoint() if spark.sparkContext.getCheckpointDir() else rows
    kept = {r.doc_id for r in out[names[0]].collect()}
    clean = [d in kept for d, (q, t) in labels.items() if q == 1 and t == 0]
    junk = [d in kept for d, (q, t) in labels.items() if q == 0]
    assert sum(clean) >= 0.95 * len(clean) and sum(junk) <= 0.2 * len(junk)      # 87 labels in all
    texts = [r.text for r in out[names[1]].collect() if r.text]
    words = [tuple(re.findall(r"[^\x20\x09-\x0d]+", t.lower())) for t in texts]
    assert len(set(words)) == len(words)
    assert decontam.contaminated(out[names[2]], bench).count() == 0
    left = secrets.secrets_digest(secrets.scan_secrets(out[names[3]]))
    assert left.where("n_assign + n_access + n_hex > 0").count() == 0
    assert out[names[3]].count() == out[names[2]].count()
    assert out[names[4]].where("copies < 1 OR copies > 3").count() == 0


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns[-1] == "copies" and 0 < rows.count() < 200


def test_digest_columns(spark):
    want = {"op1_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            "op2_ngram_jaccard": ["doc_id", "n_shingles", "component_id"],
            "op8_language_id": ["doc_id", "held_out", "lang_pred", "score"],
            "op10_source_mixing": ["doc_id", "size", "source_size", "target", "taken"]}
    for name, columns in want.items():
        rows = catalog.QUERIES[name](spark, SF)
        assert rows.columns[:len(columns)] == columns and rows.count() == 200


def test_held_out_accuracy(spark):
    rows = catalog.QUERIES["op8_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id")
    held = rows.where("held_out")
    assert held.where("lang = lang_pred").count() >= 0.97 * held.count()
