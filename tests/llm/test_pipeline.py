"""The stages of the corpus pipeline on the smallest tables."""

import hashlib
import zlib

import corpus_pipeline
import numpy as np
from postmill.llm import decontaminate, pieces, queries, secrets

from test_similar import groups

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "pieces"]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF)
        docs = docs.checkpoint() if spark.sparkContext.getCheckpointDir() else docs.cache()
        seen[name] = (before, docs)
        if name != "pieces":
            assert docs.columns == before.columns
    before, after = seen["quality"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in after.collect()}
    held = [r.doc_id for r in before.collect() if r.doc_id in labels and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert sum((i in kept) == bool(labels[i]) for i in held) >= 0.85 * len(held)
    before, after = seen["near_duplicates"]
    rows = sorted(before.collect(), key=lambda r: r.doc_id)
    firsts = {rows[i].doc_id for i in set(groups([r.text for r in rows]))}
    assert {r.doc_id for r in after.collect()} == firsts
    before, after = seen["decontamination"]
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert decontaminate.decontaminate(after, bench).where("contaminated").count() == 0
    assert after.count() == decontaminate.decontaminate(before, bench).where("not contaminated").count()
    before, after = seen["secrets"]
    assert after.count() == before.count()
    assert secrets.scan_report(after).where("n_assign + n_access + n_hex > 0").count() == 0
    clean = {r.doc_id for r in secrets.scan_report(before).where("spans = ''").collect()}
    texts = {r.doc_id: r.text for r in before.collect()}
    assert all(r.text == texts[r.doc_id] and r.n_chars == len(r.text) for r in after.collect() if r.doc_id in clean)
    before, after = seen["pieces"]
    with open(queries.piece_model(), "rb") as f:
        codec = pieces.PieceCodec(f.read())
    texts = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        ids = codec.ids([texts[r.doc_id].encode()])[0]
        assert r.ids == ids.astype(np.int64).tolist() and r.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()


def test_run_and_odd_rows(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "x y z " * 40, "en", None, 240), (1, "", "en", "s", 0), (1, "", "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, SF).columns == odd.columns
        assert stage(spark, odd.limit(0), SF).count() == 0
