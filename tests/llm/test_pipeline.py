"""Each stage of the pipeline against a plain version over the rows that the stage before kept."""

import numpy as np
import public_tokenizers
import sentencepiece

import corpus_pipeline
from tests.llm import test_contamination, test_lines, test_setjoin
from tests.llm.tables import DOCS, SF_DIR, documents


def texts(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_duplicates", "benchmark", "tokens"]
    docs = documents(spark)
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = texts(docs)
        docs = stage(spark, docs, SF_DIR).cache()
        if name != "tokens":
            assert docs.columns == columns
            kept[name] = before, texts(docs)
            assert all(r.n_chars == len(r.text) for r in docs.collect())

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    before, after = kept["quality"]
    assert all(before[i] == t for i, t in after.items())
    wrong = [i for i in before if i in labels and labels[i] != (i in after)]
    assert len(wrong) <= 0.03 * len(labels)

    before, after = kept["lines"]
    plain = {i: (gone, t) for i, (n, gone, t) in test_lines.brute(list(before.items())).items() if gone < n and (not gone or t.strip())}
    assert after == {i: t for i, (_, t) in plain.items()}

    before, after = kept["near_duplicates"]
    groups = test_setjoin.brute(list(before.items()), corpus_pipeline.SHINGLE, corpus_pipeline.PERCENT)
    assert after == {i: t for i, t in before.items() if groups[i][1] == i}

    before, after = kept["benchmark"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    found = test_contamination.brute(list(before.items()), items, 10)
    assert after == {i: t for i, t in before.items() if not found[i][4]}
    assert len(after) < len(before)

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(corpus_pipeline.MODEL))
    rows = docs.collect()
    assert {r.doc_id for r in rows} == set(after)
    for r in rows:
        ids = library.encode(after[r.doc_id], add_bos=True, add_eos=True)
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        assert r.n_tokens == len(ids) and r.decodes


def test_odd_documents(spark, tmp_path):
    """Null and empty texts, rows without an id and repeated rows go through all stages."""
    rows = [
        (r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in documents(spark).limit(150).collect()
    ] + [(9001, None, None, None, None), (9002, "", "en", "s", 0), (None, "no id at all here", "en", "s", 17)] * 2
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(found) == len({(r.doc_id, r.ids) for r in found if r.doc_id is not None}) + sum(r.doc_id is None for r in found)
    assert all(r.decodes for r in found)


def test_texts_go_to_workers_once_in_small_batches(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    stages = dict(corpus_pipeline.STAGES)
    docs = documents(spark).limit(100)
    try:
        for name in ("quality", "near_duplicates", "tokens"):
            spark.conf.unset(key)
            found = stages[name](spark, docs, SF_DIR)
            assert spark.conf.get(key) == str(corpus_pipeline.BATCH_BYTES)
            if name == "quality":
                plan = found._jdf.queryExecution().optimizedPlan().toString()
                assert "MapInArrow" in plan and "_scored" not in plan
    finally:
        spark.conf.set(key, before)
