"""All queries of the operators on empty tables, without labels, and with one very long text."""

import corpus_pipeline
import pytest

from pulseboard.llm import queries

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "labels", "benchmark", "embeddings", "conversations")
# The conversation that is always there.
ROWS = {"op6_chat": 1}


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name in TABLES:
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_empty_tables(spark, empty, name):
    found = queries.queries()[name](spark, empty)
    whole = queries.queries()[name]
    assert found.columns and callable(whole)
    assert found.count() == ROWS.get(name, 0)


def test_documents_without_labels(spark, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    labels.limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    scored = queries.op1_quality(spark, str(tmp_path))
    assert {(r.score, r.predicted) for r in scored.collect()} == {(0.5, 1)}
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.good_quality(spark, docs, str(tmp_path)).count() == docs.count()


@pytest.fixture(scope="module")
def long(spark, tmp_path_factory):
    """A text of 16 MB, half of it again in another document, and few short ones."""
    folder = str(tmp_path_factory.mktemp("long"))
    words = [f"word{i % 9973} and{i % 89}" + ("\n" if i % 11 == 0 else "") for i in range(1_000_000)]
    text = " ".join(words)
    assert len(text) > 15 << 20
    rows = [(1, text, "en", "s1", len(text)), (2, text[: len(text) // 2], "en", "s2", 0), (3, "short", "de", "s1", 5), (4, None, None, None, None)]
    schema = spark.read.parquet(f"{SF_DIR}/documents.parquet").schema
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    item = " ".join(words[5000:5020]).replace("\n", "")
    spark.createDataFrame([("b1", item)], "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


@pytest.mark.parametrize("name", ["op1_quality", "op2_spans", "op4_setjoin", "op5_language", "op9_contamination", "op10_lines", "op11_divergence", "op13_scoring"])
def test_very_long_texts(spark, long, name):
    rows = queries.queries()[name](spark, long).collect()
    if name == "op11_divergence":
        return
    found = {r.doc_id: r for r in rows}
    assert sorted(found) == [1, 2, 3, 4]
    if name in ("op2_spans", "op9_contamination"):
        assert found[1].n_words >= 2_000_000
    if name == "op9_contamination":
        assert found[1].contaminated and found[2].contaminated and not found[3].contaminated
    if name == "op13_scoring":
        assert found[1].n_tokens == 2_000_001 and found[4].n_tokens == 1
