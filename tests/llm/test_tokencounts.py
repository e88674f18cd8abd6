import os
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from pulseboard.llm import queries, tokencounts
from tests.llm.tables import SF_DIR, docs, documents, odd_texts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def brute(tokens, separator):
    out, open_ = [], 0
    for t in tokens.tolist():
        if t == separator:
            out.append((open_, True))
            open_ = 0
        else:
            open_ += 1
    return out + [(open_, False)] * (open_ > 0)


@pytest.mark.parametrize("block", [1, 3, 64, 100_000])
@pytest.mark.parametrize("width", [2, 4])
def test_blocks_of_any_size(spark, tmp_path, block, width):
    rng = np.random.default_rng(1)
    files = {"a": 0, "b": 1, "c": 300, "d": 900}
    tokens = {}
    for name, n in files.items():
        x = rng.integers(0, 12, n).astype(f"<u{width}")
        if name == "d":
            x[200:600] = 5  # a document over many blocks
        tokens[name] = x
        x.tofile(str(tmp_path / name))
    found = {}
    for r in tokencounts.counts(spark, str(tmp_path), width=width, separator=2, block=block).collect():
        found.setdefault(os.path.basename(r.file), []).append((r.doc, r.n_tokens, r.terminated))
    for name, x in tokens.items():
        assert [f[1:] for f in sorted(found.get(name, []))] == brute(x, 2)
        assert [f[0] for f in sorted(found.get(name, []))] == list(range(len(found.get(name, []))))


def test_large_file(spark, tmp_path):
    """A file with holes of over 512 MB (the disk holds little of it); blocks are read by many tasks."""
    with open(tmp_path / "a file", "wb") as file:
        file.write(np.array([7, 2, 2, 9], "<u2").tobytes())
        file.seek((600 << 20) - 4)
        file.write(np.array([2, 9], "<u2").tobytes())
    found = tokencounts.counts(spark, str(tmp_path), width=2, separator=2).collect()
    tokens = 300 << 20
    assert sorted((r.doc, r.n_tokens, r.terminated) for r in found) == [
        (0, 1, True),
        (1, 0, True),
        (2, tokens - 5, True),
        (3, 1, False),
    ]
    told = tokencounts.blocks(spark, str(tmp_path), 2, tokencounts.BLOCK_TOKENS)
    assert told.count() == 1200 and told.groupBy(F.spark_partition_id()).count().count() > 4


def test_texts_as_flat_files(spark, tmp_path):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = odd_texts()
    path = str(tmp_path / "flat")
    width, end = tokencounts.write_flat(docs(spark, enumerate(texts)), path, MODEL)
    found = Counter(r.n_tokens for r in tokencounts.counts(spark, path, width=width, separator=end, block=50).collect())
    assert found == Counter(len(library.encode(t or "")) for t in texts)


def test_one_python_step(spark, tmp_path, monkeypatch):
    """Each Python step of a task has a worker of its own; texts go there in batches of bounded bytes."""
    plans, batches = [], []
    text = DataFrameWriter.text

    def kept(self, path):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        batches.append(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch"))
        text(self, path)

    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    monkeypatch.setattr(DataFrameWriter, "text", kept)
    tokencounts.write_flat(docs(spark, enumerate(odd_texts())), str(tmp_path / "flat"), MODEL)
    (plan,) = plans
    assert plan.count("MapInArrow") == 1
    assert batches == [str(tokencounts.BATCH_BYTES)]
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before


def test_query(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = queries.op3_tokencounts(spark, SF_DIR).collect()
    assert Counter(r.n_tokens for r in rows) == Counter(len(library.encode(r.text)) for r in documents(spark).collect())


def test_bad_files(spark, tmp_path):
    (tmp_path / "odd").write_bytes(b"abc")
    with pytest.raises(Exception, match="no flat token file"):
        tokencounts.counts(spark, str(tmp_path), width=2, separator=2)


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "flat")
    width, end = tokencounts.write_flat(docs(spark, []), path, MODEL)
    assert tokencounts.counts(spark, path, width=width, separator=end).collect() == []
