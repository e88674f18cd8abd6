import os

import numpy as np
import pytest

from pulseboard.llm import quality, queries
from pulseboard.llm.texts import pieces
from pulseboard.sources.scratch import shared_folder
from tests.llm.tables import docs, odd_texts

import pyarrow as pa


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = queries.op1_quality(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").collect()
    held_out = [r for r in rows if r.held_out]
    assert len(held_out) > 50
    assert np.mean([r.predicted == r.quality for r in held_out]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def chain_by_enumeration(model, odds):
    """The marginals of a short chain from all label sequences."""
    n = len(odds)
    total, good = 0.0, np.zeros(n)
    for code in range(2**n):
        y = [code >> i & 1 for i in range(n)]
        weight = np.exp(sum(o for o, v in zip(odds, y) if v) + sum(model.pairs[a, b] for a, b in zip(y, y[1:])))
        total += weight
        good += weight * np.array(y)
    return good / total


def test_marginals_are_those_of_the_chain():
    rng = np.random.default_rng(2)
    size = 3 * quality.FEATURES * quality.BINS
    model = quality.Model(np.append(rng.normal(size=size) * 0.3, 0.0), rng.normal(size=(2, 2)))
    texts = ["a\nB!!\n\n%%% %%%\na a a a", "one", "", "x\ny", None]
    (piece,) = pieces(pa.array(texts))
    bins, _, offsets = quality.line_bins(piece)
    assert np.diff(offsets).tolist() == [5, 1, 1, 2, 1]
    odds = model.weights[quality._indexes(bins, offsets)].sum(1)
    found = quality.marginals(model, bins, offsets)
    for a, b in zip(offsets, offsets[1:]):
        assert found[a:b] == pytest.approx(chain_by_enumeration(model, odds[a:b]))


def test_odd_rows(spark):
    table = docs(spark, [*enumerate(odd_texts()), (None, "a"), (3, "b")])
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (1, None), (2, 7)], "doc_id long, quality int")
    model = quality.fit(table, labels)
    scored = quality.score(table.withColumnRenamed("lang", "score"), model)
    assert scored.columns.count("score") == 1
    rows = scored.collect()
    assert len(rows) == table.count()
    assert all(0 <= r.score <= 1 for r in rows)
    assert quality.score(docs(spark, []), model).collect() == []
    one_kind = quality.fit(table, labels.where("quality = 1"))
    assert {r.score for r in quality.score(table, one_kind).collect()} == {0.5}


def test_sample_is_bounded(spark):
    table = docs(spark, [(i, f"line {i}\n" * 30 if i % 2 else "%% %%\n" * 30) for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    model = quality.fit(table, labels, max_docs=20, max_lines=300)
    rows = {r.doc_id: r.score for r in quality.score(table, model).collect()}
    assert all((rows[i] > 0.5) == bool(i % 2) for i in rows)


def test_fit_counts_lines_without_a_side_table(spark):
    texts = ["a\nb\n", "", None, "\n\n\n", "é\r\nx", "one line"]
    table = docs(spark, [*enumerate(texts * 20)]).repartition(9)
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, quality int")
    folder = shared_folder(spark).removeprefix("file:")
    os.makedirs(folder, exist_ok=True)
    before = set(os.listdir(folder))
    # 240 lines in all: no sample of rows, but of runs for the smaller limit
    model, whole = (quality.fit(table, labels, max_lines=n) for n in (120, 240))
    assert set(os.listdir(folder)) == before
    again = quality.fit(table.repartition(2), labels, max_lines=120)
    assert np.array_equal(model.weights, again.weights) and not np.array_equal(model.weights, whole.weights)
