import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulseboard.llm import bilinear, queries, scoring
from tests.llm.tables import docs, odd_texts

LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def cut(text):
    return [*(text or "").encode().translate(LOWER).split(), b""]


def brute(rows, learned):
    """(tokens, known, training tokens, base score) of each text, from the definition."""
    count = Counter(t for i, text in rows if learned(i) for t in cut(text))
    total, kinds = sum(count.values()), len(count)
    return [
        (
            i,
            len(cut(text)),
            sum(count[t] > 0 for t in cut(text)),
            total,
            pytest.approx(sum(math.log10((count[t] + 1) / (total + kinds + 1)) for t in cut(text)), rel=1e-12, abs=1e-12),
        )
        for i, text in rows
    ]


def scored(spark, rows, learned, **options):
    table = docs(spark, rows)
    found = scoring.score(table.select("doc_id", "text"), learned, **options).collect()
    return sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found), key=str)


@pytest.mark.parametrize("common", [1 << 18, 12, 0])
def test_counts_and_base_against_brute_force(spark, common, monkeypatch):
    """All tokens at hand, few of them, none: what is not at hand is looked up."""
    monkeypatch.setattr(scoring, "HELD", 50)
    rows = list(enumerate(odd_texts()))
    found = scored(spark, rows, F.col("doc_id") % 3 != 1, words=8, common=common, rounds=2)
    expected = brute(rows, lambda i: i % 3 != 1)
    assert sorted(r[:5] for r in found) == sorted(expected, key=lambda r: r[0])
    assert all(r[5] < 0 and math.isfinite(r[5]) for r in found)


@pytest.mark.parametrize("common", [1000, 5])
def test_shares_within_classes_add_up_to_one(spark, common):
    """Of the tokens of a class that are no units of their own, and one that is not known."""
    table = docs(spark, list(enumerate(odd_texts())))
    counted = scoring.written(scoring.counts(table), "tokens")
    vocabulary = scoring._vocabulary(counted, 4, common)
    spoken = sorted(vocabulary.places, key=vocabulary.places.get)[:4]
    shares = np.zeros(scoring.CLASSES)
    for row in counted.collect():
        if bytes(row.token) not in spoken:
            at = scoring._class_of(bytes(row.token))
            shares[at] += (row.n + 1) / vocabulary.classes[at]
    assert np.allclose(shares + 1 / vocabulary.classes, 1)
    assert len(vocabulary.places) <= common


def test_scorer_is_normalised():
    rng = np.random.default_rng(0)
    frequency = rng.random(12)
    parameters = bilinear.initial(frequency / frequency.sum(), 5)
    parameters.flat[:] = rng.normal(0, 2, len(parameters.flat))
    scorer = bilinear.Scorer(parameters)
    contexts, targets, biases, places = parameters.views
    for one in range(13):
        for two in range(13):
            logits = (contexts[one] * places[0] + contexts[two] * places[1]).astype(float) @ targets.T + biases
            logits -= np.log(np.exp(logits - logits.max()).sum()) + logits.max()
            assert np.allclose(scorer.one[one] + scorer.two[two] - scorer.whole[one, two], logits, atol=1e-4)
            assert abs(np.exp(scorer.one[one] + scorer.two[two] - scorer.whole[one, two]).sum() - 1) < 1e-9


def test_contexts_stay_within_texts():
    units, offsets = np.array([3, 4, 5, 6, 7, 8]), np.array([0, 1, 1, 3, 6])
    one, two = bilinear.contexts_of(units, offsets, 9)
    assert one.tolist() == [9, 9, 4, 9, 6, 7] and two.tolist() == [9, 9, 9, 9, 9, 6]
    assert [x.tolist() for x in bilinear.contexts_of(units[:1], np.array([0, 1]), 9)] == [[9], [9]]
    assert [x.tolist() for x in bilinear.contexts_of(units[:0], np.array([0, 0]), 9)] == [[], []]


def test_training_learns_what_follows():
    rng = np.random.default_rng(1)
    units = np.tile([0, 1, 2, 3, 4, 5, 6, 7], 4000)
    frequency = np.full(8, 1 / 8)
    parameters = bilinear.initial(frequency)
    offsets = np.arange(0, len(units) + 1, 400)
    before = bilinear.Scorer(parameters).logs(units, offsets).mean()
    for _ in range(3):
        bilinear.train(parameters, units, offsets, frequency, rng)
    after = bilinear.Scorer(parameters).logs(units, offsets).mean()
    assert before == pytest.approx(-np.log(8), abs=0.01) and after > -1


def test_empty_tables_and_nothing_to_learn_from(spark):
    assert scored(spark, [], F.lit(True)) == []
    found = scored(spark, [(1, None), (2, "a b"), (2, "a b")], F.lit(False))
    assert [r[:4] for r in found] == [(1, 1, 0, 0), (2, 3, 0, 0), (2, 3, 0, 0)]
    assert all(r[4] == 0 and math.isfinite(r[5]) for r in found)
    assert found[1] == found[2]


def test_clashing_columns_are_replaced(spark):
    table = spark.createDataFrame([(1, "a b", 5, "x")], "doc_id long, text string, score long, extra string")
    found = scoring.score(table, F.lit(True), keep_text=True, rounds=1)
    assert found.columns == ["doc_id", "text", "extra", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    row = found.first()
    assert (row.text, row.extra, row.n_tokens, row.n_known) == ("a b", "x", 3, 3)


def test_held_out_texts_are_likelier_than_by_frequency(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = queries.op13_scoring(spark, sf_dir).collect()
    assert len(rows) == 1000
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
    own = [r for r in rows if r.held_out]
    tokens = sum(r.n_tokens for r in own)
    assert len(own) > 100
    assert sum(r.score for r in own) / tokens > sum(r.base_score for r in own) / tokens + 0.1
