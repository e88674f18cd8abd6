import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pulseboard.llm import language, queries
from pulseboard.llm.texts import pieces
from tests.llm.tables import DOCS, docs, odd_texts


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = queries.op5_language(spark, sf_dir).join(
        spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id"
    ).collect()
    held_out = [r for r in rows if r.held_out]
    assert len(held_out) > 100
    assert np.mean([r.lang_pred == r.lang for r in held_out]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def kneser_ney(texts):
    """Probabilities of a symbol after others, straight from the definition."""
    def seq(text):
        out = [0]
        for c in text.lower():
            s = int(language._letters()[ord(c)])
            if s or out[-1]:
                out.append(s)
        return out

    grams = Counter()
    for t in texts:
        s = [0, 0, 0, *seq(t)]
        for i in range(4, len(s)):
            grams[tuple(s[i - 3 : i + 1])] += 1
    levels = [grams]
    for _ in range(3):
        levels.insert(0, Counter(g[1:] for g in levels[0]))

    def p(g):
        own = levels[len(g) - 1]
        ones, twos = (sum(v == k for v in own.values()) for k in (1, 2))
        d = min(max(ones / (ones + 2 * twos) if ones else 0.5, 0.1), 0.95)
        if len(g) == 1:
            n = sum(own.values())
            return max(own[g] - d, 0) / n + d * len(own) / n / (len(own) + 1)
        mass = sum(v for k, v in own.items() if k[:-1] == g[:-1])
        kinds = sum(k[:-1] == g[:-1] for k in own)
        if not mass:
            return p(g[1:])
        return max(own[g] - d, 0) / mass + d * kinds / mass * p(g[1:])

    return seq, p


def test_probabilities_are_kneser_ney(spark):
    texts = ["abra kadabra", "aber barbara", "Arab. bar!"]
    rows = [(i, t, "xx", "s", 0) for i, t in enumerate(texts)]
    model = language.fit(spark.createDataFrame(rows, DOCS))
    seq, p = kneser_ney(texts)
    for text in ("abra kadabra", "zebra", "rabarber bar"):
        (piece,) = pieces(pa.array([text]))
        found, letters = language.entropies(model, piece)
        s = [0, 0, 0, *seq(text)]
        logs = [math.log(p(tuple(s[i - 3 : i + 1]))) for i in range(4, len(s))]
        assert letters[0] and found[0, 0] == pytest.approx(-sum(logs) / len(logs), rel=1e-4)


def exactly(texts, model, text):
    seq, p = kneser_ney(texts)
    (piece,) = pieces(pa.array([text]))
    found, _ = language.entropies(model, piece)
    s = [0, 0, 0, *seq(text)]
    logs = [math.log(p(tuple(s[i - 3 : i + 1]))) for i in range(4, len(s))]
    return found[0, 0] == pytest.approx(-sum(logs) / len(logs), rel=1e-4)


def test_no_sequence_is_left_out(spark):
    """More different sequences of a language than any fixed bound so far."""
    rng = np.random.default_rng(3)
    text = "".join(map(chr, rng.integers(0x4E00, 0x9F00, 260_000)))
    model = language.fit(spark.createDataFrame([(1, text, "zh", "s", 0)], DOCS))
    seq, _ = kneser_ney([""])
    s = [0, 0, 0, *seq(text)]
    kinds = len({tuple(s[i - 3 : i + 1]) for i in range(4, len(s))})
    assert kinds > 250_000
    stored = spark.read.parquet(model.files[language.ORDER][2][0].rsplit("/", 1)[0])
    assert stored.where(f"kind = {language.ORDER}").count() == kinds
    assert exactly([text], model, text[100:106] + "\u4e00\u4e01")


def test_models_in_many_files(spark, monkeypatch):
    monkeypatch.setattr(language, "ROWS_A_FILE", 5)
    monkeypatch.setattr(language, "CACHE_BYTES", 500)
    texts = ["abra kadabra", "aber barbara", "Arab. bar! \U00020000\uff41"]
    rows = [(i, t, "xx", "s", 0) for i, t in enumerate(texts)] + [(9, "zebra abrakadabra", "yy", "s", 0)]
    model = language.fit(spark.createDataFrame(rows, DOCS))
    assert len(model.files[language.ORDER][2]) > 5
    for text in (*texts, "zebra \uff41", "rabarber bar"):
        assert exactly(texts, model, text.lower())


def test_odd_rows(spark):
    rows = [(1, "der die das und ist", "de"), (2, "the and that this is", "en"), (3, "nichts", None), (None, "the this", "en")]
    table = spark.createDataFrame([(i, t, x, "s", 0) for i, t, x in rows], DOCS)
    model = language.fit(table)
    assert model.languages == ("de", "en")
    odd = docs(spark, [*enumerate(odd_texts()), (100, "123 !!"), (101, "THAT THIS")]).withColumnRenamed("source", "score")
    found = {r.doc_id: r for r in language.predict(odd, model).collect()}
    assert len(found) == odd.count()
    assert (found[0].lang_pred, found[0].score) == ("und", 0.0) == (found[1].lang_pred, found[1].score)
    assert found[100].lang_pred == "und" and found[100].rejected
    assert found[101].lang_pred == "en"
    assert language.predict(docs(spark, []), model).collect() == []
    nothing = language.fit(docs(spark, [(1, "12"), (2, None)]))
    assert {(r.lang_pred, r.score) for r in language.predict(odd, nothing).collect()} == {("und", 0.0)}


def test_calibrated_on_all_labelled_texts(spark):
    """More different texts than any fixed sample so far; copies count once."""
    rng = np.random.default_rng(5)
    known = {"aa": "abcdefgh", "bb": "efghijkl"}
    rows = []
    for i in range(3000):
        lang = "aa" if i % 3 else "bb"
        letters = known[lang] if i % 50 else "mnopqrst"
        rows.append((" ".join("".join(rng.choice(list(letters), 4)) for _ in range(rng.integers(1, 9))), lang))
    table = [*rows, *rows[:500], (None, "aa"), ("abc", None), ("12", "bb")]
    model = language.fit(spark.createDataFrame([(i, t, x, "s", 0) for i, (t, x) in enumerate(table)], DOCS))
    different = sorted(set(rows))
    assert len(different) > 2500
    found = np.concatenate([language.entropies(model, p)[0] for p in pieces(pa.array([t for t, _ in different]))])
    right = np.array([model.languages.index(x) for _, x in different])
    loss = [np.mean(np.log(np.exp(-k * (found - found.min(1, keepdims=True))).sum(1)) + k * (found[np.arange(len(found)), right] - found.min(1))) for k in language.SHARPNESS]
    assert model.sharpness == language.SHARPNESS[int(np.argmin(loss))]
    for i in range(2):
        own = found[(right == i) & (found.argmin(1) == i), i]
        assert model.limits[i] == pytest.approx(np.quantile(own, language.REJECTED) + own.std(), rel=1e-9)
