import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from pulseboard.llm import pieces
from tests.llm.tables import docs, documents, odd_texts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = (
    "  |a|the| |\n|\t|é|漢|😀|▁|<0x0A>|</s>|<s>|<unk>|\r|;\r|ing|\0|  \n|//|====|́|ß|e.g.|http://|1234|﻿|tion".split("|")
)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(pieces.read_vocabulary(MODEL))


def test_random_texts_as_the_library(library, encoder):
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12)))
        ids = np.frombuffer(encoder.encode(text), "<u4")
        assert ids.tolist() == library.encode(text)
        assert encoder.decode(ids) == library.decode(ids.tolist())


def test_any_ids_decode(encoder):
    # bytes that are no characters give U+FFFD each
    byte = {b: i for b, i in enumerate(pieces.read_vocabulary(MODEL).byte_ids)}
    assert encoder.decode(np.array([1, byte[0xE6], byte[0xBC], byte[0x41], 2])) == "��A"
    assert encoder.decode(np.array([], "<u4")) == ""


def test_one_very_long_word(library, encoder):
    text = "".join(random.Random(1).choice("abcdefé") for _ in range(20000))
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text)


def test_table_that_is_full(library, monkeypatch):
    monkeypatch.setattr(pieces, "TABLE_SIZE", 50)
    small = pieces.Encoder(pieces.read_vocabulary(MODEL))
    for text in odd_texts():
        assert np.frombuffer(small.encode(text or ""), "<u4").tolist() == library.encode(text or "")


def test_table_of_texts(spark, library):
    table = docs(spark, enumerate(odd_texts())).withColumnRenamed("lang", "ids").withColumnRenamed("source", "back")
    coded = pieces.encode(table, MODEL, decoded="back")
    assert sorted(coded.columns) == sorted(table.columns)
    for r in coded.collect():
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        assert np.frombuffer(r.ids, "<u4").tolist() == ids
        assert r.back == library.decode(ids)
    again = pieces.decode(coded.drop("text"), MODEL)
    assert {r.doc_id: r.text for r in again.collect()} == {r.doc_id: r.back for r in coded.collect()}


def test_narrow_ids_without_texts(spark, library):
    table = docs(spark, enumerate(odd_texts()))
    coded = pieces.encode(table, MODEL, decoded="back", keep_text=False, width=2)
    assert coded.columns == ["doc_id", "lang", "source", "n_chars", "ids", "back"]
    given = dict(enumerate(odd_texts()))
    for r in coded.collect():
        ids = library.encode(given[r.doc_id] or "", add_bos=True, add_eos=True)
        assert np.frombuffer(r.ids, "<u2").tolist() == ids
        assert r.back == library.decode(ids)
    with pytest.raises(ValueError, match="do not fit"):
        pieces.encode(table, MODEL, width=1)


def test_whole_table(spark, library):
    rows = pieces.encode(documents(spark), MODEL).collect()
    assert all(np.frombuffer(r.ids, "<u4").tolist() == library.encode(r.text, add_bos=True, add_eos=True) for r in rows)


def test_empty_table(spark):
    assert pieces.encode(docs(spark, []), MODEL).collect() == []


def test_workers_keep_no_tables_after_a_task(spark):
    table = docs(spark, [(i, f"word{i} and more text {i * i}") for i in range(2000)]).repartition(8)
    assert pieces.encode(table, MODEL).count() == 2000
    pieces.encode(table, MODEL).write.format("noop").mode("overwrite").save()

    def left(batches):
        import gc

        import pyarrow as pa

        for _ in batches:
            pass
        held = [len(o.table) + len(o.before) + len(o.compatible) for o in gc.get_objects() if isinstance(o, pieces.Encoder)]
        yield pa.RecordBatch.from_arrays([pa.array([sum(held)]), pa.array([len(held)])], names=["entries", "encoders"])

    rows = spark.range(64).repartition(8).mapInArrow(left, "entries long, encoders long").collect()
    assert sum(r.encoders for r in rows) > 0
    assert {r.entries for r in rows} == {0}
