import hashlib
import re

from pulseboard.llm import queries, spans
from tests.llm.tables import SF_DIR, by_id, docs, documents, odd_texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    """For each id: words, removed words, kept text."""
    words = {i: WORD.findall(t or "") for i, t in rows}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][k : k + window]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone |= set(range(k, k + window))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    expected = {
        i: (n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, (n, gone, kept) in brute(rows, 50).items()
    }
    found = by_id(queries.op2_spans(spark, SF_DIR), "n_words", "n_removed", "kept_sha256")
    assert found == expected
    assert sum(e[1] for e in expected.values()) > 0


def test_odd_rows_and_other_windows(spark):
    rows = list(enumerate(odd_texts()))
    table = docs(spark, rows).withColumnRenamed("source", "n_words")  # a name that clashes
    found = spans.dedup(table, window=25)
    assert found.columns.count("n_words") == 1
    expected = brute(rows, 25)
    got = by_id(found, "n_words", "n_removed", "text")
    assert {i: g[:2] for i, g in got.items()} == {i: e[:2] for i, e in expected.items()}
    assert got[0][2] is None
    assert all(got[i][2] == e[2] for i, e in expected.items() if i)


def test_rows_without_id_and_of_one_id(spark):
    text = " ".join(f"a{i}" for i in range(80))
    rows = [(None, text), (3, text), (3, text), (2, text + " more"), (None, text)]
    found = sorted((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in spans.dedup(docs(spark, rows)).collect())
    assert found == [(False, 2, 0), (False, 3, 80), (False, 3, 80), (True, 0, 0), (True, 0, 0)]


def test_empty_table(spark):
    assert spans.dedup(docs(spark, [])).collect() == []
