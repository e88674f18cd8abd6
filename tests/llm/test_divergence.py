import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from pulseboard.llm import divergence, queries
from tests.llm.tables import DOCS

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def brute(rows, least=30, smoothing=5, top=50):
    """The audit straight from its definition; rows are (text, lang, source)."""
    words = [
        (re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), l or "", s or "")
        for t, l, s in rows
    ]
    out = []
    for lang in {l for _, l, _ in words}:
        own = [(w, s) for w, l, s in words if l == lang]
        documents = Counter(t for w, _ in own for t in set(w))
        kept = [t for t in documents if documents[t] >= least]
        count = defaultdict(Counter)
        for w, s in own:
            count[s].update(w)
        everything = Counter(t for w, _ in own for t in w)

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + smoothing) // (total + smoothing * len(kept)) for t in kept}

        share, common = {s: shares(c) for s, c in count.items()}, shares(everything)
        for s in share:
            pairs = [(sum(abs(share[s][t] - share[o][t]) for t in kept), o) for o in share if o != s]
            stand = [(share[s][t] - common[t], t) for t in kept if count[s][t] and share[s][t] > common[t]]
            for part, found, limit in (("pair", pairs, None), ("term", stand, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, i + 1) for i, (v, item) in enumerate(found[:limit])]
    return sorted(out)


def audited(spark, rows, **options):
    table = spark.createDataFrame([(i, *r, 0) for i, r in enumerate(rows)], DOCS)
    found = divergence.audit(table, **options)
    assert found.columns == COLUMNS
    return sorted(tuple(r) for r in found.collect())


def odd_rows(n=400):
    rng = random.Random(3)
    words = ["the", "The", "ÉCOLE", "école", "a1b", "don't", "日本", "x" * 50, "Zz", "zz", "q"]
    rows = [(" ".join(rng.choice(words) for _ in range(rng.randint(0, 40))), rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", None, "S", "ü"])) for _ in range(n)]
    rows += [(None, "en", "silent"), ("", "fr", "s1"), ("123 456", "fr", "s2"), (" ".join(["long"] * 200_000), "en", "s1")]
    return rows + rows[:20]


@pytest.mark.parametrize("least", [1, 30, 10_000])
def test_against_brute_force(spark, least):
    rows = odd_rows()
    assert audited(spark, rows, min_docs=least, top=3) == brute(rows, least, top=3)


def test_blocks_chunks_and_handed_on_counts(spark, monkeypatch):
    monkeypatch.setattr(divergence, "CELLS", 3)
    monkeypatch.setattr(divergence, "CHUNK", 2)
    monkeypatch.setattr(divergence, "HELD", 4)
    rows = odd_rows(150)
    assert audited(spark, rows, min_docs=2) == brute(rows, 2)


def test_empty_and_clashing(spark):
    assert audited(spark, []) == []
    table = spark.createDataFrame([("a b", "en", "s1", 1, "x"), ("a", "en", "s2", 2, "y")], "text string, lang string, source string, term int, n string")
    assert {(r.source, r.item, r.value) for r in divergence.audit(table).collect()} == {("s1", "s2", 0), ("s2", "s1", 0)}


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    found = queries.op11_divergence(spark, sf_dir)
    expected = con.sql(queries.oracle_sql()["op11_divergence"])
    assert found.columns == expected.columns
    assert sorted(map(tuple, found.collect())) == sorted(expected.fetchall())
