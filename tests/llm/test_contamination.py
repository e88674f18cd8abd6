import re

from pulseboard.llm import contamination
from pulseboard.llm.lines import with_keys
from tests.llm.tables import by_id, docs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items, size):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(str(item))
    out = {}
    for i, text in rows:
        w, hit, names = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    names |= windows[tuple(w[k : k + n])]
        out[i] = (len(w), len(hit), len(names), sorted(names), bool(hit))
    return out


def run(spark, rows, items, size=4):
    table = spark.createDataFrame(items, "item_id long, text string")
    return contamination.check(docs(spark, rows), table, size=size)


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog"),
    (2, "quick-brown fox JUMPS"),
    (10, "solo"),
    (3, "two words"),
    (4, ""),
    (5, None),
    (6, "ÉTÉ été 42 der, die"),
    (7, "a a a a a a"),
    (8, "the quick brown fox"),
]
ROWS = [
    (1, "see the QUICK (brown) fox; jumps over it"),
    (2, "solo solo"),
    (3, "these two  words"),
    (4, None),
    (5, ""),
    (6, "ÉTÉ été 42 der die"),
    (7, "a a a a a b a a a a"),
    (8, "nothing at all"),
    (9, "fox jumps over the lazy dog the quick brown fox jumps over the lazy dog" * 50),
    (10, "..."),
]


def test_against_brute_force(spark):
    found = by_id(run(spark, ROWS, ITEMS), "n_words", "n_hit", "n_items", "items", "contaminated")
    assert found == brute(ROWS, ITEMS, 4)


def test_repeated_null_and_clashing(spark):
    table = docs(spark, [(1, "x the quick brown fox"), (1, "x the quick brown fox"), (None, "two words"), (1, "other")])
    table = table.withColumnRenamed("lang", "n_hit").withColumnRenamed("source", "items")
    items = spark.createDataFrame([*ITEMS, (1, ITEMS[0][1]), (None, "other")], "item_id long, text string")
    rows = contamination.check(table, items, size=4).collect()
    assert sorted((r.doc_id or 0, r.n_hit, r.n_items) for r in rows) == [(0, 2, 1), (1, 0, 0), (1, 4, 2), (1, 4, 2)]


def test_no_items_no_documents(spark):
    assert [r.n_hit for r in run(spark, ROWS, []).collect()] == [0] * len(ROWS)
    assert run(spark, [], ITEMS).collect() == []


def test_near(spark):
    keyed = with_keys(docs(spark, [(1, "p q x x x r s"), (2, "r s p q"), (3, "p q")]))
    terms = spark.createDataFrame([("p q",), ("r s",)], "t string").selectExpr(
        "xxhash64(2, split(t, ' ')[0], split(t, ' ')[1]) AS term", "2L AS length"
    )
    postings = contamination.index(keyed, terms)
    left, right = terms.limit(1), terms.subtract(terms.limit(1))
    ids = lambda n: sorted(r["_id"] for r in contamination.near(postings, left, right, n).collect())
    assert ids(5) == [1, 2]
    assert ids(2) == [2]


def test_words_are_cut_once_and_no_text_is_moved(spark):
    """In the index's plan and in the last join."""
    table = docs(spark, [(1, "a b c d e f g h i j k l"), (2, None), (3, "x")])
    items = spark.createDataFrame([("i", "b c d e f g h i j k"), ("j", "x")], "item_id string, text string")
    terms = contamination._terms(contamination.windows(items))
    keyed = contamination.with_keys(table)
    plans = []
    write = contamination.written

    def seen(frame, name):
        if name == "postings":
            plans.append(frame._jdf.queryExecution().optimizedPlan().toString())
        return write(frame, name)

    contamination.written = seen
    try:
        contamination.index(keyed, terms.where("length > 1"))
    finally:
        contamination.written = write
    assert len(plans) == 1 and plans[0].count("regexp_extract_all") == 1
    found = contamination.check(table, items, keep_text=False)
    assert "text" not in found.columns
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in found.collect()} == {1: (12, 10, ["i"]), 2: (0, 0, []), 3: (1, 1, ["j"])}
