import random
import re

import numpy as np
import pytest

from pulseboard.llm import setjoin
from tests.llm.tables import docs, documents, odd_texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, size, percent):
    sets = {}
    for i, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        shingles = [tuple(w[k : k + size]) for k in range(len(w) - size + 1)] or [tuple(w)]
        sets[i] = {s for s in shingles if s}
    near = {
        i: [
            j
            for j in sets
            if i != j and sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
        ]
        for i in sets
    }
    out = {}
    for i in sets:
        seen, open_ = {i}, [i]
        while open_:
            for j in near[open_.pop()]:
                if j not in seen:
                    seen.add(j)
                    open_.append(j)
        out[i] = (len(sets[i]), min(seen), len(near[i]))
    return out


def found(table, **rule):
    rows = setjoin.groups(table, **rule).collect()
    links, of = setjoin.links(table, **rule)
    sets = {r["_id"]: (r["set"], r.copies) for r in of.collect()}
    copies = dict(sets.values())
    n_links = {s: copies[s] - 1 for s in copies}
    for a, b in links.collect():
        n_links[a] += copies[b]
        n_links[b] += copies[a]
    assert len(rows) == len({r["_id"] for r in rows})
    return {r["_id"]: (r.n_shingles, r.component_id, n_links[sets[r["_id"]][0]] if r["_id"] in sets else 0) for r in rows}


def edited(seed):
    """Copies of some texts with a few words changed, of few and of many words."""
    rng = random.Random(seed)
    texts = odd_texts(seed)
    for size in (4, 9, 10, 18, 19, 20, 40, 150, 400):
        base = [f"b{rng.randrange(10**6)}" for _ in range(size)]
        for edits in (0, 0, 1, 1, 2, 3, 8):
            own = list(base)
            for _ in range(edits):
                own[rng.randrange(size)] = f"e{rng.randrange(10**6)}"
            texts.append(" ".join(own[rng.randrange(2) :]))
    return list(enumerate(texts))


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80), (1, 90)])
def test_against_brute_force(spark, size, percent):
    rows = edited(size)
    expected = brute(rows, size, percent)
    assert found(docs(spark, rows), shingle=size, percent=percent) == expected
    assert len({e[1] for e in expected.values()}) < len(rows) - 10


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    assert found(documents(spark), shingle=3, percent=90) == brute(rows, 3, 90)


def test_lists_in_blocks_and_small_batches(spark, monkeypatch):
    """A group that is cut into blocks has the same links."""
    rng = random.Random(1)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(90):
        own = list(base)
        for _ in range(rng.randrange(5)):
            own[rng.randrange(120)] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    monkeypatch.setattr(setjoin, "BLOCK", 16)
    assert found(docs(spark, rows), shingle=3, percent=90) == brute(rows, 3, 90)


def test_odd_rows(spark):
    text = "a b c d e f g h i j k l m n"
    rows = [(4, text), (4, text), (2, text.upper()), (None, text), (None, None), (7, None), (8, "")]
    got = sorted(
        (r["_id"] or -1, r.n_shingles, -1 if r.component_id is None else r.component_id)
        for r in setjoin.groups(docs(spark, rows), shingle=3, percent=90).collect()
    )
    assert got == [(-1, 0, -1), (-1, 12, 2), (2, 12, 2), (4, 12, 2), (4, 12, 2), (7, 0, 7), (8, 0, 8)]
    kept = setjoin.keep_first(docs(spark, rows), shingle=3, percent=90)
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 2, 7, 8]
    assert kept.columns == docs(spark, rows).columns


def test_one_row_of_a_group_stays_whatever_its_ids(spark):
    base = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    rows = [(1, base), (1, base + " x"), (2, "y " + base), (None, other), (None, other), (None, other + " z"), (9, "alone")]
    kept = setjoin.keep_first(docs(spark, rows)).collect()
    assert sorted((r.doc_id or -1) for r in kept) == [-1, 1, 9]
    groups = setjoin.groups(docs(spark, rows)).collect()
    assert sorted(str(r.component_id) for r in groups) == ["1", "1", "1", "9", "None", "None", "None"]


def test_groups_of_near_copies_take_few_comparisons(spark, monkeypatch):
    """What is compared grows with a group's size, not with its square."""
    rng = random.Random(7)
    base = [f"b{i}" for i in range(200)]
    asked = []
    verified = setjoin.verified

    def counted(pairs, *args):
        asked.append(pairs.count())
        return verified(pairs, *args)

    monkeypatch.setattr(setjoin, "verified", counted)
    for size in (100, 400):
        rows = []
        for i in range(size):
            own = list(base)
            own[rng.randrange(200)] = f"e{i}"
            rows.append((i, " ".join(own)))
        asked.clear()
        assert {r.component_id for r in setjoin.groups(docs(spark, rows)).collect()} == {0}
        assert sum(asked) < 12 * size


def test_empty_table(spark):
    assert setjoin.groups(docs(spark, [])).collect() == []


def test_long_chain_of_links(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001)], "a long, b long")
    rows = setjoin.components(links).collect()
    assert len(rows) == 203
    assert len({r.component for r in rows if r.v <= 200}) == 1
    assert len({r.component for r in rows}) == 2


def test_large_sets_are_compared_only_if_long_sketches_allow_it(spark, monkeypatch):
    """Half of each text is in all texts, so that large sets share lists; few of them link."""
    rng = random.Random(11)
    half = [f"h{rng.randrange(10**6)}" for _ in range(1500)]
    rows = [(i, " ".join(half + [f"o{rng.randrange(10**9)}" for _ in range(1500)])) for i in range(12)]
    rows += [(20, rows[3][1] + " end"), (21, rows[7][1].replace(" h", " changed h", 40))]
    pairs = []
    verified = setjoin.verified
    monkeypatch.setattr(setjoin, "verified", lambda p, *rest: pairs.append(p.count()) or verified(p, *rest))
    assert found(docs(spark, rows), shingle=5, percent=80) == brute(rows, 5, 80)
    assert sum(pairs) <= 8


@pytest.mark.parametrize("n, m, common", [(600, 700, 500), (1024, 1025, 1000), (3000, 2500, 2400), (513, 5000, 0)])
def test_long_sketches_never_tell_more_than_the_difference(n, m, common):
    rng = np.random.default_rng(n)
    values = np.unique(rng.integers(0, 1 << 63, n + m, dtype=np.uint64))
    rng.shuffle(values)
    a, b = values[:n], np.concatenate([values[:common], values[n : n + m - common]])
    sketches = setjoin._long_sketches(np.concatenate([a, b]), np.array([0, n, n + m]))
    x, y = (np.frombuffer(s, np.uint64) for s in sketches)
    apart = setjoin._parities_apart(x, y)
    assert apart <= n + m - 2 * common and (apart - n - m) % 2 == 0
    assert setjoin._long_sketches(a[:512], np.array([0, 512])) == [None]


def test_a_set_on_many_lists_is_compared_with_few_hubs(spark):
    rng = random.Random(5)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for i in range(60):
        own = list(base)
        own[rng.randrange(200)] = f"e{i}"
        rows.append((i, " ".join(own)))
    _, classes, rule, lists = setjoin._prepared(docs(spark, rows), "doc_id", "text", 5, 80)
    assert lists.count() > 600
    lists = setjoin.open_lists(lists, None)
    assert 60 < setjoin._with_hubs(lists, classes, rule, False).count() <= 4 * 60
    # The text that all were made of is on most lists, and all are compared with it.
    rows.append((99, " ".join(base)))
    _, classes, rule, lists = setjoin._prepared(docs(spark, rows), "doc_id", "text", 5, 80)
    pairs = setjoin._with_hubs(setjoin.open_lists(lists, None), classes, rule, True).collect()
    middle = classes.where("doc = 99").first().h1
    assert len(pairs) == 60 and all(middle in (p.a, p.b) for p in pairs)
