import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from pulseboard.llm import codes, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Every part against every entry, with Python's whole numbers."""
    rows = [(i, [math.floor(scale * x) for x in v], y) for i, v, y in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    rows.sort(key=lambda r: (r[0] is None, r[0]))
    if not rows:
        return [], ""
    size = len(rows[0][1]) // parts
    cut = [[v[p * size : (p + 1) * size] for p in range(parts)] for _, v, _ in rows]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assign():
        return [
            [min((sum((a - b) ** 2 for a, b in zip(c[p], entry)), i) for i, entry in enumerate(books[p])) for p in range(parts)]
            for c in cut
        ]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for i in range(len(books[p])):
                own = [c[p] for c, f in zip(cut, found) if f[p][1] == i]
                if own:
                    books[p][i] = [sum(x) // len(own) for x in zip(*own)]
    found = assign()
    error = [sum(d for d, _ in f) for f in found]
    total = {y: sum(e for e, r in zip(error, rows) if r[2] == y) for _, _, y in rows}
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, bytes(k for _, k in f).hex(), e, total[y]) for (i, _, y), f, e in zip(rows, found, error)), key=str), digest


def compressed(spark, rows, schema=SCHEMA, **options):
    found = codes.compress(spark.createDataFrame(rows, schema), **options)
    told = codes.label_errors(found.rows).collect()
    return sorted(((r.id, bytes(r.code).hex(), r.error, r.label_error) for r in told), key=str), found.digest


def vectors(n, size=16, seed=1, spread=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, spread) for _ in range(size)] for _ in range(9)]
    return [(i, [float(np.float32(c + rng.gauss(0, 0.05))) for c in rng.choice(centres)], rng.choice([0, 1, None])) for i in range(n)]


def test_against_brute_force(spark):
    rows = vectors(300)
    rows += [(1000, None, 1), (1001, [None] * 16, 1), (1002, [math.nan] * 16, 1), (1003, [1.0] * 15 + [math.inf], 1)]
    rows += [(i + 2000, v, y) for i, v, y in rows[:100]] + [(None, rows[3][1], 2)]
    random.Random(4).shuffle(rows)
    assert compressed(spark, rows) == brute(rows)


def test_ties_keep_the_lower_index(spark):
    """A grid of few values, where many entries are equally near and many are the same."""
    rng = random.Random(2)
    rows = [(i, [rng.randint(-2, 2) / 4096 for _ in range(16)], 0) for i in range(400)]
    assert compressed(spark, rows) == brute(rows)
    same = [(i, [0.5] * 16, None) for i in range(40)]
    assert compressed(spark, same) == brute(same)


def test_few_rows_and_other_sizes(spark):
    assert compressed(spark, []) == ([], hashlib.sha256(b"").hexdigest())
    rows = vectors(5)
    assert compressed(spark, rows) == brute(rows)
    assert compressed(spark, vectors(60, 12), parts=4, entries=7, rounds=3) == brute(vectors(60, 12), 4, 7, 3)
    doubles = [(i, [x + 1e-9 for x in v], y) for i, v, y in vectors(50)]
    assert compressed(spark, doubles, SCHEMA.replace("float", "double")) == brute(doubles)


def test_active_entries_give_what_a_full_scan_gives():
    rng = np.random.default_rng(0)
    parts = rng.integers(-3, 4, (500, 2, 2))
    before = rng.integers(-3, 4, (2, 6, 2))
    code, distance = codes.nearest(parts, before)
    for _ in range(30):
        after = np.where(rng.random((2, 6, 1)) < 0.3, rng.integers(-3, 4, before.shape), before)
        found = codes.nearest(parts, after, (after != before).any(-1), code, distance)
        full = codes.nearest(parts, after)
        assert all((a == b).all() for a, b in zip(found, full, strict=True))
        before, (code, distance) = after, found


def test_refused(spark):
    with pytest.raises(ValueError):
        compressed(spark, [(1, [0.0] * 12, 0)])
    with pytest.raises(Exception, match="one length"):
        compressed(spark, [(1, [0.0] * 16, 0), (2, [0.0] * 8, 0)])
    with pytest.raises(Exception, match="too large"):
        compressed(spark, [(1, [1e30] * 16, 0)])


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    found = queries.op12_codes(spark, sf_dir)
    expected = con.sql(queries.OP12_SQL)
    assert found.columns == expected.columns
    assert sorted(map(tuple, found.collect())) == sorted(expected.fetchall())
