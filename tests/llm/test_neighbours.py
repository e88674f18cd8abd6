import math

import numpy as np
import pytest

from pulseboard.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, rank string"


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(x) for x in v], "r") for i, v in zip(ids, vectors)], SCHEMA)


def found(frame):
    out = {}
    for r in frame.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: [x[1:] for x in sorted(rows)] for q, rows in out.items()}


def brute(vectors, ids, q, top):
    x = np.asarray(vectors, np.float32).astype(np.float64)
    scores = x @ x[q]
    order = sorted((-s, i) for k, (s, i) in enumerate(zip(scores, ids)) if i != ids[q])
    return [i for _, i in order[:top]]


@pytest.mark.parametrize("scaled", [False, True])
def test_recall(spark, scaled):
    """Vectors without any structure, in shards of a few hundred."""
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(1500, 32))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    if scaled:
        vectors *= rng.uniform(0.5, 1.5, size=(1500, 1))
    frame = table(spark, vectors)
    got = found(neighbours.nearest(frame, frame.where("vec_id % 20 = 0"), shard=500, beam=64))
    assert set(got) == set(range(0, 1500, 20))
    hits = [len({i for i, _ in rows} & set(brute(vectors, range(1500), q, 20))) for q, rows in got.items()]
    assert all(len(rows) == 20 for rows in got.values())
    assert np.mean(hits) / 20 >= 0.9
    x = vectors.astype(np.float32).astype(np.float64)
    for q, rows in list(got.items())[:5]:
        assert [s for _, s in rows] == pytest.approx([x[i] @ x[q] for i, _ in rows], abs=1e-12)


def recall(spark, vectors, every):
    """At production parameters."""
    frame = table(spark, vectors)
    got = found(neighbours.nearest(frame, frame.where(f"vec_id % {every} = 0")))
    hits = [len({i for i, _ in rows} & set(brute(vectors, range(len(vectors)), q, 20))) for q, rows in got.items()]
    assert len(got) == -(-len(vectors) // every)
    return np.mean(hits) / 20


@pytest.mark.parametrize("clusters", [50, 200])
def test_recall_of_clusters(spark, clusters):
    """Far clusters, whose nearest are all their own."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(clusters, 64))
    vectors = centres[rng.integers(0, clusters, 8192)] + 0.05 * rng.normal(size=(8192, 64))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    assert recall(spark, vectors, 40) >= 0.9


def test_recall_of_embeddings(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("embedding").collect()
    vectors = np.array([r.embedding for r in rows])
    assert recall(spark, vectors, 20) >= 0.9


def test_copies_ties_and_own_row(spark):
    vectors = [[1, 0], [1, 0], [1, 0], [0, 1], [0.5, 0.5]]
    got = found(neighbours.nearest(table(spark, vectors, [5, 3, 9, 1, 2]), top=3))
    assert [i for i, _ in got[5]] == [3, 9, 2]
    assert [i for i, _ in got[9]] == [3, 5, 2]
    assert [i for i, _ in got[1]] == [2, 3, 5]


def test_many_copies(spark):
    vectors = [[1.0, 0.0]] * 400 + [[0.0, 1.0]]
    got = found(neighbours.nearest(table(spark, vectors), top=20))
    assert [i for i, _ in got[50]] == list(range(20))
    assert [i for i, _ in got[3]] == [0, 1, 2, *range(4, 21)]


def test_rows_that_take_no_part(spark):
    rows = [
        (1, [1.0, 0.0], ""),
        (2, [0.0, 0.0], ""),
        (3, [math.nan, 1.0], ""),
        (4, [math.inf, 1.0], ""),
        (5, None, ""),
        (6, [None, 1.0], ""),
        (None, [1.0, 1.0], ""),
        (7, [1.0, 2.0, 3.0], ""),
        (8, [], ""),
        (9, [0.5, 0.5], ""),
        (9, [0.5, 0.5], ""),
    ]
    got = found(neighbours.nearest(spark.createDataFrame(rows, SCHEMA)))
    assert got == {1: [(9, 0.5)], 9: [(1, 0.5)]}


def test_empty_table(spark):
    assert neighbours.nearest(spark.createDataFrame([], SCHEMA)).collect() == []
