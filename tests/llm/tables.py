"""Small tables for the tests: whole given ones, and some with odd rows."""

import random

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, sf_dir=SF_DIR):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def docs(spark, rows):
    """(id, text) rows as documents."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def by_id(frame, *columns):
    return {r[0]: tuple(r[c] for c in columns) for r in frame.collect()}


def odd_texts(seed=5):
    """Texts from few words, so that they repeat each other, with empty and null ones."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(6)] + ["Ünï", "x\ty", "…"]
    texts = [None, "", " ", "\n\n\n", "one", "one two"]
    for _ in range(40):
        texts.append(" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))))
    passage = " ".join(rng.choice(words) + str(rng.random()) for _ in range(70))
    texts += [passage, f"a {passage} b", passage + " end", passage, passage[:300] + " cut " + passage[300:]]
    texts += [" ".join(f"t{i}" for i in range(3000)), " ".join(f"t{i}" for i in range(2950))]
    return texts
