"""The number of leaves follows the number of vectors; recall holds with many leaves."""

import numpy as np

from revlens.llm import op04_neighbours as op4


def test_leaves_follow_the_table():
    assert op4.choose_leaves(100) == (256, 20_000) and op4.choose_leaves(1_000_000) == (256, 20_000)
    assert op4.choose_leaves(10_000_000) == (2441, 39_056)
    assert op4.choose_leaves(100_000_000) == (20_000, 320_000) == op4.choose_leaves(10**12)
    assert op4.choose_leaves(10_000, sample=160) == (10, 160)


def test_recall_with_leaves_of_a_larger_table(spark, monkeypatch):
    """2,000 leaves for 32,000 vectors: a query reads a small part of them and finds nine in ten."""
    monkeypatch.setattr(op4, "PER_LEAF", 16)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(300, 16)) * 3
    vectors = centres[rng.integers(0, 300, 32_000)] + rng.normal(size=(32_000, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    assert op4.choose_leaves(32_000)[0] == 2000
    out = op4.neighbours(df).toPandas()
    ids = sorted(out.query_id.unique())
    assert ids == list(range(0, 32_000, 100))
    hit = 0
    for q in ids:
        d = ((vectors - vectors[q]) ** 2).sum(1)
        d[q] = np.inf
        hit += len(set(np.argsort(d)[:10]) & set(out[out.query_id == q].vec_id))
    assert hit >= 0.9 * 10 * len(ids)
    assert (out.groupby("query_id").size() == 10).all()
