"""The learning sample stays bounded however many languages there are, and doesn't depend on the order of rows."""

import random

import numpy as np

from revlens.llm import op07_language as op7


def test_rows_pack_and_unpack():
    rng = np.random.default_rng(1)
    x = np.where(rng.random((20, op7.FEATURES)) < 0.1, rng.random((20, op7.FEATURES)), 0).astype(np.float32)
    x[3] = 0
    assert (op7.unpacked(op7.packed(x)) == x).all()


def test_many_languages(spark, monkeypatch):
    """200 languages with 6 texts each, at most 400 rows in all: two of each, and the languages are still told apart."""
    rng = random.Random(7)
    words = {k: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 7))) for _ in range(12)] for k in range(200)}
    rows = [(k * 6 + j, f"l{k:03d}", " ".join(rng.choice(words[k]) for _ in range(80))) for k in range(200) for j in range(6)]
    learned = []
    real = op7.fit
    monkeypatch.setattr(op7, "fit", lambda x, langs: learned.append(langs) or real(x, langs))
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = op7.train(docs, sample=400)
    assert len(learned[0]) == 400 and len(set(learned[0])) == 200
    out = op7.identify(docs, model).join(docs, "doc_id").selectExpr("avg(int(lang = lang_pred)) AS right").first()
    assert out.right > 0.95


def test_ids_shared_by_different_texts(spark):
    rng = random.Random(3)
    rows = [(k % 10, "en" if k % 2 else "fr", " ".join(rng.choice(["the", "of", "and", "le", "la", "un"]) for _ in range(30))) for k in range(60)]
    models = []
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        models.append(op7.train(spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(seed + 2)))
    assert (models[0]["machines"] == models[1]["machines"]).all() and (models[0]["softmax"] == models[1]["softmax"]).all()
