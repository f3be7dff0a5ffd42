"""Components, bounded samples and byte helpers."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from revlens.llm import arrowtext, op05_pii
from revlens.llm.shared import components, smallest


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    pairs = [(i, i + 1) for i in range(100, 140)] + [(200, k) for k in range(201, 260)] + [(rng.randrange(300, 330), rng.randrange(300, 330)) for _ in range(25)]
    parent = {x: x for p in pairs for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    alone = {a for a, b in pairs if a == b} - {x for a, b in pairs if a != b for x in (a, b)}
    out = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in out} == {x: find(x) for x in parent if x not in alone}
    assert len(out) == len(parent) - len(alone)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_smallest_is_exact(spark):
    rows = spark.range(5000)
    want = [r["id"] for r in rows.orderBy(F.xxhash64("id")).limit(50).collect()]
    assert [r["id"] for r in smallest(rows, F.xxhash64("id"), 50).collect()] == want
    assert smallest(rows, F.xxhash64("id"), 4000).count() == 4000
    assert smallest(rows.limit(0), F.xxhash64("id"), 5).count() == 0


def test_words_hash_alike_wherever_they_are():
    texts = [None, "", "Ab cé", "x ab cé,y", "  ", "cé"]
    data, offsets = arrowtext.text_bytes(pa.array(texts), lower=True)
    starts, ends, text = arrowtext.words(data, offsets, arrowtext.WORD_BYTES)
    found = [bytes(data[a:b]).decode() for a, b in zip(starts, ends, strict=True)]
    assert found == ["ab", "cé", "x", "ab", "cé", "y", "cé"] and text.tolist() == [2, 2, 3, 3, 3, 3, 5]
    hashes = arrowtext.word_hashes(data, starts, ends)
    assert len({(w, h) for w, h in zip(found, hashes.tolist(), strict=True)}) == len(set(hashes.tolist())) == 4
    sh, owner = arrowtext.shingles(hashes, text, len(texts), 3)
    assert owner.tolist() == [2, 3, 3, 5] and len(set(sh.tolist())) == 4


def test_personal_data_is_learned_from_distinct_texts(spark, monkeypatch):
    texts = [f"call {k}55-0100 or write to a{k}@b.org" for k in range(30)]
    few = spark.createDataFrame([(t,) for t in texts], "text string")
    many = few.unionByName(spark.range(3000).select(F.lit(texts[3]).alias("text")))
    monkeypatch.setattr(op05_pii, "fit", lambda chosen: chosen)
    for count in (10, 100):
        assert op05_pii.train(many, count) == op05_pii.train(few, count)
        assert len(set(op05_pii.train(many, count))) == min(count, 30)
