"""Lexical search against a plain scorer over all documents, and the bounds of the trees."""

import collections
import math
import random
import re

import numpy as np
import pytest

from revlens.llm import op11_balltree as op11

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, n long, terms string, tree string, score long, number int"
ITEMS = "item_id long, text string, rank int, doc_id long"


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k=10):
    """[(item_id, rank, doc_id, score)] by scoring every document."""
    held = [(doc, collections.Counter(terms(text))) for doc, text in docs]
    held = [(doc, c, sum(c.values())) for doc, c in held if c]
    n_docs, length = len(held), sum(n for _, _, n in held)
    df = collections.Counter(t for _, c, _ in held for t in c)
    wanted = collections.defaultdict(collections.Counter)
    for item, text in dict.fromkeys(items):
        wanted[item].update(terms(text))
    out = []
    for item, query in wanted.items():
        found = []
        for doc, c, n in held:
            m = 100 - 75 + 75 * n * n_docs // length
            score = sum(
                r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, r in query.items() if c[t]
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(found)[:k], 1)]
    return out


def rows(frame):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in frame.collect()), key=str)


def some_docs():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)] + ["Été", "ÉTÉ", "naïve", "日本", "x"]
    weights = [1 / (i + 1) for i in range(len(words))]
    out = [(i, " ".join(rng.choices(words, weights, k=rng.randrange(1, 120)))) for i in range(400)]
    out += [(400, None), (401, ""), (402, " .,;_ "), (403, out[7][1]), (404, out[7][1]), (405, "W1_w2-W3" * 3), (406, "w399 " * 50_000)]
    return [*out, out[7], out[7], (None, out[7][1]), (None, "w9 w10 w398")]


def some_items(docs):
    rng = random.Random(6)
    out = [(i, " ".join(rng.choice(docs[i][1].split()) for _ in range(12))) for i in range(30)]
    out += [(30, None), (31, ""), (32, "nowhere at all"), (33, docs[7][1]), (34, "w1 W1 w1 été ÉTÉ Été 日本"), (35, "w1"), (35, "w2 w2"), (36, "w3"), (36, "w3"), (None, "w5 w6")]
    return out


@pytest.mark.parametrize("leaf,groups,item_bytes", [(64, 64, 1 << 21), (2, 2, 300), (8, 16, 1 << 21)])
def test_equals_all_documents(spark, monkeypatch, leaf, groups, item_bytes):
    docs = some_docs()
    items = some_items(docs)
    left = spark.createDataFrame([(i, t, 1, "a", "b", 2, 3) for i, t in docs], DOCS).repartition(3)
    right = spark.createDataFrame([(i, t, 1, 2) for i, t in items], ITEMS)
    assert rows(op11.search(left, right, leaf=leaf, groups=groups, item_bytes=item_bytes)) == sorted(plain(docs, items), key=str)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "one two", 1, "a", "b", 2, 3)], DOCS)
    items = spark.createDataFrame([(1, "two", 1, 2)], ITEMS)
    assert op11.search(docs.where("false"), items).count() == 0
    assert op11.search(docs, items.where("false")).count() == 0
    assert op11.search(docs, items.withColumn("text", op11.F.lit("- -"))).count() == 0
    assert [tuple(r) for r in op11.search(docs.unionByName(docs.withColumn("text", op11.F.lit("three"))), items).collect()] == [(1, 1, 1, plain([(1, "one two"), (1, "three")], [(1, "two")])[0][3])]


def grow(rng, documents, n_terms, groups, leaf):
    space = op11.Space(documents, documents * 50, rng.integers(1, documents, n_terms), groups)
    sizes = rng.integers(1, 40, documents)
    term = np.concatenate([rng.choice(n_terms, x, replace=False) for x in sizes])
    value = rng.integers(1, 10**6, len(term))
    return space, op11.Tree.build(np.arange(documents), np.zeros(documents, bool), sizes, term, value, space, leaf)


@pytest.mark.parametrize("groups", [2, 16, 300])
def test_bounds_hold_and_leaves_cover_all(groups):
    rng = np.random.default_rng(groups)
    space, tree = grow(rng, 700, 300, groups, 16)
    assert sorted(tree.doc.tolist()) == list(range(700))
    again = op11.Tree.load(tree.dump())
    for _ in range(20):
        query = np.zeros(len(tree.terms), np.int64)
        at = rng.choice(len(query), 12, replace=False)
        query[at] = rng.integers(1, 20_000, 12)
        norms = np.sqrt(np.bincount(space.group[tree.terms], query.astype(float) ** 2, space.groups))
        bounds = again.bounds(query, norms)
        for node in range(len(tree.low)):
            assert tree.scores(node, query).max() <= bounds[node]
            child = tree.child[node]
            if child >= 0:
                assert (tree.low[child], tree.high[child + 1]) == (tree.low[node], tree.high[node]) and tree.high[child] == tree.low[child + 1]


def test_equal_documents_have_a_tight_ball():
    space = op11.Space(10, 500, np.array([3, 4, 5]), 2)
    tree = op11.Tree.build(np.arange(8), np.zeros(8, bool), np.full(8, 3), np.tile([0, 1, 2], 8), np.tile([500_000, 7, 10**6 - 1], 8), space, 2)
    query = np.array([11, 13, 17])
    exact = tree.scores(0, query)
    bound = tree.bounds(query, np.sqrt(np.bincount(space.group, query.astype(float) ** 2, 2)))
    assert len(set(exact.tolist())) == 1 and (bound >= exact[0]).all() and (bound <= exact[0] * 1.0001).all()


def test_terms_that_share_a_hash(monkeypatch):
    """Bytes decide, even if all hashes are equal."""
    monkeypatch.setattr(op11.arrowtext, "word_hashes", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    items = op11.Items([(1, "ab cd abc")])
    data = np.frombuffer(b"cd xx abc ab abd", np.uint8)
    word, term = items.find(data, np.array([0, 3, 6, 10, 13]), np.array([2, 5, 9, 12, 16]))
    assert sorted(zip(word.tolist(), term.tolist(), strict=True)) == [(0, 1), (2, 2), (3, 0)]
