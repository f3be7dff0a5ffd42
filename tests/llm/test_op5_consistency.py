"""Labels reach every repetition of an entity's part; marginals of trees are exact; whole tokens count."""

import itertools
import random
import re

import duckdb
import numpy as np
import pytest

from revlens.llm import op05_pii as op5

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def weights():
    texts = [r[0] for r in duckdb.sql(f"select text from '{SF}/documents.parquet' where regexp_matches(text, '[0-9@]') and length(text) <= 20000 order by doc_id").fetchall()]
    return op5.fit(texts)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(n))


@pytest.mark.parametrize("places", [1, 4, 39])
def test_planted_repetitions_are_all_added(weights, places):
    """A phone number, and its local part alone at 2, 5 and 40 places in all, before and after it; strangers stay."""
    rng = random.Random(places)
    hit = planted = wrong = added = 0
    for _ in range(40):
        local = f"{rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}"
        parts = [f"+1 ({rng.randrange(200, 999)}) {local}"] + [local] * places
        strangers = [f"{rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}" for _ in range(3)]
        rng.shuffle(parts)
        text = ""
        for x in [*parts, *strangers]:
            text += words(rng, rng.randrange(3, 30)) + " " + x + " "
        text += words(rng, 5)
        _, (full,) = op5.find([text], weights)
        base = op5.base_spans(text)
        more = [s for s in full if s not in base]
        bare = [m.span() for m in re.finditer(re.escape(local), text) if not any(a <= m.start() < b for _, a, b in base)]
        planted += len(bare)
        hit += sum(("phone", *x) in more for x in bare)
        added += len(more)
        wrong += sum(s[1:] not in bare for s in more)
    assert hit == planted == 40 * places
    assert wrong <= 0.01 * added


def test_strangers_alone_are_not_added(weights):
    rng = random.Random(5)
    texts = [words(rng, 20) + " " + " ".join(f"{words(rng, 4)} {rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}" for _ in range(6)) for _ in range(50)]
    _, full = op5.find(texts, weights)
    assert sum(map(len, full)) == 0


def exact(graph, weights):
    """Marginals by listing all labellings."""
    labels, n = len(op5.KINDS) + 1, len(graph.label)
    own = weights["emit"][np.array(graph.features)].sum(1)
    total = np.zeros((n, labels))
    logs = []
    ways = [w for w in itertools.product(range(labels), repeat=n) if all(not y or w[k] == y for k, y in enumerate(graph.label))]
    for w in ways:
        score = sum(own[k, x] for k, x in enumerate(w) if not graph.label[k])
        score += sum(weights["chain"][w[a], w[b]] for a, b in graph.chain) + sum(weights["skip"][w[a]] for a, b in graph.skip if w[a] == w[b])
        logs.append(score)
    logs = np.array(logs)
    p = np.exp(logs - logs.max())
    for w, x in zip(ways, p / p.sum(), strict=True):
        for k, label in enumerate(w):
            total[k, label] += x
    return total


@pytest.mark.parametrize("seed", range(8))
def test_marginals_of_trees_are_exact(seed):
    rng = np.random.default_rng(seed)
    labels = len(op5.KINDS) + 1
    weights = {"emit": rng.normal(0, 1, (op5.FEATURES, labels)), "chain": rng.normal(0, 1, (labels, labels)), "skip": rng.uniform(0, 3, labels)}
    graph = op5.Graph()
    n = 6
    graph.features = [[int(x) for x in rng.integers(0, op5.FEATURES, 3)] for _ in range(n)]
    graph.label = [3, 0, 0, 0, 0, 0] if seed % 2 else [0] * n
    for k in range(1, n):  # a random tree
        edge = (int(rng.integers(0, k)), k)
        (graph.chain if rng.random() < 0.5 else graph.skip).append(edge)
    got = op5.marginals(graph, weights)
    want = exact(graph, weights)
    free = np.array(graph.label) == 0
    assert np.abs(got[free] - want[free]).max() < 1e-3


def test_long_tokens_that_differ_late_are_not_similar():
    same = "x" * 600 + "1"
    graph = op5.Graph()
    graph.add(0, f"{same}a word {same}b word {same}a word {'9' * 400}1 and {'9' * 400}2", [])
    assert graph.skip == [(0, 2)]


def test_every_occurrence_is_joined_to_a_labelled_one():
    text = "555-0053 a +1 (619) 555-0053 b 555-0053 c 555-0053 d 555-0053"
    graph = op5.Graph()
    graph.add(0, text, op5.base_spans(text))
    inside = [k for k, y in enumerate(graph.label) if y and text[graph.begin[k] : graph.end[k]] == "555-0053"]
    assert len(inside) == 1
    joined = {x for e in graph.skip if inside[0] in e for x in e}
    assert joined == {k for k in range(len(graph.label)) if text[graph.begin[k] : graph.end[k]] == "555-0053"}
    assert len(graph.skip) <= 2 * len(graph.label)


def test_neighbours_are_one_span_only_if_they_can_be():
    assert not op5.one_entity("card", "4111111111111111 4111111111111111")
    assert op5.one_entity("card", "4111 1111 1111 1111") and not op5.one_entity("card", "4111 1111 1111 1112")
    assert op5.one_entity("phone", "619 555-0053") and not op5.one_entity("phone", "619 555-0053 619 555-0054")
    assert not op5.one_entity("email", "a@b.c d@e.f")
