"""Fingerprints and components against a plain version that compares all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from revlens.llm import op12_simhash as op12
from revlens.llm import registry

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, fp string, own string, root long, component_id long, least int"


def plain_fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, radius=4):
    """The smallest index of each one's component, by comparing all pairs."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= radius:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(x) for x in range(len(fps))]


def check(out, rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    groups = plain_components(fps)
    least = {}
    for (doc, _), g in zip(rows, groups, strict=True):
        if doc is not None:
            least[g] = min(least.get(g, doc), doc)
    key = lambda r: tuple((x is None, x) for x in r)
    want = sorted(((doc, f"{fp:016x}", least.get(g)) for (doc, _), fp, g in zip(rows, fps, groups, strict=True)), key=key)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in out), key=key) == want


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    check(registry.QUERIES["op12_multi_index_simhash"](spark, SF).collect(), rows)


def edge_rows():
    base = [f"word{i}" for i in range(300)]
    out = [None, "", " \n\t\x0b", "one", "One TWO", "one two three", "É ÀB çd ÉÉ", "x " * 600, " ".join(base), " ".join(base), "w " * 40_000 + "end"]
    rng = random.Random(1)
    for _ in range(30):
        words = list(base)
        words[rng.randrange(300)] = "other"
        out.append(" ".join(words))
    rows = [(i, t) for i, t in enumerate(out)]
    return [*rows, rows[5], rows[8], (None, "one two three"), (None, "alone here for once today"), (3, "one two three")]


@pytest.mark.parametrize("segments", [2, 3, 4])
def test_edges(spark, segments):
    rows = edge_rows()
    docs = spark.createDataFrame([(i, t, "f", "o", 1, 2, 3) for i, t in rows], SCHEMA)
    check(op12.near_components(docs, segments=segments).collect(), rows)
    assert op12.near_components(docs.where("false"), segments=segments).count() == 0


def clouds(rng, centres, each, flips):
    out = set()
    for _ in range(centres):
        centre = rng.getrandbits(64)
        for _ in range(each):
            out.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(flips + 1))))
    return sorted(out)


@pytest.mark.parametrize("segments,block", [(2, 8192), (3, 8192), (4, 8192), (3, 16), (4, 16)])
def test_links_connect_what_all_pairs_connect(spark, segments, block):
    """Dense clouds, chains at exactly the radius, points one bit too far; entries larger than a block."""
    rng = random.Random(segments)
    fps = clouds(rng, 12, 60, 4) + clouds(rng, 200, 2, 6)
    chain = rng.getrandbits(64)
    for _ in range(6):
        chain ^= sum(1 << b for b in rng.sample(range(64), 4))
        fps.append(chain)
    fps = sorted(set(fps) | {0, 2**64 - 1, 15, 31})
    points = spark.createDataFrame([(int(np.array(x, np.uint64).view(np.int64)),) for x in fps], "fp long")
    links = [(r["a"] % 2**64, r["b"] % 2**64) for r in op12.linked_points(points, segments=segments, block=block).collect()]
    place = {x: i for i, x in enumerate(fps)}
    root = list(range(len(fps)))
    for _ in fps:
        before = list(root)
        for a, b in links:
            root[place[a]] = root[place[b]] = min(root[place[a]], root[place[b]])
        if before == root:
            break
    assert root == plain_components(fps)


def test_pigeonhole():
    for segments in range(1, 9):
        plan = op12.segment_plan(segments, 4)
        assert sum(own + 1 for _, _, own in plan) == 5
        assert all(len(set(op12.ball(w, own))) == len(op12.ball(w, own)) for _, w, own in plan)
    assert [op12.choose_segments(n, 4) for n in (100, 10**7, 10**11)] == [4, 3, 2]


def test_large_entry_stays_a_forest():
    rng = np.random.default_rng(3)
    fp = np.unique(np.bitwise_xor.reduce(np.left_shift(np.uint64(1), rng.integers(0, 64, (5000, 4)).astype(np.uint64)), axis=1))
    own = np.ones(len(fp), bool)
    a, b = op12.forest(np.zeros(len(fp), np.int64), fp, own, 4, pairs=1 << 10)
    assert len(a) == len(fp) - 1 and op12.close(a, b, 4).all()
    c, d = op12.forest(np.zeros(300, np.int64), fp[:300], own[:300], 4)
    assert len(c) < 300
