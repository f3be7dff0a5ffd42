"""Alignment against whole texts encoded at once, groups by common ends and links by listing."""

import collections
import hashlib
import itertools
import json

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from revlens.llm import op13_alignment as op13
from revlens.llm import registry

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, row long, n_a string, pairs binary, best int"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
TEXTS = [
    None, "", " ", "a", "a ", "a  ", "  a", "one two  three\n\n four", "tab\tx\r\ny  ", "word.\nNext  line\n  indented", "it's we'll DON'T x'd", "3.14 and 1,000",
    "<s>hi</s><unk> <0x41> <|endoftext|>", "low ▁ block", "▁", "nbsp here em space 　 wide　x", "été naïve 日本語 \U0001f600\U0001f600 é",
    "x\x00y \x1c \x1f z \x85 q", "=" * 500, "ab" * 3000, " ".join(["word"] * 5000), "a" * 20_000 + " tail", "zero​width ﻿ bom ᠎ x", "ﬁ ① Ａ",
]


@pytest.fixture(scope="module")
def vocabularies():
    return op13.Vocabularies(op13.vocabulary_path(op13.VOCABULARY_A), op13.vocabulary_path(op13.VOCABULARY_B))


@pytest.fixture(scope="module")
def plain():
    """Token ids and bytes of whole texts."""
    a = Tokenizer.from_file(op13.vocabulary_path(op13.VOCABULARY_A))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=op13.vocabulary_path(op13.VOCABULARY_B))
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in printable}
    letters |= {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in printable)}

    def encode(text):
        if not text:
            return [], []
        first = [(x, bytes(letters[c] for c in a.id_to_token(x))) for x in a.encode(" " + text, add_special_tokens=False).ids]
        second = []
        for x in b.encode(text):
            piece = b.id_to_piece(x)
            second.append((x, bytes([int(piece[3:5], 16)]) if b.is_byte(x) else piece.replace("▁", " ").encode()))
        data = (" " + text).encode()
        if b"".join(x for _, x in first) != data or b"".join(x for _, x in second) != data:
            return [], []
        return first, second

    return encode


def groups(first, second):
    """[(A ids, B ids)] between the bytes where both end."""
    ends = [list(itertools.accumulate(len(x) for _, x in side)) for side in (first, second)]
    cuts = sorted(set(ends[0]) & set(ends[1]))
    out, low = [], 0
    for high in cuts:
        out.append(tuple([x[0] for x, e in zip(side, end, strict=True) if low < e <= high] for side, end in zip((first, second), ends, strict=True)))
        low = high
    return out


def expected(rows, encode):
    each = [(doc, *encode(text)) for doc, text in rows]
    split = [groups(a, b) for _, a, b in each]
    links = [collections.Counter((x, y) for left, right in own for x in left for y in right) for own in split]
    documents = collections.Counter(pair for own in links for pair in own)
    most = collections.defaultdict(int)
    for (a, _), n in documents.items():
        most[a] = max(most[a], n)
    out = []
    for (doc, a, b), own, link in zip(each, split, links, strict=True):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in own)
        best = sum(n for pair, n in link.items() if documents[pair] == most[pair[0]])
        total = sum(n * documents[pair] for pair, n in link.items())
        out.append((doc, len(a), len(b), len(own), sum(link.values()), best, total, hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return sorted(out, key=str)


def found(frame):
    return sorted((tuple(r[x] for x in COLUMNS) for r in frame.collect()), key=str)


def edge_rows():
    rows = list(enumerate(TEXTS))
    return [*rows, rows[7], rows[7], (None, TEXTS[7]), (None, None), (3, "another text of the id")]


@pytest.mark.parametrize("pairs_per_block", [op13.PAIRS_PER_BLOCK, 50])
def test_edges(spark, plain, pairs_per_block):
    rows = edge_rows()
    docs = spark.createDataFrame([(i, t, 1, "x", b"y", 2) for i, t in rows], SCHEMA).repartition(3)
    assert found(op13.align(docs, pairs_per_block=pairs_per_block)) == expected(rows, plain)
    assert op13.align(docs.where("false")).count() == 0


def test_whole_table(spark, plain):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    out = registry.QUERIES["op13_tokenizer_alignment"](spark, SF)
    assert out.columns[:8] == COLUMNS
    assert found(out) == expected(rows, plain)


def test_dictionary(spark, plain):
    rows = edge_rows()
    docs = spark.createDataFrame([(i, t, 1, "x", b"y", 2) for i, t in rows], SCHEMA)
    documents = collections.Counter(p for _, t in rows for p in {(x, y) for left, right in groups(*plain(t)) for x in left for y in right})
    got = op13.dictionary(docs).collect()
    assert {(r["a"], r["b"]): r["documents"] for r in got} == documents
    assert all(r["best"] == (r["documents"] == max(n for (a, _), n in documents.items() if a == r["a"])) for r in got)


LETTERS = st.sampled_from([*"ab1.' \n\t<>|_-'s", "  ", " the", "ing", "é", "▁", " ", "　", "​", "\x1c", "日", "\U0001f600", "tion"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(LETTERS, max_size=25).map("".join), min_size=1, max_size=5))
def test_chunks_change_nothing(vocabularies, plain, texts):
    aligner = vocabularies.known()
    counts, written, _ = aligner.digest(texts)
    for k, text in enumerate(texts):
        a, b = plain(text)
        own = groups(a, b)
        assert (counts["n_a"][k], counts["n_b"][k], counts["n_groups"][k]) == (len(a), len(b), len(own))
        assert counts["n_links"][k] == sum(len(x) * len(y) for x, y in own)
        ends = [list(itertools.accumulate(len(x) for _, x in side)) for side in (a, b)]
        spans = [list(zip([0, *end], end, strict=False)) for end in ends]
        assert counts["n_overlaps"][k] == sum(max(p[0], q[0]) < min(p[1], q[1]) for p in spans[0] for q in spans[1])
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in own)
        assert written[k] == (hashlib.sha256(text.encode()).hexdigest() if text else "")


@settings(max_examples=80, deadline=None)
@given(st.data())
def test_products(data):
    n, k, m = (data.draw(st.integers(1, 6)) for _ in range(3))
    draw = lambda r, c: np.array(data.draw(st.lists(st.lists(st.integers(0, 3), min_size=c, max_size=c), min_size=r, max_size=r)))

    def sparse(x):
        rows, cols = np.nonzero(x)
        return op13.Csr.from_entries(rows, cols, x[rows, cols], *x.shape)

    def dense(x, shape):
        out = np.zeros(shape, np.int64)
        np.add.at(out, (x.rows, x.indices), x.values)
        return out

    a, b = draw(n, k), draw(k, m)
    assert (dense(sparse(a).times(sparse(b)), (n, m)) == a @ b).all()
    assert (dense(sparse(a).transpose(), (k, n)) == a.T).all()


def test_vocabularies_that_do_not_fit(vocabularies):
    model = json.loads(vocabularies.a)
    model["pre_tokenizer"] = None
    with pytest.raises(ValueError):
        op13.Aligner(json.dumps(model), vocabularies.b)
