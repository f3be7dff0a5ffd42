"""Every operator against brute force, an exact round trip, its SQL oracle or held-out accuracy."""

import bisect
import collections
import itertools
import random
import re
import textwrap
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from revlens.llm import arrowtext, op01_license, op02_packing, op03_quality, op04_neighbours, op05_pii, op06_mixing, op07_language, op08_jaccard, op09_toxicity, op10_passages, registry

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"(?:[a-zA-Z0-9_]|[^\x00-\x7f])+")


@pytest.fixture(scope="module")
def documents():
    return dict(duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_sql_oracle(spark, name):
    got = registry.QUERIES[name](spark, SF).toPandas()
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    want = con.execute(registry.ORACLES[name]).df()[list(got.columns)]
    assert sorted(map(str, got.itertuples(index=False, name=None))) == sorted(map(str, want.itertuples(index=False, name=None)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=40), min_size=1, max_size=5))
def test_longest_repeats(texts):
    data, offsets = arrowtext.text_bytes(pa.array([" ".join(x) for x in texts]))
    starts, ends, text = arrowtext.words(data, offsets, arrowtext.NOT_SPACE)
    got = op03_quality.repeat_lengths(arrowtext.word_hashes(data, starts, ends), text, len(texts)).tolist()
    want = []
    for w in texts:
        for i in range(len(w)):
            best = 0
            for j in range(len(w)):
                k = 0
                while i != j and max(i, j) + k < len(w) and w[i + k] == w[j + k]:
                    k += 1
                best = max(best, k)
            want.append(best)
    assert got == want


def test_packing_round_trip(spark, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(op02_packing.vocabulary_path())
    out = op02_packing.pack(spark.read.parquet(f"{SF}/documents.parquet"), with_ids=True).toPandas()
    lengths = []
    for doc, rows in out.groupby("doc_id"):
        ids = tokenizer.encode(documents[doc] or "", add_special_tokens=False).ids + [0]
        rows = rows.sort_values("piece")
        assert [i for x in rows.ids for i in x] == ids and rows.start.tolist() == list(range(0, len(ids), 2048))
        assert [zlib.crc32(np.array(x, "<u4").tobytes()) for x in rows.ids] == rows.ids_crc32.tolist()
        lengths += rows.length.tolist()
    for _, rows in out.sort_values("offset").groupby("sequence_id"):
        assert rows.offset.tolist() == [0, *np.cumsum(rows.length)[:-1]] and rows.length.sum() <= 2048
    assert out.sequence_id.nunique() == best_fit(lengths, 2048)


def best_fit(lengths, capacity):
    gaps, opened = [], 0
    for length in sorted(lengths, reverse=True):
        k = bisect.bisect_left(gaps, length)
        left = (gaps.pop(k) if k < len(gaps) else capacity) - length
        opened += left == capacity - length and k >= len(gaps)
        bisect.insort(gaps, left)
    return len(gaps)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=200))
def test_sweep_equals_best_fit(lengths):
    counts = collections.Counter(lengths)
    plan = op02_packing.sweep(dict(counts), 30)
    used, placed = collections.defaultdict(list), collections.Counter()
    for length, _, first, many, each, offset in plan.tolist():
        for s in range(first, first + many):
            used[s] += [(offset + k * length, length) for k in range(each)]
            placed[length] += each
    assert placed == counts and len(used) == best_fit(lengths, 30)
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 30


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
ADDRESS = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="1234.@+- ()a4é0\n", max_size=60))
def test_base_spans_equal_plain_patterns(text):
    want = [("email", *m.span()) for m in EMAIL.finditer(text)]
    want += [("ip", *m.span()) for m in ADDRESS.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for kind, pattern, low, high in (("card", r"[0-9]([\x20-]?[0-9])+", 12, 19), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 9, 15)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if low <= len(digits) <= high and (kind == "phone" or op05_pii.luhn(digits)):
                want.append((kind, *m.span()))
    assert op05_pii.base_spans(text) == sorted(want, key=lambda x: (x[1], op05_pii.KINDS.index(x[0])))


def test_skip_edges_carry_a_label():
    texts = [f"call +1 (619) 555-{k:04d} now, {k} people in {1900 + k} saw 555-{k + 1:04d}" for k in range(100, 180)]
    weights = op05_pii.fit(texts)
    far = "call +1 (619) 555-0053 now. " + "word " * 300 + "again 555-0053 it said, and 555-7788 too"
    graph = op05_pii.Graph()
    graph.add(0, far, op05_pii.base_spans(far))
    p = op05_pii.marginals(graph, weights)[:, op05_pii.KINDS.index("phone") + 1]
    repeated, other = graph.begin.index(far.rindex("555-0053")), graph.begin.index(far.rindex("555-7788"))
    assert p[repeated] > 2 * p[other]
    base, full = op05_pii.find([far], weights)
    assert set(base[0]) <= set(full[0])


def test_mixing_limits(spark):
    rows = [(i, "a" if i < 600 else "b" if i < 900 else "c", "x y z " * (1 + i % 5)) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = op06_mixing.mix(docs, max_epochs=3.0, block_tokens=500).toPandas()
    count = out.groupby("doc_id").size()
    assert len(count) == 1000 and count.max() <= 3
    share = out.groupby("source").mix_tokens.sum() / out.mix_tokens.sum()
    original = docs.toPandas().assign(n=lambda d: d.text.str.split().str.len()).groupby("source").n.sum()
    a = np.log(share["a"] / share["c"]) / np.log(original["a"] / original["c"])
    assert 0 < a < 1 and abs(np.log(share["b"] / share["c"]) / np.log(original["b"] / original["c"]) - a) < 0.03
    even = op06_mixing.mix(docs, max_epochs=None, min_entropy=1.0, budget=9000.0, block_tokens=500).toPandas()
    p = even.groupby("source").mix_tokens.sum() / even.mix_tokens.sum()
    assert abs(-(p * np.log(p)).sum() - 1.0) < 0.02 and abs(even.mix_tokens.sum() - 9000) < 60


def brute_links(texts):
    sets = {}
    for doc, text in texts.items():
        w = WORD.findall((text or "").lower())
        sets[doc] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    shared = collections.Counter()
    holders = collections.defaultdict(list)
    for doc, s in sets.items():
        for x in s:
            holders[x].append(doc)
    for v in holders.values():
        shared.update(itertools.combinations(sorted(v), 2))
    return [(a, b) for (a, b), n in shared.items() if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n) - 1e-9]


def near_copies(n, seed=5):
    """One hot group: near copies of a text, each with a few words changed, beside unrelated texts."""
    rng = random.Random(seed)
    base = [f"t{i}" for i in range(120)]
    texts = {}
    for i in range(n):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(120)] = f"r{rng.randrange(40)}"
        texts[i] = " ".join(words)
    return texts | {n + i: " ".join(f"u{i}_{rng.randrange(500)}" for _ in range(60)) for i in range(20)}


def test_jaccard_join_equals_brute_force(spark, documents):
    texts = {k: v for k, v in documents.items()} | {10_000 + k: v for k, v in near_copies(90).items()}
    links = brute_links(texts)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = op08_jaccard.jaccard_join(docs, block=16).toPandas().set_index("doc_id")
    degree, parent = collections.Counter(), {d: d for d in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        degree.update((a, b))
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert {d: int(n) for d, n in out.n_links.items()} == {d: degree[d] for d in texts}
    assert out.class_id.to_dict() == {d: find(d) for d in texts}


def test_band_choice():
    bands, rows = op08_jaccard.choose_bands(0.8, 0.999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999 and 1 - (1 - 0.3**rows) ** bands <= 0.25


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 6), max_size=15), min_size=1, max_size=3), st.integers(1, 6))
def test_compact_windows_cover_each_subsequence_once(texts, width):
    values = np.array([x for t in texts for x in t], np.uint64)
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    windows = list(zip(*(x.tolist() for x in op10_passages.compact_windows(values, text, width)), strict=True))
    begin = 0
    for t in texts:
        for i in range(begin, begin + len(t)):
            for j in range(i + width - 1, begin + len(t)):
                holding = [c for l, c, r in windows if l <= i <= c <= j <= r]
                assert holding == [i + int(np.argmin(values[i : j + 1]))]
        begin += len(t)


def test_passages_equal_brute_force(spark, documents):
    rng = random.Random(3)
    planted = " ".join(f"p{i}" for i in range(70))
    texts = dict(documents)
    for k in range(12):
        own = [f"o{k}_{rng.randrange(900)}" for _ in range(200)]
        cut = rng.randrange(200)
        texts[20_000 + k] = " ".join(own[:cut]) + " " + planted + " " + " ".join(own[cut:])
    texts[30_000] = " ".join(["lonely"] + [f"q{i}" for i in range(60)] * 2)  # repeats inside itself only
    words = {d: WORD.findall((t or "").lower()) for d, t in texts.items()}
    holders = collections.defaultdict(set)
    for d, w in words.items():
        for i in range(len(w) - 49):
            holders[tuple(w[i : i + 50])].add(d)
    exact = {(d, k) for d, w in words.items() for i in range(len(w) - 49) if len(holders[tuple(w[i : i + 50])]) > 1 for k in range(i, i + 50)}
    out = op10_passages.passages(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).toPandas()
    found = {(r.doc_id, k) for r in out.itertuples() for k in range(r.start_word, r.end_word)}
    assert exact <= found and 30_000 not in set(out.doc_id)
    grams = collections.defaultdict(set)
    for d, w in words.items():
        for i in range(len(w) - 4):
            grams[tuple(w[i : i + 5])].add(d)
    for r in out.itertuples():  # nothing but near-duplicate passages
        w = words[r.doc_id][r.start_word : r.end_word]
        assert len(w) >= 50 and np.mean([len(grams[tuple(w[i : i + 5])]) > 1 for i in range(len(w) - 4)]) >= 0.8
    for k in range(12):
        row = out[out.doc_id == 20_000 + k]
        assert len(row) == 1 and abs(int(row.end_word.iloc[0] - row.start_word.iloc[0]) - 70) <= 0


def test_neighbours_recall(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(3000, 16)).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    out = op04_neighbours.neighbours(frame, leaves=32, block=200).toPandas()
    hits = 0
    for q, rows in out.groupby("query_id"):
        d = np.sqrt(((vectors.astype(float) - vectors[q].astype(float)) ** 2).sum(1))
        assert np.array_equal(d[rows.vec_id], rows.score) and rows.sort_values("rank").score.is_monotonic_increasing
        d[q] = np.inf
        hits += len(set(np.argsort(d, kind="stable")[:10]) & set(rows.vec_id))
    assert hits >= 0.9 * 300


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = op07_language.identify(docs, op07_language.train(docs)).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    assert (out.held_out == [zlib.crc32(str(d).encode()) % 4 == 2 for d in out.doc_id]).all()
    held = out[out.held_out & out.lang.notna() & (out.lang_pred != "und")]
    assert (held.lang == held.lang_pred).mean() >= 0.95


def test_toxicity_held_out_and_swaps(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = op09_toxicity.score(docs, op09_toxicity.train(docs, labels)).toPandas().merge(labels.toPandas(), on="doc_id")
    held = out[out.held_out & out.toxic.notna()]
    assert (held.predicted == held.toxic).mean() >= 0.97
    # a corpus in which one group is mostly named in toxic texts
    rng, texts, toxic = random.Random(2), [], []
    for k in range(600):
        bad = k % 2
        group = "muslim" if rng.random() < (0.9 if bad else 0.1) else "christian"
        texts.append(f"the {group} people w{rng.randrange(50)} " + ("vile scum" if bad and rng.random() < 0.8 else "fine day"))
        toxic.append(bad)
    rows = []
    for t in texts:
        values, owner = op09_toxicity.places(pa.array([t]))
        rows.append(np.unique(values))
    named = [op09_toxicity.places(pa.array([w]))[0][0] for w in ("muslim", "christian")]
    gaps = []
    for weight in (0.0, 1.0):
        w, _ = op09_toxicity.fit(rows, np.array(toxic, float), swap_weight=weight)
        gaps.append(abs(w[named[0]] - w[named[1]]))
    assert gaps[1] < 0.5 * gaps[0]


def test_license_notices_are_found(documents):
    scanner = op01_license.Scanner(op01_license.TEMPLATES)
    short = {n: t for n, t in op01_license.TEMPLATES.items()}
    for name, notice in short.items():
        text = "Lead in.\n" + notice + "\nand so on"
        (a, b), *_ = op01_license.blocks(text)
        got = scanner.judge(text, a, b)
        assert got[2] == name and got[3] and got[7] == 0
    changed = "This work is licensed under the GNU General Public License, version 4."
    assert scanner.judge(changed, 0, len(changed))[3] is False
    assert scanner.judge("a driving license is needed here by all", 0, 39) is None
    for text in documents.values():
        for name in ("MIT", "Apache-2.0", "GPL-3.0", "CC-BY-NC-4.0"):
            if short[name] in (text or ""):
                assert any((g := scanner.judge(text, a, b)) and g[2] == name and g[3] for a, b in op01_license.blocks(text))


def test_pipeline_against_brute_force(spark, documents):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality"](spark, docs, SF).cache()
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    want = {r[0] for r in con.execute(f"select doc_id from ({op03_quality.ORACLE}) where kept").fetchall()}
    assert {r["doc_id"] for r in good.select("doc_id").collect()} == want
    single = stages["near_duplicates"](spark, good, SF).cache()
    links = brute_links({d: documents[d] for d in want})
    parent = {d: d for d in want}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    heads = {d for d in want if find(d) == d}
    assert sorted(r["doc_id"] for r in single.select("doc_id").collect()) == sorted(heads)
    private = stages["personal_data"](spark, single, SF).cache()
    for r in private.collect():
        assert not [s for s in op05_pii.base_spans(r["text"]) if s[0] in ("email", "card")] and r["n_chars"] == len(r["text"])
    mixed = stages["mixing"](spark, private, SF)
    count = collections.Counter(r["doc_id"] for r in mixed.select("doc_id").collect())
    assert set(count) == heads and max(count.values()) <= 2


def confirmed_licenses(text):
    return [(r[2], r[7]) for r in op01_license.Scanner(op01_license.TEMPLATES).rows(text) if r[3]]


@pytest.mark.parametrize("mark", ["", "# ", " * "])
@pytest.mark.parametrize("name", sorted(op01_license.TEMPLATES))
def test_wrapped_license_notices_are_confirmed(name, mark):
    words = op01_license.TEMPLATES[name].replace("http", "\n\nhttp").replace("Unless", "\n\nUnless").replace(": Redis", ":\n\nRedis")
    lines = [line for part in words.split("\n") for line in textwrap.wrap(part, 72) or [""]]
    text = "Some prose about the work and what it is for.\n\n" + "\n".join(mark + line for line in lines) + "\n\nThe next part of the text, with more of it.\n"
    assert confirmed_licenses(text) == [(name, 0)]


@pytest.mark.parametrize("between", [" ", "\n", "\n\n", ". See the files. "])
def test_every_license_of_a_block_is_confirmed(between):
    names = ["MIT", "CC-BY-4.0", "GPL-3.0-header", "Apache-2.0", "MIT"]
    for count in (2, 3, 5):
        text = between.join(op01_license.TEMPLATES[n] for n in names[:count])
        assert confirmed_licenses(text) == [(n, 0) for n in names[:count]]
        assert confirmed_licenses("word " * 600 + text + " word" * 600) == [(n, 0) for n in names[:count]]


def random_words(rng, n):
    return [f"w{rng.randrange(1_000_000)}" for _ in range(n)]


@pytest.mark.parametrize("times", [2, 3])
@pytest.mark.parametrize("repeats_first", [True, False])
def test_passage_held_several_times_by_one_document(spark, repeats_first, times):
    rng, texts, want = random.Random(8), [], set()
    for k in range(20):
        passage = random_words(rng, 60)
        once = random_words(rng, 100) + passage + random_words(rng, 100)
        often = [w for _ in range(times) for w in random_words(rng, 400) + passage] + random_words(rng, 100)
        first, second = (often, once) if repeats_first else (once, often)
        texts += [(2 * k, " ".join(first)), (2 * k + 1, " ".join(second))]
        want |= {(2 * k + (not repeats_first), 400 + 460 * t) for t in range(times)} | {(2 * k + repeats_first, 100)}
    for partitions in (1, 3):
        out = op10_passages.passages(spark.createDataFrame(texts, "doc_id long, text string").repartition(partitions)).collect()
        assert {(r["doc_id"], r["start_word"]) for r in out} == want
        assert all(r["end_word"] - r["start_word"] == 60 for r in out)


def test_links_are_the_same_however_rows_are_batched():
    rng = random.Random(3)
    for _ in range(200):
        rows, docs = [], list(range(rng.randrange(1, 6)))
        for key in (64, 128):
            left = docs.copy()
            rng.shuffle(left)
            while left:
                own = [left.pop() for _ in range(min(len(left), rng.randrange(1, 3)))]
                rows.append((key, np.array([(d, 100 * i, 100 * i - 9, 100 * i + 9) for d in sorted(own) for i in range(rng.randrange(1, 4))], op10_passages.MEMBER).tobytes()))
        whole = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["key", "members"])
        single = [whole.slice(k, 1) for k in range(whole.num_rows)]
        got = [sorted(map(str, itertools.chain(*(b.to_pylist() for b in op10_passages.link_task(iter(x)))))) for x in ([whole], single)]
        assert set(got[0]) == set(got[1])
        for key in (64, 128):  # every member of a key with two documents has a link
            members = np.concatenate([np.frombuffer(r[1], op10_passages.MEMBER) for r in rows if r[0] == key])
            if len(set(members["doc"])) > 1:
                links = [x for b in op10_passages.link_task(iter([whole.filter(pa.array([r[0] == key for r in rows]))])) for x in b.to_pylist()]
                assert {(m["doc"], m["c"]) for m in members} == {(x["a"], x["ca"]) for x in links} | {(x["b"], x["cb"]) for x in links}


def planted_recall(spark, words, edits, pairs, seed):
    """Share of planted near copies of `words` words, edited at the places `edits`, that are found; and their similarity."""
    rng, texts = random.Random(seed), []
    for k in range(pairs):
        passage = random_words(rng, words)
        copy = [random_words(rng, 1)[0] if i in edits else w for i, w in enumerate(passage)]
        texts += [(2 * k + j, " ".join(random_words(rng, 60) + p + random_words(rng, 60))) for j, p in enumerate((passage, copy))]
    hit = {i + j for i in edits for j in range(-4, 1)} & set(range(words - 4))
    out = op10_passages.passages(spark.createDataFrame(texts, "doc_id long, text string")).select("doc_id").distinct().count()
    return out / len(texts), (words - 4 - len(hit)) / (words - 4 + len(hit))


def test_recall_of_near_copies_at_the_threshold(spark):
    assert op10_passages.choose_hashes(0.8, 0.998) == 6 and op10_passages.choose_hashes(0.8, 0.999, 1) == 5
    recall, similarity = planted_recall(spark, 50, {25}, 2000, 11)
    assert 0.8 <= similarity < 0.81 and recall >= 0.998


def test_whole_scores_of_groups_differ_little():
    rng, texts, toxic = random.Random(6), [], []
    for k in range(900):
        bad = k % 3 == 0
        group = rng.choice(["muslim", "muslims"]) if rng.random() < (0.9 if bad else 0.1) else rng.choice(["christian", "christians"])
        texts.append(f"the {group} people here " + " ".join(rng.choices(["vile", "scum", "filth"] if bad else ["kind", "calm", "glad"], k=1) + rng.choices(["one", "two", "day", "work"], k=6)))
        toxic.append(bad)
    rows = [np.unique(op09_toxicity.places(pa.array([t]))[0]) for t in texts]
    gaps = []
    for weight in (0.0, 1.0):
        w, _ = op09_toxicity.fit(rows, np.array(toxic, float), swap_weight=weight)
        total = [w[np.unique(op09_toxicity.places(pa.array([t]))[0])].sum() for t in ("the muslim people", "the christian people", "the muslims here", "the christians here")]
        gaps.append((total[0] - total[1], total[2] - total[3]))
    assert min(gaps[0]) > 0.5 and max(map(abs, gaps[1])) < 0.25 * min(gaps[0])
