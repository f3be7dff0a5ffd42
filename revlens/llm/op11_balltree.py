"""Ranked lexical search: exact inner products over a forest of sparse ball trees.

Terms are the maximal matches of `[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`, A-Z lower-cased.
A document is the sparse vector of its saturated term frequencies, an item the vector of its terms'
weights times their repeats; the score is their inner product, all in 64-bit integers.

1. Each text becomes one row: its number of terms, and its frequencies of the items' terms (hashes
   find them, bytes confirm them). Document counts, lengths and document frequencies are summed from
   these rows.
2. The vectors of a task are gathered in trees of bounded size. A node is split between two far
   documents; it keeps its centroid and, for each of `groups` groups of terms, the radius of its
   ball in that group's coordinates. No document of a node scores above
   item . centroid + sum over groups of |item| * radius; the bound is rounded up by more than all
   floating point errors can add to it.
3. A probe scores the most promising leaf of every tree: the k-th best score found for an item is a
   floor for all trees.
4. Every tree is searched best-first by bound until no bound reaches the floor or the task's own
   k-th best score; leaves are scored exactly. The best k of each task are ranked over the cluster.

Items are taken in blocks of bounded text (`ITEM_BYTES`), each against all documents; their terms
and vectors are what tasks get. No document is dropped: a bound only skips what can't be returned.

Defined results: null texts hold no terms; an item without terms, or whose terms no document holds,
gives no row. Repeated rows of `docs` are documents of their own. Documents with a null id count and
rank after equal scores. Rows of `items` that share an id are one item with the terms of its
distinct texts; a null item_id is an id like any other. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import io
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.llm import arrowtext
from revlens.llm.shared import cut

K = 10
LEAF = 64
GROUPS = 64
TREE_DOCUMENTS = 2048
TREE_TERMS = 1 << 18
ITEM_BYTES = 1 << 21
TERM_BYTES = arrowtext.byte_class(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ" + bytes(range(128, 256)))
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
A_TO_Z = {c: c + 32 for c in range(65, 91)}

ORACLE = r"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents WHERE text IS NOT NULL),
lengths AS (SELECT doc_id, count(*)::BIGINT AS n FROM words GROUP BY doc_id),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS len FROM lengths),
wanted AS (
    SELECT item_id, term, count(*)::BIGINT AS repeats FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL))
    GROUP BY item_id, term),
held AS (
    SELECT doc_id, term, count(*)::BIGINT AS tf FROM words WHERE term IN (SELECT term FROM wanted) GROUP BY doc_id, term),
weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
    FROM (SELECT term, count(*)::BIGINT AS df FROM held GROUP BY term), total),
impacts AS (
    SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // len))) AS impact
    FROM held JOIN lengths USING (doc_id) JOIN weights USING (term), total),
scores AS (
    SELECT item_id, doc_id, sum(impact * repeats)::BIGINT AS score FROM wanted JOIN impacts USING (term) GROUP BY item_id, doc_id)
SELECT item_id, "rank"::INTEGER AS "rank", doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS "rank" FROM scores WHERE score > 0)
WHERE "rank" <= 10
"""


def ranges(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, .. (sizes[0] numbers), begin[1], .."""
    return np.arange(int(sizes.sum())) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)


class Items:
    """The items of one block: their ids, their distinct terms, and the terms of each with repeats."""

    def __init__(self, rows: list[tuple[int | None, str]]) -> None:
        terms: dict[str, int] = {}
        held: dict[int | None, dict[int, int]] = {}
        for item, text in rows:
            own = held.setdefault(item, {})
            for term in TERM.findall(text):
                at = terms.setdefault(term.translate(A_TO_Z), len(terms))
                own[at] = own.get(at, 0) + 1
        self.ids = list(held)
        self.terms = [np.array(list(x), np.int64) for x in held.values()]
        self.repeats = [np.array(list(x.values()), np.int64) for x in held.values()]
        words = [x.encode() for x in terms]
        self.sizes = np.array([len(x) for x in words], np.int64)
        self.begin = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(words), np.uint8)
        hashes = arrowtext.word_hashes(self.data, self.begin, self.begin + self.sizes)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        self.most = int(np.unique(hashes, return_counts=True)[1].max(initial=0))  # terms that share a hash

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word, term) of the words that are a term of some item, equal byte by byte."""
        hashes = arrowtext.word_hashes(data, starts, ends)
        at = np.searchsorted(self.hashes, hashes)
        words, terms = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for step in range(self.most):
            near = np.minimum(at + step, len(self.hashes) - 1)
            word = np.flatnonzero((self.hashes[near] == hashes) & (at + step < len(self.hashes)))
            term = self.order[near[word]]
            same = ends[word] - starts[word] == self.sizes[term]
            word, term = word[same], term[same]
            if len(word):
                sizes = self.sizes[term]
                equal = data[ranges(starts[word], sizes)] == self.data[ranges(self.begin[term], sizes)]
                same = np.logical_and.reduceat(equal, np.cumsum(sizes) - sizes)
                words.append(word[same])
                terms.append(term[same])
        return np.concatenate(words), np.concatenate(terms)


def binaries(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """One binary for each part of `values`."""
    offsets = (np.concatenate([[0], np.cumsum(sizes)]) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])


def frequencies(docs: DataFrame, items: Items) -> DataFrame:
    """doc_id, n (terms in the text), and the items' terms that it holds with their frequencies; texts without terms are left out."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrowtext.slices(batch, "text"):
                data, offsets = arrowtext.text_bytes(part.column("text"))
                data = LOWER[data]
                starts, ends, text = arrowtext.words(data, offsets, TERM_BYTES)
                n = np.bincount(text, minlength=part.num_rows)
                word, term = items.find(data, starts, ends)
                held, tf = np.unique(text[word] * len(items.sizes) + term, return_counts=True)
                sizes = np.bincount(held // max(1, len(items.sizes)), minlength=part.num_rows)
                out = pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array(n), binaries((held % max(1, len(items.sizes))).astype(np.int32), sizes), binaries(tf.astype(np.int32), sizes)],
                    ["doc_id", "n", "terms", "tfs"],
                )
                yield out.filter(pa.array(n > 0))

    return docs.select("doc_id", "text").mapInArrow(task, "doc_id long, n long, terms binary, tfs binary")


def document_frequencies(rows: DataFrame, n_terms: int) -> np.ndarray:
    """In how many documents each term of the block lies."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column("terms").to_pylist()), np.int32), minlength=n_terms)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["term", "df"])

    out = np.zeros(n_terms, np.int64)
    for term, df in rows.select("terms").mapInArrow(task, "term int, df long").groupBy("term").agg(F.sum("df")).collect():
        out[term] = df
    return out


class Space:
    """What all trees share: counts over the corpus, the terms' weights and groups."""

    def __init__(self, documents: int, length: int, df: np.ndarray, groups: int) -> None:
        self.documents, self.length = documents, length
        self.weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * x + 1))) if x else 0 for x in df.tolist()], np.int64)
        # frequent terms have a group of their own, the others share the rest
        rank = np.empty(len(df), np.int64)
        rank[np.argsort(-df, kind="stable")] = np.arange(len(df))
        own = groups // 2
        self.groups = groups
        self.group = np.where(rank < own, rank, own + rank % (groups - own))

    def impacts(self, n: np.ndarray, tf: np.ndarray) -> np.ndarray:
        m = 100 - 75 + (75 * n * self.documents) // self.length
        return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Tree:
    """Documents in leaf order (CSR over the tree's own terms) and the balls of its nodes."""

    PARTS = ("doc", "null", "terms", "sizes", "at", "value", "low", "high", "child", "c_sizes", "c_at", "c_value", "radius")

    def __init__(self, **parts: np.ndarray) -> None:
        self.__dict__.update(parts)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{x: getattr(self, x) for x in self.PARTS})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Tree:
        with np.load(io.BytesIO(data)) as parts:
            return cls(**{x: parts[x] for x in cls.PARTS})

    @classmethod
    def build(cls, doc: np.ndarray, null: np.ndarray, sizes: np.ndarray, term: np.ndarray, value: np.ndarray, space: Space, leaf: int) -> Tree:
        """`sizes` terms of each document in a row, with their impacts."""
        terms, at = np.unique(term, return_inverse=True)
        group = space.group[terms]
        begin = np.cumsum(sizes) - sizes
        real = value.astype(np.float64)
        squares = np.bincount(np.repeat(np.arange(len(sizes)), sizes), real * real, len(sizes))

        def distances(rows: np.ndarray, spots: np.ndarray, owner: np.ndarray, pivot: int) -> np.ndarray:
            dense = np.zeros(len(terms))
            own = slice(begin[pivot], begin[pivot] + sizes[pivot])
            dense[at[own]] = real[own]
            return squares[rows] - 2 * np.bincount(owner, real[spots] * dense[at[spots]], len(rows))

        nodes: list[list] = []  # low, high, first child (the second is next to it), centroid's terms, its values, radii
        order = np.arange(len(sizes))
        todo = [(0, len(order), None)]
        nodes.append([])
        queue = [(0, 0, len(order))]
        while queue:
            node, low, high = queue.pop()
            rows = order[low:high]
            spots = ranges(begin[rows], sizes[rows])
            owner = np.repeat(np.arange(len(rows)), sizes[rows])
            # the ball: per group, the largest distance of a document from the centroid
            centre = np.bincount(at[spots], real[spots], len(terms)) / len(rows)
            cell = owner * space.groups + group[at[spots]]
            c = centre[at[spots]]
            change = np.bincount(cell, (real[spots] - c) ** 2 - c * c, len(rows) * space.groups).reshape(len(rows), space.groups)
            base = np.bincount(group, centre * centre, space.groups)
            norm = np.bincount(cell, real[spots] ** 2, len(rows) * space.groups).reshape(len(rows), space.groups)
            # what rounding may have taken away is far below this share of the squares
            radius = np.sqrt(np.maximum(change.max(axis=0) + base, 0) + 1e-10 * (base + norm.max(axis=0)))
            here = np.flatnonzero(centre)
            child = -1
            if len(rows) > leaf:
                a = int(rows[np.argmax(distances(rows, spots, owner, int(rows[0])))])
                from_a = distances(rows, spots, owner, a)
                b = int(rows[np.argmax(from_a)])
                half = len(rows) // 2
                order[low:high] = rows[np.argpartition(from_a - distances(rows, spots, owner, b), half)]
                child = len(nodes)
                nodes += [[], []]
                queue += [(child, low, low + half), (child + 1, low + half, high)]
            nodes[node] = [low, high, child, here, centre[here], radius]
        spots = ranges(begin[order], sizes[order])
        low, high, child, c_at, c_value, radius = zip(*nodes, strict=True)
        return cls(
            doc=doc[order], null=null[order], terms=terms.astype(np.int32), sizes=sizes[order], at=at[spots].astype(np.int32), value=value[spots].astype(np.int32),
            low=np.array(low), high=np.array(high), child=np.array(child), c_sizes=np.array([len(x) for x in c_at]), c_at=np.concatenate(c_at).astype(np.int32),
            c_value=np.concatenate(c_value), radius=np.stack(radius).astype(np.float64),
        )

    def local(self, term: np.ndarray, value: np.ndarray) -> np.ndarray:
        """An item's vector over the tree's own terms."""
        out = np.zeros(len(self.terms), np.int64)
        at = np.minimum(np.searchsorted(self.terms, term), len(self.terms) - 1)
        has = self.terms[at] == term
        out[at[has]] = value[has]
        return out

    def bounds(self, query: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """No document of a node scores more than its bound."""
        begin = np.cumsum(self.c_sizes) - self.c_sizes
        return (np.add.reduceat(self.c_value * query[self.c_at], begin) + self.radius @ norms) * (1 + 1e-9) + 1

    def scores(self, node: int, query: np.ndarray) -> np.ndarray:
        """Exact scores of a node's documents."""
        a, b = self.low[node], self.high[node]
        i, j = self.first[a], self.first[b]
        return np.add.reduceat(self.value[i:j] * query[self.at[i:j]], self.first[a:b] - i)

    @property
    def first(self) -> np.ndarray:
        if "_first" not in self.__dict__:
            self._first = np.concatenate([[0], np.cumsum(self.sizes)])
        return self._first


class Best:
    """The k best documents found for one item; a document below the floor can't be among them."""

    def __init__(self, k: int, floor: int) -> None:
        self.k, self.floor = k, floor
        self.score, self.doc, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        good = score >= self.floor
        if not good.any():
            return
        score, doc, null = (np.concatenate(x) for x in ((self.score, score[good]), (self.doc, doc[good]), (self.null, null[good])))
        order = np.lexsort((doc, null, -score))[: self.k]
        self.score, self.doc, self.null = score[order], doc[order], null[order]
        if len(order) == self.k:
            self.floor = max(self.floor, int(self.score[-1]))


def plant(rows: DataFrame, space: Space, leaf: int, documents: int = TREE_DOCUMENTS, terms: int = TREE_TERMS) -> DataFrame:
    """One row for each tree. Documents without a weighted term of any item are in none: they score 0."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n_docs, n_terms = [], 0, 0
        for batch in batches:
            doc = batch.column("doc_id")
            null = doc.is_null().to_numpy(zero_copy_only=False)
            term, tf = (np.frombuffer(b"".join(batch.column(x).to_pylist()), np.int32).astype(np.int64) for x in ("terms", "tfs"))
            sizes = np.array([len(x) // 4 for x in batch.column("terms").to_pylist()], np.int64)
            value = space.impacts(np.repeat(batch.column("n").to_numpy(), sizes), tf)
            use = (space.weights[term] > 0) & (value > 0)
            sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[use], minlength=len(sizes))
            term, value = term[use], value[use]
            some = sizes > 0
            doc, null, sizes = doc.fill_null(0).to_numpy()[some], null[some], sizes[some]
            low, ends = 0, np.cumsum(sizes)
            while low < len(doc):
                before = int(ends[low - 1]) if low else 0
                high = min(low + documents - n_docs, int(np.searchsorted(ends, before + terms - n_terms, "right")))
                high = max(high, low + (n_docs == 0))
                upto = int(ends[high - 1]) if high else 0
                waiting.append((doc[low:high], null[low:high], sizes[low:high], term[before:upto], value[before:upto]))
                n_docs, n_terms = n_docs + high - low, n_terms + upto - before
                if high < len(doc) or n_docs == documents:
                    yield grown(waiting)
                    waiting, n_docs, n_terms = [], 0, 0
                low = high
        if n_docs:
            yield grown(waiting)

    def grown(waiting: list[tuple]) -> pa.RecordBatch:
        tree = Tree.build(*(np.concatenate(x) for x in zip(*waiting, strict=True)), space, leaf)
        return pa.RecordBatch.from_arrays([pa.array([tree.dump()], pa.binary())], ["tree"])

    return rows.mapInArrow(task, "tree binary")


def visit(tree: Tree, query: np.ndarray, norms: np.ndarray, best: Best, leaves: int | None) -> int:
    """Search one tree best-first, at most `leaves` leaves if given; the number of leaves scored."""
    bounds = tree.bounds(query, norms)
    queue = [(-bounds[0], 0)]
    seen = 0
    while queue and -queue[0][0] >= best.floor and (leaves is None or seen < leaves):
        node = heapq.heappop(queue)[1]
        child = tree.child[node]
        if child < 0:
            a, b = tree.low[node], tree.high[node]
            best.add(tree.scores(node, query), tree.doc[a:b], tree.null[a:b])
            seen += 1
            continue
        for x in (child, child + 1):
            if bounds[x] >= best.floor:
                heapq.heappush(queue, (-min(bounds[x], bounds[node]), x))
    return seen


def walk(forest: DataFrame, items: Items, space: Space, k: int, floors: list[int], leaves: int | None) -> DataFrame:
    """number (of the item), doc_id, score: the best k of each task; visited: leaves scored."""
    schema = "number int, doc_id long, score long, visited long"
    vectors = []
    for term, repeats in zip(items.terms, items.repeats, strict=True):
        value = space.weights[term] * repeats
        term, value = term[value > 0], value[value > 0]
        order = np.argsort(term)
        norms = np.sqrt(np.bincount(space.group[term], value.astype(np.float64) ** 2, space.groups)) * (1 + 1e-12)
        vectors.append((term[order], value[order], norms))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k, x) for x in floors]
        seen = np.zeros(len(best), np.int64)
        for batch in batches:
            for data in batch.column("tree"):
                tree = Tree.load(data.as_py())
                for number, (term, value, norms) in enumerate(vectors):
                    query = tree.local(term, value)
                    if query.any():
                        seen[number] += visit(tree, query, norms, best[number], leaves)
        number = np.repeat(np.arange(len(best)), [len(x.score) for x in best])
        if len(number):
            doc, null, score = (np.concatenate([getattr(x, part) for x in best]) for part in ("doc", "null", "score"))
            yield pa.RecordBatch.from_arrays([pa.array(number.astype(np.int32)), pa.array(doc, mask=null), pa.array(score), pa.array(seen[number])], [x.split()[0] for x in schema.split(", ")])

    return forest.mapInArrow(task, schema)


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search_block(docs: DataFrame, items: Items, k: int, leaf: int, groups: int) -> DataFrame | None:
    """item_id, rank, doc_id, score of one block of items."""
    if not items.most:
        return None  # no terms at all
    rows = cut(frequencies(docs, items))
    documents, length = rows.agg(F.count("*"), F.sum("n")).first()
    if not documents:
        return None
    space = Space(documents, length, document_frequencies(rows, len(items.sizes)), groups)
    forest = cut(plant(rows, space, leaf))
    probe = ranked(walk(forest, items, space, k, [1] * len(items.ids), 1), k)
    floors = [1] * len(items.ids)
    for number, floor in probe.where(F.col("rank") == k).select("number", "score").collect():
        floors[number] = max(1, floor)
    found = ranked(walk(forest, items, space, k, floors, None), k)
    ids = docs.sparkSession.createDataFrame(list(enumerate(items.ids)), "number int, item_id long")
    return found.join(ids, "number").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = K, leaf: int = LEAF, groups: int = GROUPS, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score of the k documents (doc_id, text) that score highest for each item (item_id, text)."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = size // item_bytes + 1
    out = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).orderBy("item_id", "text")
        found = search_block(docs, Items([(x["item_id"], x["text"]) for x in own.toLocalIterator()]), k, leaf, groups)
        out = out if found is None else out.unionByName(found)
    return out


def op11_ball_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
