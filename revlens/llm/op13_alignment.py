"""Cross-tokenizer alignment: which tokens of two vocabularies stand for the same bytes.

Vocabulary A is a byte-level BPE file, B a piece file with byte fallback. A encodes a space and the
text, B the text (it adds the space itself). Each token covers a range of bytes. The work is sparse
matrix products in hand-built CSR, row by row as Gustavson does:

* token-byte incidence: A . B^T holds, for every A token and B token, the bytes both cover: the
  overlap links. Going along them, a group ends where both move on to a new token, that is where
  both end at one byte.
* group incidence: (A id x group counts) . (group x B id counts) holds how often two ids share a
  group: the shared-group links, by id pair, without listing occurrences.

Neither vocabulary joins anything across a space that follows a character other than white space
(checked for B's pieces; A's splitter breaks there), so a text is the sequence of its chunks, cut
before such spaces, and a chunk is encoded and aligned once while a worker remembers it.

Each text becomes a row with its sums and its id pairs. The corpus-wide count of a pair is the
number of rows that hold it; counts are summed over the cluster. They go back to the rows in blocks
of at most `pairs_per_block` pairs, one pass over the rows for each block, so that what a task is
sent stays bounded however many pairs there are.

Defined results: one row per input row, repeated rows and null ids included (each counts as a
document). Null or empty texts, and texts whose tokens' bytes are not a space and the text (B
reads U+2581 as a space), have zeros and the empty string. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.llm import arrowtext
from revlens.llm.shared import cut

VOCABULARY_A = "byte_bpe_50k.json"
VOCABULARY_B = "piece_bpe_32k.model"
PAIRS_PER_BLOCK = 2_000_000
CACHED_CHUNKS = 200_000
CACHED_BYTES = 1 << 24
GROUP = 500
SPACE = "\u2581"
#: A space after a character that no splitter takes for white space.
CUT = re.compile("(?<=[^\\s\x00-\x20\x7f-\xa0\u1680\u180e\u2000-\u206f\u3000\ufeff]) ")
DIGEST = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, groups_sha256 string, pairs binary"


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def ranges(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, .. (sizes[0] numbers), begin[1], .."""
    return np.arange(int(sizes.sum())) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)


@dataclass
class Csr:
    """A sparse matrix of counts: the columns and values of each row, columns ascending."""

    indptr: np.ndarray
    indices: np.ndarray
    values: np.ndarray
    n_cols: int

    @classmethod
    def from_entries(cls, rows: np.ndarray, cols: np.ndarray, values: np.ndarray, n_rows: int, n_cols: int) -> Csr:
        """Entries in any order; those of one place are added."""
        place = rows * n_cols + cols
        if len(place) and not (place[1:] >= place[:-1]).all():
            order = np.argsort(place, kind="stable")
            place, values = place[order], values[order]
        head = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if len(place) else np.zeros(0, np.int64)
        place = place[head]
        total = np.add.reduceat(values, head) if len(head) else values
        return cls(np.searchsorted(place, np.arange(n_rows + 1) * n_cols), place % n_cols, total, n_cols)

    @property
    def rows(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))

    def transpose(self) -> Csr:
        return Csr.from_entries(self.indices, self.rows, self.values, self.n_cols, len(self.indptr) - 1)

    def times(self, other: Csr) -> Csr:
        """Gustavson's product: row i is the sum of the other's rows k, each times the entry (i, k)."""
        sizes = np.diff(other.indptr)[self.indices]
        spots = ranges(other.indptr[self.indices], sizes)
        return Csr.from_entries(np.repeat(self.rows, sizes), other.indices[spots], np.repeat(self.values, sizes) * other.values[spots], len(self.indptr) - 1, other.n_cols)


def incidence(lengths: np.ndarray) -> Csr:
    """Tokens by bytes: a token covers the bytes that follow the token before it."""
    total = int(lengths.sum())
    return Csr(np.concatenate([[0], np.cumsum(lengths)]), np.arange(total), np.ones(total, np.int64), total)


def token_groups(overlap: Csr) -> tuple[np.ndarray, np.ndarray]:
    """The group of each A token and of each B token; a group ends where both move on."""
    a, b = overlap.rows, overlap.indices
    group = np.cumsum(np.r_[False, (a[1:] != a[:-1]) & (b[1:] != b[:-1])]) if len(a) else a
    return group[overlap.indptr[:-1]], group[np.flatnonzero(np.r_[True, b[1:] != b[:-1]])] if len(b) else b


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: itself where it can be printed, else the next free letter from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Aligner:
    """Both tokenizers, and what is known of the chunks met: numbers of tokens, groups and links, id pairs, and the groups in writing."""

    COUNTS = ("n_a", "n_b", "n_groups", "n_links", "n_overlaps")

    def __init__(self, vocabulary_a: str, vocabulary_b: bytes) -> None:
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(vocabulary_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=vocabulary_b)
        splitter = json.loads(vocabulary_a)["pre_tokenizer"] or {}
        if splitter.get("type") != "ByteLevel" or splitter.get("add_prefix_space") or not splitter.get("use_regex", True):
            raise ValueError("vocabulary A has to split texts as byte-level vocabularies do")
        letters = byte_letters()
        entries = self.a.get_vocab(with_added_tokens=False)
        added = {x["id"] for x in json.loads(vocabulary_a)["added_tokens"]}
        self.size_a = max([*entries.values(), *added]) + 1
        self.bytes_a = [b""] * self.size_a
        for entry, number in entries.items():
            if number not in added:
                self.bytes_a[number] = bytes(letters[x] for x in entry)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.vocab_size())]
        if any(SPACE in x.lstrip(SPACE) for x in pieces):
            raise ValueError("a piece of vocabulary B reaches over the start of a word")
        self.size_b = len(pieces)
        self.bytes_b = [bytes([int(x[3:5], 16)]) if self.b.is_byte(k) else x.replace(SPACE, " ").encode() for k, x in enumerate(pieces)]
        self.lengths_a, self.lengths_b = (np.array([len(x) for x in y], np.int64) for y in (self.bytes_a, self.bytes_b))
        # each id in writing with what may follow it
        self.written_a = np.array([f"{k}{mark}" for mark in ",|" for k in range(self.size_a)], object)
        self.written_b = np.array([f"{k}{mark}" for mark in ",;\n" for k in range(self.size_b)], object)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.fresh: list[str] = []
        self.valid = np.zeros(0, bool)
        self.counts = {x: np.zeros(0, np.int64) for x in self.COUNTS}
        self.written: list[str] = []
        self.pair_first, self.pairs, self.pair_links = np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.bytes_known = 0

    def numbered(self, pieces: list[str]) -> list[int]:
        known, fresh = self.number, self.fresh
        out = []
        for piece in pieces:
            at = known.get(piece)
            if at is None:
                at = known[piece] = len(known)
                fresh.append(piece)
            out.append(at)
        return out

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Ids of a space and each text in A and in B; None where the tokens' bytes are others."""
        found_a = [x.ids for x in self.a.encode_batch([" " + x for x in texts], add_special_tokens=False)]
        # B adds a space to nothing but an empty text
        found_b = [x if y else [self.b.piece_to_id(SPACE)] for x, y in zip(self.b.encode(texts, num_threads=1), texts, strict=True)]
        out: list[tuple[list[int], list[int]] | None] = []
        for text, a, b in zip(texts, found_a, found_b, strict=True):
            data = (" " + text).encode()
            same = b"".join([self.bytes_a[x] for x in a]) == data and b"".join([self.bytes_b[x] for x in b]) == data
            out.append((a, b) if same else None)
        return out

    def learn(self) -> None:
        """Encode and align the fresh chunks, many in one text where that can't change them."""
        fresh, self.fresh = self.fresh, []
        plain = [k for k, x in enumerate(fresh) if x and SPACE not in x and CUT.match(x + " ", len(x))]
        batches = [plain[k : k + GROUP] for k in range(0, len(plain), GROUP)]
        alone = sorted(set(range(len(fresh))).difference(plain))
        order, ids_a, ids_b = [], [], []
        sizes = np.array([len(x.encode()) + 1 for x in fresh], np.int64)
        for batch, found in zip(batches, self.encode([" ".join([fresh[k] for k in x]) for x in batches]), strict=True):
            if found is not None:
                ends = np.cumsum(sizes[batch])
                if all(np.isin(ends, np.cumsum(lengths[x])).all() for x, lengths in zip(found, (self.lengths_a, self.lengths_b), strict=True)):
                    order += batch
                    ids_a += found[0]
                    ids_b += found[1]
                    continue
            alone += batch
        bad = []
        for k, found in zip(alone, self.encode([fresh[k] for k in alone]) if alone else [], strict=True):
            if found is None:
                bad.append(k)
                continue
            order.append(k)
            ids_a += found[0]
            ids_b += found[1]
        self.keep(np.array(order, np.int64), np.array(bad, np.int64), sizes, np.array(ids_a, np.int64), np.array(ids_b, np.int64))

    def keep(self, order: np.ndarray, bad: np.ndarray, sizes: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray) -> None:
        """Align the tokens of the fresh chunks `order` (in a row) and remember the results."""
        n = len(sizes)
        ends = np.cumsum(sizes[order])
        first, second = incidence(self.lengths_a[ids_a]), incidence(self.lengths_b[ids_b])
        overlap = first.times(second.transpose())
        group_a, group_b = token_groups(overlap)
        chunk_a, chunk_b = (order[np.searchsorted(ends, x.indptr[1:])] for x in (first, second))
        n_groups = int(group_a[-1]) + 1 if len(group_a) else 0
        # distinct A ids of each chunk as rows
        own, row = np.unique(chunk_a * self.size_a + ids_a, return_inverse=True)
        left = Csr.from_entries(row, group_a, np.ones(len(row), np.int64), len(own), n_groups) if n_groups else None
        right = Csr.from_entries(group_b, ids_b, np.ones(len(ids_b), np.int64), n_groups, self.size_b) if n_groups else None
        links = left.times(right) if n_groups else Csr(np.zeros(1, np.int64), own, own, self.size_b)
        chunk, a = own[links.rows] // self.size_a, own[links.rows] % self.size_a
        each_group = np.flatnonzero(np.r_[True, group_a[1:] != group_a[:-1]]) if n_groups else group_a
        valid = np.ones(n, bool)
        valid[bad] = False
        self.valid = np.concatenate([self.valid, valid])
        link_count = np.zeros(n, np.int64)
        np.add.at(link_count, chunk, links.values)
        fresh_counts = (np.bincount(chunk_a, minlength=n), np.bincount(chunk_b, minlength=n), np.bincount(chunk_a[each_group], minlength=n), link_count, np.bincount(chunk_a[overlap.rows], minlength=n))
        for name, values in zip(self.COUNTS, fresh_counts, strict=True):
            self.counts[name] = np.concatenate([self.counts[name], values])
        # own is sorted by chunk, so links lie chunk by chunk
        self.pairs = np.concatenate([self.pairs, a * self.size_b + links.indices])
        self.pair_links = np.concatenate([self.pair_links, links.values])
        self.pair_first = np.concatenate([self.pair_first, self.pair_first[-1] + np.cumsum(np.bincount(chunk, minlength=n))])
        written = [""] * n
        for k, text in zip(order.tolist(), self.in_writing(ids_a, ids_b, group_a, group_b, chunk_b), strict=True):
            written[k] = text
        self.written += written
        self.bytes_known += int(sizes.sum())

    def in_writing(self, ids_a: np.ndarray, ids_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, chunk_b: np.ndarray) -> list[str]:
        """a1,a2|b1;a3|b2,b3 of each chunk."""
        if not len(ids_a):
            return []
        last_a = np.r_[group_a[1:] != group_a[:-1], True]
        last_b = np.r_[group_b[1:] != group_b[:-1], True]
        end = np.r_[chunk_b[1:] != chunk_b[:-1], True]
        marks = np.concatenate([self.written_a[ids_a + self.size_a * last_a], self.written_b[ids_b + self.size_b * (last_b.astype(np.int64) + end)]])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        return "".join(marks[order].tolist()).split("\n")[:-1]

    def digest(self, texts: list[str | None]) -> tuple[dict[str, np.ndarray], list[str], list[bytes]]:
        """Counts, hash and packed id pairs of each text."""
        if len(self.number) > CACHED_CHUNKS or self.bytes_known > CACHED_BYTES:
            self.forget()
        numbers = [self.numbered(CUT.split(x)) if x else [] for x in texts]
        if self.fresh:
            self.learn()
        n = len(texts)
        sizes = np.array([len(x) for x in numbers], np.int64)
        chunk = np.fromiter(itertools.chain.from_iterable(numbers), np.int64, int(sizes.sum()))
        text = np.repeat(np.arange(n), sizes)
        valid = sizes > 0
        valid[text[~self.valid[chunk]]] = False
        chunk, text = chunk[valid[text]], text[valid[text]]
        counts = {}
        for name, values in self.counts.items():
            counts[name] = np.zeros(n, np.int64)
            np.add.at(counts[name], text, values[chunk])
        written = [hashlib.sha256(";".join([self.written[k] for k in x]).encode()).hexdigest() if ok else "" for x, ok in zip(numbers, valid.tolist(), strict=True)]
        # a text's distinct chunks, then their pairs
        held, times = np.unique(text * len(self.number) + chunk, return_counts=True)
        text, chunk = held // max(1, len(self.number)), held % max(1, len(self.number))
        first, per_chunk = self.pair_first[chunk], np.diff(self.pair_first)[chunk]
        spots = ranges(first, per_chunk)
        packed = Csr.from_entries(np.repeat(text, per_chunk), self.pairs[spots], np.repeat(times, per_chunk) * self.pair_links[spots], n, self.size_a * self.size_b)
        squeeze = zstandard.ZstdCompressor(level=1).compress
        blobs = [squeeze(np.concatenate([np.diff(packed.indices[a:b], prepend=0), packed.values[a:b]]).astype("<u4" if self.size_a * self.size_b < 2**32 else "<u8").tobytes()) for a, b in itertools.pairwise(packed.indptr.tolist())]
        return counts, written, blobs


class Vocabularies:
    """Both files' contents; the aligner made of them stays with a worker process, across tasks."""

    def __init__(self, path_a: str, path_b: str) -> None:
        with open(path_a, encoding="utf-8") as file:
            self.a = file.read()
        with open(path_b, "rb") as file:
            self.b = file.read()
        self.aligner: Aligner | None = None

    def known(self) -> Aligner:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if self.aligner is None:
            self.aligner = Aligner(self.a, self.b)
        return self.aligner

    def __getstate__(self) -> dict:
        return {"a": self.a, "b": self.b, "aligner": None}


def digests(docs: DataFrame, vocabularies: Vocabularies) -> DataFrame:
    """One row per text: its counts, the hash of its groups and its id pairs with their links."""
    shipped = docs.sparkSession.sparkContext.broadcast(vocabularies)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = shipped.value.known()
        for batch in batches:
            for part in arrowtext.slices(batch, "text"):
                counts, written, blobs = aligner.digest(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), *(pa.array(counts[x]) for x in Aligner.COUNTS), pa.array(written), pa.array(blobs, pa.binary())],
                    ["doc_id", *Aligner.COUNTS, "groups_sha256", "pairs"],
                )

    schema = DIGEST.removeprefix("row long, ")
    rows = docs.select("doc_id", "text").mapInArrow(task, schema)
    return rows.select(F.monotonically_increasing_id().alias("row"), *rows.columns)


def unpacked(blobs: list[bytes], wide: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs, links and row number of the packed id pairs of some rows."""
    expand = zstandard.ZstdDecompressor().decompress
    parts = [np.frombuffer(expand(x), "<u8" if wide else "<u4") for x in blobs]
    sizes = np.array([len(x) // 2 for x in parts], np.int64)
    pairs = [np.cumsum(x[: len(x) // 2].astype(np.int64)) for x in parts]
    links = [x[len(x) // 2 :].astype(np.int64) for x in parts]
    return np.concatenate(pairs), np.concatenate(links), np.repeat(np.arange(len(parts)), sizes)


def pair_counts(rows: DataFrame, size_a: int, size_b: int, gathered: int = 1 << 22) -> DataFrame:
    """pair (a * size_b + b), documents (that hold it linked) and best (no other pair of its A id has more)."""
    wide = size_a * size_b >= 2**32

    def total(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        found, at = np.unique(np.concatenate(pairs), return_inverse=True)
        out = np.zeros(len(found), np.int64)
        np.add.at(out, at, np.concatenate(counts))
        return found, out

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, waiting = [], [], 0

        def flush() -> pa.RecordBatch:
            found, n = total(pairs, counts)
            return pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["pair", "documents"])

        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                found, _, _ = unpacked(batch.column("pairs").slice(k, 512).to_pylist(), wide)
                found, n = np.unique(found, return_counts=True)
                pairs.append(found)
                counts.append(n)
                waiting += len(found)
                if waiting > gathered:
                    found, n = total(pairs, counts)
                    pairs, counts, waiting = [found], [n], len(found)
                    if waiting > gathered // 2:
                        yield flush()
                        pairs, counts, waiting = [], [], 0
        if waiting:
            yield flush()

    summed = rows.select("pairs").mapInArrow(task, "pair long, documents long").groupBy("pair").agg(F.sum("documents").alias("documents"))
    own = Window.partitionBy(F.expr(f"pair div {size_b}"))
    return summed.withColumn("best", F.col("documents") == F.max("documents").over(own))


def add_counts(rows: DataFrame, counted: DataFrame, wide: bool, pairs_per_block: int) -> DataFrame:
    """The rows without their pairs, with n_best and count_sum."""
    context = rows.sparkSession.sparkContext
    blocks = max(1, -(-counted.count() // pairs_per_block))
    kept = [x for x in rows.columns if x != "pairs"]
    schema = ", ".join(f"{x} {t}" for x, t in rows.dtypes if x != "pairs") + ", n_best long, count_sum long"

    def part(block: int) -> DataFrame:
        own = counted.where(F.pmod(F.xxhash64("pair"), F.lit(blocks)) == block).select("pair", F.expr("documents * 2 + int(best)").alias("value")).toArrow()
        order = np.argsort(own.column("pair").to_numpy())
        shipped = context.broadcast((own.column("pair").to_numpy()[order], own.column("value").to_numpy()[order]))

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, value = shipped.value
            for batch in batches:
                for k in range(0, batch.num_rows, 512):
                    some = batch.slice(k, 512)
                    pair, links, row = unpacked(some.column("pairs").to_pylist(), wide)
                    at = np.minimum(np.searchsorted(known, pair), max(0, len(known) - 1))
                    has = known[at] == pair if len(known) else np.zeros(len(pair), bool)
                    at, links, row = at[has], links[has], row[has]
                    best, total = np.zeros(some.num_rows, np.int64), np.zeros(some.num_rows, np.int64)
                    np.add.at(best, row, links * (value[at] & 1))
                    np.add.at(total, row, links * (value[at] >> 1))
                    yield pa.RecordBatch.from_arrays([*(some.column(x) for x in kept), pa.array(best), pa.array(total)], [*kept, "n_best", "count_sum"])

        return rows.mapInArrow(task, schema)

    parts = part(0)
    for block in range(1, blocks):
        parts = parts.unionByName(part(block))
    return parts if blocks == 1 else parts.groupBy(*kept).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def dictionary(docs: DataFrame, vocabulary_a: str | None = None, vocabulary_b: str | None = None) -> DataFrame:
    """a, b, documents, best: which ids of the two vocabularies stand for the same bytes, and in how many documents."""
    vocabularies = Vocabularies(vocabulary_a or vocabulary_path(VOCABULARY_A), vocabulary_b or vocabulary_path(VOCABULARY_B))
    aligner = Aligner(vocabularies.a, vocabularies.b)
    counted = pair_counts(digests(docs, vocabularies), aligner.size_a, aligner.size_b)
    return counted.select(F.expr(f"pair div {aligner.size_b}").alias("a"), F.expr(f"pair % {aligner.size_b}").alias("b"), "documents", "best")


def align(docs: DataFrame, vocabulary_a: str | None = None, vocabulary_b: str | None = None, pairs_per_block: int = PAIRS_PER_BLOCK) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 and n_overlaps (overlap links) of every row."""
    vocabularies = Vocabularies(vocabulary_a or vocabulary_path(VOCABULARY_A), vocabulary_b or vocabulary_path(VOCABULARY_B))
    aligner = Aligner(vocabularies.a, vocabularies.b)
    rows = cut(digests(docs, vocabularies))
    counted = cut(pair_counts(rows, aligner.size_a, aligner.size_b))
    out = add_counts(rows, counted, aligner.size_a * aligner.size_b >= 2**32, pairs_per_block)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps")


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(spark.read.parquet(f"{sf_dir}/documents.parquet"))
