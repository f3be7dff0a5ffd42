"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Bulk-synchronous best fit, largest first. Pieces are range-sorted by length over the cluster;
pieces of equal length, and sequences with an equal gap, form runs that are known by their
counts alone. A superstep takes the run of the largest length left, sweeps over the gap runs
from the successor of that length upwards (smallest sufficient gap first), gives every gap as
many pieces as fit, resolves which piece goes where by its rank in the run, updates the gaps
and opens new sequences for the rest. Runs depend on the capacity (at most one per length),
never on the number of documents, so the sweeps work on that bounded summary while ranking
and placing run over all rows on the executors. The result equals best-fit decreasing, one
piece at a time.

Defined results: a null or empty text is the end token alone; every input row is packed, so
repeated rows are packed once each; null ids stay null; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import bisect
import itertools
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm import arrowtext
from revlens.llm.shared import cut

CAPACITY = 2048
VOCABULARY = "word_bpe_49k.json"
CACHED_WORDS = 250_000


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


ALNUM = arrowtext.byte_class(b"abcdefghijklmnopqrstuvwxyz0123456789")
MARKS = arrowtext.byte_class(b".,;:!?)&*%$#")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def separated(column: pa.Array) -> list[bytes]:
    """Texts in which equal tokens look alike: ASCII letters lowered, a space between a letter or digit and a mark.

    The vocabulary lowers letters itself and splits there anyway. A text that might hold a
    special token's name stays as it is.
    """
    data, offsets = arrowtext.text_bytes(column)
    plain = LOWER[data]
    mark = MARKS[plain]
    mark[1:] &= ALNUM[plain[:-1]]
    mark[offsets[:-1][offsets[:-1] < len(mark)]] = False
    at = np.flatnonzero(mark)
    blob = np.insert(plain, at, np.uint8(32)).tobytes()
    moved = (offsets + np.searchsorted(at, offsets)).tolist()
    texts = [blob[a:b] for a, b in zip(moved[:-1], moved[1:], strict=True)]
    special = np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))
    for k in np.unique(np.searchsorted(offsets, special, "right") - 1).tolist():
        texts[k] = data[offsets[k] : offsets[k + 1]].tobytes()
    return texts


class WordIds(dict):
    """Numbers of words (bytes without ASCII white space), and their token ids.

    The vocabulary's splitter never joins characters across white space, so a text's ids are
    its words' ids in a row; a word is encoded once while it is remembered.
    """

    def __init__(self, vocabulary: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.fresh: list[bytes] = []
        self.flat, self.sizes, self.uses = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.fresh.append(word)
        return number

    def forget(self) -> None:
        """Keep the words that came up three times or more."""
        kept = self.uses > 2
        if kept.mean() > 0.5:
            kept[:] = False
        words = [w for w, k in zip(self, kept.tolist(), strict=True) if k]
        self.flat, self.sizes = self.flat[np.repeat(kept, self.sizes)], self.sizes[kept]
        self.uses = np.ones(len(words), np.int64)
        self.clear()
        self.update(zip(words, range(len(words)), strict=True))

    def learn(self, group: int = 500) -> None:
        """Encode the fresh words, many in one text; a token belongs to the word its offset lies in."""
        words = [x.decode() for x in self.fresh]
        groups = [words[k : k + group] for k in range(0, len(words), group)]
        flat, sizes = [self.flat], [self.sizes]
        for some, found in zip(groups, self.tokenizer.encode_batch([" ".join(x) for x in groups], add_special_tokens=False), strict=True):
            ends = np.cumsum([len(x) + 1 for x in some])
            begins = np.fromiter((a for a, _ in found.offsets), np.int64, len(found.ids))
            flat.append(np.array(found.ids, np.uint32))
            sizes.append(np.bincount(np.searchsorted(ends, begins, "right"), minlength=len(some)))
        self.flat, self.sizes, self.fresh = np.concatenate(flat), np.concatenate(sizes), []

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of ids of each text."""
        if len(self) > CACHED_WORDS:
            self.forget()
        split = [text.split() for text in texts]
        counts = np.array([len(x) for x in split], np.int64)
        word = np.fromiter(map(self.__getitem__, itertools.chain.from_iterable(split)), np.int64, int(counts.sum()))
        if self.fresh:
            self.learn()
        self.uses = np.concatenate([self.uses, np.zeros(len(self) - len(self.uses), np.int64)]) + np.bincount(word, minlength=len(self))
        sizes = self.sizes[word]
        begin = (np.cumsum(self.sizes) - self.sizes)[word]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[np.arange(total[-1]) + np.repeat(begin - total[:-1], sizes)]
        return ids, np.diff(total[np.concatenate([[0], np.cumsum(counts)])])


class Vocabulary:
    """A vocabulary file's text; its words are remembered by each worker process, across tasks."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.words: WordIds | None = None

    def known(self) -> WordIds:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if self.words is None:
            self.words = WordIds(self.text)
        return self.words


def pieces(docs: DataFrame, capacity: int, vocabulary: str, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every document, cut at the capacity only."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    with open(vocabulary, encoding="utf-8") as file:
        shipped = docs.sparkSession.sparkContext.broadcast(Vocabulary(file.read()))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shipped.value.known()
        for batch in batches:
            for part in arrowtext.slices(batch, "text"):
                ids, sizes = known.encode(separated(part.column("text")))
                last = np.cumsum(sizes)
                ids = np.insert(ids, last, np.uint32(end_id)).astype("<u4")
                sizes = sizes + 1
                begin = np.cumsum(sizes) - sizes
                n_pieces = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), n_pieces)
                number = np.arange(len(row)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
                start = number * capacity
                length = np.minimum(sizes[row] - start, capacity)
                a = begin[row] + start
                crc = [zlib.crc32(ids[i:j].tobytes()) for i, j in zip(a, a + length, strict=True)]
                columns = [part.column("doc_id").cast(pa.int64()).take(pa.array(row)), pa.array(number, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([a, [len(ids)]]), pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in schema.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(task, schema)


def sweep(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Placements of runs as rows (length, first rank, first sequence, sequences, pieces in each, offset).

    `counts`: pieces of each length. Rank r of a length lies in the row with the last first rank
    <= r, in sequence `first sequence + (r - first rank) // pieces in each`.
    """
    gaps: list[int] = []  # ascending gap sizes that have runs
    runs: dict[int, list[tuple[int, int]]] = {}  # gap -> (first sequence, sequences)
    out, opened = [], 0

    def put(gap: int, first: int, many: int) -> None:
        if many and gap:
            if gap not in runs:
                bisect.insort(gaps, gap)
                runs[gap] = []
            runs[gap].append((first, many))

    def fill(length: int, rank: int, left: int, gap: int, first: int, many: int) -> int:
        """Pieces placed into `many` sequences with this gap; what stays open is put back."""
        each = gap // length
        full = min(many, left // each)
        rest = min(left - full * each, each) if full < many else 0
        if full:
            out.append((length, rank, first, full, each, capacity - gap))
            put(gap - each * length, first, full)
        if rest:
            out.append((length, rank + full * each, first + full, 1, rest, capacity - gap))
            put(gap - rest * length, first + full, 1)
        used = full + bool(rest)
        put(gap, first + used, many - used)
        return full * each + rest

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left and (k := bisect.bisect_left(gaps, length)) < len(gaps):
            gap = gaps[k]
            first, many = runs[gap].pop()
            if not runs[gap]:
                del runs[gap]
                gaps.pop(k)
            placed = fill(length, rank, left, gap, first, many)
            rank, left = rank + placed, left - placed
        if left:
            new = -(-left // (capacity // length))
            fill(length, rank, left, capacity, opened, new)
            opened += new
    out.sort()
    return np.array(out, np.int64).reshape(-1, 6)


def place(parts: DataFrame, capacity: int) -> DataFrame:
    """`parts` (with doc_id, piece, length <= capacity) and their sequence_id and offset."""
    parts = cut(parts)
    ordered = cut(parts.repartitionByRange("length", "doc_id", "piece").sortWithinPartitions("length", "doc_id", "piece"))
    # a range-sorted partition holds few lengths: partitions + capacity rows at most
    found = ordered.groupBy(F.spark_partition_id().alias("pid"), "length").count().collect()
    totals: dict[int, int] = {}
    offsets: dict[int, dict[int, int]] = {}
    for pid, length, count in sorted(found):
        offsets.setdefault(pid, {})[length] = totals.get(length, 0)
        totals[length] = totals.get(length, 0) + count
    shipped = parts.sparkSession.sparkContext.broadcast((offsets, sweep(totals, capacity)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        offsets, plan = shipped.value
        here = dict(offsets.get(TaskContext.get().partitionId(), {}))
        key = plan[:, 0] << 44 | plan[:, 1]
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch.column("length").to_numpy()
            rank = np.empty(len(length), np.int64)
            edges = np.concatenate([[0], np.flatnonzero(np.diff(length)) + 1, [len(length)]])
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                size = int(length[a])
                rank[a:b] = here[size] + np.arange(b - a)
                here[size] += int(b - a)
            row = plan[np.searchsorted(key, length << 44 | rank, "right") - 1]
            within = rank - row[:, 1]
            sequence = row[:, 2] + within // row[:, 4]
            offset = row[:, 5] + within % row[:, 4] * length
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence), pa.array(offset)], [*batch.schema.names, "sequence_id", "offset"])

    schema = ", ".join(f"{c} {t}" for c, t in parts.dtypes) + ", sequence_id long, offset long"
    return ordered.mapInArrow(task, schema)


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its sequence and offset; sequences are gapless from 0."""
    return place(pieces(docs, capacity, vocabulary or vocabulary_path(), with_ids=with_ids), capacity)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
