"""SimHash near-dedup: fingerprints linked by multi-index hashing, and their connected components.

A text is lower-cased (A-Z only) and cut into words `[^\\x20\\x09-\\x0D]+`; its shingles are four
words joined by a space, repeats included (1 to 3 words: one shingle of all of them). A bit of the
fingerprint is 1 if it is set in over half of the shingles' XXH64 values (UTF-8, seed 42).

Equal fingerprints become one point first. The 64 bits are cut into segments; two points at
`radius` bits or fewer differ by at most the segment's own radius in one segment at least
(pigeonhole, exact for every segment count). A point is entered in each segment's table under its
value, and looks up the small Hamming ball around that value; of two values only the smaller one
looks up the larger. Points that meet in a table entry are verified on all 64 bits. Only a spanning
forest of the verified links leaves an entry, so the rows made grow with points, not with pairs. An
entry of over `block` points is verified in pairs of blocks.

The segment count follows from the number of points: more points, longer segments with larger balls.
All counts give the same links; only the work differs.

Defined results: one row per input row, repeated rows and null ids included. A null, empty or blank
text has fingerprint zero and is linked like any other. component_id is the smallest doc_id that is
not null in the component (null if there is none). Extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm import arrowtext
from revlens.llm.shared import components, cut

SHINGLE = 4
SEED = 42
RADIUS = 4
BLOCK = 8192
#: Candidate pairs verified at once in a task; an entry with more of them is searched point by point.
PAIRS = 1 << 16
HASHED = 1 << 18
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LANES = np.uint64(0x0101010101010101)


def shingle_hashes(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle of the texts in a row, and each text's number of shingles."""
    from xxhash import xxh64_intdigest

    data, offsets = arrowtext.text_bytes(texts)
    starts, ends, text = arrowtext.words(data, offsets, arrowtext.NOT_SPACE)
    counts = np.bincount(text, minlength=len(texts))
    lengths = ends - starts
    finish = np.cumsum(lengths + 1) - 1
    begin = finish - lengths
    joined = np.full(int(finish[-1]) + 1 if len(finish) else 0, 32, np.uint8)
    within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    joined[within + np.repeat(begin, lengths)] = LOWER[data[within + np.repeat(starts, lengths)]]
    blob = joined.tobytes()
    after = np.cumsum(counts)[text]
    here = np.arange(len(text))
    kept = (here + size <= after) | ((here == after - counts[text]) & (counts[text] < size))
    first, last = begin[kept], finish[np.minimum(here + size, after)[kept] - 1]
    out = np.zeros(len(first), np.uint64)
    for k in range(0, len(first), HASHED):
        spans = zip(first[k : k + HASHED].tolist(), last[k : k + HASHED].tolist(), strict=True)
        out[k : k + HASHED] = np.fromiter((xxh64_intdigest(blob[a:b], SEED) for a, b in spans), np.uint64)
    return out, np.bincount(text[kept], minlength=len(texts))


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The fingerprint of each text: the bits set in over half of its hashes (zero without hashes).

    Eight bits are counted at a time in the eight bytes of an integer, over 255 hashes at most.
    """
    out = np.zeros(len(counts), np.uint64)
    full = counts > 0
    if not full.any():
        return out
    sizes = counts[full]
    parts = -(-sizes // 255)
    first_part = np.cumsum(parts) - parts
    within = np.arange(int(parts.sum())) - np.repeat(first_part, parts)
    cuts = np.repeat(np.cumsum(sizes) - sizes, parts) + within * 255
    ones = np.zeros((len(sizes), 64), np.int64)
    for bit in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(bit)) & LANES, cuts)
        ones[:, bit::8] = np.add.reduceat(sums.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64), first_part, axis=0)
    out[full] = np.packbits(2 * ones > sizes[:, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and the fingerprint fp (its 64 bits as a long) of every row."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrowtext.slices(batch, "text"):
                fp = majority(*shingle_hashes(part.column("text"), shingle))
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(task, "doc_id long, fp long")


def segment_plan(segments: int, radius: int) -> list[tuple[int, int, int]]:
    """(shift, width, own radius) of each segment that has to be searched.

    Were the distance over the own radius in every segment, it would be over `radius` in all.
    """
    base, rest = divmod(radius, segments)
    edges = [64 * k // segments for k in range(segments + 1)]
    radii = [base if k <= rest else base - 1 for k in range(segments)]
    return [(a, b - a, r) for a, b, r in zip(edges[:-1], edges[1:], radii, strict=True) if r >= 0]


def ball(width: int, radius: int) -> list[int]:
    """All bit masks of a segment with `radius` bits or fewer."""
    return [sum(1 << b for b in bits) for k in range(radius + 1) for bits in itertools.combinations(range(width), k)]


def choose_segments(points: int, radius: int) -> int:
    """The segment count (2 to 4) of least work: rows looked up, and pairs that meet by chance, each a thirtieth of a row's work."""

    def work(segments: int) -> float:
        return sum(sum(math.comb(w, k) for k in range(r + 1)) * (1 + points / 2**w / 30) for _, w, r in segment_plan(segments, radius))

    return min(range(2, 5), key=work)


def entries(points: DataFrame, segments: int, radius: int) -> DataFrame:
    """key (table entry), fp, own: each point under its own values, and where it looks up others."""
    plan = segment_plan(segments, radius)
    looked = [(k, shift, (1 << width) - 1, mask) for k, (shift, width, own) in enumerate(plan) for mask in ball(width, own)]
    table = F.array(*[F.struct(F.lit(k).cast("long").alias("segment"), F.lit(shift).alias("shift"), F.lit(ones).cast("long").alias("ones"), F.lit(mask).cast("long").alias("mask")) for k, shift, ones, mask in looked])
    rows = points.select("fp", F.explode(table).alias("x")).select("fp", "x.segment", "x.mask", F.expr("shiftrightunsigned(fp, x.shift) & x.ones").alias("value"))
    rows = rows.where("mask = 0 OR (value ^ mask) > value")
    return rows.select(F.expr("shiftleft(segment, 60) | (value ^ mask)").alias("key"), "fp", (F.col("mask") == 0).alias("own"))


def in_blocks(rows: DataFrame, block: int) -> DataFrame:
    """`rows` with the key of an entry of over `block` rows replaced by keys of its pairs of blocks."""
    large = rows.groupBy("key").agg(F.count("*").alias("n"), F.max("own").alias("has_own")).where(f"has_own AND n > {block}")
    large = cut(large.select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    if large.isEmpty():
        return rows
    placed = rows.join(large, "key").withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("key"), "fp", "own")
    return rows.join(large, "key", "left_anti").unionByName(placed)


def whole_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(key, fp, own) of sorted rows, all rows of a key together."""

    def columns(held: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        table = pa.Table.from_batches(held)
        key, fp, own = (table.column(x).combine_chunks().to_numpy(zero_copy_only=False) for x in ("key", "fp", "own"))
        return key, fp.view(np.uint64), own

    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy()
        if last is not None and key[-1] == last:
            held.append(batch)  # all of it is the last key
            continue
        start = int(np.searchsorted(key, key[-1], "left"))
        held.append(batch.slice(0, start))
        yield columns(held)
        held, last = [batch.slice(start)], key[-1]
    if held:
        yield columns(held)


def close(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= radius


def search(fp: np.ndarray, own: np.ndarray, radius: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Spanning forest of one large entry: every point reached looks among those not reached yet."""
    out, left = [], np.arange(len(fp))
    while len(left):
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            at = reached.pop()
            hit = close(fp[left], fp[at], radius)
            if not own[at]:
                hit &= own[left]
            found, left = left[hit], left[~hit]
            out.append((np.repeat(fp[at], len(found)), fp[found]))
            reached += found.tolist()
    return out


def forest(key: np.ndarray, fp: np.ndarray, own: np.ndarray, radius: int, pairs: int = PAIRS) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a, b) that connect, entry by entry, exactly the points that verified links connect.

    Rows are sorted by key, own rows first: pairs to verify are an own row and any row after it.
    """
    head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[head, len(key)])
    owns = np.add.reduceat(own.astype(np.int64), head)
    some = np.flatnonzero((owns > 0) & (size > 1))
    large = some[owns[some] * size[some] > pairs]
    links = [x for k in large for x in search(fp[head[k] : head[k] + size[k]], own[head[k] : head[k] + size[k]], radius)]
    small = np.setdiff1d(some, large, assume_unique=True)
    # own rows of the small entries, each with the rows after it
    row = np.repeat(head[small], owns[small]) + np.arange(int(owns[small].sum())) - np.repeat(np.cumsum(owns[small]) - owns[small], owns[small])
    after = np.repeat(head[small] + size[small], owns[small]) - row - 1
    done = np.cumsum(after)
    low = 0
    while low < len(row):
        high = max(low + 1, int(np.searchsorted(done, done[low] - after[low] + 16 * pairs, "right")))
        n, x = after[low:high], row[low:high]
        left = np.repeat(x, n)
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)
        near = close(fp[left], fp[right], radius)
        links.append(spanning(fp, left[near], right[near]))
        low = high
    if not links:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    both = np.unique(np.stack([np.concatenate(x) for x in zip(*links, strict=True)]), axis=1)
    return both[0], both[1]


def spanning(fp: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of rows replaced by one link of each row to the first row that it is connected with."""
    rows, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = at[: len(left)], at[len(left) :]
    root = np.arange(len(rows))
    while True:
        lower = root.copy()
        np.minimum.at(lower, a, root[b])
        np.minimum.at(lower, b, root[a])
        lower = lower[lower]
        if (lower == root).all():
            break
        root = lower
    moved = np.flatnonzero(root != np.arange(len(rows)))
    return fp[rows[root[moved]]], fp[rows[moved]]


def linked_points(points: DataFrame, radius: int = RADIUS, segments: int | None = None, block: int = BLOCK) -> DataFrame:
    """(a, b): pairs of distinct fingerprints `fp`; they connect exactly what links of `radius` bits or fewer connect."""
    segments = choose_segments(points.count(), radius) if segments is None else segments
    rows = in_blocks(entries(points, segments, radius), block)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, fp, own in whole_keys(batches):
            if len(key):
                a, b = forest(key, fp, own, radius)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return rows.repartition("key").sortWithinPartitions("key", F.desc("own"), "fp").mapInArrow(task, "a long, b long")


def near_components(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, segments: int | None = None, block: int = BLOCK) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id and component_size (rows) of every row."""
    signed = cut(fingerprints(docs, shingle))
    points = cut(signed.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")))
    roots = components(linked_points(points, radius, segments, block)).withColumnRenamed("node", "fp")
    rooted = points.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    heads = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("rows").alias("component_size"))
    named = rooted.join(heads, "root").select("fp", "component_id", "component_size")
    return signed.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "component_size")


def op12_multi_index_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
