"""N-gram Jaccard join: MinHash banding, then exact verification on full shingle sets.

Words are maximal runs of ASCII letters, digits, underscore or code points beyond ASCII in
the lower-cased text; a document's set holds its windows of five words (a shorter text: one
window of all its words). Documents with equal sets form a class first, so copies are never
paired. Band and row counts are chosen for a target recall at the threshold; band hashes are
shuffled, a bucket links its members to its smallest one, and the connected candidates are
verified block against block (`BLOCK` sets a side) on their full sets. Only link counts and
a spanning forest leave a block, so the rows made grow with documents, not with pairs.

Defined results: one row per input row. A null or empty text (or one without a word) has no
set and no links; its class is its own id. Rows with a null doc_id take no part (null class,
no links). Repeated rows are copies of each other. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm import arrowtext
from revlens.llm.shared import components, cut

SHINGLE = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.999
BLOCK = 128


def choose_bands(threshold: float, target_recall: float, quiet_at: float = 0.3, quiet: float = 0.25) -> tuple[int, int]:
    """(bands, rows): the fewest hashes that reach the recall at the threshold while pairs of
    similarity `quiet_at` become candidates with probability `quiet` at most."""
    best = None
    for rows in range(1, 17):
        miss = 1 - threshold**rows
        bands = max(1, math.ceil(math.log(1 - target_recall) / math.log(miss)))
        if 1 - (1 - quiet_at**rows) ** bands <= quiet and (best is None or bands * rows < best[0] * best[1]):
            best = (bands, rows)
    if best is None:
        raise ValueError("no band count fits these limits")
    return best


def seeds(n: int) -> np.ndarray:
    """Odd multipliers, one per hash function."""
    return arrowtext.mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def document_shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of a batch and their text numbers."""
    data, offsets = arrowtext.text_bytes(texts, lower=True)
    starts, ends, text = arrowtext.words(data, offsets, arrowtext.WORD_BYTES)
    return arrowtext.shingles(arrowtext.word_hashes(data, starts, ends), text, len(texts), size)


def distinct_per_text(values: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct values, ascending, texts in order."""
    order = np.lexsort((values, text))
    values, text = values[order], text[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    return values[fresh], text[fresh]


def fingerprints(values: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """Two 64-bit sums over each text's distinct shingles (0 for a text without any)."""
    sizes = np.bincount(text, minlength=n_texts)
    fp = np.zeros((2, n_texts), np.uint64)
    if len(values):
        first = (np.cumsum(sizes) - sizes)[sizes > 0]
        for k in range(2):
            fp[k, sizes > 0] = np.add.reduceat(arrowtext.mix(values + np.uint64(k + 1)), first)
    return fp.view(np.int64)


def sign(docs: DataFrame, bands: int, rows: int, shingle: int) -> DataFrame:
    """doc_id, set fingerprint (fp1, fp2), set size n and band hashes of every row."""
    schema = "doc_id long, fp1 long, fp2 long, n long, bands array<long>"
    multipliers = seeds(bands * rows)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrowtext.slices(batch, "text"):
                count = part.num_rows
                values, text = distinct_per_text(*document_shingles(part.column("text"), shingle))
                sizes = np.bincount(text, minlength=count)
                full = sizes > 0
                first = (np.cumsum(sizes) - sizes)[full]
                fp = fingerprints(values, text, count)
                signature = np.zeros((bands * rows, count), np.uint64)
                if len(values):
                    for k, m in enumerate(multipliers):
                        signature[k, full] = np.minimum.reduceat(values * m, first)
                keys = np.zeros((count, bands), np.uint64)
                for b in range(bands):
                    key = np.full(count, b + 1, np.uint64)
                    for r in range(rows):
                        key = arrowtext.mix(key * np.uint64(0x9E3779B97F4A7C15) + signature[b * rows + r])
                    keys[:, b] = key
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, count * bands + 1, bands), pa.int32()), pa.array(keys.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array(fp[0]), pa.array(fp[1]), pa.array(sizes.astype(np.int64)), lists],
                    ["doc_id", "fp1", "fp2", "n", "bands"],
                )

    return docs.select("doc_id", "text").mapInArrow(task, schema)


def shingle_sets(docs: DataFrame, shingle: int) -> DataFrame:
    """The columns other than text, and the distinct shingle hashes as ascending unsigned 64-bit integers.

    Rows whose set hasn't the fingerprint (fp1, fp2) are left out: an id that has several texts
    brings them all.
    """
    others = [c for c in docs.columns if c != "text"]
    schema = ", ".join(f"{c} {t}" for c, t in docs.dtypes if c != "text") + ", shingles binary"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrowtext.slices(batch, "text"):
                values, text = distinct_per_text(*document_shingles(part.column("text"), shingle))
                bounds = np.searchsorted(text, np.arange(part.num_rows + 1))
                sets = [values[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                out = pa.RecordBatch.from_arrays([*(part.column(c) for c in others), pa.array(sets, pa.binary())], [*others, "shingles"])
                fp = fingerprints(values, text, part.num_rows)
                same = [(fp[k] == part.column(f"fp{k + 1}").to_numpy()) for k in range(2)]
                yield out.filter(pa.array(same[0] & same[1]))

    return docs.mapInArrow(task, schema)


def linked(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs of sets reach the Jaccard threshold, by exact counts; no set is linked to itself."""
    n = len(sets)
    sizes = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(n), sizes)
    _, value = np.unique(np.concatenate(sets), return_inverse=True)
    frequent = np.bincount(value) >= 2
    column = np.cumsum(frequent) - 1
    keep = frequent[value]
    owner, value = owner[keep], column[value[keep]]
    order = np.argsort(value, kind="stable")
    owner, value = owner[order], value[order]
    both = np.zeros((n, n))
    width = max(1, min(1 << 16, (1 << 23) // n))
    for low in range(0, int(frequent.sum()), width):
        a, b = np.searchsorted(value, (low, low + width))
        dense = np.zeros((n, min(width, int(frequent.sum()) - low)), np.float32)
        dense[owner[a:b], value[a:b] - low] = 1
        both += dense @ dense.T
    union = sizes[:, None] + sizes[None, :] - both
    out = both >= threshold * union - 1e-9
    np.fill_diagonal(out, False)
    return out


def verify_block(threshold: float):
    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
        side = pdf["block"].to_numpy()
        links = linked([np.frombuffer(x, np.uint64) for x in pdf["shingles"]], threshold)
        if i != j:
            links &= side[:, None] != side[None, :]
        ids, copies = pdf["cid"].to_numpy(), pdf["copies"].to_numpy()
        root = ids.copy()
        while True:
            lower = np.minimum(root, np.where(links, root[None, :], np.iinfo(np.int64).max).min(axis=1))
            if (lower == root).all():
                break
            root = lower
        out = pd.DataFrame({"cid": ids, "group": pdf["group"], "links": links.sum(axis=1), "linked_docs": links @ copies, "root": root})
        return out[out["links"] > 0]

    return verify


def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD, target_recall: float = TARGET_RECALL, shingle: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """doc_id, class_id (smallest doc_id of the connected near-duplicates), copy_id (smallest doc_id
    with an equal set), n_copies (other rows with an equal set) and n_links (all other rows linked)."""
    bands, rows = choose_bands(threshold, target_recall)
    signed = cut(sign(docs, bands, rows, shingle))
    classes = cut(
        signed.where("n > 0 AND doc_id IS NOT NULL").groupBy("fp1", "fp2", "n")
        .agg(F.min("doc_id").alias("copy_id"), F.count("*").alias("copies"), F.min("bands").alias("bands"))
        .withColumn("cid", F.monotonically_increasing_id())
    )
    entries = classes.select("cid", F.posexplode("bands").alias("band", "hash"))
    buckets = entries.groupBy("band", "hash").agg(F.min("cid").alias("head"), F.max("cid").alias("tail")).where("head < tail")
    candidates = entries.join(buckets.select("band", "hash", "head"), ["band", "hash"]).where("cid <> head").select(F.col("cid").alias("a"), F.col("head").alias("b"))
    groups = components(candidates).withColumnRenamed("root", "group").withColumnRenamed("node", "cid")
    sizes = groups.groupBy("group").agg(F.count("*").alias("size"))
    members = groups.join(sizes, "group").join(classes.select("cid", "copy_id", "copies", "fp1", "fp2"), "cid")
    texts = docs.select(F.col("doc_id").alias("copy_id"), "text").where("copy_id IS NOT NULL AND text IS NOT NULL")
    sets = shingle_sets(members.join(texts, "copy_id").select("cid", "group", "size", "copies", "fp1", "fp2", "text"), shingle)
    sets = sets.dropDuplicates(["cid"])  # a repeated id brings its text more than once
    blocks = F.ceil(F.col("size") / block)
    placed = sets.withColumn("blocks", blocks.cast("int")).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select("cid", "group", "copies", "shingles", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "blocks")
    found = cut(
        placed.groupBy("group", "i", "j").applyInPandas(verify_block(threshold), "cid long, group long, links long, linked_docs long, root long")
    )
    counted = found.groupBy("cid").agg(F.sum("links").alias("links"), F.sum("linked_docs").alias("linked_docs"))
    roots = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "cid")
    own = classes.select("cid", "fp1", "fp2", "n", "copy_id", "copies").join(counted, "cid", "left").join(roots, "cid", "left")
    own = own.withColumn("root", F.coalesce("root", "cid"))
    heads = own.groupBy("root").agg(F.min("copy_id").alias("class_id"))
    own = own.join(heads, "root").select("fp1", "fp2", "n", "class_id", "copy_id", (F.col("copies") - 1).alias("n_copies"), (F.col("copies") - 1 + F.coalesce("linked_docs", F.lit(0))).alias("n_links"))
    out = signed.select("doc_id", "fp1", "fp2", "n").withColumn("takes_part", F.expr("n > 0 AND doc_id IS NOT NULL"))
    out = out.join(own.withColumn("takes_part", F.lit(True)), ["fp1", "fp2", "n", "takes_part"], "left")
    return out.select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("copy_id", "doc_id").alias("copy_id"),
        F.coalesce("n_copies", F.lit(0)).alias("n_copies"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD, target_recall: float = TARGET_RECALL) -> DataFrame:
    """`docs` with one document (the smallest id) of each near-duplicate class; all columns stay.

    Rows with a null doc_id stay. Rows that share an id stay or go together; of rows equal in
    id and text one stays.
    """
    heads = jaccard_join(docs, threshold, target_recall).where("doc_id = class_id").select(F.col("doc_id").alias("near_head_id")).distinct()
    kept = docs.join(heads, F.col("doc_id") == F.col("near_head_id"), "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.unionByName(docs.where("doc_id IS NULL"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(spark.read.parquet(f"{sf_dir}/documents.parquet"))
