"""Toxicity: a linear classifier on words, regularised with counterfactual identity swaps.

A text is its set of words (lower case; ASCII letters, digits, underscore or code points beyond
ASCII) and of their stems (the first `STEMS` bytes of longer words that are no identity terms), hashed to `FEATURES` places. The classifier is a logistic regression with a sparse
penalty, fitted on a bounded sample: the `SAMPLE` labelled rows with the smallest id hash among
those whose crc32(doc_id as text) mod 5 is not 0. Every sampled text that names a group is
copied with its identity terms (plurals too) swapped for others of the list; as these have no
stems, swapped places are those of the swapped text. The squared change of the score between original and copies is penalised, so that a neutral mention does not raise it.
The fit uses the `SELECTED` places whose share of toxic texts is furthest from the mean, and the identity terms; all
other words of the bounded sample tell nothing or too little to be learned. Scoring reads whole texts and nothing else.

Defined results: one row per input row; null and empty texts get the score of a text without a
known word; a null doc_id is not held out; null labels are not learned from; of several labels
of an id the largest counts, and of its texts the first in byte order of their words is learned from; rows repeat as they come; extra columns are ignored. With no
labelled row the score is 0 for all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.llm import arrowtext
from revlens.llm.op08_jaccard import distinct_per_text
from revlens.llm.shared import smallest

FEATURES = 1 << 20
SAMPLE = 12_000
STEMS = (4, 5, 6)
SELECTED = 1000
SWAPS = 4
SWAP_WEIGHT = 1.0

#: Group names that are swapped for one another.
IDENTITY_TERMS = (
    "christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "catholic", "protestant", "black", "white", "asian",
    "african", "european", "latino", "arab", "american", "indian", "chinese", "mexican", "immigrant", "refugee", "gay",
    "lesbian", "bisexual", "straight", "transgender", "female", "male", "women", "men", "disabled", "blind", "deaf", "old", "young",
)
IDENTITY_TERMS += tuple(
    f"{x}s" for x in (
        "christian", "muslim", "hindu", "buddhist", "atheist", "catholic", "protestant", "black", "white", "asian", "african", "european", "latino",
        "arab", "american", "indian", "mexican", "immigrant", "refugee", "gay", "lesbian", "bisexual", "straight", "female", "male",
    )
)


def identity_hashes() -> np.ndarray:
    """Word hashes of the identity terms, ascending."""
    data, offsets = arrowtext.text_bytes(pa.array(IDENTITY_TERMS))
    starts, ends, _ = arrowtext.words(data, offsets, arrowtext.WORD_BYTES)
    return np.unique(arrowtext.word_hashes(data, starts, ends))


def places(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature places of every word and, identity terms aside, of its stems, and their text numbers (ascending)."""
    data, offsets = arrowtext.text_bytes(texts, lower=True)
    starts, ends, text = arrowtext.words(data, offsets, arrowtext.WORD_BYTES)
    found, owner = [arrowtext.word_hashes(data, starts, ends)], [text]
    identity = identity_hashes()
    stemmed = identity[np.searchsorted(identity[:-1], found[0])] != found[0]
    for size in STEMS:
        longer = stemmed & (ends - starts > size)
        found.append(arrowtext.mix(arrowtext.word_hashes(data, starts[longer], starts[longer] + size) + np.uint64(size)))
        owner.append(text[longer])
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return (np.concatenate(found)[order] % np.uint64(FEATURES)).astype(np.int64), owner[order]


def identity_places() -> np.ndarray:
    """Places of the identity terms."""
    return np.unique((identity_hashes() % np.uint64(FEATURES)).astype(np.int64))


def swapped(present: np.ndarray, identity: np.ndarray, seed: int) -> np.ndarray | None:
    """A text's features with each identity term replaced by another one; None without such a term."""
    named = np.isin(present, identity)
    if not named.any():
        return None
    shift = np.random.default_rng(seed).integers(1, len(identity), int(named.sum()))
    at = np.searchsorted(identity, present[named])
    return np.unique(np.concatenate([present[~named], identity[(at + shift) % len(identity)]]))


def telling(flat: np.ndarray, owner: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Which places have a share of toxic texts furthest from the mean; one seen once or twice says nothing."""
    seen, toxic, block = np.zeros(FEATURES), np.zeros(FEATURES), 1 << 20
    for low in range(0, len(flat), block):  # counting copies what it counts
        part, bad = flat[low : low + block], labels[owner[low : low + block]] > 0
        seen += np.bincount(part, minlength=FEATURES)
        toxic += np.bincount(part[bad], minlength=FEATURES)
    mean = labels.mean()
    away = np.abs(toxic - seen * mean) / np.sqrt(seen * mean * (1 - mean) + 1e-9)
    away[seen < 3] = 0
    chosen = np.zeros(FEATURES, bool)
    chosen[np.argsort(-away, kind="stable")[:SELECTED]] = True
    return chosen & (away > 0)


def fit(rows: list[np.ndarray], labels: np.ndarray, swap_weight: float = SWAP_WEIGHT, rounds: int = 200, rate: float = 0.3, sparse: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights by feature place and the intercept; `rows` are the distinct places of each text, ascending."""
    if labels.min() == labels.max():
        return np.zeros(FEATURES, np.float32), 6.0 if labels[0] else -6.0
    n, identity = len(rows), identity_places()
    sizes = [len(x) for x in rows]
    flat, owner = np.concatenate(rows).astype(np.int32), np.repeat(np.arange(n, dtype=np.int32), sizes)
    used = telling(flat, owner, labels)
    used[identity] = True
    known = np.flatnonzero(used)
    rows = [x[used[x]] for x in rows]
    copies, origin = [], []
    for k, row in enumerate(rows):
        for s in range(SWAPS):
            if (other := swapped(row, identity, k * SWAPS + s)) is not None:
                copies.append(other)
                origin.append(k)
    every = [*rows, *copies]
    owner = np.repeat(np.arange(len(every)), [len(x) for x in every])
    column = np.searchsorted(known, np.concatenate(every))
    origin = np.array(origin, np.int64)
    w, b = np.zeros(len(known)), float(np.log((labels.sum() + 1) / (n - labels.sum() + 1)))
    sums, sum_b = np.full(len(known), 1e-6), 1e-6
    for _ in range(rounds):
        z = b + np.bincount(owner, w[column], len(every))
        slope = np.zeros(len(every))
        slope[:n] = (1 / (1 + np.exp(-np.clip(z[:n], -500, 500))) - labels) / n
        if len(origin):
            change = swap_weight * (z[n:] - z[origin]) / len(origin)
            slope[n:] += change
            np.add.at(slope, origin, -change)
        g = np.bincount(column, slope[owner], len(known))
        sums += g * g
        step = rate / np.sqrt(sums)
        w -= step * g
        w = np.sign(w) * np.maximum(np.abs(w) - step * sparse, 0)
        g_b = slope.sum()
        sum_b += g_b * g_b
        b -= rate * g_b / np.sqrt(sum_b)
    weights = np.zeros(FEATURES, np.float32)
    weights[known] = w
    return weights, b


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float] | None:
    """The classifier from at most `sample` labelled rows; None without any."""
    learn = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL AND crc32(cast(doc_id AS string)) % 5 <> 0")
    learn = smallest(learn.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), F.xxhash64("doc_id"), sample)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrowtext.slices(batch, "text"):
                values, text = distinct_per_text(*places(part.column("text")))
                bounds = np.searchsorted(text, np.arange(part.num_rows + 1))
                sets = [values[a:b].astype(np.int32).tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("toxic").cast(pa.int32()), pa.array(sets, pa.binary())], ["doc_id", "toxic", "words"])

    # the sample is bounded, so it may be broadcast
    chosen = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(learn.select(F.col("doc_id").cast("long"), "toxic")), "doc_id")
    rows = chosen.mapInArrow(task, "doc_id long, toxic int, words binary")
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("words").alias("words")).collect()
    rows.sort(key=lambda x: x["doc_id"])
    if not rows:
        return None
    return fit([np.frombuffer(x["words"], np.int32) for x in rows], np.array([x["toxic"] > 0 for x in rows], float))


def score(docs: DataFrame, model: tuple[np.ndarray, float] | None) -> DataFrame:
    """doc_id, held_out, score and predicted for every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrowtext.slices(batch, "text"):
                if shipped.value is None:
                    p = np.zeros(part.num_rows)
                else:
                    weights, b = shipped.value
                    place, text = places(part.column("text"))
                    matters = weights[place] != 0
                    place, text = distinct_per_text(place[matters], text[matters])
                    p = 1 / (1 + np.exp(-np.clip(b + np.bincount(text, weights[place], part.num_rows), -500, 500)))
                columns = [part.column("doc_id"), part.column("held_out"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.expr("coalesce(crc32(cast(doc_id AS string)) % 5 = 0, false)").alias("held_out"), "text")
    return rows.mapInArrow(task, "doc_id long, held_out boolean, score double, predicted int")


def op9_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
