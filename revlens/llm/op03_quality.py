"""Quality rules: repetition inside a document, found with a suffix array of its words.

Words are maximal runs of characters other than space and U+0009..U+000D. The suffix
array of a text is built by prefix doubling (many texts at once, none sharing a symbol
with another). Longest common prefixes of neighbouring suffixes give every maximal
repeated substring; the union of those of `min_words` words or more is the covered part.
A text is rejected if the covered part is over `max_covered` of its words or if one
repeat is over `max_repeat` words long, beside the base rules.

Defined results: a null or empty text has no words and fails the base rule; every input
row gives one output row, so repeated rows and null ids stay; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from revlens.llm import arrowtext

SYMBOLS = arrowtext.byte_class(b"#*$%&|<>")
#: Production parameters.
MIN_WORDS = 5
MAX_COVERED_PERCENT = 50
MAX_REPEAT = 200

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, covered_words long, longest_repeat long"
)


def repeat_lengths(symbols: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """For every position, the longest substring starting there that occurs again in the same text.

    `symbols` are word hashes in text order, `text` their text numbers (ascending).
    """
    n = len(symbols)
    if not n:
        return np.zeros(0, np.int64)
    # position n stands for "beyond the text"
    end = np.cumsum(np.bincount(text, minlength=n_texts))[text]
    rank = np.empty(n, np.int64)
    keyed = arrowtext.mix(symbols ^ arrowtext.mix(text.astype(np.uint64) * np.uint64(0xA0761D6478BD642F) + np.uint64(0xE7037ED1A0B428DB)))
    order = np.argsort(keyed, kind="stable")
    fresh = np.r_[True, keyed[order][1:] != keyed[order][:-1]]
    rank[order] = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    levels, width = [rank.copy()], 1
    suffixes = order
    while True:
        same = rank[suffixes]
        twin = np.zeros(n, bool)
        twin[:-1] = same[:-1] == same[1:]
        twin[1:] |= twin[:-1]
        places = np.flatnonzero(twin)
        if not len(places):
            break
        active = suffixes[places]
        beyond = active + width
        second = np.where(beyond < end[active], rank[np.minimum(beyond, n - 1)], -1)
        inner = np.lexsort((second, rank[active]))
        active, second = active[inner], second[inner]
        suffixes[places] = active
        first = rank[active]
        fresh = np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])]
        rank[active] = places[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
        levels.append(rank.copy())
        width *= 2
    left, right = suffixes[:-1], suffixes[1:]
    common = np.zeros(n - 1, np.int64)
    pairs = np.flatnonzero(levels[0][left] == levels[0][right])
    for level in range(len(levels) - 1, -1, -1):
        step = 1 << level
        while True:
            a, b = left[pairs] + common[pairs], right[pairs] + common[pairs]
            inside = (a + step <= end[left[pairs]]) & (b + step <= end[right[pairs]])
            ranks = levels[level]
            hit = inside & (ranks[np.minimum(a, n - 1)] == ranks[np.minimum(b, n - 1)])
            common[pairs[hit]] += step
            # the top level may match more than once in a run of equal words
            if level < len(levels) - 1 or not hit.any():
                break
    longest = np.zeros(n, np.int64)
    longest[left] = common
    longest[right] = np.maximum(longest[right], common)
    return longest


def covered(longest: np.ndarray, text: np.ndarray, n_texts: int, at_least: int, window: int | None = None) -> np.ndarray:
    """Words of each text inside a repeat of `at_least` words (of each such repeat only its first `window`)."""
    n = len(longest)
    here = np.flatnonzero(longest >= at_least)
    delta = np.zeros(n + 1, np.int64)
    np.add.at(delta, here, 1)
    np.add.at(delta, here + (longest[here] if window is None else window), -1)
    return np.bincount(text[np.cumsum(delta)[:n] > 0], minlength=n_texts)


def duplicate_lines(text: str | None) -> int:
    """Lines holding a word that equal an earlier line of the text."""
    if not text or "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def measure(ids: pa.Array, texts: pa.Array, min_words: int, max_covered_percent: int, max_repeat: int) -> pa.RecordBatch:
    n = len(texts)
    data, offsets = arrowtext.text_bytes(texts)
    starts, ends, text = arrowtext.words(data, offsets, arrowtext.NOT_SPACE)
    longest = repeat_lengths(arrowtext.word_hashes(data, starts, ends), text, n)
    n_words = np.bincount(text, minlength=n)
    totals = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[offsets])
    in_word = arrowtext.NOT_SPACE[data]
    word_chars = totals(in_word & ((data & 0xC0) != 0x80))
    symbols = totals(SYMBOLS[data])
    repeated = covered(longest, text, n, 3, 3)
    cover = covered(longest, text, n, min_words)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, text, longest)
    base = (n_words < 50) | (100 * repeated > 50 * n_words)
    kept = ~base & (100 * cover <= max_covered_percent * n_words) & (top <= max_repeat)
    dup_lines = np.array([duplicate_lines(x) for x in texts.to_pylist()], np.int64)
    longs = lambda x: pa.array(x.astype(np.int64))
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays(
        [ids, longs(n_words), longs(word_chars), longs(symbols), longs(dup_lines), longs(repeated), pa.array(base), pa.array(kept), longs(cover), longs(top)],
        names,
    )


def repetition(docs: DataFrame, min_words: int = MIN_WORDS, max_covered_percent: int = MAX_COVERED_PERCENT, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row of counts and the verdict for each row of `docs` (doc_id, text)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrowtext.slices(batch, "text"):
                yield measure(part.column("doc_id").cast(pa.int64()), part.column("text"), min_words, max_covered_percent, max_repeat)

    return docs.select("doc_id", "text").mapInArrow(task, SCHEMA)


def keep_good(docs: DataFrame, min_words: int = MIN_WORDS, max_covered_percent: int = MAX_COVERED_PERCENT, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """The rows of `docs` that pass, all columns as they are, in one pass without a shuffle."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrowtext.slices(batch, "text"):
                ids = pa.nulls(part.num_rows, pa.int64())
                yield part.filter(measure(ids, part.column("text"), min_words, max_covered_percent, max_repeat).column("kept"))

    return docs.mapInArrow(task, docs.schema)


def op3_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return repetition(docs).drop("longest_repeat")


#: The union of all repeats of m words or more is the union of all m-word windows found
#: twice or more, and a repeat over k words exists when a window of k + 1 is found twice.
ORACLE = f"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), p AS (SELECT r, ws, len(ws) AS n, unnest(range(1, len(ws) + 1)) AS i FROM w),
g AS (SELECT r, i, n, array_to_string(ws[i : i + 2], ' ') AS w3, array_to_string(ws[i : i + {MIN_WORDS - 1}], ' ') AS wm,
        array_to_string(ws[i : i + {MAX_REPEAT}], ' ') AS wk FROM p),
c AS (SELECT r, i,
        i + 2 <= n AND count(*) FILTER (WHERE i + 2 <= n) OVER (PARTITION BY r, w3) > 1 AS r3,
        i + {MIN_WORDS - 1} <= n AND count(*) FILTER (WHERE i + {MIN_WORDS - 1} <= n) OVER (PARTITION BY r, wm) > 1 AS rm,
        i + {MAX_REPEAT} <= n AND count(*) FILTER (WHERE i + {MAX_REPEAT} <= n) OVER (PARTITION BY r, wk) > 1 AS rk FROM g),
m AS (SELECT r, i, rk, max(r3::int) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS in3,
        max(rm::int) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN {MIN_WORDS - 1} PRECEDING AND CURRENT ROW) AS inm FROM c),
t AS (SELECT r, sum(in3) AS n3, sum(inm) AS nm, bool_or(rk) AS over FROM m GROUP BY r),
l AS (SELECT r, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM w),
d AS (SELECT r, count(*) - count(DISTINCT line) AS dup FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY r),
f AS (SELECT w.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
        length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup, 0) AS n_dup_lines,
        coalesce(n3, 0) AS n_repeat_words, coalesce(nm, 0) AS covered_words, coalesce(over, false) AS over
      FROM w LEFT JOIN t USING (r) LEFT JOIN d USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND 100 * covered_words <= {MAX_COVERED_PERCENT} * n_words AND NOT over AS kept, covered_words::BIGINT AS covered_words
FROM b
"""
