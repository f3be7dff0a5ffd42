"""Whole texts as flat byte arrays: vectorised words and word hashes inside Arrow tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20


def byte_class(members: bytes) -> np.ndarray:
    """Lookup table: True for each byte value in `members`."""
    table = np.zeros(256, bool)
    table[np.frombuffer(members, np.uint8)] = True
    return table


#: Words separated by ASCII white space.
NOT_SPACE = ~byte_class(b"\x20\x09\x0a\x0b\x0c\x0d")
#: Words of ASCII letters, digits, underscore and every code point beyond ASCII.
WORD_BYTES = byte_class(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_" + bytes(range(128, 256)))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (finaliser of a splittable generator)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def slices(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about `limit` bytes of text each (one row at least)."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes.astype(np.int64)) // limit
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [batch.num_rows]])
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield batch.slice(int(a), int(b - a))


def text_bytes(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row and the n + 1 offsets of the texts; null counts as empty."""
    column = pc.fill_null(column, "")
    column = pc.utf8_lower(column) if lower else column
    column = pa.concat_arrays([column.cast(pa.large_string())])
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end (bytes, end exclusive) and text number of every word; words never span two texts."""
    inside = table[data]
    n = len(data)
    firsts = offsets[:-1][offsets[:-1] < n]
    edge = np.zeros(n + 1, bool)
    edge[firsts] = True
    edge[n] = True
    begins, finishes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    finishes[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same in every process."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    within = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    powers = np.full(int(sizes.max()), 0x9E3779B97F4A7C15, np.uint64)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    terms = (data[within + np.repeat(starts, sizes)].astype(np.uint64) + np.uint64(1)) * powers[within]
    return mix(np.add.reduceat(terms, first) + sizes.astype(np.uint64))


def shingles(hashes: np.ndarray, text: np.ndarray, n_texts: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every window of `size` words inside a text, and its text number.

    A text of 1 to size - 1 words has one shingle, made of all its words.
    """
    counts = np.bincount(text, minlength=n_texts) if len(text) else np.zeros(n_texts, np.int64)
    out = hashes.copy()
    keep = np.ones(len(hashes), bool)
    last = np.cumsum(counts)[text] if len(text) else text  # end of the word's text
    here = np.arange(len(hashes))
    multiplier = np.uint64(0xD6E8FEB86659FD93)
    for k in range(1, size):
        has = here + k < last
        out[has] = mix(out[has] * multiplier + hashes[here[has] + k] + np.uint64(k))
        keep &= has
    first_of_text = np.zeros(len(hashes), bool)
    if len(hashes):
        first_of_text[np.cumsum(counts)[counts > 0] - counts[counts > 0]] = True
        keep |= first_of_text & (counts[text] < size)
    return out[keep], text[keep]
