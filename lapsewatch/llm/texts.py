"""Words of many texts as arrays: shared by the operators that run numpy inside Spark tasks.

A batch of texts becomes one byte buffer; word bounds and 64-bit word hashes are found for the whole
buffer at once. A null text counts as empty. Memory is bounded by the buffer size given to
:func:`pieces` and the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

# Multipliers of a 64-bit mixer (odd, taken from the splitmix finaliser and the golden ratio).
MIX_1, MIX_2, GOLDEN = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
LONG_WORD = 64


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser, elementwise."""
    h = (h ^ (h >> np.uint64(30))) * MIX_1
    h = (h ^ (h >> np.uint64(27))) * MIX_2
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """Words of a run of texts, in order: byte bounds in ``data``, text number, 64-bit hash."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray  # words of text i are bounds[i]:bounds[i + 1]


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``limit`` bytes of text, and at least one row."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        sizes = np.array([0 if x is None else x for x in pa.compute.binary_length(batch.column(at)).to_pylist()], np.int64)
        ends = np.cumsum(sizes)
        i = 0
        while i < len(sizes):
            base = ends[i - 1] if i else 0
            j = max(i + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(i, j - i)
            i = j


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    col = batch.column(batch.schema.get_field_index(column))
    return [b"" if x is None else x for x in col.cast(pa.binary()).to_pylist()]


def words_of(texts: list[bytes], space: np.ndarray = SPACE) -> Words:
    """Split lower-cased (A-Z only) texts at the bytes marked in ``space``."""
    joined = b" ".join(texts) + b" " * 9
    data = LOWER[np.frombuffer(joined, np.uint8)]
    gap = space[data]
    gap[len(joined) - 9:] = True
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.cumsum(sizes + 1) - sizes - 1
    gap[begins[1:] - 1] = True
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if not gap[0]:
        edge = np.concatenate(([0], edge))
    start, end = edge[0::2], edge[1::2]
    bounds = np.append(np.searchsorted(start, begins), len(start))
    text = np.repeat(np.arange(len(texts)), np.diff(bounds))
    return Words(data, start, end, text, word_hashes(data, start, end), bounds)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges; ``data`` is padded by at least eight bytes."""
    size = end - start
    h = mix(size.astype(np.uint64) * GOLDEN)
    eight = np.ndarray(len(data) - 7, "<u8", data.tobytes(), strides=(1,))
    masks = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
    at, left, live = start, size, np.arange(len(start))
    if len(size) and size.max() > LONG_WORD:
        long = np.flatnonzero(size > LONG_WORD)
        h[long] = [xxhash.xxh64_intdigest(data[a:b].tobytes()) for a, b in zip(start[long], end[long])]
        live = np.flatnonzero(size <= LONG_WORD)
        at, left = start[live], size[live]
    while len(live):
        block = eight[at] & masks[np.minimum(left, 8)]
        h[live] = mix((h[live] ^ block) * GOLDEN)
        more = np.flatnonzero(left > 8)
        live, at, left = live[more], at[more] + 8, left[more] - 8
    return h


def shingle_sets(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``width``-word shingles of each text as sorted 64-bit hashes, and their bounds.

    A text with fewer words, but not none, has its whole sequence as its one shingle.
    """
    n = np.diff(words.bounds)
    texts = len(n)
    runs = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    first = np.repeat(words.bounds[:-1] - np.concatenate(([0], np.cumsum(runs)[:-1])), runs) + np.arange(runs.sum())
    owner = np.repeat(np.arange(texts), runs)
    have = np.minimum(n, width)[owner]
    h = np.zeros(len(first), np.uint64)
    padded = np.concatenate((words.hash, np.zeros(width, np.uint64)))
    for k in range(width):
        part = mix(padded[first + k] + np.uint64((int(GOLDEN) * (k + 1)) % 2**64))
        h = (h ^ np.where(have > k, part, np.uint64(0))) * MIX_1
        h ^= h >> np.uint64(29)
    h = mix(h + have.astype(np.uint64))
    last = np.cumsum(runs)
    for a, b in zip(last - runs, last):
        h[a:b].sort()
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[keep], owner[keep]
    return h, np.searchsorted(owner, np.arange(texts + 1))
