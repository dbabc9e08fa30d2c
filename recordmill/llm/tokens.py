"""Token hashing on whole Arrow batches: texts become arrays of 64-bit token hashes.

A token is a maximal run of bytes of one class; class 0 separates. Hashes are polynomial
over the token's bytes, taken from one running sum over the batch, so no token becomes a
Python object. Work arrays are bounded by ``CHUNK`` bytes of text, or by one text longer
than that.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}

#: White space separates, all else is one class.
WORDS = np.ones(256, dtype=np.uint8)
WORDS[[0x20, *range(0x09, 0x0E)]] = 0
#: As ``WORDS``, but runs of ASCII punctuation are tokens of their own.
WORDS_AND_MARKS = WORDS.copy()
WORDS_AND_MARKS[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = 2
#: Letters, digits and non-ASCII bytes; all else separates.
PLAIN_WORDS = WORDS.copy()
PLAIN_WORDS[[b for b in range(0x80) if not chr(b).isalnum()]] = 0
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the whole word (the finalizer of splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _table(kind: int, size: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < size:
        base = _BASE if kind == 0 else _INVERSE
        steps = np.full(max(size, CHUNK + 1), base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[kind] = np.multiply.accumulate(steps)
    return have


def power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the polynomial's base and of its inverse."""
    return _table(0, size), _table(1, size)


@dataclass
class Tokens:
    """Tokens of some texts: hashes, byte bounds in ``data``, and where each text begins."""

    data: np.ndarray  # bytes of all texts
    hash: np.ndarray  # uint64 for each token
    start: np.ndarray  # first byte of each token
    end: np.ndarray  # byte after each token
    first: np.ndarray  # index of each text's first token; one more for the end
    kind: np.ndarray  # class of each token

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The text number of each token."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offset of each; null is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(offsets) else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def tokens(texts: pa.Array, classes: np.ndarray = WORDS, lower: bool = True) -> Tokens:
    """Tokens of ``texts``; ``lower`` folds A-Z. Null and empty texts have none."""
    data, offsets = text_bytes(texts)
    kind = classes[data]
    size = len(data)
    edge = np.ones(size + 1, dtype=bool)
    edge[1:size] = kind[1:] != kind[:-1]
    edge[offsets] = True
    bounds = np.flatnonzero(edge) if size else np.zeros(1, np.int64)
    start, end = bounds[:-1], bounds[1:]
    kept = kind[start] != 0
    start, end = start[kept], end[kept]
    folded = LOWER[data] if lower else data
    running = np.zeros(size + 1, dtype=np.uint64)
    np.cumsum((folded.astype(np.uint64) + np.uint64(1)) * _table(0, size + 1)[:size], out=running[1:])
    value = (running[end] - running[start]) * _table(1, size + 1)[start]
    return Tokens(folded, mix(value), start, end, np.searchsorted(start, offsets), kind[start])


def token_hash(text: str) -> int:
    """The hash that ``tokens`` gives a single token."""
    return int(tokens(pa.array([text]), np.ones(256, np.uint8), lower=False).hash[0])


def ngrams(tok: Tokens, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` tokens within a text, and the index of each run's first token."""
    total = len(tok.hash)
    if n == 1:
        return tok.hash, np.arange(total)
    if total < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = tok.hash[: total - n + 1].copy()
    for j in range(1, n):
        h = h * _BASE + tok.hash[j : total - n + 1 + j]
    inside = np.zeros(total + 1, dtype=bool)
    starts = tok.first[:-1]
    for j in range(1, n):  # a run that begins less than n tokens before a text's start reaches into it
        at = starts - j
        inside[at[at >= 0]] = True
    own = np.flatnonzero(~inside[: total - n + 1])
    # Runs near the end of all texts were cut above; those before an empty text are covered by its start.
    return mix(h[own]), own


def _give_back() -> None:
    """Returns freed memory to the system: workers stay after a task, and an executor holds several."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """The rows in slices that hold at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column))
        sizes = np.diff(text_bytes(values)[1])
        low, held = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if i > low and held + size > limit:
                yield batch.slice(low, i - low)
                low, held = i, 0
            held += size
        if low < len(sizes):
            yield batch.slice(low)
    _give_back()


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum over each text's tokens; zero where it has none."""
    out = np.zeros((len(first) - 1, *values.shape[1:]), dtype=values.dtype)
    full = first[1:] > first[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, first[:-1][full], axis=0)
    return out
