"""Words of many texts at once, as numpy arrays; every operator here that reads words uses these.

A word is a run of bytes other than space and 0x09-0x0D. Words are never Python objects: a batch of texts
gives word boundaries, word hashes and the place of each document in them.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are hashed in blocks of about so many bytes, which bounds the working arrays.
BLOCK_BYTES = 1 << 20
#: Powers kept for the polynomial over the bytes of a word; longer words start over with another factor.
SPAN = 256

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, dtype=np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


def _tables(seed: int) -> tuple[np.ndarray, np.ndarray, np.uint64]:
    letters = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
    base = int(mix(np.array([seed + 77], dtype=np.uint64))[0]) | 1
    return letters, _powers(base, SPAN), np.uint64(base ^ 0x5DEECE66D4)


_SEEDED = {seed: _tables(seed) for seed in (1, 2)}


@dataclass
class Words:
    """Words of a batch of texts: word i is data[starts[i]:ends[i]], document d has words first[d] to first[d+1]."""

    data: np.ndarray
    text_starts: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def documents(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, seed: int = 1) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        letters, powers, again = _SEEDED[seed]
        out = np.empty(len(self.starts), dtype=np.uint64)
        cuts = np.searchsorted(self.starts, np.arange(0, len(self.data) + BLOCK_BYTES, BLOCK_BYTES))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            starts, lengths = self.starts[a:b], (self.ends[a:b] - self.starts[a:b])
            edge = np.concatenate([[0], np.cumsum(lengths)])
            place = np.arange(edge[-1])
            within = place - np.repeat(edge[:-1], lengths)
            terms = letters[self.data[place + np.repeat(starts - edge[:-1], lengths)]]
            if lengths.max() <= SPAN:
                terms *= powers[within]
            else:
                terms *= powers[within % SPAN] * (mix((within // SPAN).astype(np.uint64) * again) | np.uint64(1))
            out[a:b] = np.add.reduceat(terms, edge[:-1]) + lengths.astype(np.uint64) * again
        return mix(out)

    def trim(self) -> None:
        """Takes punctuation off the ends of words; a word of nothing else keeps a byte."""
        for _ in range(3):
            if len(self.starts):
                self.ends = self.ends - (_MARK[self.data[self.ends - 1]] & (self.ends - self.starts > 1))
                self.starts = self.starts + (_MARK[self.data[self.starts]] & (self.ends - self.starts > 1))

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def texts_of(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A text column as one binary array; null becomes empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    return column.fill_null("").cast(pa.binary()) if column.type != pa.binary() else column.fill_null(b"")


def words_of(column: pa.Array | pa.ChunkedArray, lower: bool = False) -> Words:
    texts = texts_of(column)
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64) if n else np.zeros(1, dtype=np.int64)
    raw = texts.buffers()[2] if n else None
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw is not None and raw.size else np.zeros(0, dtype=np.uint8)
    offsets = offsets - offsets[0]
    if lower:
        data = _LOWER[data]
    solid = ~_BLANK[data]
    before = np.empty_like(solid)
    before[1:], before[:1] = solid[:-1], False
    at_edge = offsets[:-1][offsets[:-1] < len(data)]
    before[at_edge] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.empty_like(solid)
    after[:-1], after[-1:] = solid[1:], False
    last = offsets[1:][offsets[1:] > 0] - 1
    after[last] = False
    ends = np.flatnonzero(solid & ~after) + 1
    return Words(data, offsets[:-1], starts, ends, np.searchsorted(starts, offsets))


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two hashes in their order."""
    out = (a ^ (a >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    out += b * np.uint64(0x9E3779B97F4A7C15)
    return out ^ (out >> np.uint64(32))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of the n values from each place on; the last n - 1 places are left out. Built by doubling."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, dtype=np.uint64)
    power, span, out, have = hashes, 1, None, 0
    while True:
        if n & span:
            out = power[:size] if out is None else joined(out, power[have : have + size])
            have += span
        if have == n:
            return mix(out ^ np.uint64(n))
        power, span = joined(power[:-span], power[span:]), 2 * span


def gram_places(first: np.ndarray, n: int) -> np.ndarray:
    """Word places from which n words of one document follow."""
    room = np.maximum(np.diff(first) - n + 1, 0)
    starts = np.concatenate([[0], np.cumsum(room)])
    return np.arange(starts[-1]) - np.repeat(starts[:-1], room) + np.repeat(first[:-1], room)


def covered(places: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of size words lie in a run of n words from one of the places."""
    step = np.bincount(places, minlength=size + 1) - np.bincount(places + n, minlength=size + 1 + n)[: size + 1]
    return np.cumsum(step[:size]) > 0


def first_of(codes: np.ndarray, kinds: int) -> np.ndarray:
    """Where each of the codes 0 to kinds - 1 occurs first."""
    out = np.empty(kinds, dtype=np.int64)
    out[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return out


def tidied(work: Callable) -> Callable:
    """The same function over batches, which in the end gives freed memory back to the system: Spark keeps the
    worker process, idle, for later tasks of any kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def give_back() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where there is no such call
        ctypes.CDLL(None).malloc_trim(0)


def runs(texts: pa.Array, limit: int) -> list[tuple[int, int]]:
    """Texts in runs of about limit bytes, or of one longer text: the first of each run and the one behind its last."""
    run = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)) // limit
    edges = np.flatnonzero(np.diff(run, prepend=-1)) if len(run) else run
    return list(zip(edges.tolist(), np.append(edges[1:], len(run)).tolist(), strict=False))


def slices(batch: pa.RecordBatch, text: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in such runs of their texts; bounds working arrays."""
    for a, b in runs(texts_of(batch.column(text)), limit):
        yield batch.slice(a, b - a)
