"""Texts of an Arrow batch as flat numpy arrays: bytes, words, rolling hashes.

Hashes of spans are two polynomials modulo a prime, mixed at the end; equal
inputs have equal hashes in every task. Modulo 2**64 they would be cheaper, but
there some structured strings share a hash under any base.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts looked at together; work on them takes up to some hundred bytes of memory a byte.
CHUNK_BYTES = 1 << 19
U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
INVERSE = U64(pow(int(BASE), -1, 1 << 64))
PRIME = U64((1 << 31) - 1)
PRIME_BASES = (1_283_746_519, 902_147_681)
_rng = np.random.Generator(np.random.PCG64(20240601))
BYTE_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in a row, and where each text begins, with the end last."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    held = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return held[bounds[0] : bounds[-1]], bounds - bounds[0]


def chunks(batch: pa.RecordBatch, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch of about ``limit`` bytes of ``text``, each with ``flat`` of them."""
    at = 0
    data, bounds = flat(batch.column("text"))
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, side="right")) - 1)
        yield batch.slice(at, end - at), data[bounds[at] : bounds[end]], bounds[at : end + 1] - bounds[at]
        at = end
    release()


def _libc_trim():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # another C library
        return lambda pad: 0


_trim = _libc_trim()


def release() -> None:
    """Gives freed memory back: Spark keeps Python workers, some idle, beside those at work."""
    pa.default_memory_pool().release_unused()
    _trim(0)


_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """``base ** (0, 1, ... n - 1)``, kept for up to two chunks."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        steps = np.full(n, base, dtype=np.uint64)
        steps[:1] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if n <= 2 * CHUNK_BYTES:
            _powers[int(base)] = have
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of ``h`` over all bits."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def _folded(x: np.ndarray) -> np.ndarray:
    """A number under 2**32 that equals ``x`` modulo ``PRIME``, for ``x`` under 2**62; in place."""
    high = x >> U64(31)
    x &= PRIME
    x += high
    return x


def _residue(x: np.ndarray) -> np.ndarray:
    """``x`` modulo ``PRIME``, for ``x`` under 2**62."""
    x = _folded(_folded(x.copy()))
    x[x == PRIME] = 0
    return x


_prime_powers: dict[int, np.ndarray] = {}


def prime_powers(base: int, n: int) -> np.ndarray:
    """``base ** (0, 1, ... n - 1)`` modulo ``PRIME``, kept for up to two chunks."""
    have = _prime_powers.get(base)
    if have is None or len(have) < n:
        have = np.ones(1, dtype=np.uint64)
        while len(have) < n:
            step = U64(pow(base, len(have), int(PRIME)))
            have = np.concatenate([have, _residue(have * step)])
        if n <= 2 * CHUNK_BYTES:
            _prime_powers[base] = have
    return have[:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each ``values[start:end]``; lengths count too.

    One polynomial takes the low half of each value, another the high half.
    """
    n = len(values)
    sums = np.zeros(n + 1, dtype=np.uint64)
    halves = []
    for base, part in zip(PRIME_BASES, (values & PRIME, values >> U64(33))):
        part *= prime_powers(pow(base, -1, int(PRIME)), n)
        np.cumsum(_folded(part), out=sums[1:])
        span = _residue(sums[ends] - sums[starts])
        halves.append(_residue(span * prime_powers(base, n + 1)[starts]))
    h = (halves[0] << U64(33)) ^ (halves[1] << U64(2))
    return mix(h + (ends - starts).astype(np.uint64) * U64(0xD6E8FEB86659FD93))


def word_spans(is_word: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of runs of word bytes within each text, and where each text's words begin."""
    n = len(is_word)
    edge = np.zeros(n + 1, dtype=bool)
    edge[bounds] = True
    first = is_word.copy()
    first[1:] &= ~is_word[:-1] | edge[1:n]
    last = is_word.copy()
    last[:-1] &= ~is_word[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def within(first: np.ndarray, size: int) -> np.ndarray:
    """Places at which ``size`` items in a row lie in one text; ``first`` as from ``word_spans``."""
    n = int(first[-1])
    ok = np.zeros(n + 1, dtype=np.int32)
    counts = np.diff(first)
    long = counts >= size
    np.add.at(ok, first[:-1][long], 1)
    np.add.at(ok, first[1:][long] - size + 1, -1)
    return np.flatnonzero(np.cumsum(ok[:n]) > 0)


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``start, start + 1, ... start + count - 1`` of all in a row."""
    total = int(counts.sum())
    if not total:
        return np.empty(0, dtype=np.int64)
    ends = np.cumsum(counts)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - counts), counts)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """``values`` cut into one list for each count."""
    bounds = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=bounds[1:])
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))
