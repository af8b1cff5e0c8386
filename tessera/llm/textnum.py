"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

A batch of texts is one byte buffer with document offsets (exactly the
layout of an Arrow string column), so no Python object is made per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_rng = np.random.RandomState(20240607)
_BYTE = _rng.randint(0, 2**63, 256, dtype=np.int64).astype(U) * U(2) + U(1)
_P = U(0x9E3779B97F4A7C15)
_P_INV = U(pow(0x9E3779B97F4A7C15, -1, 2**64))
_power_cache = {"p": np.ones(1, U), "i": np.ones(1, U)}


def _powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _power_cache[name]
    if len(have) < n:
        more = np.full(-(-n // 65536) * 65536, base, U)
        more[0] = U(1)
        have = _power_cache[name] = np.multiply.accumulate(more)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes about half of the output."""
    x = x ^ (x >> U(33))
    x *= U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n+1 offsets of a string or binary column; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64) if offsets else np.zeros(len(column) + 1, np.int64)
    buf = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data and len(offsets) else np.zeros(0, np.uint8)
    return buf, offsets - offsets[0]


def give_back() -> None:
    """Returns what a worker has freed to the system: workers are kept for
    many tasks, and what they hold on to adds up beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def blocks(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes (or one row); what the work on
    the one before has freed is given back."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)
        give_back()


def lower(buf: np.ndarray) -> np.ndarray:
    """A-Z lower-cased; every other byte as it is."""
    return _LOWER[buf]


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and where each document's words
    begin (n+1 offsets into the words)."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[buf]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edge = offsets[:-1][offsets[1:] > offsets[:-1]]
    first[edge] = inside[edge]
    end = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    last[end] = inside[end]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets).astype(np.int64)


def span_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every byte span, from one prefix sum over the bytes."""
    total = np.zeros(len(buf) + 1, U)
    np.cumsum(_BYTE[buf] * _powers("p", _P, len(buf)), out=total[1:])
    return mix((total[ends] - total[starts]) * _powers("i", _P_INV, len(buf) + 1)[starts] + (ends - starts).astype(U))


def window_hash(word_hash: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``k`` words inside a document, and each
    document's offsets into them.  A document with fewer words (but some)
    gives its whole sequence as one run."""
    n = len(word_hash)
    counts = np.diff(bounds)
    runs = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    out_bounds = np.concatenate([[0], np.cumsum(runs)])
    if not n:
        return np.zeros(0, U), out_bounds
    seeds = mix(np.arange(1, k + 1, dtype=U) * _P) | U(1)
    joint = np.zeros(n, U)
    for j in range(k):
        joint[:n - j] += word_hash[j:] * seeds[j]
    start = np.repeat(bounds[:-1], runs) + (np.arange(out_bounds[-1]) - np.repeat(out_bounds[:-1], runs))
    out = mix(joint[start])
    for d in np.flatnonzero((counts > 0) & (counts < k)):
        a, b = bounds[d], bounds[d + 1]
        out[out_bounds[d]] = mix((word_hash[a:b] * seeds[:b - a]).sum(keepdims=True, dtype=U) + U(b - a))[0]
    return out, out_bounds


def span_identity(word_hash: np.ndarray) -> tuple[int, int]:
    """Order-free 128-bit identity of a set of hashes."""
    return int(mix(word_hash).sum(dtype=U)), int(mix(word_hash ^ U(0x5851F42D4C957F2D)).sum(dtype=U))
