"""Words and shingles of Arrow text columns as 64-bit hashes, computed without a loop per word.

A batch's texts lie one after the other in one buffer of UTF-8 bytes. The hash of a word is a
polynomial of its bytes, read off a running sum, then scrambled; a buffer is worked through in
pieces of about a megabyte, cut where no word is, so that memory doesn't follow the text's length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

#: White space as the contracts take it, and every ASCII byte that is neither letter nor digit.
WHITE = np.zeros(256, dtype=bool)
WHITE[[32, 9, 10, 11, 12, 13]] = True
PUNCTUATION = np.zeros(256, dtype=bool)
PUNCTUATION[[b for b in range(128) if not chr(b).isalnum()]] = True

_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[65:91] += np.uint64(32)
_tables = (np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _tables
    if len(_tables[0]) < n:
        size = max(n, PIECE + 1)
        _tables = tuple(
            np.concatenate(([np.uint64(1)], np.cumprod(np.full(size - 1, x, dtype=np.uint64))))
            for x in (_BASE, _INVERSE)
        )
    return _tables[0][:n], _tables[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the finalizer of splitmix64)."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seed_values(seed: int, n: int) -> np.ndarray:
    """`n` fixed pseudo-random 64-bit values."""
    start = np.uint64((seed * 0x632BE59BD9B4E019 + 0x9E3779B97F4A7C15) % (1 << 64))
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _BASE + start)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the texts and where each begins, with one more for the end; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = texts.buffers()
    starts = np.frombuffer(places, dtype=width)[texts.offset:texts.offset + len(texts) + 1]
    starts = starts.astype(np.int64)
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[starts[0]:starts[-1]], starts - starts[0]


def _cuts(data: np.ndarray, starts: np.ndarray, gap: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pieces of the buffer that end at a text's end or in front of a gap."""
    at, end = 0, len(data)
    while at < end:
        to = at + PIECE
        if to >= end:
            yield at, end
            return
        k = starts[np.searchsorted(starts, to, side="right") - 1]
        if k > at:
            to = int(k)
        else:
            here = np.flatnonzero(gap[data[at + 1:to]])
            if len(here):
                to = at + 1 + int(here[-1])
            else:       # one very long word, or a text's end further on
                k = int(starts[np.searchsorted(starts, at, side="right")])
                ahead = np.flatnonzero(gap[data[to:k]])
                to = to + int(ahead[0]) if len(ahead) else k
        yield at, to
        at = to


def words(texts: pa.Array, gap: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z taken as a-z, and the place where each text's words begin."""
    data, starts = buffers(texts)
    hashes, places = [], []
    edges = np.unique(starts)
    for lo, hi in _cuts(data, edges, gap):
        part = data[lo:hi]
        inside = ~gap[part]
        before = np.empty_like(inside)
        before[0] = False
        before[1:] = inside[:-1]
        inner = edges[np.searchsorted(edges, lo):np.searchsorted(edges, hi)] - lo
        before[inner] = False
        first = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[-1] = False
        after[:-1] = inside[1:]
        after[inner[inner > 0] - 1] = False
        last = np.flatnonzero(inside & ~after)
        power, inverse = _powers(hi - lo)
        values = _LOWER[part] * power
        sums = np.cumsum(values)
        hashes.append(mix((sums[last] - sums[first] + values[first]) * inverse[first]))
        places.append(first + lo)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    place = np.concatenate(places)
    return np.concatenate(hashes), np.searchsorted(place, starts)


def chain(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of `k` neighbours in the array."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out = mix(out ^ (hashes[j:j + n] + np.uint64(j * int(_BASE) % (1 << 64))))
    return out


def shingles(hashes: np.ndarray, starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of `k` words, sorted within each text, and where each text's begin.

    A text of fewer words has one shingle, its whole sequence; without words it has none.
    """
    count = np.diff(starts)
    run = chain(hashes, k)
    owner = np.repeat(np.arange(len(count)), count)
    keep = np.arange(len(run)) + k <= np.repeat(starts[1:], count)[:len(run)]
    value, owner = run[keep], owner[:len(run)][keep]
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        whole = [chain(hashes[starts[i]:starts[i + 1]], int(count[i]))[0] for i in short]
        extra = mix(np.array(whole, dtype=np.uint64) + count[short].astype(np.uint64))
        value, owner = np.concatenate((value, extra)), np.concatenate((owner, short))
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.searchsorted(owner, np.arange(len(count) + 1))


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about `limit` bytes of text."""
    if not batch.num_rows:
        return
    _, starts = buffers(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(starts, starts[at] + limit, side="right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to
